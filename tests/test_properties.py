"""Properties that hold for any log, on the test tables and on skewed ones."""

import datetime as dt
import re
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cartwise.functions import scalars as S
from cartwise.operators import cube, joins, measures, ranks
from cartwise.operators.log import action_log, counted_log
from cartwise.operators.windows import WindowSpec
from cartwise.plans import dataset, families, labels
from cartwise.plans.run import Plan, Run
from cartwise.session import PLAN_CONF, new_folder
from cartwise.sources import fixtures as X
from cartwise.sources.tables import Tables, materialize, materialize_bucketed
from checks import spark_queries
from tests.conftest import SF


@pytest.fixture(scope="module")
def built(spark):
    keep = spark_queries.writer(spark)
    x = spark_queries.inputs(spark, SF, keep=keep)
    return x, families.all_families(x)


def test_counts_grow_with_the_range(built):
    _, tables = built
    for name, prefix in (("ucs", "ucs"), ("uc", "uc"), ("us", "us")):
        columns = [f"{prefix}_b_count_in_{n}" for n in (1, 3, 5, 7, 10)]
        shrinking = " OR ".join(f"{a} > {b}" for a, b in zip(columns, columns[1:]))
        assert tables[name].where(shrinking).count() == 0


def test_rank_one_exists_for_every_active_user(built):
    _, tables = built
    best = tables["uc"].groupBy("user_id").agg(
        F.min("uc_b_count_rank_in_7_in_u").alias("best"), F.sum("uc_b_count_in_7").alias("n")
    )
    assert best.where("n > 0 AND best != 1").count() == 0


def test_joins_neither_add_nor_lose_candidates(built):
    x, tables = built
    rows = labels.train_labels(x.log, x.spec)
    wide = dataset.assemble(rows, tables, x.pairs)
    assert wide.count() == rows.count() == tables["ucs"].count()
    assert wide.select(*families.UCS).distinct().count() == rows.count()
    nulls = [F.count_if(F.col(c).isNull()) for c in wide.columns]
    assert sum(wide.agg(*nulls).first()) == 0


def test_assembling_without_a_bound_gives_the_same_set(built):
    x, tables = built
    rows = labels.train_labels(x.log, x.spec)
    one, other = dataset.assemble(rows, tables, x.pairs), dataset.assemble(rows, tables, None)
    assert one.columns == other.columns
    assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_kept_tables_are_joined_without_a_shuffle(built):
    """Above the written tables nothing but broadcasts moves, and a session that knows no bucketed table names it again."""
    x, tables = built
    rows = x.keep("candidates", labels.train_labels(x.triples, x.spec), x.by_user)
    wide = dataset.assemble(rows, tables, x.pairs, x.by_user)
    text = plan(wide)
    assert "Bucketed: true" in text and "Exchange hashpartitioning" not in text and "Exchange REPARTITION" not in text
    plain = dataset.assemble(labels.train_labels(x.log, x.spec), tables, None)
    assert wide.exceptAll(plain).count() == 0 and plain.exceptAll(wide).count() == 0


def test_sets_are_sorted_and_joined_as_few_columns(spark):
    """Features of a family travel as one struct, also where some are dropped; a query of few features reads only those."""
    def columns(df, operator):
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        return [int(n) for n in re.findall(rf"\) {operator}.*\n(?:Input|Output) \[(\d+)\]", text)]

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert 0 < max(columns(spark_queries.ds_feature_select(spark, SF), "Sort")) <= 60
        assert 0 < max(columns(spark_queries.feat_window_diffs(spark, SF), "Scan parquet")) <= 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("digits", [3, 9])
def test_doubles_are_rounded_as_by_round(spark, digits):
    unit = 10.0 ** -digits
    odd = [None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, 5e-324, -unit / 4, 1 / 3, -2 / 3, 60.0, 999.9999999995, 1000.0, -1e12 / 7, 1e300]
    ties = [sign * (k + 0.5) * unit for k in range(300) for sign in (1, -1)]
    df = spark.createDataFrame([(x,) for x in [*odd, *ties, *[k / 7 - 90 for k in range(1300)]]], "x double")
    wanted = df.selectExpr(f"string(round(x, {digits})) AS x")  # text tells -0.0 from 0.0
    got = S.round_doubles(df, digits).selectExpr("string(x) AS x")
    assert got.exceptAll(wanted).count() == 0 and wanted.exceptAll(got).count() == 0


def test_buckets_are_found_again(spark):
    path = new_folder(spark, "buckets")
    rows = spark.range(1000).selectExpr("id % 37 AS user_id", "id", "named_struct('a', id) AS s")
    first = materialize_bucketed(spark, path, lambda: rows.repartition(4, "user_id"), "user_id", 4, "m")
    name = next(t.name for t in spark.catalog.listTables() if t.name.startswith("cartwise_") and first.inputFiles()[0].split("/")[-1]
                in {f.split("/")[-1] for f in spark.table(t.name).inputFiles()})
    spark.sql(f"DROP TABLE {name}")  # as in another session; the files stay
    again = materialize_bucketed(spark, path, lambda: 1 / 0, "user_id", 4, "m")
    assert again.exceptAll(rows).count() == 0 and again.count() == 1000
    assert "Exchange" not in plan(again.groupBy("user_id").count())
    assert len({f.rsplit("_", 1)[1] for f in again.inputFiles()}) <= 4


def test_later_rows_change_no_feature(spark, built):
    x, tables = built
    cut = spark_queries.TestTables(spark, SF)
    cut.actions = X.action(spark, SF).where(F.col("action_time") <= F.lit(x.spec.end))
    cut.comments = X.comment(spark, SF).where(F.col("dt") <= F.lit(x.spec.end))
    y = families.Inputs(cut, spark_queries.SPEC, X.USER_VOCABULARY)
    for name in ("u", "c", "s", "uc"):
        again = families.family(y, name)
        assert tables[name].exceptAll(again).count() == 0 and again.exceptAll(tables[name]).count() == 0


def skewed(spark, n=30_000):
    """A third of all rows by one user on one product, another third on one shop of one category."""
    base = spark.range(n).withColumn("h", F.xxhash64("id"))
    hot = F.col("id") % 3
    actions = base.select(
        F.when(hot == 0, 1).otherwise(F.pmod("h", F.lit(500))).cast("long").alias("user_id"),
        F.when(hot == 0, 1).when(hot == 1, F.pmod("h", F.lit(40)) * 10).otherwise(F.pmod("h", F.lit(400)))
        .cast("long").alias("sku_id"),
        F.date_sub(F.lit(dt.date(2018, 3, 25)), F.pmod(F.shiftrightunsigned("h", 8), F.lit(20)).cast("int"))
        .alias("action_time"),
        (F.pmod(F.shiftrightunsigned("h", 16), F.lit(5)) + 1).cast("int").alias("type"),
    )
    products = spark.range(400).select(
        F.col("id").alias("sku_id"), (F.col("id") % 7).cast("int").alias("brand"),
        (F.col("id") % 10).alias("shop_id"), (F.col("id") % 6).cast("int").alias("cate"),
    )
    return actions, products


def test_skewed_log_by_brute_force(spark):
    """Counts, distinct days and ranks of a skewed log, recomputed in pandas."""
    actions, products = skewed(spark)
    spec = WindowSpec(dt.date(2018, 3, 25))
    x = families.Inputs(Tables(actions, None, None, products, None), spec, {})
    pdf = action_log(actions, products).toPandas()
    pdf["action_time"] = pdf["action_time"].astype(str)
    keys = ["user_id", "cate", "shop_id"]
    got = families.family(x, "ucs").toPandas().set_index(keys).sort_index()
    cand = pdf[pdf.action_time >= str(spec.start)]
    assert len(got) == len(cand.groupby(keys))
    week = pdf[(pdf.action_time >= str(spec.recent(7)))]
    counts = week[week.type <= 4].groupby(keys).size().reindex(got.index, fill_value=0)
    assert (counts == got.ucs_b_count_in_7).all()
    days = cand.groupby(keys).action_time.nunique().reindex(got.index)
    assert (days == got.ucs_active_days).all()
    members = week.groupby(keys).size().index
    rank = counts[counts.index.isin(members)].groupby("user_id").rank(ascending=False, method="dense")
    assert (rank.reindex(got.index).fillna(1000).astype(int) == got.ucs_b_count_rank_in_7_in_u).all()
    uc = families.family(x, "uc").toPandas().set_index(["user_id", "cate"]).sort_index()
    distinct = pdf.drop_duplicates()
    orders = distinct[distinct.type == 2].groupby(["user_id", "cate"]).size().reindex(uc.index, fill_value=0)
    known = distinct[distinct.type <= 4].groupby(["user_id", "cate"]).size().reindex(uc.index, fill_value=0)
    assert ((orders / known.clip(lower=1)) - uc.uc_b2_rate).abs().max() < 1e-12


def test_the_cube_adds_up_to_the_log(spark):
    """Measures and distinct days of a skewed log from its cube, against plain aggregates over the log."""
    actions, products = skewed(spark)
    log = counted_log(actions, products)
    spec = WindowSpec(dt.date(2018, 3, 20), history_start=dt.date(2018, 3, 8))
    found = cube.daily_cube(log)
    assert found.where("by_product = 0").agg(F.sum("n")).first()[0] == 30_000 == found.where("by_product = 1").agg(F.sum("n")).first()[0]
    assert found.where("by_product = 0 AND user_id = 1 AND cate = 1 AND shop_id = 1").count() <= 20  # of 10,000 actions
    rows = log.where(F.col("action_time").between(spec.history_start, spec.end))
    plain = rows.groupBy(*families.UCS).agg(
        F.expr("sum(if(type = 2 AND action_time > DATE'2018-03-13', n, 0L)) AS n2_7"),
        F.expr("count_if(type = 4) AS d4_hist"), F.expr("max(if(type = 2, action_time, NULL)) AS order_last"),
        F.expr("count(DISTINCT action_time) AS hist_days"),
        F.expr("count(DISTINCT if(type = 2, action_time, NULL)) AS order_days"),
    )
    made = measures.measure_triples(found, spec).select(plain.columns)
    assert made.exceptAll(plain).count() == 0 and plain.exceptAll(made).count() == 0
    words = measures.day_words(found, families.UC)
    for keys, table in ((families.UC, words), (["user_id"], measures.roll_words(words, ["user_id"]))):
        plain = rows.groupBy(*keys).agg(
            F.expr("count(DISTINCT if(type = 2, action_time, NULL)) AS order_days"),
            F.expr("count(DISTINCT action_time) AS hist_days"),
        )
        made = measures.count_days(table, spec, keys).where("hist_days > 0")  # other days of a word may be all it has
        assert made.exceptAll(plain).count() == 0 and plain.exceptAll(made).count() == 0


def test_day_words_are_cut_at_any_day(spark):
    first = dt.date(1969, 10, 1)  # words before 1970 have negative numbers
    days = [(1, 2, 3, first + dt.timedelta(days=i), 0, 1) for i in range(0, 400, 3)]
    table = spark.createDataFrame(days, "user_id int, cate int, shop_id int, action_time date, by_product int, n2 long")
    words = measures.day_words(table, families.UC)
    assert words.count() == 7  # 400 days touch seven words of 64
    for low, high in ((None, 70), (5, 64), (63, 127), (92, 93), (91, 92), (0, 399), (300, 200)):
        start = None if low is None else first + dt.timedelta(days=low)
        spec = WindowSpec(first + dt.timedelta(days=high), history_start=start)
        expected = sum((low or 0) <= i <= high for i in range(0, 400, 3))
        got = measures.count_days(words, spec, families.UC).collect()
        assert sum(r.order_days for r in got) == sum(r.hist_days for r in got) == expected


def test_single_days_of_a_cube_are_replaced(spark):
    actions, products = skewed(spark, 3000)
    log = counted_log(actions, products).withColumn("n", F.col("n"))
    folder, gone, new = new_folder(spark, "cubes"), dt.date(2018, 3, 10), dt.date(2018, 3, 26)
    cube.kept_cube(spark, folder, log, "first")

    def files():
        return {str(p) for p in Path(folder, "cube").rglob("part-*")}

    old = files()
    later = log.where(F.col("action_time") != F.lit(gone)).unionByName(
        log.where("action_time = DATE'2018-03-11'").withColumn("action_time", F.lit(new))
    )
    kept = cube.kept_cube(spark, folder, later, "second", [gone, new])
    whole = cube.daily_cube(later)
    assert kept.select(whole.columns).exceptAll(whole).count() == 0 and whole.exceptAll(kept.select(whole.columns)).count() == 0
    lost = old - files()
    assert lost and all(str(gone) in f for f in lost)  # only that day's files went, and only the new day's came
    assert files() - old and all(str(new) in f for f in files() - old)
    assert cube.kept_cube(spark, folder, later.limit(0), "second").count() == kept.count()  # read, not built
    for marker in Path(folder, "cube-state").iterdir():  # as a job killed on the way leaves it
        marker.rmdir()
    assert cube.kept_cube(spark, folder, log, "third", [new]).count() == cube.daily_cube(log).count()  # built in full


def test_the_job_scans_the_log_once(spark):
    raw, scanned = X.raw_tables(spark, SF), spark.sparkContext.accumulator(0)
    path = new_folder(spark, "actions")
    raw.actions.write.parquet(path)
    n = raw.actions.count()

    def seen(user_id):
        scanned.add(1)
        return user_id

    count = F.udf(seen, "long").asNondeterministic()
    stored = spark.read.parquet(path)
    actions = stored.withColumn("user_id", count("user_id")).select(stored.columns)
    ends = {"1": dt.date(2024, 1, 9), "2": dt.date(2024, 1, 16), "a": dt.date(2024, 1, 23), "test": dt.date(2024, 1, 30)}
    plan_ = Plan(ends=ends, user_bounds=X.USER_REG_BOUNDS, shop_bounds=X.SHOP_REG_BOUNDS, market_bounds=X.MARKET_BOUNDS)
    run = Run(spark, replace(raw, actions=actions), new_folder(spark, "job"), plan_)
    for name in ("1", "2", "a", "test", "a_test"):
        assert run.assembled(name).count() > 0
    assert scanned.value == n
    one = spark_queries.training_set(spark, SF, WindowSpec(ends["1"]))
    assert run.assembled("1").select(one.columns).exceptAll(one).count() == 0


def test_both_rank_paths_agree(spark):
    actions, products = skewed(spark)
    counts = action_log(actions, products).groupBy("user_id", "cate", "shop_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("type") == 2).alias("orders")
    )
    nowhere = counts.limit(30).withColumn("user_id", F.lit(None).cast("long"))
    counts_ = counts.unionByName(nowhere)  # null parents: no path ranks them
    counts = materialize(spark, new_folder(spark, "counts"), lambda: counts_)
    wanted = {"by_rows": "n", "by_orders": "if(orders > 0, orders, NULL)"}
    windowed = ranks.dense_rank_in_parent(counts, ["user_id"], wanted, group_rows=10)
    joined = ranks.dense_rank_in_parent(counts, ["user_id"], wanted, group_rows=ranks.MAX_GROUP_ROWS + 1)
    unbounded = ranks.dense_rank_in_parent(counts, ["user_id"], wanted)
    assert windowed.count() == joined.count() == unbounded.count()
    joined = joined.select(windowed.columns)
    assert windowed.exceptAll(joined).count() == 0
    assert windowed.exceptAll(unbounded.select(windowed.columns)).count() == 0
    assert {r.by_rows for r in windowed.where("user_id IS NULL").collect()} == {ranks.ABSENT_RANK}
    for table in (windowed, unbounded):  # beyond the bound, narrow rows of parent and counts are ranked, and one join follows
        text = plan(table)
        assert text.count("Join") == 1
        assert not [line for line in text.split("\n") if "Sort [" in line and (" n#" in line or " orders#" in line)]


def test_a_parent_of_a_million_keys(spark):
    keys = spark.range(1_000_000).selectExpr("7L AS user_id", "id AS cate", "id DIV 3 AS n", "if(id % 2 = 0, id DIV 5, NULL) AS m")
    ranked = ranks.dense_rank_in_parent(keys, ["user_id"], {"by_n": "n", "by_m": "m"})
    wrong = ranked.where("by_n != 333334 - n OR by_m != if(m IS NULL, 1000, 200000 - m)")
    assert ranked.count() == 1_000_000 and wrong.count() == 0


def test_large_lookups_are_not_broadcast(spark):
    actions, products = skewed(spark, 3000)
    small = action_log(actions, products)
    lookup = products.select("sku_id", "cate", "shop_id")
    assert joins.broadcast_if_small(lookup, 100) is lookup
    assert joins.broadcast_if_small(lookup, 10**6) is not lookup
    plain = actions.join(joins.broadcast_if_small(lookup, 100), "sku_id")
    assert small.exceptAll(plain.select(small.columns)).count() == 0


def test_hot_products_are_split_when_the_catalogue_is_not_broadcast(spark):
    actions, products = skewed(spark, 60_000)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        lookup = joins.broadcast_if_small(products.select("sku_id", "cate", "shop_id"), 100)
        rows = actions.repartition(16).join(lookup, "sku_id")
        assert len(rows.collect()) == 60_000
        assert "SortMergeJoin(skew=true)" in plan(rows)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    # the fixture reads days from a timestamp; the range still arrives at the parquet reader
    text = plan(spark_queries.flt_candidate_window(spark, SF))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text
    assert "value" not in text.split("ReadSchema")[1]


def test_the_log_is_combined_before_its_shuffle(spark):
    log = counted_log(X.action(spark, SF), X.product(spark, SF))
    text = plan(log)
    assert text.count("partial_count") == 1
    assert "BroadcastHashJoin" in text


def test_a_block_reads_only_its_measures(spark):
    x = spark_queries.inputs(spark, SF)
    text = families.block(x, "ucs", "active_days")._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("bit_or(") == 1 and "count_if" not in text and "Window" not in text


def test_families_read_the_cube_and_not_the_log(spark):
    x = spark_queries.inputs(spark, SF)
    for name in families.KEYS:
        text = plan(families.family(x, name))
        assert "action_time" in text and text.count("ReadSchema: struct<ts") == (name in ("c", "s"))  # the comment table


def test_no_python_in_any_plan(spark):
    x = spark_queries.inputs(spark, SF)
    for name in families.KEYS:
        assert "Python" not in plan(families.family(x, name))


def same_rows(one, other):
    return one.columns == other.columns and one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


@pytest.mark.parametrize("family", ["u", "ucs", "uc", "us"])
def test_a_large_catalogue_does_not_hide_that_users_have_few_rows(spark, monkeypatch, family):
    """Tables are clustered by user if no user has many rows, in as many tasks as the rows need, and else by their own keys."""
    monkeypatch.setattr(families, "TASK_ROWS", 100)
    x = spark_queries.inputs(spark, SF)
    x.pairs = 10**9
    rows = x.cube.where("by_product = 0").count()
    assert x.by_user == x.tasks == -(-rows // 100) > spark.sparkContext.defaultParallelism
    clustered = families.family(x, family)
    assert f"hashpartitioning(user_id#{{}}L, {x.tasks}), REPARTITION_BY_NUM" in re.sub(r"#\d+L", "#{}L", plan(clustered))
    monkeypatch.setattr(families, "MAX_USER_ROWS", 1)
    y = spark_queries.inputs(spark, SF)
    assert y.by_user is None and y.rows_per_user <= y.pairs
    assert same_rows(clustered, families.family(y, family))


def test_windows_of_one_job_share_their_tables_and_cube(spark):
    specs = X.WINDOWS["w2"], X.WINDOWS["w3"]
    shared = spark_queries.Windows(spark, SF, *specs)
    first, second = (shared.inputs(spec) for spec in specs)
    assert first.cube is second.cube and first.tables is second.tables
    assert first.by_user == second.by_user is not None
    for table in (shared.tables.products, shared.tables.shops, shared.tables.users):  # written, not summed up again by each reader
        assert not any("lineitem" in f or "orders" in f for f in table.inputFiles())
    alone = spark_queries.Windows(spark, SF, specs[0]).inputs(specs[0])
    for name in ("u", "s", "us"):
        assert same_rows(families.family(first, name), families.family(alone, name))


def test_a_foreign_session_gets_the_plan_settings(spark):
    for build in (spark_queries.inputs, spark_queries.order_inputs, lambda *at: spark_queries.Windows(*at, spark_queries.SPEC)):
        for key in PLAN_CONF:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.codegen.maxFields", "100")
        build(spark, SF)
        assert all(spark.conf.get(key) == value for key, value in PLAN_CONF.items())
