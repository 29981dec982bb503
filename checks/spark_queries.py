"""The registered queries: every operator and block over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.functions import scalars as S
from cartwise.operators import clean, ranks
from cartwise.operators.cube import daily_cube
from cartwise.operators.log import action_log, candidate_rows, counted_log
from cartwise.operators.joins import left_lookup
from cartwise.plans import dataset, evaluate, families, labels, model, trees, vote
from cartwise.session import new_folder, set_plan_conf
from cartwise.sources import fixtures as X
from cartwise.sources import schemas, tables

UCS = families.UCS
SPEC = X.WINDOWS["w3"]

Query = Callable[[SparkSession, str], DataFrame]


class TestTables:
    """The five cleaned tables, each built on first use.

    ``keep`` may write what several steps read: users, shops and products are aggregates over all orders and order lines.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, keep=families._as_is):
        self._at, self._keep = (spark, sf_dir), keep

    @cached_property
    def actions(self) -> DataFrame:
        return X.action(*self._at)

    @cached_property
    def users(self) -> DataFrame:
        return clean.clean_users(self._keep("users_raw", X.user(*self._at)), X.USER_REG_BOUNDS)

    @cached_property
    def shops(self) -> DataFrame:
        return self._keep("shops", clean.clean_shops(self._keep("shops_raw", X.shop(*self._at)), X.SHOP_REG_BOUNDS))

    @cached_property
    def products(self) -> DataFrame:
        return self._keep("products", clean.clean_products(self._keep("products_raw", X.product(*self._at)), X.MARKET_BOUNDS))

    @cached_property
    def comments(self) -> DataFrame:
        return X.comment(*self._at)


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return action_log(X.action(spark, sf_dir), X.product(spark, sf_dir))


def merged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counted_log(X.action(spark, sf_dir), X.product(spark, sf_dir))


def inputs(spark: SparkSession, sf_dir: str, spec=SPEC, cart: bool = False, keep=families._as_is):
    set_plan_conf(spark)
    return families.Inputs(TestTables(spark, sf_dir, keep), spec, X.USER_VOCABULARY, cart, keep)


class OrderTables(TestTables):
    """The larger log; its pairs of category and shop are those that occur in it."""

    @cached_property
    def actions(self) -> DataFrame:
        return X.order_rows(*self._at)

    @cached_property
    def products(self) -> DataFrame:
        return self.actions.select("sku_id", "cate", "shop_id").distinct()


def order_inputs(spark: SparkSession, sf_dir: str):
    set_plan_conf(spark)
    tables_ = OrderTables(spark, sf_dir)
    merged = tables_.actions.groupBy(*tables_.actions.columns).agg(F.count("*").alias("n"))
    return families.Inputs(tables_, X.ORDER_LOG_WINDOW, X.USER_VOCABULARY, log=merged)


def writer(spark: SparkSession):
    """A ``keep`` that writes each table below a new folder and reads it back."""
    folder = new_folder(spark, "tables")

    def keep(name: str, df: DataFrame, by_user: int | None = None) -> DataFrame:
        if by_user is None:
            return tables.materialize(spark, f"{folder}/{name}", lambda: df)
        return tables.materialize_bucketed(spark, f"{folder}/{name}", lambda: df, "user_id", by_user)

    return keep


class Windows:
    """What the sets of several windows share: the kept tables, one cube up to the last label day, day words and users."""

    def __init__(self, spark: SparkSession, sf_dir: str, *specs):
        set_plan_conf(spark)
        self._keep = writer(spark)
        self.tables, self.last = TestTables(spark, sf_dir, self._keep), max(s.label_end for s in specs)

    @cached_property
    def cube(self) -> DataFrame:
        rows = counted_log(self.tables.actions, self.tables.products)
        return self._keep("cube", daily_cube(rows.where(F.col("action_time") <= F.lit(self.last))))

    def inputs(self, spec, cart: bool = False):
        def keep(name: str, df: DataFrame, by_user: int | None = None) -> DataFrame:
            shared = name.startswith(("days_", "users_"))  # the same for every window
            return self._keep(name if shared else f"end={spec.end}/{name}", df, by_user)

        return families.Inputs(self.tables, spec, X.USER_VOCABULARY, cart, keep, cube=self.cube)


# ---- sources and cleaning --------------------------------------------------------------------------


def src_csv_roundtrip(spark, sf_dir):
    """Written with its columns in another order; they are found by name."""
    path = new_folder(spark, "action_csv")
    tables.write_csv(X.action(spark, sf_dir).select("type", "sku_id", "action_time", "user_id"), path)
    return tables.read_csv(spark, path, schemas.ACTION)


def src_materialize_reuse(spark, sf_dir):
    path = new_folder(spark, "test_set")
    first = tables.materialize(spark, path, lambda: labels.scoring_candidates(log(spark, sf_dir), X.WINDOWS["test"]))
    again = tables.materialize(spark, path, lambda: first.limit(0))
    return again


def clean_day_truncate(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate")
    return clean.truncate_to_day(orders, "o_orderdate")


def clean_impute_mode(spark, sf_dir):
    users = X.user(spark, sf_dir)
    columns = ["user_reg_tm", "sex", "city_level", "province"]
    return clean.impute(users, mode=columns).select("user_id", *columns)


def clean_impute_median(spark, sf_dir):
    users = X.user(spark, sf_dir).withColumn("age", F.col("age").cast("double"))
    return clean.impute(users, median=["age"]).select("user_id", "age")


def clean_bucket_user_reg(spark, sf_dir):
    return clean.clean_users(X.user(spark, sf_dir), X.USER_REG_BOUNDS).select("user_id", "user_reg_tm", "user_reg_time")


def clean_bucket_shop_reg(spark, sf_dir):
    return clean.clean_shops(X.shop(spark, sf_dir), X.SHOP_REG_BOUNDS).select("shop_id", "shop_reg_tm", "shop_reg_time")


def clean_bucket_market(spark, sf_dir):
    return clean.clean_products(X.product(spark, sf_dir), X.MARKET_BOUNDS).select("sku_id", "market_time", "market_tm")


def clean_null_profile(spark, sf_dir):
    return clean.null_profile(X.user(spark, sf_dir))


# ---- primitives ------------------------------------------------------------------------------------


def flt_candidate_window(spark, sf_dir):
    return candidate_rows(X.action(spark, sf_dir), SPEC)


def join_action_product(spark, sf_dir):
    return log(spark, sf_dir).select("user_id", "sku_id", "action_time", "type", "cate", "shop_id")


def join_left_fill_default(spark, sf_dir):
    users = X.action(spark, sf_dir).select("user_id").distinct()
    orders = (
        X.action(spark, sf_dir).where(F.col("type") == schemas.ORDER)
        .groupBy("user_id").agg(F.count("*").alias("orders"), F.max("action_time").alias("last_order"))
        .selectExpr("user_id", "orders", f"{S.days_until(SPEC.label_start, 'last_order')} AS days_ago")
    )
    return left_lookup(users, orders, ["user_id"], {"orders": 0, "days_ago": 75})


def agg_group_count(spark, sf_dir):
    return log(spark, sf_dir).groupBy("cate", "shop_id").agg(F.count("*").alias("rows"))


def agg_group_sum(spark, sf_dir):
    return X.comment(spark, sf_dir).groupBy("sku_id").agg(
        *[F.sum(c).alias(c) for c in ("comments", "good_comments", "bad_comments")]
    )


def agg_windowed_counts(spark, sf_dir):
    x = inputs(spark, sf_dir)
    columns = [f"n{c}_{n}" for n in (1, 3, 5, 7, 10) for c in (1, 2, 3, 4)]
    return x.ucs.select(*UCS, *columns)


def agg_distinct_counts(spark, sf_dir):
    return log(spark, sf_dir).groupBy("user_id").agg(
        F.count_distinct("cate").alias("cates"), F.count_distinct("shop_id").alias("shops"),
        F.count_distinct("action_time").alias("days"),
    )


def agg_distinct_keys(spark, sf_dir):
    return log(spark, sf_dir).select("user_id", "cate").distinct()


def agg_log_dedup(spark, sf_dir):
    return merged_log(spark, sf_dir).select("user_id", "sku_id", "action_time", "type", "cate", "shop_id", "n")


def win_dense_rank_in_parent(spark, sf_dir):
    rows = log(spark, sf_dir).groupBy("shop_id", "cate").agg(F.count("*").alias("rows"))
    return ranks.dense_rank_in_parent(rows, ["shop_id"], {"rank": "rows"})


def win_order_gap_lag(spark, sf_dir):
    orders = merged_log(spark, sf_dir).where(F.col("type") == schemas.ORDER)
    gaps = ranks.order_gaps(orders, ["user_id"])
    return gaps.groupBy("user_id").agg(F.sum("gap").alias("gap_days"), (F.sum("n") - 1).alias("gaps")).where(
        F.col("gap_days").isNotNull()
    )


def win_latest_per_key(spark, sf_dir):
    orders = log(spark, sf_dir).where(F.col("type") == schemas.ORDER)
    return ranks.latest_per_key(orders, ["user_id", "cate"], "action_time", "sku_id")


def sc_log_ratio(spark, sf_dir):
    return _user_type_counts(spark, sf_dir).selectExpr("user_id", f"{S.log_ratio('b2', 'b1')} AS log_ratio")


def sc_safe_rate(spark, sf_dir):
    return _user_type_counts(spark, sf_dir).selectExpr("user_id", f"{S.safe_rate('b2', 'b1 + b2')} AS rate")


def sc_day_diff(spark, sf_dir):
    return X.action(spark, sf_dir).selectExpr(
        "user_id", "sku_id", "action_time", f"{S.days_until(SPEC.label_start, 'action_time')} AS days"
    )


def pivot_action_type(spark, sf_dir):
    return _user_type_counts(spark, sf_dir)


def _user_type_counts(spark, sf_dir):
    return X.action(spark, sf_dir).groupBy("user_id").agg(
        *[F.expr(f"count_if(type = {c}) AS b{c}") for c in (1, 2, 3, 4, 5)]
    )


# ---- labels ----------------------------------------------------------------------------------------


def label_train_set(spark, sf_dir):
    return labels.train_labels(log(spark, sf_dir), SPEC)


def label_test_set(spark, sf_dir):
    return labels.scoring_candidates(log(spark, sf_dir), X.WINDOWS["test"])


def label_all_windows(spark, sf_dir):
    training = {k: v for k, v in X.WINDOWS.items() if k != "test"}
    return labels.all_windows(log(spark, sf_dir), training, {"test": X.WINDOWS["test"]})


# ---- blocks, families and data sets ----------------------------------------------------------------


def feature_block(spark, sf_dir, family: str, name: str, cart: bool = False):
    return families.block(inputs(spark, sf_dir, cart=cart), family, name)


def feature_family(spark, sf_dir, name: str, cart: bool = False):
    return families.family(inputs(spark, sf_dir, cart=cart), name)


def order_log_labels(spark, sf_dir):
    return labels.train_labels(X.order_rows(spark, sf_dir), X.ORDER_LOG_WINDOW)


def order_log_family(spark, sf_dir, name: str):
    return families.family(order_inputs(spark, sf_dir), name)


def feat_u_reg_recency(spark, sf_dir):
    # The test tables register users in 1995 to 2000, so the window ends there.
    spec = X.REGISTRATION_WINDOW
    x = inputs(spark, sf_dir, spec=spec, cart=True)
    return families.user_profile(x).select("user_id", "reg_tm_last_day", "reg_tm_7_day")


def _families(spark, sf_dir, spec, cart=False, shared=None):
    x = (shared or Windows(spark, sf_dir, spec)).inputs(spec, cart)
    return x, families.all_families(x)


def training_set(spark, sf_dir, spec=SPEC, cart=False, shared=None):
    x, built = _families(spark, sf_dir, spec, cart, shared)
    rows = x.keep("candidates", labels.train_labels(x.triples, spec), x.by_user)
    return dataset.assemble(rows, built, x.rows_per_user, x.by_user)


def scoring_set(spark, sf_dir, spec=X.WINDOWS["test"], cart=False, shared=None):
    x, built = _families(spark, sf_dir, spec, cart, shared)
    rows = x.keep("candidates", labels.scoring_candidates(x.triples, spec), x.by_user)
    return dataset.assemble(rows, built, x.rows_per_user, x.by_user)


def feat_window_diffs(spark, sf_dir):
    wide = dataset.with_differences(training_set(spark, sf_dir))
    spark.conf.set("spark.sql.optimizer.nestedSchemaPruning.enabled", "true")  # few columns of each family are used
    return wide.select(*UCS, *[f"{n}_{a}_{b}_diff" for n, a, b in dataset.DIFFERENCES])


def ds_feature_select(spark, sf_dir):
    return dataset.drop_weak(dataset.with_differences(training_set(spark, sf_dir)))


def ds_union_windows(spark, sf_dir):
    specs = X.WINDOWS["w2"], X.WINDOWS["w3"]
    shared = Windows(spark, sf_dir, *specs)
    return dataset.union_windows(*[training_set(spark, sf_dir, spec, shared=shared) for spec in specs])


# ---- votes and scores ------------------------------------------------------------------------------


def score_sets(spark, sf_dir, spec=SPEC) -> dict[str, DataFrame]:
    """Five deterministic score columns in place of five models."""
    x = inputs(spark, sf_dir, spec=spec)
    counts = families.family(x, "ucs")
    probs = {
        "1": "ucs_b2_count_in_7 / (1 + ucs_b_count_in_7)",
        "2": "ucs_b1_count_in_10 / (4 + ucs_b_count_in_10 * 2)",
        "3": "(ucs_b1_count_in_3 + ucs_b2_count_in_3) / (1 + ucs_b_count_in_10)",
        "a": "ucs_active_days / 20",
        "23": "ucs_b_count_in_5 / (10 + ucs_b_count_in_10)",
    }
    kept = counts.selectExpr(*UCS, *[f"{p} AS prob_{m}" for m, p in probs.items()])
    kept = writer(spark)("scores", kept)
    return {m: kept.selectExpr(*UCS, f"prob_{m} AS prob") for m in probs}


def vote_threshold(spark, sf_dir):
    scores = score_sets(spark, sf_dir)
    return vote.threshold(scores["1"], vote.THRESHOLDS["1"])


def vote_majority(spark, sf_dir):
    return vote.majority(score_sets(spark, sf_dir))


def eval_two_level(spark, sf_dir):
    truth = labels.bought_triples(log(spark, sf_dir), SPEC)
    return evaluate.two_level(vote.majority(score_sets(spark, sf_dir)), truth)


SWEEP = [i / 50 for i in range(1, 26)]


def eval_threshold_sweep(spark, sf_dir):
    return evaluate.threshold_sweep(_labelled_scores(spark, sf_dir), SWEEP)


def _labelled_scores(spark, sf_dir):
    scored = score_sets(spark, sf_dir)["3"]
    return scored.join(labels.train_labels(log(spark, sf_dir), SPEC), list(UCS))


def _steady(labelled):
    """Scores as text of nine digits and back, so that equal ones are equal in both engines."""
    return labelled.withColumn("prob", F.round("prob", 9))


def eval_exact_curve(spark, sf_dir):
    return evaluate.exact_curve(_steady(_labelled_scores(spark, sf_dir)))


def eval_best_submission(spark, sf_dir):
    return evaluate.best_submission(_steady(_labelled_scores(spark, sf_dir)))


def clean_impute_many_values(spark, sf_dir):
    """Prices of orders, nearly all distinct, with some made null and filled by mode and by median."""
    prices = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey", "if(o_orderkey % 7 = 0, NULL, o_totalprice) AS by_median", "if(o_orderkey % 7 = 0, NULL, o_totalprice) AS by_mode",
    )
    return clean.impute(prices, mode=["by_mode"], median=["by_median"], many_values=True)


# ---- models ----------------------------------------------------------------------------------------

def _model_input(spark, sf_dir, spec, labelled: bool, shared: Windows | None = None) -> DataFrame:
    build = training_set if labelled else scoring_set
    ready = dataset.drop_weak(dataset.with_differences(build(spark, sf_dir, spec, shared=shared)))
    return writer(spark)("model_input", ready)


PROBABILITY = "prob BETWEEN 0 AND 1"
#: Area under the curve on the training rows, fixed beforehand: a constant, or a model of shuffled labels, has about a half.
LEAST_AUC = 0.75


def _learned(fitted, rows) -> "F.Column":
    return F.lit(model.auc(fitted, rows) >= LEAST_AUC).alias("learned")


def model_train(spark, sf_dir):
    """Triples of the window after the training window by true label, whether all were scored, and whether the model learned."""
    trained_on = _model_input(spark, sf_dir, X.WINDOWS["w2"], True)
    fitted = model.train(trained_on)
    held_out = _model_input(spark, sf_dir, X.WINDOWS["w3"], True)
    scored = model.score(fitted, held_out).join(held_out.select(*UCS, "label"), list(UCS))
    return scored.groupBy("label").agg(F.count("*").alias("triples"), F.expr(f"bool_and({PROBABILITY})").alias("scored")).withColumn(
        "learned", _learned(fitted, trained_on)
    )


def model_score(spark, sf_dir):
    """Whether each triple's score is what the persisted tree nodes give, and whether scores differ and are those of a model that learned."""
    shared = Windows(spark, sf_dir, SPEC, X.WINDOWS["test"])
    trained_on = _model_input(spark, sf_dir, SPEC, True, shared)
    fitted, rows = model.train(trained_on), _model_input(spark, sf_dir, X.WINDOWS["test"], False, shared)
    by_nodes = trees.probabilities(model.nodes(fitted), rows, model.model_features(fitted))
    scored = writer(spark)("scored", model.score(fitted, by_nodes, "node_prob"))  # one pass over the wide rows
    differ = F.lit(scored.select("prob").distinct().count() > 1).alias("differ")
    return scored.select(*UCS, "prob").join(scored.select(*UCS, "node_prob"), list(UCS)).select(
        *UCS, F.expr(f"{PROBABILITY} AND abs(prob - node_prob) < 1e-9").alias("scored"), differ, _learned(fitted, trained_on)
    )


def model_reload(spark, sf_dir):
    """Whether a saved and loaded model gives each triple the same score."""
    shared = Windows(spark, sf_dir, SPEC, X.WINDOWS["test"])
    fitted = model.train(_model_input(spark, sf_dir, SPEC, True, shared))
    rows = _model_input(spark, sf_dir, X.WINDOWS["test"], False, shared)
    path = new_folder(spark, "model")
    model.save(fitted, path)
    again = model.score(model.load(path), rows).withColumnRenamed("prob", "again")
    return model.score(fitted, rows).join(again, list(UCS)).selectExpr(*UCS, "prob = again AS same")


def model_importance(spark, sf_dir):
    """Whether the shares of the best features are at most 20, in order and of all splits, and the model learned."""
    trained_on = _model_input(spark, sf_dir, SPEC, True)
    fitted = model.train(trained_on)
    best, ensemble = model.top_features(fitted), fitted.stages[1]
    splits = (ensemble.totalNumNodes - ensemble.getNumTrees) // 2  # every split has two children
    counted = F.sum(F.col("fscore") * splits)
    order = F.sort_array(F.collect_list("fscore"), asc=False)
    return best.agg(
        (F.count("*") <= 20).alias("few"), (F.collect_list("fscore") == order).alias("in_order"),
        F.expr("bool_and(fscore > 0 AND fscore <= 1)").alias("shares"),
        # Shares of split counts are whole numbers of splits.
        ((F.abs(counted - F.round(counted)) < 1e-6) & (counted >= 1) & (counted <= splits + 1e-6)).alias("whole"),
        _learned(fitted, trained_on),
    )


def model_gain_shares(spark, sf_dir):
    """The share and top-20 step of the importance, on sums of the order lines per part type."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey", "l_quantity")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type")
    gains = lines.join(parts, "l_partkey").groupBy(F.concat_ws(" ", "p_brand", "p_type").alias("feature")).agg(
        F.sum("l_quantity").alias("gain")
    )
    return model.top(model.shares(gains))


# ---- registry --------------------------------------------------------------------------------------

# Query key of each block -> (family, block).
BLOCK_KEYS = {
    f"feat_{fam}_{blk}": (fam, blk)
    for fam, blks in {
        "u": ("onehot", "order_rhythm", "activity"),
        "ucs": ("conversion", "counts", "type_counts", "browse_to_order", "last_browse", "active_days",
                "rank_in_user", "order_rhythm"),
        "c": ("conversion", "catalog_counts", "new_items", "user_counts", "type_counts", "counts", "orders",
              "comments"),
        "s": ("conversion", "catalog_counts", "new_items", "user_counts", "type_counts", "counts",
              "browse_to_order", "comments", "profile"),
        "uc": ("recency", "browse_to_order", "counts", "type_counts", "rank_in_user", "conversion", "active_days"),
        "us": ("recency", "browse_to_order", "counts", "type_counts", "rank_in_user", "conversion", "active_days"),
        "cs": ("row_rank", "item_count", "new_items", "orders", "action_rank", "order_rank", "conversion",
               "active_days", "major"),
    }.items()
    for blk in blks
}

# Blocks whose columns or rules change when the cart action is used.
CART_BLOCKS = (
    "feat_u_onehot", "feat_ucs_counts", "feat_ucs_type_counts", "feat_ucs_rank_in_user", "feat_c_type_counts",
    "feat_s_type_counts", "feat_uc_recency", "feat_uc_counts", "feat_uc_type_counts", "feat_uc_rank_in_user",
    "feat_us_recency", "feat_us_counts", "feat_us_type_counts", "feat_us_rank_in_user", "feat_cs_action_rank",
)

# Families that need no launch days, comments or shop table, which the order log has not.
ORDER_FAMILIES = ("u", "ucs", "uc", "us")

PLAIN = [
    src_csv_roundtrip, src_materialize_reuse, clean_day_truncate, clean_impute_mode, clean_impute_median,
    clean_bucket_user_reg, clean_bucket_shop_reg, clean_bucket_market, clean_null_profile,
    flt_candidate_window, join_action_product, join_left_fill_default, agg_group_count, agg_group_sum,
    agg_windowed_counts, agg_distinct_counts, agg_distinct_keys, agg_log_dedup, win_dense_rank_in_parent,
    win_order_gap_lag, win_latest_per_key, sc_log_ratio, sc_safe_rate, sc_day_diff, pivot_action_type,
    label_train_set, label_test_set, label_all_windows, feat_u_reg_recency, feat_window_diffs,
    ds_feature_select, ds_union_windows, vote_threshold, vote_majority, eval_two_level, eval_threshold_sweep,
    eval_exact_curve, eval_best_submission, clean_impute_many_values, order_log_labels, model_train, model_score, model_importance, model_gain_shares, model_reload,
]


def _rounded(query: Query) -> Query:
    return lambda spark, sf_dir: S.round_doubles(query(spark, sf_dir))


def registry() -> dict[str, Query]:
    found: dict[str, Query] = {q.__name__: q for q in PLAIN}
    for key, (fam, blk) in BLOCK_KEYS.items():
        found[key] = partial(feature_block, family=fam, name=blk)
        if key in CART_BLOCKS:
            found[f"{key}_cart"] = partial(feature_block, family=fam, name=blk, cart=True)
    for fam in families.KEYS:
        found[f"family_{fam}"] = partial(feature_family, name=fam)
        found[f"family_{fam}_cart"] = partial(feature_family, name=fam, cart=True)
    for fam in ORDER_FAMILIES:
        found[f"order_log_family_{fam}"] = partial(order_log_family, name=fam)
    found["ds_assemble"] = training_set
    found["ds_assemble_cart"] = partial(training_set, cart=True)
    found["ds_assemble_test"] = scoring_set
    found["ds_assemble_test_cart"] = partial(scoring_set, cart=True)
    return {key: _rounded(query) for key, query in found.items()}
