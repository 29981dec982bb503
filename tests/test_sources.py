import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwise.operators.clean import clean_tables, null_profile
from cartwise.operators.log import counted_log
from cartwise.session import new_folder, shared_dir
from cartwise.sources import schemas, tables


def test_shared_folder_comes_from_the_session(spark):
    assert new_folder(spark, "x").startswith(shared_dir(spark))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_csv_keeps_nulls_and_types(spark, make):
    path = new_folder(spark, "users")
    users = make("user", [(1, None, -1, dt.date(2018, 3, 1), 1, None, 2, 3), (2, 5, 0, None, None, 1, None, None)])
    tables.write_csv(users, path)
    again = tables.read_csv(spark, path, schemas.USER)
    assert set(again.collect()) == set(users.collect())


def _csv(spark, name, text):
    path = new_folder(spark, name)
    spark.createDataFrame([(line,) for line in text.split("\n")], "value string").coalesce(1).write.text(path)
    return path


def test_csv_columns_are_found_by_name(spark):
    path = _csv(spark, "shuffled", "sku_id,place,user_id,action_time,type\n7,a,1,2018-03-25,1\n7,b,1,2018-03-25,1\n7,b,1,2018-03-25,1")
    rows = tables.read_csv(spark, path, schemas.ACTION)
    assert rows.columns == [*schemas.ACTION.names, "place"]
    assert {(r.user_id, r.sku_id, r.type, r.place) for r in rows.collect()} == {(1, 7, 1, "a"), (1, 7, 1, "b")}
    products = spark.createDataFrame([(7, 1, 5, 9, None)], schemas.PRODUCT)
    # Actions that differ in an undeclared column are two actions.
    assert sorted(r.n for r in counted_log(rows, products).collect()) == [1, 2]
    with pytest.raises(ValueError, match="sku_id"):
        tables.read_csv(spark, _csv(spark, "lacking", "user_id,action_time,type\n1,2018-03-25,1"), schemas.ACTION)


def test_files_with_different_headers_fail(spark):
    path = _csv(spark, "mixed", "user_id,sku_id,action_time,type\n1,7,2018-03-25,1")
    spark.createDataFrame([("sku_id,user_id,action_time,type",), ("7,1,2018-03-25,1",)], "value string").coalesce(
        1
    ).write.mode("append").text(path)
    with pytest.raises(Exception):
        tables.read_csv(spark, path, schemas.ACTION).collect()


def test_materialize_builds_again_for_another_manifest(spark):
    path, calls = new_folder(spark, "manifest"), []

    def build(n):
        calls.append(n)
        return spark.range(n)

    for n, manifest in ((3, "a"), (4, "a"), (5, "b"), (6, "b")):
        table = tables.materialize(spark, path, lambda: build(n), manifest=manifest)
    assert calls == [3, 5] and table.count() == 5
    assert tables.materialize(spark, path, lambda: build(7), manifest="a").count() == 3  # still there


def test_a_killed_rebuild_mixes_no_plans(spark):
    path = new_folder(spark, "killed")
    tables.materialize(spark, path, lambda: spark.range(3), manifest="a")

    @F.udf("long")
    def fail(i):
        if i > 90:
            raise RuntimeError("killed")
        return i

    with pytest.raises(Exception, match="killed"):
        tables.materialize(spark, path, lambda: spark.range(0, 99, 1, 9).select(fail("id").alias("id")), manifest="b")
    assert not tables.has_table(spark, path, "b")
    assert tables.materialize(spark, path, lambda: spark.range(5), manifest="a").count() == 3
    assert tables.materialize(spark, path, lambda: spark.range(99), manifest="b").count() == 99


def test_other_code_makes_other_tables(spark, monkeypatch):
    here = tables.table_path("t", "a")
    assert here == tables.table_path("t", "a") != tables.table_path("t", "b")
    monkeypatch.setattr(tables, "code_version", lambda: "next")
    assert tables.table_path("t", "a") != here


def test_the_state_of_a_table_follows_its_files(spark):
    path = new_folder(spark, "state")
    spark.range(3).write.parquet(path)
    first = tables.state_of(spark.read.parquet(path))
    assert tables.state_of(spark.read.parquet(path)) == first
    spark.range(4).write.mode("append").parquet(path)
    assert tables.state_of(spark.read.parquet(path)) != first


def test_malformed_csv_fails(spark):
    path = new_folder(spark, "bad")
    spark.createDataFrame([("user_id,sku_id,action_time,type",), ("1,x,2018-03-01,1",)], "value string").coalesce(
        1
    ).write.text(path)
    with pytest.raises(Exception):
        tables.read_csv(spark, path, schemas.ACTION).collect()


def test_raw_files_with_times_are_cut_to_days(spark):
    folder = new_folder(spark, "raw")
    content = {
        "action": "user_id,sku_id,action_time,type\n1,1,2018-03-25 23:59:59,1",
        "user": "user_id,age,sex,user_reg_tm,city_level,province,city,county\n1,2,0,2017-01-01 10:00:00.0,1,1,1,1",
        "shop": "shop_id,cate,fans_num,vip_num,shop_score,shop_reg_tm\n1,7,1,1,9.5,",
        "product": "sku_id,brand,shop_id,cate,market_time\n1,1,1,7,2016-01-01 00:00:00.0",
        "comment": "dt,sku_id,comments,good_comments,bad_comments\n2018-03-25,1,1,1,0",
    }
    for name, text in content.items():
        lines = [(line,) for line in text.split("\n")]
        spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{folder}/{name}")
    cleaned = clean_tables(tables.read_tables(spark, folder))
    assert cleaned.actions.first().action_time == dt.date(2018, 3, 25)
    assert cleaned.users.first().user_reg_time == 2
    assert cleaned.products.first().market_tm == 3
    assert cleaned.shops.first().shop_reg_tm is None
    assert cleaned.comments.first().dt == dt.date(2018, 3, 25)


def test_materialize_computes_once_and_ignores_unfinished_tables(spark):
    path, calls = new_folder(spark, "once"), []

    def compute():
        calls.append(1)
        return spark.range(5)

    for _ in range(2):
        assert tables.materialize(spark, path, compute).count() == 5
    assert len(calls) == 1
    unfinished = new_folder(spark, "unfinished")
    spark.range(3).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(unfinished)
    assert tables.materialize(spark, unfinished, compute).count() == 5


def test_materialize_by_partition_prunes(spark):
    path = new_folder(spark, "parts")
    df = spark.range(10).withColumn("day", F.date_add(F.lit(dt.date(2018, 3, 1)), (F.col("id") % 3).cast("int")))
    log = tables.materialize(spark, path, lambda: df, partition_by="day")
    one = log.where("day = DATE'2018-03-02'")
    assert one.count() == 3
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (None, None)], "a int, b string")
    got = {r.column_name: (r.nulls, r.filled) for r in null_profile(df).collect()}
    assert got == {"a": (1, 2), "b": (2, 1)}
