"""The five input tables as expressions over the TPC-H-like test tables.

The mapping is the one in FIXTURES.md. ``checks/oracle.py`` states the same mapping in SQL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.operators.windows import WindowSpec
from cartwise.sources.tables import Tables

# Bucket boundaries inside the date range of the test tables.
USER_REG_BOUNDS = [dt.date(1995, 3, 9), dt.date(1995, 6, 21), dt.date(1995, 11, 26)]
SHOP_REG_BOUNDS = [
    dt.date(1995, 1, 3), dt.date(1995, 1, 5), dt.date(1995, 1, 6), dt.date(1995, 1, 8), dt.date(1995, 1, 15),
]
MARKET_BOUNDS = [
    dt.date(1995, 1, 15), dt.date(1995, 2, 1), dt.date(1995, 3, 1), dt.date(1995, 4, 1), dt.date(1995, 6, 1),
]

# One-hot vocabularies of the test tables.
USER_VOCABULARY = {
    "user_reg_time": [1, 2, 3, 4],
    "age": [-1, 0, 1, 2, 3, 4],
    "sex": [0, 1, -1],
    "city_level": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "province": list(range(25)),
}

WINDOWS = {
    "w1": WindowSpec(dt.date(2024, 1, 9)),
    "w2": WindowSpec(dt.date(2024, 1, 16)),
    "w3": WindowSpec(dt.date(2024, 1, 23)),
    "test": WindowSpec(dt.date(2024, 1, 30)),
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null_when(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def action(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    code = (
        F.when(kind == "view", 1).when(kind == "purchase", 2).when(kind == "signup", 3)
        .when(kind == "error", 4).when(kind == "click", 5)
    )
    return _read(spark, sf_dir, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").cast("long").alias("sku_id"),
        F.to_date("ts").alias("action_time"),
        code.alias("type"),
    )


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    launch = (
        _read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(
            F.to_date(F.min("l_shipdate")).alias("launch"),
            F.min(F.struct("l_orderkey", "l_linenumber", "l_suppkey"))["l_suppkey"].alias("shop_id"),
        )
    )
    return _read(spark, sf_dir, "part").join(launch, "p_partkey", "left").select(
        F.col("p_partkey").alias("sku_id"),
        F.col("p_brand").alias("brand"),
        "shop_id",
        F.col("p_type").alias("cate"),
        _null_when(F.col("p_partkey") % 23 == 0, F.col("launch")).alias("market_time"),
    )


def user(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_order = (
        _read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.to_date(F.min("o_orderdate")).alias("first_order"))
    )
    key = F.col("c_custkey")
    return _read(spark, sf_dir, "customer").join(first_order, "c_custkey", "left").select(
        key.alias("user_id"),
        _null_when(key % 17 == 0, F.floor(F.col("c_acctbal") / 2000).cast("int")).alias("age"),
        _null_when(key % 13 == 0, (key % 3 - 1).cast("int")).alias("sex"),
        F.col("c_mktsegment").alias("city_level"),
        _null_when(key % 11 == 0, F.col("c_nationkey")).alias("province"),
        _null_when(key % 19 == 0, F.col("first_order")).alias("user_reg_tm"),
    )


def shop(spark: SparkSession, sf_dir: str) -> DataFrame:
    opened = (
        _read(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.to_date(F.min("l_shipdate")).alias("opened"))
    )
    main_cate = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("s_suppkey"), "p_type")
    key = F.col("s_suppkey")
    return (
        _read(spark, sf_dir, "supplier")
        .join(opened, "s_suppkey", "left").join(main_cate, "s_suppkey", "left")
        .select(
            key.alias("shop_id"),
            _null_when(key % 10 == 9, F.col("p_type")).alias("cate"),
            F.col("s_nationkey").cast("long").alias("fans_num"),
            (F.col("s_nationkey") % 7).cast("long").alias("vip_num"),
            _null_when(key % 4 == 3, F.col("s_acctbal") / 1000).alias("shop_score"),
            _null_when(key % 10 == 6, F.col("opened")).alias("shop_reg_tm"),
        )
    )


def comment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _read(spark, sf_dir, "events")
        .select(
            F.to_date("ts").alias("dt"), F.get_json_object("props", "$.k").cast("long").alias("sku_id"), "value"
        )
        .groupBy("dt", "sku_id")
        .agg(
            F.count("*").alias("comments"),
            F.count_if(F.col("value") >= 50).alias("good_comments"),
            F.count_if(F.col("value") < 5).alias("bad_comments"),
        )
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        actions=action(spark, sf_dir), users=user(spark, sf_dir), shops=shop(spark, sf_dir),
        products=product(spark, sf_dir), comments=comment(spark, sf_dir),
    )

# A window that ends inside the range of the mapped registration days.
REGISTRATION_WINDOW = WindowSpec(dt.date(1995, 6, 21), history_start=dt.date(1995, 6, 8))

# The order log below spans six years; its window has a longer candidate range, so that keys repeat.
ORDER_LOG_WINDOW = WindowSpec(dt.date(2001, 6, 30), days=60)


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second, larger log: every order line is an action on its part, in the shop of its supplier."""
    code = "CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE if(l_linestatus = 'F', 3, 4) END AS type"
    lines = _read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"
    )
    orders = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderdate")
    parts = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return lines.join(orders, "l_orderkey").join(parts, "l_partkey").selectExpr(
        "o_custkey AS user_id", "l_partkey AS sku_id", "to_date(o_orderdate) AS action_time", code,
        "p_type AS cate", "l_suppkey AS shop_id",
    )
