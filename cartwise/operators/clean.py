"""Cleaning of the dimension tables: day truncation, imputation, date buckets, null profile."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.scalars import date_bucket
from cartwise.operators.running import exact_median, exact_mode
from cartwise.sources.tables import Tables

# Year boundaries of the published data: fixed values.
USER_REG_BOUNDS = [dt.date(2008, 1, 1), dt.date(2015, 1, 1), dt.date(2018, 1, 1)]
SHOP_REG_BOUNDS = [
    dt.date(2010, 1, 1), dt.date(2013, 1, 1), dt.date(2015, 1, 1), dt.date(2017, 1, 1), dt.date(2018, 1, 1),
]
MARKET_BOUNDS = [
    dt.date(2012, 1, 1), dt.date(2015, 1, 1), dt.date(2016, 1, 1), dt.date(2017, 1, 1), dt.date(2018, 1, 1),
]

USER_MODE_COLUMNS = ("sex", "city_level", "province", "city", "county")


def truncate_to_day(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.to_date(c) for c in columns})


def impute(
    df: DataFrame, mode: Sequence[str] = (), median: Sequence[str] = (), many_values: bool = False
) -> DataFrame:
    """Replace nulls by the column's mode (smallest on a tie) or median; the column keeps its type.

    The fill values are one scalar subquery: a single scan finds them all, and nothing runs before the result
    is asked for. Both aggregates keep one count per distinct value in one task, which suits the coded columns
    of a dimension table (days, codes, levels), whose values are few at any row count. ``many_values`` is for any other
    column: the counts per value stay distributed, and the values are found at once, by a job or two each.
    """
    types = dict(df.dtypes)
    if many_values:
        exact = {c: exact_mode(df, c) for c in mode} | {c: exact_median(df, c) for c in median}
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(types[c])) for c, v in exact.items()})
    found = [F.mode(c, True).alias(c) for c in mode] + [F.median(c).alias(c) for c in median]
    fills = df.agg(F.struct(*found).alias("fills")).scalar()
    return df.withColumns({
        c: F.coalesce(F.col(c), fills.getField(c).cast(types[c])) for c in (*mode, *median)
    })


def clean_users(users: DataFrame, bounds: Sequence[dt.date] = USER_REG_BOUNDS) -> DataFrame:
    """Registration day filled and bucketed, profile codes filled by mode, age by median."""
    users = truncate_to_day(users, "user_reg_tm")
    coded = [c for c in USER_MODE_COLUMNS if c in users.columns]
    users = users.withColumn("age", F.col("age").cast("double"))
    users = impute(users, mode=["user_reg_tm", *coded], median=["age"])
    return users.withColumn("user_reg_time", F.expr(date_bucket("user_reg_tm", bounds)))


def clean_shops(shops: DataFrame, bounds: Sequence[dt.date] = SHOP_REG_BOUNDS) -> DataFrame:
    """Opening day filled and bucketed; days before the first bound keep a null bucket."""
    shops = truncate_to_day(shops, "shop_reg_tm")
    shops = impute(shops, mode=["shop_reg_tm"])
    return shops.withColumn("shop_reg_time", F.expr(date_bucket("shop_reg_tm", bounds, open_start=False)))


def clean_products(products: DataFrame, bounds: Sequence[dt.date] = MARKET_BOUNDS) -> DataFrame:
    """Launch day filled and bucketed."""
    products = truncate_to_day(products, "market_time")
    products = impute(products, mode=["market_time"])
    return products.withColumn("market_tm", F.expr(date_bucket("market_time", bounds)))


def clean_tables(
    raw: Tables,
    user_bounds: Sequence[dt.date] = USER_REG_BOUNDS,
    shop_bounds: Sequence[dt.date] = SHOP_REG_BOUNDS,
    market_bounds: Sequence[dt.date] = MARKET_BOUNDS,
) -> Tables:
    return replace(
        raw,
        actions=truncate_to_day(raw.actions, "action_time"),
        users=clean_users(raw.users, user_bounds),
        shops=clean_shops(raw.shops, shop_bounds),
        products=clean_products(raw.products, market_bounds),
        comments=truncate_to_day(raw.comments, "dt"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: nulls and non-null values, counted in one scan."""
    counts = df.agg(
        F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns]
    )
    rows = F.array(*[
        F.struct(F.lit(c).alias("column_name"), (F.col("_rows") - F.col(c)).alias("nulls"), F.col(c).alias("filled"))
        for c in df.columns
    ])
    return counts.select(F.inline(rows))
