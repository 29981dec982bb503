"""Features of the product catalogue and the comment table, per category, shop or both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.scalars import lit
from cartwise.operators.cube import product_days
from cartwise.operators.windows import WindowSpec

MARKET_BUCKETS = (1, 2, 3, 4, 5, 6)
COMMENT_COLUMNS = ("comments", "good_comments", "bad_comments")


def distinct_counts(products: DataFrame, keys: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """Distinct values per key: output name -> counted column."""
    return products.groupBy(*keys).agg(*[F.expr(f"count(DISTINCT {c}) AS {name}") for name, c in columns.items()])


def launch_buckets(products: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Products per launch bucket and key: a pivot over a fixed vocabulary, in one pass."""
    return products.groupBy(*keys).agg(
        *[F.expr(f"count_if(market_tm = {b}) AS {prefix}_market_tm_{b}") for b in MARKET_BUCKETS]
    )


def comment_totals(comments: DataFrame, spec: WindowSpec) -> DataFrame:
    """Comment counts per product over the candidate days."""
    inside = comments.where(f"dt BETWEEN {lit(spec.start)} AND {lit(spec.end)}")
    return inside.groupBy("sku_id").agg(*[F.expr(f"sum({c}) AS {c}") for c in COMMENT_COLUMNS])


def product_comments(cube: DataFrame, comments: DataFrame, spec: WindowSpec) -> DataFrame:
    """Comment counts per product (with its category and shop), weighted by its action rows up to the window end.

    The cube has one row per product and day, so the join is between two catalogue-sized tables and a hot product is one
    row.
    """
    weights = product_days(cube, spec).groupBy("sku_id", "cate", "shop_id").agg(F.sum("n").alias("n"))
    weighted = weights.join(comment_totals(comments, spec), "sku_id")
    return weighted.selectExpr("sku_id", "cate", "shop_id", *[f"n * {c} AS {c}" for c in COMMENT_COLUMNS])


def comment_sums(products: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Sums of :func:`product_comments` per category, shop or both."""
    return products.groupBy(*keys).agg(*[F.expr(f"sum({c}) AS {prefix}_{c}") for c in COMMENT_COLUMNS])
