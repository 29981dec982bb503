"""Running totals over a whole ordered table, and exact quantile and mode from them, without a task that sees all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.session import new_folder
from cartwise.sources.tables import materialize

PART = "_part"


def running_totals(df: DataFrame, order: Sequence[Column], sums: Mapping[str, str]) -> DataFrame:
    """``df`` with running sums (output name -> summed column) up to and with each row; ``order`` tells all rows apart.

    The rows are cut into ranges of the order, which are written, so that a lost executor cannot cut them anew. Each range is
    totalled, the totals of the ranges before it are its offsets, and a window runs inside each range only. What one task
    sees is a range, or a total per range.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(ranges, *order).withColumn(PART, F.spark_partition_id())
    cut = materialize(spark, new_folder(spark, "ranges"), lambda: cut)
    totals = cut.groupBy(PART).agg(*[F.sum(c).alias(f"_all_{name}") for name, c in sums.items()])
    before = W.orderBy(PART).rowsBetween(W.unboundedPreceding, -1)  # over one row per range
    offsets = totals.select(PART, *[F.coalesce(F.sum(f"_all_{name}").over(before), F.lit(0)).alias(f"_before_{name}") for name in sums])
    inside = W.partitionBy(PART).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    return cut.join(F.broadcast(offsets), PART).select(
        *df.columns, *[(F.sum(c).over(inside) + F.col(f"_before_{name}")).alias(name) for name, c in sums.items()]
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, as (value, n), without nulls; combined on the map side."""
    value = F.col(column)
    return df.where(value.isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n"))


def exact_mode(df: DataFrame, column: str):
    """The most frequent value, the smallest of several; None without a value."""
    best = value_counts(df, column).agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("best"))
    return best.select("best.value").first()[0]


def exact_median(df: DataFrame, column: str) -> float | None:
    """The middle value, or the mean of the two middle ones; None without a value.

    Only the range of values that holds the middle is looked at for it.
    """
    running = running_totals(value_counts(df, column), [F.col("value")], {"upto": "n"})
    rows = running.agg(F.max("upto")).first()[0]
    if not rows:
        return None
    middle = [running.where(f"upto > {k}").agg(F.min("value")).first()[0] for k in sorted({(rows - 1) // 2, rows // 2})]
    return sum(map(float, middle)) / len(middle)
