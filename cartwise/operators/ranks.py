"""Dense ranks of a count among the keys of one parent, and per-key row order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cartwise.functions.scalars import named

ABSENT_RANK = 1000  # rank of a key without any row in the range: fixed value
MAX_GROUP_ROWS = 200_000


def dense_rank_in_parent(
    df: DataFrame, parent: Sequence[str], counts: Mapping[str, str], group_rows: int | None = None
) -> DataFrame:
    """Add one descending dense rank per entry of ``counts`` (output name -> count as SQL, null = not ranked).

    A row with a null count or a null in its parent gets ABSENT_RANK, whichever way is taken.

    ``group_rows`` is a proven upper bound on the rows of one parent, such as the number of (category, shop)
    pairs in the catalogue. Within the limit, one aggregate over the parent and the counts gathers the
    distinct counts of each parent, and a row's rank is its count's place among them: no wide row is sorted.
    Without a bound, or beyond the limit, the distinct combinations of a parent's counts are ranked by windows, as
    narrow rows, and joined back once: the join is on parent and counts, so a hot parent is spread over its
    combinations, and hashes the combinations, so no wide row is sorted. Combinations of a hot parent are few against its
    actions, as a high count takes as many actions: for a third of a 10^12-row log they are some 10^8 rows of a few numbers
    at worst, which a task sorts on disk.
    """
    if group_rows is not None and group_rows <= MAX_GROUP_ROWS:
        rows = df.selectExpr("*", *named({f"_{name}": count for name, count in counts.items()}))
        levels = rows.groupBy(*parent).agg(*[
            F.sort_array(F.collect_set(f"_{name}"), asc=False).alias(f"_{name}_levels") for name in counts
        ])
        joined = rows.join(levels.hint("shuffle_hash"), list(parent), "left")
        return joined.selectExpr(*df.columns, *named({
            name: f"int(coalesce(nullif(array_position(_{name}_levels, _{name}), 0), {ABSENT_RANK}))" for name in counts
        }))
    values = {f"_{name}": count for name, count in counts.items()}
    rows = df.selectExpr("*", *named(values))
    known = " AND ".join(f"{p} IS NOT NULL" for p in parent)
    levels = rows.where(known).selectExpr(*[f"{c} AS _of{c}" for c in (*parent, *values)]).distinct()
    by = ", ".join(f"_of{p}" for p in parent)
    ranked = levels.selectExpr("*", *named({  # nulls stand last and so move no other rank
        name: f"dense_rank() OVER (PARTITION BY {by} ORDER BY _of_{name} DESC NULLS LAST)" for name in counts
    }))
    same = " AND ".join([*(f"{p} = _of{p}" for p in parent), *(f"{v} <=> _of{v}" for v in values)])
    joined = rows.join(ranked.hint("shuffle_hash"), F.expr(same), "left")
    return joined.selectExpr(*df.columns, *named({
        name: f"int(if(_{name} IS NULL, {ABSENT_RANK}, coalesce({name}, {ABSENT_RANK})))" for name in counts
    }))


def latest_per_key(df: DataFrame, keys: Sequence[str], order: str, *carried: str) -> DataFrame:
    """The row with the largest ``order`` value of each key, as an aggregate: no sort, combined map-side.

    Ties fall to the largest carried values, so the result does not depend on row order.
    """
    picked = df.groupBy(*keys).agg(F.max(F.struct(order, *carried)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in (order, *carried)])


def order_gaps(orders: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days since the previous order row of the same key, by lag; ``n`` repeats count as gaps of zero.

    The checkable form of the mean gap. The feature itself is (last - first) / (rows - 1), which needs no
    sort and no window.
    """
    w = W.partitionBy(*keys).orderBy("action_time")
    daily = orders.groupBy(*keys, "action_time").agg(F.sum("n").alias("n"))
    return daily.withColumn("gap", F.datediff("action_time", F.lag("action_time").over(w)))
