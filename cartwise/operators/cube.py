"""The daily cube: the counted log as additive counts, from which every window is a range sum.

One aggregation over the counted log gives two grains: a row per (user, category, shop, day), and a row per (product, day)
for what is counted by product. Counts of a day add up over any range of days and any coarser key, so measures, day bitmaps,
comment weights and labels of all windows read the cube and the log is scanned once. The rows of a triple are at most
its days, whatever the number of actions, so no later step meets a hot triple.

A written cube is partitioned by grain and day: a window reads its days only, and :func:`kept_cube` replaces single days.

An action without a day is in no window and left out. Columns: ``by_product``, the keys (``user_id`` is null in the grain
of products and ``sku_id`` in the other), ``action_time``, ``n`` and ``d`` (actions with and without repeats), and
``n1``.. ``n5``, ``d1``.. ``d5`` by action code.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.operators.log import history_rows
from cartwise.operators.windows import WindowSpec
from cartwise.sources.schemas import ACTION_CODES
from cartwise.sources.tables import hadoop_path

PARTITIONS = ("by_product", "action_time")
_KEYS = ("user_id", "cate", "shop_id", "sku_id", "action_time")
_LACKS_USER = 1 << (len(_KEYS) - 1)  # of grouping_id, whose first key is the highest bit


def daily_cube(log: DataFrame) -> DataFrame:
    """The cube of a counted log (see :func:`cartwise.operators.log.counted_log`)."""
    rows = log.where("action_time IS NOT NULL").select(*_KEYS, "type", "n")
    counts = [F.expr("sum(n) AS n"), F.expr("count(*) AS d")]
    for code in range(1, ACTION_CODES + 1):
        counts += [F.expr(f"sum(if(type = {code}, n, 0L)) AS n{code}"), F.expr(f"count_if(type = {code}) AS d{code}")]
    grains = [[k for k in _KEYS if k != "sku_id"], [k for k in _KEYS if k != "user_id"]]
    both = rows.groupingSets([[F.col(k) for k in grain] for grain in grains], *_KEYS)
    return both.agg(F.expr(f"int(grouping_id() = {_LACKS_USER}) AS by_product"), *counts)


def triple_days(cube: DataFrame, spec: WindowSpec) -> DataFrame:
    """Counts per (user, category, shop, day) up to the window end, with ``age`` = days before it."""
    return history_rows(cube.where("by_product = 0"), spec).drop("by_product", "sku_id")


def product_days(cube: DataFrame, spec: WindowSpec) -> DataFrame:
    """Counts per (product, day) up to the window end."""
    return history_rows(cube.where("by_product = 1"), spec).drop("by_product", "user_id")


def write_cube(cube: DataFrame, path: str, only_days: bool = False) -> None:
    """Write a cube by grain and day; with ``only_days`` the days of ``cube`` replace theirs and all others stay.

    Rebalancing gathers a day's rows, so that a day has few files, and splits a busy day over tasks.
    """
    writer = cube.hint("rebalance", *PARTITIONS).write.mode("overwrite").partitionBy(*PARTITIONS)
    writer.option("partitionOverwriteMode", "dynamic" if only_days else "static").parquet(path)


def kept_cube(
    spark: SparkSession, folder: str, log: DataFrame, state: str, new_days: Sequence[dt.date] | None = None
) -> DataFrame:
    """The cube of ``log`` in ``folder``, which ``state`` describes (inputs and what made it).

    A cube of another state is built again, or only the ``new_days``, if the caller knows that no other day differs. A
    marker names the state that the cube was finished for. It goes before anything is changed and comes after, so a killed
    job leaves a cube without a marker, and the next one builds it in full.
    """
    cube, markers = f"{folder}/cube", f"{folder}/cube-state"
    marker, store = hadoop_path(spark, f"{markers}/{hashlib.sha256(state.encode()).hexdigest()}")
    if not store.exists(marker):
        above = hadoop_path(spark, markers)[0]
        known = store.exists(above) and len(store.listStatus(above)) > 0
        store.delete(above, True)
        if known and new_days is not None:
            days = sorted(set(new_days))
            rows = log.where(F.col("action_time").isin(days))
            write_cube(daily_cube(rows), cube, only_days=True)
            left = {r[0] for r in rows.select("action_time").distinct().collect()}  # at most the given days
            for day in days:  # a day that has lost all its rows
                for grain in (0, 1) if day not in left else ():
                    store.delete(hadoop_path(spark, f"{cube}/by_product={grain}/action_time={day}")[0], True)
        else:
            write_cube(daily_cube(log), cube)
        store.mkdirs(marker)
    return spark.read.schema(daily_cube(log).schema).parquet(cube)
