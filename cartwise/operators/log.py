"""The action log: actions joined with their product, and the same log with repeats counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.scalars import days_until, lit
from cartwise.operators.joins import broadcast_if_small
from cartwise.operators.windows import WindowSpec


def action_log(actions: DataFrame, products: DataFrame) -> DataFrame:
    """One row per action with the category and shop of its product; actions on unknown products drop out."""
    lookup = products.select("sku_id", "cate", "shop_id")
    return actions.join(broadcast_if_small(lookup), "sku_id")


def counted_log(actions: DataFrame, products: DataFrame) -> DataFrame:
    """The log with equal rows merged into one that carries their number ``n``.

    ``sum(n)`` counts actions and ``count(*)`` counts distinct actions, so raw and de-duplicated features
    share one log. The merge runs before the product join: it is combined on the map side and its keys are
    all columns of an action, so a hot user or product is spread out and shrinks before any join sees it.
    """
    merged = actions.groupBy(*actions.columns).agg(F.count("*").alias("n"))
    return action_log(merged, products)


def candidate_rows(log: DataFrame, spec: WindowSpec) -> DataFrame:
    """Rows of the candidate days."""
    return log.where(f"action_time BETWEEN {lit(spec.start)} AND {lit(spec.end)}")


def history_rows(log: DataFrame, spec: WindowSpec) -> DataFrame:
    """Rows up to the window end, with ``age`` = days before it. Nothing later can leak into a feature."""
    days = f"action_time <= {lit(spec.end)}"
    if spec.history_start is not None:
        days += f" AND action_time >= {lit(spec.history_start)}"
    return log.where(days).selectExpr("*", f"{days_until(spec.end, 'action_time')} AS age")
