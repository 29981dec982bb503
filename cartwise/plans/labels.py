"""Candidates and labels per window, from the log or from the daily cube: both have a row of every triple and day."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.operators.log import candidate_rows
from cartwise.operators.measures import UCS
from cartwise.operators.windows import WindowSpec
from cartwise.sources.schemas import ORDER


def _candidate(spec: WindowSpec) -> Column:
    return F.col("action_time").between(F.lit(spec.start), F.lit(spec.end))


def _bought(log: DataFrame, spec: WindowSpec) -> Column:
    inside = F.col("action_time").between(F.lit(spec.label_start), F.lit(spec.label_end))
    return inside & (F.col(f"n{ORDER}") > 0 if f"n{ORDER}" in log.columns else F.col("type") == ORDER)


def train_labels(log: DataFrame, spec: WindowSpec) -> DataFrame:
    """Triples acted on in the candidate days; label 1 if ordered in the label days.

    One aggregate over both ranges instead of two distinct scans and a join.
    """
    days = F.col("action_time").between(F.lit(spec.start), F.lit(spec.label_end))
    flags = log.where(days).groupBy(*UCS).agg(
        F.bool_or(_candidate(spec)).alias("_seen"), F.bool_or(_bought(log, spec)).alias("_bought")
    )
    return flags.where("_seen").select(*UCS, F.col("_bought").cast("int").alias("label"))


def scoring_candidates(log: DataFrame, spec: WindowSpec) -> DataFrame:
    """Distinct triples acted on in the candidate days."""
    return candidate_rows(log, spec).select(*UCS).distinct()


def bought_triples(log: DataFrame, spec: WindowSpec) -> DataFrame:
    """Distinct triples ordered in the label days: the truth of a hold-out window."""
    return log.where(_bought(log, spec)).select(*UCS).distinct()


def all_windows(log: DataFrame, training: Mapping[str, WindowSpec], scoring: Mapping[str, WindowSpec]) -> DataFrame:
    """Candidates of several windows from one scan and one shuffle; scoring windows have a null label.

    A triple carries two flags per window through the shuffle and becomes one row per window after it.
    """
    specs = {**training, **scoring}
    first = min(s.start for s in specs.values())
    last = max([s.label_end for s in training.values()] + [s.end for s in specs.values()])
    flags = []
    for name, spec in specs.items():
        flags.append(F.bool_or(_candidate(spec)).alias(f"_seen_{name}"))
        if name in training:
            flags.append(F.bool_or(_bought(log, spec)).alias(f"_bought_{name}"))
    per_triple = (
        log.where(F.col("action_time").between(F.lit(first), F.lit(last))).groupBy(*UCS).agg(*flags)
    )
    rows = F.array(*[
        F.struct(
            F.lit(name).alias("window"),
            F.col(f"_seen_{name}").alias("_seen"),
            (F.col(f"_bought_{name}").cast("int") if name in training else F.lit(None).cast("int")).alias("label"),
        )
        for name in specs
    ])
    return per_triple.select(*UCS, F.inline(rows)).where("_seen").select("window", *UCS, "label")
