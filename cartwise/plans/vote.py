"""Thresholds on the scores of several models, and a majority vote."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.operators.measures import UCS

# Threshold of each model and the votes a triple needs: fixed values.
THRESHOLDS = {"1": 0.076, "2": 0.057, "3": 0.076, "a": 0.083, "23": 0.073}
MIN_VOTES = 3


def threshold(scores: DataFrame, bound: float, name: str = "label") -> DataFrame:
    """1 if the score reaches the bound, else 0."""
    return scores.withColumn(name, (F.col("prob") >= bound).cast("int"))


def ballots(scores: Mapping[str, DataFrame], thresholds: Mapping[str, float] = THRESHOLDS) -> DataFrame:
    """Per triple: how many models scored it, and how many voted for it.

    All score sets are stacked and grouped once, where a chain of joins would shuffle once per model.
    """
    stacked = None
    for position, (name, df) in enumerate(scores.items()):
        bit = 1 << position
        vote = F.when(F.col("prob") >= thresholds[name], bit).otherwise(0)
        rows = df.select(*UCS, F.lit(bit).alias("scored"), vote.alias("voted"))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked.groupBy(*UCS).agg(
        F.bit_count(F.bit_or("scored")).alias("models"), F.bit_count(F.bit_or("voted")).alias("votes")
    )


def majority(
    scores: Mapping[str, DataFrame],
    thresholds: Mapping[str, float] = THRESHOLDS,
    min_votes: int = MIN_VOTES,
) -> DataFrame:
    """Triples that every model scored and at least ``min_votes`` voted for."""
    counted = ballots(scores, thresholds)
    return counted.where((F.col("models") == len(scores)) & (F.col("votes") >= min_votes)).select(*UCS)
