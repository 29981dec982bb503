"""Scores of a prediction against a hold-out window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.scalars import f1, named, safe_rate
from cartwise.operators.measures import UCS
from cartwise.operators.running import running_totals


def two_level(
    predicted: DataFrame, truth: DataFrame, cate_weight: float = 0.5, shop_weight: float = 0.5
) -> DataFrame:
    """Precision, recall and F1 of (user, category) pairs and of triples, and their weighted sum.

    One row. Repeated predictions count once at each level.
    """
    rows = predicted.select(*UCS, F.lit(1).alias("p"), F.lit(0).alias("t")).unionByName(
        truth.select(*UCS, F.lit(0).alias("p"), F.lit(1).alias("t"))
    )
    triples = rows.groupBy(*UCS).agg(F.max("p").alias("p"), F.max("t").alias("t"))
    pairs = triples.groupBy("user_id", "cate").agg(
        F.max("p").alias("pair_p"), F.max("t").alias("pair_t"),
        F.sum("p").alias("p"), F.sum("t").alias("t"), F.sum(F.col("p") * F.col("t")).alias("hit"),
    )
    sums = {
        "cate_predicted": "pair_p", "cate_actual": "pair_t", "cate_hits": "pair_p * pair_t",
        "shop_predicted": "p", "shop_actual": "t", "shop_hits": "hit",
    }
    counts = pairs.agg(*[F.expr(f"coalesce(sum({sql}), 0L) AS {name}") for name, sql in sums.items()])
    rates = counts.selectExpr("*", *named({
        f"{level}_{rate}": safe_rate(f"{level}_hits", f"{level}_{of}")
        for level in ("cate", "shop") for rate, of in (("precision", "predicted"), ("recall", "actual"))
    }))
    scored = rates.selectExpr("*", *named({
        f"{level}_f1": f1(f"{level}_precision", f"{level}_recall") for level in ("cate", "shop")
    }))
    return scored.selectExpr("*", f"{float(cate_weight)}D * cate_f1 + {float(shop_weight)}D * shop_f1 AS score")


def threshold_sweep(scored: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """Submission size, hits, precision, recall and F1 per threshold, for rows with ``prob`` and ``label``.

    One pass with two conditional sums per threshold.
    """
    aggs = ["count_if(label = 1) AS _actual"]
    rows = []
    for i, bound in enumerate(thresholds):
        chosen = f"prob >= {float(bound)}D"
        aggs += [f"count_if({chosen}) AS _size_{i}", f"count_if({chosen} AND label = 1) AS _hits_{i}"]
        rows.append(
            f"struct({float(bound)}D AS threshold, _size_{i} AS predicted, _hits_{i} AS hits, _actual AS actual)"
        )
    swept = scored.agg(*[F.expr(a) for a in aggs]).selectExpr(f"inline(array({', '.join(rows)}))")
    return _rated(swept)


def _rated(counts: DataFrame) -> DataFrame:
    rated = counts.selectExpr("*", *named({
        "precision": safe_rate("hits", "predicted"), "recall": safe_rate("hits", "actual"),
    }))
    return rated.selectExpr("*", *named({"f1": f1("precision", "recall")}))


def exact_curve(scored: DataFrame) -> DataFrame:
    """The sweep at every distinct score: what a submission of all rows of at least this ``prob`` gets. Null scores are out.

    Rows are counted per score, and running totals go from the highest score down.
    """
    hit = "count_if(label = 1)"
    known = scored.where("prob IS NOT NULL")
    by_score = known.groupBy(F.col("prob").alias("threshold")).agg(F.expr("count(*) AS _n"), F.expr(f"{hit} AS _hits"))
    actual = known.agg(F.expr(f"{hit} AS actual")).scalar()
    running = running_totals(by_score, [F.desc("threshold")], {"predicted": "_n", "hits": "_hits"})
    return _rated(running.select("threshold", "predicted", "hits", actual.alias("actual")))


def best_submission(scored: DataFrame) -> DataFrame:
    """The row of :func:`exact_curve` with the best F1, of several the smallest submission: best threshold and best size."""
    curve = exact_curve(scored)
    best = F.max(F.struct(F.col("f1"), (-F.col("predicted")).alias("less"), *[c for c in curve.columns if c != "f1"]))
    return curve.agg(best.alias("best")).where("best IS NOT NULL").select(*[F.col(f"best.{c}").alias(c) for c in curve.columns])
