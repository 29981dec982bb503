"""Running totals, exact median and mode of any column, the exact curve over scores."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from cartwise.operators import clean, running
from cartwise.plans import evaluate


def test_running_totals_of_a_table_in_ranges(spark):
    rows = spark.range(5_000).selectExpr("id", "pmod(xxhash64(id), 97) AS a", "id % 5 AS b")
    got = running.running_totals(rows, [F.desc("a"), F.col("id")], {"sum_a": "a", "sum_b": "b"})
    assert got.columns == ["id", "a", "b", "sum_a", "sum_b"]
    total_a = total_b = 0
    for r in sorted(got.collect(), key=lambda r: (-r.a, r.id)):
        total_a, total_b = total_a + r.a, total_b + r.b
        assert (r.sum_a, r.sum_b) == (total_a, total_b)
    assert running.running_totals(rows.limit(0), [F.col("id")], {"s": "a"}).collect() == []


def test_no_task_sees_all_values(spark):
    rows = spark.range(1_000_000).selectExpr("id * 7919 % 1000003 AS v")
    totals = running.running_totals(running.value_counts(rows, "v"), [F.col("value")], {"upto": "n"})
    text = totals._jdf.queryExecution().executedPlan().toString()
    assert text.count("SinglePartition") == 1 and "Exchange SinglePartition" in text.split("BroadcastExchange")[1]  # the totals of the ranges
    parts = rows.toPandas()["v"]
    assert running.exact_median(rows, "v") == parts.median()
    assert running.exact_mode(rows.unionByName(rows.where("v IN (17, 5)")), "v") == 5  # the smallest of two


@pytest.mark.parametrize("values", [[3], [1, 2], [5, 1, 1, 9, None], [None], [], [2.5, -1.0, 2.5, 7.0], [4, 4, 1, 1]])
def test_median_and_mode_by_hand(spark, values):
    frame = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    known = sorted(v for v in values if v is not None)
    assert running.exact_median(frame, "v") == (statistics.median(known) if known else None)
    assert running.exact_mode(frame, "v") == (min(known, key=lambda v: (-known.count(v), v)) if known else None)


def test_both_ways_to_fill_agree(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, *range(30)]), rng.choice([None, rng.random()])) for i in range(500)]
    frame = spark.createDataFrame(rows, "id long, code int, price double")
    few, many = (clean.impute(frame, ["code"], ["price"], many_values=m) for m in (False, True))
    assert few.dtypes == many.dtypes and few.exceptAll(many).count() == 0


def test_exact_curve(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 0.1, 0.5, rng.random()]), rng.randrange(2)) for _ in range(400)]
    frame = spark.createDataFrame(rows, "prob double, label int")
    known = [(p, y) for p, y in rows if p is not None]
    curve = {r.threshold: r for r in evaluate.exact_curve(frame).collect()}
    assert set(curve) == {p for p, _ in known}
    for t, r in curve.items():
        chosen = [y for p, y in known if p >= t]
        assert (r.predicted, r.hits, r.actual) == (len(chosen), sum(chosen), sum(y for _, y in known))
    best = evaluate.best_submission(frame).first()
    assert best.f1 == max(r.f1 for r in curve.values()) and curve[best.threshold] == best
    swept = {r.threshold: r for r in evaluate.threshold_sweep(frame.where("prob IS NOT NULL"), [0.1, 0.5]).collect()}
    assert all(swept[t].f1 == curve[t].f1 for t in swept)
    assert evaluate.exact_curve(frame.limit(0)).collect() == [] == evaluate.best_submission(frame.limit(0)).collect()
