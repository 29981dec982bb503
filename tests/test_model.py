"""Training, scoring and the whole job."""

import datetime as dt
from dataclasses import replace
from functools import cache

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from cartwise.plans import dataset, model, trees
from cartwise.plans.families import UCS
from cartwise.plans.run import Plan, Run
from cartwise.session import new_folder
from cartwise.sources import fixtures as X
from cartwise.sources.tables import has_table
from checks import compare, oracle, spark_queries
from tests.conftest import SF


@pytest.fixture(scope="module")
def train_set(spark):
    rows = spark.range(2000).select(
        (F.col("id") % 200).alias("user_id"), (F.col("id") % 5).cast("int").alias("cate"), F.col("id").alias("shop_id"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) / 100).alias("signal"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100)) / 100).alias("noise"),
    )
    return rows.withColumn("label", (F.col("signal") > 0.7).cast("int")).cache()


def test_model_learns_scores_and_reloads(spark, train_set):
    fitted = model.train(train_set, model.TreeParams(rounds=3, depth=3))
    assert list(model.model_features(fitted)) == ["signal", "noise"]
    assert model.auc(fitted, train_set) > 0.95
    scored = model.score(fitted, train_set.drop("label"))
    assert scored.columns == [*UCS, "prob"] and scored.count() == 2000
    assert scored.where("prob < 0 OR prob > 1").count() == 0
    top = model.top_features(fitted).collect()
    assert top[0].feature == "signal" and sum(r.fscore for r in top) == pytest.approx(1)
    path = new_folder(spark, "model")
    model.save(fitted, path)
    again = model.score(model.load(path), train_set)
    assert scored.exceptAll(again).count() == 0


def test_one_flat_round_does_not_stop_training():
    assert model.best_round([5, 4, 4, 3, 2], 2) == (5, False)
    assert model.best_round([5, 4, 4, 4, 2], 2) == (2, True)
    assert model.best_round([5, 6, 7, 8], 10) == (1, False)


@pytest.mark.parametrize("watch", ["loss", "auc"])
def test_training_ends_at_the_best_round(spark, train_set, watch, monkeypatch):
    fits, fit = [], model.GBTClassifier.fit
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda self, rows: fits.append(self.getMaxIter()) or fit(self, rows))
    params = model.TreeParams(rounds=12, depth=2, first_rounds=3, patience=2, step=1.0, watch=watch)
    fitted = model.train(train_set, params)
    assert fits == [3, 6, 12][:len(fits)]  # one fit per doubling, none after the best round is known
    ensemble, names = fitted.stages[1], model.model_features(fitted)
    held = fitted.stages[0].transform(model.hold_out(train_set, params.hold_out).where("_held_out"))
    found = trees.by_round(ensemble, held, names)[watch]
    best = found.index(min(found) if watch == "loss" else max(found))
    assert 1 <= ensemble.getNumTrees <= 12 and best == ensemble.getNumTrees - 1
    same = GBTClassifier(maxIter=ensemble.getNumTrees, maxDepth=2, stepSize=1.0, subsamplingRate=0.9, featureSubsetStrategy="0.8",
                         minInstancesPerNode=3, maxBins=64, checkpointInterval=10, seed=7, featuresCol="features", labelCol="label")
    learned = fitted.stages[0].transform(model.hold_out(train_set, params.hold_out).where("NOT _held_out")).select("features", "label")
    assert ensemble.toDebugString.split("\n", 1)[1] == fit(same, learned).toDebugString.split("\n", 1)[1]  # as if fitted that long


def test_quality_after_every_round(spark, train_set):
    fitted = model.train(train_set, model.TreeParams(rounds=6, depth=3, hold_out=0.0))
    rows = fitted.stages[0].transform(train_set.withColumn("label", F.expr("if(shop_id % 9 = 0, 1 - label, label)")))
    found = trees.by_round(fitted.stages[1], rows, model.model_features(fitted))
    assert found["loss"] == pytest.approx(fitted.stages[1].evaluateEachIteration(rows))
    for n in (1, 3, 6):
        short = trees.cut(fitted.stages[1], n)
        assert short.getNumTrees == n
        exact = BinaryClassificationEvaluator(labelCol="label").evaluate(short.transform(rows))
        assert found["auc"][n - 1] == pytest.approx(exact, abs=2e-3)
    by_nodes = trees.probabilities(model.nodes(fitted), train_set, model.model_features(fitted))
    scored = model.score(fitted, train_set).join(by_nodes.select(*UCS, "node_prob"), list(UCS))
    assert scored.where("abs(prob - node_prob) < 1e-9").count() == 2000


def test_importance_of_a_tree_made_by_hand(spark):
    rows = [(0, 0, "a"), (0, 1, "b"), (0, 2, None), (0, 3, None), (0, 4, None), (1, 0, "a"), (1, 1, None), (1, 2, None), (2, 0, None)]
    table = spark.createDataFrame(rows, "tree int, node int, feature string")
    got = {r.feature: r.fscore for r in model.shares(trees.split_counts(table)).collect()}
    assert got == pytest.approx({"a": 2 / 3, "b": 1 / 3})


def test_both_kinds_of_importance(spark, train_set):
    fitted = model.train(train_set, model.TreeParams(rounds=4, depth=3))
    table = model.nodes(fitted)
    assert table.where("feature IS NOT NULL").count() == (fitted.stages[1].totalNumNodes - fitted.stages[1].getNumTrees) // 2
    by_gain = {r.feature: r.fscore for r in model.importance(fitted, "gain").collect()}
    by_splits = {r.feature: r.fscore for r in model.importance(fitted).collect()}
    assert set(by_gain) == set(by_splits) and sum(by_gain.values()) == pytest.approx(1) == sum(by_splits.values())
    assert by_gain["signal"] > by_splits["signal"]  # the noise splits often and gains little


def test_checks_turn_red_for_a_model_that_learned_nothing(spark, monkeypatch):
    monkeypatch.setattr(spark_queries, "_model_input", cache(spark_queries._model_input))
    duck, train = compare.connect(SF), model.train

    def constant(rows):
        return train(rows, model.TreeParams(rounds=2, min_gain=10.0))

    def of_shuffled_labels(rows):
        return train(rows.withColumn("label", F.expr("int(pmod(xxhash64(user_id, cate, shop_id), 10) = 0)")), model.TreeParams(rounds=20))

    for bad in (constant, of_shuffled_labels):
        monkeypatch.setattr(model, "train", bad)
        for name in ("model_train", "model_score", "model_importance"):
            assert compare.compare(spark_queries.registry()[name](spark, SF), duck, oracle.statements()[name]) is not None


def test_splits_need_their_gain(spark, train_set):
    few = model.train(train_set, model.TreeParams(rounds=2, min_gain=10.0))
    assert few.stages[1].totalNumNodes == few.stages[1].getNumTrees  # single leaves


def test_model_queries_agree_with_their_sql(spark):
    duck = compare.connect(SF)
    for name in ("model_train", "model_score", "model_importance", "model_reload"):
        assert compare.compare(spark_queries.registry()[name](spark, SF), duck, oracle.statements()[name]) is None


def test_scoring_shares_tables_and_reads_wide_rows_once(spark, monkeypatch):
    kept, writer, train = [], spark_queries.writer, model.train

    def recording(session):
        keep = writer(session)
        return lambda name, *rest: kept.append(name) or keep(name, *rest)

    monkeypatch.setattr(spark_queries, "writer", recording)
    monkeypatch.setattr(model, "train", lambda rows: train(rows, model.TreeParams(rounds=2)))
    found = spark_queries.registry()["model_score"](spark, SF)
    assert kept.count("cube") == kept.count("users_raw") == 1 and kept.count("model_input") == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "/model_input" not in plan  # both scores were found in the pass that wrote them
    assert found.where("scored").count() == found.count() > 0


def test_rows_of_the_learner_leave_memory_to_its_binned_rows(train_set, monkeypatch):
    levels, fit = [], model.GBTClassifier.fit
    monkeypatch.setattr(model.GBTClassifier, "fit", lambda self, rows: levels.append(rows.storageLevel) or fit(self, rows))
    model.train(train_set, model.TreeParams(rounds=2, depth=2))
    assert levels and all(level.useDisk and not level.useMemory for level in levels)


def test_columns_travel_with_the_scores(train_set):
    fitted = model.train(train_set, model.TreeParams(rounds=2, depth=2))
    scored = model.score(fitted, train_set, "noise")
    assert scored.columns == [*UCS, "noise", "prob"]
    assert scored.select(*UCS, "noise").exceptAll(train_set.select(*UCS, "noise")).count() == 0


def test_hold_out_keeps_users_together(train_set):
    marked = model.hold_out(train_set, 0.1)
    sides = marked.groupBy("user_id").agg(F.count_distinct("_held_out").alias("n"))
    assert sides.where("n > 1").count() == 0
    assert 0 < marked.where("_held_out").count() < 600


def test_weak_columns_are_distinct():
    assert len(dataset.WEAK_COLUMNS) == len(set(dataset.WEAK_COLUMNS)) == 31


def test_whole_job(spark):
    """Windows 1, 2, 3 and A train five models that vote on the scoring window; a second run reads tables."""
    ends = {"1": dt.date(2024, 1, 9), "2": dt.date(2024, 1, 16), "3": dt.date(2024, 1, 23),
            "a": dt.date(2024, 1, 23), "test": dt.date(2024, 1, 30)}
    plan = Plan(
        ends=ends, user_bounds=X.USER_REG_BOUNDS, shop_bounds=X.SHOP_REG_BOUNDS, market_bounds=X.MARKET_BOUNDS,
        trees=model.TreeParams(rounds=4, depth=2), thresholds={m: 0.05 for m in ("1", "2", "3", "a", "23")},
    )
    raw, folder = X.raw_tables(spark, SF), new_folder(spark, "job")
    run = Run(spark, raw, folder, plan)
    voted = run.predictions()
    candidates = run.assembled("test").select(*UCS)
    assert voted.count() > 0 and voted.exceptAll(candidates).count() == 0
    assert has_table(spark, f"{folder}/scores=23", run.manifest)
    assert "ucs_b5_count_in_1" in run.assembled("a").columns
    assert "ucs_b5_count_in_1" not in run.assembled("3").columns
    again = Run(spark, raw, folder, plan)
    assert again.predictions().exceptAll(voted).count() == 0
    other = Run(spark, raw, folder, replace(plan, thresholds={m: 2.0 for m in plan.thresholds}))
    assert other.manifest != again.manifest and not has_table(spark, f"{folder}/predictions", other.manifest)
