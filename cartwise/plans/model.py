"""Boosted trees on an assembled set: training with a hold-out, scores, feature importance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.operators.measures import UCS
from cartwise.plans import trees
from cartwise.plans.dataset import feature_columns
from cartwise.session import shared_dir


@dataclass(frozen=True)
class TreeParams:
    """Rounds, patience, depth, step size, row share, column share and smallest leaf: fixed values.

    Leaves hold at least ``min_rows`` rows, where a learner with second-order gradients would bound their
    hessian. A split must gain at least ``min_gain`` (per row, where a learner with second-order gradients
    would bound the sum; off by default). Training stops once what it watches on the hold-out, ``auc`` or ``loss``, has not
    become better for ``patience`` rounds, and the model ends at its best round.
    """

    rounds: int = 500
    depth: int = 6
    step: float = 0.125
    row_share: float = 0.9
    column_share: float = 0.8
    min_rows: int = 3
    patience: int = 10
    min_gain: float = 0.0
    max_bins: int = 64
    first_rounds: int = 20
    hold_out: float = 0.1
    watch: str = "auc"
    seed: int = 7


TOP_FEATURES = 20


def hold_out(df: DataFrame, share: float) -> DataFrame:
    """Mark a fixed share of the users as hold-out; all rows of a user fall on the same side."""
    return df.withColumn("_held_out", F.expr(f"pmod(xxhash64(user_id), 1000) < {int(share * 1000)}"))


def best_round(losses: Sequence[float], patience: int) -> tuple[int, bool]:
    """Number of rounds up to the smallest value before ``patience`` rounds without a smaller one, and whether that came."""
    best = 0
    for k, loss in enumerate(losses):
        if loss < losses[best]:
            best = k
        elif k - best >= patience:
            return best + 1, True
    return best + 1, False


def train(train_set: DataFrame, params: TreeParams = TreeParams()) -> PipelineModel:
    """Fit on a labelled set; every column but the keys and the label is a feature.

    The learner stops at the first flat round, if at all, so it is run without: for ``first_rounds`` rounds, then
    for twice as many, until the hold-out has been flat for ``patience`` rounds or all rounds are used. One pass over the
    hold-out gives its quality after every round, and the fitted ensemble is cut at its best round, not fitted again.
    """
    if params.watch not in ("auc", "loss"):
        raise ValueError("the hold-out is watched by auc or by loss")
    spark = train_set.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_dir(spark)}/boosting")
    features = VectorAssembler(inputCols=feature_columns(train_set), outputCol="features", handleInvalid="error")
    marked = hold_out(train_set, params.hold_out)
    # The learner reads these once a fit and keeps its own, binned rows in memory, which all levels of all trees read.
    rows, held = (
        features.transform(marked.where(c)).select("features", "label").persist(StorageLevel.DISK_ONLY)
        for c in ("NOT _held_out", "_held_out")
    )
    watched = not held.isEmpty()
    rounds = min(params.rounds, params.first_rounds if watched else params.rounds)

    def fit(n: int) -> GBTClassificationModel:
        return GBTClassifier(
            featuresCol="features", labelCol="label", maxIter=n, maxDepth=params.depth,
            stepSize=params.step, subsamplingRate=params.row_share, featureSubsetStrategy=str(params.column_share),
            minInstancesPerNode=params.min_rows, minInfoGain=params.min_gain, maxBins=params.max_bins,
            checkpointInterval=10, seed=params.seed,
        ).fit(rows)

    while True:
        fitted = fit(rounds)
        best, flat = rounds, True
        if watched:
            found = trees.by_round(fitted, held, features.getInputCols())[params.watch]
            best, flat = best_round([-x for x in found] if params.watch == "auc" else found, params.patience)
        if flat or rounds >= params.rounds:
            break
        rounds = min(2 * rounds, params.rounds)
    if best < rounds:
        fitted = trees.cut(fitted, best)
    rows.unpersist()
    held.unpersist()
    return PipelineModel([features, fitted])


def score(model: PipelineModel, rows: DataFrame, *kept: str) -> DataFrame:
    """Purchase probability per candidate; the keys, and columns ``kept`` besides, travel with the rows."""
    prob = vector_to_array(F.col("probability"))[1].alias("prob")
    return model.transform(rows).select(*UCS, *kept, prob)


def auc(model: PipelineModel, rows: DataFrame) -> float:
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction")
    return evaluator.evaluate(model.transform(rows))


def nodes(model: PipelineModel) -> DataFrame:
    """The nodes of all trees (see :func:`cartwise.plans.trees.nodes`)."""
    return trees.nodes(model.stages[1], model_features(model))


def importance(model: PipelineModel, kind: str = "splits") -> DataFrame:
    """Share of each used feature in all splits, or in the total ``gain``, one row per feature."""
    if kind not in ("splits", "gain"):
        raise ValueError("importance is a share of the splits or of the gain")
    if kind == "splits":
        return shares(trees.split_counts(nodes(model)))
    assembler, fitted = model.stages
    gain = fitted.featureImportances.toArray()
    rows = [(name, float(v)) for name, v in zip(assembler.getInputCols(), gain) if v > 0]
    return shares(SparkSession.active().createDataFrame(rows, "feature string, gain double"))


def shares(gains: DataFrame) -> DataFrame:
    """Each feature's share (fscore) in the sum of the gains."""
    whole = gains.agg(F.sum("gain")).scalar()
    return gains.select("feature", (F.col("gain") / whole).alias("fscore"))


def top(scores: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    return scores.orderBy(F.desc("fscore"), "feature").limit(n)


def top_features(model: PipelineModel, n: int = TOP_FEATURES) -> DataFrame:
    return top(importance(model), n)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def model_features(model: PipelineModel) -> Sequence[str]:
    return model.stages[0].getInputCols()
