"""A fitted ensemble as a table of tree nodes: split counts, the quality after every round, and cutting at a round."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.session import new_folder

#: Margins are counted in so many bins between -REACH and REACH, beyond which a probability is over 0.99.
BINS, REACH = 1024, 2.5
CHUNK = 1_000


def nodes(model: GBTClassificationModel, names: Sequence[str]) -> DataFrame:
    """The persisted nodes: tree, weight, node, feature (null in a leaf), threshold, left, right, prediction, gain, rows.

    A row goes left if its feature is at most the threshold.
    """
    spark = SparkSession.active()
    path = new_folder(spark, "trees")
    model.write().save(path)
    name = F.get(F.array(*map(F.lit, names)), F.col("split.featureIndex"))
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("treeID", "metadata", "weight").drop("metadata")
    found = spark.read.parquet(f"{path}/data").join(F.broadcast(weights), "treeID").select("treeID", "weight", "nodeData.*")
    inner = F.col("leftChild") >= 0
    return found.select(
        F.col("treeID").alias("tree"), "weight", F.col("id").alias("node"), F.when(inner, name).alias("feature"),
        F.when(inner, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        "prediction", F.when(inner, F.col("gain")).alias("gain"), F.col("rawCount").alias("rows"),
    )


def split_counts(table: DataFrame) -> DataFrame:
    """How often each feature splits a node."""
    return table.where("feature IS NOT NULL").groupBy("feature").agg(F.count("*").cast("double").alias("gain"))


class Forest:
    """All trees as arrays, evaluated for many rows at once."""

    def __init__(self, table: DataFrame, names: Sequence[str]):
        rows = table.collect()  # at most rounds times nodes of a tree
        shape = 1 + max(r.tree for r in rows), 1 + max(r.node for r in rows)
        number = {n: i for i, n in enumerate(names)}
        self.feature = np.full(shape, -1)
        self.threshold, self.value = np.zeros(shape), np.zeros(shape)
        self.child = np.zeros((*shape, 2), int)
        for r in rows:
            at = r.tree, r.node
            self.value[at] = r.weight * r.prediction
            if r.feature is not None:
                self.feature[at], self.threshold[at], self.child[at] = number[r.feature], r.threshold, (r.left, r.right)

    def margins(self, features: np.ndarray) -> np.ndarray:
        """Margin of every row after every tree."""
        trees, at = np.arange(len(self.value)), np.zeros((len(features), len(self.value)), int)
        row = np.arange(len(features))[:, None]
        while (inner := self.feature[trees, at] >= 0).any():
            right = features[row, self.feature[trees, at]] > self.threshold[trees, at]
            at = np.where(inner, self.child[trees, at, right.astype(int)], at)
        return np.cumsum(self.value[trees, at], axis=1)


def by_round(model: GBTClassificationModel, rows: DataFrame, names: Sequence[str]) -> dict[str, list[float]]:
    """``auc`` and ``loss`` of rows (features, label) after every round, all from one pass.

    A task counts its rows by round, margin bin and label, and adds up their losses; Spark sums over tasks. Ties inside a
    bin count half. What is collected is bounded by rounds and bins.
    """
    forest = Forest(nodes(model, names), names)
    rounds = len(forest.value)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, loss = np.zeros(rounds * BINS * 2, np.int64), np.zeros(rounds)
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                features = part.column("features").flatten().to_numpy().reshape(part.num_rows, -1)
                label = part.column("label").to_numpy().astype(int)
                margins = forest.margins(features)
                bins = np.clip(((margins + REACH) * (BINS / (2 * REACH))).astype(int), 0, BINS - 1)
                keys = ((np.arange(rounds) * BINS + bins) * 2 + label[:, None]).reshape(-1)
                cells += np.bincount(keys, minlength=len(cells))
                loss += 2 * np.logaddexp(0, -2 * (2 * label[:, None] - 1) * margins).sum(axis=0)
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_pydict({
            "cell": pa.array([*used, *(-1 - np.arange(rounds))], pa.int64()), "n": pa.array([*cells[used], *[0] * rounds], pa.int64()),
            "loss": pa.array([*[0.0] * len(used), *loss], pa.float64()),
        })

    flat = rows.select(vector_to_array("features").alias("features"), F.col("label").cast("int").alias("label"))
    sums = flat.mapInArrow(count, "cell bigint, n bigint, loss double").groupBy("cell").agg(
        F.sum("n").alias("n"), F.sum("loss").alias("loss")
    ).collect()
    cells, loss = np.zeros((rounds, BINS, 2)), np.zeros(rounds)
    for r in sums:
        if r.cell < 0:
            loss[-1 - r.cell] = r.loss
        else:
            cells.reshape(-1)[r.cell] = r.n
    negative, positive = cells[:, :, 0], cells[:, :, 1]
    below = np.cumsum(negative, axis=1) - negative / 2
    pairs = np.maximum(negative.sum(axis=1) * positive.sum(axis=1), 1)
    auc = np.where(pairs > 1, (positive * below).sum(axis=1) / pairs, 0.5)
    return {"auc": auc.tolist(), "loss": (loss / max(cells[0].sum(), 1)).tolist()}


def probabilities(table: DataFrame, rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rows`` with ``node_prob``: the probability of label 1 by the nodes alone, from the columns of these names."""
    forest = Forest(table, names)

    @F.arrow_udf("double")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            features = column.flatten().to_numpy().reshape(len(column), -1)
            found = [forest.margins(features[at:at + CHUNK])[:, -1] for at in range(0, len(features), CHUNK)]
            yield pa.array(1 / (1 + np.exp(-2 * np.concatenate(found or [np.empty(0)]))))

    return rows.withColumn("node_prob", of(F.array(*(F.col(f"`{n}`").cast("double") for n in names))))


def cut(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The ensemble of the first ``rounds`` trees."""
    jvm, gateway, java = model._java_obj, SparkSession.active().sparkContext._gateway, SparkSession.active()._jvm
    trees = gateway.new_array(java.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(java.double, rounds)
    for i, (tree, weight) in enumerate(zip(list(jvm.trees())[:rounds], model.treeWeights)):
        trees[i], weights[i] = tree, weight
    short = java.org.apache.spark.ml.classification.GBTClassificationModel(
        model.uid, trees, weights, model.numFeatures, model.numClasses
    )
    out = GBTClassificationModel(short)
    return out.setFeaturesCol(model.getFeaturesCol())
