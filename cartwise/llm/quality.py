"""Quality classifier: supervised subword embeddings.

A document is the bag of its words (split at white space) and of the character n-grams of every word, each hashed to a
row of an embedding table; one more row stands for a word that repeats the word before it. The rows are averaged over the
document (with ``PRIOR`` empty ones, so that a few words decide little) and a softmax layer gives the two class
probabilities. Table and layer are learned together by numpy stochastic gradient descent.

Training reads at most ``sample`` labelled documents (those of the smallest hash of their id, so that the choice
does not depend on the order of rows). Their features are made on the executors; one task runs the descent, and its
model has a fixed size whatever the corpus. Scoring needs no more than a number per table row: the layer's weights times
the vector, as the average is linear. Every document is scored in full, and a task keeps the sums of words it has met.

Text without white space is one word, whose n-grams are all counted, in training and in scoring. A word beyond
``LONG_WORD`` bytes is counted in slices, so that it needs no list of its n-grams, and a task does not keep it.

Defined results: a null or empty text has no features and gets the score of the bias alone. Labels other than 0 and 1, and
documents with both, are not learned from; without labels every score is 0.5. Rows that repeat a ``doc_id`` are scored
each by its own text; the smallest is learned from. Columns named like the results are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import quoted, ship, without, written

TABLE_BITS = 16
DIMENSION = 16
N_GRAMS = (3, 4)
PRIOR = 30
#: Row of a repeated word.
REPEATED = 0
#: Words whose sums a task keeps; beyond it the store is emptied and filled anew.
KEPT_WORDS = 300_000
#: Bytes beyond which the n-grams of a word are counted in slices of so many n-grams.
LONG_WORD, SLICE = 200, 1 << 16
RESULTS = ("score", "predicted")


@dataclass(frozen=True)
class Model:
    """Weight of every hashed feature (class 1 less class 0, the product of layer and vector) and the bias."""

    weights: np.ndarray
    bias: float


def _features(word: bytes) -> list[int]:
    """Table rows of a word: itself and its character n-grams, with marks at both ends."""
    crc, mask = zlib.crc32, (1 << TABLE_BITS) - 1
    marked = b"<" + word + b">"
    found = [crc(word, 1) & mask]
    for n in N_GRAMS:
        found += [crc(marked[i:i + n]) & mask for i in range(len(marked) - n + 1)]
    return found


def _crc_tables(n: int) -> np.ndarray:
    """What each byte at each of ``n`` places adds to the checksum of ``n`` zero bytes, by exclusive or."""
    zero = zlib.crc32(bytes(n))
    return np.array([[zlib.crc32(bytes(p) + bytes([b]) + bytes(n - 1 - p)) ^ zero for b in range(256)] for p in range(n)], np.uint32)


_CRC = {n: (np.uint32(zlib.crc32(bytes(n))), _crc_tables(n)) for n in N_GRAMS}


def _counted(word: bytes) -> np.ndarray:
    """How often each table row occurs in a long word: the counts of :func:`_features`, made in slices."""
    mask = (1 << TABLE_BITS) - 1
    marked = np.frombuffer(b"<" + word + b">", np.uint8)
    counts = np.zeros(1 << TABLE_BITS, np.int64)
    counts[zlib.crc32(word, 1) & mask] = 1
    for n, (zero, tables) in _CRC.items():
        for at in range(0, len(marked) - n + 1, SLICE):
            part = marked[at:at + SLICE + n - 1]
            sums = np.full(len(part) - n + 1, zero, np.uint32)
            for p in range(n):
                sums ^= tables[p][part[p:p + len(sums)]]
            counts += np.bincount(sums & np.uint32(mask), minlength=len(counts))
    return counts


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of a text and how often each occurs."""
    words = (text or "").encode().split()
    ids = [i for w in words if len(w) <= LONG_WORD for i in _features(w)] + [REPEATED] * sum(map(eq, words, words[1:]))
    rows, counts = np.unique(np.array(ids, np.int32), return_counts=True)
    large = Counter(w for w in words if len(w) > LONG_WORD)
    if large:
        total = np.zeros(1 << TABLE_BITS, np.int64)
        total[rows] = counts
        for w, times in large.items():
            total += times * _counted(w)
        rows = np.flatnonzero(total).astype(np.int32)
        counts = total[rows]
    return rows, counts.astype(np.float32)


def train(
    rows: list[np.ndarray], counts: list[np.ndarray], labels: np.ndarray, epochs: int = 6, rate: float = 0.5, seed: int = 7
) -> Model:
    """Stochastic gradient descent over documents, with a rate that falls linearly to zero."""
    size, rng = 1 << TABLE_BITS, np.random.default_rng(seed)
    if not len(labels):
        return Model(np.zeros(size, np.float32), 0.0)
    vectors = rng.uniform(-1 / DIMENSION, 1 / DIMENSION, (size, DIMENSION)).astype(np.float32)
    layer, bias = np.zeros((DIMENSION, 2), np.float32), np.zeros(2, np.float32)
    share = [c / (PRIOR + c.sum()) for c in counts]
    done, total = 0, epochs * len(labels)
    for _ in range(epochs):
        for k in rng.permutation(len(labels)):
            step = rate * (1 - done / total)
            done += 1
            mean = share[k] @ vectors[rows[k]]
            out = mean @ layer + bias
            out = np.exp(out - out.max())
            error = out / out.sum()
            error[labels[k]] -= 1
            back = layer @ error
            layer -= step * np.outer(mean, error)
            bias -= step * error
            vectors[rows[k]] -= (step * len(rows[k]) ** 0.5) * np.outer(share[k], back)
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` documents with one usable label: text and label. Of rows that repeat an id, the smallest text."""
    usable = labels.where("label IN (0, 1)").groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most"))
    # Ids first: the bounded choice is made before any text moves.
    chosen = usable.where("label = most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).select("doc_id", "label")
    rows = docs.select("doc_id", "text").join(F.broadcast(written(chosen, "chosen_labels")), "doc_id")
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).select("text", "label")


def fit(docs: DataFrame, labels: DataFrame, sample: int = 8_000, epochs: int = 6) -> Model:
    """A model from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1)."""

    @F.pandas_udf("rows array<int>, counts array<float>")
    def bags(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in parts:
            yield pd.DataFrame([bag(t) for t in texts], columns=["rows", "counts"])

    def learn(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frames = [p for p in parts if len(p)]
        if frames:
            rows, counts = ([np.asarray(x) for f in frames for x in f[c]] for c in ("rows", "counts"))
            model = train(rows, counts, np.concatenate([f["label"].to_numpy() for f in frames]), epochs)
            yield pd.DataFrame({"weights": [model.weights], "bias": [model.bias]})

    ship(docs.sparkSession)
    # Sorted by hash within the one task, so that the descent meets the documents in the same order every time.
    made = training_rows(docs, labels, sample).select(
        F.xxhash64("text").alias("h"), "label", bags("text").alias("bag")
    ).select("h", F.col("bag.rows").alias("rows"), F.col("bag.counts").alias("counts"), F.col("label").cast("int").alias("label"))
    made = written(made, "training_bags")
    out = made.coalesce(1).sortWithinPartitions("h", "label").select("rows", "counts", "label").mapInPandas(
        learn, "weights array<float>, bias double"
    ).first()
    if out is None:
        return Model(np.zeros(1 << TABLE_BITS, np.float32), 0.0)
    return Model(np.array(out["weights"], np.float32), out["bias"])


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``docs`` with score (probability of class 1) and predicted (1 if the score reaches the threshold)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias, known = shared.value.weights, shared.value.bias, {}
        for texts in parts:
            scores = []
            for text in texts:
                total, n = 0.0, 0
                words = text.encode().split() if text else []
                missing = set(words).difference(known)
                if len(known) + len(missing) > KEPT_WORDS:
                    known.clear()
                    missing = set(words)
                large = [w for w in missing if len(w) > LONG_WORD]
                for w in missing.difference(large) if large else missing:
                    ids = _features(w)
                    known[w] = (float(weights[ids].sum()), len(ids))
                for w in large:
                    counts = _counted(w)
                    known[w] = (float(counts @ weights), int(counts.sum()))
                for s, k in map(known.__getitem__, words):
                    total += s
                    n += k
                for w in large:
                    del known[w]
                repeats = sum(map(eq, words, words[1:]))
                mean = (total + repeats * weights[REPEATED]) / (PRIOR + n + repeats)
                scores.append(1 / (1 + np.exp(-np.clip(mean + bias, -500, 500))))
            yield pd.Series(scores, dtype="float64")

    columns = [quoted(c) for c in without(docs, *RESULTS)]
    return docs.select(*columns, of("text").alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
