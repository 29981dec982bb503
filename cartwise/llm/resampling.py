"""Target-distribution importance resampling: documents weighed by hashed word features, by bit-sliced aggregation, then drawn.

A text's features are its runs of 1 to ``max_words`` consecutive words; a feature's bucket is its CRC-32 modulo ``buckets``.
A bucket's gain says, in thousandths of a natural logarithm, how much more frequent it is in the target texts than in the
documents. A document's weight is the floored mean of its features' gains.

The sums are bit-sliced. A document's bucket counts become planes of ``buckets`` bits: plane i holds bit i of every count.
The gains become planes in two's complement, the last of which counts negatively. AND of a plane of counts and a plane of gains,
the number of ones in it, and two to the sum of their numbers give one term; the terms add up to the exact sum of gains over all
features in integers, whatever the order. Only documents that have a count of 2^i or more have a plane i.

Spark holds the work. Corpus and target counts are one pass in which a task adds up its own counts, so it returns ``buckets`` rows
at most, summed by Spark; the driver sees one number per bucket, and a task gets the same back. Texts are not shuffled.

The draw adds Gumbel noise made from each id, and takes the highest scores. Ranks need no single sort: documents are
counted by score (at most as many rows as scores can differ, some 100,000, since gains and noise are bounded
logarithms), which gives every score the number of documents above it; documents of one score are ordered among
themselves, equal rows as one row with a count. Only scores that are reached are ordered at all.

Defined results: a null or empty text has no features, weight 0. A null ``doc_id`` draws noise as the empty id does and stands
after all others of its score. Rows that repeat an id are documents of their own; of the same score, those with more features come
first, then those of less weight, and equal rows have consecutive ranks. Empty documents give an empty result; an empty
target has counts of zero. Long texts are read in pieces. Extra columns are carried by :func:`weigh`, whose results
replace columns of their names, and left out by :func:`draw`.
"""

from __future__ import annotations

import math
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.shared import quoted, ship, without, written

PIECE = 1 << 20
KEPT_FEATURES = 200_000
RESULTS = ("n_words", "n_features", "weight")
#: Equal rows that one row stands for until they are spread.
SPREAD = 10_000

#: ASCII letters in lower case and digits stay, as do all bytes from 128 on; the rest parts words.
_WORD = bytes(
    ord(chr(b).lower()) if b > 127 or chr(b) in string.ascii_letters + string.digits and b < 128 else 32 for b in range(128)
) + bytes(range(128, 256))


class Features(dict):
    """Buckets of features; kept for the features met, up to a bound."""

    def __init__(self, buckets: int, max_words: int):
        self.buckets, self.max_words = buckets, max_words

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= KEPT_FEATURES:
            self.clear()
        found = self[feature] = zlib.crc32(feature) % self.buckets
        return found

    def count(self, text: str | None) -> tuple[int, np.ndarray]:
        """Number of words of a text, and the number of its features per bucket."""
        counts, n_words, tail = np.zeros(self.buckets, np.int64), 0, []
        for words in _words(text):
            n_words += len(words)
            numbers = list(map(self.__getitem__, words))
            words = tail + words
            for n in range(2, self.max_words + 1):
                # Runs that end in this piece: those inside the tail were counted with the last one.
                ends = range(max(n, len(tail) + 1), len(words) + 1)
                numbers += [self[b" ".join(words[e - n:e])] for e in ends]
            counts += np.bincount(np.array(numbers, np.int64), minlength=self.buckets)
            tail = words[len(words) - min(len(words), self.max_words - 1):]
        return n_words, counts


def _words(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text, a piece at a time."""
    data = (text or "").encode().translate(_WORD)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def bucket_counts(texts: DataFrame, buckets: int, max_words: int) -> np.ndarray:
    """Number of features per bucket over all rows of ``text``."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(buckets, max_words), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column("text"):
                total += features.count(text.as_py())[1]
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used, pa.int64()), "n": pa.array(total[used], pa.int64())})

    ship(texts.sparkSession)
    sums = texts.select("text").mapInArrow(add, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in sums.collect():  # one row per bucket
        out[r.bucket] = r.n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of every bucket from the counts of documents and target, each smoothed by one feature per bucket."""
    buckets, all_documents, all_target = len(documents), int(documents.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(
            float(t + 1) * float(all_documents + buckets) / (float(s + 1) * float(all_target + buckets))
        )) for s, t in zip(documents.tolist(), target.tolist())
    ], np.int64)


def plane(bits: np.ndarray) -> np.ndarray:
    """Rows of zeros and ones as rows of 64-bit words."""
    packed = np.packbits(bits.astype(bool), axis=-1)
    room = np.zeros((*packed.shape[:-1], -(-packed.shape[-1] // 8) * 8), np.uint8)
    room[..., :packed.shape[-1]] = packed
    return room.view(np.uint64)


def signed_planes(values: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Planes of integers in two's complement with the value of a one in each; the last is negative."""
    n = max(int(np.abs(values).max(initial=0)).bit_length(), 1)
    return [(1 << j, plane(values >> j & 1)) for j in range(n)] + [(-(1 << n), plane(values >> n & 1))]


def sliced_sums(counts: np.ndarray, gain_planes: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Sum of count times gain of every row of ``counts``."""
    top, total = counts.max(axis=1, initial=0), np.zeros(len(counts), np.int64)
    for i in range(int(top.max(initial=0)).bit_length()):
        rows = np.flatnonzero(top >> i)
        ones_of = plane(counts[rows] >> i & 1)
        for value, of_gain in gain_planes:
            total[rows] += (value << i) * np.bitwise_count(ones_of & of_gain).sum(axis=1, dtype=np.int64)
    return total


def weigh(docs: DataFrame, target: DataFrame, buckets: int = 10_000, max_words: int = 1, together: int = 256) -> DataFrame:
    """``docs`` with n_words, n_features and weight of ``text`` against the texts of ``target``; ``together`` documents are summed at once."""
    gain_planes = signed_planes(gains(bucket_counts(docs, buckets, max_words), bucket_counts(target, buckets, max_words)))

    @F.arrow_udf("n_words bigint, n_features bigint, weight bigint")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        features = Features(buckets, max_words)
        for column in columns:
            found = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for at in range(0, len(column), together):
                n_words, counts = zip(*(features.count(t.as_py()) for t in column.slice(at, together)))
                counts = np.stack(counts)
                n = counts.sum(axis=1)
                for out, values in zip(found, (n_words, n, sliced_sums(counts, gain_planes) // np.maximum(n, 1))):
                    out.append(np.array(values, np.int64))
            yield pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in found], list(RESULTS))

    columns = [quoted(c) for c in without(docs, *RESULTS)]
    rows = docs.select(F.struct(*columns).alias("row"), of("text").alias("found"))
    return rows.select("row.*", "found.*")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the id alone."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(weighed: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; rank is null for those that are not drawn.

    ``percent`` of the documents with at least ``least_words`` words are drawn, rounded down.
    """
    scored = weighed.select(
        "doc_id", "n_features", "weight", (F.col("weight") + noise(F.col("doc_id"), seed)).alias("score"),
        (F.col("n_words") >= least_words).alias("long_enough"),
    )
    scored = written(scored, "scores")
    by_score = written(scored.where("long_enough").groupBy("score").agg(F.count("*").alias("n")), "scores_counted")
    drawn = (by_score.agg(F.sum("n")).first()[0] or 0) * percent // 100
    # One row per score: bounded, whatever the number of documents.
    higher = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    reached = by_score.select("score", F.coalesce(F.sum("n").over(higher), F.lit(0)).alias("above")).where(F.col("above") < drawn)
    marked = scored.join(F.broadcast(reached), "score", "left")
    inside = F.col("long_enough") & F.col("above").isNotNull()
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = marked.where(~inside).select(*columns, F.lit(None).cast("long").alias("rank"))
    order = Window.partitionBy("score").orderBy(F.asc_nulls_last("doc_id"), F.desc("n_features"), "weight")
    equal = marked.where(inside).groupBy(*columns, "above").agg(F.count("*").alias("n"))
    first = equal.select(
        *columns, "n", (F.col("above") + F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before")
    )
    parts = first.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(SPREAD).cast("long"))).alias("from"))
    parts = parts.repartition("score", "doc_id", "from")
    ranked = parts.select(
        *columns, F.explode(F.sequence(
            F.col("before") + F.col("from") + 1, F.col("before") + F.least(F.col("n"), F.col("from") + SPREAD)
        )).alias("rank"),
    )
    return ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(rest)


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, seed: int = 2024, buckets: int = 10_000,
    max_words: int = 1,
) -> DataFrame:
    """The rows of ``docs`` whose id is drawn, or one of them if several rows share it; ids of null are left out."""
    drawn = draw(weigh(docs.select("doc_id", "text"), target, buckets, max_words), percent, least_words, seed)
    ids = drawn.where("rank IS NOT NULL").select(F.col("doc_id").alias("drawn id"))
    return docs.join(ids, docs["doc_id"] == ids["drawn id"], "left_semi")
