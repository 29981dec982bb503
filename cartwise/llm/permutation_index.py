"""Approximate nearest neighbours: a permutation index.

A bounded sample of vectors are the pivots. Every vector is represented by its nearest pivots in order. The index is cut
into blocks by a hash of the id; each block has an inverted file per pivot, with the vectors that have it among their
nearest and its rank there. A query fetches the files of its own nearest pivots, and what it finds is ranked by the
footrule distance of the two orders (a pivot that one side lacks counts as standing just after its last). The best
``share`` of a block is reranked by the exact inner product in double precision.

A pivot's place in an order says nothing about a vector's length, but the inner product does. So for the pivots all vectors
are evened: one more component brings each to the length of the longest, and queries get a zero there, which leaves
their products as they are. Then the largest product is the smallest angle, which the orders of pivots follow.

The stated queries meet the index in blocks: a task holds one block of vectors and one of queries, both of
bounded size; block numbers grow with the tables. Hashed ids keep blocks even, so equal vectors make no hot block.

The share is a fraction of every block at any size, all that tie with its last are reranked too (near copies have one
order of pivots), and no candidate list is capped by a number. Vectors that
share no pivot with a query are not found; if fewer than ``k`` of a block share one, the whole block is reranked.

Defined results: a null id or vector, a zero vector, null or non-finite components, and another number of components than
the most frequent one (the largest of several) take no part. Of rows that repeat an id, the smallest vector stands. Equal scores go to the
smaller id. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwise.llm.shared import ship, written

PIVOTS = 128
NEAREST = 48
SHARE = 0.4
BLOCK, QUERY_BLOCK = 16_384, 4_096
FOUND = "query_id bigint, vec_id bigint, score double"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles), one row per id, of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select("vec_id", v.alias("embedding"))
    rows = rows.where(fine).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    rows = written(rows, "vectors")
    common = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("embedding") == (common[0]["n"] if common else 0))


def longest_of(rows: DataFrame) -> float:
    """Length of the longest vector."""
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x))
    return rows.agg(F.max(length)).first()[0] or 0.0


def evened(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component that brings all of them to the length of the longest."""
    rest = np.maximum(longest * longest - np.einsum("ij,ij->i", vectors, vectors), 0)
    return np.concatenate([vectors, np.sqrt(rest)[:, None]], axis=1)


def choose_pivots(rows: DataFrame, n: int = PIVOTS, longest: float | None = None) -> np.ndarray:
    """``n`` vectors of the smallest hash of their id, evened and at length one: a sample of fixed size."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(n).select("embedding").collect()
    if not sample:
        return np.empty((0, 0))
    pivots = evened(np.array([r[0] for r in sample], np.float64), longest_of(rows) if longest is None else longest)
    return pivots / np.linalg.norm(pivots, axis=1, keepdims=True)


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """Numbers of each vector's nearest pivots, nearest first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :nearest]


def search_block(
    ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, pivots: np.ndarray,
    nearest: int, share: float, k: int, longest: float,
) -> pd.DataFrame:
    """The best ``k`` of one block for each query, by the method above."""
    nearest = min(nearest, len(pivots))
    ranks = nearest_pivots(evened(vectors, longest), pivots, nearest)
    files = []  # per pivot: the vectors posted there, and their ranks
    for p in range(len(pivots)):
        rows, rank = np.nonzero(ranks == p)
        files.append((rows, rank.astype(np.int16)))
    budget = max(k + 1, int(np.ceil(share * len(ids))))
    out = []
    for q, vector, own in zip(query_ids, queries, nearest_pivots(np.pad(queries, ((0, 0), (0, 1))), pivots, nearest)):
        # Footrule less its largest value: a shared pivot saves both absences and costs the difference of ranks.
        saved = np.zeros(len(ids), np.int16)
        for mine, p in enumerate(own):
            rows, rank = files[p]
            saved[rows] += (2 * nearest - mine - rank - np.abs(rank - mine)).astype(np.int16)
        found = np.flatnonzero(saved)
        if len(found) <= k:
            found = np.arange(len(ids))
        elif len(found) > budget:
            cut = -np.partition(-saved[found], budget - 1)[budget - 1]
            found = found[saved[found] >= cut]
        found = found[ids[found] != q]
        rough = vectors[found] @ vector
        if len(found) > k:  # what the last bits of a matrix product cannot bring among the best
            found = found[rough >= -np.partition(-rough, k - 1)[k - 1] - 1e-9 * np.abs(rough).max()]
        # Row by row in one order, so that equal vectors have equal scores wherever they stand.
        scores = np.einsum("ij,j->i", vectors[found], vector)
        best = np.lexsort((ids[found], -scores))[:k]
        out.append((np.full(len(best), q), ids[found[best]], scores[best]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 2 + [np.empty(0)]
    return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))


def search(
    vectors: DataFrame, k: int = 20, every: int = 20, pivots: int = PIVOTS, nearest: int = NEAREST, share: float = SHARE,
    block: int = BLOCK, query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``k`` nearest found for every id divisible by ``every``: query_id, rank, vec_id, score."""
    ship(vectors.sparkSession)
    rows = usable(vectors)
    longest = longest_of(rows)
    chosen = choose_pivots(rows, pivots, longest)
    queries = rows.where(F.col("vec_id") % every == 0)
    n, m = (max(1, -(-t.count() // size)) for t, size in ((rows, block), (queries, query_block)))

    def part(parts: int, salt: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(parts)).cast("int")

    def spread(parts: int):
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    index = rows.select("vec_id", "embedding", part(n, 1).alias("block"), spread(m).alias("queries"))
    asked = queries.select("vec_id", "embedding", spread(n).alias("block"), part(m, 2).alias("queries"))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> Iterator[pd.DataFrame] | pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return search_block(
            left["vec_id"].to_numpy(), np.stack(left["embedding"]), right["vec_id"].to_numpy(), np.stack(right["embedding"]),
            chosen, nearest, share, k, longest,
        )

    found = index.groupBy("block", "queries").cogroup(asked.groupBy("block", "queries")).applyInPandas(cell, FOUND)
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
