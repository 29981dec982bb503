"""Vector code compression: every part of a vector becomes the number of its nearest codebook entry, found by Orchard's search.

Vectors become integers (floor of ``scale`` times each component) and are cut into ``parts`` equal consecutive parts. Each
part position has a codebook of ``entries`` entries, which starts as that part of the vectors of the smallest ids.
A round assigns every part to its nearest entry and moves every entry to the floored mean of its parts.

Orchard's search finds the nearest entry exactly. Every entry has a list of all entries by their distance from it. A search
holds the best entry so far and walks its list; an entry already visited is skipped, an improvement jumps to the head of the
improved entry's list, and the walk ends at the first entry further than twice the current distance, as no entry from there on
can be as near (squares are compared: more than four times). Ties go to the lower index, so an entry at exactly twice the
distance is still visited. All parts of a batch walk together in numpy, and those that have ended leave.

Spark holds the work: the integers are written once; a round is one pass in which a task adds up its own parts, so a
round returns one row per component of the codebooks and task, summed by Spark; the codebooks (parts x entries x width
numbers) are all that the driver sees. Nothing is gathered by key, so copies and common vectors make no hot task.

Defined results: a vector that is null or holds a null or a component that is not finite is dropped. Vectors of another
length than the most frequent one (the longest of several) are dropped too; a length that ``parts`` does not divide is
an error, and so is a component too large for its squared distances to fit 64 bits (about 20,000 at 64 dimensions). Rows
that repeat an id each come back; the codebook takes one vector per id, the smallest in order of components. A null id is
coded but never starts an entry. With fewer ids than entries the codebook has as many entries as ids; without any id the
result is empty. Columns other than ``embedding`` are carried, those named like the results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import quoted, ship, without, written

CHUNK = 8_192
RESULTS = ("code", "error")


def integers(vectors: DataFrame, parts: int = 8, scale: int = 4096) -> DataFrame:
    """A written table of the kept rows: the other columns as struct ``row``, ``vec_id``, and ``ints``."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    carried = [quoted(c) for c in without(vectors, "embedding", *RESULTS)]
    rows = vectors.select(F.struct(*carried).alias("row"), "vec_id", v.alias("embedding")).where(
        F.col("embedding").isNotNull() & fine
    )
    common = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    n = common[0]["n"] if common else 0
    if n % parts:
        raise ValueError(f"vectors of {n} components cannot be cut into {parts} equal parts")
    limit = math.isqrt((2**63 - 1) // (16 * max(n, 1)))
    one = F.transform("embedding", lambda x: F.floor(x * scale))
    checked = F.when(F.forall(one, lambda x: F.abs(x) <= limit), one.cast("array<int>")).otherwise(
        F.raise_error(F.lit(f"a component times {scale} is beyond {limit}, so that its distances overflow")).cast("array<int>")
    )
    return written(rows.where(F.size("embedding") == n).select("row", "vec_id", checked.alias("ints")), "vector_integers")


def first_entries(rows: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Codebooks of the smallest ids: an array of parts x entries x width."""
    ids = [r[0] for r in rows.where("vec_id IS NOT NULL").select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    first = rows.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("ints").alias("ints")).collect() if ids else []
    whole = np.array([r.ints for r in sorted(first, key=lambda r: r.vec_id)], np.int64)
    return whole.reshape(len(first), parts, -1).swapaxes(0, 1) if whole.size else np.zeros((parts, len(first), 0), np.int64)


class Orchard:
    """Nearest entries of parts of vectors."""

    def __init__(self, books: np.ndarray):
        self.books = books
        apart = ((books[:, :, None, :] - books[:, None, :, :]) ** 2).sum(axis=3)
        #: For every part and entry: all entries by their distance from it, and these squared distances.
        self.lists = np.argsort(apart, axis=2, kind="stable")
        self.apart = np.take_along_axis(apart, self.lists, axis=2)
        self.evaluated = 0

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances, both rows x parts, of integer vectors (rows x parts x width)."""
        n, parts, width = vectors.shape
        points, part = vectors.reshape(n * parts, width), np.tile(np.arange(parts), n)
        best, at = np.zeros(n * parts, np.int64), np.zeros(n * parts, np.int64)
        distance = ((points - self.books[part, 0]) ** 2).sum(axis=1)
        visited = np.zeros((n * parts, self.books.shape[1]), bool)
        visited[:, 0] = True
        walking = np.arange(n * parts)
        while len(walking):
            where = part[walking], best[walking], at[walking]
            walking, entry = (x[self.apart[where] <= 4 * distance[walking]] for x in (walking, self.lists[where]))
            at[walking] += 1
            new = ~visited[walking, entry]
            point, entry = walking[new], entry[new]
            visited[point, entry] = True
            found = ((points[point] - self.books[part[point], entry]) ** 2).sum(axis=1)
            self.evaluated += len(point)
            better = (found < distance[point]) | ((found == distance[point]) & (entry < best[point]))
            point, entry, found = point[better], entry[better], found[better]
            best[point], distance[point], at[point] = entry, found, 0
            walking = walking[at[walking] < self.books.shape[1]]
        return best.reshape(n, parts), distance.reshape(n, parts)


def _chunks(column: pa.Array, parts: int) -> Iterator[np.ndarray]:
    for at in range(0, len(column), CHUNK):
        part = column.slice(at, CHUNK)
        yield part.flatten().to_numpy().astype(np.int64).reshape(len(part), parts, -1)


def _adder(books: np.ndarray):
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Orchard(books)
        parts, entries, width = books.shape
        totals = np.zeros((parts, entries, width + 1), np.int64)  # the last is the number of parts
        for batch in batches:
            for vectors in _chunks(batch.column("ints"), parts):
                codes, _ = search.nearest(vectors)
                for p in range(parts):
                    np.add.at(totals[p, :, :width], codes[:, p], vectors[:, p])
                    totals[p, :, width] += np.bincount(codes[:, p], minlength=entries)
        flat = totals.reshape(-1)
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(used, pa.int64()), "total": pa.array(flat[used], pa.int64())})

    return add


def moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all rows."""
    sums = rows.select("ints").mapInArrow(_adder(books), "cell bigint, total bigint")
    totals = np.zeros((*books.shape[:2], books.shape[2] + 1), object)
    flat = totals.reshape(-1)
    for r in sums.groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect():
        flat[r.cell] = int(r.total)  # a Python integer: exact at any number of rows
    out = books.copy()
    for p, e in zip(*np.nonzero(totals[:, :, -1])):
        out[p, e] = totals[p, e, :-1] // totals[p, e, -1]
    return out


def fit(rows: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6) -> np.ndarray:
    """Codebooks (parts x entries x width) of the table that :func:`integers` wrote."""
    if not 1 <= entries <= 256:
        raise ValueError("a codebook has 1 to 256 entries, as a code is one byte per part")
    ship(rows.sparkSession)
    books = first_entries(rows, parts, entries)
    for _ in range(rounds if books.size else 0):
        books = moved(rows, books)
    return books


def encode(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """The carried columns, ``code`` (one byte per part) and ``error`` (squared distance over all parts) of every row."""
    ship(rows.sparkSession)
    parts = books.shape[0]
    if not books.shape[1]:
        rows = rows.limit(0)

    @F.arrow_udf("code binary, error bigint")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        search = Orchard(books)
        for column in columns:
            codes, errors = [], []
            for vectors in _chunks(column, parts):
                found, distance = search.nearest(vectors)
                codes += map(bytes, found.astype(np.uint8))
                errors.append(distance.sum(axis=1))
            yield pa.StructArray.from_arrays(
                [pa.array(codes, pa.binary()), pa.array(np.concatenate(errors) if errors else [], pa.int64())], list(RESULTS)
            )

    return rows.select("row", of("ints").alias("coded")).select("row.*", "coded.*")


def decode(coded: DataFrame, books: np.ndarray, scale: int = 4096) -> DataFrame:
    """``coded`` with the vector that its ``code`` stands for, as ``approximate``."""
    table = (books / scale).astype(np.float32)

    @F.arrow_udf("array<float>")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            codes = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
            vectors = table[np.arange(codes.shape[1]), codes].reshape(len(column), -1)
            ends = np.arange(len(column) + 1, dtype=np.int32) * vectors.shape[1]
            yield pa.ListArray.from_arrays(ends, vectors.reshape(-1))

    ship(coded.sparkSession)
    return coded.select(*(quoted(c) for c in without(coded, "approximate")), of("code").alias("approximate"))


def compress(
    vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096
) -> tuple[DataFrame, np.ndarray]:
    """``vectors`` without ``embedding`` but with ``code`` and ``error``, and the codebooks."""
    rows = integers(vectors, parts, scale)
    books = fit(rows, parts, entries, rounds)
    return encode(rows, books), books
