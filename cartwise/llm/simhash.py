"""SimHash near-dedup: covering locality-sensitive hashing.

A text's fingerprint has a bit set if it is set in over half of the XXH64 hashes (seed 42) of its word shingles. Two
fingerprints are linked if they differ in at most ``radius`` bits, and linked documents form components.

For radius r every bit is given one of the 2^(r+1) - 1 non-zero vectors of r + 1 bits, and there is one mask
for each such vector v: it keeps the bits whose vector has an odd product with v. For any r bits some v is
orthogonal to all their vectors, so a pair within the radius agrees on all bits of at least one mask: every link
collides in some table, with certainty. A mask keeps more than half of the bits, so chance collisions are rare.

Equal fingerprints are one row from the start. A bucket of up to ``BUCKET`` fingerprints is searched in one task,
which emits links that connect what is connected (one per fingerprint at most) and not all pairs. A larger bucket is
never gathered: each of its fingerprints is sent with at most one of the unmasked bits flipped; two of them meet at a
flipped value only if they are within the radius, a value gathers 65 at most, and all of them are linked to one.
Components come from alternating star contractions, whose edge tables are written in every round.

Defined results: a null text has no words; no words give fingerprint zero, linked like any other. Rows that repeat a
``doc_id`` each come back with the fingerprint of their own text; ``one_per_group`` keeps one row of a component whatever repeats. Null ids take no part in ``component_id``, which is null
if all ids of a component are. Extra columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import carried, ship, written

BITS = 64
BUCKET = 4_096
SEED = 42


def _fingerprint(text: str | None, shingle: int) -> int:
    """Fingerprint as a signed 64-bit integer."""
    words = text.encode().lower().split() if text else []  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = [0, *(ends[:n - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(data[a:b], SEED) for a, b in zip(begins, ends[-n:].tolist())]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 65_536):
        part = np.array(hashes[at:at + 65_536], ">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with the column ``__fp``: the fingerprint of ``text`` as a signed integer."""

    @F.pandas_udf("bigint")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series([_fingerprint(t, shingle) for t in texts], dtype="int64")

    ship(docs.sparkSession)
    return docs.withColumn("__fp", of("text"))


def covering_masks(radius: int) -> list[int]:
    """Masks (as signed 64-bit integers) one of which keeps none of any ``radius`` bits."""
    n = 2 ** (radius + 1) - 1
    masks = [sum(1 << b for b in range(BITS) if (b % n + 1 & v).bit_count() % 2) for v in range(1, n + 1)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect the values of a bucket as far as they are connected within the radius."""
    links, rest = [], values
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                links += [(int(x), int(y)) for y in rest[near]]
                frontier += list(rest[near])
                rest = rest[~near]
    return links


def _search(radius: int):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for bucket in batch.column("fps"):
                links += _forest(bucket.values.to_numpy().view(np.uint64), radius)
            ends = np.array(links, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_pydict({"a": pa.array(ends[:, 0]), "b": pa.array(ends[:, 1])})

    return search


def _links_of_large(rows: DataFrame, masks: list[int], radius: int) -> DataFrame:
    """Links inside large buckets through values with at most one unmasked bit flipped."""
    if radius == 0:
        return rows.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    flips = [[0, *(1 << b if b < BITS - 1 else -(1 << BITS - 1) for b in range(BITS) if not m >> b & 1)] for m in masks]
    table = F.array(*(F.array(*(F.lit(x).cast("long") for x in f)) for f in flips))
    near = rows.select("fp", F.explode(F.get(table, F.col("t"))).alias("flip")).select(
        "fp", (F.col("flip") != 0).alias("flipped"), F.col("fp").bitwiseXOR(F.col("flip")).alias("value")
    ).distinct()
    met = near.groupBy("value").agg(  # 65 at most, as they are distinct and within one bit
        F.collect_set("fp").alias("fps"), F.min(F.when(~F.col("flipped"), F.col("fp"))).alias("centre")
    ).where(F.size("fps") > 1)
    # Two fingerprints one flip away from a value differ in two bits; within radius 1 only the value itself is linked.
    centre = F.array_min("fps") if radius == 2 else F.col("centre")
    return met.select(centre.alias("a"), F.explode("fps").alias("b")).where("a <> b").distinct()


def links(fps: DataFrame, radius: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that give all components within the radius."""
    if not 0 <= radius <= 2:
        raise ValueError("the radius is 0, 1 or 2")
    ship(fps.sparkSession)
    masks = covering_masks(radius)
    tables = F.array(*(
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key")) for t, m in enumerate(masks)
    ))
    rows = fps.select("fp", F.explode(tables).alias("x")).select("fp", "x.t", "x.key")
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = written(rows.join(sizes, ["t", "key"]), "simhash_buckets")
    small = met.where(F.col("n") <= bucket).groupBy("t", "key").agg(F.collect_list("fp").alias("fps"))
    found = small.select("fps").mapInArrow(_search(radius), "a bigint, b bigint")
    return found.unionByName(_links_of_large(met.where(F.col("n") > bucket), masks, radius)).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b): the root is the smallest node of the component.

    Star contractions in turn: every node's larger neighbours, then its smaller ones, are hung on its smallest
    neighbour, until nothing changes. The number of rounds grows with the logarithm of the longest chain.
    """
    def hung(directed: DataFrame) -> DataFrame:
        least = directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
        return directed.join(least, "u")

    edges, last = written(edges.select("a", "b").where("a <> b"), "links"), None
    while True:
        ends = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        both = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = hung(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()
        small = hung(large)
        stars = small.select(F.col("v").alias("a"), F.col("least").alias("b")).unionByName(
            small.select(F.col("u").alias("a"), F.col("least").alias("b"))
        ).where("a <> b").distinct()
        edges = written(stars, "stars")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == last:
            break
        last = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _marked(docs: DataFrame, shingle: int, radius: int) -> DataFrame:
    """Every row's doc_id, text_hash, fingerprint (__fp), root fingerprint and component_id."""
    rows = fingerprints(docs.select("doc_id", "text"), shingle).select("doc_id", F.xxhash64("text").alias("text_hash"), "__fp")
    rows = written(rows, "fingerprints")
    fps = rows.groupBy(F.col("__fp").alias("fp")).agg(F.min("doc_id").alias("first"))
    roots = components(links(fps, radius))
    named = fps.join(roots, fps.fp == roots.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = named.join(least, "root").select(F.col("fp").alias("__fp"), "root", "component_id")
    return rows.join(by_fp, "__fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (smallest doc_id of its component) of every row."""
    return _marked(docs, shingle, radius).select(
        "doc_id", F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_group(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """The one row of each component that stays: that of the smallest doc_id (a null one is the largest).

    Of rows that share this doc_id the one of the smaller text hash stays, and of rows that share the text as well the
    smallest in order of its columns. Such repeated rows are reduced on the map side, so a row that is repeated very often
    makes no hot task.
    """
    places = _marked(docs, shingle, radius).groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("rows"))
    stays = written(places.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "rows")).alias("x")
    ).select("x.doc_id", "x.text_hash", "x.rows"), "kept_documents")

    def of(these: DataFrame):
        return docs["doc_id"].eqNullSafe(these["doc_id"]) & (F.xxhash64(docs["text"]) == these["text_hash"])

    single, repeated = stays.where("rows = 1"), stays.where("rows > 1")
    kept = docs.join(single, of(single), "left_semi")
    if repeated.isEmpty():
        return kept
    copies = docs.join(repeated, of(repeated), "left_semi").select("doc_id", F.xxhash64("text").alias("hash"), carried(docs))
    return kept.unionByName(copies.groupBy("doc_id", "hash").agg(F.min("row").alias("row")).select("row.*"))
