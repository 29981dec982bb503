"""Benchmark decontamination by a prefix-filtered set join.

A window of an item is ``window`` consecutive words; an item of fewer words is one window. A window occurs in a
document only if all its shingles (three words, or the whole window if shorter) do, so it is enough to look for one of
them: the rarest. The steps are

1. tokens: shingles of the documents that occur in the benchmark, as (document, position, hash), written once;
2. rarity: their counts over all documents;
3. prefix: for each window its rarest shingle; windows of an item that share one form a range;
4. candidates: tokens joined to the prefixes, with the length bound (the window must end inside the document) and the
   positional bound (it must begin at the shingle's place less its place in the window);
5. verification: the item-sized piece of the document around the shingle is compared word for word;
6. per document, the union of the hit windows and the items.

Only the benchmark's shingles and prefixes are ever broadcast, and only within a counted bound; otherwise the joins
shuffle, and AQE splits a frequent shingle. The text of a document moves only if it has candidates. Words are
cut out of the document before candidates are exploded, so no row carries a whole document.

Defined results: a null text has no words and no hits. An item without words has no window. Items of equal words
share their work, and each counts; an item without id marks words but is not listed. Rows that repeat a ``doc_id`` are
judged each by its own text. Columns named like the results are replaced; empty tables give no hits or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import BROADCAST_ROWS, ascii_lower, broadcast_if_small, carried, written

#: Characters between words: ASCII other than digits and lower-case letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 3
RESULTS = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")


def words_of(text: Column) -> Column:
    """Words of a text, A-Z in lower case; none for null."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BETWEEN, -1), "")


def _shingles(words: Column, size: int) -> Column:
    """Hash of every ``size`` consecutive words, by position."""
    first = F.slice(words, F.lit(1), F.greatest(F.size(words) - size + 1, F.lit(0)))
    return F.transform(first, lambda w, i: F.xxhash64(w, *(F.get(words, i + k) for k in range(1, size))))


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words_of(F.col("text")).alias("words"))


def _texts(benchmark: DataFrame, window: int) -> DataFrame:
    """One row per distinct item text: words, ids, and the lengths of its windows and shingles."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    return items.groupBy("words").agg(F.collect_set("item_id").alias("item_ids")).select(
        F.xxhash64("words").alias("t1"), F.xxhash64(F.lit(1), "words").alias("t2"), "words", "item_ids",
        F.size("words").alias("n"), F.least(F.size("words"), F.lit(window)).alias("length"),
        F.least(F.size("words"), F.lit(SHINGLE)).alias("size"),
    )


def _item_shingles(texts: DataFrame) -> DataFrame:
    """Shingles of the item texts: hash, place and which windows hold it (their first words lo..hi)."""
    hashes = F.when(F.col("size") == SHINGLE, _shingles(F.col("words"), SHINGLE))
    for size in range(1, SHINGLE):
        hashes = hashes.when(F.col("size") == size, _shingles(F.col("words"), size))
    return texts.select("t1", "t2", "n", "length", "size", F.posexplode(hashes).alias("place", "hash")).select(
        "t1", "t2", "length", "size", "place", "hash",
        F.greatest(F.lit(0), F.col("place") + F.col("size") - F.col("length")).alias("lo"),
        F.least(F.col("place"), F.col("n") - F.col("length")).alias("hi"),
    )


def _tokens(docs: DataFrame, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """Positions of the benchmark's shingles in the documents."""
    rows = _documents(docs).withColumn("n_words", F.size("words"))
    known = broadcast_if_small(written(shingles.select("size", "hash").distinct(), "item_shingles"))
    found = None
    for size in sizes:
        own = rows.select(
            "doc_id", "text_hash", "n_words", F.posexplode(_shingles(F.col("words"), size)).alias("pos", "hash")
        ).join(known.where(F.col("size") == size).select("hash", "size"), "hash")
        found = own if found is None else found.unionByName(own)
    return found


def _prefixes(shingles: DataFrame, tokens: DataFrame) -> DataFrame:
    """The rarest shingle of every window, as ranges of windows lo..hi of an item text that share it.

    A window with a shingle that no document has cannot occur, and is left out.
    """
    counts = tokens.groupBy("size", "hash").agg(F.count("*").alias("found"))
    windows = shingles.join(counts, ["size", "hash"], "left").select(
        "t1", "t2", "length", F.explode(F.sequence("lo", "hi")).alias("start"),
        F.struct(F.coalesce("found", F.lit(0)).alias("found"), "hash", "place", "size").alias("rank"),
    )
    rarest = windows.groupBy("t1", "t2", "length", "start").agg(F.min("rank").alias("rank"))
    return rarest.where(F.col("rank.found") > 0).groupBy(
        "t1", "t2", "length", F.col("rank.size").alias("size"), F.col("rank.hash").alias("hash"),
        F.col("rank.place").alias("place"),
    ).agg(F.min("start").alias("lo"), F.max("start").alias("hi"))


def _candidates(tokens: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Per document, the item texts to compare: the document's word ``shift`` stands at the item's first word."""
    found = tokens.join(prefixes, ["size", "hash"]).withColumn("shift", F.col("pos") - F.col("place"))
    found = found.withColumn("lo", F.greatest("lo", -F.col("shift"))).withColumn(
        "hi", F.least("hi", F.col("n_words") - F.col("length") - F.col("shift"))
    )
    return found.where("lo <= hi").groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.struct("t1", "t2", "shift", "lo", "hi", "length")).alias("candidates")
    )


def _verified(docs: DataFrame, candidates: DataFrame, texts: DataFrame) -> DataFrame:
    """Windows that do occur: document, first word, length and the ids of the item."""
    candidates = written(candidates, "candidates")
    ids = candidates.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__own"))
    if ids.count() <= BROADCAST_ROWS:  # few: only their texts are split and moved
        docs = docs.join(
            F.broadcast(ids), docs["doc_id"].eqNullSafe(ids["__id"]) & (F.xxhash64(docs["text"]) == ids["__own"]), "left_semi"
        )
    rows = _documents(docs).alias("d").join(
        candidates.alias("c"),
        F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col("d.text_hash").eqNullSafe(F.col("c.text_hash")),
    )
    pieces = rows.select("d.doc_id", "d.text_hash", "words", F.size("words").alias("n_words"), "candidates").select(
        "doc_id", "text_hash", "n_words", F.explode(F.transform("candidates", lambda c: F.struct(
            c.alias("c"),
            F.slice(F.col("words"), c["shift"] + c["lo"] + 1, c["hi"] - c["lo"] + c["length"]).alias("piece"),
        ))).alias("x"),
    ).select("doc_id", "text_hash", "n_words", "x.c.*", "x.piece")
    starts = F.filter(F.sequence("lo", "hi"), lambda w: F.slice(
        F.col("piece"), w - F.col("lo") + 1, F.col("length")
    ) == F.slice(F.col("words"), w + 1, F.col("length")))
    return pieces.join(texts.select("t1", "t2", "words", "item_ids"), ["t1", "t2"]).select(
        "doc_id", "text_hash", "n_words", "length", "item_ids", "shift", F.explode(starts).alias("start")
    ).select("doc_id", "text_hash", "n_words", (F.col("shift") + F.col("start")).alias("start"), "length", "item_ids")


def _covered(windows: Column) -> Column:
    """Number of words in the union of (start, length) windows, sorted by start."""
    zero = F.struct(F.lit(0).alias("words"), F.lit(0).alias("end"))
    return F.aggregate(windows, zero, lambda acc, w: F.struct(
        (acc["words"] + F.greatest(
            F.lit(0), w["start"] + w["length"] - F.greatest(acc["end"], w["start"])
        )).alias("words"),
        F.greatest(acc["end"], w["start"] + w["length"]).alias("end"),
    ), lambda acc: acc["words"])


def hits(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """Documents with occurring windows: doc_id, text_hash, n_words, n_hit and the sorted item ids (as strings)."""
    texts = written(_texts(benchmark, window), "item_texts")
    shingles = _item_shingles(texts)
    sizes = sorted(r[0] for r in texts.select("size").distinct().collect()) or [SHINGLE]
    tokens = written(_tokens(docs, shingles, sizes), "item_tokens")
    prefixes = broadcast_if_small(written(_prefixes(shingles, tokens), "item_prefixes"))
    found = _verified(docs, _candidates(tokens, prefixes), texts)
    return found.groupBy("doc_id", "text_hash").agg(
        F.first("n_words").cast("long").alias("n_words"),
        _covered(F.sort_array(F.collect_set(F.struct("start", "length")))).cast("long").alias("n_hit"),
        F.array_sort(F.transform(
            F.array_distinct(F.flatten(F.collect_set("item_ids"))), lambda x: x.cast("string")
        )).alias("item_ids"),
    )


def mark(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, item_ids and contaminated (``share`` x n_hit >= n_words, n_hit > 0)."""
    found = written(hits(docs, benchmark, window), "hits")
    rows = docs.select(
        carried(docs, *RESULTS), "doc_id", F.xxhash64("text").alias("hash"),
        F.size(words_of(F.col("text"))).cast("long").alias("n_words"),
    )
    right = found.drop("n_words").withColumnsRenamed({"doc_id": "hit_id"})
    joined = rows.join(right, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("hash") == F.col("text_hash")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return joined.select(
        "row.*", "n_words", n_hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, share: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated; only the contaminated ones are looked up by id."""
    dirty = hits(docs, benchmark, window).where(share * F.col("n_hit") >= F.col("n_words")).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__own")
    )
    dirty = written(dirty, "contaminated")
    same = docs["doc_id"].eqNullSafe(dirty["__id"]) & (F.xxhash64(docs["text"]) == dirty["__own"])
    return docs.join(broadcast_if_small(dirty), same, "left_anti")
