"""Line dedup: lines found in many documents are dropped from all of them.

Every text is split at ``\\n`` and exploded to normalised lines. A line's key is the line without white space at both
ends and with A-Z in lower case; it travels as a 128-bit hash. Distinct documents are counted per hash, and the
lines of the keys that reach the threshold are dropped before the rest is put together again by position.

Shuffles: (hash, document) pairs once, combined on the map side, so a line that a third of all documents hold is
spread over its documents before it is counted; the lines once, by document. The frequent hashes are written, counted
and broadcast only within a bound; beyond it the lines join them by hash, where AQE splits a hot key.

Defined results: a null or empty text is one empty line and comes back as ''. Keys shorter than ``min_chars`` are never
dropped. Rows that repeat a ``doc_id`` are one document in the counts, and each row comes back; a null ``doc_id`` is one
more document. Columns named like the results are replaced; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import WHITE, ascii_lower, broadcast_if_small, quoted, without, written


def _lines(docs: DataFrame) -> DataFrame:
    """One row per line: document, text hash, position, line and the two halves of the key's hash."""
    rest = [quoted(c) for c in without(docs, "doc_id", "text", "n_lines", "n_dropped")]
    rows = docs.select(
        F.col("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.struct(F.lit(0).alias("__row"), *rest).alias("rest")
    )
    rows = rows.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), "rest",
        F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"),
    )
    rows = rows.withColumn("key", ascii_lower(F.btrim("line", F.lit(WHITE))))
    return rows.select(
        "doc_id", "text_hash", "pos", "line", F.char_length("key").alias("chars"),
        F.when(F.col("pos") == 0, F.col("rest")).alias("rest"),
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"),
    )


def frequent_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Hashes (h1, h2) of the keys of at least ``min_chars`` code points found in at least ``min_docs`` documents."""
    return (
        _lines(docs).where(F.col("chars") >= min_chars).select("h1", "h2", "doc_id").distinct()
        .groupBy("h1", "h2").count().where(F.col("count") >= min_docs).select("h1", "h2")
    )


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``docs`` without their frequent lines, with ``n_lines`` (before) and ``n_dropped``.

    ``docs`` has ``doc_id``, ``text`` and any other columns.
    """
    hot = broadcast_if_small(written(frequent_lines(docs, min_docs, min_chars), "frequent_lines"))
    lines = _lines(docs).join(hot.withColumn("hot", F.lit(True)), ["h1", "h2"], "left")
    stays = F.col("hot").isNull() | (F.col("chars") < min_chars)
    whole = lines.groupBy("doc_id", "text_hash").agg(
        (F.max("pos") + 1).cast("long").alias("n_lines"),
        # A set, as rows that repeat a document bring every position again.
        F.collect_set(F.when(stays, F.struct("pos", "line"))).alias("kept"),
        F.collect_list("rest").alias("rests"),
    )
    whole = whole.select(
        "doc_id", F.array_join(F.transform(F.sort_array("kept"), lambda x: x["line"]), "\n").alias("text"),
        "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"), F.explode("rests").alias("rest"),
    )
    own = {"doc_id", "text"}
    columns = [
        F.col(c) if c.lower() in own else F.col("rest")[c].alias(c) for c in without(docs, "n_lines", "n_dropped")
    ]
    return whole.select(*columns, "n_lines", "n_dropped")
