"""The registered queries of this folder: thin digests of what the operators return."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import (
    byte_bpe, chat, decontaminate, line_dedup, permutation_index, quality, resampling, sentencepiece_codec, simhash,
    substring_dedup, url_rules, vector_codes, warc,
)
from cartwise.llm.shared import broadcast_if_small, written

Query = Callable[[SparkSession, str], DataFrame]

#: Rules of op7: host, path, verdict.
URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


#: Where the public vocabulary files lie.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")

#: The model of op10 and the vocabulary of op11; parameters of the operators.
PIECE_MODEL, BYTE_VOCABULARY = f"{TOKENIZERS}/piece_bpe_32k.model", f"{TOKENIZERS}/byte_bpe_50k.json"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def held_out() -> Column:
    """Documents whose labels are not learned from; a null id, which no label can be joined to, is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "labels").where(~held_out()).select("doc_id", F.col("quality").alias("label"))


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, learned_labels(spark, sf_dir))
    return quality.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.dedup_substrings(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", sha256(F.col("kept_text")).alias("kept_sha256"))


def op3_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold the control strings of common templates."""
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    out = chat.format_conversations(rows).select(
        "conv_id", "formatted", chat.turns_of(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    )
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), sha256(digest).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), sha256(F.col("loss")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, radius=2)


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = decontaminate.mark(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", "n_words", "n_hit", "n_items", sha256(F.array_join("item_ids", ",")).alias("items_sha256"),
        "contaminated",
    )


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(read(spark, sf_dir, "pages"), payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = F.array(*(F.struct(*(F.lit(x).alias(n) for n, x in zip(("host", "path", "verdict"), r))) for r in URL_RULES))
    rules = spark.range(1).select(F.inline(rules))
    judged = url_rules.judge(read(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(read(spark, sf_dir, "embeddings"), k=20, every=20)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's ids, whether decoding them gives the text again, and how many of its words were encoded in two ways."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.round_trip(docs, PIECE_MODEL, differing=True)
    return coded.select("doc_id", "n_tokens", "token_ids", "same_text", "n_differing")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    coded = byte_bpe.round_trip(docs, BYTE_VOCABULARY)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("packed_ids", 256).alias("ids_sha256"), sha256(F.col("decoded")).alias("decoded_sha256")
    )


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(read(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    coded = written(coded, "vector_codes")
    by_label = written(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label_errors")
    numbers = ",".join(map(str, books.reshape(-1).tolist()))
    return coded.join(broadcast_if_small(by_label), F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        sha256(F.lit(numbers)).alias("codebooks_sha256"),
    )


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return resampling.draw(resampling.weigh(docs, read(spark, sf_dir, "benchmark")))


def registry() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op")}
