"""From raw documents to token ids: five stages over the whole table, each written and read again.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of
``documents``; the last returns doc_id with its token ids. ``n_chars`` follows the text where a stage changes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm import decontaminate, line_dedup, quality, queries, sentencepiece_codec, simhash
from cartwise.llm.shared import written

def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from the labelled rows that op1 learns from."""
    model = quality.fit(docs, queries.learned_labels(spark, sf_dir))
    return quality.score(docs, model).where("predicted = 1").select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least ten of them share."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one of the smallest doc_id."""
    return simhash.one_per_group(docs, shingle=3, radius=2).select(docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.clean(docs, queries.read(spark, sf_dir, "benchmark")).select(docs.columns)


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and how many of its words were encoded in two ways."""
    return sentencepiece_codec.encode(docs.select("doc_id", "text"), queries.PIECE_MODEL, differing=True).select(
        "doc_id", "n_tokens", "token_ids", "n_differing"
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece_encoding", sentencepiece_encoding),
]

#: SQL can express neither the classifier nor the fingerprints nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
