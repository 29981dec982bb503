"""Inputs that an operator meets once in a while: helper names as columns, repeated ids, odd urls and lengths."""

import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from cartwise.llm import (
    byte_bpe, chat, decontaminate, line_dedup, permutation_index, quality, queries, resampling, sentencepiece_codec, simhash,
    substring_dedup, url_rules, vector_codes, warc,
)
from tests.conftest import SF
from tests.llm.test_substrings import _removed_by_hand

#: Names that operators use inside, or might.
HELPERS = [
    "__id", "__own", "__hash", "__text", "__runs", "__cut", "__coded", "__fp", "id", "own", "hash", "row", "cut", "runs", "coded", "found",
    "hit_id", "text_hash", "fp", "root", "x", "n", "key", "lines", "words", "bag", "rank", "score", "above", "a.b", "pos", "value",
]


def _with_helpers(frame):
    extra = [n for n in HELPERS if n not in frame.columns]
    return frame.withColumns({n: F.lit(f"own {n}") for n in extra}), extra


TEXTS = [(1, "the cat sat on the mat " * 8), (2, "the cat sat on the mat " * 8), (3, None), (4, ""), (5, "another line\nof text"), (None, "no id")]


@pytest.mark.parametrize("name", ["2", "4", "5", "5 clean", "9", "10", "10 round trip", "11", "12", "13", "7", "1"])
def test_helper_names_are_ordinary_columns(spark, name):
    docs, extra = _with_helpers(spark.createDataFrame(TEXTS, "doc_id long, text string"))
    bench = spark.createDataFrame([(1, "cat sat on the mat the cat sat on the mat the cat sat")], "item_id long, text string")
    pages, of_pages = _with_helpers(spark.createDataFrame([(1, "http://a.net/x"), (2, None)], "page_id long, url string"))
    vectors, of_vectors = _with_helpers(spark.createDataFrame([(i, [float(i)] * 8) for i in range(5)], "vec_id long, embedding array<float>"))
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, verdict string")
    build = {
        "1": lambda: quality.score(docs, quality.fit(docs, spark.createDataFrame([(1, 1), (5, 0)], "doc_id long, label int"))),
        "2": lambda: substring_dedup.dedup_substrings(docs), "4": lambda: simhash.one_per_group(docs),
        "5": lambda: decontaminate.mark(docs, bench), "5 clean": lambda: decontaminate.clean(docs, bench),
        "7": lambda: url_rules.judge(pages, rules), "9": lambda: line_dedup.dedup_lines(docs),
        "10": lambda: sentencepiece_codec.encode(docs, queries.PIECE_MODEL),
        "10 round trip": lambda: sentencepiece_codec.round_trip(docs, queries.PIECE_MODEL, differing=True),
        "11": lambda: byte_bpe.round_trip(docs, queries.BYTE_VOCABULARY), "12": lambda: vector_codes.compress(vectors)[0],
        "13": lambda: resampling.weigh(docs, bench),
    }
    out = build[name]()
    wanted = {"7": of_pages, "12": of_vectors}.get(name, extra)
    replaced = {"1": {"score"}, "7": {"host", "path", "rule", "verdict"}}.get(name, set())
    rows = out.collect()
    assert rows and all(r[n] == f"own {n}" for r in rows for n in wanted if n not in replaced)


def test_helper_names_beside_what_is_read(spark):
    pages, _ = _with_helpers(spark.createDataFrame([(1, "u", "<p>"), (2, "u", "<p>")], "page_id long, url string, html string"))
    assert warc.round_trip(pages).count() == 2
    turns, _ = _with_helpers(spark.createDataFrame([(1, 0, "user", "x")], "conv_id long, turn long, role string, text string"))
    assert chat.format_conversations(turns).count() == 1
    vectors, _ = _with_helpers(spark.createDataFrame([(i, [float(i + 1)] * 4) for i in range(9)], "vec_id long, embedding array<float>"))
    assert permutation_index.search(vectors, every=3).count() == 3 * 8
    docs, _ = _with_helpers(spark.createDataFrame(TEXTS, "doc_id long, text string"))
    assert simhash.near_duplicates(docs).count() == len(TEXTS)


@pytest.mark.parametrize("flipped", [False, True])
def test_the_later_start_of_a_repeated_id_is_removed(spark, flipped):
    rng = random.Random(1)
    word = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = word(30)
    rows = [(1, f"{word(50)} {passage} {word(5)}", "x", "en"), (1, f"{word(10)} {passage} {word(5)}", "x", "en")]
    frame = spark.createDataFrame(rows[::-1] if flipped else rows, "doc_id long, text string, n_words string, lang string").coalesce(1)
    found = substring_dedup.dedup_substrings(frame).collect()
    assert sorted(map(tuple, found), key=str) == _removed_by_hand(rows, 20)
    assert {r.n_removed for r in found if r.text == rows[0][1]} == {30}


def test_one_row_of_a_group_stays_whatever_repeats(spark):
    text, other = "some words that are repeated here", "wholly different words in another document"
    rows = [(1, text, "b"), (1, text, "a"), (1, text, "a"), (2, text, "c"), (None, other, "d"), (None, other, "d"), (3, "alone", "e")]
    kept = simhash.one_per_group(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(1, text, "a"), (None, other, "d"), (3, "alone", "e")], key=str)


def test_urls_keep_their_white_space(spark, tmp_path):
    urls = ["http://x/\u00a0", "\u3000http://y/", " http://z/ \t", " ", ""]
    pages = spark.createDataFrame([(i, u, f"<{i}>") for i, u in enumerate(urls)], "page_id long, url string, html string")
    assert {r.page_id: r.url for r in warc.round_trip(pages, str(tmp_path / "a")).collect()} == dict(enumerate(urls))


def test_archives_lie_where_spark_resolves_the_folder(spark, tmp_path):
    assert warc.store_uri(spark, str(tmp_path)) == f"file://{tmp_path}" == warc.store_uri(spark, f"file:{tmp_path}")
    with pytest.raises(Exception):
        warc.store_uri(spark, "unknown://x/y")


def test_rule_hosts_have_no_case(spark):
    pages = spark.createDataFrame([(1, "http://a.example.net/x")], "page_id long, url string")
    rules = spark.createDataFrame([("Example.NET", "/", "block")], "host string, path string, verdict string")
    row = url_rules.judge(pages, rules).first()
    assert (row.verdict, row.rule) == ("block", "Example.NET/")


@pytest.mark.parametrize("spread", [0.0, 0.7, 1.5])
def test_search_of_uneven_lengths(spark, spread):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(2_000, 64))
    vectors *= np.exp(spread * rng.normal(size=(2_000, 1))) / np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(-20, [1.0]), (-40, [2.0])]
    found = permutation_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), block=1_000).collect()
    hit, scores = 0, vectors @ vectors[::20].T
    for r in found:
        hit += r.rank <= 20 and int((np.delete(scores[:, r.query_id // 20], r.query_id) > r.score + 1e-12).sum()) < 20
    assert len(found) == 2_000 and hit >= 0.95 * 2_000


def test_equal_vectors_have_equal_scores(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 67))
    rows = [(i, base[i % 40].tolist()) for i in range(1_200)]
    found = permutation_index.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=40).collect()
    scores = {}
    for r in found:
        scores.setdefault((r.query_id, r.vec_id % 40), set()).add(r.score)
    assert all(len(s) == 1 for s in scores.values())
    first = sorted((r for r in found if r.query_id == 0), key=lambda r: r.rank)
    assert [r.vec_id for r in first[:29]] == [40 * i for i in range(1, 30)]


def test_stages_take_odd_documents(spark):
    docs = queries.read(spark, SF, "documents")
    text = docs.where("doc_id = 1").first().text
    odd = [(1, text), (1, text), (1, "other text of the id"), (None, text), (None, None), (900, None), (901, ""), (902, "x " * 30_000)]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in odd], docs.schema).withColumn("__id", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        for given in (frame, frame.limit(0)):
            out = stage(spark, given, SF)
            n = out.count()
            assert n <= len(odd) if given is frame else n == 0, name
