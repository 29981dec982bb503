import io
import random

import numpy as np
import pytest

from cartwise.llm import permutation_index, quality, sentencepiece_codec, warc
from cartwise.llm.queries import PIECE_MODEL

PAGES = "page_id long, url string, html string, record_type string"


def test_pages_round_trip(spark, tmp_path):
    pages = [
        (1, "http://a/ b%20\r\nX: y", "<p>é</p>", "x"), (2, None, "<p>é</p>", "x"), (3, "http://c/é", None, "x"), (4, "d", "", "x"),
        (5, "e", "WARC/1.1\r\n\r\n" * 40_000, "x"), (5, "e", "WARC/1.1\r\n\r\n" * 40_000, "x"), (None, "f", "alone", "x"), (None, "g", "<p>é</p>", "x"),
        (6, "h", "small", "x"), (7, "i", "small", "x"),
    ]
    frame = spark.createDataFrame(pages, PAGES).repartition(3)
    last = {}
    for p, _, html, _ in pages:
        last[html or ""] = max(last.get(html or "", -1), -1 if p is None else p)
    for least in (0, 6):
        expected = []
        for p, url, html, _ in pages:
            data = (html or "").encode()
            revisit = len(data) >= least and (-1 if p is None else p) != last[html or ""]
            expected.append((
                p, url, "revisit" if revisit else "response", last[html or ""] if revisit else None, len(data), warc.digest_of(data),
                None if revisit else bytes(data),
            ))
        found = warc.round_trip(frame, f"{tmp_path}/{least}", least).collect()
        assert sorted(((*r[:6], None if r[6] is None else bytes(r[6])) for r in found), key=str) == sorted(expected, key=str)
    assert warc.round_trip(frame.limit(0), f"{tmp_path}/none").collect() == []


def test_damaged_archives_are_found():
    good = warc.make_record(1, "u", b"payload", "response", None)
    assert [r["payload"] for r in warc.read_stream(io.BytesIO(good * 3))] == [b"payload"] * 3
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.read_stream(io.BytesIO(good + good[:-3])))
    import gzip
    raw = gzip.decompress(good)
    for bad in (raw.replace(b"payload", b"pAyload"), raw.replace(b"Content-Length: 7", b"Content-Length: 8"), raw[:-1], raw + b"x", b"junk"):
        with pytest.raises(ValueError):
            list(warc.read_stream(io.BytesIO(gzip.compress(bad))))


def test_search_finds_most_of_the_nearest(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(3_000, 32)).astype(np.float32)
    vectors[:40] = vectors[0]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)] + [
        (9_000, None, 0), (9_020, [0.0] * 32, 0), (9_040, [float("nan")] * 32, 0), (9_060, [1.0] * 31 + [None], 0), (9_080, [1.0], 0),
        (None, [1.0] * 32, 0), (20, vectors[20].tolist(), 0), (9_100, [float("inf")] * 32, 0), (9_120, [], 0),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int")
    found = permutation_index.search(frame, block=900, query_block=60).collect()
    lists = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        lists.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(lists) == list(range(0, 3_000, 20))
    exact, hit = vectors.astype(np.float64), 0
    for q, got in lists.items():
        scores = exact @ exact[q]
        order = np.lexsort((np.arange(3_000), -scores))
        best = [int(i) for i in order if i != q][:20]
        assert [r for r, _, _ in got] == list(range(1, 21))
        assert all(abs(s - scores[i]) < 1e-12 for _, i, s in got)
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        hit += len({i for _, i, _ in got} & set(best))
    assert hit >= 0.9 * 20 * len(lists)
    assert [i for _, i, _ in lists[0]] == list(range(1, 21))  # equal vectors: the smaller ids
    assert permutation_index.search(frame.limit(0)).collect() == []
    few = permutation_index.search(frame.where("vec_id < 5")).collect()
    assert sorted((r.query_id, r.vec_id) for r in few) == [(0, i) for i in (1, 2, 3, 4)]


def test_classifier_learns_and_scores_every_row(spark):
    rng = random.Random(2)
    good, bad = [f"calm{i}" for i in range(50)], [f"JUNK{i}!!" for i in range(50)]
    docs = [(i, " ".join(rng.choice(good if i % 3 else bad) for _ in range(30)), "x") for i in range(300)]
    docs += [(400, None, "x"), (401, "", "x"), (402, "w" * 100_000, "x"), (403, "calm1 " * 50_000, "x"), (None, "calm1", "x"), (0, docs[0][1], "x")]
    labels = [(i, int(i % 3 > 0)) for i in range(200)] + [(1, 1), (4, 0), (4, 1), (5, None), (6, 7), (None, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    table = spark.createDataFrame(labels, "doc_id long, label int")
    out = quality.score(frame, quality.fit(frame, table))
    assert out.columns == ["doc_id", "text", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.doc_id is not None and 200 <= r.doc_id < 300]
    assert sum((r.score >= 0.5) == (r.doc_id % 3 > 0) for r in held) >= 0.97 * len(held)
    again = {(r.doc_id, r.text): r.score for r in quality.score(frame, quality.fit(frame, table)).collect()}
    assert all(again[r.doc_id, r.text] == r.score for r in rows)
    assert {r.score for r in quality.score(frame, quality.fit(frame, table.limit(0))).collect()} == {0.5}
    assert quality.score(frame.limit(0), quality.fit(frame, table)).collect() == []


def test_words_sum_to_the_average_of_vectors():
    text = "one two two one"
    rows, counts = quality.bag(text)
    weights = np.random.default_rng(0).normal(size=1 << quality.TABLE_BITS)
    ids = [i for w in text.encode().split() for i in quality._features(w)] + [quality.REPEATED]
    assert np.isclose((weights[rows] * counts).sum(), weights[ids].sum()) and counts.sum() == len(ids)


def test_long_words_have_all_their_n_grams(monkeypatch):
    from collections import Counter

    def by_hand(text):
        return Counter([i for w in text.encode().split() for i in quality._features(w)])

    head = "頁" * 70  # 210 bytes
    one, two = head + "良い文章です" * 20, head + "広告広告買う" * 20
    for n in (1 << 16, 7):
        monkeypatch.setattr(quality, "SLICE", n)
        for text in (one, two, one + " short " + two + " x " + two, "a" * 199, "a" * 200, "a" * 201, "ab" * 5_000):
            assert dict(zip(*(x.tolist() for x in quality.bag(text)))) == by_hand(text)
    differ = set(quality.bag(one)[0].tolist()) ^ set(quality.bag(two)[0].tolist())
    assert len(differ) > 10  # more than the two hashes of whole words


def test_texts_without_spaces_are_scored_to_their_end(spark):
    rng = random.Random(4)
    good, bad = "春夏秋冬山川花鳥", "株券広告激安即買"
    docs = [(i, "頁" * 70 + "".join(rng.choice(good if i % 2 else bad) for _ in range(150))) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(120)], "doc_id long, label int")
    rows = quality.score(frame, quality.fit(frame, labels)).collect()
    held = [r for r in rows if r.doc_id >= 120]
    assert sum((r.score >= 0.5) == (r.doc_id % 2 > 0) for r in held) >= 0.97 * len(held)


@pytest.fixture(scope="module")
def piece_model():
    with open(PIECE_MODEL, "rb") as f:
        return f.read()


def _odd_texts():
    rng = random.Random(1)
    fixed = ["", " ", "  ", "   ", " a", "a ", "a  ", "a  b", "▁", "a▁b ▁", "=== =======", "<s> </s> <unk> <0x0A>", "\n\t x", "aaaa aa", "日本 🎉", "x\x00y", "　w"]
    return fixed + ["".join(rng.choice("aab =-\n\t éß日🎉<>") for _ in range(rng.randint(1, 40))) for _ in range(400)]


def test_ids_are_those_of_the_library(piece_model):
    import sentencepiece

    codec, peer = sentencepiece_codec.Codec(piece_model), sentencepiece.SentencePieceProcessor(model_proto=piece_model)
    texts = _odd_texts() + ["word " * 30_000]
    ids = [i.tolist() for i in codec.encode(texts)]
    assert ids == peer.encode(texts) and codec.differing == 0
    assert [codec.decode(i) for i in ids] == [t.replace("▁", " ") for t in texts]
    assert len(codec.model.pieces) == peer.get_piece_size()
    assert all(p == peer.id_to_piece(i) for i, (p, _, _) in enumerate(codec.model.pieces))


def test_differing_words_are_replaced_one_by_one_and_counted(piece_model):
    codec = sentencepiece_codec.Codec(piece_model)
    library, taken = codec.peer, []

    class Other:
        """A library that has other ids for one word, and notes what it is asked."""

        def encode(self, texts, num_threads=1):
            taken.extend(texts)
            return [[i for w in t.split(" ") for i in ([7] * 3 if w == "odd" else library.encode(w))] for t in texts]

    codec.peer = Other()
    ids, differing = codec.encode_counted(["odd one odd", "one two", "", "two odd"])
    assert differing == [2, 0, 0, 1] and codec.differing == 1 and "odd" in taken
    assert ids[0].tolist() == [7] * 3 + library.encode("one") + [7] * 3
    assert ids[1].tolist() == library.encode("one two") and ids[2].tolist() == []


def test_ids_are_the_tokenizers_where_both_agree(piece_model):
    codec = sentencepiece_codec.Codec(piece_model)
    theirs = [codec.peer.encode("a b")]
    codec.peer = type("Peer", (), {"encode": lambda self, texts, num_threads=1: theirs})()
    found, differ = codec._verified(["a b"])
    assert found == theirs and found[0] is not theirs[0] and differ == []


def test_differing_words_are_a_column(spark):
    frame = spark.createDataFrame([(1, "one two"), (2, None), (3, "")], "doc_id long, text string")
    for f in (sentencepiece_codec.encode, sentencepiece_codec.round_trip):
        coded = f(frame, PIECE_MODEL, differing=True)
        assert coded.columns[-1] == "n_differing" and [r.n_differing for r in coded.collect()] == [0, 0, 0]


def test_unigram_scores_and_byte_fallback():
    """A small unigram model, serialised by hand, against the library."""
    import struct

    import sentencepiece

    def field(n, kind, data):
        key = bytes([n << 3 | kind]) if n < 16 else bytes([(n << 3 & 127 | kind) | 128, n >> 4])
        return key + (bytes([len(data) & 127 | 128, len(data) >> 7]) if kind == 2 else b"") + data

    def piece(text, score, kind):
        return field(1, 2, field(1, 2, text.encode()) + field(2, 5, struct.pack("<f", score)) + field(3, 0, bytes([kind])))

    pieces = [piece("<unk>", 0, 2), piece("<s>", 0, 3)] + [piece(f"<0x{b:02X}>", 0, 6) for b in range(256)]
    pieces += [piece(p, s, 1) for p, s in (("▁", -2.0), ("a", -3.0), ("b", -3.5), ("ab", -4.0), ("▁ab", -5.5), ("ba", -5.0), ("▁a", -4.5))]
    data = b"".join(pieces) + field(2, 2, field(3, 0, b"\x01") + field(35, 0, b"\x01")) + field(3, 2, field(1, 2, b"identity"))
    codec, peer = sentencepiece_codec.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["abab ba", "a b  ab", "aé🎉b", "", " ba ", "bbbaaab"]
    assert codec.model.kind == sentencepiece_codec.UNIGRAM and codec.model.byte_fallback
    assert [i.tolist() for i in codec.encode(texts)] == peer.encode(texts) and codec.differing == 0


def test_rows_encode_and_decode(spark):
    docs = [(1, "one two", "x"), (1, "one two", "x"), (2, None, "x"), (3, "", "x"), (None, "é" * 5_000, "x"), (4, "\n".join(["x y"] * 20_000), "x")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, n_tokens string")
    coded = sentencepiece_codec.encode(frame, PIECE_MODEL)
    assert coded.columns == ["doc_id", "text", "token_ids", "n_tokens"]
    rows = sentencepiece_codec.decode(coded, PIECE_MODEL).collect()
    assert len(rows) == len(docs)
    assert all(r.decoded == (r.text or "") and r.n_tokens == len(r.token_ids) for r in rows)
    both = sentencepiece_codec.round_trip(frame, PIECE_MODEL)
    assert both.columns == ["doc_id", "text", "token_ids", "n_tokens", "same_text"]
    assert all(r.same_text for r in both.collect())
    assert sentencepiece_codec.encode(frame.limit(0), PIECE_MODEL).collect() == []
