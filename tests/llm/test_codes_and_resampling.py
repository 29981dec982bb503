import collections
import hashlib
import json
import math
import random
import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cartwise.llm import byte_bpe, queries, resampling, vector_codes

PARTS = ["a", "e", "t", " ", "  ", "\n", "é", "ß", "的", "ab", "the", "ing", "1", "12", "...", "--", "'s", "'re", "<|endoftext|>", " ",
         "　", "😀", "=", "====", "A", "_", "\t", "\x1c", "\x85", "\xa0", "ing the"]


def _texts(n, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def _ids(packed):
    return np.frombuffer(packed, "<i4").tolist()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(queries.BYTE_VOCABULARY)


@pytest.fixture
def codec():
    with open(queries.BYTE_VOCABULARY, "rb") as f:
        return byte_bpe.Codec(f.read())


def test_ids_and_texts_are_those_of_the_library(codec, library):
    rng = random.Random(1)
    texts = _texts(4_000) + ["a" * n for n in range(60)] + [" " * n for n in range(140)] + ["=" * n + "-" * m for n in range(30) for m in range(30)]
    texts += ["".join(rng.choice("abcdeft") for _ in range(n)) for n in (47, 48, 49, 5_000)] + ["é的" * 400, " \n \n x  ", "\n \n", " a  b   c \t d"]
    found = codec.encode(texts)
    assert [_ids(x) for x in found] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [codec.decode(_ids(x)) for x in found] == texts
    assert 0 < codec.merged < codec.encoded  # both ways were taken
    for _ in range(500):
        ids = [rng.randrange(50_300) for _ in range(rng.randint(0, 12))]
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_code_point_parts_words_as_in_the_library(codec, library):
    texts = [f"a{c}b {c}1 {c}. 's{c}" for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000, 7)])]
    assert [_ids(x) for x in codec.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_small_pieces_and_stores_change_nothing(codec, monkeypatch):
    texts = _texts(300, 9) + [" ".join(_texts(200, 3))]
    expected = codec.encode(texts)
    monkeypatch.setattr(byte_bpe, "PIECE_CHARS", 30)
    monkeypatch.setattr(byte_bpe, "KEPT_WORDS", 5)
    monkeypatch.setattr(byte_bpe, "SHORT_WORD", 3)
    with open(queries.BYTE_VOCABULARY, "rb") as f:
        assert byte_bpe.Codec(f.read()).encode(texts) == expected


def test_long_words_are_not_kept(codec, library):
    texts = ["的é" * 300 + str(i) for i in range(50)] + ["line\n" * 200] * 2 + ["x" * 100 + " short"] + ["長い文" * 100 + "\n" + "別の文" * 100]
    for _ in range(2):
        assert [_ids(x) for x in codec.encode(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert max(map(len, codec._young)) <= byte_bpe.KEPT_CHARS and " short" in codec._young


def _small_file(merges, **model):
    """A vocabulary file of the bytes and these merges."""
    letters = sorted(byte_bpe._byte_of(), key=byte_bpe._byte_of().get)
    names = letters + list(dict.fromkeys("".join(m) for m in merges))
    return json.dumps({
        "added_tokens": [], "normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True, "trim_offsets": True},
        "decoder": {"type": "ByteLevel", "add_prefix_space": True, "use_regex": True, "trim_offsets": True},
        "model": {"type": "BPE", "vocab": {s: i for i, s in enumerate(names)}, "merges": merges, **model},
    })


def test_random_merges_against_the_library():
    rng = random.Random(4)
    for _ in range(30):
        tokens, merges = list("abc"), []
        while len(merges) < 25:
            pair = [rng.choice(tokens), rng.choice(tokens)]
            if "".join(pair) not in tokens:
                merges.append(pair)
                tokens.append("".join(pair))
        file = _small_file(merges)
        codec, library = byte_bpe.Codec(file.encode()), Tokenizer.from_str(file)
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) for _ in range(300)]
        for word, ids, peer in zip(words, codec.encode(words), library.encode_batch(words, add_special_tokens=False)):
            assert _ids(ids) == peer.ids == codec.vocabulary.merge(word.encode())


def test_files_that_break_the_proof_are_refused():
    with pytest.raises(ValueError, match="again"):
        byte_bpe.Codec(_small_file([["a", "b"], ["b", "c"], ["ab", "c"], ["a", "bc"]]).encode())
    with pytest.raises(ValueError, match="plain"):
        byte_bpe.Codec(_small_file([], byte_fallback=True).encode())


def test_encoding_tables(spark, library):
    rows = [(1, "héllo wörld", "x", 1), (1, "héllo wörld", "x", 1), (2, None, "y", 2), (None, "", "z", 3), (3, "a<|endoftext|>b", None, 4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, coded string, row int")
    for docs in (frame, frame.withColumnsRenamed({"coded": "decoded", "row": "n_tokens"})):
        out = byte_bpe.round_trip(docs, queries.BYTE_VOCABULARY)
        got = [(r.doc_id, r.text, r.n_tokens, _ids(r.packed_ids), r.decoded) for r in out.collect()]
        expected = [(i, t, len(e.ids), e.ids, t or "") for i, t, _, _ in rows for e in [library.encode(t or "", add_special_tokens=False)]]
        assert sorted(got, key=str) == sorted(expected, key=str)
    back = byte_bpe.decode(byte_bpe.encode(frame, queries.BYTE_VOCABULARY), queries.BYTE_VOCABULARY)
    assert back.columns == ["doc_id", "text", "coded", "row", "n_tokens", "packed_ids", "decoded"]
    assert all(r.decoded == (r.text or "") for r in back.collect())
    assert byte_bpe.round_trip(frame.limit(0), queries.BYTE_VOCABULARY).collect() == []


def _codes_by_hand(rows, parts, entries, rounds, scale):
    """Codes, errors and codebooks by trying every entry, in Python integers."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    common = collections.Counter(len(v) for _, v in kept)
    n = max(common, key=lambda k: (common[k], k)) if common else 0
    kept, width = [(i, v) for i, v in kept if len(v) == n], n // parts
    first = {}
    for i, v in kept:
        if i is not None:
            first[i] = min(first.get(i, v), v)
    start = [first[i] for i in sorted(first)[:entries]]
    cut = lambda v, p: v[p * width:(p + 1) * width]
    books = [[cut(v, p) for v in start] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = collections.defaultdict(list)
            for _, v in kept:
                groups[near(cut(v, p), books[p])[1]].append(cut(v, p))
            for k, group in groups.items():
                books[p][k] = [sum(c) // len(group) for c in zip(*group)]
    out = []
    for i, v in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, bytes(k for _, k in found), sum(d for d, _ in found)))
    return out, books


def test_orchard_finds_the_nearest_entry_of_lowest_index():
    rng = np.random.default_rng(0)
    for span in (2, 4, 1_000):
        books = rng.integers(-span, span, (3, 16, 4))
        books[0, 5] = books[0, 9] = books[0, 2]
        vectors = rng.integers(-span, span, (700, 3, 4))
        search = vector_codes.Orchard(books)
        code, distance = search.nearest(vectors)
        every = ((vectors[:, :, None] - books[None]) ** 2).sum(axis=3)
        assert (code == every.argmin(axis=2)).all() and (distance == every.min(axis=2)).all()
    tight = np.concatenate([books[:1] * 1_000, books[:1] * 1_000 + 1], axis=1)
    search = vector_codes.Orchard(tight)
    search.nearest(np.repeat(tight.swapaxes(0, 1), 20, axis=0))
    assert search.evaluated < 20 * 32 * 31  # the walk ends early


def test_codes_like_by_hand(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), rng.integers(-3, 4, 16).astype(float).tolist(), int(i) % 3, "x") for i in rng.permutation(200)]
    rows += [(0, rows[0][1], None, "x"), (5, rows[5][1], None, "x"), (None, rows[7][1], 1, "x"), (900, None, 1, "x"), (901, [1.0] * 15 + [None], 1, "x"),
             (902, [float("nan")] * 16, 1, "x"), (903, [float("-inf")] * 16, 1, "x"), (904, [1.0] * 8, 1, "x"), (905, [], 1, "x"), (-1, [0.3, -0.3] * 8, 1, "x")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, row int, code string").repartition(5)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v, _, _ in rows]
    for entries, rounds in ((16, 6), (4, 0), (256, 2)):
        coded, books = vector_codes.compress(frame, 8, entries, rounds, 4)
        expected, expected_books = _codes_by_hand(rows, 8, entries, rounds, 4)
        assert coded.columns == ["vec_id", "row", "code", "error"]
        assert books.tolist() == expected_books
        assert sorted(((r.vec_id, bytes(r.code), r.error) for r in coded.collect()), key=str) == sorted(expected, key=str)
    near = vector_codes.decode(coded, books, 4).collect()
    assert all(np.allclose(r.approximate, np.concatenate([books[p, c] for p, c in enumerate(r.code)]) / 4) for r in near)


def test_codes_of_few_odd_and_no_vectors(spark):
    kind = "vec_id long, embedding array<double>, label int"
    few = spark.createDataFrame([(3, [1.0] * 8, 1), (1, [2.0] * 8, 1)], kind)
    coded, books = vector_codes.compress(few)
    assert books.shape == (8, 2, 1) and {r.vec_id: bytes(r.code) for r in coded.collect()} == {3: b"\1" * 8, 1: b"\0" * 8}
    assert vector_codes.compress(few.limit(0))[0].collect() == []
    assert vector_codes.compress(spark.createDataFrame([(1, None, 1), (2, [float("nan")], 1)], kind))[0].collect() == []
    with pytest.raises(ValueError, match="cut"):
        vector_codes.compress(spark.createDataFrame([(1, [1.0] * 9, 1)], kind))
    with pytest.raises(Exception, match="overflow"):
        vector_codes.compress(spark.createDataFrame([(1, [1e9] * 8, 1)], kind))


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _features(text, max_words):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(words), [" ".join(words[i:i + n]).encode() for n in range(1, max_words + 1) for i in range(len(words) - n + 1)]


def _draw_by_hand(docs, target, buckets, max_words, percent, least):
    def counts(texts):
        return collections.Counter(zlib.crc32(f) % buckets for t in texts for f in _features(t, max_words)[1])

    s, t = counts(x for _, x in docs), counts(x for _, x in target)
    all_s, all_t = sum(s.values()), sum(t.values())
    out, pool = [], []
    for k, (i, text) in enumerate(docs):
        n_words, features = _features(text, max_words)
        total = sum(
            math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
            for b in (zlib.crc32(f) % buckets for f in features)
        )
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = total // len(features) if features else 0
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(features), weight, score, None])
        if n_words >= least:
            pool.append(k)
    pool.sort(key=lambda k: (-out[k][3], out[k][0] is None, out[k][0] or 0, -out[k][1], out[k][2]))
    for rank, k in enumerate(pool[:len(pool) * percent // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=str)


def test_draw_like_by_hand(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: rng.choice(["Spark", "ÉTÉ", "été", "x1", "日本", "the", "of", "a-b", "Z"])
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(250)]
    docs += [(7, "the of " * 30)] * 25 + [(7, "of " * 40), (None, "the " * 50), (None, "the " * 50), (300, None), (301, ""), (302, "?! ..."), (303, "x1 Z " * 4_000)]
    target = [(1, "Spark x1, spark X1 été the"), (2, None), (3, "")]
    frame = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id long, text string, row string, rank int").repartition(4)
    goal = spark.createDataFrame(target, "item_id long, text string")
    for max_words, percent, piece, spread in ((1, 10, 1 << 20, 10_000), (2, 55, 50, 7), (3, 100, 9, 1)):
        monkeypatch.setattr(resampling, "PIECE", piece)
        monkeypatch.setattr(resampling, "SPREAD", spread)
        weighed = resampling.weigh(frame, goal, 500, max_words, together=16)
        assert weighed.columns == ["doc_id", "text", "row", "rank", "n_words", "n_features", "weight"]
        found = resampling.draw(weighed, percent).collect()
        assert sorted(map(tuple, found), key=str) == _draw_by_hand(docs, target, 500, max_words, percent, 20)
    assert resampling.draw(resampling.weigh(frame.limit(0), goal)).collect() == []
    assert resampling.draw(resampling.weigh(frame, goal.limit(0))).where("rank = 1").count() == 1
    kept = resampling.resample(frame, goal, 50)
    assert kept.columns == frame.columns and 0 < kept.count() < frame.count()


def test_sliced_sums_are_plain_sums():
    rng = np.random.default_rng(3)
    counts = np.where(rng.random((40, 10_000)) < 0.02, rng.integers(0, 70_000, (40, 10_000)), 0)
    counts[3] = 0
    for gains in (rng.integers(-40_000, 40_000, 10_000), np.zeros(10_000, np.int64), -np.ones(10_000, np.int64)):
        assert (resampling.sliced_sums(counts, resampling.signed_planes(gains)) == counts @ gains).all()
