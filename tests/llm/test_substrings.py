import random

import numpy as np
import pytest

from cartwise.llm import decontaminate, substring_dedup

DOCS = "doc_id long, text string, n_words string, lang string"


def _removed_by_hand(docs, window):
    largest = 2**63 - 1
    first, split = {}, [(largest if d[0] is None else d[0], (d[1] or "").encode().split()) for d in docs]
    for i, words in split:
        for k in range(len(words) - window + 1):
            w = tuple(words[k:k + window])
            first[w] = min(first.get(w, (i, k)), (i, k))
    out = []
    for row, (i, words) in zip(docs, split):
        gone = set()
        for k in range(len(words) - window + 1):
            if first[tuple(words[k:k + window])] < (i, k):
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        out.append((row[0], row[1], row[3], kept, len(words), len(gone)))
    return sorted(out, key=str)


def _corpus(rng, window):
    vocabulary = [f"{a}{b}" for a in "abé" for b in range(40)]
    passage = [rng.choice(vocabulary) for _ in range(3 * window)]
    docs = []
    for i in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(3 * window))]
        if i % 2:
            cut = rng.randrange(window)
            words += passage[cut:cut + rng.randrange(window, 2 * window)] + [rng.choice(vocabulary)] * (i % 5)
        docs.append((i, rng.choice([" ", "\n", " \t "]).join(words), "x", "en"))
    docs += [
        (3, docs[3][1], "x", "en"), (50, None, "x", None), (51, "", None, "en"), (52, "same " * (4 * window), "x", "en"),
        (None, docs[5][1], "x", "en"), (None, docs[5][1], "x", "en"), (3, docs[7][1], "x", "en"), (53, "a b " * 6_000, "x", "en"),
        (54, " ".join(passage), "x", "en"), (2, "  x" + " ".join(passage), "x", "en"),
    ]
    return docs


@pytest.mark.parametrize("window,limit", [(20, 1 << 26), (6, 1 << 26), (6, 100), (4, 1 << 26)])
def test_words_removed_like_by_hand(spark, window, limit):
    docs = _corpus(random.Random(window), window)
    frame = spark.createDataFrame(docs, DOCS).repartition(3)
    found = substring_dedup.dedup_substrings(frame, window, limit)
    assert found.columns == ["doc_id", "text", "lang", "kept_text", "n_words", "n_removed"]
    assert sorted(map(tuple, found.collect()), key=str) == _removed_by_hand(docs, window)


def test_small_batches_and_equal_hashes(spark, monkeypatch):
    docs = _corpus(random.Random(9), 5)
    words = substring_dedup._Words
    monkeypatch.setattr(words, "spans", lambda self, n, f=words.spans: f(self, n) % np.uint64(11))
    packed = list(substring_dedup._packer(5, 3, np.array([3], np.uint64))([_batch(docs)]))
    rows = substring_dedup._reducer(5, 1 << 26)(sorted(packed_rows(packed), key=lambda b: b.column("bucket")[0].as_py()))
    runs = [x for batch in rows for x in batch.to_pylist()]
    gone = {}
    for r in runs:
        gone.setdefault((r["doc_id"], r["own"]), set()).update(range(r["start"], r["start"] + r["count"] + 4))
    for row in _removed_by_hand([(i, d[1], None, None) for i, d in enumerate(docs)], 5):
        assert len(gone.get((row[0], 0), ())) == row[5]


def _batch(docs):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(range(len(docs)), pa.int64()), "text": pa.array([d[1] for d in docs], pa.string()),
        "own": pa.array([0] * len(docs), pa.int32()),
    })


def packed_rows(batches):
    return [b.slice(i, 1) for b in batches for i in range(b.num_rows)]


def test_frequent_grams_are_bounded():
    grams = [b for b in substring_dedup._count_grams([_batch([(0, "p q r s " * 50_000), (1, "a b c d e f")])])]
    found = grams[0].to_pylist()
    assert found[0] == {"gram": None, "found": 200_006}
    assert 1 < len(found) <= 1 + substring_dedup.HOT_SHARE


def test_no_documents(spark):
    assert substring_dedup.dedup_substrings(spark.createDataFrame([], DOCS)).collect() == []


def _marks_by_hand(docs, items, window):
    import re

    def words(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    windows = {}
    for i, text in items:
        w = words(text)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for d in docs:
        w, hit, ids = words(d[1]), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    ids |= windows[tuple(w[k:k + n])]
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((d[0], d[1], d[3], len(w), len(hit), len(ids), tuple(ids), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_benchmark_marked_like_by_hand(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "the"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(4, 20))) for i in range(12)]
    items += [(20, items[0][1].upper()), (21, "rare"), (22, "Two words!"), (23, None), (24, "..."), (25, "the the the the the"), (None, "no id here"),
              (3, "another text of the same item")]
    docs = []
    for i in range(30):
        parts = [text(rng.randrange(30)), rng.choice(items)[1] or "", text(rng.randrange(100)), "the " * (i % 7)]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts), "x", "en"))
    docs += [(40, None, "x", "en"), (41, "", "x", None), (42, "RARE", "x", "en"), (3, docs[3][1], "x", "en"), (3, "two words", "x", "en"),
             (43, "the " * 20_000 + "two-words", "x", "en"), (None, "no id here", "x", "en"), (44, "two", "x", "en")]
    frame = spark.createDataFrame(docs, DOCS)
    bench = spark.createDataFrame([(*x, 1) for x in items], "item_id long, text string, words int")
    for window in (5, 13):
        found = decontaminate.mark(frame, bench, window)
        assert found.columns == ["doc_id", "text", "lang", "n_words", "n_hit", "n_items", "item_ids", "contaminated"]
        rows = sorted(((*r[:6], tuple(r[6]), r[7]) for r in found.collect()), key=str)
        expected = _marks_by_hand(docs, items, window)
        assert rows == expected
        clean = decontaminate.clean(frame, bench, window)
        assert sorted(str((r[0], r[1])) for r in clean.collect()) == sorted(str(r[:2]) for r in expected if not r[-1])
    assert decontaminate.mark(frame.limit(0), bench).collect() == []
    assert {r.n_hit for r in decontaminate.mark(frame, bench.limit(0)).collect()} == {0}
