"""Substring dedup: words under a window of words that also starts earlier are removed.

A window is ``window`` consecutive words of one document. Its minimiser is the smallest hash of the ``GRAM`` consecutive
words inside it. Consecutive windows that share a minimiser (a super-k-mer) travel as one packed string to the bucket of
that minimiser, so that equal windows meet in one bucket while the text is sent about three times instead of once per
window. In the bucket the windows are sorted by a 64-bit hash; equal hashes are compared word for word, so the
result does not rest on the hash.

Skew:

* Frequent grams are looked for first, over all documents: a gram that makes up more than 1 / ``HOT_SHARE`` of all
  grams does so in at least one batch, each batch names its own, and at most ``HOT_SHARE`` of them can exist, which
  bounds what is sent to the tasks. Such grams are minimisers only of windows that hold nothing else.
* A packed string that comes again in a batch is not sent again: all windows of its later copies are covered, and only
  the copy's place is sent.
* A bucket beyond ``BUCKET_BYTES`` is never held: its windows go on as rows of their own, are reduced to their first
  place by a group-by that combines on the map side, and are joined back.

The number of buckets grows with the words of the input, so that one bucket stays small at any size.

Defined results: a null or empty text has no words. ``doc_id`` orders the documents; a null one counts as the largest
integer. Rows that repeat a ``doc_id`` are one document: equal places are not earlier than each other, and every
row comes back with what its own text loses. Columns named like the results are replaced; an empty table gives an
empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.llm.shared import carried, ship, written

GRAM = 4
HOT_SHARE = 20_000
BATCH_WORDS = 1_000_000
BUCKET_WORDS = 600_000
BUCKET_BYTES = 20_000_000
RESULTS = ("kept_text", "n_words", "n_removed")

_NULL_ID = 2**63 - 1
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_STEP = 1 << 20

PACKED = "bucket int, ids array<bigint>, own array<int>, starts array<int>, counts array<int>, n_packed int, packed binary"
COVERED = "doc_id bigint, own int, start int, count int, words binary"


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_BASE, _STEP), _powers(_INVERSE, _STEP)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 2**64))


class _Words:
    """Words of a buffer of texts, words separated by a space and texts by a line feed.

    ``begin`` and ``end`` are byte offsets, ``hash`` a 64-bit hash of each word, ``text`` the number of its text.
    """

    def __init__(self, data: bytes):
        self.data = data
        raw = np.frombuffer(data + b"\n", np.uint8)
        self.end = np.flatnonzero((raw == 32) | (raw == 10))
        self.begin = np.concatenate([[0], self.end[:-1] + 1])
        breaks = raw[self.end] == 10
        self.text = np.concatenate([[0], np.cumsum(breaks)[:-1]])
        # Prefix sums of byte times power, in steps that keep the arrays short; a word is a difference of two.
        sums = np.empty(len(raw) + 1, np.uint64)
        sums[0] = total = np.uint64(0)
        for at in range(0, len(raw), _STEP):
            part = raw[at:at + _STEP].astype(np.uint64) + np.uint64(1)
            part *= _UP[:len(part)] * _power(_BASE, at)
            sums[at + 1:at + 1 + len(part)] = np.cumsum(part, dtype=np.uint64) + total
            total = sums[at + len(part)]
        self._shift = _DOWN[self.begin % _STEP]
        for at in range(0, len(raw), _STEP):
            here = slice(*np.searchsorted(self.begin, [at, at + _STEP]))
            self._shift[here] *= _power(_INVERSE, at)
        self.hash = _mix((sums[self.end] - sums[self.begin]) * self._shift)

    def __len__(self) -> int:
        return len(self.end)

    def spans(self, n: int) -> np.ndarray:
        """Hash of the ``n`` words from every word on (over text ends too; see :meth:`whole`)."""
        out = np.zeros(max(0, len(self) - n + 1), np.uint64)
        for k in range(n):
            out = out * _BASE + self.hash[k:len(self) - n + 1 + k]
        return _mix(out)

    def whole(self, n: int) -> np.ndarray:
        """True where the ``n`` words from a word on lie in one text."""
        m = max(0, len(self) - n + 1)
        return self.text[:m] == self.text[n - 1:n - 1 + m]


def _texts(column: pa.Array) -> list[bytes]:
    """Texts with one space between words (white space is that of bytes.split)."""
    return [b" ".join(x.split()) if x else b"" for x in column.cast(pa.binary()).to_pylist()]


def _batches(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches of about so many words, with their normal texts; a longer text is a slice of its own."""
    for batch in batches:
        at, taken, texts = 0, 0, []
        for i in range(batch.num_rows):
            texts += _texts(batch.column("text").slice(i, 1))
            taken += texts[-1].count(b" ") + 1
            if taken >= words:
                yield batch.slice(at, i + 1 - at), texts
                at, taken, texts = i + 1, 0, []
        if texts:
            yield batch.slice(at), texts


def _count_grams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams that are frequent in a batch with their counts, and under null the words of the batch."""
    for _, texts in _batches(batches, BATCH_WORDS):
        words = _Words(b"\n".join(texts))
        grams = np.sort(words.spans(GRAM)[words.whole(GRAM)])
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.empty(0, int)
        counts = np.diff(np.append(first, len(grams)))
        many = counts > max(1, len(grams) / HOT_SHARE)
        yield pa.RecordBatch.from_pydict({
            "gram": pa.array([None, *grams[first[many]].view(np.int64).tolist()], pa.int64()),
            "found": pa.array([len(words), *counts[many].tolist()], pa.int64()),
        })


def _minima(values: np.ndarray, n: int) -> np.ndarray:
    """Smallest of every ``n`` consecutive values."""
    span = 1
    while 2 * span <= n:
        values = np.minimum(values[:-span], values[span:]) if len(values) > span else values[:0]
        span *= 2
    rest = n - span
    return values if not rest else np.minimum(values[:-rest], values[rest:]) if len(values) > rest else values[:0]


def _packer(window: int, buckets: int, hot: np.ndarray) -> Callable:
    """Super-k-mers of the documents, packed by bucket."""
    flags = np.zeros(1 << 16, bool)
    flags[(hot >> np.uint64(48)).astype(np.int64)] = True

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch, texts in _batches(batches, BATCH_WORDS):
            ids = np.array([_NULL_ID if x is None else x for x in batch.column("doc_id").to_pylist()], np.int64)
            own = batch.column("own").to_numpy()
            # The earliest place of a string comes first; short texts have no window.
            order = [i for i in np.argsort(ids, kind="stable") if texts[i].count(b" ") >= window - 1]
            words = _Words(b"\n".join([texts[i] for i in order]))
            grams = words.spans(GRAM)
            rare = grams >> np.uint64(1)
            doubt = np.flatnonzero(flags[(grams >> np.uint64(48)).astype(np.int64)])
            doubt = doubt[np.isin(grams[doubt], hot)]
            rare[doubt] |= np.uint64(1) << np.uint64(63)
            least = _minima(rare, window - GRAM + 1)
            valid = words.whole(window)
            if not order or not valid.any():
                continue
            place = np.flatnonzero(valid)
            breaks = (least[place][1:] != least[place][:-1]) | (place[1:] != place[:-1] + 1)
            runs = np.concatenate([[0], np.flatnonzero(breaks) + 1])
            first = place[runs]
            count = np.diff(np.append(runs, len(place)))
            text = words.text[first]
            row = np.array(order)[text]
            start = (first - np.searchsorted(words.text, text)).astype(np.int32)
            begin, end = words.begin[first].tolist(), words.end[first + count + window - 2].tolist()
            bucket = (_mix(least[first]) % np.uint64(buckets)).astype(np.int64)
            data, seen, packed, sent = words.data, {}, [], np.ones(len(first), bool)
            id_of, own_of, start_of = ids[row], own[row], start
            for k, (a, b) in enumerate(zip(begin, end)):
                string = data[a:b]
                k0 = seen.get(string)
                if k0 is not None and (id_of[k0], start_of[k0]) < (id_of[k], start_of[k]):
                    sent[k] = False  # an earlier copy covers all its windows
                else:
                    # Rows that share an id come in any order of their starts: what was sent before may start later.
                    seen[string] = k
                    packed.append(string)
            strings = np.empty(len(packed), object)
            strings[:] = packed
            at = np.cumsum(sent) - 1
            # By bucket, what carries a string before what is only a place.
            by = np.lexsort((~sent, bucket))
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket[by])) + 1, [len(by)]])
            out = {name: [] for name in ("bucket", "ids", "own", "starts", "counts", "n_packed", "packed")}
            for a, b in zip(cuts[:-1], cuts[1:]):
                here = by[a:b]
                with_text = here[sent[here]]
                out["bucket"].append(int(bucket[here[0]]))
                out["ids"].append(id_of[here])
                out["own"].append(own_of[here])
                out["starts"].append(start_of[here])
                out["counts"].append(count[here].astype(np.int32))
                out["n_packed"].append(len(with_text))
                out["packed"].append(press.compress(b"\n".join(strings[at[with_text]])))
            yield pa.RecordBatch.from_pydict({
                "bucket": pa.array(out["bucket"], pa.int32()),
                "ids": pa.array(out["ids"], pa.list_(pa.int64())),
                "own": pa.array(out["own"], pa.list_(pa.int32())),
                "starts": pa.array(out["starts"], pa.list_(pa.int32())),
                "counts": pa.array(out["counts"], pa.list_(pa.int32())),
                "n_packed": pa.array(out["n_packed"], pa.int32()),
                "packed": pa.array(out["packed"], pa.binary()),
            })

    return pack


def _runs(ids: np.ndarray, own: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places in order as runs of consecutive starts: id, own, first start, number."""
    cut = np.flatnonzero((ids[1:] != ids[:-1]) | (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)) + 1
    first = np.concatenate([[0], cut])
    return ids[first], own[first], starts[first], np.diff(np.append(first, len(ids)))


def _table(ids, own, starts, counts, words=None) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.array(ids, pa.int64()), "own": pa.array(own, pa.int32()), "start": pa.array(starts, pa.int32()),
        "count": pa.array(counts, pa.int32()),
        "words": pa.nulls(len(ids), pa.binary()) if words is None else pa.array(words, pa.binary()),
    })


class _Bucket:
    """Rows of one bucket, or a part of them."""

    def __init__(self, window: int):
        self.window, self.parts, self.size = window, [], 0

    def add(self, ids, own, starts, counts, packed: bytes) -> None:
        self.parts.append((ids, own, starts, counts, packed))
        self.size += len(packed)

    def _windows(self):
        ids, own, starts = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        words = _Words(b"\n".join(p[4] for p in self.parts))
        valid = np.flatnonzero(words.whole(self.window))
        text = words.text[valid]
        first = np.searchsorted(words.text, np.arange(len(ids)))
        return words, valid, ids[text], own[text], starts[text] + (valid - first[text]).astype(np.int32)

    def covered(self) -> pa.RecordBatch:
        """Runs of windows that also start earlier in the bucket."""
        words, at, ids, own, starts = self._windows()
        hashes = words.spans(self.window)[at]
        order = np.argsort(hashes, kind="stable")
        same = hashes[order][1:] == hashes[order][:-1]
        shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        order = order[shared]
        order = order[np.lexsort((starts[order], ids[order], hashes[order]))]
        hashes, ids, own, starts, at = hashes[order], ids[order], own[order], starts[order], at[order]
        begin, end, data = words.begin[at].tolist(), words.end[at + self.window - 1].tolist(), words.data
        later, head = np.zeros(len(order), bool), 0
        for i in range(1, len(order)):
            if hashes[i] != hashes[head]:
                head = i
            elif data[begin[i]:end[i]] == data[begin[head]:end[head]]:
                later[i] = (ids[i], starts[i]) != (ids[head], starts[head])
            else:  # two different windows of one hash: look for the first equal one
                own_head = next(
                    j for j in range(head, i + 1) if data[begin[j]:end[j]] == data[begin[i]:end[i]]
                )
                later[i] = (ids[i], starts[i]) != (ids[own_head], starts[own_head])
        ids, own, starts = ids[later], own[later], starts[later]
        order = np.lexsort((starts, own, ids))
        return _table(*_runs(ids[order], own[order], starts[order])) if len(ids) else _table([], [], [], [])

    def spread(self) -> pa.RecordBatch:
        """Every window as a row with its words, for a bucket that is too large to be held."""
        words, at, ids, own, starts = self._windows()
        begin, end = words.begin[at].tolist(), words.end[at + self.window - 1].tolist()
        return _table(ids, own, starts, np.ones(len(ids), np.int32), [words.data[a:b] for a, b in zip(begin, end)])


def _reducer(window: int, limit: int) -> Callable:
    def reduce(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press, bucket, held, large = zstandard.ZstdDecompressor(), None, _Bucket(window), False
        for batch in batches:
            for i in range(batch.num_rows):
                now = batch.column("bucket")[i].as_py()
                if now != bucket:
                    if held.parts:
                        yield held.spread() if large else held.covered()
                    bucket, held, large = now, _Bucket(window), False
                ids, own, starts, counts = (
                    batch.column(c)[i].values.to_numpy() for c in ("ids", "own", "starts", "counts")
                )
                n = batch.column("n_packed")[i].as_py()
                if n < len(ids):
                    yield _table(ids[n:], own[n:], starts[n:], counts[n:])
                if n:
                    packed = press.decompress(batch.column("packed")[i].as_py())
                    held.add(ids[:n], own[:n], starts[:n], counts[:n], packed)
                if held.size > limit:
                    large = True
                    yield held.spread()
                    held = _Bucket(window)
        if held.parts:
            yield held.spread() if large else held.covered()

    return reduce


def covered_runs(docs: DataFrame, window: int = 20, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Runs of windows that also start earlier: doc_id (null as the largest integer), own (of the text), start, count."""
    if window < GRAM:
        raise ValueError(f"a window has at least {GRAM} words")
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select("doc_id", "text", F.hash("text").alias("own"))
    grams = rows.select("text").mapInArrow(_count_grams, "gram bigint, found bigint").groupBy("gram").agg(
        F.sum("found").alias("found")
    )
    grams = written(grams, "frequent_grams")
    n_words = grams.where("gram IS NULL").agg(F.sum("found")).first()[0] or 0
    # At most HOT_SHARE rows, as their counts sum to no more than all words.
    hot = [r[0] for r in grams.where(F.col("gram").isNotNull() & (F.col("found") * HOT_SHARE > n_words)).collect()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(-(-n_words // BUCKET_WORDS), 2 * parts)
    pack = _packer(window, buckets, np.sort(np.array(hot, np.int64).view(np.uint64)))
    packed = rows.mapInArrow(pack, PACKED).repartition("bucket").sortWithinPartitions("bucket")
    found = written(packed.mapInArrow(_reducer(window, bucket_bytes), COVERED), "covered_windows")
    spread = found.where("words IS NOT NULL")
    first = spread.groupBy("words").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    late = spread.join(first, "words").where(F.struct("doc_id", "start") > F.col("first"))
    columns = ["doc_id", "own", "start", "count"]
    return found.where("words IS NULL").select(columns).unionByName(late.select(columns))


def _cutter(window: int) -> Callable:
    """Text and its covered runs to what is left, the number of words and of removed words."""

    def cut(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, starts, counts in parts:
            out = []
            for text, at, n in zip(texts, starts, counts):
                words = text.encode().split() if text else []
                removed = 0
                if at is not None and len(at):
                    step = np.zeros(len(words) + 1, np.int64)
                    np.add.at(step, at, 1)
                    np.add.at(step, np.asarray(at) + n + window - 1, -1)
                    stays = np.cumsum(step)[:-1] == 0
                    removed = len(words) - int(stays.sum())
                    kept = [w for w, ok in zip(words, stays.tolist()) if ok]
                else:
                    kept = words
                out.append((b" ".join(kept).decode(), len(words), removed))
            yield pd.DataFrame(out, columns=["kept_text", "n_words", "n_removed"])

    return cut


def dedup_substrings(docs: DataFrame, window: int = 20, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``docs`` with kept_text (words joined by one space), n_words and n_removed.

    ``docs`` has ``doc_id`` (integer), ``text`` and any other columns.
    """
    runs = covered_runs(docs, window, bucket_bytes).groupBy(F.col("doc_id").alias("id"), "own").agg(
        F.collect_list(F.struct("start", "count")).alias("runs")
    )
    rows = docs.select(
        carried(docs, *RESULTS), F.coalesce("doc_id", F.lit(_NULL_ID)).alias("id"), F.hash("text").alias("own")
    ).join(runs, ["id", "own"], "left")
    cut = F.pandas_udf(_cutter(window), "kept_text string, n_words bigint, n_removed bigint")
    return rows.select("row", cut("row.text", "runs.start", "runs.count").alias("cut")).select("row.*", "cut.*")
