"""Byte-level BPE encoding and decoding: propose by longest match, verify adjacent pairs, merge exactly only where that fails.

The vocabulary file is that of the tokenizers library (merges in order of rank, byte-level pre-tokenizer); ids are what the
library's ``encode(text, add_special_tokens=False)`` gives, strings of added tokens in a text included.

* A text is cut at added tokens, then into chunks before spaces that no word reaches over, and a chunk by the pre-tokenizer's
  pattern into words. Distinct chunks and words are encoded once and kept, up to a length and a number.
* Propose: for all new words at once, a trie is walked from the first byte to the longest token, and from its end to the next.
* Verify: a sequence of tokens is what BPE makes of a word if and only if every two neighbours are what BPE makes of the two
  alone. For a pair, the tokens along the right edge of the left one and the left edge of the right one are taken apart in the order in
  which merges made them; the boundary falls if two of them that stand side by side have a merge that comes before the
  merges that took them up. All distinct pairs are tested at once in numpy. A token that BPE does not make of its own
  bytes is never accepted.
* Only words with a failing pair are merged exactly, lowest rank and then leftmost first: short ones together in numpy, one
  merge a word and step, long ones with a heap over a linked list.

The claim rests on a token being made by one merge, of two tokens that earlier merges made; a file in which that does not
hold is refused, as is one with settings that change the result and are not built here.

Tasks run over whole texts; nothing is shuffled. Long texts are cut into pieces before white space that follows other text, where
no word can reach over, so memory beside the text and its ids is bounded unless a text has no white space at all.

Defined results: a null text is empty; an empty text has no tokens and decodes to an empty text. Ties cannot arise: ids
are a function of the text. Repeated rows each come back, an empty table gives an empty one. Columns named like the results are
replaced, others are carried. Decoding drops ids that the vocabulary lacks and turns bytes that are no UTF-8 into replacement
characters, both as the library does.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm.shared import quoted, ship, without

#: Fixed: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed: the byte values that the vocabulary file writes as the character of the same number; the others follow from 256 on.
PRINTED = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]

PIECE_CHARS = 500_000
KEPT_WORDS, KEPT_CHARS = 200_000, 64
GROUP_ROWS = 512
_END = 256  # stands after every word; no token goes on over it
_NEVER = np.int64(2**62)
#: A space between white space, before which a text cannot be cut, and all others.
_DOUBTFUL, _INSIDE = re.compile(r"\s (?:\s|\Z)"), re.compile(r"(?<!\s) | (?=\S)")
#: Bytes up to which failing words are merged together.
SHORT_WORD = 48


def _byte_of() -> dict[str, int]:
    """The byte of every character that vocabulary files use."""
    others = [b for b in range(256) if b not in PRINTED]
    return {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}


def chunks_of(text: str) -> list[str]:
    """A text cut before spaces that no word of the pattern reaches over.

    Those are the spaces that follow other text, and those that other text follows: from a run of white space the pattern
    leaves its last space to the word behind it.
    """
    first, *others = _INSIDE.split(text) if _DOUBTFUL.search(text) else text.split(" ")
    return [first, *[" " + c for c in others]]


class Vocabulary:
    """Tokens, merges, and the tables of the proposal and the verification."""

    def __init__(self, data: bytes):
        file = json.loads(data)
        model, before = file["model"], file.get("pre_tokenizer") or {}
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if odd or file.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError(f"not a plain byte-level BPE: {odd or file.get('normalizer') or before}")
        added = [t for t in file.get("added_tokens", [])]
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens that take in their surroundings are not supported")
        byte_of = _byte_of()
        self.added = {t["content"]: t["id"] for t in added}
        ids = {bytes(byte_of[c] for c in s): i for s, i in model["vocab"].items() if s not in self.added}
        size = 1 + max([*ids.values(), *self.added.values()])
        #: The bytes of every id; an added token's are its text.
        self.bytes: list[bytes] = [b""] * size
        for b, i in [*ids.items(), *((s.encode(), i) for s, i in self.added.items())]:
            self.bytes[i] = b
        if any(bytes([b]) not in ids for b in range(256)):
            raise ValueError("a byte-level vocabulary has all 256 bytes")
        self.single = np.array([ids[bytes([b])] for b in range(256)], np.int64)

        #: By token: the rank of the merge that makes it (-1 for bytes), and the two tokens that it merges.
        self.born = np.full(size, -1, np.int64)
        self.left, self.right = np.zeros(size, np.int64), np.zeros(size, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = (ids[bytes(byte_of[c] for c in s)] for s in (merge if isinstance(merge, list) else merge.split(" ")))
            made = ids[self.bytes[a] + self.bytes[b]]
            if self.born[made] >= 0 or len(self.bytes[made]) < 2 or any(len(self.bytes[x]) > 1 and self.born[x] < 0 for x in (a, b)):
                raise ValueError(f"merge {rank} makes a token again, or of tokens that no earlier merge makes")
            self.born[made], self.left[made], self.right[made] = rank, a, b
            self.merges[a, b] = rank, made
        self._size = size
        keys = np.array([a * size + b for a, b in self.merges], np.int64)
        ranks = np.array([r for r, _ in self.merges.values()], np.int64)
        order = np.argsort(keys)
        self._pairs, self._ranks = np.append(keys[order], np.int64(2**63 - 1)), np.append(ranks[order], _NEVER)
        self._made = np.array([m for _, m in self.merges.values()], np.int64)
        self._grow_trie(ids)
        #: Tokens that BPE makes of their own bytes.
        self.sound = self.born < 0
        made = np.flatnonzero(self.born >= 0)
        self.sound[made] = self.compatible(self.left[made], self.right[made], self.born[made])
        for i in made[np.argsort(self.born[made])].tolist():  # and so are the two that they merge
            self.sound[i] &= self.sound[self.left[i]] and self.sound[self.right[i]]

    def _grow_trie(self, ids: dict[bytes, int]) -> None:
        """Edges of the trie of all tokens, as sorted (node, byte) keys; a node's token or -1."""
        prefixes: dict[bytes, int] = {b"": 0}
        edges, tokens = {}, [-1]
        for token, i in ids.items():
            node = 0
            for k in range(1, len(token) + 1):
                below = prefixes.get(token[:k])
                if below is None:
                    below = prefixes[token[:k]] = len(tokens)
                    tokens.append(-1)
                    edges[node * (_END + 1) + token[k - 1]] = below
                node = below
            tokens[node] = i
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        # A last key that no edge has stands behind all others.
        self._edges = np.append(keys[order], np.int64(2**63 - 1))
        self._below = np.fromiter(edges.values(), np.int64, len(edges))[order]
        self._token = np.array(tokens, np.int64)

    def rank_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of two tokens, or ``_NEVER``."""
        key = a * self._size + b
        at = np.searchsorted(self._pairs, key)  # a last key that no pair has stands behind all others
        return np.where(self._pairs[at] == key, self._ranks[at], _NEVER)

    def compatible(self, left: np.ndarray, right: np.ndarray, until: np.ndarray | None = None) -> np.ndarray:
        """True where the boundary of two tokens stands when BPE merges their bytes (in merges before rank ``until``)."""
        a, b = left.copy(), right.copy()
        ends_a = np.full(len(a), _NEVER) if until is None else until.copy()
        ends_b = np.full(len(a), _NEVER) if until is None else until - 1
        fine, open_ = np.ones(len(a), bool), np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            rank = self.rank_of(x, y)
            # Of equal merges the left one is done first: it takes the left token before this pair, but this pair before the right token.
            falls = (rank < ends_a[open_]) & (rank <= ends_b[open_])
            fine[open_[falls]] = False
            born_x, born_y = self.born[x], self.born[y]
            going = ~falls & ((born_x >= 0) | (born_y >= 0))
            of_left = going & (born_x > born_y)
            of_right = going & ~of_left
            i, j = open_[of_left], open_[of_right]
            ends_a[i], a[i] = born_x[of_left], self.right[x[of_left]]
            ends_b[j], b[j] = born_y[of_right], self.left[y[of_right]]
            open_ = open_[going]
        return fine

    def longest(self, symbols: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token that starts at every place ``at``, and its length; none and 1 where a word ends."""
        token, length = np.full(len(at), -1, np.int64), np.ones(len(at), np.int64)
        which, node, depth = np.arange(len(at)), np.zeros(len(at), np.int64), 0
        while len(which):
            keys = node * (_END + 1) + symbols[at[which] + depth]  # nothing goes on over _END, the last symbol
            edge = np.searchsorted(self._edges, keys)
            found = self._edges[edge] == keys
            which, node = which[found], self._below[edge[found]]
            depth += 1
            whole = self._token[node] >= 0
            token[which[whole]], length[which[whole]] = self._token[node[whole]], depth
        return token, length

    def greedy(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words by longest match, and the number of the word of each."""
        sizes = np.array([len(w) for w in words], np.int64)
        symbols = np.insert(np.frombuffer(b"".join(words), np.uint8).astype(np.int64), np.cumsum(sizes), _END)
        begins = np.cumsum(sizes + 1) - sizes - 1
        short, tokens, of = np.flatnonzero(sizes <= SHORT_WORD), [], []
        at, word = begins[short], short
        while len(word):  # one token of every short word at a time
            token, length = self.longest(symbols, at)
            going = token >= 0
            tokens.append(token[going])
            of.append(word[going])
            at, word = (at + length)[going], word[going]
        for i in np.flatnonzero(sizes > SHORT_WORD).tolist():  # all places of a long word, then along them
            part = symbols[begins[i]:begins[i] + sizes[i] + 1]
            token, length = self.longest(part, np.arange(len(part)))
            step, chain, place = length.tolist(), [], 0
            while place < len(part) - 1:
                chain.append(place)
                place += step[place]
            tokens.append(token[chain])
            of.append(np.full(len(chain), i))
        of = np.concatenate(of) if of else np.empty(0, np.int64)
        order = np.argsort(of, kind="stable")
        return (np.concatenate(tokens) if tokens else np.empty(0, np.int64))[order], of[order]

    def merge(self, word: bytes) -> list[int]:
        """Exact BPE of a word: the lowest rank first, of equal ones the leftmost."""
        tokens = self.single[np.frombuffer(word, np.uint8)].tolist()
        n = len(tokens)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        find = self.merges.get
        heap = [(m[0], i, m[1]) for i in range(n - 1) if (m := find((tokens[i], tokens[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rank, i, made = heapq.heappop(heap)
            j = after[i]
            if tokens[i] < 0 or j >= n or find((tokens[i], tokens[j]), (-1,))[0] != rank:
                continue  # one of the two has been merged meanwhile
            tokens[i], tokens[j] = made, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if m := find((made, tokens[k])):
                    heapq.heappush(heap, (m[0], i, m[1]))
            h = before[i]
            if h >= 0 and (m := find((tokens[h], made))):
                heapq.heappush(heap, (m[0], h, m[1]))
        return [t for t in tokens if t >= 0]

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """Exact BPE of words as packed ids: short ones all together, one merge a word and step."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        for low, high in ((0, 8), (8, 16), (16, SHORT_WORD)):
            which = np.flatnonzero((sizes > low) & (sizes <= high))
            if not len(which):
                continue
            raw = np.frombuffer(b"".join(words[i].ljust(high, b"\0") for i in which.tolist()), np.uint8).reshape(-1, high)
            tokens, left = self.single[raw], sizes[which].copy()
            tokens[np.arange(high) >= left[:, None]] = -1
            ranks = np.full(tokens.shape, _NEVER)  # the last column has no right neighbour
            both = tokens[:, 1:] >= 0
            ranks[:, :-1][both] = self.rank_of(tokens[:, :-1][both], tokens[:, 1:][both])
            going = np.arange(len(which))
            while True:
                at = ranks[going].argmin(axis=1)  # the first of equal ones
                rank = ranks[going, at]
                some = rank < _NEVER
                going, at, rank = going[some], at[some], rank[some]
                if not len(going):
                    break
                source = np.minimum(np.arange(high) + (np.arange(high) > at[:, None]), high - 1)
                now, of = np.take_along_axis(tokens[going], source, 1), np.take_along_axis(ranks[going], source, 1)
                left[going] -= 1
                row = np.arange(len(going))
                now[row, at] = self._made[rank]
                now[row, left[going]] = -1
                of[row, left[going] - 1] = _NEVER
                for place in (at - 1, at):
                    ok = (place >= 0) & (place + 1 < left[going])
                    r, c = row[ok], place[ok]
                    of[r, c] = self.rank_of(now[r, c], now[r, c + 1])
                tokens[going], ranks[going] = now, of
            packed = tokens.astype("<i4").tobytes()
            for k, (i, n) in enumerate(zip(which.tolist(), left.tolist())):
                out[i] = packed[4 * high * k:4 * (high * k + n)]
        for i in np.flatnonzero(sizes > SHORT_WORD).tolist():
            out[i] = np.array(self.merge(words[i]), "<i4").tobytes()
        return out


class Codec:
    """Encoder and decoder of a vocabulary."""

    def __init__(self, data: bytes):
        self.vocabulary = v = Vocabulary(data)
        self._split = regex.compile(PATTERN).findall
        self._safe_end = regex.compile(r"(?<=\S)\s")
        added = sorted(v.added, key=len, reverse=True)
        self._added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self._added_ids = {s: np.array([i], "<i4").tobytes() for s, i in v.added.items()}
        #: Ids of the chunks and words met: the recent ones, and those met before.
        self._young: dict[str, bytes] = dict(self._added_ids)
        self._old: dict[str, bytes] = {}
        #: Words encoded, and those of them whose proposal failed.
        self.encoded = self.merged = 0

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of all words by longest match, the end of each word among them, and whether they are what BPE makes of it."""
        v = self.vocabulary
        tokens, word = v.greedy(words)
        fine = np.ones(len(words), bool)
        fine[word[~v.sound[tokens]]] = False
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique(tokens[inner] * len(v.bytes) + tokens[inner + 1], return_inverse=True)
        stands = v.compatible(pairs // len(v.bytes), pairs % len(v.bytes))
        fine[word[inner[~stands[which]]]] = False
        return tokens, np.searchsorted(word, np.arange(len(words)), "right"), fine

    def _learn(self, words: list[str]) -> None:
        raw = [w.encode() for w in words]
        tokens, ends, fine = self.propose(raw)
        data, ends = tokens.astype("<i4").tobytes(), (4 * ends).tolist()
        self._young.update(zip(words, [data[a:b] for a, b in zip([0, *ends], ends)]))
        failed = np.flatnonzero(~fine).tolist()
        self._young.update(zip([words[i] for i in failed], self.vocabulary.merge_all([raw[i] for i in failed])))
        self.encoded += len(words)
        self.merged += len(failed)

    def _new(self, keys: set[str]) -> list[str]:
        """Those that are not kept; older ones become recent."""
        missing = keys.difference(self._young)
        old = self._old
        self._young.update((k, old[k]) for k in missing if k in old)
        return [k for k in missing if k not in old]

    def _joined(self, cut: list[list[str]]) -> list[bytes]:
        """Ids of lists of chunks; new chunks are encoded together."""
        if len(self._young) > KEPT_WORDS:
            self._young, self._old = dict(self._added_ids), self._young
        find = self._young.__getitem__
        new = self._new(set().union(*cut))
        parts = list(map(self._split, new))
        if learned := self._new({w for words in parts for w in words}):
            self._learn(learned)
        self._young.update((c, b"".join(map(find, words))) for c, words in zip(new, parts) if len(words) != 1)
        out = [b"".join(map(find, chunks)) for chunks in cut]
        for key in (*new, *learned):  # long ones seldom come again, and the store is bounded by their number
            if len(key) > KEPT_CHARS:
                self._young.pop(key, None)
        return out

    def _pieces(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > PIECE_CHARS:
            found = self._safe_end.search(text, at + PIECE_CHARS)
            if not found:
                break
            yield text[at:found.start()]
            at = found.start()
        yield text[at:] if at else text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of every text as little-endian 32-bit integers."""
        out, waiting, taken = [[] for _ in texts], [], 0

        def flush():
            for (i, _), ids in zip(waiting, self._joined([chunks for _, chunks in waiting])):
                out[i].append(ids)

        for i, text in enumerate(texts):
            parts = self._added.split(text) if self._added else [text]
            for k, part in enumerate(parts):
                if k % 2:
                    waiting.append((i, [part]))
                    continue
                for piece in self._pieces(part):
                    waiting.append((i, chunks_of(piece)))
                    taken += len(piece)
                    if taken >= PIECE_CHARS:
                        flush()
                        waiting, taken = [], 0
        flush()
        return [b"".join(ids) for ids in out]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids."""
        known, n = self.vocabulary.bytes, len(self.vocabulary.bytes)
        return b"".join(known[i] for i in np.asarray(ids).tolist() if 0 <= i < n).decode("utf-8", "replace")


_CODECS: dict[str, Codec] = {}


def _codec(path: str) -> Codec:
    """The codec of a vocabulary file, built once in a worker."""
    if path not in _CODECS:
        with open(SparkFiles.get(os.path.basename(path)), "rb") as f:
            _CODECS[path] = Codec(f.read())
    return _CODECS[path]


def _send(spark: SparkSession, vocabulary: str) -> None:
    """Send this package and the vocabulary file to the executors."""
    ship(spark)
    spark.sparkContext.addFile(vocabulary)


def _groups(column: pa.Array) -> Iterator[list[str]]:
    """A few texts at a time, about as many characters as a piece has."""
    group, taken = [], 0
    for value in column:
        group.append(value.as_py() or "")
        taken += len(group[-1])
        if taken >= PIECE_CHARS or len(group) >= GROUP_ROWS:
            yield group
            group, taken = [], 0
    if group:
        yield group


def _with_coded(docs: DataFrame, vocabulary: str, text: str, decoded: bool) -> DataFrame:
    """``docs`` as struct ``row``, and ``coded``: packed ids, and on request the text that they decode to."""
    _send(docs.sparkSession, vocabulary)
    kinds = "packed_ids binary, decoded string" if decoded else "packed_ids binary"

    @F.arrow_udf(kinds)
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(vocabulary)
        for column in columns:
            packed, texts = [], []
            for group in _groups(column):
                found = codec.encode(group)
                packed.append(pa.array(found, pa.binary()))
                if decoded:
                    texts.append(pa.array([codec.decode(np.frombuffer(x, "<i4")) for x in found], pa.string()))
            fields = [pa.concat_arrays(packed) if packed else pa.array([], pa.binary())]
            if decoded:
                fields.append(pa.concat_arrays(texts) if texts else pa.array([], pa.string()))
            yield pa.StructArray.from_arrays(fields, ["packed_ids", "decoded"][:len(fields)])

    results = ("packed_ids", "n_tokens", *(["decoded"] if decoded else []))
    carried = [quoted(c) for c in without(docs, *results)]
    return docs.select(F.struct(*carried).alias("row"), of(quoted(text)).alias("coded"))


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens and packed_ids: the ids of the text as little-endian 32-bit integers, as trainers read them."""
    return _with_coded(docs, vocabulary, text, False).select(
        "row.*", (F.octet_length("coded.packed_ids") / 4).cast("long").alias("n_tokens"), "coded.packed_ids"
    )


def decode(rows: DataFrame, vocabulary: str) -> DataFrame:
    """``rows`` with the text of their packed_ids as ``decoded``; null ids are no ids."""
    _send(rows.sparkSession, vocabulary)

    @F.arrow_udf("string")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(vocabulary)
        for column in columns:
            yield pa.array([codec.decode(np.frombuffer(x.as_py() or b"", "<i4")) for x in column], pa.string())

    return rows.select(*(quoted(c) for c in without(rows, "decoded")), of("packed_ids").alias("decoded"))


def round_trip(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, packed_ids and what they decode to, in one pass over the texts."""
    return _with_coded(docs, vocabulary, text, True).select(
        "row.*", (F.octet_length("coded.packed_ids") / 4).cast("long").alias("n_tokens"), "coded.packed_ids", "coded.decoded"
    )
