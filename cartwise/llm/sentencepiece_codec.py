"""SentencePiece encoding and decoding with the tokenizers library as backend.

The model file's protobuf is parsed here: pieces with scores and kinds, the trainer's model kind and byte fallback, and
the normaliser's character map and white-space rules. From these a tokenizer is rebuilt: normaliser, metaspace
marker, and either unigram scores or, for a BPE model, merges in the order of the scores; both with byte fallback. If
no piece has the marker after another character, a merge never crosses the beginning of a word, so a text's ids are those
of its words: every distinct word (with the spaces before it) is encoded once and kept while the store has room. New words
are joined to texts and encoded in batches by the library's threads.

Parity: the ids are the tokenizer's. What is encoded is also encoded by the ``sentencepiece`` library, so every distinct word
is verified; only where the two differ (they could where equal scores tie) the library's ids are taken, and
``n_differing`` says for every document how many of its words that befell (1 for a text that is encoded whole).

Defined results: a null text gives no ids, decodes to '' and is not counted as changed; an empty text gives no
ids. Special tokens in a text are ordinary text. Repeated rows each come back. Columns named like the results are
replaced; an empty table gives an empty one.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.llm.shared import carried, quoted, ship, without

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Characters that are encoded at once; a longer text is a batch of its own.
BATCH_CHARS = 500_000
#: Texts that are Python strings at once.
GROUP_ROWS = 200
#: New words that are encoded as one text.
JOINED = 200
#: Distinct words whose ids a task keeps; beyond it the store is emptied and filled anew.
KEPT_WORDS = 300_000
_RUNS = re.compile(" *[^ ]+| +")


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        value |= (byte & 127) << shift
        at, shift = at + 1, shift + 7
        if byte < 128:
            return value, at


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """Numbers and values of a protobuf message's fields."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 1:
            value, at = data[at:at + 8], at + 8
        elif kind == 2:
            n, at = _varint(data, at)
            value, at = data[at:at + n], at + n
        elif kind == 5:
            value, at = data[at:at + 4], at + 4
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_spaces: bool = True
    escape_spaces: bool = True
    space_suffix: bool = False


def parse_model(data: bytes) -> PieceModel:
    """Parse a serialised model: pieces (field 1), trainer (2) and normaliser (3)."""
    model = PieceModel()
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    piece = v.decode()
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            model.pieces.append((piece, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    model.kind = v
                elif n == 24:
                    model.space_suffix = bool(v)
                elif n == 35:
                    model.byte_fallback = bool(v)
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    model.charsmap = v
                elif n == 3:
                    model.dummy_prefix = bool(v)
                elif n == 4:
                    model.remove_spaces = bool(v)
                elif n == 5:
                    model.escape_spaces = bool(v)
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models are known")
    return model


def merges_of(model: PieceModel) -> list[tuple[str, str]]:
    """All pairs of pieces whose concatenation is a piece, best score first, then the shorter left part."""
    scores = {p: s for p, s, kind in model.pieces if kind in (NORMAL, USER_DEFINED)}
    ranked = sorted((p for p in scores if len(p) > 1), key=lambda p: -scores[p])
    return [(p[:i], p[i:]) for p in ranked for i in range(1, len(p)) if p[:i] in scores and p[i:] in scores]


def splits_words(model: PieceModel) -> bool:
    """True if no piece has the marker after another character."""
    return not any(MARK in p.lstrip(MARK) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))


def build_tokenizer(model: PieceModel):
    """A tokenizers.Tokenizer with the model's normaliser, marker, scores and byte fallback."""
    from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

    unknown = next((i for i, (_, _, kind) in enumerate(model.pieces) if kind == UNKNOWN), None)
    if model.kind == UNIGRAM:
        made = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback)
    else:
        made = models.BPE(
            vocab={p: i for i, (p, _, _) in enumerate(model.pieces)}, merges=merges_of(model), fuse_unk=True,
            byte_fallback=model.byte_fallback, unk_token=None if unknown is None else model.pieces[unknown][0],
        )
    tokenizer = Tokenizer(made)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.remove_spaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(" "))
    if model.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    tokenizer.normalizer = normalizers.Sequence(steps)
    if model.kind == BPE and splits_words(model):
        tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    return tokenizer


def _words_of(text: str) -> list[str]:
    """The words of a text, each with the spaces before it but for the first space (that of the text's begin, too)."""
    text = text.replace(MARK, " ")
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [w[1:] for w in _RUNS.findall(" " + text)]


class Codec:
    """Encoder and decoder of a model, whose ids are those of the sentencepiece library."""

    def __init__(self, data: bytes):
        import sentencepiece

        self.model = parse_model(data)
        self.tokenizer = build_tokenizer(self.model)
        self.peer = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.by_word = (
            self.model.kind == BPE and splits_words(self.model) and not self.model.charsmap
            and self.model.dummy_prefix and self.model.escape_spaces and not self.model.remove_spaces
        )
        self._begins = np.array([p.startswith(MARK) for p, _, _ in self.model.pieces])
        # A space that ends a text is a word without anything after its marker.
        alone = self.peer.encode("a ")[len(self.peer.encode("a")):]
        self._space = {"": np.array(alone, np.int32).tobytes()}
        self._words: dict[str, bytes] = dict(self._space)
        #: Encodings that differed, and the words of the store among them.
        self.differing = 0
        self._differ: set[str] = set()
        self._bytes = [
            bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind in (CONTROL, UNKNOWN) else p.encode()
            for p, _, kind in self.model.pieces
        ]

    def _verified(self, texts: list[str]) -> tuple[list[list[int]], list[int]]:
        """Ids of whole texts by the tokenizer, but by the other library where that differs, and the numbers of those texts."""
        ours = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        theirs = self.peer.encode(texts, num_threads=1)
        differ = [i for i, (a, b) in enumerate(zip(ours, theirs)) if a != b]
        for i in differ:
            ours[i] = theirs[i]
        return ours, differ

    def _alone(self, words: list[str]) -> None:
        """Keep the ids of words that are encoded one by one."""
        found, differ = self._verified(words)
        self._words.update((w, np.array(ids, np.int32).tobytes()) for w, ids in zip(words, found))
        self._differ.update(words[i] for i in differ)
        self.differing += len(differ)

    def _learn(self, words: list[str]) -> None:
        """Keep the ids of words without spaces: they are encoded as texts, whose ids are cut where a marker begins one."""
        for at in range(0, len(words), 200 * JOINED):
            lines = [words[i:i + JOINED] for i in range(at, min(at + 200 * JOINED, len(words)), JOINED)]
            found, differ = self._verified([" ".join(line) for line in lines])
            for i in differ:
                self._alone(lines[i])
                lines[i] = []
            for line, ids in zip(lines, found):
                ids = np.array(ids, np.int32)
                cuts = 4 * np.append(np.flatnonzero(self._begins[ids]), len(ids))
                data = ids.tobytes()
                self._words.update((w, data[a:b]) for w, a, b in zip(line, cuts[:-1].tolist(), cuts[1:].tolist()))

    def forget(self) -> None:
        """Drop the kept words: the worker lives on, and what it runs next needs the memory."""
        self._words, self._differ = dict(self._space), set()

    def encode_counted(self, texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
        """Ids of every text, without special tokens, and the number of its words whose two encodings differed."""
        if not self.by_word:
            found, differ = self._verified(texts)
            self.differing += len(differ)
            return [np.array(ids, np.int32) for ids in found], np.bincount(differ, minlength=len(texts)).tolist()
        # Words without the space that begins them: the tokenizer puts one before whatever it encodes.
        parts = [_words_of(t) for t in texts]
        new = list(set().union(*parts).difference(self._words))
        if len(self._words) + len(new) > KEPT_WORDS:
            self._words, self._differ = dict(self._space), set()
            new = list(set().union(*parts).difference(self._words))
        self._alone([w for w in new if " " in w])
        self._learn([w for w in new if " " not in w])
        find, differs = self._words.__getitem__, self._differ.__contains__
        counts = [sum(map(differs, words)) for words in parts] if self._differ else [0] * len(parts)
        return [np.frombuffer(b"".join(map(find, words)), np.int32) for words in parts], counts

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text, without special tokens."""
        return self.encode_counted(texts)[0]

    def decode(self, ids) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        text = b"".join(map(self._bytes.__getitem__, ids)).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


_CODECS: dict[str, Codec] = {}


def _codec(path: str) -> Codec:
    """The codec of a model file, built once in a worker."""
    if path not in _CODECS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        with open(SparkFiles.get(os.path.basename(path)), "rb") as f:
            _CODECS[path] = Codec(f.read())
    return _CODECS[path]


def _send(spark: SparkSession, model_path: str) -> None:
    """Send this package and the model file to the executors."""
    ship(spark)
    spark.sparkContext.addFile(model_path)


def _groups(texts: list[str]) -> Iterator[slice]:
    at = taken = 0
    for i, t in enumerate(texts):
        taken += len(t)
        if taken >= BATCH_CHARS:
            yield slice(at, i + 1)
            at, taken = i + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))


def _coded(codec: Codec, part: pa.Array) -> Iterator[tuple[list[str], list[np.ndarray], pa.Array, list[int]]]:
    """Texts, ids, the ids as an Arrow list and the differing words, for a few texts of the part at a time: only the Arrow
    lists need be kept."""
    for at in range(0, len(part), GROUP_ROWS):
        rows = [t or "" for t in part.slice(at, GROUP_ROWS).to_pylist()]
        for group in _groups(rows):
            texts = rows[group]
            ids, differing = codec.encode_counted(texts)
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            yield texts, ids, pa.ListArray.from_arrays(ends, np.concatenate(ids)), differing


def _joined(lists: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(lists) if lists else pa.array([], kind)


def encode(docs: DataFrame, model_path: str, text: str = "text", differing: bool = False) -> DataFrame:
    """``docs`` with token_ids and n_tokens of the text, and on request n_differing; Spark sends the model file to the executors."""
    _send(docs.sparkSession, model_path)

    @F.arrow_udf("token_ids array<int>, n_differing bigint")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(model_path)
        for part in parts:
            lists, counts = [], []
            for _, _, found, differ in _coded(codec, part):
                lists.append(found)
                counts += differ
            yield pa.StructArray.from_arrays(
                [_joined(lists, pa.list_(pa.int32())), pa.array(counts, pa.int64())], ["token_ids", "n_differing"]
            )
        codec.forget()

    more = ["n_differing"] if differing else []
    return docs.select(carried(docs, "token_ids", "n_tokens", *more), of(quoted(text)).alias("coded")).select(
        "row.*", "coded.token_ids", F.size("coded.token_ids").cast("long").alias("n_tokens"), *(f"coded.{c}" for c in more)
    )


def decode(rows: DataFrame, model_path: str) -> DataFrame:
    """``rows`` with the text of their token_ids as ``decoded``."""
    _send(rows.sparkSession, model_path)

    @F.pandas_udf("string")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(model_path)
        for part in parts:
            yield pd.Series([codec.decode(ids) if ids is not None else "" for ids in part], dtype=object)

    return rows.select(*(quoted(c) for c in without(rows, "decoded")), of("token_ids").alias("decoded"))


def round_trip(docs: DataFrame, model_path: str, text: str = "text", differing: bool = False) -> DataFrame:
    """``docs`` with token_ids, n_tokens and same_text: whether the ids decode to the text, in one pass over it.

    On request also n_differing.
    """
    _send(docs.sparkSession, model_path)

    @F.arrow_udf("token_ids array<int>, same_text boolean, n_differing bigint")
    def of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(model_path)
        for part in parts:
            lists, same, counts = [], [], []
            for texts, ids, found, differ in _coded(codec, part):
                lists.append(found)
                same += [codec.decode(i) == t for i, t in zip(ids, texts)]
                counts += differ
            yield pa.StructArray.from_arrays(
                [_joined(lists, pa.list_(pa.int32())), pa.array(same, pa.bool_()), pa.array(counts, pa.int64())],
                ["token_ids", "same_text", "n_differing"],
            )
        codec.forget()

    more = ["n_differing"] if differing else []
    return docs.select(carried(docs, "token_ids", "n_tokens", "same_text", *more), of(quoted(text)).alias("coded")).select(
        "row.*", "coded.token_ids", F.size("coded.token_ids").cast("long").alias("n_tokens"), "coded.same_text",
        *(f"coded.{c}" for c in more),
    )
