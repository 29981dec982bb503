"""Chat formatting: the turns of a conversation as one string with a loss mask, and back.

Turn structs are collected per conversation and sorted; adjacent turns of one role become one block by array
functions; blocks are escaped and concatenated. Everything is a Spark expression.

Template: ``<turn ROLE>`` line feed, texts joined by ``<next>``, ``</turn>`` line feed. In texts and roles ``&`` and ``<``
(in roles also ``>``) are written ``&amp;``, ``&lt;`` (``&gt;``), so no text can hold a control string, and reading back
gives every turn unchanged, merged ones too.

The loss mask is a list of runs (loss, chars) that covers the string from its first code point to its last.

Defined results: turns sort by (turn, role, text), nulls first; a null role or text is an empty one. Repeated rows are
turns of their own. Rows with a null ``conv_id`` are one conversation. Extra columns are ignored; an empty table gives an
empty one. A conversation is one output string, so its turns meet in one task; all work on it is linear in its length
but for :func:`loss_text`, which grows with the number of runs times the length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, OPENED, NEXT, CLOSE = "<turn ", ">\n", "<next>", "</turn>\n"


def _replace(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def escape(text: Column) -> Column:
    return _replace(text, [("&", "&amp;"), ("<", "&lt;")])


def unescape(text: Column) -> Column:
    return _replace(text, [("&gt;", ">"), ("&lt;", "<"), ("&amp;", "&")])


def _blocks(turns: Column) -> Column:
    """Slices of the sorted turns: each holds adjacent turns of one role."""
    starts = F.filter(
        F.sequence(F.lit(0), F.size(turns) - 1),
        lambda i: (i == 0) | (F.get(turns, i)["role"] != F.get(turns, i - 1)["role"]),
    )
    ends = F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(turns)))
    return F.zip_with(starts, ends, lambda a, b: F.slice(turns, a + 1, b - a))


def _opening(block: Column) -> Column:
    role = _replace(escape(F.get(block, F.lit(0))["role"]), [(">", "&gt;")])
    return F.concat(F.lit(OPEN), role, F.lit(OPENED))


def _run(loss: bool, chars: Column | int) -> Column:
    chars = F.lit(chars) if isinstance(chars, int) else chars
    return F.struct(F.lit(loss).alias("loss"), chars.cast("int").alias("chars"))


def _runs(block: Column, loss_role: str) -> Column:
    """Runs of one block: opening, text, (break, text)*, close."""
    opening, close = F.array(_run(False, F.char_length(_opening(block)))), F.array(_run(False, len(CLOSE)))

    def texts(loss: bool) -> Column:
        each = F.transform(block, lambda t: F.array(
            _run(False, len(NEXT)), _run(loss, F.char_length(escape(t["text"])))
        ))
        flat = F.flatten(each)
        return F.slice(flat, F.lit(2), F.size(flat))  # no break before the first text

    trained = F.get(block, F.lit(0))["role"] == F.lit(loss_role)
    return F.concat(opening, F.when(trained, texts(True)).otherwise(texts(False)), close)


def format_conversations(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted and loss_mask for ``rows`` of conv_id, turn, role, text."""
    turn = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    blocks = turns.select("conv_id", _blocks(F.col("turns")).alias("blocks"))
    written = F.transform("blocks", lambda b: F.concat(
        _opening(b), F.array_join(F.transform(b, lambda t: escape(t["text"])), NEXT), F.lit(CLOSE)
    ))
    return blocks.select(
        "conv_id", F.array_join(written, "").alias("formatted"),
        F.flatten(F.transform("blocks", lambda b: _runs(b, loss_role))).alias("loss_mask"),
    )


def turns_of(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted string, merged blocks taken apart."""
    blocks = F.split(formatted, "</turn>\n", -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)  # nothing after the last close

    def texts(block: Column) -> Column:
        parts = F.split(block, ">\n", 2)
        role = unescape(F.substring(F.get(parts, F.lit(0)), F.lit(len(OPEN) + 1), F.char_length(block)))
        return F.transform(F.split(F.get(parts, F.lit(1)), NEXT, -1), lambda t: F.struct(
            role.alias("role"), unescape(t).alias("text")
        ))

    return F.flatten(F.transform(blocks, texts))


def loss_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<string>").alias("texts"))
    parts = F.aggregate(loss_mask, start, lambda acc, run: F.struct(
        (acc["at"] + run["chars"]).alias("at"),
        F.when(run["loss"], F.array_append(
            acc["texts"], F.substring(formatted, acc["at"], run["chars"])
        )).otherwise(acc["texts"]).alias("texts"),
    ), lambda acc: acc["texts"])
    return F.array_join(F.transform(parts, unescape), "")
