"""Additive measures per key, from which every feature block is derived.

One aggregation over the daily cube computes the measures for (user, category, shop). Each measure merges with
itself (sum, min, max, bitwise or), so coarser keys roll up from the finer table. Distinct candidate days are kept as
bit sets, which roll up where a distinct count would not.

Distinct days of the whole history are *day words*: rows of (key, word number, 64 days as bits), as many as the
history of a key has words with an action, so the schema is the same for 50 days and for 100 years. They merge by bitwise or,
roll up like the measures, and are counted by bit_count after the days outside a window have been masked.

Names: ``n2_7`` order rows in the last 7 days, ``d2_7`` the same without repeats, scopes ``cand``
(candidate days) and ``hist`` (everything up to the window end).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.scalars import total
from cartwise.operators.cube import triple_days
from cartwise.operators.windows import RECENT_DAYS, WindowSpec
from cartwise.sources.schemas import BROWSE, CART, ORDER

WORD = 64  # days per bit set
#: Distinct order days and active days of the whole history.
ORDER_DAYS, HISTORY_DAYS = "order_days", "hist_days"
UCS = ("user_id", "cate", "shop_id")
_EPOCH = dt.date(1970, 1, 1)


@dataclass(frozen=True)
class Measure:
    name: str
    sql: str  # aggregate over the rows of a key in the cube
    merge: str  # aggregate that combines two partial values


def candidate_words(spec: WindowSpec) -> list[str]:
    """Names of the bit sets of the candidate days, one per 64 of them."""
    return ["cand_days", *(f"cand_days_{k}" for k in range(1, -(-spec.days // WORD)))]


def _day_set(inside: str, first: int = 0) -> str:
    """Bit set of the days for which ``inside`` holds; bit k stands for ``first + k`` days before the end."""
    return f"bit_or(if({inside}, shiftleft(1L, age - {first}), 0L))"


@lru_cache(maxsize=64)
def measures(spec: WindowSpec) -> tuple[Measure, ...]:
    found: list[Measure] = []

    def add(name: str, sql: str, merge: str) -> None:
        found.append(Measure(name, sql, merge))

    # Raw counts, by action code and range.
    for n in RECENT_DAYS:
        for code in (1, 2, 3, 4):
            add(f"n{code}_{n}", f"sum(if(age < {n}, n{code}, 0L))", "sum")
    add(f"n{CART}_1", f"sum(if(age < 1, n{CART}, 0L))", "sum")
    for code in (1, 2, 3, 4):
        add(f"n{code}_hist", f"sum(n{code})", "sum")

    # Counts of distinct actions.
    cand = f"age < {spec.days}"
    scopes = {
        "1": ("age < 1", (1, 5)),
        "3": ("age < 3", (1, 2, 3, 4)),
        "5": ("age < 5", (1, 2, 3, 4)),
        "7": ("age < 7", (1, 2, 3, 4)),
        "cand": (cand, (1, 2, 3, 4, 5)),
        "hist": ("true", (1, 2, 3, 4)),
    }
    for scope, (inside, codes) in scopes.items():
        for code in codes:
            add(f"d{code}_{scope}", f"sum(if({inside}, d{code}, 0L))", "sum")
    add("d_cand", f"sum(if({cand}, d, 0L))", "sum")

    # First and last days.
    add("browse_first", f"min(if(n{BROWSE} > 0, action_time, NULL))", "min")
    add("order_first", f"min(if(n{ORDER} > 0, action_time, NULL))", "min")
    add("order_last", f"max(if(n{ORDER} > 0, action_time, NULL))", "max")
    for code in (1, 2, 3, 5):
        add(f"recent_{code}", f"max(if(n{code} > 0 AND {cand}, action_time, NULL))", "max")

    # Day sets.
    for k, name in enumerate(candidate_words(spec)):
        first, last = k * WORD, min(spec.days, (k + 1) * WORD) - 1
        add(name, _day_set(f"age BETWEEN {first} AND {last}", first), "bit_or")
    return tuple(found)


def measure_triples(cube: DataFrame, spec: WindowSpec, by_user: int | None = None, tasks: int | None = None) -> DataFrame:
    """All measures per (user, category, shop) over the days up to the window end, and its distinct days.

    The rows of a triple are at most its days, so the narrow rows are clustered and aggregated where they land: measured at
    half the time, because partial results are several times wider than the rows they stand for. A triple has one row a
    day, so its distinct days are counts; one with a null key has none, as in the coarser keys, which find days by key.

    ``by_user`` clusters by user into so many partitions instead, where the rows of a user are known to be few. Otherwise
    ``tasks`` is the number of partitions; without it the session's number holds, and AQE merges them by their narrow bytes.
    """
    rows = triple_days(cube, spec)
    if by_user is not None:
        rows = rows.repartition(by_user, "user_id")
    else:
        rows = rows.repartition(*UCS) if tasks is None else rows.repartition(tasks, *UCS)
    unknown = " OR ".join(f"{k} IS NULL" for k in UCS)
    days = {ORDER_DAYS: f"count_if(n{ORDER} > 0)", HISTORY_DAYS: "count(*)"}
    return rows.groupBy(*UCS).agg(
        *[F.expr(f"{m.sql} AS {m.name}") for m in measures(spec)],
        *[F.expr(f"if({unknown}, 0L, {sql}) AS {name}") for name, sql in days.items()],
    )


def measure_by_user(cube: DataFrame, spec: WindowSpec, keys: Sequence[str], by_user: int) -> DataFrame:
    """All measures per ``keys``, a user among them, from the narrow rows of the cube, clustered by user into so many partitions.

    The same as rolling up the triples, whose rows are some ten times wider and nearly as many.
    """
    rows = triple_days(cube, spec).repartition(by_user, "user_id")
    return rows.groupBy(*keys).agg(*[F.expr(f"{m.sql} AS {m.name}") for m in measures(spec)])


def roll_up(finer: DataFrame, spec: WindowSpec, keys: Sequence[str], *extra: str) -> DataFrame:
    """Merge a measure table onto a subset of its keys; ``extra`` adds aggregates over the finer rows."""
    merged = [F.expr(f"{m.merge}({m.name}) AS {m.name}") for m in measures(spec)]
    return finer.groupBy(*keys).agg(*merged, *[F.expr(e) for e in extra])


def day_words(cube: DataFrame, keys: Sequence[str], by_user: int | None = None) -> DataFrame:
    """Day words of all days of the cube: keys, ``word``, and the days with an order and with any action as bits.

    ``by_user`` as in :func:`measure_triples`.
    """
    day = "unix_date(action_time)"
    rows = cube.where("by_product = 0").selectExpr(
        *keys, f"shiftright({day}, 6) AS word", f"shiftleft(1L, {day} & 63) AS any_bits", f"n{ORDER} > 0 AS ordered"
    )
    rows = rows if by_user is None else rows.repartition(by_user, "user_id")
    return rows.groupBy(*keys, "word").agg(
        F.expr("bit_or(if(ordered, any_bits, 0L)) AS order_bits"), F.expr("bit_or(any_bits) AS any_bits")
    )


def roll_words(finer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Day words on a subset of their keys."""
    return finer.groupBy(*keys, "word").agg(F.expr("bit_or(order_bits) AS order_bits"), F.expr("bit_or(any_bits) AS any_bits"))


def count_days(words: DataFrame, spec: WindowSpec, keys: Sequence[str]) -> DataFrame:
    """Distinct days of the window's history per key, as ``order_days`` and ``hist_days``; ``words`` has these keys.

    A key without any such day has no row, or zeros if a word at the edge has other days of it.
    """
    last = (spec.end - _EPOCH).days
    inside, masks = f"word <= {last >> 6}", [f"if(word = {last >> 6}, {_signed((2 << (last & 63)) - 1)}L, -1L)"]
    if spec.history_start is not None:
        first = (spec.history_start - _EPOCH).days
        inside += f" AND word >= {first >> 6}"
        masks.append(f"if(word = {first >> 6}, {_signed(-1 << (first & 63))}L, -1L)")
    return words.where(inside).groupBy(*keys).agg(*[
        F.expr(f"sum(bigint(bit_count({' & '.join([bits, *masks])}))) AS {name}")
        for bits, name in (("order_bits", ORDER_DAYS), ("any_bits", HISTORY_DAYS))
    ])


def _signed(bits: int) -> int:
    """The signed 64-bit integer of the lowest 64 bits."""
    bits &= (1 << 64) - 1
    return bits - (1 << 64) if bits >> 63 else bits


def spine(table: DataFrame) -> DataFrame:
    """Keys with any action in the candidate days."""
    return table.where(" OR ".join(f"{c} != 0" for c in table.columns if c.startswith("cand_days")))


def recent_mask(n: int) -> str:
    """The candidate day set cut to the last n days."""
    return f"(cand_days & {(1 << n) - 1}L)"


def seen_in(n: int) -> str:
    """True for a key with any action in the last n days."""
    return f"({recent_mask(n)} != 0)"


def days_in(*words: str) -> str:
    """Number of distinct days in the given bit sets."""
    return total(f"bigint(bit_count({w}))" for w in words)
