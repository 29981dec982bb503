"""SQL expressions shared by the feature blocks.

They are text, so that a table of a hundred columns is one ``selectExpr`` and not a thousand small
driver calls. Arguments are SQL expressions as well.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence


def lit(value) -> str:
    """A literal: a date, a string or a number."""
    if isinstance(value, dt.date):
        return f"DATE'{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(value)


def named(columns: Mapping[str, str]) -> list[str]:
    """``expression AS name`` for every entry, for selectExpr."""
    return [f"{sql} AS `{name}`" for name, sql in columns.items()]


def log_ratio(a: str, b: str) -> str:
    """log(1 + a) - log(1 + b): above zero when a outnumbers b, and defined at zero."""
    return f"(log1p({a}) - log1p({b}))"


def safe_rate(part: str, whole: str) -> str:
    """part / whole for counts, with a zero whole read as one."""
    return f"({part} / greatest({whole}, 1))"


def days_until(day: dt.date, column: str) -> str:
    """Whole days from the column's date to ``day``; negative if the date lies after it."""
    return f"datediff({lit(day)}, {column})"


def total(columns: Iterable[str]) -> str:
    return f"({' + '.join(columns)})"


def date_bucket(column: str, bounds: Sequence[dt.date], open_start: bool = True) -> str:
    """Bucket number of a date among ascending bounds: 1 for the newest, len(bounds) + 1 before the first.

    With ``open_start=False`` the first bound also starts the oldest bucket, and earlier dates get null.
    """
    bounds = sorted(bounds)
    bucket = f"({len(bounds) + 1} - {total(f'int({column} >= {lit(b)})' for b in bounds)})"
    return bucket if open_start else f"if({column} >= {lit(bounds[0])}, {bucket}, NULL)"


def one_hot(column: str, values: Sequence, prefix: str | None = None, names: Mapping | None = None) -> dict[str, str]:
    """0/1 columns for a fixed vocabulary; null and unknown values give 0 everywhere."""
    names = names or {v: f"{prefix or column}_{v}" for v in values}
    return {names[v]: f"int({column} <=> {lit(v)})" for v in values}


def at_least(column: str, bound: float) -> str:
    """1 if the value reaches the bound, else 0; null counts as below."""
    return f"int(coalesce({column} >= {lit(bound)}, false))"


def f1(precision: str, recall: str) -> str:
    """Harmonic mean, 0 when both are 0."""
    return f"if({precision} + {recall} > 0, 2 * {precision} * {recall} / ({precision} + {recall}), 0D)"


def round_doubles(df, digits: int = 9):
    """Round every double column, for comparisons across engines.

    ``round`` goes through decimal text. A small number that is not near a tie takes the quotient of two whole numbers
    instead, which is the same double: both are the nearest to the rounded decimal. Zero has no sign, as after ``round``.
    """
    scale = f"1e{digits}D"

    def rounded(c: str) -> str:
        near = f"abs(abs({c} * {scale} - floor({c} * {scale})) - 0.5D) < 0.01D"
        return f"if(abs({c}) < 1000D AND NOT ({near}), rint({c} * {scale}) / {scale} + 0D, round({c}, {digits}))"

    return df.selectExpr(*[f"{rounded(f'`{c}`')} AS `{c}`" if t == "double" else f"`{c}`" for c, t in df.dtypes])
