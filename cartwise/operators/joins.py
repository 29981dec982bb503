"""Lookup joins whose broadcast depends on a measured size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a lookup table for broadcast if its measured size allows it.

    The size is 16 bytes per column and row plus the bytes of every string, from one aggregate over the
    table. Larger tables are returned as they are, and the join shuffles, with skew splits by AQE.
    """
    text = [c for c, t in df.dtypes if t == "string"]
    sizes = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in text]
    row = df.agg(F.count("*"), *sizes).first()
    size = row[0] * 16 * len(df.columns) + sum(row[1:])
    return F.broadcast(df) if size <= max_bytes else df


def left_lookup(left: DataFrame, right: DataFrame, on: Sequence[str], defaults: dict | None = None) -> DataFrame:
    """Left join on named keys, with a default per column where the key is missing."""
    joined = left.join(right, list(on), "left")
    return joined.fillna(defaults) if defaults else joined
