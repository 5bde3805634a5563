"""When a table may be broadcast: its rows and text bytes are counted first."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LookupLimits:
    """When to broadcast a vocabulary table, and how finely to cut a hot term.

    Tables within both broadcast limits are broadcast. Larger ones are joined
    by shuffle, where a term with more than ``rows_per_slice`` rows is spread
    over several tasks. At most ``hot_terms`` such terms are broadcast; beyond,
    slices grow.
    """

    broadcast_rows: int = 1_000_000
    broadcast_bytes: int = 64 << 20
    rows_per_slice: int = 2_000_000
    hot_terms: int = 1_000_000

    def allow(self, rows: int, size: int) -> bool:
        return rows <= self.broadcast_rows and size <= self.broadcast_bytes


def text_bytes(texts: list[str], lists: list[str]) -> Column:
    """Aggregate: bytes held by text columns and by columns of text lists."""
    width = F.lit(0)
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    for name in lists:
        width = width + F.coalesce(F.octet_length(F.array_join(name, ",")), F.lit(0))
    return F.coalesce(F.sum(width.cast("long")), F.lit(0))


def fits_broadcast(keys: DataFrame, columns: list[str], limits: LookupLimits) -> bool:
    """Whether a key table, cut to ``columns``, is small enough to broadcast.

    The same scan checks that keys are unique; a repeated one raises ``ValueError``
    at any size. Rows without a key match nothing and may repeat.
    """
    lists = [name for name in columns if name == "lineage"]
    each = keys.groupBy("key").agg(
        F.count("key").alias("rows"), text_bytes(["key", "concept"], lists).alias("size")
    )
    rows, size, most = each.select(
        F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("size"), F.lit(0)), F.max("rows")
    ).first()
    if most is not None and most > 1:
        raise ValueError("a key of the vocabulary is held by several rows")
    return limits.allow(rows, size)
