"""Size checks that decide whether one side of a join may be broadcast.

Spark's own threshold works from file sizes. Behind joins and filters it must guess, and by the
time it knows better the large side may already have been shuffled. Where a job looks at its
small side anyway, the measured size decides instead; a side above the limit is left to Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.functions.scalars import quoted

BROADCAST_BYTES = 64 * 1024 * 1024
_VALUE_OVERHEAD = 16


@dataclass(frozen=True)
class KeySize:
    """Distinct non-NULL keys, the bytes they take and the most rows any of them has."""

    keys: int
    size_bytes: int
    most_rows: int

    @property
    def small(self) -> bool:
        return self.size_bytes <= BROADCAST_BYTES


def key_size(df: DataFrame, keys: Sequence[str]) -> KeySize:
    """Measure the keys of ``df``. Reads key columns only and aggregates before the shuffle."""
    columns = [quoted(k) for k in keys]
    counts = df.dropna(subset=list(keys)).groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))
    row = counts.agg(
        F.count(F.lit(1)).alias("keys"),
        F.coalesce(F.sum(_bytes(columns)), F.lit(0)).alias("size_bytes"),
        F.coalesce(F.max("_rows"), F.lit(0)).alias("most_rows"),
    ).first()
    return KeySize(row["keys"], row["size_bytes"], row["most_rows"])


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint when its measured size allows that."""
    measured = df.agg(F.coalesce(F.sum(_bytes([quoted(c) for c in df.columns])), F.lit(0)).alias("size_bytes")).first()
    return F.broadcast(df) if measured["size_bytes"] <= BROADCAST_BYTES else df


def _bytes(columns: Sequence[Column]) -> Column:
    total = F.lit(0).cast("bigint")
    for column in columns:
        total = total + F.coalesce(F.octet_length(column.cast("string")), F.lit(0)) + F.lit(_VALUE_OVERHEAD)
    return total
