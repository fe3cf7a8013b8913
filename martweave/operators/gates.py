"""How long jobs wait behind a gate: intervals merged, and their overlap with any number of others.

While a top-priority job is in a stage, others there may not run. The times it is closed are the union of many overlapping intervals:
entries count +1 and exits -1, and a running sum along time says where it is closed. How much of a wait falls into
closed times needs no join of intervals with intervals: with S the sum of exits less entries of closed times so far, and C
whether it is closed, S + C * t is the time closed up to t, and a wait's part is its difference at both ends.
Everything runs along (stage, time) in range partitions, so a stage that has all jobs is many tasks' work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.functions.scalars import quoted
from martweave.operators.ordering import row_index, running_totals
from martweave.session import parked


def micros(moment: Column) -> Column:
    """Microseconds of a zone-free timestamp since 1970."""
    gap = moment - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (gap.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("bigint")


def merge_intervals(df: DataFrame, start: str, end: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by, start, end) of the union of the intervals of each group; touching ones are one.

    ``start`` and ``end`` are zone-free timestamps. Intervals that lack an end or do not last are left out; NULL groups are groups.
    """
    keys = [quoted(c) for c in by]
    lasting = df.where(quoted(start) < quoted(end))
    change = F.explode(F.array(F.struct(quoted(start).alias("at"), F.lit(1).cast("bigint").alias("step")), F.struct(quoted(end).alias("at"), F.lit(-1).cast("bigint").alias("step"))))
    steps = lasting.select(*keys, change.alias("c")).groupBy(*keys, F.col("c.at").alias("at")).agg(F.sum("c.step").alias("step"))
    running = running_totals(steps, [*by, "at"], {"inside": "step"})
    # Each union begins where the sum leaves zero and ends where it is back there, in turns.
    edges = running.where((F.col("inside") == 0) != (F.col("inside") == F.col("step"))).select(*keys, "at")
    numbered = row_index(edges, [*by, "at"], name="edge")
    pairs = numbered.groupBy(*keys, F.expr("(edge - 1) div 2").alias("edge"))
    return pairs.agg(F.min("at").alias(start), F.max("at").alias(end)).drop("edge")


def covered_seconds(df: DataFrame, start: str, end: str, merged: DataFrame, merged_start: str, merged_end: str, by: Sequence[str] = (), name: str = "covered_seconds") -> DataFrame:
    """``df`` with the seconds of each of its intervals that lie in ``merged`` intervals of its group.

    ``merged`` holds intervals that do not overlap within a group, as ``merge_intervals`` gives. Intervals that lack an end or do not
    last are covered for no time. Rows may be equal.
    """
    keys = [quoted(c) for c in by]
    rows = parked(df.withColumn("_id", F.monotonically_increasing_id()), "intervals")

    def points(frame: DataFrame, at: Column, closes: int, weight: Column, row: Column, sign: int) -> DataFrame:
        return frame.select(
            *keys, at.alias("at"), F.lit(closes).cast("bigint").alias("closes"), weight.alias("weight"), row.alias("_id"), F.lit(sign).cast("bigint").alias("sign")
        )

    none, zero = F.lit(None).cast("bigint"), F.lit(0).cast("bigint")
    lasting = rows.where(quoted(start) < quoted(end))
    every = [
        points(merged, quoted(merged_start), 1, -micros(quoted(merged_start)), none, 0),
        points(merged, quoted(merged_end), -1, micros(quoted(merged_end)), none, 0),
        points(lasting, quoted(start), 0, zero, F.col("_id"), -1),
        points(lasting, quoted(end), 0, zero, F.col("_id"), 1),
    ]
    along = every[0]
    for more in every[1:]:
        along = along.unionByName(more)
    # At one moment the order does not matter: S + C * t is the same before and after an edge at t.
    summed = running_totals(along, [*by, "at", "_id", "sign", "closes"], {"s": "weight", "c": "closes"})
    closed = F.col("s") + F.col("c") * micros(F.col("at"))
    each = summed.where(F.col("_id").isNotNull()).groupBy("_id").agg((F.sum(closed * F.col("sign")) / 1_000_000).alias("_seconds"))
    joined = rows.join(each, "_id", "left")
    return joined.select(*map(quoted, df.columns), F.coalesce("_seconds", F.lit(0.0)).alias(name))
