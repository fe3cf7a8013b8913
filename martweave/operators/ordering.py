"""Row numbers, chunks and pages over tables of any size.

``row_number()`` over one global window, or over a few large groups, puts a whole group into
one task. Here the table is range-partitioned on the full ordering instead, which also splits
a hot leading value, and each row gets its position inside its partition. Partition sizes turn
these positions into global ones: one small row per partition is all that is collected.

The ranged rows are written to the shared scratch folder first. Range bounds come from a sample
and may differ when a plan runs again, so both the partition sizes and the positions must be
read from one written copy; the copy also survives the loss of executors.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from martweave.functions.scalars import printed_bytes, quoted
from martweave.operators.sizing import broadcast_if_small
from martweave.session import parked

# monotonically_increasing_id keeps the partition above, and the row within it below, this bit.
_ROW_BITS = 33
_SHALLOW_PAGE_ROWS = 100_000
# Chunks are cut anew after so many times their bound.
_CHUNKS_PER_STRETCH = 32


def row_index(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    name: str = "row_index",
    ranges: int | None = None,
    unique: bool = True,
) -> DataFrame:
    """1-based position of each row by ``order_by``, within each ``partition_by`` group if given.

    NULLs come first. ``ranges`` fixes the number of range partitions; by default Spark sizes
    them. An ordering that leaves many rows equal needs ``unique=False``: a range cannot split
    equal rows, so they are told apart by a number written down with them beforehand.
    """
    columns = [quoted(c) for c in [*partition_by, *order_by]]
    rows = df
    if not unique:
        rows = parked(df.withColumn("_tie", F.monotonically_increasing_id()), "row-ties")
        columns.append(F.col("_tie"))
    spread = rows.repartitionByRange(*columns) if ranges is None else rows.repartitionByRange(ranges, *columns)
    placed = parked(
        spread.sortWithinPartitions(*columns).drop("_tie").withColumn("_pos", F.monotonically_increasing_id()),
        "row-index",
    )
    part = F.shiftright("_pos", _ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    within = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per range partition, so the broadcast is bounded by the partition count.
    numbered = (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + within + 1)
        .select(*[quoted(c) for c in df.columns], quoted(name))
    )
    return _restart_per_group(numbered, partition_by, name) if partition_by else numbered


def _restart_per_group(numbered: DataFrame, partition_by: Sequence[str], name: str) -> DataFrame:
    """Groups are contiguous in the global order, so each starts over at its lowest number."""
    firsts = numbered.groupBy(*[quoted(c).alias(f"_group_{c}") for c in partition_by]).agg(
        F.min(quoted(name)).alias("_first")
    )
    same_group: Column = F.lit(True)
    for column in partition_by:
        same_group = same_group & quoted(column).eqNullSafe(quoted(f"_group_{column}"))
    others = [quoted(c) for c in numbered.columns if c != name]
    # Joining on a few large groups would shuffle each to one task; few groups are broadcast.
    return numbered.join(broadcast_if_small(firsts), same_group).select(*others, (quoted(name) - F.col("_first") + 1).alias(name))


def chunk_ids(
    df: DataFrame, order_by: Sequence[str], rows_per_chunk: int, name: str = "chunk_id", unique: bool = True
) -> DataFrame:
    """0-based chunk of each row; chunks hold ``rows_per_chunk`` rows, the last what remains."""
    if rows_per_chunk < 1:
        raise ValueError("rows_per_chunk must be positive")
    indexed = row_index(df, order_by, name="_index", unique=unique)
    return _chunked(indexed, df.columns, rows_per_chunk, name)


def chunk_ids_by_bytes(
    df: DataFrame,
    order_by: Sequence[str],
    max_bytes: int,
    size: Column | None = None,
    name: str = "chunk_id",
    unique: bool = True,
) -> DataFrame:
    """0-based chunk of each row; chunks are runs of the ordering of at most ``max_bytes`` each.

    ``size`` is the bytes of a row (default: ``printed_bytes`` of all columns). A row above half the bound is a chunk
    of its own, above the bound too. The others are cut by the running sum of bytes: with no row larger than m, those that
    start in the same ``max_bytes - m`` bytes fit together whatever came before, so no cut depends on
    another one. m is taken anew for every stretch of 32 bounds, and a stretch begins a chunk.

    No window spans the table: see ``running_totals``; the chunks, one row each, are numbered by ``row_index``.
    """
    if max_bytes < 1:
        raise ValueError("max_bytes must be positive")
    size = (printed_bytes(df.columns) if size is None else size).cast("bigint")
    heavy = (size * 2 > max_bytes).cast("bigint")
    summed = running_totals(df.withColumns({"_size": size, "_heavy": heavy}), order_by, {"_end": "_size", "_heavies": "_heavy"}, unique)
    # Each heavy row opens a run for itself and one for what follows it.
    offset = summed.withColumns({"_start": F.col("_end") - F.col("_size"), "_run": F.col("_heavies") * 2 - F.col("_heavy")})
    stretch = max_bytes * _CHUNKS_PER_STRETCH
    offset = offset.withColumn("_stretch", F.expr(f"_start div {stretch}L"))
    largest = offset.groupBy("_stretch").agg(F.coalesce(F.max(F.when(F.col("_heavy") == 0, F.col("_size"))), F.lit(0)).alias("_most"))
    offset = offset.join(broadcast_if_small(parked(largest, "stretches")), "_stretch")
    offset = offset.withColumn("_block", F.expr(f"(_start - _stretch * {stretch}L) div ({max_bytes}L - _most)"))
    keys = ["_stretch", "_run", "_block"]
    # The keys ascend along the ordering, and there are as many as chunks.
    numbered = parked(row_index(offset.select(*keys).distinct(), keys, name="_index"), "chunks")
    return offset.join(broadcast_if_small(numbered), keys).select(*[quoted(c) for c in df.columns], (F.col("_index") - 1).alias(name))


def running_totals(df: DataFrame, order_by: Sequence[str], totals: dict[str, str], unique: bool = True) -> DataFrame:
    """``df`` with sums of bigint columns along the ordering (NULL first), each row's own value included: name -> summed column.

    Values add up within range partitions as the rows stream through in their order, where a window would need another shuffle;
    one row per partition offsets them. The rows are written once, so that both agree. NULL adds nothing.
    An ordering that leaves many rows equal takes ``unique=False``.
    """
    columns, rows = [quoted(c) for c in order_by], df
    if not unique:
        rows = parked(df.withColumn("_tie", F.monotonically_increasing_id()), "row-ties")
        columns.append(F.col("_tie"))
    ordered = rows.repartitionByRange(*columns).sortWithinPartitions(*columns).drop("_tie")
    names, summed = list(totals), list(totals.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = [0] * len(names)
        for batch in batches:
            sums = [end + np.cumsum(batch.column(c).fill_null(0).to_numpy()) for end, c in zip(ends, summed, strict=True)]
            if batch.num_rows:
                ends = [int(s[-1]) for s in sums]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, sums)], [*batch.schema.names, *names])

    schema = StructType([*ordered.schema.fields, *(StructField(n, LongType()) for n in names)])
    placed = parked(ordered.mapInArrow(run, schema).withColumn("_part", F.spark_partition_id()), "running-totals")
    parts = placed.groupBy("_part").agg(*(F.sum(quoted(c)).alias(f"_of_{n}") for n, c in totals.items()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range partition.
    starts = parts.select("_part", *(F.coalesce(F.sum(f"_of_{n}").over(before), F.lit(0)).alias(f"_to_{n}") for n in names))
    whole = placed.join(F.broadcast(starts), "_part")
    return whole.select(*map(quoted, df.columns), *((quoted(n) + F.col(f"_to_{n}")).alias(n) for n in names))


def batch_ids(
    df: DataFrame, order_by: Sequence[str], batches: int = 10, name: str = "batch_id", unique: bool = True
) -> DataFrame:
    """0-based batch of each row; at most ``batches`` batches of ``ceil(rows / batches)`` rows."""
    if batches < 1:
        raise ValueError("batches must be positive")
    indexed = row_index(df, order_by, name="_index", unique=unique)
    size = max(1, -(-indexed.count() // batches))
    return _chunked(indexed, df.columns, size, name)


def _chunked(indexed: DataFrame, columns: Sequence[str], size: int, name: str) -> DataFrame:
    # Integer division: a double would round positions beyond 2**53.
    chunk = F.expr(f"(_index - 1) div {size}")
    return indexed.select(*[quoted(c) for c in columns], chunk.alias(name))


def chunk_actions(chunked: DataFrame, chunk: str = "chunk_id", name: str = "action") -> DataFrame:
    """First piece of a table replaces, later pieces insert."""
    return chunked.withColumn(name, F.when(quoted(chunk) == 0, "replace").otherwise("insert"))


def page(df: DataFrame, order_by: Sequence[str], offset: int, rows: int, unique: bool = True) -> DataFrame:
    """``rows`` rows after skipping ``offset``, in order. ``unique=False`` for orderings with many equal rows.

    Spark answers shallow pages with a per-task top-k merged on the driver; a deep page would
    merge ``offset + rows`` rows there, so it goes through ``row_index`` instead.
    """
    if offset + rows <= _SHALLOW_PAGE_ROWS:
        return df.orderBy(*[quoted(c) for c in order_by]).offset(offset).limit(rows)
    indexed = row_index(df, order_by, name="_index", unique=unique)
    return indexed.where((F.col("_index") > offset) & (F.col("_index") <= offset + rows)).orderBy("_index").drop("_index")


def preview(df: DataFrame, order_by: Sequence[str] = (), rows: int = 5) -> DataFrame:
    """A few rows to look at."""
    return df.orderBy(*[quoted(c) for c in order_by]).limit(rows) if order_by else df.limit(rows)
