"""Upsert and delete on a partitioned directory table, rewriting only the partitions touched."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martweave.functions.scalars import quoted
from martweave.operators.actions import delete_where, latest_per_key, put_rows, require_unique, without_keys
from martweave.plans.key_index import files_with_keys, update_key_index
from martweave.session import delete_path, parked, scratch_scope
from martweave.sources.files import overwrite_partitions

# Fixed values.
MAX_DYNAMIC_PARTITIONS = 10_000


def upsert_partitions(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str],
    condition: Column | str | None = None,
    latest_by: Sequence[str] = (),
    rows_move: bool = True,
    max_partitions: int | None = MAX_DYNAMIC_PARTITIONS,
    key_index: bool = False,
) -> int:
    """Upsert ``source`` into the table at ``path``; returns how many partitions were rewritten.

    A partition is touched when the source brings a row for it, when it holds a row whose key
    the source has, or when ``condition`` deletes from it. Finding them reads the key and
    partition columns of the table; with ``rows_move=False`` (a key always stays in its
    partition) the table outside the source's own partitions is not searched for keys at all.
    Running the same upsert again gives the same table, so repeating it after a failure is safe.

    ``key_index`` looks the source's keys up in the index beside the table (see ``key_index``), so that only files that
    may hold one of them are searched, and keeps it up after the write. The result is the same.

    Partitions are switched one by one at the end of the write; where readers need all or
    nothing, publish a release instead.
    """
    with scratch_scope(spark):
        # Several passes decide what to rewrite, and all must see the same rows.
        rows = parked(latest_per_key(source, keys, latest_by) if latest_by else source, "upsert-source")
        touched = _upsert_parked(spark, path, rows, list(keys), list(partition_by), condition, rows_move, max_partitions, key_index)
    if key_index:
        update_key_index(spark, path, keys, partition_by)
    return touched


def _upsert_parked(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    keys: list[str],
    partition_by: list[str],
    condition: Column | str | None,
    rows_move: bool,
    max_partitions: int | None,
    key_index: bool,
) -> int:
    target = _read_typed(spark, path, source.schema, partition_by)
    known = {c.lower() for c in target.columns}
    added = [c for c in source.columns if c.lower() not in known]
    if added:
        raise ValueError(f"columns {', '.join(added)} are not in the table at {path}; add them to it first")
    small = require_unique(source, keys).small

    incoming = _partitions(source, partition_by, max_partitions)
    searched = target
    if key_index and rows_move:
        files = files_with_keys(spark, path, source, keys, partition_by, target.schema)
        if files is not None:
            searched = spark.read.schema(target.schema).option("basePath", path).parquet(*files) if files else target.limit(0)
    leaving = _leaving_rows(target, searched, source, keys if rows_move else [], condition, small)
    outgoing = _partitions(leaving, partition_by, max_partitions)
    touched = incoming | outgoing
    _refuse_beyond(max_partitions, touched)
    if not touched:
        return 0
    # No output row names a partition that the upsert empties, so the overwrite would leave its
    # old rows in place. Only partitions that lose rows and gain none can be emptied.
    losing = outgoing - incoming
    emptied: set[tuple] = set()
    if losing:
        before = target.where(_in_partitions(target, losing, partition_by))
        kept = before if condition is None else delete_where(before, condition)
        emptied = losing - _partitions(without_keys(kept, source, keys, small), partition_by, None)

    _rewrite(
        spark,
        path,
        target,
        touched,
        emptied,
        partition_by,
        lambda before: put_rows(before, source, keys, condition, small),
    )
    return len(touched)


def delete_from_partitions(
    spark: SparkSession,
    path: str,
    condition: Column | str,
    partition_by: Sequence[str],
    schema: StructType | None = None,
    max_partitions: int | None = MAX_DYNAMIC_PARTITIONS,
    key_index: Sequence[str] = (),
) -> int:
    """Delete by predicate, rewriting only the partitions that hold matching rows. ``key_index`` names the keys of an index to keep up.

    Without ``schema`` Spark infers the types of the partition columns from directory names.
    """
    target = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
    predicate = F.expr(condition) if isinstance(condition, str) else condition
    touched = _partitions(target.where(predicate), partition_by, max_partitions)
    if not touched:
        return 0
    _refuse_beyond(max_partitions, touched)
    before = target.where(_in_partitions(target, touched, partition_by))
    emptied = touched - _partitions(delete_where(before, predicate), partition_by, None)
    _rewrite(spark, path, target, touched, emptied, partition_by, lambda rows: delete_where(rows, predicate))
    if key_index:
        update_key_index(spark, path, key_index, partition_by)
    return len(touched)


def _read_typed(spark: SparkSession, path: str, like: StructType, partition_by: Sequence[str]) -> DataFrame:
    """The table with partition columns of the source's types; names such as ``01`` would read as numbers."""
    types = {name.lower(): like[name].dataType for name in like.names}
    wanted = {name.lower() for name in partition_by}
    fields = [
        StructField(f.name, types[f.name.lower()] if f.name.lower() in wanted else f.dataType)
        for f in spark.read.parquet(path).schema.fields
    ]
    return spark.read.schema(StructType(fields)).parquet(path)


def _rewrite(
    spark: SparkSession,
    path: str,
    target: DataFrame,
    touched: set[tuple],
    emptied: set[tuple],
    partition_by: Sequence[str],
    change: Callable[[DataFrame], DataFrame],
) -> None:
    """Replace the touched partitions by ``change`` of their rows and remove the emptied ones."""
    _assert_same_directories(target.where(_in_partitions(target, touched, partition_by)), partition_by)
    rewritten = touched - emptied
    if rewritten:
        # Dynamic overwrite writes beside the table and switches directories when all tasks are done.
        before = target.where(_in_partitions(target, rewritten, partition_by))
        overwrite_partitions(change(before), path, partition_by)
    _drop_partitions(spark, target, emptied, partition_by)


def _assert_same_directories(rows: DataFrame, partition_by: Sequence[str]) -> None:
    """Raise when a partition would be written back under another name than it has.

    A directory ``m=01`` read as the number 1 would come back as ``m=1`` beside the old one.
    Text keeps directory names as they are and needs no check.
    """
    # Directory names are escaped once by the table format and once more in the URI.
    path = _uri_decoded(_uri_decoded(F.col("_metadata.file_path")))
    for name in partition_by:
        if rows.schema[name].dataType == StringType():
            continue
        directory = F.concat(F.lit(f"/{name}="), quoted(name).cast("string"), F.lit("/"))
        other = rows.where(quoted(name).isNotNull() & ~F.contains(path, directory))
        if other.take(1):
            raise ValueError(f"partition directories of '{name}' do not match its type; use text for it")


def _leaving_rows(
    target: DataFrame, searched: DataFrame, source: DataFrame, keys: Sequence[str], condition: Column | str | None, small: bool
) -> DataFrame:
    """Target rows that the upsert replaces (when ``keys`` are given; all of them are in ``searched``) or deletes."""
    leaving = target.limit(0)
    if keys:
        changed = source.select(*[quoted(k) for k in keys])
        leaving = searched.join(F.broadcast(changed) if small else changed, list(keys), "left_semi").select(*target.columns)
    if condition is None:
        return leaving
    predicate = F.expr(condition) if isinstance(condition, str) else condition
    return leaving.unionByName(target.where(predicate))


def _partitions(df: DataFrame, partition_by: Sequence[str], at_most: int | None) -> set[tuple]:
    """Distinct partition values; with a limit, no more than one beyond it reach the driver."""
    found = df.select(*[quoted(c) for c in partition_by]).distinct()
    return {tuple(row) for row in (found if at_most is None else found.limit(at_most + 1)).collect()}


def _refuse_beyond(max_partitions: int | None, touched: set[tuple]) -> None:
    if max_partitions is not None and len(touched) > max_partitions:
        raise ValueError(f"more than {max_partitions} partitions change; raise max_partitions or rewrite the table as a release")


def _in_partitions(rows: DataFrame, values: set[tuple], partition_by: Sequence[str]) -> Column:
    """Literal predicate on the partition columns, so the scan is pruned to these partitions.

    One set lookup over all columns: its size does not nest, and NULL equals NULL in a struct.
    """
    kind = StructType([StructField(f"c{i}", rows.schema[name].dataType) for i, name in enumerate(partition_by)])
    wanted = [F.struct(*[F.lit(v) for v in value]).cast(kind) for value in values]
    return F.struct(*[quoted(name) for name in partition_by]).cast(kind).isin(wanted)


def _uri_decoded(path: Column) -> Column:
    """A path as the file system has it. In the path of a URI a plus sign is just that."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _drop_partitions(spark: SparkSession, target: DataFrame, emptied: set[tuple], partition_by: Sequence[str]) -> None:
    """Remove the files of emptied partitions through the file system Spark reads them with."""
    if not emptied:
        return
    file = F.col("_metadata.file_path")
    folders = target.where(_in_partitions(target, emptied, partition_by)).select(
        _uri_decoded(F.regexp_extract(file, r"^(.*)/[^/]*$", 1)).alias("folder")
    )
    # One folder per emptied partition.
    for row in folders.distinct().collect():
        if not delete_path(spark, row["folder"]):
            raise OSError(f"{row['folder']} holds rows that have left it, but could not be removed")
