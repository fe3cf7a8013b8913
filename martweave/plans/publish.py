"""Apply action lists and publish all tables of a mart as one verified release.

A release lives in ``<root>/release=<run_id>/<table>``. The log ``<root>/releases`` names the
directory of every table per release; readers follow its last entry. Writing that entry is the
only switch, so a failed table leaves the previous release current and its own files in place
for inspection. Tables that did not change keep their earlier directory and are not rewritten.

The entry of a release is one file, named by its number and created only if no other publisher has that number. Who comes
second reads the log again: if the other release changed none of the same tables, both are joined under the next number,
else the second one fails and nothing is lost.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martweave.functions.scalars import quoted
from martweave.model import TableAction
from martweave.operators import actions as act
from martweave.operators.verify import checksum_aggregates, table_checksum
from martweave.session import delete_path, move_new, path_exists
from martweave.sources.files import clustered

LOG_SCHEMA = (
    "sequence bigint, run_id string, published_at timestamp_ntz, table_name string, path string, "
    "row_count bigint, checksum string, table_schema string"
)
_TABLE_COLUMNS = ("path", "row_count", "checksum", "table_schema")
# Fixed value.
PARALLEL_TABLES = 4
_NEEDS_SOURCE = ("replace", "append", "insert", "upsert")


class PublishError(RuntimeError):
    """A written table does not match what was to be written."""


class PublishConflict(PublishError):
    """Another release changed the same tables first; make the content anew from it and publish again."""


@dataclass(frozen=True)
class StagedTable:
    """A table written and checked, but not yet visible to readers."""

    path: str
    row_count: int
    checksum: str


def new_run_id() -> str:
    """One identifier per run, made on the driver."""
    return uuid.uuid4().hex


def apply_actions(
    targets: dict[str, DataFrame], sources: dict[str, DataFrame], steps: Sequence[TableAction]
) -> dict[str, DataFrame]:
    """New content of every table named in ``steps``, in order of first mention.

    Steps on one table apply in list order and fold into a single plan per table.
    """
    result: dict[str, DataFrame] = {}
    for step in steps:
        source = sources.get(step.source or step.target)
        if step.action in _NEEDS_SOURCE and source is None:
            raise ValueError(f"{step.action} on '{step.target}' has no source")
        result[step.target] = _apply(result.get(step.target, targets.get(step.target)), source, step)
    return result


def apply_pieces(targets: dict[str, DataFrame], pieces: dict[str, dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Replace tables by the pieces of a split extract: per table the first piece replaces, later ones insert.

    ``pieces`` maps piece names to their tables and is taken in name order.
    """
    steps: list[TableAction] = []
    sources: dict[str, DataFrame] = {}
    for piece, tables in sorted(pieces.items()):
        for table, df in tables.items():
            action = "insert" if any(step.target == table for step in steps) else "replace"
            steps.append(TableAction(action, table, source=f"{piece}/{table}"))
            sources[f"{piece}/{table}"] = df
    return apply_actions(targets, sources, steps)


def _apply(target: DataFrame | None, source: DataFrame | None, step: TableAction) -> DataFrame:
    if step.action == "replace":
        return act.replace(target, source)
    if step.action in ("append", "insert"):
        return act.append(target, source)
    if step.action == "upsert":
        return act.upsert(target, source, step.keys, step.condition, step.latest_by)
    if step.action == "delete":
        if target is None or step.condition is None:
            raise ValueError(f"delete on '{step.target}' needs an existing table and a condition")
        return act.delete_where(target, step.condition)
    raise ValueError(f"unknown action '{step.action}'")


def stage_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> StagedTable:
    """Write a table and check the files against the rows that went in.

    Count and checksum of the input are observed during the write, so the input is not computed
    twice. Work repeated after losing an executor can count twice in an observation; then, and
    only then, the input is evaluated again before the table is called wrong.
    """
    spark = df.sparkSession
    seen = Observation()
    writer = clustered(df, partition_by).observe(seen, *checksum_aggregates(df.columns)).write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    written = table_checksum(spark.read.schema(df.schema).parquet(path), df.columns).first().asDict()
    # Spark may skip an empty plan and with it the observation.
    if written["row_count"] == 0:
        matches = df.isEmpty()
    else:
        matches = written == seen.get or written == table_checksum(df).first().asDict()
    if not matches:
        raise PublishError(f"{path}: the files hold {written}, which is not what was to be written")
    return StagedTable(path, written["row_count"], written["checksum"])


def publish_release(
    spark: SparkSession,
    root: str,
    tables: dict[str, DataFrame],
    run_id: str | None = None,
    partition_by: dict[str, Sequence[str]] | None = None,
    base: int | None = None,
) -> DataFrame:
    """Write, verify and switch to a release; returns its log rows.

    Tables start in the order given (dimensions first, then facts). Publishing the current
    ``run_id`` again changes nothing, and a run that failed may be repeated under its ``run_id``:
    what it left behind is overwritten, as no release names it.

    Several may publish to one root. A release that changed one of ``tables`` after the release that these were made from (``base``, by
    default the current one) raises ``PublishConflict``; releases of other tables are kept. Tables that refer to each other belong in one release.
    """
    root = root.rstrip("/")
    run_id = run_id or new_run_id()
    _ensure_log(spark, root)
    previous = {row["table_name"]: row for row in current_release(spark, root).collect()}
    if any(row["run_id"] == run_id for row in previous.values()):
        return current_release(spark, root)
    if release_log(spark, root).where(F.col("run_id") == run_id).take(1):
        raise ValueError(f"run '{run_id}' is an earlier release of {root}")
    if base is not None and base != _sequence_of(previous):
        _refuse_overlap(tables, _release(spark, root, base), previous)

    def stage(name: str) -> StagedTable:
        return stage_table(tables[name], f"{root}/release={run_id}/{name}", (partition_by or {}).get(name, ()))

    staged = {}
    # Tables are independent until the switch, so their jobs share the cluster.
    with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
        for name, done in zip(tables, pool.map(stage, tables)):
            staged[name] = (done.path, done.row_count, done.checksum, tables[name].schema.json())
    while True:
        sequence = 1 + _sequence_of(previous)
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        entries = {name: tuple(row[c] for c in _TABLE_COLUMNS) for name, row in previous.items()} | staged
        rows = [(sequence, run_id, now, name, *entry) for name, entry in entries.items()]
        if _append_entry(spark, root, sequence, rows):
            return current_release(spark, root)
        seen, previous = previous, {row["table_name"]: row for row in current_release(spark, root).collect()}
        _refuse_overlap(tables, seen, previous)


def _append_entry(spark: SparkSession, root: str, sequence: int, rows: list[tuple]) -> bool:
    """Put the log rows of a release into place as one file, unless another publisher already has that number.

    The file is written elsewhere and moved without overwriting, which a shared file system does in one step.
    """
    place = f"{root}/releases/{sequence:019d}.parquet"
    if path_exists(spark, place):
        return False
    written = f"{root}/releases/_new/{uuid.uuid4().hex}"
    spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1).write.parquet(written)
    (file,) = spark.read.parquet(written).inputFiles()
    moved = move_new(spark, file, place)
    delete_path(spark, written)
    # A local file system looks first and moves then; what stands there in the end decides.
    return moved and release_log(spark, root).where(F.col("sequence") == sequence).select("run_id").distinct().collect() == [(rows[0][1],)]


def _sequence_of(release: dict[str, Row]) -> int:
    return max((row["sequence"] for row in release.values()), default=0)


def _release(spark: SparkSession, root: str, sequence: int) -> dict[str, Row]:
    return {row["table_name"]: row for row in release_log(spark, root).where(F.col("sequence") == sequence).collect()}


def _refuse_overlap(tables: dict[str, DataFrame], before: dict[str, Row], now: dict[str, Row]) -> None:
    """Raise when one of ``tables`` has another directory now than it had before."""
    changed = [name for name in tables if name in now and (name not in before or before[name]["path"] != now[name]["path"])]
    if changed:
        raise PublishConflict(f"release {_sequence_of(now)} ({next(iter(now.values()))['run_id']}) changed {', '.join(changed)} in the meantime")


def release_log(spark: SparkSession, root: str) -> DataFrame:
    """All releases of a root."""
    return spark.read.schema(LOG_SCHEMA).parquet(f"{root.rstrip('/')}/releases")


def current_release(spark: SparkSession, root: str) -> DataFrame:
    """Log rows of the release that readers see, one per table."""
    log = release_log(spark, root)
    last = log.agg(F.max("sequence").alias("sequence"))
    return log.join(last, "sequence").select(*log.columns)


def current_sequence(spark: SparkSession, root: str) -> int:
    """Number of the release that readers see; 0 without releases."""
    return release_log(spark, root).agg(F.coalesce(F.max("sequence"), F.lit(0)).alias("sequence")).first()["sequence"]


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the current release, with the columns and types it was published with."""
    found = current_release(spark, root).where(F.col("table_name") == table).collect()
    if len(found) != 1:
        raise LookupError(f"'{table}' is not in the current release of {root}")
    return _read_entry(spark, found[0])


def published_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of the current release; none for a root without releases."""
    _ensure_log(spark, root)
    return {entry["table_name"]: _read_entry(spark, entry) for entry in current_release(spark, root).collect()}


def _read_entry(spark: SparkSession, entry: Row) -> DataFrame:
    schema = StructType.fromJson(json.loads(entry["table_schema"]))
    return spark.read.schema(schema).parquet(entry["path"]).select(*[quoted(c) for c in schema.names])


def _ensure_log(spark: SparkSession, root: str) -> None:
    spark.createDataFrame([], LOG_SCHEMA).write.mode("ignore").parquet(f"{root.rstrip('/')}/releases")
