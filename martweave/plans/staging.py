"""Stage the tables a configuration asks for, verify the copies, process them, clean up."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.plans.publish import PARALLEL_TABLES, stage_table
from martweave.session import delete_path
from martweave.sources.config import missing_sources, stage_plan
from martweave.sources.extracts import extract_path
from martweave.sources.files import append_log

Result = TypeVar("Result")

STAGED = "staged"
FAILED = "failed"
_NAMED_UNKNOWN = 20


def stage_by_config(
    spark: SparkSession,
    requested: DataFrame,
    entries: DataFrame,
    roots: dict[str, str],
    staging: str,
    run_id: str,
    log_path: str | None = None,
    parallel: int = PARALLEL_TABLES,
) -> dict[tuple[str, str], DataFrame]:
    """Copy the requested facts and their dimensions to ``staging`` and verify every copy.

    ``roots`` gives the extract for each load mode, ``incremental`` for facts and ``full`` for
    dimensions, and the copies are keyed by load mode and table: one table may be staged in both
    modes. A dimension that several facts share is staged once. A requested table that the
    configuration does not know stops the run before anything is copied.
    """
    missing = missing_sources(requested, entries)
    unknown = [row["source_table"] for row in missing.orderBy("source_table").limit(_NAMED_UNKNOWN).collect()]
    if unknown:
        more = missing.count() - len(unknown)
        raise LookupError(f"not in the merge configuration: {', '.join(unknown)}" + f" and {more} more" * (more > 0))

    def stage(step) -> DataFrame:
        source = spark.read.parquet(extract_path(roots[step["mode"]], step["table"]))
        path = f"{staging.rstrip('/')}/{step['mode']}/{step['table']}"
        stage_table(source, path)
        return spark.read.schema(source.schema).parquet(path)

    # One row per table to copy; the copies themselves are distributed writes.
    steps = stage_plan(requested, entries).orderBy("mode", "table").collect()
    with ThreadPoolExecutor(parallel) as pool:
        copies = {(step["mode"], step["table"]): pool.submit(stage, step) for step in steps}
    if log_path is not None:
        # Written once for all tables: jobs that append to one directory at a time would collide.
        outcomes = [(mode, name, FAILED if copy.exception() else STAGED) for (mode, name), copy in copies.items()]
        rows = spark.createDataFrame(outcomes, "mode string, name string, status string")
        append_log(rows.select(F.localtimestamp().alias("ts"), F.lit(run_id).alias("run_id"), "mode", "name", "status"), log_path)
    return {step: copy.result() for step, copy in copies.items()}


def run_staged(
    spark: SparkSession,
    staged: dict[tuple[str, str], DataFrame],
    staging: str,
    process: Callable[[dict[tuple[str, str], DataFrame]], Result],
) -> Result:
    """Run ``process`` on staged tables and remove the staging area once it has succeeded.

    ``process`` must publish what it makes; a failure keeps the staged files for inspection.
    """
    result = process(staged)
    delete_path(spark, staging)
    return result

