"""Order, gate and summarise a backlog of jobs ``(name, ts, stage, ...)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martweave.functions.scalars import parse_log_line, priority_class, stage_path_parts
from martweave.operators.ordering import row_index

# Fixed values.
CONCURRENT_JOBS = 5
GATED_STAGE = "hyper"
TOP_PRIORITY = 1
UNPARSED = "unparsed"


def with_priority(jobs: DataFrame, loose: bool = False) -> DataFrame:
    """Jobs with their priority class."""
    return jobs.withColumn("priority", priority_class("name", loose))


def dispatch_order(jobs: DataFrame) -> DataFrame:
    """Position of each job in its stage: by priority, then first come first served.

    There are few stages and many jobs, so no window over a stage: see ``row_index``.
    """
    return row_index(jobs, ["priority", "ts", "name"], ["stage"], name="position")


def first_per_stage(jobs: DataFrame, jobs_per_stage: int = CONCURRENT_JOBS) -> DataFrame:
    """The next jobs of each stage.

    Spark turns the rank filter into a group limit, so every task passes on at most
    ``jobs_per_stage`` rows per stage.
    """
    queue = Window.partitionBy("stage").orderBy("priority", "ts", "name")
    return jobs.withColumn("position", F.row_number().over(queue)).where(F.col("position") <= jobs_per_stage)


def admissible(jobs: DataFrame, gated_stage: str = GATED_STAGE) -> DataFrame:
    """Jobs that may run now: while the gated stage holds a top-priority job, only those may.

    The gate is one yes-or-no subquery, so no stage is gathered anywhere.
    """
    top = F.col("priority") == TOP_PRIORITY
    gated = F.col("stage").eqNullSafe(gated_stage)
    return jobs.where(~gated | top | ~jobs.where(gated & top).exists())


def latest_stage(log: DataFrame, job: str = "name", order_by: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Last recorded stage of each job."""
    return log.groupBy(job).agg(F.max_by("stage", F.struct(*order_by)).alias("stage"))


def stage_counts(paths: DataFrame, path: str = "path") -> DataFrame:
    """Jobs per stage and status, read from ``stage.status/name`` paths."""
    stage, status, name = stage_path_parts(path)
    return paths.select(stage, status, name).groupBy("stage", "status").agg(F.count(F.lit(1)).alias("jobs"))


def run_summary(lines: DataFrame, line: str = "value") -> DataFrame:
    """Log lines per status, with the first and last time seen; other lines count as ``unparsed``."""
    moment, name, status = parse_log_line(line)
    return (
        lines.select(moment, name, status)
        .withColumn("status", F.when(F.col("ts").isNull(), UNPARSED).otherwise(F.col("status")))
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("runs"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    )


def outcome_totals(runs: DataFrame, success: str = "succeeded") -> DataFrame:
    """One row: all, successful and failed runs."""
    succeeded = F.col("status") == success
    return runs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(succeeded).alias("successful"),
        F.count_if(~succeeded).alias("failed"),
    )
