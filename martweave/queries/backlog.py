"""Job backlog queries over the jobs derived from events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.functions.scalars import NEXT_STAGE, next_stage, stage_path
from martweave.operators import backlog
from martweave.operators.gates import covered_seconds, merge_intervals
from martweave.queries.inputs import JOBS, RANKED_JOBS, jobs, table
from martweave.session import parked


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.with_priority(jobs(spark, sf_dir))


def job_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    strict = _ranked(spark, sf_dir)
    return backlog.with_priority(strict.withColumnRenamed("priority", "strict_priority"), loose=True)


def dispatch_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.dispatch_order(_ranked(spark, sf_dir))


def top5_per_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.first_per_stage(_ranked(spark, sf_dir))


def class_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.admissible(_ranked(spark, sf_dir))


def stage_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.latest_stage(jobs(spark, sf_dir), "user_id", ("ts", "event_id"))


def stage_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each job goes next; jobs with top priority fail here."""
    ranked = _ranked(spark, sf_dir)
    return ranked.select("event_id", "stage", next_stage("stage", F.col("priority") > 1).alias("next_stage"))


def stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.contains("name", F.lit("DLE")), "failed").otherwise("pending")
    paths = jobs(spark, sf_dir).select(stage_path(F.col("stage"), status, F.col("name")).alias("path"))
    return backlog.stage_counts(paths)


def any_top_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).groupBy("stage").agg(
        F.bool_or(F.col("priority") == backlog.TOP_PRIORITY).alias("has_top_priority"),
        F.count(F.lit(1)).alias("jobs"),
    )


_ORDER = "PARTITION BY stage ORDER BY priority, ts, name"
_FLOW = " ".join(f"WHEN '{stage}' THEN '{following}'" for stage, following in NEXT_STAGE.items())

def blocked_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long each job waits for top-priority jobs of its stage: these take as many minutes as their value says, others wait two hours."""
    value = table(spark, sf_dir, "events").select("event_id", F.floor(F.col("value") * 60).alias("seconds"))
    ranked = _ranked(spark, sf_dir).join(value, "event_id")
    top = ranked.where("priority = 1").withColumn("done", F.col("ts") + F.make_dt_interval(secs=F.col("seconds")))
    waiting = ranked.where("priority <> 1").select("event_id", "stage", "ts", (F.col("ts") + F.expr("INTERVAL 2 HOURS")).alias("until"))
    closed = parked(merge_intervals(top, "ts", "done", ["stage"]), "closed")
    return covered_seconds(waiting, "ts", "until", closed, "ts", "done", ["stage"], "blocked_seconds").select("event_id", "stage", "blocked_seconds")


_BLOCKED = f"""WITH ranked AS (SELECT j.*, CAST(floor(e.value * 60) AS BIGINT) AS seconds FROM ({RANKED_JOBS}) j JOIN events e USING (event_id)),
    top AS (SELECT stage, ts, ts + to_seconds(seconds) AS done FROM ranked WHERE priority = 1 AND seconds > 0),
    marked AS (SELECT *, coalesce(ts > max(done) OVER (PARTITION BY stage ORDER BY ts, done ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS opens FROM top),
    grouped AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY stage ORDER BY ts, done ROWS UNBOUNDED PRECEDING) AS part FROM marked),
    closed AS (SELECT stage, min(ts) AS ts, max(done) AS done FROM grouped GROUP BY stage, part)
    SELECT w.event_id, w.stage, coalesce(sum(epoch_us(least(c.done, w.ts + INTERVAL 2 HOUR)) - epoch_us(greatest(c.ts, w.ts))) FILTER (c.ts IS NOT NULL), 0) / 1000000
        AS blocked_seconds
    FROM ranked w LEFT JOIN closed c ON c.stage = w.stage AND c.ts < w.ts + INTERVAL 2 HOUR AND c.done > w.ts WHERE w.priority <> 1 GROUP BY 1, 2"""


QUERIES = {
    "blocked_seconds": (blocked_seconds, _BLOCKED),
    "job_priority": (
        job_priority,
        f"""SELECT event_id, user_id, name, ts, stage, priority AS strict_priority,
        CASE WHEN contains(name, 'DLE') THEN 1 WHEN contains(name, 'MR') THEN 2 ELSE 3 END AS priority
        FROM ({RANKED_JOBS})""",
    ),
    "dispatch_order": (
        dispatch_order,
        f"SELECT *, row_number() OVER ({_ORDER}) AS position FROM ({RANKED_JOBS})",
    ),
    "top5_per_stage": (
        top5_per_stage,
        f"""SELECT *, CAST(row_number() OVER ({_ORDER}) AS INTEGER) AS position FROM ({RANKED_JOBS})
        QUALIFY position <= 5""",
    ),
    "class_gate": (
        class_gate,
        f"""SELECT event_id, user_id, name, ts, stage, priority
        FROM (SELECT *, bool_or(priority = 1) OVER (PARTITION BY stage) AS has_top FROM ({RANKED_JOBS}))
        WHERE NOT (stage = 'hyper' AND has_top AND priority <> 1)""",
    ),
    "stage_latest": (
        stage_latest,
        f"""SELECT user_id, stage FROM (SELECT user_id, stage,
            row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
            FROM ({JOBS})) WHERE rn = 1""",
    ),
    "stage_flow": (
        stage_flow,
        f"""SELECT event_id, stage, CASE WHEN priority = 1 THEN 'failed' ELSE CASE stage {_FLOW} END END AS next_stage
        FROM ({RANKED_JOBS})""",
    ),
    "stage_counts": (
        stage_counts,
        f"""SELECT stage, CASE WHEN contains(name, 'DLE') THEN 'failed' ELSE 'pending' END AS status, count(*) AS jobs
        FROM ({JOBS}) GROUP BY 1, 2""",
    ),
    "any_exists": (
        any_top_priority,
        f"SELECT stage, bool_or(priority = 1) AS has_top_priority, count(*) AS jobs FROM ({RANKED_JOBS}) GROUP BY 1",
    ),
}
