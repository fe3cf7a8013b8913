"""Streaming queries: table rows land as files, a stream drains the folder, the result is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.queries.inputs import JOBS, RANKED_JOBS, UPSERTED_ORDERS, arriving_orders, jobs, moment, stored_orders
from martweave.session import scratch_path
from martweave.sources.files import append_partitioned
from martweave.streaming import arrivals as st
from martweave.streaming.admission import admit, drain_admitted
from martweave.streaming.stages import check_stages


_NAMES_PER_BUCKET = 100_000


def _land(spark: SparkSession, df: DataFrame, purpose: str) -> str:
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return path


def stream_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drained twice with one checkpoint; the second run finds nothing new."""
    incoming = jobs(spark, sf_dir)
    landed = _land(spark, incoming, "landing")
    out, checkpoint = scratch_path(spark, "arrived"), scratch_path(spark, "checkpoint")
    for _ in range(2):
        arrived = st.tag_priority(st.watch_folder(spark, landed, incoming.schema)).drop("source_file")
        st.drain_to_table(arrived, out, checkpoint).awaitTermination()
    return spark.read.parquet(out)


def stream_no_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same jobs delivered again under other file names count once, however late a job first arrives."""
    incoming = jobs(spark, sf_dir)
    landed = _land(spark, incoming, "landing")
    incoming.write.mode("append").parquet(landed)
    out, checkpoint = scratch_path(spark, "arrived"), scratch_path(spark, "checkpoint")
    arrived = st.watch_folder(spark, landed, incoming.schema, files_per_trigger=1).drop("source_file")
    st.drain_new(arrived, out, checkpoint, ["event_id"], ["ts"]).awaitTermination()
    return spark.read.parquet(out).drop("batch")


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate")
    path = scratch_path(spark, "orders-by-year")
    append_partitioned(stored_orders(spark, sf_dir).withColumn("order_year", year), path, ["order_year"])
    incoming = arriving_orders(spark, sf_dir).withColumn("order_year", year)
    landed, checkpoint = _land(spark, incoming, "landing"), scratch_path(spark, "checkpoint")
    arrived = st.watch_folder(spark, landed, incoming.schema).drop("source_file")
    st.drain_to_upserts(arrived, path, checkpoint, ["o_orderkey"], ["order_year"]).awaitTermination()
    return spark.read.parquet(path).drop("order_year")


def stream_stage_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last stage of each user's work. The table starts with the first entries, the stream brings all."""
    log = jobs(spark, sf_dir).select(F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("name"), "ts", "stage")
    buckets = max(4, log.select("name").distinct().count() // _NAMES_PER_BUCKET)
    log = log.withColumn("bucket", F.pmod(F.xxhash64("name"), F.lit(buckets)).cast("int"))
    first = log.groupBy("name").agg(F.min(F.struct("ts", "stage", "bucket")).alias("entry")).select("name", "entry.*")
    path = scratch_path(spark, "stages")
    append_partitioned(first, path, ["bucket"])
    landed, checkpoint = _land(spark, log, "landing"), scratch_path(spark, "checkpoint")
    arrived = st.watch_folder(spark, landed, log.schema).drop("source_file")
    st.drain_latest_stage(arrived, path, checkpoint).awaitTermination()
    return spark.read.parquet(path).drop("bucket")


def stream_bounded_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries: the first half of the jobs, the second half with two days sent again, and old jobs under new ids, too late to judge."""
    incoming = jobs(spark, sf_dir).select("event_id", "ts", "name")
    landed = scratch_path(spark, "landing")
    out, late, checkpoint = (scratch_path(spark, n) for n in ("arrived", "late", "checkpoint"))
    deliveries = [
        incoming.where(F.col("ts") < moment("2024-01-16")),
        incoming.where(F.col("ts") >= moment("2024-01-14")),
        incoming.where(F.col("ts") < moment("2024-01-06")).withColumn("event_id", -1 - F.col("event_id")),
    ]
    for delivery in deliveries:
        delivery.write.mode("append").parquet(landed)
        arrived = st.watch_folder(spark, landed, incoming.schema).drop("source_file")
        st.drain_new_within(arrived, out, late, checkpoint, ["event_id"], "ts", "4 days").awaitTermination()
    both = spark.read.parquet(out).withColumn("late", F.lit(False)).unionByName(spark.read.parquet(late).withColumn("late", F.lit(True)), allowMissingColumns=True)
    return both.select("event_id", "ts", "name", "late")


def _stage_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs(spark, sf_dir).select(F.concat(F.lit("job_"), F.col("user_id").cast("string")).alias("name"), "ts", "stage")


def stream_stage_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage event of a user's work, accepted or refused by the stage the work stands in."""
    log = _stage_events(spark, sf_dir)
    landed, out, checkpoint = _land(spark, log, "landing"), scratch_path(spark, "judged"), scratch_path(spark, "checkpoint")
    judged = check_stages(st.watch_folder(spark, landed, log.schema).drop("source_file"), stuck_after="90 days")
    st.drain_to_table(judged, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select("name", F.col("ts").cast("timestamp_ntz").alias("ts"), "stage", "outcome")


def stream_admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs land in two deliveries; each is read after two listings have seen it alike."""
    incoming = jobs(spark, sf_dir)
    landed, ledger, out, checkpoint = (scratch_path(spark, n) for n in ("landing", "ledger", "arrived", "checkpoint"))
    for half in (F.col("ts") < moment("2024-01-16"), F.col("ts") >= moment("2024-01-16")):
        incoming.where(half).write.mode("append").parquet(landed)
        for _ in range(2):
            admit(spark, landed, ledger, "*.parquet")
        drain_admitted(spark, ledger, out, checkpoint, incoming.schema).awaitTermination()
    return spark.read.parquet(out).select(*incoming.columns)


QUERIES = {
    "stream_bounded_repeats": (
        stream_bounded_repeats,
        f"""SELECT event_id, ts, name, false AS late FROM ({JOBS}) UNION ALL
        SELECT -1 - event_id, ts, name, true FROM ({JOBS}) WHERE ts < TIMESTAMP '2024-01-06'""",
    ),
    "stream_stage_check": (
        stream_stage_check,
        f"""WITH log AS (SELECT 'job_' || CAST(user_id AS VARCHAR) AS name, ts, stage,
            row_number() OVER (PARTITION BY user_id ORDER BY ts, stage) AS i FROM ({JOBS})),
        one AS (SELECT name, min(i) AS i FROM log WHERE stage = 'extract' GROUP BY name),
        two AS (SELECT log.name, min(log.i) AS i FROM log JOIN one ON one.name = log.name AND log.i > one.i WHERE stage = 'hyper' GROUP BY 1),
        three AS (SELECT log.name, min(log.i) AS i FROM log JOIN two ON two.name = log.name AND log.i > two.i WHERE stage = 'publish' GROUP BY 1),
        taken AS (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three)
        SELECT name, ts, stage, CASE WHEN EXISTS (SELECT 1 FROM taken t WHERE t.name = log.name AND t.i = log.i) THEN 'accepted' ELSE 'refused' END AS outcome FROM log""",
    ),
    "stream_admitted": (stream_admitted, JOBS),
    "stream_arrivals": (stream_arrivals, f"SELECT * FROM ({RANKED_JOBS})"),
    "stream_no_repeats": (stream_no_repeats, JOBS),
    "stream_upsert": (stream_upsert, UPSERTED_ORDERS),
    "stream_stage_latest": (
        stream_stage_latest,
        f"""SELECT 'job_' || CAST(user_id AS VARCHAR) AS name, ts, stage FROM ({JOBS})
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, stage DESC) = 1""",
    ),
}
