"""Watch a folder with Structured Streaming: emit new arrivals once, tag them, apply them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from martweave.functions.scalars import path_name, priority_class, quoted
from martweave.operators.actions import latest_per_key
from martweave.plans.partitions import MAX_DYNAMIC_PARTITIONS, upsert_partitions
from martweave.session import path_exists


def watch_folder(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    file_format: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of the rows of arriving files, each with the ``source_file`` it came from.

    The checkpoint of the query remembers the files seen, so none is emitted twice.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select("*", path_name(F.col("_metadata.file_path")).alias("source_file"))


def watch_names(spark: SparkSession, path: str) -> DataFrame:
    """Stream of arriving files as jobs ``(path, name, ts)``; contents are not read."""
    files = spark.readStream.schema("path string, modificationTime timestamp, length bigint, content binary")
    arrived = files.format("binaryFile").load(path)
    return arrived.select("path", path_name("path").alias("name"), F.col("modificationTime").alias("ts"))


def tag_priority(arrivals: DataFrame, name: str = "name", loose: bool = False) -> DataFrame:
    """Stateless priority class of each arrival."""
    return arrivals.withColumn("priority", priority_class(name, loose))


def drain_new(arrivals: DataFrame, path: str, checkpoint: str, keys: Sequence[str], first_by: Sequence[str]) -> StreamingQuery:
    """Append arrivals whose key was not delivered before, and stop; late ones count like others.

    Of several rows with one key in a batch the first by ``first_by`` counts. Each batch writes its own
    directory ``batch=N`` below ``path``, so running it again after a failure replaces what it
    wrote. Delivered keys are read from there, key columns only, and never forgotten.
    """
    keys = list(keys)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rest = [c for c in batch.columns if c not in keys]
        order = [*first_by, *(c for c in rest if c not in first_by)]
        first = batch.groupBy(*map(quoted, keys)).agg(F.min(F.struct(*map(quoted, order))).alias("_first"))
        rows = first.select(*[(quoted(c) if c in keys else F.col("_first").getField(c)).alias(c) for c in batch.columns])
        if path_exists(spark, path):
            delivered = spark.read.schema(StructType([*batch.schema.fields, StructField("batch", LongType())])).parquet(path).where(F.col("batch") < batch_id)
            rows = rows.join(delivered.select(*map(quoted, keys)).distinct(), keys, "left_anti").select(*map(quoted, batch.columns))
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return (
        arrivals.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain_new_within(
    arrivals: DataFrame, path: str, late_path: str, checkpoint: str, keys: Sequence[str], time: str, delay: str
) -> StreamingQuery:
    """Append arrivals whose key did not come within ``delay`` before, with bounded state, and stop.

    ``drain_new`` remembers every key; this one forgets a key once the newest ``time`` is ``delay`` past it. What is
    that late when it arrives can no longer be judged and goes to ``late_path`` instead, as do rows without a time: nothing is dropped. Keys lie in the
    state store, on disk with the session's default. Of repeats in one batch any one counts.

    Two streams: the first parts late rows from others, by the newest time of earlier batches, which it writes down per
    batch, so a batch that runs again decides alike; the second removes repeats from what is on time. Its
    batches are no smaller, so its watermark is never ahead of the first one's and it drops nothing as late.
    """
    root = checkpoint.rstrip("/")
    staged, newest = f"{root}/on-time", f"{root}/newest"

    def part(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        limit = F.lit(None).cast(batch.schema[time].dataType)
        if path_exists(spark, newest):
            seen = spark.read.parquet(newest).where(F.col("batch") < batch_id).agg(F.max("newest").alias("newest"))
            limit = F.lit(seen.first()["newest"]).cast(batch.schema[time].dataType) - F.expr(f"INTERVAL {delay}")
        on_time = quoted(time).isNotNull() & F.coalesce(quoted(time) > limit, F.lit(True))
        batch.where(on_time).write.mode("overwrite").parquet(f"{staged}/batch={batch_id}")
        batch.where(~on_time).write.mode("overwrite").parquet(f"{late_path.rstrip('/')}/batch={batch_id}")
        batch.agg(F.max(quoted(time)).alias("newest")).write.mode("overwrite").parquet(f"{newest}/batch={batch_id}")

    first = arrivals.writeStream.foreachBatch(part).option("checkpointLocation", f"{root}/parting").trigger(availableNow=True).start()
    first.awaitTermination()
    spark = arrivals.sparkSession
    rows = spark.readStream.schema(arrivals.schema).parquet(staged)
    # A watermark needs a timestamp with zone; it is of use to the state store only.
    moment = quoted(time).cast("timestamp")
    fresh = rows.withColumn("_moment", moment).withWatermark("_moment", delay).dropDuplicatesWithinWatermark(list(keys)).drop("_moment")
    return drain_to_table(fresh, path, f"{root}/repeats")


def drain_to_table(arrivals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived to a Parquet directory, exactly once per file, and stop."""
    return (
        arrivals.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain_to_upserts(
    arrivals: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    latest_by: Sequence[str] = (),
    rows_move: bool = True,
) -> StreamingQuery:
    """Upsert everything that has arrived into a partitioned table, and stop.

    A batch that runs again after a failure meets its own rows by key and leaves the same table.
    With ``latest_by`` an older row that arrives late does not undo a newer stored one.
    ``rows_move=False`` promises that a key stays in its partition, so that only the partitions
    of the batch are searched.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if latest_by:
            newest = latest_per_key(batch, keys, latest_by)
            stored = spark.read.schema(batch.schema).parquet(path)
            if not rows_move:
                places = newest.select(*map(quoted, partition_by)).distinct()
                stored = stored.join(F.broadcast(places) if places.count() < MAX_DYNAMIC_PARTITIONS else places, list(partition_by), "left_semi")
            known = stored.join(newest.select(*map(quoted, keys)), list(keys), "left_semi").select(*map(quoted, batch.columns))
            rows = newest.unionByName(known)
        upsert_partitions(spark, path, rows, keys, partition_by, latest_by=latest_by, rows_move=rows_move)

    return (
        arrivals.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drain_latest_stage(log: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the last stage of each job ``(name, ts, stage)`` in a table, and stop.

    The table at ``path`` has columns ``name, ts, stage, bucket`` and is partitioned by
    ``bucket``, which depends on the name alone, so a batch rewrites only its own buckets.
    An event that arrives late does not undo a newer one.
    """

    def apply(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        stored = spark.read.parquet(path)
        newest = latest_per_key(batch.select(*stored.columns), ["name"], ["ts"])
        known = stored.join(newest.select("name"), "name", "left_semi").select(*stored.columns)
        upsert_partitions(
            spark, path, newest.unionByName(known), ["name"], ["bucket"], latest_by=["ts"], rows_move=False
        )

    return (
        log.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
