"""Files are taken only when complete: seen twice with one length and time, then entered in a ledger, in order.

Looking at a folder and reading it are two steps. ``admit`` lists the folder, compares with the listing before, and enters files that did not
change in between, once each. The ledger is a table, and a stream over it reads the files it names; so a file that was still
growing when first seen is read once, when it is whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from martweave.operators.ordering import row_index
from martweave.session import parked, path_exists, scratch_scope

LISTING = "path string, length bigint, modified timestamp"
LEDGER = f"position bigint, {LISTING}"


def admit(spark: SparkSession, inbox: str, ledger: str, pattern: str = "*") -> int:
    """Enter the files below ``inbox`` that are as the last call saw them; returns how many were new.

    ``position`` goes on from call to call, by modification time and path. One caller at a time. A file that changes after it was
    entered is not read again. The listing is replaced last: a call that fails is simply made again.
    """
    root = ledger.rstrip("/")
    with scratch_scope(spark):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(inbox)
        now = parked(files.select("path", "length", F.col("modificationTime").alias("modified")), "listing")
        entered = 0
        if path_exists(spark, f"{root}/seen"):
            before = spark.read.schema(LISTING).parquet(f"{root}/seen")
            stable = now.join(before, ["path", "length", "modified"], "left_semi")
            known = entries(spark, ledger)
            if known is not None:
                stable = stable.join(known.select("path"), "path", "left_anti")
            last = known.agg(F.coalesce(F.max("position"), F.lit(0))).first()[0] if known is not None else 0
            new = parked(row_index(stable, ["modified", "path"], name="position").select((F.col("position") + last).alias("position"), "path", "length", "modified"), "admitted")
            entered = new.count()
            if entered:
                new.coalesce(1).write.mode("append").parquet(f"{root}/admitted")
        now.write.mode("overwrite").parquet(f"{root}/seen")
    return entered


def entries(spark: SparkSession, ledger: str) -> DataFrame | None:
    """The ledger, or ``None`` before the first file was entered."""
    path = f"{ledger.rstrip('/')}/admitted"
    return spark.read.schema(LEDGER).parquet(path) if path_exists(spark, path) else None


def drain_admitted(spark: SparkSession, ledger: str, path: str, checkpoint: str, schema: StructType | str, file_format: str = "parquet") -> StreamingQuery:
    """Append the rows of all files entered since the last call to ``path``, with their file's ``position``, and stop.

    Each batch writes its own directory ``batch=N``, so running it again after a failure replaces what it wrote.
    """
    entered = spark.readStream.schema(LEDGER).parquet(f"{ledger.rstrip('/')}/admitted")

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # One short row per arriving file.
        files = batch.select("path", "position").collect()
        if not files:
            return
        rows = session.read.schema(schema).format(file_format).load([r["path"] for r in files])
        name = F.regexp_extract(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), r"^[a-z0-9]+:/*(/.*)$", 1)
        positions = batch.select(F.regexp_extract("path", r"^[a-z0-9]+:/*(/.*)$", 1).alias("_file"), "position")
        placed = rows.withColumn("_file", name).join(F.broadcast(positions), "_file").drop("_file")
        placed.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return entered.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
