"""CSV, delimited text, plain text and file-inventory readers, and the file sinks."""

from __future__ import annotations

import os
import re
import shutil
from collections.abc import Iterator, Sequence
from itertools import groupby
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from martweave.functions.scalars import path_name, quoted
from martweave.operators.ordering import chunk_ids
from martweave.session import local_path, scratch_path, scratch_scope, session_with

# Fixed values.
MIN_FILE_BYTES = 10
MAX_FILE_BYTES = 10 * 1024 * 1024
_NO_SUCH_TEXT = "\u0001never-a-value-5d1c0e5e\u0001"
_MAX_ROW_BYTES = (1 << 31) - 64
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_FILES_PER_FOLDER = 1000
_FOLDERS_PER_LISTING = 100
_SMALL_FILES = {
    # Spark takes the opening of a file for 4 MB of reading, and so gives a task at most 32 small files.
    "spark.sql.files.openCostInBytes": str(64 << 10),
    # The driver forgets a listing with its frame.
    "spark.sql.hive.manageFilesourcePartitions": "false",
}


def read_csv(
    spark: SparkSession, path: str | list[str], schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header and doubled quotes. Without ``schema`` the types are inferred, at the price of a second pass.

    ``multi_line`` reads line breaks inside quotes; a file is then read by one task.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    # Only what is not quoted is NULL; this text merely must not occur, or a quoted empty text would be NULL too.
    reader = reader.option("nullValue", _NO_SUCH_TEXT)
    return reader.csv(path, inferSchema=True) if schema is None else reader.schema(schema).csv(path)


def read_delimited(spark: SparkSession, path: str, schema: StructType | str, separator: str = ",") -> DataFrame:
    """Text rows without header or quoting, as delimited catalogue tables store them."""
    return spark.read.schema(schema).option("sep", separator).option("quote", "").csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines in column ``value``."""
    return spark.read.text(path)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV part files with a header line each; no index column.

    Any text survives: quotes are doubled, blanks at the ends stay, an empty text is quoted and
    NULL is not. Texts with line breaks need ``multi_line`` when read; so that such reading stays
    parallel, bound the files with ``spark.sql.files.maxRecordsPerFile``.
    """
    writer = df.write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)


def write_delimited(df: DataFrame, path: str, separator: str = ",") -> None:
    """Text rows without header or quoting; raises when a text holds a separator or a line break."""
    unsafe = "|".join(re.escape(c) for c in (separator, "\n", "\r"))
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    for name in texts:
        refused = F.raise_error(F.concat(F.lit(f"a value of '{name}' holds a separator or a line break: "), quoted(name)))
        df = df.withColumn(name, F.when(quoted(name).rlike(unsafe), refused.cast("string")).otherwise(quoted(name)))
    # The NUL quote character is Spark's way to switch quoting off when writing.
    df.write.option("sep", separator).option("quote", "\u0000").option("emptyValue", "").csv(path)


def clustered(df: DataFrame, partition_by: Sequence[str], cluster: bool = True) -> DataFrame:
    """``df`` shuffled so that each output partition is written by few tasks, hot ones by several.

    Without it every task writes a file for each partition it has rows of. That is fine, and
    saves the shuffle, for a handful of partitions: pass ``cluster=False``. ``rebalance`` is
    used as it splits hot partitions, which a plain repartition would send to one task each.
    """
    return df.hint("rebalance", *[quoted(c) for c in partition_by]) if cluster and partition_by else df


def append_partitioned(
    df: DataFrame, path: str, partition_by: Sequence[str], file_format: str = "parquet", cluster: bool = True
) -> None:
    """Append to a directory table; see ``clustered``."""
    writer = clustered(df, partition_by, cluster).write.mode("append")
    writer.partitionBy(*partition_by).format(file_format).save(path)


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], file_format: str = "parquet", cluster: bool = True
) -> None:
    """Replace the partitions that occur in ``df`` and leave all others alone; see ``clustered``."""
    writer = clustered(df, partition_by, cluster).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).format(file_format).save(path)


def write_bounded(df: DataFrame, path: str, rows_per_file: int, file_format: str = "parquet") -> None:
    """Files of at most ``rows_per_file`` rows, in no particular order and without a shuffle."""
    df.write.option("maxRecordsPerFile", rows_per_file).format(file_format).save(path)


def write_chunks(
    df: DataFrame, path: str, order_by: Sequence[str], rows_per_chunk: int, file_format: str = "parquet"
) -> None:
    """One directory ``chunk_id=N`` per chunk of an ordered table.

    For consumers that need the order; ``write_bounded`` is the cheaper way to bound files.
    Numbered rows are read in ranges, so a task meets few chunks and needs no shuffle.
    """
    with scratch_scope(df.sparkSession):
        append_partitioned(chunk_ids(df, order_by, rows_per_chunk), path, ["chunk_id"], file_format, cluster=False)


def write_files(df: DataFrame, path: str, name: str, content: str) -> list[str]:
    """A text file for each value of the column ``name`` in a partition, named ``name=value``, with a line of ``content`` per row.

    Returns the folders to read, of at most 1,000 files each. Hadoop's local file system starts a ``chmod`` process and adds
    a checksum file for every file, and ``partitionBy`` a folder, so tasks write local files themselves: into a hidden folder
    per attempt, which takes its place when complete. Other stores get a folder per file from Spark's writer.
    """
    spark, per_folder = df.sparkSession, _FILES_PER_FOLDER
    root = local_path(spark, path)
    if root is None:
        df.select(quoted(name), quoted(content)).write.partitionBy(name).text(path)
        return [path]
    # An empty table has a folder too.
    os.makedirs(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part = f"part-{task.partitionId():05d}"
        attempt = f"{root}/.{part}-{task.taskAttemptId()}"
        lines = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for n, (value, group) in enumerate(groupby(lines, lambda row: row[0])):
            folder = f"{attempt}/{n // per_folder:06d}"
            if n % per_folder == 0:
                os.makedirs(folder)
            with open(f"{folder}/{name}={quote(value, safe='')}.txt", "xb") as file:
                file.writelines(line for _, text in group for line in (text or b"", b"\n"))
        if os.path.isdir(attempt):
            try:
                os.rename(attempt, f"{root}/{part}")
            except OSError:
                # Another attempt was first; if not, there is nothing to list below, and that raises.
                shutil.rmtree(attempt)
            yield pa.RecordBatch.from_pydict({"folder": [f"{part}/{f}" for f in sorted(os.listdir(f"{root}/{part}"))]})

    lines = df.select(quoted(name).alias("name"), quoted(content).cast("binary").alias("content")).sortWithinPartitions("name")
    written = lines.select(F.coalesce(F.col("name").cast("string"), F.lit(_NO_VALUE)), "content").mapInArrow(run, "folder string")
    return [f"{path}/{row.folder}" for row in written.collect()] or [path]


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows read from each file of a file-based frame."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("file_rows"))


def file_inventory(spark: SparkSession, path: str | list[str], recursive: bool = False, hashed: bool = False) -> DataFrame:
    """Files below ``path``, or below several: path, name, modification time and length.

    ``hashed`` adds ``md5``; only then are contents read at all: now, each once, and the inventory is kept in the scratch
    folder. Spark reads a file as one row, so the hash is NULL beyond 2 GB; larger data is verified as tables. The hash
    does not depend on ``size_reason``. The driver lists a hundred of several paths at a time.
    """

    def listing(session: SparkSession, paths: str | list[str]) -> DataFrame:
        return session.read.format("binaryFile").option("recursiveFileLookup", recursive).load(paths)

    columns = ["path", path_name("path").alias("name"), "modificationTime", "length"]
    if not hashed:
        return listing(spark, path).select(*columns)
    session, kept = session_with(spark, _SMALL_FILES), scratch_path(spark, "inventory")
    # A condition on the listing: no task meets a file of the other side.
    readable = F.col("_metadata.file_size") < _MAX_ROW_BYTES
    paths = [path] if isinstance(path, str) else path
    for start in range(0, len(paths), _FOLDERS_PER_LISTING):
        files = listing(session, paths[start : start + _FOLDERS_PER_LISTING])
        small = files.where(readable).select(*columns, F.md5("content").alias("md5"))
        large = files.where(~readable).select(*columns, F.lit(None).cast("string").alias("md5"))
        inventory = small.unionByName(large)
        inventory.write.mode("append").parquet(kept)
    return spark.read.schema(inventory.schema).parquet(kept)


def size_reason(
    length: Column | str = "length", min_bytes: int = MIN_FILE_BYTES, max_bytes: int = MAX_FILE_BYTES
) -> Column:
    """Why a file is refused, or NULL when its size is acceptable."""
    size = quoted(length) if isinstance(length, str) else length
    return F.when(size < min_bytes, "too small").when(size > max_bytes, "too large")


def by_name(files: DataFrame) -> DataFrame:
    """Inventory in the order pieces are processed."""
    return files.orderBy("name", "path")


def append_log(df: DataFrame, path: str) -> None:
    """Append run-log rows."""
    df.write.mode("append").parquet(path)
