"""A table stored for reading page after page: sorted files, and a directory of where each begins.

Sorting is paid once, when the pages are written. The directory holds, per file, its first key and the running
count of rows before it, so a page opens the one or two files that its rows lie in and sorts nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.functions.scalars import quoted
from martweave.operators.ordering import row_index
from martweave.session import parked, scratch_scope

DIRECTORY = "_pages"
ROW = "_row"
ROWS_PER_FILE = 1_000_000
_MOST_RANGES = 100_000


def store_pages(df: DataFrame, path: str, order_by: Sequence[str], unique: bool = True, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``df`` sorted by ``order_by`` (NULL first), at most ``rows_per_file`` rows a file, with its directory.

    An ordering with many equal rows takes ``unique=False``; their order is then fixed by this write.
    """
    if rows_per_file < 1:
        raise ValueError("rows_per_file must be positive")
    spark = df.sparkSession
    with scratch_scope(spark):
        numbered = row_index(df, order_by, name=ROW, unique=unique)
        # Numbers are dense, so their ranges are even, and a task writes whole files in order.
        ranged = numbered.withColumn("_file", F.expr(f"({ROW} - 1) div {rows_per_file}L"))
        n_files = min(max(1, -(-numbered.count() // rows_per_file)), _MOST_RANGES)
        in_order = ranged.repartitionByRange(n_files, "_file").sortWithinPartitions(ROW).drop("_file")
        in_order.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    write_directory(spark, path, order_by)


def write_directory(spark: SparkSession, path: str, order_by: Sequence[str]) -> None:
    """Directory of the files at ``path``, read from their row numbers and keys: (file, first_row, last_row, first_key)."""
    stored = spark.read.parquet(path)
    key = F.struct(F.col(ROW), F.struct(*map(quoted, order_by)).alias("key"))
    files = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(ROW).alias("first_row"), F.max(ROW).alias("last_row"), F.min(key)["key"].alias("first_key")
    )
    decoded = F.url_decode(F.replace(F.col("file"), F.lit("+"), F.lit("%2B")))
    parked(files.withColumn("file", decoded), "page-directory").coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{DIRECTORY}")


def page_files(spark: SparkSession, path: str, offset: int, rows: int) -> list[str]:
    """Files that hold rows ``offset + 1`` to ``offset + rows``."""
    directory = spark.read.parquet(f"{path.rstrip('/')}/{DIRECTORY}")
    found = directory.where((F.col("first_row") <= offset + rows) & (F.col("last_row") > offset)).orderBy("first_row")
    return [r["file"] for r in found.select("file").collect()]


def read_page(spark: SparkSession, path: str, offset: int, rows: int) -> DataFrame:
    """``rows`` rows after skipping ``offset``, with their number ``_row``; beyond the end there are none.

    Nothing is sorted again: rows of a file come in order, and ``_row`` gives the order of all.
    """
    files = page_files(spark, path, offset, rows) if rows > 0 else []
    stored = spark.read.parquet(path)
    source = spark.read.schema(stored.schema).parquet(*files) if files else stored.limit(0)
    return source.where(F.col(ROW).between(offset + 1, offset + rows))


def read_from_key(spark: SparkSession, path: str, key: Sequence, rows: int) -> DataFrame:
    """The ``rows`` rows from the first one whose ordering columns are at least ``key``: paging by key instead of number."""
    directory = spark.read.parquet(f"{path.rstrip('/')}/{DIRECTORY}")
    names = directory.schema["first_key"].dataType.names
    wanted = F.struct(*[F.lit(v).cast(directory.schema["first_key"].dataType[n].dataType).alias(n) for n, v in zip(names, key, strict=True)])
    before = directory.where(F.col("first_key") <= wanted).agg(F.max("first_row").alias("row")).first()["row"] or 1
    stored = spark.read.parquet(path)
    # The key lies in the file that begins at or before it, or is the first key of the next one.
    end = directory.where(F.col("first_row") == before).select("last_row").first()
    if end is None:
        return stored.limit(0)
    own = read_page(spark, path, before - 1, end["last_row"] - before + 1)
    at = own.where(F.struct(*map(quoted, names)) >= wanted).agg(F.min(ROW).alias("row")).first()["row"]
    return read_page(spark, path, (at or end["last_row"] + 1) - 1, rows)
