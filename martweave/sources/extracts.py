"""Extracts: directories ``<root>/<schema>/<table>`` of Parquet files, and catalogue listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.functions.scalars import path_stem
from martweave.operators.keys import null_counts

LISTING_SCHEMA = "schema string, table string, position int, column string, type string, nullable boolean"


def extract_path(root: str, table: str, schema: str = "public") -> str:
    """Directory of one table."""
    return f"{root.rstrip('/')}/{schema}/{table}"


def write_table(df: DataFrame, root: str, table: str, schema: str = "public") -> None:
    """Create or replace a table of an extract from a frame that does not read it."""
    df.write.mode("overwrite").parquet(extract_path(root, table, schema))


def read_table(spark: SparkSession, root: str, table: str, schema: str = "public") -> DataFrame:
    """One named table."""
    return spark.read.parquet(extract_path(root, table, schema))


def list_tables(spark: SparkSession, root: str) -> DataFrame:
    """``(schema, table)`` pairs of an extract, from file paths alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    tail = rf"/([^/]+)/([^/]+)/[^/]+$"
    return (
        files.load(root)
        .select(F.regexp_extract("path", tail, 1).alias("schema"), F.regexp_extract("path", tail, 2).alias("table"))
        .distinct()
    )


def first_table(spark: SparkSession, root: str) -> DataFrame | None:
    """First table of the first schema by name, or ``None`` for an empty extract."""
    found = list_tables(spark, root).orderBy("schema", "table").limit(1).collect()
    return read_table(spark, root, found[0]["table"], found[0]["schema"]) if found else None


def read_pieces(spark: SparkSession, pattern: str) -> DataFrame:
    """All pieces that match a glob, each row with the ``piece`` it came from."""
    source = path_stem(F.regexp_extract(F.col("_metadata.file_path"), r"^(.*)/[^/]*$", 1))
    return spark.read.parquet(pattern).select("*", source.alias("piece"))


def read_split_extract(spark: SparkSession, pattern: str) -> dict[str, dict[str, DataFrame]]:
    """Extracts that match a glob, in name order, each with its tables: piece -> table -> frame.

    For a few pieces that are acted upon one after the other; ``read_pieces`` reads any number
    of pieces of one table as a single scan.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    found = files.load(pattern).select(folder.alias("folder")).distinct().orderBy("folder").collect()
    pieces: dict[str, dict[str, DataFrame]] = {}
    for row in found:
        piece, _schema, table = row["folder"].rsplit("/", 3)[1:]
        pieces.setdefault(piece, {})[table] = spark.read.parquet(row["folder"])
    return dict(sorted(pieces.items()))


def list_columns(spark: SparkSession, tables: dict[str, DataFrame], schema: str = "public") -> DataFrame:
    """Column listing of frames, taken from their schemas."""
    rows = [
        (schema, name, position, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for position, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def list_catalog_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Column listing of the session catalogue."""
    database = database or spark.catalog.currentDatabase()
    tables = {
        t.name: spark.table(f"`{database}`.`{t.name}`")
        for t in spark.catalog.listTables(database)
        if not t.isTemporary
    }
    return list_columns(spark, tables, database)


def profile_columns(df: DataFrame, table: str) -> DataFrame:
    """Column listing of one table with its row count and each column's NULLs, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), *null_counts(df, df.columns))
    entries = F.array(
        *[
            F.struct(
                F.lit(position).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                F.col(f"`{f.name}_nulls`").alias("null_count"),
            )
            for position, f in enumerate(df.schema.fields, start=1)
        ]
    )
    return counts.select(F.lit(table).alias("table"), "row_count", F.inline(entries))
