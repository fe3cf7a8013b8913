"""Merge configuration: nested JSON of tables and their foreign keys, and ``KEY="a,b"`` lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from martweave.functions.scalars import list_values

ENTRY_SCHEMA = StructType(
    [
        StructField("source_table", StringType()),
        StructField("foreign_keys", ArrayType(StructType([StructField("target_table", StringType())]))),
    ]
)


def read_json_config(spark: SparkSession, path: str, root: str | None = None) -> DataFrame:
    """Configuration entries as ``(source_table, foreign_keys)``.

    Without ``root`` each line of the input is one entry and files split across tasks. With
    ``root`` the input is one JSON document that lists its entries under that name.
    """
    if root is None:
        return spark.read.schema(ENTRY_SCHEMA).json(path)
    document = StructType([StructField(root, ArrayType(ENTRY_SCHEMA))])
    nested = spark.read.schema(document).option("multiLine", True).json(path)
    return nested.select(F.inline(F.col(f"`{root}`")))


def config_edges(entries: DataFrame) -> DataFrame:
    """``(source_table, target_table)``; a source without foreign keys keeps a NULL target."""
    targets = F.explode_outer("foreign_keys.target_table")
    return entries.select("source_table", targets.alias("target_table"))


def targets_of(entries: DataFrame, source_table: str) -> DataFrame:
    """Tables that the foreign keys of one source table point at."""
    edges = config_edges(entries.where(F.col("source_table") == source_table))
    return edges.where(F.col("target_table").isNotNull()).select("target_table")


def parse_list_config(lines: DataFrame, line: str = "value") -> DataFrame:
    """``(key, value)`` rows of ``KEY="a,b"`` lines; keys are compared whole, never as substrings."""
    key = F.trim(F.substring_index(line, "=", 1))
    text = F.expr(f"substr(`{line}`, instr(`{line}`, '=') + 1)")
    return (
        lines.where(F.contains(line, F.lit("=")))
        .where(~F.startswith(F.ltrim(line), F.lit("#")))
        .select(key.alias("key"), F.explode(list_values(text)).alias("value"))
    )


def missing_sources(requested: DataFrame, entries: DataFrame) -> DataFrame:
    """Requested tables that the configuration does not know."""
    known = entries.select("source_table").distinct()
    return requested.select("source_table").join(known, "source_table", "left_anti")


def stage_plan(requested: DataFrame, entries: DataFrame) -> DataFrame:
    """Tables to stage: requested facts incrementally and their dimensions in full, each once.

    A known source without foreign keys is staged alone.
    """
    known = entries.join(requested.select("source_table").distinct(), "source_table", "left_semi")
    facts = known.select(F.lit("incremental").alias("mode"), F.col("source_table").alias("table"))
    dimensions = (
        config_edges(known).where(F.col("target_table").isNotNull())
        .select(F.lit("full").alias("mode"), F.col("target_table").alias("table"))
    )
    return facts.unionByName(dimensions).distinct()
