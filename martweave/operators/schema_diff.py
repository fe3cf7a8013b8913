"""Compare two column listings ``(schema, table, column, type)``, source against target.

The comparison runs one way: what only the target has is not reported. Types compare as exact
text. A target without the table, or without the whole schema, makes the table source-only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MISSING_COLUMN = "missing_column"
TYPE_DIFFERS = "type_differs"
SOURCE_ONLY = "source_only"
SAME = "same"


def compare_columns(source: DataFrame, target: DataFrame) -> DataFrame:
    """Every source column with its ``status`` and the type on both sides."""
    theirs = target.select("schema", "table", "column", F.col("type").alias("target_type"))
    tables = target.select("schema", "table").distinct().withColumn("_known", F.lit(True))
    status = (
        F.when(F.col("_known").isNull(), SOURCE_ONLY)
        .when(F.col("target_type").isNull(), MISSING_COLUMN)
        .when(F.col("target_type") != F.col("source_type"), TYPE_DIFFERS)
        .otherwise(SAME)
    )
    return (
        source.select("schema", "table", "column", F.col("type").alias("source_type"))
        .join(theirs, ["schema", "table", "column"], "left")
        .join(tables, ["schema", "table"], "left")
        .select("schema", "table", "column", "source_type", "target_type", status.alias("status"))
    )


def schema_diff(source: DataFrame, target: DataFrame) -> DataFrame:
    """Only the source columns that differ."""
    return compare_columns(source, target).where(F.col("status") != SAME)


def schema_diff_by_table(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per source table with its missing, differently typed and source-only columns.

    A group is one table's columns, so the collected lists stay small.
    """
    typed = F.struct(F.col("column"), F.col("source_type").alias("type"))
    both = F.struct("column", "source_type", "target_type")

    def listed(status: str, value):
        return F.sort_array(F.collect_list(F.when(F.col("status") == status, value)))

    return compare_columns(source, target).groupBy("schema", "table").agg(
        listed(MISSING_COLUMN, typed).alias("missing_columns"),
        listed(TYPE_DIFFERS, both).alias("different_data_types"),
        listed(SOURCE_ONLY, typed).alias("source_only_content"),
    )
