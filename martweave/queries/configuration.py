"""Configuration queries. The configuration lines are derived from table rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.queries.inputs import table
from martweave.session import scratch_path
from martweave.sources import config
from martweave.sources.files import read_lines


def _entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON entry per part: the name is the source table, brand and type its targets.

    ``STANDARD`` parts have no targets.
    """
    part = table(spark, sf_dir, "part")
    targets = F.array(F.struct(F.col("p_brand").alias("target_table")), F.struct(F.col("p_type").alias("target_table")))
    entry = F.struct(
        F.col("p_name").alias("source_table"),
        F.when(F.col("p_type") != "STANDARD", targets).otherwise(F.slice(targets, 1, 0)).alias("foreign_keys"),
    )
    path = scratch_path(spark, "merge-config")
    part.select(F.to_json(entry).alias("value")).write.text(path)
    return config.read_json_config(spark, path)


def _list_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``BRAND="name,size..."`` lines, one per part."""
    line = F.format_string('%s="%s,size_%d"', "p_brand", "p_name", "p_size")
    path = scratch_path(spark, "list-config")
    table(spark, sf_dir, "part").select(line.alias("value")).write.text(path)
    return read_lines(spark, path)


def json_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = config.config_edges(_entries(spark, sf_dir))
    return edges.groupBy("source_table", "target_table").agg(F.count(F.lit(1)).alias("entries"))


def list_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = config.parse_list_config(_list_lines(spark, sf_dir))
    return values.groupBy("key", "value").agg(F.count(F.lit(1)).alias("entries"))


def _requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables asked for under exactly ``Brand#1`` (not ``Brand#10`` and so on)."""
    values = config.parse_list_config(_list_lines(spark, sf_dir))
    return values.where(F.col("key") == "Brand#1").select(F.col("value").alias("source_table")).distinct()


def config_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.missing_sources(_requested(spark, sf_dir), _entries(spark, sf_dir))


def config_stage_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return config.stage_plan(_requested(spark, sf_dir), _entries(spark, sf_dir))


def config_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the entries of one configured table point at: the first part by name that is not ``STANDARD``."""
    first = table(spark, sf_dir, "part").where("p_type <> 'STANDARD'").agg(F.min("p_name")).first()[0]
    return config.targets_of(_entries(spark, sf_dir), first)


_SIZES = "'size_' || CAST(p_size AS VARCHAR)"
_REQUESTED = f"""SELECT DISTINCT unnest([p_name, {_SIZES}]) AS source_table FROM part WHERE p_brand = 'Brand#1'"""

QUERIES = {
    "json_config": (
        json_config,
        """SELECT source_table, target_table, count(*) AS entries FROM (
            SELECT p_name AS source_table, unnest([p_brand, p_type]) AS target_table FROM part WHERE p_type <> 'STANDARD'
            UNION ALL SELECT p_name, NULL FROM part WHERE p_type = 'STANDARD') GROUP BY 1, 2""",
    ),
    "list_config": (
        list_config,
        f"""SELECT "key", value, count(*) AS entries
        FROM (SELECT p_brand AS "key", unnest([p_name, {_SIZES}]) AS value FROM part) GROUP BY 1, 2""",
    ),
    "config_missing": (
        config_missing,
        f"SELECT source_table FROM ({_REQUESTED}) WHERE source_table NOT IN (SELECT p_name FROM part)",
    ),
    "config_stage_plan": (
        config_stage_plan,
        f"""WITH known AS (SELECT * FROM part WHERE p_name IN (SELECT source_table FROM ({_REQUESTED})))
        SELECT 'incremental' AS mode, p_name AS "table" FROM known
        UNION SELECT 'full', p_brand FROM known WHERE p_type <> 'STANDARD'
        UNION SELECT 'full', p_type FROM known WHERE p_type <> 'STANDARD'""",
    ),
    "config_targets": (
        config_targets,
        """SELECT unnest([p_brand, p_type]) AS target_table FROM part WHERE p_type <> 'STANDARD'
        AND p_name = (SELECT min(p_name) FROM part WHERE p_type <> 'STANDARD')""",
    ),
}
