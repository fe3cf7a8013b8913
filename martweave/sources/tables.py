"""Catalogue tables: create, load, rename and extend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from martweave.operators.conform import conform, partition_columns
from martweave.operators.ordering import batch_ids
from martweave.session import scratch_path, scratch_scope
from martweave.sources.files import append_partitioned, clustered, overwrite_partitions


def quote_name(name: str) -> str:
    """Back-quoted identifier; dots separate database and table."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def create_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    file_format: str = "orc",
    location: str | None = None,
) -> None:
    """Create a table unless it exists. Partition columns are listed once, in ``schema``."""
    columns = ", ".join(f"{quote_name(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    statement = f"CREATE TABLE IF NOT EXISTS {quote_name(name)} ({columns}) USING {file_format}"
    if partition_by:
        statement += f" PARTITIONED BY ({', '.join(quote_name(c) for c in partition_by)})"
    if location:
        escaped = location.replace("'", "\\'")
        statement += f" LOCATION '{escaped}'"
    spark.sql(statement)


def append_to_table(
    df: DataFrame, name: str, mapping: dict[str, str] | None = None, cluster: bool = True
) -> None:
    """Conform to the table's schema and append, in one distributed write; see ``files.clustered``."""
    spark = df.sparkSession
    ready = conform(df, spark.table(name).schema, mapping)
    clustered(ready, partition_columns(spark, name), cluster).write.mode("append").insertInto(name)


def overwrite_table_partitions(
    df: DataFrame, name: str, mapping: dict[str, str] | None = None, cluster: bool = True
) -> None:
    """Conform to the table's schema and replace just the partitions that occur in ``df``."""
    spark = df.sparkSession
    columns = partition_columns(spark, name)
    if not columns:
        raise ValueError(f"table '{name}' is not partitioned")
    ready = conform(df, spark.table(name).schema, mapping)
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(name)}").collect()}
    if details["Provider"].lower() == "hive":
        # Needs hive.exec.dynamic.partition.mode=nonstrict; Hive itself replaces present partitions only.
        ready.write.mode("overwrite").insertInto(name)
        return
    overwrite_partitions(ready, details["Location"], columns, details["Provider"], cluster)
    spark.sql(f"MSCK REPAIR TABLE {quote_name(name)}")
    spark.catalog.refreshTable(name)


def rename_table(spark: SparkSession, name: str, new_name: str) -> None:
    """Rename a table; its data stays where it is."""
    spark.sql(f"ALTER TABLE {quote_name(name)} RENAME TO {quote_name(new_name)}")


def add_table_column(spark: SparkSession, name: str, column: str, data_type: DataType | str) -> None:
    """Add a nullable column; existing rows read NULL. See ``actions.add_column`` for the rest."""
    kind = data_type if isinstance(data_type, str) else data_type.simpleString()
    spark.sql(f"ALTER TABLE {quote_name(name)} ADD COLUMNS ({quote_name(column)} {kind})")


def preview_table(spark: SparkSession, name: str, rows: int = 5) -> DataFrame:
    """A few rows of a table, to check a load."""
    return spark.table(name).limit(rows)


def load_batches(
    df: DataFrame, name: str, order_by: Sequence[str] | None = None, batches: int = 10, cluster: bool = True
) -> None:
    """Load a frame into a table: one write, or ordered batches when ``order_by`` is given.

    Batches exist for targets that cannot take everything at once. They are laid out once, one
    directory each, so that no batch reads another's rows.
    """
    if order_by is None:
        append_to_table(df, name, cluster=cluster)
        return
    spark = df.sparkSession
    with scratch_scope(spark):
        path = scratch_path(spark, "batches")
        append_partitioned(batch_ids(df, order_by, batches), path, ["batch_id"], cluster=False)
        laid_out = spark.read.parquet(path)
        for batch in range(batches):
            append_to_table(laid_out.where(F.col("batch_id") == batch).drop("batch_id"), name, cluster=cluster)
