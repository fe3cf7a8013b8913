"""Conform a frame to a target schema in a single projection."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from martweave.functions.scalars import quoted, timestamp_literal, typed_null, with_prefix
from martweave.model import TableSpec


@dataclass(frozen=True)
class ConformReport:
    """Target columns filled with NULL and input columns left out."""

    missing: tuple[str, ...]
    dropped: tuple[str, ...]


def select_as(df: DataFrame, columns: dict[str, Column | str]) -> DataFrame:
    """Explicit projection: output name -> input column or expression."""
    return df.select(*[(quoted(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep the mapped input columns only, under their new names."""
    return df.select(*[quoted(old).alias(new) for old, new in mapping.items()])


def conform(
    df: DataFrame,
    target: StructType,
    mapping: dict[str, str] | None = None,
    on_error: str = "raise",
) -> DataFrame:
    """Rename, cast and reorder ``df`` to ``target``; absent columns become typed NULLs.

    Names match without regard to case, as Spark resolves them. A value that does not fit the
    target type raises, or becomes NULL with ``on_error="null"``.
    """
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    sources = _sources_by_target(df, mapping)
    return df.select(*[_target_column(df, sources, f, on_error).alias(f.name) for f in target.fields])


def conform_report(df: DataFrame, target: StructType, mapping: dict[str, str] | None = None) -> ConformReport:
    """What ``conform`` would fill and drop; needs schemas only."""
    sources = _sources_by_target(df, mapping)
    wanted = {name.lower() for name in target.names}
    used = {sources[name] for name in wanted if name in sources}
    return ConformReport(
        missing=tuple(n for n in target.names if n.lower() not in sources),
        dropped=tuple(c for c in df.columns if c not in used),
    )


def conform_to_table(spark: SparkSession, df: DataFrame, table: str, mapping: dict[str, str] | None = None) -> DataFrame:
    """Conform to the schema of a catalogue table."""
    return conform(df, spark.table(table).schema, mapping)


def add_load_time(df: DataFrame, name: str, as_of: str | None = None) -> DataFrame:
    """Load timestamp: the query's start, or a frozen ``as_of`` for repeatable results."""
    stamp = F.current_timestamp() if as_of is None else timestamp_literal(as_of)
    return df.withColumn(name, stamp)


def add_prefixed(df: DataFrame, name: str, prefix: str, column: str) -> DataFrame:
    """Computed text column ``prefix`` + value."""
    return df.withColumn(name, with_prefix(prefix, column))


def output_schema(schema: StructType, spec: TableSpec) -> StructType:
    """Copy of ``schema`` with the primary-key columns non-nullable."""
    keys = {name.lower() for name in spec.primary_key}
    unknown = keys - {name.lower() for name in schema.names}
    if unknown:
        raise ValueError(f"{spec.name}: no column for key {sorted(unknown)}")
    return StructType(
        [StructField(f.name, f.dataType, f.nullable and f.name.lower() not in keys, f.metadata) for f in schema.fields]
    )


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """Partition columns as the catalogue knows them (never guessed by position)."""
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _sources_by_target(df: DataFrame, mapping: dict[str, str] | None) -> dict[str, str]:
    """Lower-cased target name -> input column."""
    pairs = [(c, c) for c in df.columns] if mapping is None else list(mapping.items())
    inputs: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in inputs:
            raise ValueError(f"columns '{inputs[name.lower()]}' and '{name}' differ only in case")
        inputs[name.lower()] = name
    sources: dict[str, str] = {}
    for source, target in pairs:
        if source.lower() not in inputs:
            raise ValueError(f"mapped column '{source}' is not in the input")
        if target.lower() in sources:
            raise ValueError(f"two input columns map to '{target}'")
        sources[target.lower()] = inputs[source.lower()]
    return sources


def _target_column(df: DataFrame, sources: dict[str, str], field: StructField, on_error: str) -> Column:
    source = sources.get(field.name.lower())
    if source is None:
        return typed_null(field.dataType)
    return _cast(quoted(source), df.schema[source].dataType, field.dataType, on_error)


def _cast(column: Column, actual: DataType, wanted: DataType, on_error: str) -> Column:
    if actual == wanted:
        return column
    return column.cast(wanted) if on_error == "raise" else column.try_cast(wanted)
