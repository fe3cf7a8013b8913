"""Table actions as pure functions: each takes frames and returns the new table content."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from martweave.functions.scalars import RETENTION_DAYS, days_before, default_if_null, quoted, timestamp_literal, typed_null
from martweave.operators.conform import conform
from martweave.operators.sizing import KeySize, key_size


def replace(target: DataFrame | None, source: DataFrame, keep_schema: bool = False) -> DataFrame:
    """Source rows as they are; with ``keep_schema`` in the columns of the target, others dropped."""
    return conform(source, target.schema) if keep_schema and target is not None else source


def append(target: DataFrame | None, source: DataFrame) -> DataFrame:
    """Target and source rows; columns that one side lacks are NULL there."""
    return source if target is None else target.unionByName(source, allowMissingColumns=True)


def delete_where(target: DataFrame, condition: Column | str) -> DataFrame:
    """Remove the rows for which ``condition`` is true; a NULL condition keeps the row, as in SQL.

    Written so that Spark can push comparisons down to the scan, which ``coalesce`` would prevent.
    """
    predicate = F.expr(condition) if isinstance(condition, str) else condition
    return target.where(predicate.isNull() | ~predicate)


def delete_before(target: DataFrame, column: str, day: dt.date | dt.datetime) -> DataFrame:
    """Remove rows dated before ``day``; undated rows stay."""
    return target.where(quoted(column).isNull() | (quoted(column) >= timestamp_literal(days_before(day, 0))))


def retain_days(target: DataFrame, column: str, as_of: dt.date | dt.datetime, days: int = RETENTION_DAYS) -> DataFrame:
    """Remove rows older than ``days`` before ``as_of``; undated rows stay."""
    return delete_before(target, column, days_before(as_of, days))


def upsert(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    condition: Column | str | None = None,
    latest_by: Sequence[str] = (),
    check_keys: bool = True,
) -> DataFrame:
    """Source rows replace target rows of equal key and new keys are added.

    ``condition`` deletes from the target only, before the source arrives. NULL keys match
    nothing. Columns that only one side has are kept, NULL on the other. Repeated source keys raise, unless ``latest_by`` says which row counts.

    One pass over the source's key columns makes that test and measures the keys: if they are
    small, they are broadcast and the target is not shuffled. ``check_keys=False`` skips the
    pass for sources known to be unique and leaves the join to Spark. The source is read for
    its keys and for its rows, so one that is costly to compute should be ``parked`` first.
    """
    keys = list(keys)
    small = False
    if check_keys:
        small = require_unique(source, keys, bool(latest_by)).small
    if latest_by:
        source = latest_per_key(source, keys, latest_by)
    return put_rows(target, source, keys, condition, small)


def put_rows(
    target: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    condition: Column | str | None = None,
    small: bool = False,
) -> DataFrame:
    """``upsert`` of a checked source; ``small`` says that its keys may be broadcast."""
    if target is None:
        return source
    kept = target if condition is None else delete_where(target, condition)
    return without_keys(kept, source, keys, small).unionByName(source, allowMissingColumns=True)


def without_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], small: bool = False) -> DataFrame:
    """Target rows whose key the source does not have; NULL keys match nothing.

    Beyond the broadcast size this is a sort-merge anti join, whose hot target keys Spark
    splits at run time.
    """
    changed = source.select(*[quoted(k) for k in keys])
    return target.join(F.broadcast(changed) if small else changed, list(keys), "left_anti").select(
        *[quoted(c) for c in target.columns]
    )


def require_unique(source: DataFrame, keys: Sequence[str], repeats_allowed: bool = False) -> KeySize:
    """Size of the source's keys; raises when a non-NULL key occurs twice."""
    size = key_size(source, keys)
    if size.most_rows > 1 and not repeats_allowed:
        example = repeated_keys(source, keys).first().asDict()
        raise ValueError(f"source key {example} is not unique; pass latest_by to choose a row")
    return size


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``latest_by``, ties decided by the remaining columns.

    An aggregate rather than a window, so a hot key shrinks to one row per task before the
    shuffle. Rows with a NULL key are all kept, since NULL keys match nothing.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in set(keys) | set(latest_by)]
    ranked = F.struct(*[quoted(c) for c in [*latest_by, *rest]])
    keyed, unkeyed = df.where(has_key(keys)), df.where(~has_key(keys))
    latest = keyed.groupBy(*[quoted(k) for k in keys]).agg(F.max(ranked).alias("_latest"))
    picked = [
        (quoted(c) if c in keys else F.col("_latest").getField(c)).alias(c) for c in df.columns
    ]
    return latest.select(*picked).union(unkeyed)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-NULL keys that occur more than once, with their row count."""
    columns = [quoted(k) for k in keys]
    counts = df.where(has_key(keys)).groupBy(*columns).agg(F.count(F.lit(1)).alias("key_rows"))
    return counts.where(F.col("key_rows") > 1)


def has_key(keys: Sequence[str]) -> Column:
    """True when every key column has a value."""
    present = quoted(keys[0]).isNotNull()
    for key in keys[1:]:
        present = present & quoted(key).isNotNull()
    return present


def fill_default(df: DataFrame, columns: Sequence[str], default) -> DataFrame:
    """Replace NULLs of the listed columns by a default cast to each column's type."""
    return df.withColumns({c: default_if_null(c, default, df.schema[c].dataType) for c in columns})


def add_column(df: DataFrame, name: str, data_type: DataType | str, default=None) -> DataFrame:
    """Add a column: NULL everywhere, or ``default`` everywhere and then non-nullable.

    A column that is already there keeps its values and has its NULLs filled.
    """
    existing = next((c for c in df.columns if c.lower() == name.lower()), None)
    if existing is None:
        value = typed_null(data_type) if default is None else F.lit(default).cast(data_type)
        return df.withColumn(name, value)
    if default is None:
        return df
    return df.withColumn(existing, F.coalesce(quoted(existing).cast(data_type), F.lit(default).cast(data_type)))
