"""Primary- and foreign-key checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.functions.scalars import quoted
from martweave.model import ForeignKey, TableSpec
from martweave.operators.actions import has_key, repeated_keys


def with_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key columns all have a value."""
    return df.where(has_key(keys))


def without_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that ``with_key`` rejects."""
    return df.where(~has_key(keys))


def fk_valid(fact: DataFrame, dimension: DataFrame, fk: ForeignKey) -> DataFrame:
    """Rows of ``fact`` whose foreign key exists in ``dimension``."""
    return fact.join(_referenced(dimension, fk), list(fk.columns), "left_semi")


def fk_orphans(fact: DataFrame, dimension: DataFrame, fk: ForeignKey) -> DataFrame:
    """Rows of ``fact`` whose foreign key is NULL or absent from ``dimension``."""
    return fact.join(_referenced(dimension, fk), list(fk.columns), "left_anti")


@dataclass(frozen=True)
class CheckedKeys:
    """Rows with their key checks; accepted and refused rows come from one set of joins."""

    marked: DataFrame
    columns: tuple[str, ...]
    checks: tuple[tuple[str, Column], ...]

    @property
    def holds(self) -> Column:
        return reduce(Column.__and__, [check for _, check in self.checks])

    def accepted(self) -> DataFrame:
        return self.marked.where(self.holds).select(*[quoted(c) for c in self.columns])

    def refused(self) -> DataFrame:
        """Rows with at least one failed check, listed in ``reject_reasons``."""
        reasons = F.array_compact(F.array(*[F.when(~check, F.lit(reason)) for reason, check in self.checks]))
        return self.marked.where(~self.holds).select(
            *[quoted(c) for c in self.columns], reasons.alias("reject_reasons")
        )


def check_keys(df: DataFrame, spec: TableSpec, dimensions: dict[str, DataFrame], unique: bool = False) -> CheckedKeys:
    """Check the primary key for NULLs, with ``unique`` also for repeats, and each foreign key against its dimension.

    All rows of a repeated key fail, since none of them is known to be the right one.

    One left join per foreign key marks the rows; Spark turns it into an inner join where only
    accepted rows are asked for. Dimension keys are distinct, hence no row is multiplied.
    """
    checks = [("primary key is null", has_key(spec.primary_key))]
    marked = df
    if unique:
        repeats = repeated_keys(df, spec.primary_key).select(*[quoted(k) for k in spec.primary_key], F.lit(True).alias("_repeats"))
        marked = marked.join(repeats, list(spec.primary_key), "left")
        checks.append(("primary key repeats", F.col("_repeats").isNull()))
    for position, fk in enumerate(spec.foreign_keys):
        flag = f"_fk_{position}"
        known = _referenced(dimensions[fk.references], fk).withColumn(flag, F.lit(True))
        marked = marked.join(known, list(fk.columns), "left")
        checks.append((f"no match in {fk.references}", F.col(flag).isNotNull()))
    return CheckedKeys(marked, tuple(df.columns), tuple(checks))


def null_counts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Aggregates counting the NULLs of each column."""
    return [F.count_if(quoted(c).isNull()).alias(f"{c}_nulls") for c in columns]


def assert_not_null(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise when a column that must have values has none somewhere."""
    counts = df.agg(*null_counts(df, columns)).first()
    empty = {c: counts[f"{c}_nulls"] for c in columns if counts[f"{c}_nulls"]}
    if empty:
        raise ValueError(f"NULLs in non-nullable columns: {empty}")


def lost_keys(before: DataFrame, after: DataFrame, fk: ForeignKey) -> DataFrame:
    """Keys that left a dimension, under the names the fact uses."""
    return _referenced(before, fk).join(_referenced(after, fk), list(fk.columns), "left_anti")


def _referenced(dimension: DataFrame, fk: ForeignKey) -> DataFrame:
    """The dimension's distinct keys under the names the fact uses.

    Repeats collapse within each task; the aggregate partitions by the join key already, so
    the join needs no further shuffle. On the fact side Spark splits hot keys at run time,
    which it can not do for the right side of a semi or anti join.
    """
    return dimension.select(*[quoted(r).alias(c) for c, r in zip(fk.columns, fk.ref_columns)]).distinct()
