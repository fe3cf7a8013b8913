"""Merge the extracts of a mart: conform, check keys, combine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from martweave.model import DIMENSION, FACT, TableSpec
from martweave.operators.conform import conform, conform_report, output_schema
from martweave.operators.keys import check_keys
from martweave.operators.lattice import NoCommonType, lattice
from martweave.session import parked


@dataclass(frozen=True)
class MergeResult:
    """Merged tables and, per table, the refused rows with ``reject_reasons``."""

    tables: dict[str, DataFrame]
    rejects: dict[str, DataFrame]
    schemas: dict[str, StructType]
    #: Per table, columns of a piece that its declared schema does not have: (piece, column).
    dropped: dict[str, tuple[tuple[int, str], ...]]
    #: Per table without a declared schema, what pieces lack or have as another type: (piece, column, from, to).
    changes: dict[str, tuple[tuple[int, str, str | None, str], ...]]


def combine(pieces: Sequence[DataFrame], schema: StructType) -> DataFrame:
    """All rows of several pieces of one table, each conformed to ``schema`` first; see ``dropped_columns``."""
    return reduce(DataFrame.union, [conform(piece, schema) for piece in pieces])


def dropped_columns(pieces: Sequence[DataFrame], schema: StructType) -> tuple[tuple[int, str], ...]:
    """Columns that ``combine`` leaves out, with the number of their piece; needs schemas only."""
    return tuple((i, name) for i, piece in enumerate(pieces) for name in conform_report(piece, schema).dropped)


def merge_extracts(
    specs: Sequence[TableSpec], inputs: dict[str, Sequence[DataFrame]], park_facts: bool = False
) -> MergeResult:
    """Merge the pieces of every table in ``specs``.

    A declared schema decides the columns, and the result says what it drops. Without one the least schema that
    holds all pieces is taken, so a column that only a later piece has survives and types widen; pieces without a
    common type are refused with the reason.

    Rows without a primary key are refused, dimension rows also when their key repeats (a repeated
    fact key stops the upsert instead), and fact rows when a foreign key finds no dimension row. Dimensions are merged first, so facts are checked against accepted rows.
    Schema problems raise here, before anything runs. ``park_facts`` runs the joins of each fact
    once and keeps their outcome in scratch, for callers that use both results or use one often.
    """
    by_name = {spec.name: spec for spec in specs}
    for spec in specs:
        if not inputs.get(spec.name):
            raise ValueError(f"no input for table '{spec.name}'")
        for fk in spec.foreign_keys:
            if fk.references not in by_name or by_name[fk.references].kind != DIMENSION:
                raise ValueError(f"{spec.name}: '{fk.references}' is not a dimension of this merge")

    tables: dict[str, DataFrame] = {}
    rejects: dict[str, DataFrame] = {}
    schemas: dict[str, StructType] = {}
    dropped: dict[str, tuple] = {}
    changes: dict[str, tuple] = {}
    for spec in sorted(specs, key=lambda s: s.kind == FACT):
        pieces = inputs[spec.name]
        schema = spec.schema
        if schema is None:
            try:
                common = lattice(pieces)
            except NoCommonType as clash:
                raise NoCommonType(f"{spec.name}: {clash}") from clash
            schema, changes[spec.name] = common.schema, common.changes
        else:
            dropped[spec.name] = dropped_columns(pieces, schema)
        schemas[spec.name] = output_schema(schema, spec)
        checked = check_keys(combine(pieces, schema), spec, tables, unique=spec.kind == DIMENSION)
        if park_facts and spec.foreign_keys:
            checked = replace(checked, marked=parked(checked.marked, "merged-fact"))
        tables[spec.name] = checked.accepted()
        rejects[spec.name] = checked.refused()
    return MergeResult(tables, rejects, schemas, dropped, changes)
