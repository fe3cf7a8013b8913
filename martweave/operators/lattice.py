"""The least schema that holds all pieces of a table, so that combining them loses neither columns nor values.

Types stand in a lattice: whole numbers widen to longer ones, these and decimals to decimals that hold both, numbers to doubles, dates
to timestamps, and any of them to text. Types without a common upper bound (binary and numbers, structures and text, say)
are refused with the pieces that brought them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
#: Digits that hold every value of a whole type.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_MOMENTS = (T.DateType, T.TimestampNTZType, T.TimestampType)
_MAX_DIGITS = 38


class NoCommonType(ValueError):
    """Types that nothing holds both of."""


@dataclass(frozen=True)
class Lattice:
    """The common schema, and what each piece lacks or has to change: (piece, column, from, to); ``from`` is NULL for an absent column."""

    schema: T.StructType
    changes: tuple[tuple[int, str, str | None, str], ...]


def least_common(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds all values of both; raises ``NoCommonType``.

    A double holds whole numbers exactly up to 2**53; larger ones round, as everywhere in SQL.
    """
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return common_fields([a, b], str)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(least_common(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        value = least_common(a.valueType, b.valueType)
        return T.MapType(least_common(a.keyType, b.keyType), value, a.valueContainsNull or b.valueContainsNull)
    found = _numbers(a, b) or _moments(a, b)
    if found is None and _printable(a) and _printable(b):
        found = T.StringType()
    if found is None:
        raise NoCommonType(f"{a.simpleString()} and {b.simpleString()} have no common type")
    return found


def _numbers(a: T.DataType, b: T.DataType) -> T.DataType | None:
    if not (isinstance(a, T.NumericType) and isinstance(b, T.NumericType)):
        return None
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _DIGITS[type(t)])
    if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    digits, scale = (max(pair) for pair in zip(*(_decimal(t) for t in (a, b)), strict=True))
    if digits + scale > _MAX_DIGITS:
        return T.StringType()
    return T.DecimalType(digits + scale, scale)


def _decimal(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the point."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    return _DIGITS[type(kind)], 0


def _moments(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """A date is the beginning of its day. Moments with and without a zone have none in common but text."""
    if not (isinstance(a, _MOMENTS) and isinstance(b, _MOMENTS)) or {type(a), type(b)} == {T.TimestampType, T.TimestampNTZType}:
        return None
    return b if isinstance(a, T.DateType) else a


def _printable(kind: T.DataType) -> bool:
    return isinstance(kind, (T.NumericType, T.StringType, T.BooleanType, *_MOMENTS))


def common_fields(schemas: Sequence[T.StructType], name_of=lambda i: f"piece {i}") -> T.StructType:
    """Union of the columns, in the order of first appearance and with its spelling, each of the least common type.

    Names match without regard to case. Raises ``NoCommonType`` with all clashes at once.
    """
    fields: dict[str, T.StructField] = {}
    first: dict[str, int] = {}
    clashes = []
    for i, schema in enumerate(schemas):
        own = [f.name.lower() for f in schema.fields]
        twice = {n for n in own if own.count(n) > 1}
        if twice:
            raise ValueError(f"{name_of(i)} has columns that differ only in case: {', '.join(sorted(twice))}")
        for field in schema.fields:
            key = field.name.lower()
            known = fields.get(key)
            if known is None:
                fields[key], first[key] = T.StructField(field.name, field.dataType, field.nullable or i > 0, field.metadata), i
                continue
            try:
                kind = least_common(known.dataType, field.dataType)
            except NoCommonType as clash:
                clashes.append(f"{known.name}: {clash} ({name_of(first[key])}, {name_of(i)})")
                continue
            fields[key] = T.StructField(known.name, kind, known.nullable or field.nullable, known.metadata)
        for key in fields.keys() - set(own):
            fields[key] = T.StructField(fields[key].name, fields[key].dataType, True, fields[key].metadata)
    if clashes:
        raise NoCommonType("; ".join(clashes))
    return T.StructType(list(fields.values()))


def lattice(pieces: Sequence[DataFrame]) -> Lattice:
    """Common schema of all pieces, from their schemas alone, and how each one differs from it."""
    schema = common_fields([p.schema for p in pieces])
    changes = []
    for i, piece in enumerate(pieces):
        own = {f.name.lower(): f.dataType for f in piece.schema.fields}
        for field in schema.fields:
            given = own.get(field.name.lower())
            if given != field.dataType:
                changes.append((i, field.name, None if given is None else given.simpleString(), field.dataType.simpleString()))
    return Lattice(schema, tuple(changes))
