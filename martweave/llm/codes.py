"""Vector compression by product codes, with exact integer distances pruned through pivots.

Components become integers ``floor(4096 * x)``; each of eight equal parts of a vector is coded by the
nearest entry of its codebook, which a fixed number of rounds refines. Distances from every part to a
few fixed pivots (entries of the first codebook) are computed once and stored. In each round the
distances from the pivots to the entries are known too, and by the triangle inequality their
differences bound the distance of a part and an entry from below. Entries are tried in the order of
these bounds, and only while the bound does not exceed the best exact distance.

A task adds up its rows by entry, so a round shuffles one row per task, part, entry and component and
the driver gets one codebook, however many vectors there are.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.llm.words import ship
from martweave.operators.sizing import broadcast_if_small
from martweave.session import parked

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
PIVOTS = 4
_SLICE = 4096
#: Stored distances are single precision; bounds give way by more than that loses.
_SLACK = 1e-6
_FAR = 10**30
_LIMB = 32
_SALTS = 64


def storable(vector: Column) -> Column:
    """Vectors that are coded: not NULL, every component present and finite."""
    return F.coalesce(~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))), F.lit(False))


def to_integers(values: np.ndarray, exact: bool) -> np.ndarray:
    """``floor(4096 * x)``; as Python integers where 64 bits could overflow in squares and sums."""
    if not exact:
        return np.floor(SCALE * values.astype(float)).astype(np.int64)
    out = np.empty(values.shape, object)
    # A double is a whole multiple of a power of two, so its ratio of integers is exact at any size.
    out.reshape(-1)[:] = [SCALE * a // b for a, b in (x.as_integer_ratio() for x in values.astype(float).reshape(-1).tolist())]
    return out


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return (gap * gap).sum(axis=-1)


def _roots(squares: np.ndarray) -> np.ndarray:
    """Square roots, whole ones of Python integers; cut off at ``_FAR``, which keeps differences below the true ones."""
    if squares.dtype != object:
        return np.sqrt(squares.astype(float))
    return np.array([float(math.isqrt(v)) if v < _FAR**2 else float(_FAR) for v in squares.reshape(-1).tolist()]).reshape(squares.shape)


def pivot_distances(parts: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each part (rows) to each pivot (columns)."""
    return np.stack([_roots(_squares(parts, p[None])) for p in pivots], axis=1).astype(np.float32)


def assign(parts: np.ndarray, far: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest entry of each part, its exact squared distance, and how many exact distances that took.

    ``far`` holds the distances of ``parts`` to ``pivots``. Ties go to the lower entry.
    """
    known, given = pivot_distances(entries, pivots).astype(float), far.astype(float)
    bound = np.abs(given[:, None, 0] - known[None, :, 0])
    for p in range(1, len(pivots)):
        np.maximum(bound, np.abs(given[:, None, p] - known[None, :, p]), out=bound)
    whole = 2.0 if parts.dtype == object else 0.0
    bound -= whole + _SLACK * (given.max(axis=1, initial=0)[:, None] + known.max(initial=0) + 1)
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(len(parts), -1, np.int64)
    least = np.zeros(len(parts), parts.dtype)
    open_, tried = np.arange(len(parts)), 0
    for j in range(len(entries)):
        at = order[open_, j]
        if j:
            # Bounds ascend, so a part that stops here needs none of the later entries either.
            going = bound[open_, at] <= _roots(least[open_]) + whole
            open_, at = open_[going], at[going]
        if not len(open_):
            break
        exact = _squares(parts[open_], entries[at])
        tried += len(open_)
        better = (best[open_] < 0) | (exact < least[open_]) | ((exact == least[open_]) & (at < best[open_]))
        better = better.astype(bool)
        best[open_[better]], least[open_[better]] = at[better], exact[better]
    return best, least, tried


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dims)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, _SLICE):
            yield batch.slice(a, _SLICE)


def _with_distances(rows: DataFrame, pivots: np.ndarray, dims: int, exact: bool) -> DataFrame:
    """``rows`` (id, label, vector) with ``far``: the pivot distances of all parts, part by part."""
    width = dims // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            whole = to_integers(_vectors(batch.column("vector"), dims), exact)
            far = np.stack([pivot_distances(whole[:, p * width : (p + 1) * width], pivots[p]) for p in range(PARTS)], axis=1)
            each = PARTS * pivots.shape[1]
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(whole) + 1, dtype=np.int32) * each), pa.array(far.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, "far"])

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, vector {kinds['vector']}, far array<float>")


def _means(stored: DataFrame, books: np.ndarray, pivots: np.ndarray, dims: int, exact: bool) -> np.ndarray:
    """The codebooks after one round: each entry the floored mean of its parts; unused ones stay."""
    width, n_entries = dims // PARTS, books.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, n_entries, width), books.dtype)
        counts = np.zeros((PARTS, n_entries), np.int64)
        for batch in _slices(batches):
            whole = to_integers(_vectors(batch.column(0), dims), exact)
            far = _vectors(batch.column(1), PARTS * pivots.shape[1]).reshape(len(whole), PARTS, -1)
            for p in range(PARTS):
                own = whole[:, p * width : (p + 1) * width]
                code, _, _ = assign(own, far[:, p], books[p], pivots[p])
                np.add.at(sums[p], code, own)
                counts[p] += np.bincount(code, minlength=n_entries)
        rows = []
        for part, entry in np.argwhere(counts > 0).tolist():
            for at, value in enumerate([int(counts[part, entry]), *map(int, sums[part, entry])]):
                rows += [(part, entry, at, limb, v) for limb, v in enumerate(_limbs(value))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

    names = ["part", "entry", "at", "limb", "value"]
    partial = stored.select("vector", "far").mapInArrow(run, ", ".join(f"{n} bigint" for n in names))
    found: dict[tuple[int, int, int], int] = {}
    for r in partial.groupBy(names[:4]).agg(F.sum("value").alias("value")).collect():
        found[r.part, r.entry, r.at] = found.get((r.part, r.entry, r.at), 0) + (r.value << (_LIMB * r.limb))
    out = books.copy()
    for (part, entry, at), value in found.items():
        if at:
            out[part, entry, at - 1] = value // found[part, entry, 0]
    return out


def _limbs(value: int) -> list[int]:
    """``value`` as digits of 32 bits, the last one signed, so that Spark can add integers of any size as longs."""
    out = []
    while not -(1 << _LIMB) < value < 1 << _LIMB:
        out.append(value & ((1 << _LIMB) - 1))
        value >>= _LIMB
    return [*out, value]


def _coded(stored: DataFrame, books: np.ndarray, pivots: np.ndarray, dims: int, exact: bool) -> DataFrame:
    """Rows (vec_id, label, code, error). An error beyond a long is NULL."""
    width = dims // PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            whole = to_integers(_vectors(batch.column("vector"), dims), exact)
            far = _vectors(batch.column("far"), PARTS * pivots.shape[1]).reshape(len(whole), PARTS, -1)
            codes, error = np.zeros((len(whole), PARTS), np.uint8), np.zeros(len(whole), books.dtype)
            for p in range(PARTS):
                code, least, _ = assign(whole[:, p * width : (p + 1) * width], far[:, p], books[p], pivots[p])
                codes[:, p] = code
                error = error + least
            errors = [e if e < 2**63 else None for e in error.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes]), pa.array(errors, pa.int64())],
                ["vec_id", "label", "code", "error"],
            )

    kinds = dict(stored.dtypes)
    return stored.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint")


def digest(books: np.ndarray) -> str:
    """Hash of all components by part, entry and position within the part."""
    return hashlib.sha256(",".join(str(int(x)) for x in books.reshape(-1)).encode()).hexdigest()


def compress(embeddings: DataFrame, rounds: int = ROUNDS, n_pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray]:
    """Rows (vec_id, label, code, error) of every storable vector, and the final codebooks (part, entry, position).

    The codebook of each part starts as that part of the ``ENTRIES`` smallest vec_ids (NULL last, equal ids
    by vector), of fewer where there are fewer rows. Repeated rows each count. All vectors must have one
    length, divisible by eight, else ValueError. No rows give no rows and an empty codebook.
    """
    ship(embeddings.sparkSession)
    rows = embeddings.where(storable(F.col("embedding"))).select("vec_id", "label", F.col("embedding").alias("vector"))
    size, most = F.size("vector"), F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))
    seen = rows.agg(F.min(size).alias("low"), F.max(size).alias("high"), F.coalesce(F.max(most), F.lit(0.0)).alias("most")).first()
    if seen["low"] is None:
        return rows.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error")).limit(0), np.zeros((PARTS, 0, 0), np.int64)
    dims = seen["high"]
    if seen["low"] != dims or dims % PARTS:
        raise ValueError(f"vectors of {seen['low']} to {dims} components do not cut into {PARTS} equal parts")
    # Beyond this, squared distances or the sums of a task of up to 2**31 rows could pass 63 bits.
    exact = dims * (2 * (SCALE * seen["most"] + 1)) ** 2 >= 2**62 or SCALE * seen["most"] >= 2**31
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(ENTRIES).collect()
    start = to_integers(np.array([r["vector"] for r in first], float).reshape(len(first), dims), exact)
    books = np.stack([start[:, p * (dims // PARTS) : (p + 1) * (dims // PARTS)] for p in range(PARTS)])
    pivots = books[:, :: max(1, len(first) // n_pivots)][:, :n_pivots].copy()
    stored = parked(_with_distances(rows, pivots, dims, exact), "pivot-distances")
    for _ in range(rounds):
        books = _means(stored, books, pivots, dims, exact)
    return _coded(stored, books, pivots, dims, exact), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``: its errors summed over equal labels, NULLs together; NULL beyond a long.

    The sums are aggregates. They are broadcast where their measured size allows it; more labels than that
    are joined on label and salt, so that a label of very many rows is dealt over many tasks.
    """
    coded = parked(coded, "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    fits = F.count(F.lit(1)) == F.count("error")
    sums = coded.groupBy("label").agg(F.when(fits, total).alias("total")).select(F.col("label").alias("of"), F.expr("try_cast(total AS bigint)").alias("label_error"))
    sums = parked(sums, "label-errors")
    same = F.col("label").eqNullSafe(F.col("of"))
    small = broadcast_if_small(sums)
    if small is not sums:
        return coded.join(small, same).drop("of")
    dealt = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(_SALTS)))
    spread = sums.withColumn("_dealt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_SALTS - 1).cast("bigint"))))
    return dealt.join(spread, same & (F.col("_salt") == F.col("_dealt"))).drop("of", "_salt", "_dealt")
