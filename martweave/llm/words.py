"""Words of whole texts as arrays of hashes, many texts at a time, for use inside tasks.

A batch of texts is one byte buffer with document offsets. Words never cross documents. Word and
gram hashes are 64-bit polynomials, the same in every task and run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path
from tempfile import mkdtemp
from zipfile import ZipFile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martweave.functions.scalars import quoted

BATCH_BYTES = 1_000_000
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_shipped: set[str] = set()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Each value spread over 64 bits; another ``salt`` gives an independent spread."""
    return _mix(x.astype(np.uint64, copy=False) + np.uint64((_BASE * (2 * salt + 1)) % 2**64))


_BYTE = mixed(np.arange(256, dtype=np.uint64), 7) | np.uint64(1)
_LOWER_BYTE = _BYTE.copy()
_LOWER_BYTE[65:91] = _BYTE[97:123]

#: Bytes of ASCII letters, digits and everything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
#: Bytes other than blanks and the controls from tab to carriage return.
SPACED = np.ones(256, bool)
SPACED[[32, *range(9, 14)]] = False

_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1, modulo 2**64. What a usual batch needs is kept, more is made for a long text alone."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, BATCH_BYTES + 2), base, np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= BATCH_BYTES + 2:
            _powers[base] = known
    return known[:n]


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial of each range of ``values``, whatever its position."""
    return _between(*_sums(values, base), starts, ends)


def _sums(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(base, len(values)), out=total[1:])
    return total, _power(pow(base, -1, 2**64), len(values) + 1)


def _between(total: np.ndarray, back: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _mix((total[ends] - total[starts]) * back[starts])


@dataclass
class Words:
    """Words of consecutive documents. ``first[d]`` is the first word of document d, ``first[-1]`` their number."""

    data: bytes
    doc_bytes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def room(self) -> np.ndarray:
        """For each word, how many words of its document start there or later."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self.hashes))

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each place; only places with ``room() >= k`` mean anything."""
        return spans_hash(self.hashes, np.arange(len(self.hashes)), k)

    def text(self, a: int, b: int) -> bytes:
        """Bytes from word a up to word b, as they stand in the text."""
        return self.data[self.starts[a] : self.ends[b - 1]] if b > a else b""


def spans_hash(hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """Hash of ``lengths`` words from each start; ranges past the end are cut off."""
    return _ranges(hashes, starts, np.minimum(starts + lengths, len(hashes)), _STEP)


def split_words(texts: pa.Array, alphabet: np.ndarray, lower: bool) -> Words:
    """Words are runs of bytes in ``alphabet``. NULL is an empty text. ``lower`` ignores the case of A-Z."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = (texts.buffers()[2] or pa.py_buffer(b"")).to_pybytes()[offsets[0] : offsets[-1]] if len(texts) else b""
    offsets = offsets - offsets[0]
    raw = np.frombuffer(data, np.uint8)
    inside = alphabet[raw]
    before, after = np.zeros(len(raw), bool), np.zeros(len(raw), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(raw)]] = False
    after[cuts[cuts > 0] - 1] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    hashes = _ranges((_LOWER_BYTE if lower else _BYTE)[raw], starts, ends, _BASE)
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets), hashes)


def beginnings(words: Words, lengths: Sequence[int], lower: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length, the words of so many letters or more and the hash of their first letters. ``lower`` as in ``split_words``."""
    raw = np.frombuffer(words.data, np.uint8)
    # A letter of UTF-8 begins at each byte that does not continue one; the end of the data follows the last.
    begins = np.append((raw & 0xC0) != 0x80, True)
    letters, before = np.flatnonzero(begins), np.cumsum(begins) - begins
    first = before[words.starts]
    count = before[words.ends] - first
    sums = _sums((_LOWER_BYTE if lower else _BYTE)[raw], _BASE)
    for k in lengths:
        at = np.flatnonzero(count >= k)
        yield at, mixed(_between(*sums, words.starts[at], letters[first[at] + k]), k)


def word_hash(word: str) -> int:
    """Hash of one word, as ``split_words`` gives it."""
    return int(split_words(pa.array([word]), np.ones(256, bool), False).hashes[0])


def pieces(batches: Iterator[pa.RecordBatch], column: str | int = "text", limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text, so that arrays stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for a, b in zip(edges, edges[1:], strict=False):
            yield batch.slice(a, b - a)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.astype(np.uint64, copy=False).view(np.int64)


def ship(spark: SparkSession) -> None:
    """Give the package to the executors, once per application; it need not be installed there.

    Also bounds the bytes of an Arrow batch, as texts may be long: a batch stands in the executor, whose buffers
    double as they grow, and in its worker. Workers read it in smaller pieces anyway.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    target = f"{mkdtemp(prefix='ship-')}/{package.name}.zip"
    with ZipFile(target, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added where ``docs`` has such a column (the case of letters aside)."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def map_texts(
    docs: DataFrame,
    compute: Callable[[pa.Array], list[pa.Array]],
    added: dict[str, T.DataType],
    keep: Sequence[str] | None = None,
    text: str = "text",
) -> DataFrame:
    """Columns ``keep`` (default: all) of ``docs`` and the columns that ``compute`` makes from slices of the texts.

    A column of ``docs`` named like an added one gives way to it.
    """
    ship(docs.sparkSession)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    at = kept.index(text) if text in kept else len(kept)
    picked = docs.select(*map(quoted, kept if text in kept else [*kept, text]))
    schema = T.StructType([*picked.schema.fields[: len(kept)], *(T.StructField(n, t) for n, t in added.items())])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, at):
            own = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*own, *compute(batch.column(at))], names)

    return picked.mapInArrow(run, schema)
