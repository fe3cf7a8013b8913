"""Packing along a space-filling curve.

A document's tokens are hashed vectors; their mean is projected to few dimensions and becomes a
Hilbert key. Documents are range-sorted by key, so neighbours on the curve, which use like words,
share sequences. Within a range, tokens fill one sequence after another without a gap; what is left
at its end is cut into sequences of powers of two, so that nothing needs padding.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martweave.llm.words import pieces, ship
from martweave.session import parked

SEQUENCE_TOKENS = 2048
END_ID = 1
_DIMS, _BITS = 4, 10
_CACHED_WORDS = 800_000
_LINE_WORDS, _LINES = 500, 40
_WORD_END = "</w>"
#: Words of Latin letters are one piece each; others may be several, or none.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+").fullmatch
#: Marks that end a word after a letter are token pieces of their own, so words are known without them. Marks
#: that special tokens or contractions are made of stay where they are.
_MARKS = re.compile(rb"(?:(?<=[a-z])|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf]))[!#$%&*+,./:;=?@^_~-]+(?=[ \n\t\r\x0b\x0c]|$)")
_encoders: dict[str, _Encoder] = {}


class _Encoder:
    """Token ids of texts, word by word; a worker keeps the words it has met, up to a bound.

    The tokenizer never joins across white space, so a text's ids are those of its words in order.
    It ignores case, except in special tokens, which it looks for in the text as it stands: words
    that hold one, in whatever case, are kept as they are written.
    """

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        narrow = self.tokenizer.get_vocab_size() <= 1 << 16
        self.dtype = np.dtype("<u2" if narrow else "<u4")
        self.known: dict[bytes, bytes] = {}
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = tuple({t.content.encode().lower() for t in added if not t.normalized})
        self.marks = frozenset(s[:1] for s in self.special)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True

    def _holds_special(self, low: bytes) -> bool:
        # One byte is found faster than a word, and most texts lack it.
        return any(m in low for m in self.marks) and any(s in low for s in self.special)

    def _words(self, text: bytes) -> list[bytes]:
        low = text.lower()
        words = _MARKS.sub(rb" \g<0>", low).split()
        if low == text or not self._holds_special(low):
            return words
        # Lower case leaves lengths as they are, so the text is cut where its lower case is.
        cuts = [0, *(m.start() for m in _MARKS.finditer(low)), len(text)]
        written = b" ".join(text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)).split()
        return [own if self._holds_special(word) else word for word, own in zip(words, written, strict=True)]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        words = list(map(self._words, texts))
        new = list(set().union(*words).difference(self.known)) if words else []
        if len(self.known) + len(new) > _CACHED_WORDS:
            self.known = {}
            new = list(set().union(*words))
        # Apart, so that lines of letters alone take the short way.
        self._learn([w for w in new if _LETTERS(w)])
        self._learn([w for w in new if not _LETTERS(w)])
        return [b"".join(map(self.known.__getitem__, own)) for own in words]

    def _learn(self, new: list[bytes]) -> None:
        """Ids of unknown words. They go to the tokenizer many in a line, as a call for each costs far more than its ids.

        Where the vocabulary marks the ends of words and a line of Latin letters has as many of them as words, these part the ids; else the places do at which ids begin.
        """
        size = self.dtype.itemsize
        for a in range(0, len(new), _LINE_WORDS * _LINES):
            lines = [new[b : b + _LINE_WORDS] for b in range(a, min(a + _LINE_WORDS * _LINES, len(new)), _LINE_WORDS)]
            texts = [b" ".join(line).decode() for line in lines]
            for line, text, e in zip(lines, texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
                ids = np.array(e.ids, np.int64)
                ends = np.flatnonzero(self.ends_word[ids]) + 1
                plain = len(ends) == len(line) and (not len(ids) or ends[-1] == len(ids)) and all(map(_LETTERS, line))
                if not plain:
                    e = self.tokenizer.encode(text, add_special_tokens=False)
                    ids = np.array(e.ids, np.int64)
                    begins = np.cumsum([len(w.decode()) + 1 for w in line])
                    ends = np.searchsorted(np.fromiter((o[0] for o in e.offsets), np.int64, len(ids)), begins)
                raw, edges = ids.astype(self.dtype).tobytes(), [0, *(ends * size).tolist()]
                self.known.update((w, raw[x:y]) for w, x, y in zip(line, edges, edges[1:], strict=False))


def _encoder(spec: str) -> _Encoder:
    name = hashlib.sha256(spec.encode()).hexdigest()
    if name not in _encoders:
        _encoders[name] = _Encoder(spec)
    return _encoders[name]


def hilbert_key(points: np.ndarray, bits: int = _BITS) -> np.ndarray:
    """Place of each point (rows of whole numbers below 2**bits) along the Hilbert curve."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            turned = (x[i] >> level) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(turned, x[0] ^ low, x[0]) ^ swap
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[n - 1] >> level) & 1 == 1, flip ^ ((1 << level) - 1), flip)
    x ^= flip
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def curve_keys(ids: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Hilbert key of each document's mean token vector. ``ends`` are where documents end in ``ids``."""
    if not len(ends):
        return np.zeros(0, np.int64)
    # Every document has its end id, so none is empty.
    mean = np.add.reduceat(table[ids], np.append(0, ends[:-1]), axis=0, dtype=np.float64) / np.diff(ends, prepend=0)[:, None]
    return hilbert_key(np.minimum((np.tanh(4 * mean) + 1) / 2 * (1 << _BITS), (1 << _BITS) - 1))


def tokenize(docs: DataFrame, tokenizer_json: str, end_id: int = END_ID) -> DataFrame:
    """Rows (doc_id, key, ids): whole documents as little-endian ids, ``end_id`` last. NULL is an empty text."""
    ship(docs.sparkSession)
    spec = docs.sparkSession.sparkContext.broadcast(tokenizer_json)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Tasks run beside each other already; threads of the tokenizer would each keep memory of their own.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        encoder = _encoder(spec.value)
        end = np.array([end_id], encoder.dtype).tobytes()
        table = np.random.default_rng(11).standard_normal((max(encoder.tokenizer.get_vocab_size(), end_id + 1), _DIMS), np.float32)
        for batch in pieces(batches, 1):
            texts = batch.column(1).fill_null("").cast(pa.binary()).to_pylist()
            coded = [own + end for own in encoder.encode(texts)]
            flat = np.frombuffer(b"".join(coded), encoder.dtype)
            ends = np.cumsum([len(c) // encoder.dtype.itemsize for c in coded])
            keys = curve_keys(flat, ends, table)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.int64()), pa.array(coded, pa.binary())], ["doc_id", "key", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, key bigint, ids binary")


def _powers_of_two(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class _Packer:
    """Fills the sequences of one range. The open sequence waits, as its end may still be cut."""

    def __init__(self, sequence_tokens: int, first_id: int, with_ids: bool) -> None:
        self.size, self.next_id, self.with_ids = sequence_tokens, first_id, with_ids
        self.open: list[tuple] = []
        self.fill = 0
        self.done: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        start, total = 0, len(ids)
        while start < total:
            length = min(total - start, self.size - self.fill)
            self.open.append((doc_id, start, ids[start : start + length], total))
            self.fill += length
            start += length
            if self.fill == self.size:
                self._close(self.size)

    def _close(self, size: int) -> None:
        """Emit the first ``size`` tokens of the open pieces as one sequence; the rest stays open."""
        offset, rest = 0, []
        for doc_id, start, ids, total in self.open:
            own, left = ids[: size - offset], ids[size - offset :]
            if len(own):
                wide = own.astype("<u4").tobytes()
                row = (doc_id, start, len(own), zlib.crc32(wide), total, self.next_id, offset)
                self.done.append((*row, wide) if self.with_ids else row)
                offset += len(own)
            if len(left):
                rest.append((doc_id, start + len(own), left, total))
        self.open, self.fill = rest, self.fill - size
        self.next_id += 1

    def finish(self) -> None:
        for size in _powers_of_two(self.fill):
            self._close(size)


def pack(docs: DataFrame, tokenizer_json: str, sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, ids).

    Each token lies in exactly one piece; pieces of a sequence lie one after another from 0. All
    sequences are full or a power of two long, so there is no padding. NULL and empty documents
    are their end id alone. Repeated rows and NULL ids are packed like any other; equal rows may
    change places. A range of the curve with very many equal keys is split by doc_id.
    """
    tokens = parked(tokenize(docs, tokenizer_json, end_id), "tokens")
    order = [F.asc_nulls_first("key"), F.asc_nulls_first("doc_id"), F.asc("ids")]
    ranged = tokens.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    kind = tokens.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(sequence_tokens, TaskContext.get().partitionId() << 40, with_ids)

        def emit() -> pa.RecordBatch:
            columns = list(zip(*packer.done, strict=True))
            packer.done = []
            types = [id_type, *[pa.int64()] * 6, *[pa.binary()] * with_ids]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        dtype = wide
        id_type = pa.int64()
        for batch in batches:
            id_type = batch.column(0).type
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                packer.add(doc_id, np.frombuffer(ids.as_buffer(), dtype))
                if len(packer.done) >= 20_000:
                    yield emit()
        packer.finish()
        if packer.done:
            yield emit()

    wide = _encoder(tokenizer_json).dtype.str
    fields = f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return ranged.mapInArrow(run, fields + ", ids binary" * with_ids)
