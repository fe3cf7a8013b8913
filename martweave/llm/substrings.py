"""Repeated passages by a compacted de Bruijn graph of word k-mers.

The edges of the graph are the windows of k words, its nodes what two neighbouring windows share.
Neighbouring windows of a text that have the same smallest gram form a stretch: a path without a
branch, known by that gram and a hash of its words. Stretches are what Spark counts and joins.

1. Equal stretches are counted. A stretch whose smallest gram stands nowhere else cannot repeat.
2. Repeated stretches that follow each other everywhere, without a branch, are marked by joins. The
   marks decide nothing yet: ranges that meet become one in each text, with the same result.
3. Stretches with a common smallest gram but other words share some of their windows at most: the
   ends of repeats. Their windows are counted one by one, read at one source place of each.
4. Stretches and windows go back to the places of their texts. Equal hashes count as equal words:
   nothing compares the words of two places, so a collision of 64-bit hashes would not be noticed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.functions.scalars import quoted
from martweave.llm.decontaminate import content_key
from martweave.llm.words import SPACED, Words, pieces, ship, signed, spans_hash, split_words, unused
from martweave.session import parked

WINDOW = 35
_GRAM = 8
_MOST_WORDS = 71
#: Stretches whose ranges a task merges at once.
_LISTED = 50_000


def stretches(words: Words, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Columns (document, first window, windows, smallest gram, hash of the words) of all stretches."""
    gram = min(_GRAM, window)
    span = window - gram + 1
    low, at = words.grams(gram), np.arange(len(words.hashes))
    width = 1
    while width < span:
        # The smallest gram of a window is the smaller one of two overlapping halves; the first of equal ones.
        step = min(width, span - width)
        right, right_at = low[step:], at[step:]
        better = right < low[: len(right)]
        low, at = np.where(better, right, low[: len(right)]), np.where(better, right_at, at[: len(right)])
        width += step
    place = np.flatnonzero(words.room() >= window)
    least = at[place]
    new = np.ones(len(place), bool)
    new[1:] = (least[1:] != least[:-1]) | (np.diff(place) != 1)
    head = np.flatnonzero(new)
    start, count = place[head], np.diff(np.append(head, len(place)))
    doc = np.searchsorted(words.first, start, side="right") - 1
    return doc, start, count, low[start], spans_hash(words.hashes, start, count + window - 1)


def _stretch_rows(docs: DataFrame, window: int, places: bool) -> DataFrame:
    """Rows (gram, path) or, with ``places``, also what follows in the text, the text's key, first word and windows."""
    ship(docs.sparkSession)
    names = ["gram", "path"] + ["next", "key1", "key2", "start", "n"] * places

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words = split_words(batch.column("text"), SPACED, False)
            doc, start, n, gram, path = stretches(words, window)
            columns = [pa.array(signed(gram)), pa.array(signed(path))]
            if places:
                following = np.zeros(len(path), np.uint64)
                joined = (doc[1:] == doc[:-1]) & (start[:-1] + n[:-1] == start[1:])
                following[:-1][joined] = path[1:][joined]
                keys = [batch.column(k).take(pa.array(doc)) for k in ("key1", "key2")]
                begin = (start - words.first[doc]).astype(np.int32)
                columns += [pa.array(signed(following)), *keys, pa.array(begin), pa.array(n.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names)

    picked = docs.select("text", *content_key(F.col("text"))) if places else docs.select("text")
    return picked.mapInArrow(run, "gram bigint, path bigint" + ", next bigint, key1 bigint, key2 bigint, start int, n int" * places)


def _window_rows(sources: DataFrame, window: int) -> DataFrame:
    """Rows (gram, path, at, edge, copies): the single windows of stretches, read from their source texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            words = split_words(batch.column("text"), SPACED, False)
            lists = batch.column("found")
            found = lists.flatten()
            doc = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            gram, path, start, n, copies = (found.field(k).to_numpy() for k in ("gram", "path", "start", "n", "copies"))
            start = words.first[doc] + start
            # The source must hold what was counted: its words are hashed again.
            same = signed(spans_hash(words.hashes, start, n + window - 1)) == path
            if not same.all():
                raise ValueError("a source text has changed since it was counted")
            row = np.repeat(np.arange(len(n)), n)
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            edge = spans_hash(words.hashes, start[row] + at, window)
            columns = [gram[row], path[row], at.astype(np.int32), signed(edge), copies[row]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["gram", "path", "at", "edge", "copies"])

    return sources.select("text", "found").mapInArrow(run, "gram bigint, path bigint, at int, edge bigint, copies bigint")


def compacted(places: DataFrame) -> DataFrame:
    """``places`` of repeated stretches with ``goes_on``: the next stretch follows wherever this one stands, and only it does.

    A link is kept if neither end has another one, so stretches linked by ``goes_on`` are one
    path of the graph without a branch.
    """
    links = places.where("next != 0").select("path", "next").distinct()
    known = places.select(F.col("path").alias("next")).distinct()
    links = links.join(known, "next", "left_semi")
    only_out = links.groupBy("path").agg(F.min("next").alias("next"), F.count(F.lit(1)).alias("out")).where("out = 1").select("path", "next")
    only_in = links.groupBy("next").agg(F.count(F.lit(1)).alias("in")).where("in = 1").select("next")
    chain = only_out.join(only_in, "next", "left_semi").select("path", F.lit(True).alias("goes_on"))
    return places.join(chain, "path", "left").withColumn("goes_on", F.coalesce("goes_on", F.lit(False)) & (F.col("next") != 0))


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (key1, key2, spans): for each text by content, the word ranges covered by repeated windows.

    Ranges (start, end) are ordered, apart and counted in words from 0. A window is repeated if its words also start
    anywhere else in ``docs``, the same text and further copies of it included. Windows of more than 71 words raise ValueError:
    a stretch marks its windows in 64 bits.
    """
    if window > _MOST_WORDS:
        raise ValueError(f"windows have at most {_MOST_WORDS} words")
    # Counted stretches are used twice below. The joins would filter their keys unlike each other; with the
    # filter here both uses have the same plan, and Spark shuffles the stretches once.
    named = _stretch_rows(docs, window, False).where("gram IS NOT NULL AND path IS NOT NULL")
    counted = named.groupBy("gram", "path").agg(F.count(F.lit(1)).alias("copies"))
    shared = counted.groupBy("gram").agg(F.count(F.lit(1)).alias("paths"), F.sum("copies").alias("total")).where("total > 1").select("gram", "paths")
    # Stretches alone with their gram drop out here: most of any corpus.
    candidates = counted.join(shared, "gram").select("gram", "path", "copies", (F.col("paths") > 1).alias("mixed"))
    places = _stretch_rows(docs, window, True).join(candidates, ["gram", "path"]).dropDuplicates(["key1", "key2", "start"])
    places = parked(places, "stretch-places")

    sources = (
        places.where("mixed")
        .groupBy("gram", "path")
        .agg(F.min(F.struct("key1", "key2", "start", "n", "copies")).alias("s"))
        .select("gram", "path", "s.*")
        .groupBy("key1", "key2")
        .agg(F.collect_list(F.struct("gram", "path", "start", "n", "copies")).alias("found"))
    )
    texts = docs.select("text", *content_key(F.col("text"))).groupBy("key1", "key2").agg(F.first("text").alias("text"))
    windows = _window_rows(texts.join(sources, ["key1", "key2"]), window)
    again = windows.groupBy("gram", "edge").agg(F.sum("copies").alias("total")).where("total > 1").select("gram", "edge")
    partial = (
        windows.where("copies = 1")
        .join(again, ["gram", "edge"])
        .groupBy("gram", "path")
        .agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("windows"))
    )

    whole = compacted(places.where("copies > 1")).select(
        "key1", "key2", "start", "n", F.lit(None).cast("bigint").alias("windows"), "goes_on"
    )
    ends = places.where("copies = 1").join(partial, ["gram", "path"]).select("key1", "key2", "start", "n", "windows", F.lit(False).alias("goes_on"))
    by_text = whole.unionByName(ends).groupBy("key1", "key2").agg(F.array_sort(F.collect_list(F.struct("start", "n", "windows", "goes_on"))).alias("found"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _bounded(batch, "found"):
                yield pa.RecordBatch.from_arrays([part.column("key1"), part.column("key2"), _merged(part.column("found"), window)], ["key1", "key2", "spans"])

    return by_text.mapInArrow(merge, "key1 bigint, key2 bigint, spans array<struct<start:int,end:int>>")


def _bounded(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose lists hold about ``_LISTED`` entries; a longer list is a slice of its own."""
    ends = np.cumsum(batch.column(column).value_lengths().to_numpy())
    edges = np.flatnonzero(np.diff(ends // _LISTED)) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def _merged(found: pa.ListArray, window: int) -> pa.ListArray:
    """Word ranges of each text's stretches; ranges that meet become one, whatever ``goes_on`` says.

    Everything stays in arrays: a stretch as a Python object takes some twenty times its size.
    """
    doc = np.repeat(np.arange(len(found)), found.value_lengths().to_numpy())
    rows = found.flatten()
    start, n = (rows.field(k).to_numpy().astype(np.int64) for k in ("start", "n"))
    marks = rows.field("windows")
    whole = marks.is_null().to_numpy(zero_copy_only=False)
    marks = marks.fill_null(0).to_numpy()
    # The single windows of stretches that repeat in part.
    row = np.repeat(np.flatnonzero(~whole), n[~whole])
    at = np.arange(len(row)) - np.repeat(np.cumsum(n[~whole]) - n[~whole], n[~whole])
    marked = marks[row] >> at & 1 == 1
    row, at = row[marked], at[marked]
    doc = np.concatenate([doc[whole], doc[row]])
    first = np.concatenate([start[whole], start[row] + at])
    end = np.concatenate([start[whole] + n[whole], start[row] + at + 1]) + window - 1
    # Places of all texts on one line, each text beyond the one before.
    shift = doc * (end.max(initial=0) + 1)
    order = np.argsort(first + shift, kind="stable")
    doc, first, shift = doc[order], first[order], shift[order]
    reach = np.maximum.accumulate(end[order] + shift)
    head = np.flatnonzero(np.append(True, (first + shift)[1:] > reach[:-1])[: len(first)])
    last = np.append(head[1:], len(first))[: len(head)] - 1
    spans = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (first[head], reach[last] - shift[last])], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[head], np.arange(len(found) + 1)).astype(np.int32)), spans)


def remove_repeats(docs: DataFrame, window: int = WINDOW, keep: Sequence[str] | None = None, with_text: bool = True) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with ``_n_words``, ``_n_removed``, ``_kept_sha256`` and, ``with_text``, ``_kept``.

    Words are runs of anything but ASCII white space. Words covered by a repeated window go, all
    copies alike; ``_kept`` is the text without them, otherwise as it was, and the digest is that of
    the words left, joined by one blank. NULL and empty texts have no words, and no text shorter
    than a window loses any. Repeated rows count as copies of each other.
    """
    ship(docs.sparkSession)
    added = ["_n_words", "_n_removed", "_kept_sha256"] + ["_kept"] * with_text
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added]
    spans = repeated_spans(docs, window)
    keys = content_key(F.col("text"))
    text, one, two, span_one, span_two, found = unused(docs, "text", "key1", "key2", "span1", "span2", "spans")
    left = docs.select(*map(quoted, kept), F.col("text").alias(text), keys[0].alias(one), keys[1].alias(two))
    joined = left.join(spans.toDF(span_one, span_two, found), (F.col(one) == F.col(span_one)) & (F.col(two) == F.col(span_two)), "left")
    joined = joined.select(*map(quoted, [*kept, text, found]))
    fields = [*joined.schema.fields[: len(kept)], T.StructField("_n_words", T.LongType()), T.StructField("_n_removed", T.LongType())]
    fields += [T.StructField("_kept_sha256", T.StringType())] + [T.StructField("_kept", T.StringType())] * with_text
    schema = T.StructType(fields)
    n_kept = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, n_kept):
            texts = batch.column(n_kept).cast(pa.binary()).to_pylist()
            rows = [_cut(t, s, with_text) for t, s in zip(texts, batch.column(n_kept + 1).to_pylist(), strict=True)]
            columns = list(zip(*rows, strict=True))
            types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
            own = [batch.column(i) for i in range(n_kept)]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array(c, t) for c, t in zip(columns, types, strict=False))], schema.names)

    return joined.mapInArrow(run, schema)


def _cut(text: bytes | None, spans: list[dict] | None, with_text: bool) -> tuple:
    words = (text or b"").split()
    if not spans:
        row = (len(words), 0, hashlib.sha256(b" ".join(words)).hexdigest())
        return (*row, None if text is None else text.decode()) if with_text else row
    left, last = [], 0
    for s in spans:
        left += words[last : s["start"]]
        last = s["end"]
    left += words[last:]
    row = (len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest())
    if not with_text:
        return row
    found = split_words(pa.array([text.decode()]), SPACED, False)
    parts, last = [], 0
    for s in spans:
        parts.append(text[last : found.starts[s["start"]]])
        last = found.starts[s["end"]] if s["end"] < len(found.starts) else len(text)
    parts.append(text[last:])
    return (*row, b"".join(parts).decode())
