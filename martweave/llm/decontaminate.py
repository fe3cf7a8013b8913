"""Benchmark decontamination by winnowing.

A text's grams of five words are hashed and the smallest of every six neighbours is kept, so two
texts that share ten words in a row keep a common gram, whatever stands around it. Kept grams of
documents and benchmark meet in a join; each meeting is extended over the words on both sides, and a
run of ten equal words or more is a hit. A benchmark item of fewer words is one window of its own
length, looked up at every place of a document.

A Bloom filter of fixed size over the benchmark's grams spares most of the shuffle: what it lets
through by mistake drops out in the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.functions.scalars import quoted
from martweave.llm.words import ALNUM, Words, map_texts, mixed, pieces, ship, signed, spans_hash, split_words, unused
from martweave.session import parked

WINDOW, GRAM = 10, 5
_REACH = WINDOW - GRAM
_BLOOM_BITS = 23
_HIT = "array<struct<hash:bigint,len:int,pos:bigint,around:array<bigint>>>"


def content_key(text: Column) -> list[Column]:
    """Two hashes that name a text by its content; NULL is an empty text."""
    whole = F.coalesce(text, F.lit(""))
    return [F.xxhash64(whole).alias("key1"), F.crc32(whole.cast("binary")).alias("key2")]


def _winnow(words: Words) -> np.ndarray:
    """Places of the grams kept: in every window of ten words the smallest gram, the first of equal ones."""
    grams, n = words.grams(GRAM), len(words.hashes)
    at = np.flatnonzero(words.room() >= WINDOW)
    best, shift = grams[at], np.zeros(len(at), np.int64)
    for j in range(1, _REACH + 1):
        other = grams[at + j]
        smaller = other < best
        best[smaller] = other[smaller]
        shift[smaller] = j
    kept = np.zeros(n, bool)
    kept[at + shift] = True
    return np.flatnonzero(kept)


def _around(words: Words, at: np.ndarray, pad: int) -> np.ndarray:
    """Hashes of the words that a window holding the gram can reach; ``pad`` beyond the text."""
    doc = np.searchsorted(words.first, at, side="right") - 1
    place = at[:, None] + np.arange(-_REACH, WINDOW)
    inside = (place >= words.first[doc][:, None]) & (place < words.first[doc + 1][:, None])
    return np.where(inside, words.hashes[np.clip(place, 0, max(len(words.hashes) - 1, 0))], np.uint64(pad))


def _short(words: Words, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of ``length`` words from each place."""
    return mixed(spans_hash(words.hashes, at, length), length), spans_hash(mixed(words.hashes, 1), at, length)


def _bloom_slots(hashes: np.ndarray) -> list[np.ndarray]:
    return [(mixed(hashes, salt) >> np.uint64(64 - _BLOOM_BITS)).astype(np.int64) for salt in (21, 22)]


def _hits(doc: np.ndarray, n_docs: int, parts: list[tuple]) -> pa.Array:
    """List per document of (hash, len, pos, around) from columns of equal length."""
    hashes, lens, pos, sizes, flat = (np.concatenate(c) if c else np.zeros(0) for c in zip(*parts, strict=True))
    order = np.argsort(doc, kind="stable")
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    around = pa.ListArray.from_arrays(pa.array(offsets), pa.array(signed(flat), pa.int64()))
    rows = pa.StructArray.from_arrays(
        [pa.array(signed(hashes), pa.int64()), pa.array(lens, pa.int32()), pa.array(pos, pa.int64()), around], ["hash", "len", "pos", "around"]
    ).take(pa.array(order))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(doc[order], np.arange(n_docs + 1)).astype(np.int32)), rows)


def _part(hashes: np.ndarray, length: int, pos: np.ndarray, around: np.ndarray) -> tuple:
    n = len(hashes)
    return hashes, np.full(n, length, np.int32), pos, np.full(n, around.shape[1], np.int64), around.reshape(-1)


def benchmark_windows(benchmark: DataFrame) -> DataFrame:
    """Rows (item_id, hash, len, pos, around): kept grams of items of ten words or more, whole shorter items."""
    ship(benchmark.sparkSession)

    def run(texts: pa.Array) -> list[pa.Array]:
        words = split_words(texts, ALNUM, True)
        at = _winnow(words)
        parts = [_part(words.grams(GRAM)[at], WINDOW, at, _around(words, at, 1))]
        for length in range(1, WINDOW):
            short = words.first[:-1][words.counts == length]
            first, second = _short(words, short, length)
            parts.append(_part(first, length, short, second[:, None]))
        doc = np.searchsorted(words.first, np.concatenate([p[2] for p in parts]), side="right") - 1
        return [_hits(doc, len(texts), parts)]

    kind = T.StructType.fromDDL(f"v {_HIT}")[0].dataType
    return map_texts(benchmark.select("item_id", "text"), run, {"windows": kind}, ["item_id"]).select("item_id", F.inline("windows"))


def _bloom(windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The filter, built in Spark and of at most 2**23 bits, and the short lengths that occur."""
    hashes = windows.select("hash", "len").distinct()

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(_bloom_slots(batch.column("hash").to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], ["word", "bits"])

    found = hashes.mapInArrow(slots, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (_BLOOM_BITS - 6), np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    lengths = [r["len"] for r in hashes.select("len").distinct().collect()]
    return words, sorted(n for n in lengths if n < WINDOW)


def document_hits(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id``, content keys, n_words and the places of each document whose grams pass the filter."""
    spark = docs.sparkSession
    bits, lengths = _bloom(windows)
    shared = spark.sparkContext.broadcast(bits)

    def passes(hashes: np.ndarray) -> np.ndarray:
        ok = np.ones(len(hashes), bool)
        for at in _bloom_slots(hashes):
            ok &= (shared.value[at >> 6] >> (at & 63)) & 1 == 1
        return ok

    def run(texts: pa.Array) -> list[pa.Array]:
        words = split_words(texts, ALNUM, True)
        at = _winnow(words)
        grams = words.grams(GRAM)[at]
        ok = passes(grams)
        at = at[ok]
        parts = [_part(grams[ok], WINDOW, at, _around(words, at, 0))]
        room = words.room()
        for length in lengths:
            place = np.flatnonzero(room >= length)
            first, second = _short(words, place, length)
            ok = passes(first)
            parts.append(_part(first[ok], length, place[ok], second[ok][:, None]))
        place = np.concatenate([p[2] for p in parts])
        doc = np.searchsorted(words.first, place, side="right") - 1
        begin = words.first[doc]
        split = np.cumsum([0, *(len(p[2]) for p in parts)])
        parts = [(p[0], p[1], p[2] - begin[a:b], p[3], p[4]) for p, a, b in zip(parts, split, split[1:], strict=False)]
        return [pa.array(words.counts, pa.int64()), _hits(doc, len(texts), parts)]

    added = {"n_words": T.LongType(), "hits": T.StructType.fromDDL(f"v {_HIT}")[0].dataType}
    kept = docs.select("doc_id", "text", *content_key(F.col("text")))
    return map_texts(kept, run, added, ["doc_id", "key1", "key2"])


def _by_window(rows: DataFrame, around: str) -> DataFrame:
    """``rows`` once for each whole window that holds their gram, with its hash; short items are whole as they are."""
    windows = [F.xxhash64(F.slice(around, k, WINDOW)) for k in range(1, _REACH + 2)]
    short = F.array(F.lit(0).cast("bigint"))
    return rows.withColumn("window", F.explode(F.when(F.col("len") == WINDOW, F.array(*windows)).otherwise(short)))


def _extended(pairs: DataFrame) -> DataFrame:
    """Rows (uid, window_id, start, end) of the meetings that extend to a whole window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, pos = batch.column("len").to_numpy(), batch.column("pos").to_numpy()
            start, end = pos.copy(), pos + length
            ok = np.zeros(len(pos), bool)
            mine, other = batch.column("around"), batch.column("item_around")
            short = np.flatnonzero(length < WINDOW)
            if len(short):
                ok[short] = _flat(mine, short) == _flat(other, short)
            long = np.flatnonzero(length == WINDOW)
            if len(long):
                same = (_flat(mine, long) == _flat(other, long)).reshape(len(long), -1)
                left = np.cumprod(same[:, _REACH - 1 :: -1], axis=1).sum(axis=1)
                right = np.cumprod(same[:, _REACH + GRAM :], axis=1).sum(axis=1)
                middle = same[:, _REACH : _REACH + GRAM].all(axis=1)
                ok[long] = middle & (left + GRAM + right >= WINDOW)
                start[long], end[long] = pos[long] - left, pos[long] + GRAM + right
            keep = pa.array(ok)
            columns = [batch.column("uid"), batch.column("window_id"), pa.array(start), pa.array(end)]
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in columns], ["uid", "window_id", "start", "end"])

    return pairs.mapInArrow(run, "uid bigint, window_id bigint, start bigint, end bigint")


def _flat(lists: pa.Array, rows: np.ndarray) -> np.ndarray:
    return lists.take(pa.array(rows)).flatten().to_numpy()


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, key1, key2, n_words, n_hit, item_ids (strings, sorted), spans.

    A word is hit if it lies in an occurrence of a benchmark window; ``spans`` are the places found
    (start, end). NULL and empty texts have no words, and items without words no window. Items
    without an id mark words but are not listed. Repeated rows of either table are kept and count
    as they are; an item id counts once.
    """
    windows = parked(benchmark_windows(benchmark), "benchmark-windows")
    found = parked(document_hits(docs, windows).withColumn("uid", F.monotonically_increasing_id()), "document-hits")

    with_id = windows.withColumn("window_id", F.xxhash64("hash", "len", "around"))
    distinct = with_id.select("window_id", "hash", "len", F.col("around").alias("item_around")).dropDuplicates(["window_id"])
    hits = found.select("uid", F.inline("hits"))
    # Matched by a whole window around the gram, so that a gram common to many items meets those alone that go on alike.
    met = _by_window(hits, "around").join(_by_window(distinct, "item_around"), ["hash", "len", "window"])
    runs = parked(_extended(met.drop("window").dropDuplicates(["uid", "pos", "window_id"])), "document-runs")

    covered = F.array_distinct(F.flatten(F.collect_set(F.sequence(F.col("start"), F.col("end") - 1))))
    words = runs.groupBy("uid").agg(F.size(covered).cast("bigint").alias("n_hit"), F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    items = with_id.select("window_id", F.col("item_id").cast("string").alias("item_id")).distinct()
    listed = (
        runs.select("uid", "window_id").distinct().join(items, "window_id").select("uid", "item_id").distinct()
        .groupBy("uid").agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    )
    return (
        found.select("uid", "doc_id", "key1", "key2", "n_words")
        .join(words, "uid", "left")
        .join(listed, "uid", "left")
        .select(
            "doc_id",
            "key1",
            "key2",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
            F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark window, found by their content."""
    bad = decontaminate(docs, benchmark).where("n_hit > 0").select("key1", "key2").distinct()
    one, two, bad_one, bad_two = unused(docs, "key1", "key2", "bad1", "bad2")
    keys = content_key(F.col("text"))
    keyed = docs.select("*", keys[0].alias(one), keys[1].alias(two))
    left = keyed.join(bad.toDF(bad_one, bad_two), (F.col(one) == F.col(bad_one)) & (F.col(two) == F.col(bad_two)), "left_anti")
    return left.select(*map(quoted, docs.columns))
