"""Near-duplicate documents by improved consistent weighted sampling.

A text is a bag of five-word shingles weighted by TF-IDF. Each of its samples (Ioffe's scheme) names
one shingle and a weight level, and two texts agree on a sample as often as their weighted Jaccard
similarity says. Bands of four samples make buckets; what meets in a bucket is verified with the
weighted Jaccard similarity of the whole texts.

A bucket of m texts does not become m * m rows. All its texts are compared with the first. What that
links is one class, and a bucket within one class is settled. In the others, texts of different classes
are compared: pair by pair in small buckets, where distances to the first text bound those between
each other (the Jaccard distance is a metric), and block by block inside tasks in large ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martweave.functions.scalars import quoted
from martweave.llm.decontaminate import content_key
from martweave.llm.words import ALNUM, Words, mixed, pieces, ship, signed, spans_hash, split_words, unused
from martweave.session import parked

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 16, 4
_IDF_BITS = 20
_CHUNK_BITS = 14
_DRAW_BITS = 16
#: Buckets of up to so many texts are compared pair by pair, larger ones in blocks of about so many.
_SMALL, _BLOCK = 12, 384
#: Weight of a block's texts, about three a shingle; long texts make blocks of fewer.
_BLOCK_WEIGHT = 1_000_000.0
_COLUMNS = 2048
#: Shingles in fewer than one text in this many weigh alike, so that copies of a text do not make it light.
_RARE = 8.0


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns (document, shingle, count), ordered by document and shingle. A text of one to four words is one shingle."""
    room = words.room()
    place = np.flatnonzero(room >= SHINGLE)
    short = words.first[:-1][(words.counts > 0) & (words.counts < SHINGLE)]
    place = np.concatenate([place, short])
    hashes = spans_hash(words.hashes, place, np.minimum(room[place], SHINGLE))
    doc = np.searchsorted(words.first, place, side="right") - 1
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    head = np.flatnonzero(new)
    return doc[head], hashes[head], np.diff(np.append(head, len(doc)))


def _idf_bins(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes, 31) >> np.uint64(64 - _IDF_BITS)).astype(np.int64)


def _squeezed(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<i8").tobytes(), 1)


def _spread(counts: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(counts), "<i8")


def idf_table(docs: DataFrame) -> np.ndarray:
    """Bounded inverse document frequency by hashed shingle, over all documents.

    Frequencies are counted in 2**20 hashed bins, each document once a bin. Tasks add up dense
    chunks of bins and Spark sums the chunks, so what
    moves and what the driver gets do not grow with the number of shingles.
    """
    ship(docs.sparkSession)
    size = 1 << _CHUNK_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(1 << _IDF_BITS, np.int64), 0
        for batch in pieces(batches):
            doc, hashes, _ = shingles(split_words(batch.column("text"), ALNUM, True))
            seen = np.unique((doc << _IDF_BITS) | _idf_bins(hashes))
            counts += np.bincount(seen & ((1 << _IDF_BITS) - 1), minlength=1 << _IDF_BITS)
            n += batch.num_rows
        chunks = [_squeezed(c) for c in counts.reshape(-1, size)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *range(len(chunks))], pa.int32()), pa.array([_squeezed(np.array([n])), *chunks], pa.binary())], ["chunk", "counts"]
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                values = _spread(counts)
                sums[chunk] = sums[chunk] + values if chunk in sums else values
        if sums:
            keys = sorted(sums)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([_squeezed(sums[k]) for k in keys], pa.binary())], ["chunk", "counts"])

    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partial = docs.select("text").mapInArrow(run, "chunk int, counts binary")
    rows = partial.repartition(n_parts, "chunk").mapInArrow(add, "chunk int, counts binary").toArrow().to_pylist()
    total, counts = 0, np.zeros(1 << _IDF_BITS)
    for row in rows:
        values = _spread(row["counts"])
        if row["chunk"] < 0:
            total = int(values[0])
        else:
            counts[row["chunk"] * size : (row["chunk"] + 1) * size] = values
    return (1 + np.log(np.minimum((total + 1) / (counts + 1), _RARE))).astype(np.float32)


def _draws(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The random numbers of the sampling: r and log c from Gamma(2, 1), beta uniform."""
    rng = np.random.default_rng(seed)
    n = 1 << _DRAW_BITS
    return rng.gamma(2, 1, n).astype(np.float32), np.log(rng.gamma(2, 1, n)).astype(np.float32), rng.random(n, np.float32)


def sample(doc: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n_docs: int, samples: int) -> np.ndarray:
    """Consistent weighted samples, one row per document with shingles, in their order.

    A sample draws r, c and beta for each shingle, by a hash of it and of the sample's number; the
    shingle with the smallest log a = log c - r (t - beta + 1), t = floor(log w / r + beta), is taken with its t.
    """
    r, log_c, beta = _draws(17)
    log_w = np.log(weights).astype(np.float32)
    head = np.flatnonzero(np.diff(doc, prepend=-1))
    row = np.repeat(np.arange(len(head)), np.diff(np.append(head, len(doc))))
    out = np.zeros((len(head), samples), np.uint64)
    for k in range(samples):
        odd = np.uint64(int(mixed(np.array([k], np.uint64), 41)[0]) | 1)
        draw = ((hashes * odd) >> np.uint64(64 - _DRAW_BITS)).astype(np.int32)
        rk, bk = r[draw], beta[draw]
        t = np.floor(log_w / rk + bk)
        log_a = log_c[draw] - rk * (t - bk + 1)
        least = np.minimum.reduceat(log_a, head) if len(head) else log_a
        at = np.flatnonzero(log_a == least[row])
        at = at[np.flatnonzero(np.diff(row[at], prepend=-1))]
        out[:, k] = mixed(hashes[at] ^ mixed(t[at].astype(np.int64).view(np.uint64), 43), k)
    return out


def signatures(docs: DataFrame, idf: Broadcast) -> DataFrame:
    """Rows (doc_id, key1, key2, weight, bands): total weight and band hashes; texts without words have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 3):
            words = split_words(batch.column(3), ALNUM, True)
            doc, hashes, counts = shingles(words)
            weights = counts * idf.value[_idf_bins(hashes)]
            found = sample(doc, hashes, weights, batch.num_rows, BANDS * ROWS)
            bands = np.zeros((len(found), BANDS), np.uint64)
            for j in range(ROWS):
                bands = mixed(bands ^ found[:, j::ROWS], 50 + j)
            bands = mixed(bands + np.arange(BANDS, dtype=np.uint64), 60)
            lists = np.zeros(batch.num_rows + 1, np.int32)
            lists[1:][np.unique(doc)] = BANDS
            column = pa.ListArray.from_arrays(pa.array(np.cumsum(lists, dtype=np.int32)), pa.array(signed(bands.reshape(-1)), pa.int64()))
            total = np.bincount(doc, weights, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array(total, pa.float64()), column], ["doc_id", "key1", "key2", "weight", "bands"]
            )

    kind = dict(docs.dtypes)["doc_id"]
    picked = docs.select("doc_id", *content_key(F.col("text")), "text")
    return picked.mapInArrow(run, f"doc_id {kind}, key1 bigint, key2 bigint, weight double, bands array<bigint>")


def weighted_jaccard(first: pa.Array, second: pa.Array, idf: np.ndarray) -> np.ndarray:
    """Similarity of each pair of texts."""
    parts = []
    for texts in (first, second):
        doc, hashes, counts = shingles(split_words(texts, ALNUM, True))
        parts.append((doc, hashes, counts * idf[_idf_bins(hashes)].astype(float)))
    doc, hashes, weights = (np.concatenate(c) for c in zip(*parts, strict=True))
    total = np.bincount(doc, weights, minlength=len(first))
    order = np.lexsort((hashes, doc))
    doc, hashes, weights = doc[order], hashes[order], weights[order]
    both = np.flatnonzero((doc[1:] == doc[:-1]) & (hashes[1:] == hashes[:-1]))
    common = np.bincount(doc[both], np.minimum(weights[both], weights[both + 1]), minlength=len(first))
    return np.divide(common, total - common, out=np.zeros(len(first)), where=total > common)


def _verified(pairs: DataFrame, texts: DataFrame, idf: Broadcast) -> DataFrame:
    """``pairs`` (a, b) with ``sim``. The second join carries the texts of ``b``; ``a`` is often one text for many pairs."""
    with_b = pairs.join(texts.select(F.col("vid").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(texts.select(F.col("vid").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "text_b"):
            sim = weighted_jaccard(batch.column("text_a"), batch.column("text_b"), idf.value)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sim)], ["a", "b", "sim"])

    return with_both.mapInArrow(run, "a bigint, b bigint, sim double")


def components(edges: DataFrame) -> DataFrame:
    """Rows (vid, label): the smallest id each vertex is connected with, by contraction.

    In every round each vertex goes over to the first among itself and its neighbours, in an order that a hash of
    the round gives, and only the edges between what is left go on, each once. A round leaves at most three quarters of
    the vertices on average, so that a group of many links costs no more than a few times its links in all rounds
    together. Every round is written to the shared folder.
    """
    links = parked(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    names = parked(links.select(F.col("a").alias("vid")).union(links.select("b")).distinct().withColumn("name", F.col("vid")), "names")
    links, step = links.where("a != b"), 0
    while not links.isEmpty():
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = {c: F.xxhash64(c, F.lit(step)) for c in "ab"}
        firsts = ends.groupBy("a").agg(F.min(rank["b"]).alias("rank"), F.min_by("b", rank["b"]).alias("b"))
        firsts = parked(firsts.select(F.col("a").alias("was"), F.when(rank["a"] < F.col("rank"), F.col("a")).otherwise(F.col("b")).alias("now")), "firsts")
        moved = names.join(firsts, names["name"] == firsts["was"], "left")
        names = parked(moved.select("vid", F.coalesce("now", "name").alias("name")), "names")
        for end in "ab":
            links = links.join(firsts.withColumnRenamed("was", end), end).withColumn(end, F.col("now")).drop("now")
        links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        links, step = parked(links.distinct(), "links"), step + 1
    labels = names.groupBy("name").agg(F.min("vid").alias("label"))
    return parked(names.join(labels, "name").select("vid", "label"), "labels")


def _alike(texts: pa.Array, n_first: int, idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of the first ``n_first`` texts (rows) with the others, or with themselves where there are no others (columns)."""
    parts, first = [], 0
    for piece in pieces(iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
        doc, hashes, counts = shingles(split_words(piece.column("text"), ALNUM, True))
        parts.append((doc + first, hashes, counts))
        first += piece.num_rows
    doc, hashes, counts = (np.concatenate(c) for c in zip(*parts, strict=True))
    del parts
    weights = idf[_idf_bins(hashes)].astype(float)
    total = np.bincount(doc, weights * counts, minlength=len(texts))
    # A shingle of one text alone adds nothing to any pair.
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    often = np.zeros(len(order), bool)
    often[1:] = same
    often[:-1] |= same
    keep = np.sort(order[often])
    doc, hashes, counts, weights = doc[keep], hashes[keep], counts[keep], weights[keep]
    # The n-th occurrence of a shingle is a shingle of its own, so that common weight is a product of matrices.
    row = np.repeat(np.arange(len(doc)), counts)
    nth = (np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
    names, column = np.unique(mixed(hashes[row] ^ mixed(nth, 71)), return_inverse=True)
    doc, weights = doc[row], np.sqrt(weights[row])
    order = np.argsort(column, kind="stable")
    doc, weights, column = doc[order], weights[order], column[order]
    others = slice(n_first, None) if n_first < len(texts) else slice(None)
    common = np.zeros((n_first, len(total[others])))
    for a in range(0, len(names), _COLUMNS):
        own = slice(*np.searchsorted(column, [a, a + _COLUMNS]))
        dense = np.zeros((len(texts), _COLUMNS))
        dense[doc[own], column[own] - a] = weights[own]
        common += dense[:n_first] @ dense[others].T
    either = total[:n_first, None] + total[None, others] - common
    return np.divide(common, either, out=np.zeros_like(common), where=either > 0)


def _forest(links: np.ndarray) -> list[int]:
    """As few of the links (rows of two) as connect what all of them connect, by their places."""
    parent: dict[int, int] = {}

    def root(i: int) -> int:
        while parent.setdefault(i, i) != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for i, (a, b) in enumerate(links.tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(i)
    return kept


def _linked_in_blocks(members: DataFrame, texts: DataFrame, idf: Broadcast, similarity: float) -> DataFrame:
    """Rows (a, b, sim) that connect the alike members of large buckets, as far as their components differ.

    A bucket is dealt into blocks, and each pair of blocks is compared by one step of a task, which
    holds these two alone and emits no more links than texts. Pairs never become rows.
    """
    n_blocks = F.ceil(F.greatest(F.col("size") / _BLOCK, F.col("mass") / _BLOCK_WEIGHT)).cast("int")
    dealt = members.withColumn("block", F.pmod(F.xxhash64("vid"), n_blocks).cast("int"))
    meets = dealt.select("bucket", "vid", "comp", "block", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("other"))
    meets = meets.select("bucket", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "vid", "comp")
    n_parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["bucket", "x", "y"]
    ordered = meets.join(texts, "vid").repartition(n_parts, *keys).sortWithinPartitions(*keys, "block").select(*keys, "block", "vid", "comp", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            marks = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            edges = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if b > a:
                    if key is not None and (marks[a] != key).any():
                        yield from compare(key, held)
                        held = []
                    key = marks[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield from compare(key, held)

    def compare(key: np.ndarray, held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        block, vid, comp = (rows[c].to_numpy() for c in ("block", "vid", "comp"))
        # Rows come by block, so those of the smaller block are the first ones.
        n = int((block == block[0]).sum()) if key[1] != key[2] else len(block)
        if n == len(block) and key[1] != key[2]:
            return
        sim = _alike(rows["text"].combine_chunks(), n, idf.value)
        others = slice(n, None) if n < len(block) else slice(None)
        apart = comp[:n, None] != comp[None, others]
        if n == len(block):
            apart &= vid[:, None] < vid[None]
        at = np.argwhere((sim >= similarity) & apart)
        x, y, far = vid[:n][at[:, 0]], vid[others][at[:, 1]], sim[at[:, 0], at[:, 1]]
        kept = _forest(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1))
        if kept:
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)[kept]), pa.array(np.maximum(x, y)[kept]), pa.array(far[kept])], ["a", "b", "sim"])

    return ordered.mapInArrow(run, "a bigint, b bigint, sim double")


def _links(distinct: DataFrame, docs: DataFrame, idf: Broadcast, similarity: float) -> DataFrame:
    """Rows (a, b, sim), a < b, of texts at least ``similarity`` alike: enough of them to connect all such texts."""
    members = distinct.select("vid", "weight", F.explode("bands").alias("bucket"))
    leaders = members.groupBy("bucket").agg(F.min("vid").alias("leader"), F.count(F.lit(1)).alias("size"), F.sum("weight").alias("mass")).where("size > 1")
    members = parked(members.join(leaders, "bucket"), "buckets")
    star = members.where("vid != leader").select(F.col("leader").alias("a"), F.col("vid").alias("b")).distinct()
    # All members of a bucket stand in its star, so these are all texts that are ever compared.
    needed = members.select("vid").distinct().join(distinct.select("vid", "key1", "key2"), "vid")
    once = docs.select("text", *content_key(F.col("text"))).groupBy("key1", "key2").agg(F.first("text").alias("text"))
    texts = parked(once.join(needed, ["key1", "key2"]).select("vid", "text"), "candidates")
    first = parked(_verified(star, texts, idf), "star-pairs")
    linked = first.where(F.col("sim") >= similarity)
    labels = components(linked)

    # Buckets within one component are settled.
    placed = members.where("size > 2").join(labels, "vid", "left").withColumn("comp", F.coalesce("label", "vid")).drop("label")
    open_ = placed.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low != high").select("bucket")
    placed = parked(placed.join(open_, "bucket"), "open-buckets")

    reach, slack = 1 - similarity, 1e-9
    sims = first.select(F.col("a").alias("leader"), F.col("b").alias("vid"), (1 - F.col("sim")).alias("far"))
    x = placed.where((F.col("size") <= _SMALL) & (F.col("vid") != F.col("leader"))).join(sims, ["leader", "vid"])
    x = x.select("bucket", "vid", "weight", "comp", "far")
    y = x.select("bucket", *(F.col(c).alias(f"{c}2") for c in ("vid", "weight", "comp", "far")))
    close = (
        (F.col("vid") < F.col("vid2"))
        & (F.col("comp") != F.col("comp2"))
        & (F.abs(F.col("far") - F.col("far2")) <= reach + slack)
        & (F.least("weight", "weight2") >= similarity * F.greatest("weight", "weight2") - slack)
    )
    rest = x.join(y, "bucket").where(close).select(F.col("vid").alias("a"), F.col("vid2").alias("b")).distinct()
    rest = rest.join(first.select("a", "b"), ["a", "b"], "left_anti")
    in_small = _verified(rest, texts, idf).where(F.col("sim") >= similarity)
    in_large = _linked_in_blocks(placed.where(F.col("size") > _SMALL), texts, idf, similarity)
    return linked.unionByName(in_small).unionByName(in_large).dropDuplicates(["a", "b"])


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, key1, key2, uid, class_id, class_size, stays.

    A class holds the copies of a text and all texts connected by links of ``similarity`` or more;
    ``class_id`` is its smallest doc_id (NULL if it has none). One document of each class stays: the one with the smallest id,
    NULL last. NULL is an empty text; texts without words are alike only to exact copies.
    """
    spark: SparkSession = docs.sparkSession
    idf = spark.sparkContext.broadcast(idf_table(docs))
    rows = parked(signatures(docs, idf).withColumn("uid", F.monotonically_increasing_id()), "signatures")
    distinct = rows.groupBy("key1", "key2").agg(F.min("uid").alias("vid"), F.first("weight").alias("weight"), F.first("bands").alias("bands"))
    distinct = parked(distinct, "texts")
    links = parked(_links(distinct, docs, idf, similarity), "near-links")
    labels = components(links)

    named = distinct.select("key1", "key2", "vid").join(labels, "vid", "left")
    named = named.select("key1", "key2", F.coalesce("label", "vid").alias("label"))
    placed = rows.select("doc_id", "key1", "key2", "uid").join(named, ["key1", "key2"])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "uid")).alias("first")
    classes = placed.groupBy("label").agg(first, F.count(F.lit(1)).alias("class_size"))
    return placed.join(classes, "label").select(
        "doc_id",
        "key1",
        "key2",
        "uid",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("uid") == F.col("first.uid")).alias("stays"),
    )


def keep_one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class of near duplicates, of equal rows with one id just one."""
    def row(*keys: Column) -> list[Column]:
        return [*keys, F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("doc_id").isNull()]

    names = unused(docs, "key1", "key2", "id", "absent", "stays1", "stays2", "stays3", "stays4", "nth")
    mine, others, nth = names[:4], names[4:8], names[8]
    staying = near_duplicates(docs, similarity).where("stays").select(*(c.alias(n) for c, n in zip(row(F.col("key1"), F.col("key2")), others, strict=True)))
    marked = docs.select("*", *(c.alias(n) for c, n in zip(row(*content_key(F.col("text"))), mine, strict=True)))
    found = marked.join(staying, [F.col(a) == F.col(b) for a, b in zip(mine, others, strict=True)])
    once = found.withColumn(nth, F.row_number().over(Window.partitionBy(*mine).orderBy(mine[0]))).where(F.col(nth) == 1)
    return once.select(*map(quoted, docs.columns))
