"""Self-join of documents by the Jaccard similarity of their shingle sets, with a token-group matrix.

Documents are partitioned into groups of similar ones (equal minimum hash), and each group stores the
union of its members' tokens. The matrix says which groups hold which token; it needs only the rare tokens of each set:
in any common order of tokens, sets that are alike enough share one among their first few. A query set cannot be more
alike to any member of a group than its overlap with the union allows, so a group is opened, and
its members compared exactly, only where that bound reaches the threshold.

A token in many groups does not become all pairs of them. Each group is compared with the first of its
token, and what that links is one component. Tokens whose documents are all in one component are
settled; for the others the remaining groups are compared pair by pair where they are few, and block by block inside tasks
where they are many.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.llm.decontaminate import content_key
from martweave.llm.near import components
from martweave.llm.words import SPACED, Words, mixed, pieces, ship, signed, spans_hash, split_words
from martweave.operators.sizing import broadcast_if_small
from martweave.session import delete_path, parked, scratch_path

SHINGLE = 4
PERCENT = 85
_BIN_BITS, _CHUNK_BITS = 18, 12
#: A group has at most so many members and, but for a single document, so many tokens.
_MEMBERS, _GROUP_TOKENS = 32, 50_000
#: Documents of one minimum hash are dealt in lots of about so many before they are grouped.
_LOT = 2048
#: Tokens of up to so many groups have these compared pair by pair, others in blocks of so many.
_FEW, _BLOCK = 8, 64
#: Tokens that one product of matrices takes.
_COLUMNS = 4096
_PIECE_TOKENS = 400_000
_FILTER_BITS = 25


def shingle_sets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Columns (document, shingle hash), distinct, ordered by both. A text of one to three words is one shingle."""
    room = words.room()
    place = np.flatnonzero(room >= SHINGLE)
    place = np.concatenate([place, words.first[:-1][(words.counts > 0) & (words.counts < SHINGLE)]])
    hashes = spans_hash(words.hashes, place, np.minimum(room[place], SHINGLE))
    doc = np.searchsorted(words.first, place, side="right") - 1
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


def _sets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(split_words(texts, SPACED, True))


def needed(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that a set of each size must share with any set at least ``percent`` alike."""
    return -(-percent * sizes // 100)


def witnesses(sizes: np.ndarray | Column) -> np.ndarray | Column:
    """How many shared tokens the rare tokens of a set must show: the more are kept, the more a partner is sure to share of them."""
    return 1 + (sizes - sizes % 20) / 20 if isinstance(sizes, Column) else 1 + sizes // 20


def _bins(hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes, 23) >> np.uint64(64 - _BIN_BITS)).astype(np.int64)


def frequencies(docs: DataFrame) -> np.ndarray:
    """How often tokens of each of 2**18 hashed bins occur, over all documents. Orders tokens, rare ones first; any order is right."""
    ship(docs.sparkSession)
    size = 1 << _CHUNK_BITS

    def chunks(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if counts:
            packed = [zlib.compress(c.astype("<i8").tobytes(), 1) for c in counts.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(packed, pa.binary())], ["chunk", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << _BIN_BITS, np.int64)
        for batch in pieces(batches):
            counts += np.bincount(_bins(_sets_of(batch.column("text"))[1]), minlength=1 << _BIN_BITS)
        yield from chunks({i: c for i, c in enumerate(counts.reshape(-1, size)) if c.any()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sums[chunk] = sums.get(chunk, 0) + np.frombuffer(zlib.decompress(packed), "<i8")
        yield from chunks(sums)

    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kinds = "chunk int, counts binary"
    out = np.zeros((1 << (_BIN_BITS - _CHUNK_BITS), size), np.int64)
    for row in docs.select("text").mapInArrow(run, kinds).repartition(n_parts, "chunk").mapInArrow(add, kinds).collect():
        out[row["chunk"]] = np.frombuffer(zlib.decompress(row["counts"]), "<i8")
    return np.minimum(out.reshape(-1), 2**31 - 1).astype(np.int32)


def _sketches(docs: DataFrame, often: Broadcast, percent: int) -> DataFrame:
    """Rows (doc_id, key1, key2, n, set1, set2, group_hash, prefix): size and two hashes of the set, its minimum hash and its rare tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 3):
            doc, hashes = _sets_of(batch.column(3))
            n = np.bincount(doc, minlength=batch.num_rows)
            sums = []
            for salt in (81, 82):
                total = np.zeros(batch.num_rows, np.uint64)
                np.add.at(total, doc, mixed(hashes, salt))
                sums.append(total)
            head = np.flatnonzero(np.diff(doc, prepend=-1))
            least = np.zeros(batch.num_rows, np.uint64)
            if len(head):
                least[doc[head]] = np.minimum.reduceat(mixed(hashes, 83), head)
            order = np.lexsort((hashes, often.value[_bins(hashes)], doc))
            rank = np.arange(len(doc)) - np.repeat(head, np.diff(np.append(head, len(doc))))
            first = order[rank < (n - needed(n, percent) + witnesses(n))[doc]]
            ends = np.concatenate([[0], np.cumsum(np.bincount(doc[first], minlength=batch.num_rows))]).astype(np.int32)
            prefix = pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(hashes[first])))
            columns = [*(batch.column(i) for i in range(3)), pa.array(n), *(pa.array(signed(c)) for c in (*sums, least)), prefix]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key1", "key2", "n", "set1", "set2", "group_hash", "prefix"])

    kind = dict(docs.dtypes)["doc_id"]
    longs = ", ".join(f"{c} bigint" for c in ("key1", "key2", "n", "set1", "set2", "group_hash"))
    return docs.select("doc_id", *content_key(F.col("text")), "text").mapInArrow(run, f"doc_id {kind}, {longs}, prefix array<bigint>")


def _passing(keyed: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of ``keyed`` whose key1 passes a filter of those of ``members``, so that few other texts are shuffled.

    The filter is a table of at most 2**19 words of 64 bits and is broadcast; with very many members it lets more through, and the join sorts it out.
    """
    slot = F.col("key1").bitwiseAND(F.lit((1 << _FILTER_BITS) - 1))
    word, bit = F.shiftright(slot, 6), slot.bitwiseAND(63).cast("int")
    bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("bits")
    words = members.groupBy(word.alias("word")).agg(bits)
    marked = keyed.join(F.broadcast(words), word == F.col("word"))
    return marked.where(F.call_function("shiftrightunsigned", F.col("bits"), bit).bitwiseAND(1) == 1).select(*keyed.columns)


def _groups(members: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows (gid, vids, sizes, tokens, union): groups of documents with one minimum hash, in order of size, their sets one
    after the other, and all tokens of the group (NULL for one document, whose set it is). ``gid`` is the smallest vid."""
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lots = members.groupBy("group_hash").agg(F.ceil(F.count(F.lit(1)) / _LOT).alias("lots"))
    dealt = members.join(lots, "group_hash").withColumn("lot", F.pmod(F.xxhash64("vid"), "lots"))
    keyed = _passing(docs.select("text", *content_key(F.col("text"))), members)
    once = keyed.groupBy("key1", "key2").agg(F.first("text").alias("text"))
    keys = ["group_hash", "lot"]
    rows = once.join(dealt, ["key1", "key2"]).select(*keys, "n", "vid", "text")
    ordered = rows.repartition(n_parts, *keys).sortWithinPartitions(*keys, "n", "vid").select(*keys, "vid", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size = None, [], 0
        for batch in pieces(batches):
            doc, hashes = _sets_of(batch.column(3))
            edges = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            done = []
            for i, own in enumerate(zip(*(batch.column(c).to_pylist() for c in range(2)), strict=True)):
                tokens = hashes[edges[i] : edges[i + 1]]
                if held and (own != key or len(held) == _MEMBERS or size + len(tokens) > _GROUP_TOKENS):
                    done.append(held)
                    held, size = [], 0
                key = own
                held.append((batch.column(2)[i].as_py(), tokens.copy()))
                size += len(tokens)
            if done:
                yield emit(done)
        if held:
            yield emit([held])

    def emit(done: list[list]) -> pa.RecordBatch:
        rows_ = []
        for own in done:
            vids, sets = zip(*own, strict=True)
            every = np.concatenate(sets)
            rows_.append((min(vids), list(vids), [len(s) for s in sets], every.tobytes(), np.unique(every).tobytes() if len(own) > 1 else None))
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows_, strict=True), types, strict=True)], names)

    names = ["gid", "vids", "sizes", "tokens", "union"]
    return ordered.mapInArrow(run, "gid bigint, vids array<bigint>, sizes array<bigint>, tokens binary, union binary")


class _Side:
    """Groups of one side of a batch of group pairs, member by member."""

    def __init__(self, batch: pa.RecordBatch, suffix: str) -> None:
        lists = batch.column(f"vids{suffix}")
        self.vids = lists.flatten().to_numpy()
        self.sizes = batch.column(f"sizes{suffix}").flatten().to_numpy()
        counts = np.diff(lists.offsets.to_numpy())
        self.pair = np.repeat(np.arange(len(lists)), counts)
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.tokens = np.concatenate([np.frombuffer(b, np.uint64) for b in batch.column(f"tokens{suffix}").to_pylist()])

    def of(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the members, and which of the ``members`` each belongs to."""
        sizes = self.sizes[members]
        owner = np.repeat(np.arange(len(members)), sizes)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.starts[members], sizes)
        return self.tokens[at], owner


def _shared(tokens: np.ndarray, owner: np.ndarray, others: np.ndarray, other_owner: np.ndarray) -> np.ndarray:
    """Whether each token is among the ``others`` of the same owner."""
    own = tokens ^ mixed(owner.astype(np.uint64), 91)
    pool = np.sort(others ^ mixed(other_owner.astype(np.uint64), 91))
    if not len(pool):
        return np.zeros(len(own), bool)
    return pool[np.minimum(np.searchsorted(pool, own), len(pool) - 1)] == own


def alike_members(batch: pa.RecordBatch, percent: int) -> np.ndarray:
    """Rows (pair, a, b) of members alike, of the two groups in each row of ``batch``; a group paired with itself gives a < b.

    Sets of the first group are bounded by the union of the second, which is opened only for those that reach the threshold.
    """
    left, right = _Side(batch, ""), _Side(batch, "2")
    same = batch.column("gid").to_numpy() == batch.column("gid2").to_numpy()
    unions = [np.frombuffer(u or t, np.uint64) for u, t in zip(batch.column("union2").to_pylist(), batch.column("tokens2").to_pylist(), strict=True)]
    union_pair = np.repeat(np.arange(len(unions)), [len(u) for u in unions])
    asking = np.flatnonzero(~same[left.pair])
    tokens, owner = left.of(asking)
    hit = _shared(tokens, left.pair[asking][owner], np.concatenate(unions), union_pair)
    bound = np.bincount(owner, hit, minlength=len(asking))
    opening = np.sort(np.concatenate([asking[bound >= needed(left.sizes[asking], percent)], np.flatnonzero(same[left.pair])]))

    counts = np.diff(right.first)[left.pair[opening]]
    a = np.repeat(opening, counts)
    b = np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(right.first[left.pair[opening]], counts)
    n_a, n_b = left.sizes[a], right.sizes[b]
    fits = (100 * np.minimum(n_a, n_b) >= percent * np.maximum(n_a, n_b)) & (~same[left.pair[a]] | (left.vids[a] < right.vids[b]))
    a, b, found = a[fits], b[fits], []
    step = max(1, _PIECE_TOKENS // max(1, int(left.sizes[a].max(initial=1))))
    for at in range(0, len(a), step):
        x, y = a[at : at + step], b[at : at + step]
        tokens, owner = left.of(x)
        common = np.bincount(owner, _shared(tokens, owner, *right.of(y)), minlength=len(x)).astype(np.int64)
        good = 100 * common >= percent * (left.sizes[x] + right.sizes[y] - common)
        found.append(np.stack([left.pair[x[good]], left.vids[x[good]], right.vids[y[good]]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def _block_links(groups: _Side, meet: np.ndarray, percent: int) -> np.ndarray:
    """Links (a, b) between members of the groups that may ``meet`` (a matrix of groups).

    As for pairs of groups: every member's overlap with the tokens of each group bounds it, and groups that qualify are opened.
    Here both are products of matrices, token by group and token by member.
    """
    doc = np.repeat(np.arange(len(groups.vids)), groups.sizes)
    tokens, place, often = np.unique(groups.tokens, return_inverse=True, return_counts=True)
    # A token of one member alone adds nothing to any overlap with others.
    column = np.cumsum(often > 1) - 1
    shared = often[place] > 1
    doc, column = doc[shared], column[place[shared]]
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    del tokens, place, shared, order

    def chunks() -> Iterator[np.ndarray]:
        for a in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
            own = slice(*np.searchsorted(column, [a, a + _COLUMNS]))
            dense = np.zeros((len(groups.vids), _COLUMNS), np.float32)
            dense[doc[own], column[own] - a] = 1
            yield dense

    bound = np.zeros((len(groups.vids), len(meet)), np.float32)
    for dense in chunks():
        bound += dense @ np.maximum.reduceat(dense, groups.first[:-1], axis=0).T
    opens = meet[groups.pair] & (bound >= needed(groups.sizes, percent)[:, None])
    x = np.flatnonzero(opens.any(axis=1))
    y = np.flatnonzero(opens.any(axis=0)[groups.pair])
    common = np.zeros((len(x), len(y)), np.float32)
    if common.size:
        for dense in chunks():
            common += dense[x] @ dense[y].T
    count = common.astype(np.int64)
    alike = opens[x][:, groups.pair[y]] & (100 * count >= percent * (groups.sizes[x][:, None] + groups.sizes[y][None] - count))
    i, j = np.nonzero(alike)
    return np.stack([groups.vids[x[i]], groups.vids[y[j]]], axis=1)


def _thinned(links: np.ndarray, names: np.ndarray | None = None) -> np.ndarray:
    """As few of the links (rows a, b) as connect what all of them connect; ends of one name (default: the ends themselves) are connected already."""
    ids, at = np.unique(links if names is None else names, return_inverse=True)
    parent = list(range(len(ids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    kept = []
    for i, (a, b) in enumerate(at.reshape(-1, 2).tolist()):
        x, y = root(a), root(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(i)
    return links[kept]


def _linked(batch: pa.RecordBatch, percent: int) -> pa.RecordBatch:
    links = _thinned(alike_members(batch, percent)[:, 1:])
    return pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows in slices of a bounded number of tokens on both sides."""
    size = sum(np.array([len(b) for b in batch.column(c).to_pylist()], np.int64) for c in ("tokens", "tokens2"))
    edges = [0, *(np.flatnonzero(np.diff(np.cumsum(size) // (8 * _PIECE_TOKENS))) + 1), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def _of(groups: DataFrame, wanted: DataFrame) -> DataFrame:
    """The groups that ``wanted`` names. Only their tokens are shuffled where the names are few enough to broadcast."""
    return groups.join(broadcast_if_small(parked(wanted.select("gid").distinct(), "wanted-groups")), "gid", "left_semi")


def _compared(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect alike members of the pairs (gid, gid2) of groups."""
    pairs = pairs.select("gid", "gid2")
    second = _of(groups, pairs.select(F.col("gid2").alias("gid"))).select(*(F.col(c).alias(f"{c}2") for c in groups.columns))
    both = pairs.join(second, "gid2").join(_of(groups, pairs).drop("union"), "gid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                yield _linked(part, percent)

    names = ["gid", "vids", "sizes", "tokens", "gid2", "vids2", "sizes2", "tokens2", "union2"]
    return both.select(*names).mapInArrow(run, "a bigint, b bigint")


def _compared_in_blocks(cells: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """Links of the groups of frequent tokens: (token, gid, n_groups, low, high, low_comp, high_comp) dealt into blocks, each pair of blocks
    compared by one step of a task, which holds these two alone. Pairs never become rows. Groups within one component, or of sizes too
    unlike, are not compared."""
    n_parts = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_blocks = F.ceil(F.col("n_groups") / _BLOCK).cast("int")
    dealt = cells.withColumn("block", F.pmod(F.xxhash64("gid"), n_blocks).cast("int"))
    marks = ["low", "high", "low_comp", "high_comp"]
    meets = dealt.select("token", "gid", *marks, "block", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("other"))
    meets = meets.select("token", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", *marks, "gid")
    keys = ["token", "x", "y"]
    ordered = meets.join(_of(groups, cells), "gid").repartition(n_parts, *keys).sortWithinPartitions(*keys, "block", "gid").select(*keys, "block", *marks, *groups.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            marks = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
            edges = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1), batch.num_rows]
            for a, b in zip(edges, edges[1:], strict=False):
                if b > a:
                    if key is not None and (marks[a] != key).any():
                        yield from compare(held)
                        held = []
                    key = marks[a]
                    held.append(batch.slice(a, b - a))
        if held:
            yield from compare(held)

    def compare(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (rows,) = pa.Table.from_batches(held).combine_chunks().to_batches()
        block = rows.column("block").to_numpy()
        low, high, low_comp, high_comp = (rows.column(c).to_numpy() for c in marks)
        one = rows.column("x")[0].equals(rows.column("y")[0])
        meet = np.ones((len(block), len(block)), bool) if one else block[:, None] != block[None]
        meet &= np.minimum(low_comp[:, None], low_comp[None]) != np.maximum(high_comp[:, None], high_comp[None])
        meet &= (100 * high[:, None] >= percent * low[None]) & (100 * high[None] >= percent * low[:, None])
        np.fill_diagonal(meet, False)
        if not meet.any():
            return
        groups = _Side(rows, "")
        links = _block_links(groups, meet, percent)
        # Members of a group that lies in one component go by its label, others by their own ids.
        named = np.where((low_comp == high_comp)[groups.pair], low_comp[groups.pair], groups.vids)
        order = np.argsort(groups.vids)
        links = _thinned(links, named[order][np.searchsorted(groups.vids[order], links)])
        if len(links):
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], ["a", "b"])

    return ordered.mapInArrow(run, "a bigint, b bigint")


def _sizes_fit(low: str, high: str, low2: str, high2: str, percent: int) -> Column:
    """Whether some sizes of two ranges are near enough for their sets to be alike."""
    return (100 * F.col(high) >= percent * F.col(low2)) & (100 * F.col(high2) >= percent * F.col(low))


def _shared_tokens(matrix: DataFrame) -> DataFrame:
    """The rows of ``matrix`` whose token several documents have."""
    shared = matrix.groupBy("token").agg(F.count(F.lit(1)).alias("n_docs")).where("n_docs > 1").select("token")
    return matrix.join(shared, "token")


def set_join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Documents link when the Jaccard similarity of their sets of four-word shingles is at least ``percent`` hundredths;
    ``component_id`` is the smallest doc_id reachable by links, NULL where none of them has one. Words are lower-cased A-Z runs of characters that are not blank; a
    shorter text is one shingle, NULL and texts without words have an empty set and link with nothing. Repeated rows are
    documents of their own. Shingles are told apart by hashes of 64 bits, sets by two of them.
    """
    spark = docs.sparkSession
    often = spark.sparkContext.broadcast(frequencies(docs))
    path = scratch_path(spark, "sketches")
    _sketches(docs, often, percent).withColumn("uid", F.monotonically_increasing_id()).write.parquet(path)
    sketched = spark.read.parquet(path)
    rows = parked(sketched.drop("prefix"), "documents")
    # Equal sets are one; the row with the smallest uid stands for it.
    first = parked(rows.where("n > 0").groupBy("set1", "set2").agg(F.min("uid").alias("vid")), "sets")
    distinct = rows.join(first.select("vid"), F.col("uid") == F.col("vid"))
    firsts = sketched.join(first.select("vid"), F.col("uid") == F.col("vid"))
    tokens = firsts.select("vid", F.posexplode("prefix").alias("place", "token"))
    tokens = parked(_shared_tokens(tokens), "tokens")
    delete_path(spark, path)
    # Sets alike enough lie in one band of sizes or in two next to each other, so a token is split by pairs of bands.
    band = F.floor(F.log(F.col("n") * 1.0) / (math.log(100 / percent) * (1 + 1e-9)))
    # Any partner shares one of the first tokens; the others are witnesses only.
    first_ones = F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100)
    sides = tokens.join(distinct.select("vid", "n"), "vid").select("vid", "n", first_ones.alias("opens"), F.posexplode(F.array(band, band + 1)).alias("side", "band"), "token")
    sides = parked(sides.select("vid", "n", "opens", "side", F.xxhash64("token", "band").alias("token")), "sides")
    matrix = parked(_shared_tokens(sides), "matrix")
    # What all partners on a side share with a document shows among its shared tokens there.
    least = witnesses(F.ceil(F.col("n") * percent / 100).cast("bigint"))
    enough = matrix.groupBy("vid", "n", "side").agg(F.count(F.lit(1)).alias("shared")).where(F.col("shared") >= least).select("vid", "side")
    matrix = parked(_shared_tokens(matrix.where("opens").join(enough, ["vid", "side"])).select("vid", "token"), "matrix")
    members = parked(matrix.select("vid").distinct().join(distinct.select("vid", "key1", "key2", "n", "group_hash"), "vid"), "members")
    groups = parked(_groups(members, docs), "token-groups")
    placed = parked(groups.select("gid", F.explode(F.arrays_zip("vids", "sizes")).alias("m")).select("gid", F.col("m.vids").alias("vid"), F.col("m.sizes").alias("n")), "placed")

    cells = parked(matrix.join(placed, "vid"), "cells")
    by_group = cells.groupBy("token", "gid").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    first_group = F.min(F.struct("gid", "low", "high")).alias("first")
    leaders = by_group.groupBy("token").agg(first_group, F.count(F.lit(1)).alias("n_groups")).where("n_groups > 1")
    leaders = leaders.select("token", "n_groups", F.col("first.gid").alias("leader"), F.col("first.low").alias("leader_low"), F.col("first.high").alias("leader_high"))
    by_group = parked(by_group.join(leaders, "token"), "group-matrix")
    star = by_group.where("gid != leader").where(_sizes_fit("low", "high", "leader_low", "leader_high", percent))
    star = star.select(F.col("leader").alias("gid"), F.col("gid").alias("gid2")).distinct()
    alone = groups.where(F.size("vids") > 1).select("gid", F.col("gid").alias("gid2"))
    star = parked(star.unionByName(alone), "star")
    links = parked(_compared(star, groups, percent), "star-links")
    labels = components(links)

    # A token whose documents are in one component is settled.
    standing = cells.join(labels, "vid", "left").withColumn("comp", F.coalesce("label", "vid"))
    open_ = standing.groupBy("token").agg(F.min("comp").alias("low_comp"), F.max("comp").alias("high_comp")).where("low_comp != high_comp").select("token")
    comps = placed.join(labels, "vid", "left").groupBy("gid").agg(F.min(F.coalesce("label", "vid")).alias("low_comp"), F.max(F.coalesce("label", "vid")).alias("high_comp"))
    left = by_group.where("n_groups > 2").join(open_, "token").join(comps, "gid")
    # A passage gives many tokens one list of groups, which is compared once.
    names = [F.sum(F.xxhash64("gid", F.lit(i)).cast("decimal(38,0)")).alias(f"name{i}") for i in range(2)]
    lists = left.groupBy("token").agg(*names).groupBy("name0", "name1").agg(F.min("token").alias("token"))
    left = parked(left.join(lists.select("token"), "token"), "open-cells")
    few = left.where((F.col("n_groups") <= _FEW) & (F.col("gid") != F.col("leader")))
    other = few.select("token", *(F.col(c).alias(f"{c}2") for c in ("gid", "low", "high", "low_comp", "high_comp")))
    apart = F.least("low_comp", "low_comp2") != F.greatest("high_comp", "high_comp2")
    pairs = few.join(other, "token").where("gid < gid2").where(apart).where(_sizes_fit("low", "high", "low2", "high2", percent))
    pairs = parked(pairs.select("gid", "gid2").distinct().join(star, ["gid", "gid2"], "left_anti"), "pairs")
    rest = _compared(pairs, groups, percent).unionByName(_compared_in_blocks(left.where(F.col("n_groups") > _FEW), groups, percent))
    labels = components(parked(links.unionByName(rest), "links"))

    named = first.join(labels, "vid", "left").select("set1", "set2", F.coalesce("label", "vid").alias("label"))
    found = rows.select("doc_id", "n", "set1", "set2", "uid").join(named, ["set1", "set2"], "left").withColumn("label", F.coalesce("label", -1 - F.col("uid")))
    least = found.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return found.join(least, "label").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
