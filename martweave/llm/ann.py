"""Nearest neighbours by a forest of hash prefixes.

Every vector has one long hash string per tree: the signs of random projections of the centred
vector. Sorting the strings of a tree turns equal prefixes into ranges. A query descends in all
trees to the longest prefix it shares with others, then ascends in all trees at the same pace,
shortening the prefix, until the ranges hold enough candidates; these are compared exactly.

How many are enough is fitted: for a bounded sample of queries, exact neighbours are found in one
pass over all vectors, and the least number of candidates that contains the wanted share of them is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martweave.llm.words import ship
from martweave.session import parked

TREES = 32
SAMPLE_QUERIES = 64
TARGET_RECALL = 0.97
LEAF_ROWS = 1024
_MAX_BITS = 24
_FIT_ROWS = 4096
_FOUND = np.dtype([("q", np.int64), ("rep", np.int64), ("far", np.float64)])
_HELD = 400_000


def usable(vector: Column) -> Column:
    """Vectors that take part: not NULL, not empty or all zero, every component present and finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


class _Forest:
    """Projections of all trees and the centre; the same for the same seed and sample."""

    def __init__(self, centre: np.ndarray, trees: int, bits: int, seed: int = 3) -> None:
        self.centre, self.trees, self.bits = centre, trees, bits
        self.planes = np.random.default_rng(seed).standard_normal((len(centre), trees * bits))

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """Hash string of each vector (rows) in each tree (columns) as a number, first bit highest."""
        signs = ((vectors - self.centre) @ self.planes > 0).reshape(len(vectors), self.trees, self.bits)
        return signs @ (np.int64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.int64))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)


def _distances(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Euclidean distances, in double precision and by differences, block by block."""
    out = np.empty((len(queries), len(vectors)))
    step = max(1, 2_000_000 // max(1, vectors.size))
    for a in range(0, len(queries), step):
        gap = queries[a : a + step, None, :] - vectors[None]
        out[a : a + step] = np.sqrt(np.einsum("ijk,ijk->ij", gap, gap))
    return out


def _prefix_length(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Bits that two strings share from the front."""
    return bits - np.ceil(np.log2((a ^ b).astype(float) + 1)).astype(np.int64)


def _enough(vectors: DataFrame, forest: _Forest, dims: int, k: int, recall: float, queries: list) -> int:
    """Candidates, summed over the trees, that a query needs. One pass over all vectors; what reaches
    the driver per task is bounded by the sample of queries."""
    ids = np.array([q["rep"] for q in queries], np.int64)
    points = np.array([q["vector"] for q in queries], float).reshape(-1, dims)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = forest.strings(points)
        reached = np.zeros((len(ids), forest.bits + 1), np.int64)
        best: list[list[tuple[float, int]]] = [[] for _ in ids]
        for batch in batches:
            reps, rows = batch.column(0).to_numpy(), _matrix(batch.column(1), dims)
            strings, far = forest.strings(rows), _distances(points, rows)
            for i in range(len(ids)):
                shared = _prefix_length(strings, own[i][None], forest.bits)
                reached[i] += np.bincount(shared.reshape(-1), minlength=forest.bits + 1)
                deepest = shared.max(axis=1)
                near = np.argsort(far[i], kind="stable")[: k + 1]
                best[i] = sorted(best[i] + [(float(far[i, j]), int(deepest[j])) for j in near if reps[j] != ids[i]])[:k]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(ids)), pa.int64()),
                pa.array(list(reached), pa.list_(pa.int64())),
                pa.array([[f for f, _ in b] for b in best], pa.list_(pa.float64())),
                pa.array([[d for _, d in b] for b in best], pa.list_(pa.int64())),
            ],
            ["query", "reached", "far", "deepest"],
        )

    schema = "query bigint, reached array<bigint>, far array<double>, deepest array<bigint>"
    found = vectors.select("rep", "vector").mapInArrow(run, schema)
    ascending = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("far", "deepest"))))
    levels = [F.sum(F.col("reached")[i]).alias(f"level{i}") for i in range(forest.bits + 1)]
    rows = found.groupBy("query").agg(F.slice(ascending, 1, k).alias("best"), *levels).collect()
    counts = np.array([[r[f"level{i}"] for i in range(forest.bits + 1)] for r in rows])[:, ::-1].cumsum(axis=1)[:, ::-1]
    need = [sorted(b["deepest"] for b in r["best"]) for r in rows]
    options = sorted({int(c) for c in counts.reshape(-1)})
    lo, hi = 0, len(options) - 1
    while lo < hi:
        mid = (lo + hi) // 2
        level = (counts >= options[mid]).sum(axis=1) - 1
        hit = sum(sum(d >= x for d in own) for own, x in zip(need, level, strict=True))
        if hit >= recall * max(1, sum(map(len, need))):
            hi = mid
        else:
            lo = mid + 1
    return options[lo]


def nearest(
    embeddings: DataFrame,
    queries: Column,
    k: int = 10,
    trees: int = TREES,
    recall: float = TARGET_RECALL,
    sample_queries: int = SAMPLE_QUERIES,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row where ``queries`` holds, its ``k`` nearest found other rows.

    The score is the Euclidean distance of the original vectors in double precision; ties go to the
    smaller vec_id. Vectors that are not ``usable``, rows without an id and vectors not of the most common length take
    no part. Equal vectors share one place in the forest. A repeated (id, vector) row counts once.
    """
    ship(embeddings.sparkSession)
    spark = embeddings.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), queries.alias("asks")
    )
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if lengths is None:
        return empty
    dims = lengths["n"]
    rows = rows.where(F.size("vector") == dims).dropDuplicates(["vec_id", "vector"])

    # Equal vectors: the smallest id stands for them; k + 1 ids are all a result can need.
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    firsts = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    members = parked(firsts.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.array_sort(F.collect_list("vec_id")).alias("ids")), "vectors")
    members = members.withColumn("hash", F.xxhash64("vector"))
    asking = parked(
        rows.where(F.coalesce("asks", F.lit(False))).select("vec_id", "vector").join(members.select("vector", "rep"), "vector"), "queries"
    )

    n = members.count()
    fit = members.orderBy("hash", "rep").limit(_FIT_ROWS).select("vector").toArrow()["vector"].combine_chunks()
    centre = _matrix(fit, dims).mean(axis=0)
    bits = int(np.clip(np.ceil(np.log2(max(2, n / LEAF_ROWS))) + 4, 8, _MAX_BITS))
    forest = _Forest(centre, trees, bits)
    sample = members.orderBy("hash", "rep").limit(sample_queries).select("rep", "vector").collect()
    need = max(_enough(members, forest, dims, k, recall, sample), k + 1)

    return _search(members, asking, forest, dims, k, need)


def _leaves(vectors: DataFrame, forest: _Forest, dims: int, name: str) -> DataFrame:
    """Rows (name, tree, leaf, vector): each vector in each tree, by its whole hash string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                strings = forest.strings(_matrix(part.column(1), dims))
                at = pa.array(np.repeat(np.arange(part.num_rows), forest.trees))
                tree = np.tile(np.arange(forest.trees, dtype=np.int32), part.num_rows)
                columns = [part.column(0).take(at), pa.array(tree), pa.array(strings.reshape(-1)), part.column(1).take(at)]
                yield pa.RecordBatch.from_arrays(columns, [name, "tree", "leaf", "vector"])

    return vectors.select(name, "vector").mapInArrow(run, f"{name} bigint, tree int, leaf bigint, vector array<double>")


def _search(members: DataFrame, asking: DataFrame, forest: _Forest, dims: int, k: int, need: int) -> DataFrame:
    """Descend, ascend until ``need`` candidates, compare, and order."""
    bits = forest.bits
    points = asking.select(F.col("rep").alias("q"), "vector").dropDuplicates(["q"])
    index, probes = _leaves(members, forest, dims, "rep"), parked(_leaves(points, forest, dims, "q"), "probes")
    # The directory of the sorted arrays: rows by leaf; a prefix is a range of leaves.
    directory = parked(index.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("rows")), "directory")
    by_level = directory.select("tree", "rows", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("level"), "leaf")
    ranges = by_level.groupBy("tree", "level", F.expr(f"shiftright(leaf, {bits} - level)").alias("prefix")).agg(F.sum("rows").alias("rows"))
    own = probes.select("q", "tree", "leaf", F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("level"))
    own = own.withColumn("prefix", F.expr(f"shiftright(leaf, {bits} - level)"))
    reached = own.join(ranges, ["tree", "level", "prefix"]).groupBy("q", "level").agg(F.sum("rows").alias("rows"))
    depth = reached.groupBy("q").agg(F.coalesce(F.max(F.when(F.col("rows") >= need, F.col("level"))), F.lit(0)).alias("depth"))

    # A leaf of many rows is cut into parts, so that no task gets more than a bounded piece of it.
    parts = F.ceil(F.col("rows") / LEAF_ROWS).cast("int")
    cut = directory.select("tree", "leaf", parts.alias("parts"))
    blocks = index.join(cut, ["tree", "leaf"]).select(
        "tree", "leaf", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part"), F.col("rep").alias("id"), "vector", F.lit(False).alias("asks")
    )
    wide = probes.join(depth, "q").withColumn("prefix", F.expr(f"shiftright(leaf, {bits} - depth)"))
    first = F.expr(f"shiftleft(prefix, {bits} - depth)")
    last = F.expr(f"shiftleft(prefix + 1, {bits} - depth) - 1")
    reach = wide.select("q", "tree", "vector", F.explode(F.sequence(first, last)).alias("leaf"))
    asked = (
        reach.join(cut, ["tree", "leaf"])
        .select("tree", "leaf", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("q").alias("id"), "vector", F.lit(True).alias("asks"))
    )
    found = _compare(blocks.unionByName(asked), dims, k)

    best = found.dropDuplicates(["q", "rep"])
    nearest_reps = best.withColumn("nth", F.row_number().over(Window.partitionBy("q").orderBy("far", "rep"))).where(F.col("nth") <= k + 1)
    expanded = nearest_reps.join(members.select("rep", "ids"), "rep").select("q", "far", F.explode("ids").alias("vec_id"))
    result = asking.select(F.col("vec_id").alias("query_id"), F.col("rep").alias("q")).join(expanded, "q").where("vec_id != query_id")
    ranked = result.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("far", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", F.col("far").alias("score"))


def _nearest_of(found: list[np.ndarray], k: int) -> np.ndarray:
    """Of rows (q, rep, far), the ``k + 1`` nearest different ``rep`` of each ``q``, ties to the smaller."""
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows["rep"], rows["far"], rows["q"]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows["q"][1:] != rows["q"][:-1]) | (rows["rep"][1:] != rows["rep"][:-1])
    rows = rows[new]
    head = np.flatnonzero(np.append(True, rows["q"][1:] != rows["q"][:-1]))
    nth = np.arange(len(rows)) - np.repeat(head, np.diff(np.append(head, len(rows))))
    return rows[nth <= k]


def _compare(rows: DataFrame, dims: int, k: int) -> DataFrame:
    """Rows (q, rep, far): of the blocks of a sorted array that a task gets, the nearest rows of each query asked there.

    A task keeps the best of each query over its blocks, and passes them on when they are many. Blocks are hash-partitioned and sorted; a task streams them and holds one block of at most about
    twice ``LEAF_ROWS`` vectors, the queries after them in bounded slices.
    """
    n_parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["tree", "leaf", "part"]
    ordered = rows.repartition(n_parts, *names).sortWithinPartitions(*names, "asks", "id").select(*names, "asks", "id", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, vectors = None, [], []
        found, held = [], 0
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            asks = batch.column(3).to_numpy(zero_copy_only=False)
            own, rows_ = batch.column(4).to_numpy(), _matrix(batch.column(5), dims)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]).any(axis=1) | (asks[1:] != asks[:-1])
            edges = [*np.flatnonzero(new), len(key)]
            for a, b in zip(edges, edges[1:], strict=False):
                if block is None or (key[a] != block).any():
                    block, ids, vectors = key[a], [], []
                if not asks[a]:
                    ids.append(own[a:b])
                    vectors.append(rows_[a:b])
                elif ids:
                    ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                    far = _distances(rows_[a:b], vectors[0])
                    top = np.lexsort((np.broadcast_to(ids[0], far.shape), far), axis=1)[:, : k + 1]
                    at = np.repeat(np.arange(b - a), top.shape[1])
                    best = np.empty(len(at), _FOUND)
                    best["q"], best["rep"], best["far"] = own[a:b][at], ids[0][top.reshape(-1)], far[at, top.reshape(-1)]
                    found.append(best)
                    held += len(best)
                    if held > _HELD:
                        found = [_nearest_of(found, k)]
                        held = len(found[0])
                        if held > _HELD // 2:
                            yield emit(found[0])
                            found, held = [], 0
        if found:
            yield emit(_nearest_of(found, k))

    def emit(best: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(best[n])) for n in ("q", "rep", "far")], ["q", "rep", "far"])

    return ordered.mapInArrow(run, "q bigint, rep bigint, far double")
