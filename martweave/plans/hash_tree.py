"""Two copies of a large table compared through a tree of digests, opening only the branches that differ.

A stored copy is cut into leaves by a hash of the key, one directory each, and beside it, in ``_digests``, stand the count
and checksum of every node: of each leaf, and of each group of ``fanout`` neighbours up to the root. Digests are sums over rows,
so a node's is the sum of its children's, the tree costs one pass over the rows, and an upper level next to nothing.
Comparing descends from the roots: only children of unequal nodes are looked at, and in the end only
the rows of unequal leaves are read. What stays equal costs one row per node on the way.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from martweave.functions.scalars import quoted, row_hash
from martweave.operators.verify import EQUAL, row_diff
from martweave.session import scratch_scope
from martweave.sources.files import append_partitioned

LEAF = "_leaf"
DIGESTS = "_digests"
FANOUT, DEPTH = 16, 3
#: Leaves opened in one scan; more are read as whole tables.
_MAX_OPENED = 10_000


@dataclass(frozen=True)
class TreeDiff:
    """Unequal rows (``row_diff`` without the equal ones), and how much was looked at to find them."""

    rows: DataFrame
    leaves: int
    nodes: int


def leaf_of(keys: Sequence[str], leaves: int) -> Column:
    """Leaf of a row: the same in every copy whose keys have the same types."""
    return F.pmod(F.xxhash64(*map(quoted, keys)), F.lit(leaves)).cast("int")


def store_with_digests(df: DataFrame, path: str, keys: Sequence[str], fanout: int = FANOUT, depth: int = DEPTH) -> None:
    """Write ``df`` in ``fanout ** depth`` leaves with the digests of all levels. The rows are read once.

    A hot key is one leaf, whose rows the partitioned write deals over several files. Digests are made from what
    was written, so they hold for the stored rows.
    """
    spark = df.sparkSession
    leaves = fanout**depth
    with scratch_scope(spark):
        append_partitioned(df.withColumn(LEAF, leaf_of(keys, leaves)), path, [LEAF])
    write_digests(spark, path, df.schema, fanout, depth)


def write_digests(spark: SparkSession, path: str, schema: StructType, fanout: int = FANOUT, depth: int = DEPTH) -> None:
    """Digests of a table of columns ``schema`` that lies in leaves, for instance after a change to some of them."""
    columns = schema.names
    stored = _stored(spark, path, schema)
    # In the order of the names, as copies may order their columns otherwise.
    total = F.sum(row_hash(sorted(columns, key=str.lower)).cast("decimal(28,0)"))
    lowest = stored.groupBy(F.col(LEAF).alias("node")).agg(F.count(F.lit(1)).alias("rows"), total.alias("checksum"))
    levels = [F.struct(F.lit(level).alias("level"), F.expr(f"node div {fanout ** (depth - level)}").cast("int").alias("node")) for level in range(depth + 1)]
    up = lowest.select(F.explode(F.array(*levels)).alias("at"), "rows", "checksum")
    tree = up.groupBy("at.level", "at.node").agg(F.sum("rows").alias("rows"), F.sum("checksum").cast("decimal(38,0)").alias("checksum"))
    # One row besides the nodes says what the tree is like, also where there are no rows.
    facts = spark.range(1).select(F.lit(-1).alias("level"), F.lit(0).alias("node"), F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("decimal(38,0)").alias("checksum"))
    both = facts.withColumn("shape", F.lit(f"{fanout} {depth} {schema.json()}")).unionByName(tree.withColumn("shape", F.lit(None).cast("string")))
    both.write.mode("overwrite").partitionBy("level").parquet(f"{path.rstrip('/')}/{DIGESTS}")


def _stored(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields, StructField(LEAF, IntegerType())])).parquet(path)


def diff_stored(spark: SparkSession, left: str, right: str, keys: Sequence[str]) -> TreeDiff:
    """Unequal keys of two copies written by ``store_with_digests`` with one shape, as ``row_diff`` would list them."""
    trees = [spark.read.parquet(f"{p.rstrip('/')}/{DIGESTS}") for p in (left, right)]
    shapes = [tree.where("level = -1").first()["shape"].split(" ", 2) for tree in trees]
    schemas = [StructType.fromJson(json.loads(s[2])) for s in shapes]
    columns = [schema.names for schema in schemas]
    if shapes[0][:2] != shapes[1][:2] or sorted(map(str.lower, columns[0])) != sorted(map(str.lower, columns[1])):
        raise ValueError("copies differ in the shape of their trees or in their columns")
    tables = [_stored(spark, p, schema) for p, schema in zip((left, right), schemas, strict=True)]
    fanout, depth = map(int, shapes[0][:2])
    nodes, looked_at = [0], 0
    for level in range(depth + 1):
        opened = F.col("node").isin(nodes) if len(nodes) <= _MAX_OPENED else F.lit(True)
        sides = [t.where((F.col("level") == level) & opened).select("node", *(F.col(c).alias(f"{c}_{i}") for c in ("rows", "checksum"))) for i, t in enumerate(trees)]
        both = sides[0].join(sides[1], "node", "full")
        same = F.col("rows_0").eqNullSafe(F.col("rows_1")) & F.col("checksum_0").eqNullSafe(F.col("checksum_1"))
        found = both.select("node", same.alias("same")).collect()
        # At most one row per leaf, of which there are fanout ** depth.
        looked_at += len(found)
        unequal = sorted(r["node"] for r in found if not r["same"])
        if level < depth:
            nodes = [n * fanout + i for n in unequal for i in range(fanout)]
        if not unequal:
            break
    return TreeDiff(_unequal(tables, columns, keys, unequal), len(unequal), looked_at)


def _unequal(tables: Sequence[DataFrame], columns: Sequence[Sequence[str]], keys: Sequence[str], leaves: Sequence[int]) -> DataFrame:
    """Unequal rows of the leaves named; the scans are pruned to their directories."""
    opened = F.col(LEAF).isin(list(leaves)) if leaves else F.lit(False)
    if len(leaves) > _MAX_OPENED:
        opened = F.lit(True)
    left, right = (t.where(opened).select(*map(quoted, columns[0])) for t in tables)
    return row_diff(left, right, keys).where(F.col("status") != EQUAL)
