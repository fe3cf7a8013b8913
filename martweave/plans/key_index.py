"""Key index of a partitioned directory table: which files may hold a key.

Beside the table, in ``_key_index`` (a name Spark's readers skip), stands one row per data file: its
length and modification time, the least and greatest key, and a Bloom filter of the keys. A file is searched for keys
only if some key lies in its range and passes its filter. An entry counts only for the very file it was made
from, by length and time; files without one are searched, so a stale or absent index costs time and never rows.

A filter takes at most ten to twenty bits a row, the keys themselves several times that; where keys ascend with time, as those of
facts do, the ranges alone leave few files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martweave.functions.scalars import quoted
from martweave.operators.actions import has_key
from martweave.session import parked, path_exists, scratch_scope

FOLDER = "_key_index"
#: Up to so many source keys are looked up file by file; more would touch most files anyway.
MAX_LOOKUPS = 100_000
_BITS_PER_KEY, _PROBES = 10, 4
_MIN_BITS, _MAX_BITS = 6, 27


def update_key_index(spark: SparkSession, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> int:
    """Add the files of the table that have no valid entry; returns how many. Reads the key columns of these files only.

    Entries of files that are gone are left out of the rewritten index. Without an index there, all files are new.
    """
    with scratch_scope(spark):
        files = parked(_files(spark, path, partition_by), "files")
        entries = _entries(spark, path, keys)
        known = files.limit(0) if entries is None else files.join(entries.select(*_FILE), _FILE, "left_semi")
        new = files.join(known.select("file"), "file", "left_anti")
        n_new = new.count()
        if not n_new and entries is not None and known.count() == entries.count():
            return 0
        rows = _index_of(spark, path, new, keys, partition_by) if n_new else None
        if entries is not None:
            kept = entries.join(known.select(*_FILE), _FILE, "left_semi").select(*entries.columns)
            rows = kept if rows is None else kept.unionByName(rows)
        if rows is not None:
            # Written whole before the switch: the next index is made from the present one.
            parked(rows, "key-index").write.mode("overwrite").parquet(_place(path, keys))
        return n_new


def files_with_keys(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], partition_by: Sequence[str], schema: StructType) -> list[str] | None:
    """Paths of the files of the table that may hold a key of ``source``; ``None`` where the index cannot tell.

    Keys are compared as the table's types, which ``schema`` names.
    """
    entries = _entries(spark, path, keys)
    if entries is None:
        return None
    typed = source.where(has_key(keys)).select(*(quoted(k).cast(schema[k].dataType).alias(k) for k in keys)).distinct()
    if typed.limit(MAX_LOOKUPS + 1).count() > MAX_LOOKUPS:
        return None
    wanted = typed.agg(F.sort_array(F.collect_list(F.struct(F.struct(*map(quoted, keys)).alias("key"), *_hashes(keys)))).alias("wanted"))
    files = _files(spark, path, partition_by)
    # One row for all files, bounded by MAX_LOOKUPS.
    asked = files.join(entries, _FILE, "left").crossJoin(F.broadcast(wanted))
    passes = F.exists("wanted", lambda w: w["key"].between(F.col("low"), F.col("high")) & _in_filter(w))
    found = asked.where(F.col("bits").isNull() | passes)
    return sorted(r["path"] for r in found.select("path").collect())


_FILE = ["file", "length", "modified"]


def _place(path: str, keys: Sequence[str]) -> str:
    return f"{path.rstrip('/')}/{FOLDER}/{','.join(keys)}"


def _entries(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    place = _place(path, keys)
    return spark.read.parquet(place) if path_exists(spark, f"{place}/_SUCCESS") else None


def _files(spark: SparkSession, path: str, partition_by: Sequence[str]) -> DataFrame:
    """Rows (file, path, length, modified) of the data files, from a listing; ``file`` is the path below the table."""
    options = {"recursiveFileLookup": True, "pathGlobFilter": "*.parquet"}
    listed = spark.read.format("binaryFile").options(**options).load(path)
    # Spark's listing leaves out folders that begin with an underscore, but not what was asked for by name.
    own = listed.where(~F.contains("path", F.lit(f"/{FOLDER}/")))
    return own.select(_below(F.col("path"), partition_by).alias("file"), "path", "length", F.col("modificationTime").alias("modified"))


def _hashes(keys: Sequence[str]) -> list[Column]:
    return [F.xxhash64(*map(quoted, keys), F.lit(i)).alias(f"h{i}") for i in range(_PROBES)]


def _in_filter(wanted: Column) -> Column:
    """Whether all probes of a key are set in the words ``bits``, whose number is a power of two."""
    found = F.lit(True)
    for i in range(_PROBES):
        at = wanted[f"h{i}"].bitwiseAND(F.size("bits").cast("bigint") * 64 - 1)
        word = F.try_element_at(F.col("bits"), (F.shiftright(at, 6) + 1).cast("int"))
        bit = F.call_function("shiftrightunsigned", word, at.bitwiseAND(63).cast("int"))
        found = found & (bit.bitwiseAND(1) != 0)
    return found


def _index_of(spark: SparkSession, path: str, new: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Entries of the files ``new``. Filters are built word by word, combined within tasks before the shuffle."""
    paths = [r["path"] for r in new.select("path").collect()]
    read_from = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    data = spark.read.option("basePath", path).parquet(*paths).select(_below(read_from, partition_by).alias("file"), *map(quoted, keys))
    keyed, key = data.where(has_key(keys)), F.struct(*map(quoted, keys))
    wanted = F.ceil(F.log2(F.count(F.lit(1)) * _BITS_PER_KEY)).cast("int")
    log_bits = F.least(F.greatest(wanted, F.lit(_MIN_BITS)), F.lit(_MAX_BITS))
    sizes = parked(keyed.groupBy("file").agg(F.min(key).alias("low"), F.max(key).alias("high"), log_bits.alias("log_bits")), "key-ranges")
    # One row per new file.
    shaped = F.broadcast(sizes.select("file", "log_bits"))
    probes = keyed.join(shaped, "file").select("file", F.expr("shiftleft(1L, log_bits) - 1").alias("mask"), F.explode(F.array(*_hashes(keys))).alias("h"))
    at = F.col("h").bitwiseAND(F.col("mask"))
    marks = probes.select("file", F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(63).cast("int")).alias("bits"))
    every = F.explode(F.expr("sequence(0L, shiftleft(1L, log_bits - 6) - 1)"))
    blank = sizes.select("file", every.alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = marks.unionByName(blank).groupBy("file", "word").agg(F.bit_or("bits").alias("bits"))
    filters = words.groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"]).alias("bits"))
    # A file without keys has no range and an empty filter, which nothing passes.
    built = new.drop("path").join(sizes.drop("log_bits"), "file", "left").join(filters, "file", "left")
    return built.select(*_FILE, "low", "high", F.coalesce("bits", F.array().cast("array<bigint>")).alias("bits"))


def _below(path: Column, partition_by: Sequence[str]) -> Column:
    """The part of a file's path below the table: partition folders and name."""
    depth = 1 + len(partition_by)
    return F.array_join(F.slice(F.split(path, "/"), -depth, depth), "/")
