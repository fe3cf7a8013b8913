"""Counts, order-free checksums and keyed comparison of two copies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martweave.functions.scalars import quoted, row_hash

ONLY_LEFT = "only_left"
ONLY_RIGHT = "only_right"
CHANGED = "changed"
EQUAL = "equal"
UNVERIFIED = "unverified"


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, in one aggregate over all tables; no column is read.

    Each table also adds one uncounted row, so that an empty one shows up with zero.
    """
    spark = next(iter(tables.values())).sparkSession
    counted = [df.select(F.lit(name).alias("table_name"), F.lit(1).alias("_n")) for name, df in tables.items()]
    names = F.explode(F.array(*[F.lit(name) for name in tables]))
    every = spark.range(1).select(names.alias("table_name"), F.lit(0).alias("_n"))
    return (
        reduce(DataFrame.unionByName, [every, *counted])
        .groupBy("table_name")
        .agg(F.sum("_n").alias("row_count"))
    )


def checksum_aggregates(columns: Sequence[str]) -> list[Column]:
    """``row_count`` and ``checksum``; equal for equal rows in any order.

    A sum, not an exclusive-or: pairs of equal rows must not cancel out. Decimal(38) holds more
    64-bit hashes than a table can have rows, so even one row repeated throughout cannot overflow.
    """
    total = F.sum(row_hash(list(columns)).cast("decimal(28,0)"))
    return [F.count(F.lit(1)).alias("row_count"), F.coalesce(total, F.lit(0)).cast("string").alias("checksum")]


def table_checksum(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: count and checksum of the whole table."""
    return df.agg(*checksum_aggregates(columns or df.columns))


def bucket_checksums(df: DataFrame, keys: Sequence[str], buckets: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Count and checksum per key bucket, to narrow a mismatch down before comparing rows."""
    bucket = F.pmod(F.xxhash64(*[quoted(k) for k in keys]), F.lit(buckets)).cast("int")
    return df.groupBy(bucket.alias("bucket")).agg(*checksum_aggregates(columns or df.columns))


def portable_checksum(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count and checksum another SQL engine can repeat: the sum of 32 bits of each row's MD5.

    A row prints as the lengths of its values in characters, ``N`` for NULL, and then the values, so that no two
    rows print alike. For integer and text columns; other types print differently from engine to engine.
    Both halves of the 32 bits add up as longs, which no number of rows overflows, and meet in a decimal at the end.
    """
    printed = [quoted(c).cast("string") for c in columns]
    lengths = F.concat_ws(",", *[F.coalesce(F.char_length(v).cast("string"), F.lit("N")) for v in printed])
    text = F.concat(lengths, F.lit(":"), F.concat_ws("", *printed))
    word = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    high, low = F.sum(F.shiftright(word, 16)), F.sum(word.bitwiseAND(0xFFFF))
    return df.agg(F.count(F.lit(1)).alias("row_count"), (high.cast("decimal(28,0)") * 65536 + low).cast("decimal(38,0)").alias("checksum"))


def same_content(left: DataFrame, right: DataFrame) -> bool:
    """Whether two tables hold the same rows, by count and checksum."""
    if [c.lower() for c in left.columns] != [c.lower() for c in right.columns]:
        return False
    return table_checksum(left).first() == table_checksum(right, right.columns).first()


def row_diff(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Status of every key found in either copy, with the row count of each side.

    One aggregate over both copies instead of a full outer join: repeated keys compare as
    groups rather than multiplying, NULL keys compare like any other, and a hot key is reduced
    within each task before the shuffle.
    """
    keys = list(keys)
    others = [c for c in left.columns if c not in keys]

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        content = row_hash(others) if others else F.lit(0).cast("bigint")
        return df.select(*[quoted(k) for k in keys], content.alias("_hash"), F.lit(is_left).alias("_left"))

    content = F.col("_hash").cast("decimal(28,0)")
    grouped = side(left, True).unionByName(side(right, False)).groupBy(*[quoted(k) for k in keys]).agg(
        F.count_if("_left").alias("left_rows"),
        F.count_if(~F.col("_left")).alias("right_rows"),
        F.sum(F.when(F.col("_left"), content)).alias("_left_sum"),
        F.sum(F.when(~F.col("_left"), content)).alias("_right_sum"),
    )
    unequal = (F.col("left_rows") != F.col("right_rows")) | (F.col("_left_sum") != F.col("_right_sum"))
    status = (
        F.when(F.col("right_rows") == 0, ONLY_LEFT)
        .when(F.col("left_rows") == 0, ONLY_RIGHT)
        .when(unequal, CHANGED)
        .otherwise(EQUAL)
    )
    return grouped.select(*[quoted(k) for k in keys], "left_rows", "right_rows", status.alias("status"))


def reconcile_files(source: DataFrame, copy: DataFrame) -> DataFrame:
    """Compare two file inventories by ``name``, on length and ``md5``.

    Files of equal length are ``equal`` or ``changed`` by their hashes; where one is missing,
    nothing is known about the content and the status is ``unverified``.
    """

    def side(files: DataFrame, sign: int) -> DataFrame:
        md5 = F.col("md5") if "md5" in files.columns else F.lit(None).cast("string")
        return files.select("name", "length", md5.alias("md5"), F.lit(sign).alias("_sign"))

    def gap(columns: list[str]) -> Column:
        return F.sum(row_hash(columns).cast("decimal(28,0)") * F.col("_sign"))

    grouped = (
        side(source, 1)
        .unionByName(side(copy, -1))
        .groupBy("name")
        .agg(
            F.count_if(F.col("_sign") > 0).alias("left_rows"),
            F.count_if(F.col("_sign") < 0).alias("right_rows"),
            gap(["length"]).alias("_length_gap"),
            gap(["length", "md5"]).alias("_gap"),
            F.bool_and(F.col("md5").isNotNull()).alias("_hashed"),
        )
    )
    status = (
        F.when(F.col("right_rows") == 0, ONLY_LEFT)
        .when(F.col("left_rows") == 0, ONLY_RIGHT)
        .when((F.col("left_rows") != F.col("right_rows")) | (F.col("_length_gap") != 0), CHANGED)
        .when(~F.col("_hashed"), UNVERIFIED)
        .when(F.col("_gap") != 0, CHANGED)
        .otherwise(EQUAL)
    )
    return grouped.select("name", "left_rows", "right_rows", status.alias("status"))


def unprocessed(items: DataFrame, processed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Items not yet in the processed list, by exact key. The list may name an item often."""
    return items.join(processed.select(*[quoted(k) for k in keys]).distinct(), list(keys), "left_anti")


def lookup_one(df: DataFrame, condition: Column) -> DataFrame:
    """The single row that satisfies ``condition``; raises when there is none or more than one."""
    found = df.where(condition)
    matches = len(found.limit(2).collect())
    if matches != 1:
        raise LookupError("no row matches" if matches == 0 else "more than one row matches")
    return found


def exists(df: DataFrame, condition: Column) -> bool:
    """Whether any row satisfies ``condition``; stops at the first one."""
    return bool(df.where(condition).take(1))
