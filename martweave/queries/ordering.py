"""Numbering, chunking and paging queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.operators import ordering
from martweave.plans.pages import read_page, store_pages
from martweave.queries.inputs import table
from martweave.session import scratch_path
from martweave.sources.files import rows_per_file, write_bounded, write_chunks

_LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
               "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few dates and many lines: the leading value alone would not split the table."""
    return ordering.row_index(table(spark, sf_dir, "lineitem"), _LINE_ORDER)


def row_index_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    orders = orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return ordering.row_index(orders, ["o_orderdate", "o_orderkey"], ["o_orderstatus", "o_orderpriority"])


def row_index_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three flags order the whole table; each must own one unbroken run of numbers."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    indexed = ordering.row_index(lines, ["l_returnflag"], unique=False)
    return indexed.groupBy("l_returnflag").agg(
        F.min("row_index").alias("first_index"),
        F.max("row_index").alias("last_index"),
        F.count_distinct("row_index").alias("numbers"),
    )


def chunk_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.chunk_ids(table(spark, sf_dir, "orders"), ["o_orderkey"], 1000)


_CHUNK_BYTES = 30_000


def chunk_ids_by_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents in chunks of bounded size; some are larger than the bound."""
    documents = table(spark, sf_dir, "documents").select("source", "doc_id", "lang", "text")
    chunked = ordering.chunk_ids_by_bytes(documents, ["source", "doc_id"], _CHUNK_BYTES)
    return chunked.select("source", "doc_id", "chunk_id")


def stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of the orders by price, read one after the other from the stored pages."""
    path = scratch_path(spark, "pages")
    orders = table(spark, sf_dir, "orders")
    n = orders.count()
    store_pages(orders, path, ["o_totalprice", "o_orderkey"], rows_per_file=-(-n // 20))
    size = -(-n // 12)
    pages = [read_page(spark, path, k * size, size).withColumn("page", F.lit(k)) for k in range(12)]
    return reduce(DataFrame.unionByName, pages).withColumnRenamed("_row", "row_index")


def batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.batch_ids(table(spark, sf_dir, "customer"), ["c_name"], batches=10)


def chunk_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunked = ordering.chunk_ids(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"], 5000)
    return ordering.chunk_actions(chunked)


def ordered_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty pieces, however large the table."""
    path = scratch_path(spark, "chunks")
    part = table(spark, sf_dir, "part")
    write_chunks(part, path, ["p_partkey"], -(-part.count() // 20))
    pieces = spark.read.parquet(path).groupBy(F.col("chunk_id").cast("bigint").alias("chunk_id"))
    return pieces.agg(
        F.count(F.lit(1)).alias("chunk_rows"),
        F.min("p_partkey").alias("first_key"),
        F.max("p_partkey").alias("last_key"),
    )


def bounded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of at most a fifteenth of the table each."""
    path = scratch_path(spark, "bounded")
    orders = table(spark, sf_dir, "orders")
    bound = orders.count() // 15
    write_bounded(orders, path, bound)
    return rows_per_file(spark.read.parquet(path)).agg(
        (F.max("file_rows") <= bound).alias("within_bound"), F.sum("file_rows").alias("row_count")
    )


def shallow_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.page(table(spark, sf_dir, "orders"), ["o_orderkey"], 2000, 500)


def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    indexed = ordering.row_index(table(spark, sf_dir, "events"), ["ts", "event_id"])
    last = indexed.agg(F.max("row_index"))
    return indexed.where(F.col("row_index") > last.scalar() - 500)


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordering.preview(table(spark, sf_dir, "lineitem"), _LINE_ORDER)


QUERIES = {
    "row_index": (
        row_index,
        f"SELECT *, row_number() OVER (ORDER BY {', '.join(_LINE_ORDER)}) AS row_index FROM lineitem",
    ),
    "row_index_per_group": (
        row_index_per_group,
        """SELECT o_orderkey, o_orderdate, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
        row_number() OVER (PARTITION BY o_orderstatus, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS row_index
        FROM orders""",
    ),
    "row_index_ties": (
        row_index_ties,
        """SELECT l_returnflag, min(i) AS first_index, max(i) AS last_index, count(DISTINCT i) AS numbers
        FROM (SELECT l_returnflag, row_number() OVER (ORDER BY l_returnflag) AS i FROM lineitem) GROUP BY 1""",
    ),
    "chunk_ids": (
        chunk_ids,
        "SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS chunk_id FROM orders",
    ),
    "chunk_ids_by_bytes": (
        chunk_ids_by_bytes,
        f"""WITH sized AS (
            SELECT source, doc_id, 4 + coalesce(strlen(source), 0) + strlen(doc_id::VARCHAR) + coalesce(strlen(lang), 0) + coalesce(strlen(text), 0) AS size
            FROM documents),
        placed AS (
            SELECT *, size * 2 > {_CHUNK_BYTES} AS heavy, sum(size) OVER w - size AS start,
                2 * count(*) FILTER (size * 2 > {_CHUNK_BYTES}) OVER w - (size * 2 > {_CHUNK_BYTES})::INT AS run
            FROM sized WINDOW w AS (ORDER BY source NULLS FIRST, doc_id ROWS UNBOUNDED PRECEDING)),
        most AS (
            SELECT *, start // {32 * _CHUNK_BYTES} AS stretch,
                coalesce(max(CASE WHEN NOT heavy THEN size END) OVER (PARTITION BY start // {32 * _CHUNK_BYTES}), 0) AS most
            FROM placed)
        SELECT source, doc_id, dense_rank() OVER (ORDER BY stretch, run, (start - stretch * {32 * _CHUNK_BYTES}) // ({_CHUNK_BYTES} - most)) - 1 AS chunk_id
        FROM most""",
    ),
    "stored_pages": (
        stored_pages,
        """SELECT *, CAST((row_index - 1) // ((SELECT count(*) + 11 FROM orders) // 12) AS INTEGER) AS page
        FROM (SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS row_index FROM orders)""",
    ),
    "batch_ids": (
        batch_ids,
        """SELECT *, (row_number() OVER (ORDER BY c_name) - 1) // ((SELECT count(*) + 9 FROM customer) // 10)
        AS batch_id FROM customer""",
    ),
    "chunk_actions": (
        chunk_actions,
        """SELECT o_orderkey, chunk_id, CASE WHEN chunk_id = 0 THEN 'replace' ELSE 'insert' END AS action
        FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 5000 AS chunk_id FROM orders)""",
    ),
    "ordered_chunks": (
        ordered_chunks,
        """SELECT chunk_id, count(*) AS chunk_rows, min(p_partkey) AS first_key, max(p_partkey) AS last_key
        FROM (SELECT p_partkey, (row_number() OVER (ORDER BY p_partkey) - 1) // ((SELECT count(*) + 19 FROM part) // 20)
            AS chunk_id FROM part)
        GROUP BY 1""",
    ),
    "bounded_files": (bounded_files, "SELECT true AS within_bound, count(*) AS row_count FROM orders"),
    "page": (shallow_page, "SELECT * FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 2000"),
    "last_page": (
        deep_page,
        """SELECT * FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS row_index FROM events)
        WHERE row_index > (SELECT count(*) - 500 FROM events)""",
    ),
    "preview": (preview, f"SELECT * FROM lineitem ORDER BY {', '.join(_LINE_ORDER)} LIMIT 5"),
}
