"""File sources and sinks: CSV, delimited text, plain text, split extracts, inventories and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.functions.scalars import log_line
from martweave.operators.backlog import outcome_totals, run_summary
from martweave.operators.verify import reconcile_files
from martweave.plans.publish import new_run_id
from martweave.queries.inputs import table
from martweave.session import delete_path, scratch_path
from martweave.sources import extracts
from martweave.sources import files as io


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "csv")
    io.write_csv(customer, path)
    return io.read_csv(spark, path, customer.schema)


def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    io.write_csv(table(spark, sf_dir, "part"), path)
    return io.read_csv(spark, path).withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


def delimited_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    path = scratch_path(spark, "delimited")
    io.write_delimited(supplier, path)
    return io.read_delimited(spark, path, supplier.schema)


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all documents by length. A document spans as many lines as it has line breaks."""
    path = scratch_path(spark, "lines")
    table(spark, sf_dir, "documents").select("text").write.text(path)
    lines = io.read_lines(spark, path)
    return lines.groupBy(F.length("value").alias("n_chars")).agg(F.count(F.lit(1)).alias("line_count"))


_SAMPLES = (None, "", ' "two", lines\r\nof, ', "plain", 'ends in "', "\\", "\t|")


def csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as CSV and back, each beside a text of quotes, separators, line breaks, blanks, NULL or nothing."""
    samples = F.array(*[F.lit(s) for s in _SAMPLES])
    documents = table(spark, sf_dir, "documents").withColumn("sample", samples[F.pmod(F.col("doc_id"), F.lit(len(_SAMPLES))).cast("int")])
    path = scratch_path(spark, "csv")
    io.write_csv(documents, path)
    return io.read_csv(spark, path, documents.schema, multi_line=True)


def _split_orders(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "extract")
    orders = table(spark, sf_dir, "orders")
    for status in ("F", "O", "P"):
        extracts.write_table(orders.where(F.col("o_orderstatus") == status), root, f"orders_{status}")
    return root


def split_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracts.read_pieces(spark, f"{_split_orders(spark, sf_dir)}/public/orders_*")


def first_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracts.first_table(spark, _split_orders(spark, sf_dir))


def collection_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables and rows per extract schema."""
    pieces = extracts.read_pieces(spark, f"{_split_orders(spark, sf_dir)}/public/orders_*")
    return pieces.groupBy("piece").agg(F.count(F.lit(1)).alias("row_count"))


def _run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log line per event; errors are failures, views are starts. Each error adds an impossible moment and a trace line."""
    status = (
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "started")
        .otherwise("succeeded")
    )
    name = F.concat(F.lit("script_"), F.col("user_id").cast("string"), F.lit(".sh"))
    path = scratch_path(spark, "run-log")
    events = table(spark, sf_dir, "events")
    lines = events.select(log_line(F.col("ts"), name, status).alias("value"))
    errors = events.where("event_type = 'error'")
    broken = errors.select(F.concat(F.lit("2024-13-45 00:00:00 - "), name, F.lit(": failed")).alias("value"))
    other = errors.select(F.concat(F.lit("  at line "), F.col("event_id").cast("string")).alias("value"))
    lines.unionByName(broken).unionByName(other).write.text(path)
    return io.read_lines(spark, path)


def log_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(_run_log(spark, sf_dir))


def log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of two appended runs: orders that were finished, and all others."""
    path = scratch_path(spark, "log")
    orders = table(spark, sf_dir, "orders")
    finished = F.col("o_orderstatus") == "F"
    for chosen, status in ((finished, "succeeded"), (~finished, "failed")):
        run = orders.where(chosen).select(
            F.col("o_orderdate").alias("ts"),
            F.lit(new_run_id()).alias("run_id"),
            F.col("o_orderkey").cast("string").alias("name"),
            F.lit(status).alias("status"),
        )
        io.append_log(run, path)
    return outcome_totals(spark.read.parquet(path))


def _page_files(spark: SparkSession, pages: DataFrame, purpose: str) -> DataFrame:
    """The pages written as one text file each, and the inventory of these files, named by page. The files go once they are hashed."""
    path = scratch_path(spark, purpose)
    files = io.file_inventory(spark, io.write_files(pages, path, "page_id", "html"), recursive=True, hashed=True)
    delete_path(spark, path)
    page = F.regexp_extract("path", r"page_id=([0-9]+)[/.]", 1)
    return files.withColumn("name", F.concat(F.lit("page_"), page))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files on disk with lengths and hashes; the size guard refuses those beyond its bounds and hashes them all the same."""
    files = _page_files(spark, table(spark, sf_dir, "pages"), "pages")
    reason = io.size_reason(min_bytes=500, max_bytes=1500)
    return io.by_name(files).select("name", "length", "md5", reason.alias("reason"))


def copy_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders of files: the copy lacks the pages with a fragment and has altered those without TLS, length kept."""
    pages = table(spark, sf_dir, "pages")
    altered = F.when(F.startswith("url", F.lit("http:")), F.concat(F.lit("#"), F.substring("html", 2, 1 << 30))).otherwise(F.col("html"))
    copied = pages.where(~F.contains("url", F.lit("#"))).withColumn("html", altered)
    return reconcile_files(_page_files(spark, pages, "pages"), _page_files(spark, copied, "copy"))


QUERIES = {
    "csv_roundtrip": (csv_roundtrip, "SELECT * FROM customer"),
    "csv_documents": (
        csv_documents,
        """SELECT *, CASE doc_id % 7 WHEN 1 THEN '' WHEN 2 THEN ' "two", lines' || chr(13) || chr(10) || 'of, '
        WHEN 3 THEN 'plain' WHEN 4 THEN 'ends in "' WHEN 5 THEN chr(92) WHEN 6 THEN chr(9) || '|' END AS sample FROM documents""",
    ),
    "csv_inferred": (csv_inferred, "SELECT * FROM part"),
    "delimited_scan": (delimited_scan, "SELECT * FROM supplier"),
    "text_lines": (
        text_lines,
        """SELECT CAST(length(line) AS INTEGER) AS n_chars, count(*) AS line_count
        FROM (SELECT unnest(string_split_regex(text, '\\r\\n|\\n|\\r')) AS line FROM documents)
        GROUP BY 1""",
    ),
    "split_scan": (split_scan, "SELECT *, 'orders_' || o_orderstatus AS piece FROM orders"),
    "first_table": (first_table, "SELECT * FROM orders WHERE o_orderstatus = 'F'"),
    "collection_sizes": (
        collection_sizes,
        "SELECT 'orders_' || o_orderstatus AS piece, count(*) AS row_count FROM orders GROUP BY 1",
    ),
    "run_summary": (
        log_summary,
        """SELECT CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'started' ELSE 'succeeded' END AS status,
        count(*) AS runs, date_trunc('second', min(ts)) AS first_ts, date_trunc('second', max(ts)) AS last_ts
        FROM events GROUP BY 1
        UNION ALL SELECT 'unparsed', 2 * count(*), NULL, NULL FROM events WHERE event_type = 'error'""",
    ),
    "run_log": (
        log_append,
        """SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS successful,
        count(*) FILTER (WHERE o_orderstatus <> 'F') AS failed FROM orders""",
    ),
    "file_inventory": (
        file_inventory,
        """SELECT 'page_' || CAST(page_id AS VARCHAR) AS name, CAST(strlen(html) + 1 AS BIGINT) AS length,
        md5(html || chr(10)) AS md5,
        CASE WHEN strlen(html) + 1 < 500 THEN 'too small' WHEN strlen(html) + 1 > 1500 THEN 'too large' END AS reason FROM pages""",
    ),
    "copy_reconcile": (
        copy_reconcile,
        """SELECT 'page_' || CAST(page_id AS VARCHAR) AS name, CAST(1 AS BIGINT) AS left_rows,
        CAST(NOT contains(url, '#') AS BIGINT) AS right_rows,
        CASE WHEN contains(url, '#') THEN 'only_left' WHEN starts_with(url, 'http:') THEN 'changed' ELSE 'equal' END
        AS status FROM pages""",
    ),
}
