"""Projection, conforming and table-load queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

from martweave.functions.scalars import path_name, path_stem, stage_path
from martweave.model import TableSpec
from martweave.operators.actions import add_column, fill_default
from martweave.operators.conform import add_load_time, add_prefixed, conform, conform_to_table, output_schema, select_as
from martweave.operators.keys import null_counts
from martweave.queries.inputs import table
from martweave.session import scratch_path
from martweave.sources import tables as catalog

ORDER_MART = StructType(
    [
        StructField("order_id", LongType()),
        StructField("customer_id", IntegerType()),
        StructField("price", DoubleType()),
        StructField("clerk", StringType()),
        StructField("ordered_at", TimestampNTZType()),
    ]
)


def conform_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {
        "O_ORDERKEY": "order_id",
        "o_custkey": "customer_id",
        "o_totalprice": "price",
        "o_orderdate": "ordered_at",
    }
    return conform(table(spark, sf_dir, "orders"), ORDER_MART, mapping)


def conform_uncastable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events carry text where the target wants a number."""
    code = F.when(F.col("event_type") == "error", "E").otherwise(F.col("user_id").cast("string"))
    target = StructType(
        [
            StructField("event_id", LongType()),
            StructField("user_id", StringType()),
            StructField("code", IntegerType()),
            StructField("value", IntegerType()),
        ]
    )
    return conform(table(spark, sf_dir, "events").withColumn("code", code), target, on_error="null")


def select_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {"customer_id": "c_custkey", "customer_name": "c_name", "segment": F.lower("c_mktsegment")}
    return select_as(table(spark, sf_dir, "customer"), columns)


def load_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_load_time(table(spark, sf_dir, "supplier"), "loaded_at", as_of="2024-03-10 12:30:00")


def prefix_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    return add_prefixed(part, "prefixed_type", "prefix_", "p_type")


def fill_default_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    gaps = customer.select(
        "c_custkey",
        F.nullif("c_mktsegment", F.lit("HOUSEHOLD")).alias("c_mktsegment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("c_nationkey"),
    )
    return fill_default(gaps, ["c_mktsegment", "c_nationkey"], 0)


def add_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_size")).alias("p_size"))
    part = add_column(part, "new_text_column", "string")
    part = add_column(part, "new_integer_column", "bigint", default=0)
    return add_column(part, "p_size", "bigint", default=0)


def output_definition(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_totalprice") >= 1000, F.col("o_custkey"))
    )
    spec = TableSpec("orders", ("o_orderkey", "o_custkey"))
    required = [f.name for f in output_schema(orders.schema, spec).fields if not f.nullable]
    return orders.agg(F.count(F.lit(1)).alias("row_count"), *null_counts(orders, required))


def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        path_name(url).alias("file_name"),
        path_stem(url).alias("file_stem"),
        stage_path(F.lit("extract"), "started", path_stem(url)).alias("stage_path"),
    )


def _fresh_table(spark: SparkSession, schema: StructType, partition_by: list[str], file_format: str) -> str:
    path = scratch_path(spark, "table")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    catalog.create_table(spark, name, schema, partition_by, file_format, path)
    return name


def orc_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    name = _fresh_table(spark, orders.schema, ["o_orderstatus"], "orc")
    catalog.append_to_table(orders, name, cluster=False)
    return spark.table(name)


def append_month_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    schema = StructType(
        [
            StructField("o_orderkey", LongType()),
            StructField("o_totalprice", DoubleType()),
            StructField("comment", StringType()),
            StructField("year", IntegerType()),
            StructField("month", IntegerType()),
        ]
    )
    name = _fresh_table(spark, schema, ["year", "month"], "parquet")
    old = F.col("year") < 2000
    catalog.append_to_table(conform_to_table(spark, orders.where(old), name), name)
    catalog.append_to_table(orders.where(~old), name)
    return spark.table(name)


def overwrite_present_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    name = _fresh_table(spark, orders.schema, ["o_orderpriority"], "orc")
    catalog.append_to_table(orders, name, cluster=False)
    urgent = orders.where("o_orderpriority IN ('1-URGENT', '2-HIGH')").where("o_totalprice >= 100000")
    catalog.overwrite_table_partitions(urgent, name, cluster=False)
    return spark.table(name)


def rename_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    name = _fresh_table(spark, supplier.schema, [], "parquet")
    catalog.append_to_table(supplier, name)
    catalog.rename_table(spark, name, f"{name}_renamed")
    catalog.add_table_column(spark, f"{name}_renamed", "note", "string")
    return spark.table(f"{name}_renamed")


def batched_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    name = _fresh_table(spark, customer.schema, ["c_mktsegment"], "parquet")
    catalog.load_batches(customer, name, ["c_custkey"], batches=10, cluster=False)
    return spark.table(name)


QUERIES = {
    "conform_orders": (
        conform_orders,
        """SELECT o_orderkey AS order_id, CAST(o_custkey AS INTEGER) AS customer_id, o_totalprice AS price,
        CAST(NULL AS VARCHAR) AS clerk, o_orderdate AS ordered_at FROM orders""",
    ),
    "conform_uncastable": (
        conform_uncastable,
        """SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CASE WHEN event_type <> 'error' THEN CAST(user_id AS INTEGER) END AS code,
        CAST(trunc(value) AS INTEGER) AS value FROM events""",
    ),
    "select_alias": (
        select_alias,
        "SELECT c_custkey AS customer_id, c_name AS customer_name, lower(c_mktsegment) AS segment FROM customer",
    ),
    "load_stamp": (load_stamp, "SELECT *, TIMESTAMP '2024-03-10 12:30:00' AS loaded_at FROM supplier"),
    "prefix_part": (
        prefix_part,
        """SELECT p_partkey, nullif(p_type, 'PROMO') AS p_type, 'prefix_' || nullif(p_type, 'PROMO') AS prefixed_type
        FROM part""",
    ),
    "fill_default": (
        fill_default_segment,
        """SELECT c_custkey, coalesce(nullif(c_mktsegment, 'HOUSEHOLD'), '0') AS c_mktsegment,
        CASE WHEN c_acctbal >= 0 THEN c_nationkey ELSE 0 END AS c_nationkey FROM customer""",
    ),
    "add_required": (
        add_required,
        """SELECT p_partkey, CAST(CASE WHEN p_size > 10 THEN p_size ELSE 0 END AS BIGINT) AS p_size,
        CAST(NULL AS VARCHAR) AS new_text_column, CAST(0 AS BIGINT) AS new_integer_column FROM part""",
    ),
    "output_schema": (
        output_definition,
        """SELECT count(*) AS row_count, count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey_nulls,
        count(*) FILTER (WHERE o_totalprice < 1000) AS o_custkey_nulls FROM orders""",
    ),
    "path_parts": (
        path_parts,
        """SELECT page_id, file_name, regexp_replace(file_name, '(.)\\.[^.]*$', '\\1') AS file_stem,
        'extract.started/' || regexp_replace(file_name, '(.)\\.[^.]*$', '\\1') AS stage_path
        FROM (SELECT page_id, regexp_extract(url, '([^/?#]*)/?([?#].*)?$', 1) AS file_name FROM pages)""",
    ),
    "orc_partitioned": (orc_partitioned, "SELECT * FROM orders"),
    "append_month_partitions": (
        append_month_partitions,
        """SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS comment, CAST(year(o_orderdate) AS INTEGER) AS year,
        CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""",
    ),
    "dyn_overwrite": (
        overwrite_present_partitions,
        """SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders
        WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') OR o_totalprice >= 100000""",
    ),
    "rename_table": (rename_table, "SELECT *, CAST(NULL AS VARCHAR) AS note FROM supplier"),
    "batched_load": (batched_load, "SELECT * FROM customer"),
}
