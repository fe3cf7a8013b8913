"""Key checks, schema comparison, counts, checksums and comparison of copies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.operators import keys, verify
from martweave.operators.schema_diff import schema_diff, schema_diff_by_table
from martweave.plans.hash_tree import diff_stored, store_with_digests
from martweave.queries.inputs import TABLES, checksum_sql, good_customers, moment, table
from martweave.queries.mart import CUSTOMER_FK
from martweave.session import scratch_path
from martweave.sources.extracts import list_catalog_columns, list_columns, profile_columns


def _orders_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey"))
    )


def pk_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.with_key(_orders_with_gaps(spark, sf_dir), ["o_orderkey", "o_custkey"])


def pk_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.without_key(_orders_with_gaps(spark, sf_dir), ["o_orderkey", "o_custkey"]).drop("o_custkey")


def fk_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.fk_valid(_orders_with_gaps(spark, sf_dir), good_customers(spark, sf_dir), CUSTOMER_FK)


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.fk_orphans(_orders_with_gaps(spark, sf_dir), good_customers(spark, sf_dir), CUSTOMER_FK)


def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.row_counts({name: table(spark, sf_dir, name) for name in TABLES})


def table_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"]
    checksum = verify.portable_checksum(lineitem, columns)
    return checksum.select("row_count", F.col("checksum").cast("string").alias("checksum"))


def copies_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per key bucket, whether a reshuffled copy has the checksum of the original; one price differs by status."""
    orders = table(spark, sf_dir, "orders")
    copy = orders.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "P", -F.col("o_totalprice"))
                             .otherwise(F.col("o_totalprice")))
    halves = {True: orders, False: copy}
    per_status = [
        df.groupBy("o_orderstatus").agg(*verify.checksum_aggregates(orders.columns)).withColumn("original", F.lit(flag))
        for flag, df in halves.items()
    ]
    return (
        reduce(DataFrame.unionByName, per_status)
        .groupBy("o_orderstatus")
        .agg(
            F.max("row_count").alias("row_count"),
            (F.count_distinct("row_count", "checksum") == 1).alias("same_content"),
        )
    )


def row_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    left = orders.where(F.col("o_orderdate") < moment("2001-01-01"))
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    right = orders.where(F.col("o_orderdate") >= moment("1996-01-01")).withColumn("o_totalprice", price)
    return verify.row_diff(left, right, ["o_orderkey"])


def row_diff_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per order against the lines that were not returned: keys repeat on both sides."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    return verify.row_diff(lines, lines.where("l_returnflag <> 'R'"), ["l_orderkey"])


def stored_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored copies of the orders, compared through their digest trees; few rows differ."""
    orders = table(spark, sf_dir, "orders")
    copy = orders.where("o_totalprice < 470000").withColumn("o_orderstatus", F.when(F.col("o_totalprice") < 1500, "X").otherwise(F.col("o_orderstatus")))
    paths = [scratch_path(spark, "digested") for _ in range(2)]
    for df, path in zip((orders, copy), paths, strict=True):
        store_with_digests(df, path, ["o_orderkey"], fanout=4, depth=3)
    return diff_stored(spark, *paths, ["o_orderkey"]).rows


def schema_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of all tables, from the frames and from a catalogue; no rows are read."""
    tables = {name: table(spark, sf_dir, name) for name in TABLES}
    database = scratch_path(spark, "listing").rsplit("/", 1)[1].replace("-", "_")
    spark.sql(f"CREATE DATABASE {database}")
    for name in tables:
        spark.sql(f"CREATE TABLE {database}.{name} USING parquet LOCATION '{sf_dir}/{name}.parquet'")
    listed = list_columns(spark, tables).unionByName(list_catalog_columns(spark, database))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return listed.withColumn("schema", F.when(F.col("schema") == database, "catalogue").otherwise(F.col("schema")))


_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "TIMESTAMP": "timestamp_ntz", "FLOAT[]": "array<float>"}
_TYPE_SQL = "CASE column_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _TYPES.items()) + " END"
_SCHEMA_SQL = " UNION ALL ".join(
    f"""SELECT '{schema}' AS "schema", '{name}' AS "table", CAST(row_number() OVER () AS INTEGER) AS position, column_name AS "column", {_TYPE_SQL} AS type, true AS nullable
    FROM (DESCRIBE {name})"""
    for schema in ("public", "catalogue")
    for name in TABLES
)


def processed_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return verify.unprocessed(documents, table(spark, sf_dir, "labels"), ["doc_id"])


def lookup_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.lookup_one(table(spark, sf_dir, "customer"), F.col("c_name") == "Customer#000000042")


def catalog_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [profile_columns(table(spark, sf_dir, name), name) for name in TABLES])


def _observed_columns(events: DataFrame) -> DataFrame:
    """Column listing observed in event properties: one schema per event type, one table per user."""
    kind = F.when(F.col("value") < 5, "INT").when(F.col("value") < 60, "DOUBLE").otherwise("TEXT")
    found = events.select(
        F.col("event_type").alias("schema"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("table"),
        F.explode(F.from_json("props", "map<string,int>")).alias("key", "number"),
        kind.alias("type"),
    )
    column = F.concat_ws("_", "key", F.col("number").cast("string")).alias("column")
    return found.groupBy("schema", "table", column).agg(F.max("type").alias("type"))


def _listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    events = table(spark, sf_dir, "events")
    first_half = F.col("ts") < moment("2024-01-16")
    return _observed_columns(events.where(first_half)), _observed_columns(events.where(~first_half))


def schema_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_diff(*_listings(spark, sf_dir))


def schema_comparison_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_table = schema_diff_by_table(*_listings(spark, sf_dir))
    lists = ("missing_columns", "different_data_types", "source_only_content")
    return per_table.select(
        "schema",
        "table",
        *[F.array_join(F.transform(c, lambda item: item["column"]), ",").alias(c) for c in lists],
    )


_ORDERS_WITH_GAPS = """SELECT * REPLACE (CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS o_custkey)
    FROM orders"""
_GOOD = "SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal >= 0"

_COLUMN_TYPES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _listing_sql() -> str:
    selects = []
    for name, columns in _COLUMN_TYPES.items():
        for position, column in enumerate(columns.split(", "), start=1):
            label, kind = column.split(" ")
            selects.append(
                f"""SELECT '{name}' AS "table", count(*) AS row_count, {position} AS position, '{label}' AS "column",
                '{kind}' AS "type", count(*) - count({label}) AS null_count FROM {name}"""
            )
    return " UNION ALL ".join(selects)


def _observed_sql(condition: str) -> str:
    return f"""SELECT event_type AS "schema", 'user_' || CAST(user_id AS VARCHAR) AS "table",
        'k_' || (props ->> '$.k') AS "column",
        max(CASE WHEN value < 5 THEN 'INT' WHEN value < 60 THEN 'DOUBLE' ELSE 'TEXT' END) AS "type"
        FROM events WHERE {condition} GROUP BY ALL"""


_COMPARED = f"""WITH src AS ({_observed_sql("ts < TIMESTAMP '2024-01-16'")}),
    tgt AS ({_observed_sql("ts >= TIMESTAMP '2024-01-16'")}),
    known AS (SELECT DISTINCT "schema", "table" FROM tgt),
    compared AS (SELECT s."schema", s."table", s."column", s."type" AS source_type, t."type" AS target_type,
        CASE WHEN k."table" IS NULL THEN 'source_only' WHEN t."type" IS NULL THEN 'missing_column'
            WHEN t."type" <> s."type" THEN 'type_differs' ELSE 'same' END AS status
        FROM src s LEFT JOIN tgt t ON s."schema" = t."schema" AND s."table" = t."table" AND s."column" = t."column"
        LEFT JOIN known k ON s."schema" = k."schema" AND s."table" = k."table")"""


def _listed_sql(status: str, name: str) -> str:
    return f"""coalesce(string_agg("column", ',' ORDER BY "column") FILTER (WHERE status = '{status}'), '') AS {name}"""


_CHECKED = "l_orderkey l_partkey l_suppkey l_linenumber l_returnflag l_linestatus".split()

QUERIES = {
    "pk_filter": (pk_filter, f"SELECT * FROM ({_ORDERS_WITH_GAPS}) WHERE o_custkey IS NOT NULL"),
    "pk_missing": (
        pk_missing,
        f"SELECT * EXCLUDE (o_custkey) FROM ({_ORDERS_WITH_GAPS}) WHERE o_custkey IS NULL",
    ),
    "fk_valid": (fk_valid, f"SELECT * FROM ({_ORDERS_WITH_GAPS}) WHERE EXISTS ({_GOOD})"),
    "fk_orphans": (fk_orphans, f"SELECT * FROM ({_ORDERS_WITH_GAPS}) WHERE NOT EXISTS ({_GOOD})"),
    "row_counts": (
        row_counts,
        " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in TABLES),
    ),
    "table_checksum": (
        table_checksum,
        f"SELECT count(*) AS row_count, {checksum_sql(_CHECKED)} AS checksum FROM lineitem",
    ),
    "copies_agree": (
        copies_agree,
        "SELECT o_orderstatus, count(*) AS row_count, o_orderstatus <> 'P' AS same_content FROM orders GROUP BY 1",
    ),
    "row_diff": (
        row_diff,
        """SELECT o_orderkey, CAST(o_orderdate < TIMESTAMP '2001-01-01' AS BIGINT) AS left_rows,
        CAST(o_orderdate >= TIMESTAMP '1996-01-01' AS BIGINT) AS right_rows,
        CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'only_left'
            WHEN o_orderdate >= TIMESTAMP '2001-01-01' THEN 'only_right'
            WHEN o_orderpriority = '1-URGENT' THEN 'changed' ELSE 'equal' END AS status FROM orders""",
    ),
    "row_diff_repeated_keys": (
        row_diff_repeated_keys,
        """SELECT l_orderkey, count(*) AS left_rows, count(*) FILTER (WHERE l_returnflag <> 'R') AS right_rows,
        CASE WHEN count(*) FILTER (WHERE l_returnflag <> 'R') = 0 THEN 'only_left'
            WHEN count(*) FILTER (WHERE l_returnflag = 'R') > 0 THEN 'changed' ELSE 'equal' END AS status
        FROM lineitem GROUP BY 1""",
    ),
    "stored_diff": (
        stored_diff,
        """SELECT o_orderkey, 1::BIGINT AS left_rows, (o_totalprice < 470000)::BIGINT AS right_rows,
        CASE WHEN o_totalprice < 470000 THEN 'changed' ELSE 'only_left' END AS status FROM orders WHERE o_totalprice >= 470000 OR o_totalprice < 1500""",
    ),
    "schema_listing": (schema_listing, _SCHEMA_SQL),
    "processed_anti": (
        processed_anti,
        """SELECT doc_id, lang, source, n_chars FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    ),
    "lookup_one": (lookup_one, "SELECT * FROM customer WHERE c_name = 'Customer#000000042'"),
    "catalog_listing": (catalog_listing, _listing_sql()),
    "schema_diff": (
        schema_comparison,
        f"""{_COMPARED} SELECT * FROM compared WHERE status <> 'same'""",
    ),
    "schema_diff_by_table": (
        schema_comparison_by_table,
        f"""{_COMPARED} SELECT "schema", "table", {_listed_sql("missing_column", "missing_columns")},
        {_listed_sql("type_differs", "different_data_types")}, {_listed_sql("source_only", "source_only_content")}
        FROM compared GROUP BY 1, 2""",
    ),
}
