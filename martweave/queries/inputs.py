"""Inputs shared by the queries, as frames and as the SQL that derives the same rows.

The tables hold no NULLs and no orphans, so the queries make some from attribute values.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

AS_OF = dt.datetime(2001, 8, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


# The mart holds orders up to June 2001. May, June and later orders arrive with new prices.
def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").where(F.col("o_orderdate") < moment("2001-07-01"))


def arriving_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= moment("2001-05-01"))
    return orders.withColumn("o_totalprice", F.col("o_totalprice") + 100).withColumn("o_orderstatus", F.lit("U"))


STORED_ORDERS = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-01'"
ARRIVING_ORDERS = """SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice + 100 AS o_totalprice,
    o_orderdate, o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '2001-05-01'"""
UPSERTED_ORDERS = f"""WITH arriving AS ({ARRIVING_ORDERS}), stored AS ({STORED_ORDERS})
    SELECT * FROM arriving UNION ALL
    SELECT * FROM stored s WHERE NOT EXISTS (SELECT 1 FROM arriving a WHERE a.o_orderkey = s.o_orderkey)"""


# Customers in good standing; orders of the others have no dimension row.
def good_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)


# Jobs: one per event. The event type decides the marker in the name, the value the stage.
def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    marker = F.when(F.col("event_type") == "error", "DLE_").when(F.col("event_type") == "purchase", "load_MR_")
    stage = F.when(F.col("value") < 10, "extract").when(F.col("value") < 40, "hyper").otherwise("publish")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.concat(marker.otherwise("job_"), F.col("event_id").cast("string")).alias("name"),
        "ts",
        stage.alias("stage"),
    )


JOBS = """SELECT event_id, user_id,
    CASE event_type WHEN 'error' THEN 'DLE_' WHEN 'purchase' THEN 'load_MR_' ELSE 'job_' END
        || CAST(event_id AS VARCHAR) AS name,
    ts,
    CASE WHEN value < 10 THEN 'extract' WHEN value < 40 THEN 'hyper' ELSE 'publish' END AS stage
    FROM events"""
RANKED_JOBS = f"""SELECT *, CASE WHEN contains(name, 'DLE') THEN 1 WHEN contains(name, '_MR_') THEN 2 ELSE 3 END
    AS priority FROM ({JOBS})"""


def checksum_sql(columns) -> str:
    """SQL of ``verify.portable_checksum`` over the same columns, as text."""
    lengths = ", ".join(f"coalesce(CAST(length({c}::VARCHAR) AS VARCHAR), 'N')" for c in columns)
    values = ", ".join(f"{c}::VARCHAR" for c in columns)
    text = f"concat_ws(',', {lengths}) || ':' || concat({values})"
    return f"CAST(sum(CAST('0x' || substr(md5({text}), 1, 8) AS BIGINT)) AS VARCHAR)"
