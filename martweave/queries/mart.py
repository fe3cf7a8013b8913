"""Table actions, merging and publishing."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martweave.functions.scalars import days_before
from martweave.model import FACT, ForeignKey, TableAction, TableSpec
from martweave.operators import actions, verify
from martweave.operators.keys import check_keys, fk_valid, with_key
from martweave.plans.key_index import update_key_index
from martweave.plans.mart import refresh_mart
from martweave.plans.merge import MergeResult, merge_extracts
from martweave.plans.partitions import delete_from_partitions, upsert_partitions
from martweave.plans.publish import apply_actions, apply_pieces, new_run_id, publish_release, read_published
from martweave.plans.staging import run_staged, stage_by_config
from martweave.queries.inputs import (
    checksum_sql,
    ARRIVING_ORDERS,
    AS_OF,
    STORED_ORDERS,
    UPSERTED_ORDERS,
    arriving_orders,
    good_customers,
    moment,
    stored_orders,
    table,
)
from martweave.session import parked, scratch_path
from martweave.sources.config import ENTRY_SCHEMA
from martweave.sources.extracts import read_split_extract, write_table
from martweave.sources.files import append_partitioned

CUSTOMER_FK = ForeignKey(("o_custkey",), "customer", ("c_custkey",))
_RETAIN_FROM = days_before(AS_OF)


def merged_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert the arriving orders into the stored ones, keep 60 days of the latter, add the customer.

    Nothing goes without a trace: arriving orders that are refused, and stored ones whose customer is gone, are there with
    their ``reject_reasons`` and without customer; the merged rows have none.
    """
    customers = good_customers(spark, sf_dir)
    spec = TableSpec("orders", ("o_orderkey",), (CUSTOMER_FK,), FACT)
    arriving = check_keys(arriving_orders(spark, sf_dir), spec, {"customer": customers})
    arriving = replace(arriving, marked=parked(arriving.marked, "arriving"))
    retained = actions.retain_days(stored_orders(spark, sf_dir), "o_orderdate", AS_OF)
    orders = actions.upsert(retained, arriving.accepted(), ["o_orderkey"])
    merged = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    gone = F.when(F.col("c_custkey").isNull(), "stored: no match in customer").otherwise("")
    refused = arriving.refused().withColumn("reject_reasons", F.concat(F.lit("arriving: "), F.concat_ws(", ", "reject_reasons")))
    rows = merged.withColumn("reject_reasons", gone).unionByName(refused, allowMissingColumns=True)
    return rows.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "c_custkey", "c_name", "c_mktsegment", "reject_reasons")


def delete_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "o_orderdate", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate"))
    )
    return actions.delete_where(orders, F.col("o_orderdate") < moment("1999-01-01"))


def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.retain_days(table(spark, sf_dir, "orders"), "o_orderdate", AS_OF)


def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions.upsert(stored_orders(spark, sf_dir), arriving_orders(spark, sf_dir), ["o_orderkey"])


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated source keys: the latest event of a user counts."""
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.lit(None).cast("timestamp_ntz").alias("ts"),
        F.lit(None).cast("bigint").alias("event_id"), F.lit("none").alias("event_type"), F.lit(0.0).alias("value"),
    )
    return actions.upsert(customers, events, ["user_id"], latest_by=["ts", "event_id"])


def replace_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    snapshot = good_customers(spark, sf_dir).withColumn("c_name", F.upper("c_name"))
    return actions.replace(stored, snapshot)


def append_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = arriving_orders(spark, sf_dir).drop("o_orderpriority")
    return actions.append(stored_orders(spark, sf_dir), recent)


def _star_actions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    steps = [
        TableAction("replace", "customer"),
        TableAction("replace", "nation"),
        TableAction("delete", "orders", condition="o_orderdate < TIMESTAMP_NTZ '1996-01-01 00:00:00'"),
        TableAction("upsert", "orders", keys=("o_orderkey",)),
        TableAction("append", "supplier"),
    ]
    targets = {"orders": stored_orders(spark, sf_dir)}
    targets |= {name: table(spark, sf_dir, name) for name in ("customer", "nation", "supplier")}
    sources = {
        "customer": good_customers(spark, sf_dir),
        "nation": table(spark, sf_dir, "nation"),
        "orders": arriving_orders(spark, sf_dir),
        "supplier": table(spark, sf_dir, "supplier").where("s_acctbal < 0"),
    }
    return apply_actions(targets, sources, steps)


#: Columns that tell rows apart and print alike everywhere; the status tells an arrived order from a stored one.
_STAR_COLUMNS = {
    "customer": ("c_custkey", "c_name", "c_mktsegment"),
    "nation": ("n_nationkey", "n_name"),
    "orders": ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"),
    "supplier": ("s_suppkey", "s_name"),
}


def _totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Count and content checksum of each table."""
    each = [
        verify.portable_checksum(df, _STAR_COLUMNS[name]).select(F.lit(name).alias("table_name"), "row_count", F.col("checksum").cast("string").alias("checksum"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, each)


def action_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _totals(_star_actions(spark, sf_dir))


def staged_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two releases: the stored tables, then the action list; read back from the second."""
    root = scratch_path(spark, "mart")
    by_status = {"orders": ["o_orderstatus"]}
    first = {"orders": stored_orders(spark, sf_dir), "supplier": table(spark, sf_dir, "supplier")}
    publish_release(spark, root, first, partition_by=by_status)
    changed = _star_actions(spark, sf_dir)
    del changed["supplier"]
    publish_release(spark, root, changed, partition_by=by_status)
    return _totals({name: read_published(spark, root, name) for name in _STAR_COLUMNS})


def staged_by_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage two facts and the dimensions they share by configuration, publish, drop the staging area."""
    roots = {mode: scratch_path(spark, mode) for mode in ("incremental", "full")}
    for name in ("orders", "lineitem"):
        write_table(table(spark, sf_dir, name), roots["incremental"], name)
    for name in ("customer", "part", "supplier", "region"):
        write_table(table(spark, sf_dir, name), roots["full"], name)
    # Orders are a fact of their own and what lines refer to, so they are staged in both modes.
    write_table(table(spark, sf_dir, "orders"), roots["full"], "orders")
    edges = {"orders": ["customer"], "lineitem": ["part", "supplier", "orders"], "events": []}
    entries = spark.createDataFrame([(f, [(d,) for d in dims]) for f, dims in edges.items()], ENTRY_SCHEMA)
    requested = spark.createDataFrame([("orders",), ("lineitem",)], "source_table string")

    staging, root = scratch_path(spark, "staging"), scratch_path(spark, "mart")
    staged = stage_by_config(spark, requested, entries, roots, staging, new_run_id(), f"{root}/log")
    release = run_staged(
        spark, staged, staging, lambda tables: publish_release(spark, root, {f"{mode}_{name}": df for (mode, name), df in tables.items()})
    )
    log = spark.read.parquet(f"{root}/log").select(F.concat_ws("_", "mode", "name").alias("table_name"), "status")
    return release.join(log, "table_name").select("table_name", "status", "row_count")


def split_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored tables replaced by three extracts of two tables each, split by status and segment."""
    root = scratch_path(spark, "split")
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    early = ("AUTOMOBILE", "BUILDING")
    parts = {
        "mart_1": (F.col("o_orderstatus") == "F", F.col("c_mktsegment").isin(*early)),
        "mart_2": (F.col("o_orderstatus") == "O", F.col("c_mktsegment") == "HOUSEHOLD"),
        "mart_3": (F.col("o_orderstatus") == "P", ~F.col("c_mktsegment").isin(*early, "HOUSEHOLD")),
    }
    for piece, (of_orders, of_customer) in parts.items():
        write_table(orders.where(of_orders), f"{root}/{piece}", "orders")
        write_table(customer.where(of_customer), f"{root}/{piece}", "customer")
    stored = {"orders": stored_orders(spark, sf_dir), "customer": good_customers(spark, sf_dir)}
    return _totals(apply_pieces(stored, read_split_extract(spark, f"{root}/mart_*")))


def mart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two refreshes: the stored orders create the mart, the arriving ones and a dimension snapshot update it."""
    root = scratch_path(spark, "mart")
    specs = [
        TableSpec("customer", ("c_custkey",)),
        TableSpec("orders", ("o_orderkey",), (CUSTOMER_FK,), FACT, partition_by=("o_orderstatus",)),
    ]
    everyone = table(spark, sf_dir, "customer")
    refresh_mart(spark, root, specs, {"customer": [everyone], "orders": [stored_orders(spark, sf_dir)]})
    arriving = {"customer": [good_customers(spark, sf_dir)], "orders": [arriving_orders(spark, sf_dir)]}
    expired = {"orders": "o_orderdate < TIMESTAMP_NTZ '1996-01-01 00:00:00'"}
    rejected = refresh_mart(spark, root, specs, arriving, conditions=expired).rejects["orders"]
    accepted = read_published(spark, root, "orders").withColumn("reject_reasons", F.lit(""))
    return accepted.unionByName(rejected.withColumn("reject_reasons", F.concat_ws(", ", "reject_reasons")))


def mart_key_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a refresh publishes and refuses when the snapshot repeats some customers and lacks others."""
    root = scratch_path(spark, "mart")
    specs = [TableSpec("customer", ("c_custkey",)), TableSpec("orders", ("o_orderkey",), (CUSTOMER_FK,), FACT)]
    refresh_mart(spark, root, specs, {"customer": [table(spark, sf_dir, "customer")], "orders": [stored_orders(spark, sf_dir)]})
    good = good_customers(spark, sf_dir)
    arriving = {"customer": [good, good.where("c_custkey % 50 = 0")], "orders": [arriving_orders(spark, sf_dir)]}
    rejects = refresh_mart(spark, root, specs, arriving).rejects
    result = None
    for name, key in (("customer", "c_custkey"), ("orders", "o_orderkey")):
        published = read_published(spark, root, name).select(F.lit(name).alias("table_name"), F.col(key).alias("key"), F.lit("").alias("reason"))
        refused = rejects[name].select(F.lit(name).alias("table_name"), F.col(key).alias("key"), F.concat_ws(", ", "reject_reasons").alias("reason"))
        both = published.unionByName(refused)
        result = both if result is None else result.unionByName(both)
    return result


def _merged(spark: SparkSession, sf_dir: str) -> MergeResult:
    """Three order extracts that differ in columns, column case and missing keys, and one dimension."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    status = F.col("o_orderstatus")
    open_orders = orders.where(status == "O").drop("o_orderstatus")
    partial = orders.where(status == "P").select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("O_ORDERKEY"),
        F.col("o_totalprice").alias("O_TOTALPRICE"),
        F.col("o_custkey").alias("O_CUSTKEY"),
    )
    finished = orders.where(status == "F").withColumn("extra", F.lit(1)).drop("o_orderstatus")
    specs = [
        TableSpec("orders", ("o_orderkey",), (CUSTOMER_FK,), FACT, open_orders.schema),
        TableSpec("customer", ("c_custkey",)),
    ]
    inputs = {"orders": [open_orders, partial, finished], "customer": [good_customers(spark, sf_dir)]}
    return merge_extracts(specs, inputs)


def merged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged(spark, sf_dir).tables["orders"]


def merge_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = _merged(spark, sf_dir).rejects["orders"]
    return rejected.withColumn("reject_reasons", F.concat_ws(", ", "reject_reasons"))


def _stored_by_year(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "orders-by-year")
    append_partitioned(stored_orders(spark, sf_dir).withColumn("order_year", F.year("o_orderdate")), path, ["order_year"])
    return path


def partition_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arriving orders are redated to 2001, and the partitions of 1996 and earlier are deleted."""
    path = _stored_by_year(spark, sf_dir)
    arriving = table(spark, sf_dir, "orders").where("o_totalprice >= 400000").select(
        "o_orderkey", "o_custkey", F.lit("U").alias("o_orderstatus"), "o_totalprice",
        moment("2001-07-31").alias("o_orderdate"), "o_orderpriority", F.lit(2001).alias("order_year"),
    )
    upsert_partitions(spark, path, arriving, ["o_orderkey"], ["order_year"])
    delete_from_partitions(spark, path, "order_year <= 1996", ["order_year"])
    return spark.read.parquet(path)


def indexed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders move to 2001 again, found through the key index; a second upsert meets the index that the first one kept up."""
    path = _stored_by_year(spark, sf_dir)
    update_key_index(spark, path, ["o_orderkey"], ["order_year"])
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", moment("2001-07-31")).withColumn("order_year", F.lit(2001))
    for status, least in (("U", 400_000), ("V", 440_000)):
        arriving = orders.where(F.col("o_totalprice") >= least).withColumn("o_orderstatus", F.lit(status))
        upsert_partitions(spark, path, arriving, ["o_orderkey"], ["order_year"], key_index=True)
    return spark.read.parquet(path)


def merged_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces without a declared schema: types widen, and a column that only the last piece has survives."""
    orders = table(spark, sf_dir, "orders")
    pieces = [
        orders.where("o_orderstatus = 'O'").select("o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), F.to_date("o_orderdate").alias("placed")),
        orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").cast("string").alias("O_ORDERKEY"), "o_custkey", F.col("o_orderdate").alias("placed")),
        orders.where("o_orderstatus = 'F'").select("o_orderkey", F.col("o_totalprice").alias("o_custkey"), "o_orderpriority"),
    ]
    return merge_extracts([TableSpec("orders", ("o_orderkey",), kind=FACT)], {"orders": pieces}).tables["orders"]


_MERGE_INPUT = """WITH pieces AS (
    SELECT CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL ELSE o_orderkey END AS o_orderkey,
        o_custkey, o_totalprice, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS o_orderpriority FROM orders),
    good AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0),
    checked AS (SELECT p.*, c_custkey IS NOT NULL AS known FROM pieces p LEFT JOIN good ON o_custkey = c_custkey)"""

def _total_sql(name: str, rows: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(*) AS row_count, {checksum_sql(_STAR_COLUMNS[name])} AS checksum FROM {rows}"""


_STAR_TOTALS = f"""WITH arriving AS ({ARRIVING_ORDERS}),
    kept AS (SELECT * FROM ({STORED_ORDERS}) s WHERE o_orderdate >= TIMESTAMP '1996-01-01'
        AND NOT EXISTS (SELECT 1 FROM arriving a WHERE a.o_orderkey = s.o_orderkey)
        UNION ALL SELECT * FROM arriving)
    {_total_sql("orders", "kept")} UNION ALL {_total_sql("customer", "customer WHERE c_acctbal >= 0")}
    UNION ALL {_total_sql("nation", "nation")}"""

QUERIES = {
    "merged_mart": (
        merged_mart,
        f"""WITH good AS (SELECT * FROM customer WHERE c_acctbal >= 0),
        arrived AS (SELECT *, o_custkey IN (SELECT c_custkey FROM good) AS known FROM ({ARRIVING_ORDERS})),
        arriving AS (SELECT * EXCLUDE (known) FROM arrived WHERE known),
        kept AS (SELECT * FROM ({STORED_ORDERS}) s WHERE o_orderdate >= TIMESTAMP '{_RETAIN_FROM}'
            AND NOT EXISTS (SELECT 1 FROM arriving a WHERE a.o_orderkey = s.o_orderkey))
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, c_custkey, c_name, c_mktsegment,
            CASE WHEN c_custkey IS NULL THEN 'stored: no match in customer' ELSE '' END AS reject_reasons
        FROM (SELECT * FROM arriving UNION ALL SELECT * FROM kept) LEFT JOIN good ON o_custkey = c_custkey
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL, NULL, NULL,
            'arriving: no match in customer' FROM arrived WHERE NOT known""",
    ),
    "delete_before": (
        delete_before,
        """SELECT * FROM (SELECT * REPLACE (CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS o_orderdate)
        FROM orders) WHERE NOT coalesce(o_orderdate < TIMESTAMP '1999-01-01', false)""",
    ),
    "retention_60d": (
        retention,
        "SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-08-01' - INTERVAL 60 DAY",
    ),
    "upsert_orders": (upsert_orders, UPSERTED_ORDERS),
    "upsert_latest": (
        upsert_latest,
        """WITH latest AS (SELECT user_id, ts, event_id, event_type, value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
        SELECT * FROM latest UNION ALL
        SELECT c_custkey, NULL, NULL, 'none', 0.0 FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM latest)""",
    ),
    "replace_dim": (
        replace_dim,
        "SELECT * REPLACE (upper(c_name) AS c_name) FROM customer WHERE c_acctbal >= 0",
    ),
    "append_fact": (
        append_fact,
        f"""{STORED_ORDERS} UNION ALL
        SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderpriority) FROM ({ARRIVING_ORDERS})""",
    ),
    "action_list": (
        action_list,
        f"""{_STAR_TOTALS} UNION ALL
        {_total_sql("supplier", "(SELECT * FROM supplier UNION ALL SELECT * FROM supplier WHERE s_acctbal < 0)")}""",
    ),
    "staged_publish": (
        staged_publish,
        f"{_STAR_TOTALS} UNION ALL {_total_sql('supplier', 'supplier')}",
    ),
    "staged_by_config": (
        staged_by_config,
        " UNION ALL ".join(
            f"SELECT '{mode}_{name}' AS table_name, 'staged' AS status, count(*) AS row_count FROM {name}"
            for mode, names in (("incremental", ("orders", "lineitem")), ("full", ("customer", "part", "supplier", "orders")))
            for name in names
        ),
    ),
    "split_extract": (
        split_extract,
        f"{_total_sql('orders', 'orders')} UNION ALL {_total_sql('customer', 'customer')}",
    ),
    "mart_refresh": (
        mart_refresh,
        f"""WITH arriving AS (SELECT *, o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AS known
            FROM ({ARRIVING_ORDERS}))
        SELECT * EXCLUDE (known), CASE WHEN known THEN '' ELSE 'no match in customer' END AS reject_reasons FROM arriving
        UNION ALL SELECT *, CASE WHEN o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) THEN ''
            ELSE 'no match in customer' END
        FROM ({STORED_ORDERS}) s WHERE o_orderdate >= TIMESTAMP '1996-01-01'
            AND NOT EXISTS (SELECT 1 FROM arriving a WHERE known AND a.o_orderkey = s.o_orderkey)""",
    ),
    "mart_key_rules": (
        mart_key_rules,
        f"""WITH good AS (SELECT c_custkey FROM customer WHERE c_acctbal >= 0),
        kept AS (SELECT c_custkey FROM good WHERE c_custkey % 50 <> 0),
        arriving AS (SELECT o_orderkey, o_custkey IN (SELECT c_custkey FROM kept) AS known FROM ({ARRIVING_ORDERS}))
        SELECT 'customer' AS table_name, c_custkey AS "key", '' AS reason FROM kept
        UNION ALL SELECT 'customer', c_custkey, 'primary key repeats' FROM good, range(2) WHERE c_custkey % 50 = 0
        UNION ALL SELECT 'orders', o_orderkey, CASE WHEN known THEN '' ELSE 'no match in customer' END FROM arriving
        UNION ALL SELECT 'orders', o_orderkey, CASE WHEN o_custkey IN (SELECT c_custkey FROM kept) THEN '' ELSE 'no match in customer' END
        FROM ({STORED_ORDERS}) s WHERE NOT EXISTS (SELECT 1 FROM arriving a WHERE known AND a.o_orderkey = s.o_orderkey)""",
    ),
    "merge_extracts": (
        merged_orders,
        f"""{_MERGE_INPUT} SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM checked
        WHERE o_orderkey IS NOT NULL AND known""",
    ),
    "merge_rejects": (
        merge_rejects,
        f"""{_MERGE_INPUT} SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority,
        concat_ws(', ', CASE WHEN o_orderkey IS NULL THEN 'primary key is null' END,
            CASE WHEN NOT known THEN 'no match in customer' END) AS reject_reasons
        FROM checked WHERE o_orderkey IS NULL OR NOT known""",
    ),
    "merged_schemas": (
        merged_schemas,
        """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
            CASE o_orderstatus WHEN 'F' THEN o_totalprice ELSE CAST(o_custkey AS DOUBLE) END AS o_custkey,
            CASE o_orderstatus WHEN 'O' THEN date_trunc('day', o_orderdate) WHEN 'P' THEN o_orderdate END AS placed,
            CASE o_orderstatus WHEN 'F' THEN o_orderpriority END AS o_orderpriority FROM orders WHERE o_orderstatus IN ('O', 'P', 'F')""",
    ),
    "indexed_upsert": (
        indexed_upsert,
        f"""SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice >= 440000 THEN 'V' ELSE 'U' END AS o_orderstatus, o_totalprice,
            TIMESTAMP '2001-07-31' AS o_orderdate, o_orderpriority, 2001 AS order_year FROM orders WHERE o_totalprice >= 400000
        UNION ALL SELECT *, CAST(year(o_orderdate) AS INTEGER) FROM ({STORED_ORDERS}) WHERE o_totalprice < 400000""",
    ),
    "partition_upsert": (
        partition_upsert,
        f"""SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus, o_totalprice, TIMESTAMP '2001-07-31' AS o_orderdate,
            o_orderpriority, 2001 AS order_year FROM orders WHERE o_totalprice >= 400000
        UNION ALL SELECT *, CAST(year(o_orderdate) AS INTEGER) FROM ({STORED_ORDERS})
        WHERE o_totalprice < 400000 AND year(o_orderdate) > 1996""",
    ),
}
