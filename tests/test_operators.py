"""Edge cases of the single-frame operators, on small frames."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from martweave.functions import scalars
from martweave.model import FACT, ForeignKey, TableAction, TableSpec
from martweave.operators import actions, backlog, keys, ordering, verify
from martweave.operators.conform import conform, conform_report, output_schema, rename
from martweave.operators.schema_diff import schema_diff, schema_diff_by_table
from martweave.operators.sizing import broadcast_if_small, key_size
from martweave.plans.merge import merge_extracts
from martweave.plans.publish import apply_actions


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- conform -------------------------------------------------------------------------------

TARGET = StructType([StructField("id", LongType()), StructField("name", StringType()), StructField("n", IntegerType())])


def test_conform_matches_names_without_case(spark):
    df = spark.createDataFrame([(1, "a")], "ID int, extra string")
    assert rows(conform(df, TARGET)) == [(1, None, None)]
    assert conform(df, TARGET).schema == StructType(
        [StructField("id", LongType()), StructField("name", StringType()), StructField("n", IntegerType())]
    )
    report = conform_report(df, TARGET)
    assert report.missing == ("name", "n") and report.dropped == ("extra",)


def test_conform_mapping_drops_unmapped(spark):
    df = spark.createDataFrame([(1, "x", 5)], "a int, name string, c int")
    assert rows(conform(df, TARGET, {"a": "id", "c": "n"})) == [(1, None, 5)]
    assert rename(df, {"a": "z"}).columns == ["z"]


def test_conform_bad_values(spark):
    df = spark.createDataFrame([("7",), ("x",)], "n string")
    assert rows(conform(df, TARGET, on_error="null").select("n")) == [(7,), (None,)]
    with pytest.raises(PySparkException):
        conform(df, TARGET).collect()


def test_conform_refuses_ambiguity(spark):
    with pytest.raises(ValueError, match="map to"):
        conform(spark.createDataFrame([(1, 2)], "a int, b int"), TARGET, {"a": "id", "b": "ID"})
    with pytest.raises(ValueError, match="not in the input"):
        conform(spark.createDataFrame([(1,)], "a int"), TARGET, {"zz": "id"})


def test_conform_quotes_odd_names(spark):
    df = spark.createDataFrame([(1,)], "`a.b c` int")
    target = StructType([StructField("a.b c", LongType())])
    assert rows(conform(df, target)) == [(1,)]


def test_output_schema_marks_keys(spark):
    schema = output_schema(TARGET, TableSpec("t", ("ID",)))
    assert [f.nullable for f in schema.fields] == [False, True, True]
    with pytest.raises(ValueError):
        output_schema(TARGET, TableSpec("t", ("nope",)))


# --- actions -------------------------------------------------------------------------------


def test_delete_keeps_null_predicate(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    assert rows(actions.delete_where(df, "n < 3")) == [(5,), (None,)]


def test_delete_before_and_retention_are_exact(spark):
    day = dt.datetime(2024, 3, 1)
    df = spark.createDataFrame(
        [(day - dt.timedelta(days=60),), (day - dt.timedelta(days=60, microseconds=1),), (None,)], "d timestamp_ntz"
    )
    assert rows(actions.retain_days(df, "d", day)) == [(None,), (day - dt.timedelta(days=60),)]


def test_retention_reaches_the_scan(spark, sf_dir):
    plan = actions.retain_days(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderdate", dt.date(2001, 8, 1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in text.split("PushedFilters")[1]


def test_delete_reaches_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = actions.delete_where(orders, "o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in text.split("PushedFilters")[1]


def test_upsert_semantics(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old"), (None, "old"), (4, "gone")], "k int, v string")
    source = spark.createDataFrame([(2, "new"), (3, "new"), (None, "new"), (4, "new")], "k int, v string")
    result = actions.upsert(target, source, ["k"], condition="v = 'gone' OR v = 'new'")
    assert rows(result) == [(1, "old"), (2, "new"), (3, "new"), (4, "new"), (None, "new"), (None, "old")]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_upsert_broadcast_or_not(spark, threshold, monkeypatch):
    monkeypatch.setattr("martweave.operators.sizing.BROADCAST_BYTES", int(threshold))
    target = spark.range(1000).select("id", F.lit("old").alias("v"))
    source = spark.range(500, 1500).select("id", F.lit("new").alias("v"))
    result = actions.upsert(target, source, ["id"])
    assert result.count() == 1500 and result.where("v = 'old'").count() == 500


def test_upsert_duplicates(spark):
    target = spark.createDataFrame([(1, 0, "t")], "k int, at int, v string")
    source = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 1, "x"), (None, 1, "y")], target.schema)
    with pytest.raises(ValueError, match="not unique"):
        actions.upsert(target, source, ["k"])
    assert rows(actions.upsert(target, source, ["k"], latest_by=["at"])) == [
        (1, 2, "b"), (None, 1, "x"), (None, 1, "y"),
    ]


def test_upsert_composite_key_with_partial_null(spark):
    target = spark.createDataFrame([(1, None, "t"), (1, 1, "t")], "a int, b int, v string")
    source = spark.createDataFrame([(1, None, "s"), (1, 1, "s")], target.schema)
    assert rows(actions.upsert(target, source, ["a", "b"])) == [(1, 1, "s"), (1, None, "s"), (1, None, "t")]


def test_upsert_is_repeatable_and_accepts_nothing(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    once = actions.upsert(target, source, ["k"])
    assert rows(actions.upsert(once, source, ["k"])) == rows(once)
    assert rows(actions.upsert(target, source.limit(0), ["k"])) == [(1, "a")]
    assert rows(actions.upsert(None, source, ["k"])) == rows(source)


def test_hot_keys_are_split_in_joins(spark):
    """A key and NULL that hold most rows: the anti join must split them and stay whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") < 60_000, F.lit(7)).when(F.col("id") < 100_000, F.lit(None)).otherwise(F.col("id"))
        target = spark.range(0, 150_000, 1, 8).select(key.cast("bigint").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
        source = spark.range(120_000, 130_000, 1, 4).select(F.col("id").alias("k"), F.lit("new").alias("v"))
        result = actions.upsert(target, source, ["k"], check_keys=False)
        assert len(result.collect()) == 150_000
        assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()
        assert result.where("v = 'new'").count() == 10_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_append_and_replace(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(2, 9)], "K int, w int")
    assert rows(actions.append(target, source)) == [(1, "a", None), (2, None, 9)]
    assert rows(actions.replace(target, source)) == [(2, 9)]
    assert rows(actions.replace(target, source, keep_schema=True)) == [(2, None)]
    assert rows(actions.upsert(target, source.withColumnRenamed("K", "k"), ["k"])) == [(1, "a", None), (2, None, 9)]
    assert rows(actions.replace(None, source)) == [(2, 9)]


def test_fill_default_casts_to_the_column(spark):
    df = spark.createDataFrame([(None, None), ("x", 3)], "s string, n int")
    filled = actions.fill_default(df, ["s", "n"], 0)
    assert rows(filled) == [("0", 0), ("x", 3)] and filled.schema["s"].dataType == StringType()


def test_add_column(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, n int")
    required = actions.add_column(df, "fresh", "bigint", default=0)
    assert rows(required) == [(1, None, 0), (2, 5, 0)] and not required.schema["fresh"].nullable
    assert rows(actions.add_column(df, "note", "string")) == [(1, None, None), (2, 5, None)]
    assert rows(actions.add_column(df, "N", "bigint", default=9)) == [(1, 9), (2, 5)]


def test_action_list_order_matters(spark):
    stored = {"t": spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")}
    fresh = {"t": spark.createDataFrame([(2, "new")], "k int, v string")}
    delete = TableAction("delete", "t", condition="v = 'new'")
    upsert = TableAction("upsert", "t", keys=("k",))
    assert rows(apply_actions(stored, fresh, [delete, upsert])["t"]) == [(1, "old"), (2, "new")]
    assert rows(apply_actions(stored, fresh, [upsert, delete])["t"]) == [(1, "old")]
    other = TableAction("replace", "u", source="t")
    assert rows(apply_actions({}, fresh, [other])["u"]) == [(2, "new")]
    with pytest.raises(ValueError, match="no source"):
        apply_actions(stored, {}, [upsert])
    with pytest.raises(ValueError, match="unknown action"):
        apply_actions(stored, fresh, [TableAction("explode", "t")])


# --- keys and merge ------------------------------------------------------------------------

FK = ForeignKey(("c",), "dim", ("k",))


def test_foreign_keys(spark):
    fact = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, c int")
    dim = spark.createDataFrame([(10, "a"), (10, "again"), (None, "n")], "k int, v string")
    assert rows(keys.fk_valid(fact, dim, FK).select("id")) == [(1,)]
    assert rows(keys.fk_orphans(fact, dim, FK).select("id")) == [(2,), (3,)]


def test_merge_rejects_once_with_all_reasons(spark):
    fact = TableSpec("fact", ("id",), (FK,), FACT)
    dim = TableSpec("dim", ("k",))
    first = spark.createDataFrame([(1, 10), (None, 99)], "id int, c int")
    second = spark.createDataFrame([(2.0, "x", 11)], "ID double, note string, C int")
    dims = [spark.createDataFrame([(10, "a"), (None, "b")], "k int, v string"), spark.createDataFrame([(11,)], "k int")]
    result = merge_extracts([fact, dim], {"fact": [first, second], "dim": dims})
    assert rows(result.tables["fact"]) == [(1, 10), (2, 11)]
    assert rows(result.tables["dim"]) == [(10, "a"), (11, None)]
    assert rows(result.rejects["fact"]) == [(None, 99, ["primary key is null", "no match in dim"])]
    assert not result.schemas["fact"]["id"].nullable
    with pytest.raises(ValueError, match="no input"):
        merge_extracts([fact, dim], {"fact": [first]})
    with pytest.raises(ValueError, match="not a dimension"):
        merge_extracts([fact], {"fact": [first]})


def test_assert_not_null(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    keys.assert_not_null(df, ["a"])
    with pytest.raises(ValueError, match="'b': 1"):
        keys.assert_not_null(df, ["a", "b"])


def test_model_validation():
    with pytest.raises(ValueError):
        ForeignKey(("a", "b"), "t", ("a",))
    with pytest.raises(ValueError):
        TableSpec("t", ("a",), kind="other")
    assert TableSpec("t", ("a",), kind=FACT).load_mode == "incremental"


def test_key_size(spark):
    size = key_size(spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int"), ["k"])
    assert (size.keys, size.most_rows) == (2, 2) and size.small
    assert key_size(spark.createDataFrame([], "k int"), ["k"]).most_rows == 0


def test_broadcast_only_when_small(spark, monkeypatch):
    df = spark.range(100)
    hinted = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hinted(broadcast_if_small(df))
    monkeypatch.setattr("martweave.operators.sizing.BROADCAST_BYTES", 10)
    assert not hinted(broadcast_if_small(df))


# --- ordering ------------------------------------------------------------------------------


@pytest.mark.parametrize("n,size,expected", [(250, 100, [100, 100, 50]), (200, 100, [100, 100]), (3, 10, [3])])
def test_chunk_sizes(spark, n, size, expected):
    chunks = ordering.chunk_ids(spark.range(n), ["id"], size).groupBy("chunk_id").count()
    assert [r["count"] for r in chunks.orderBy("chunk_id").collect()] == expected


def test_row_index_is_exact_under_skew(spark):
    """One leading value holds most rows, and some sort keys are NULL."""
    df = spark.range(0, 20_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(1)).otherwise(F.lit(2)).alias("hot"),
        (F.lit(20_000) - F.col("id")).alias("k"),
    )
    indexed = ordering.row_index(df, ["hot", "k"], ranges=5).collect()
    expected = sorted((r["hot"] is not None, r["hot"] or 0, r["k"]) for r in indexed)
    in_order = [(r["hot"] is not None, r["hot"] or 0, r["k"]) for r in sorted(indexed, key=lambda r: r["row_index"])]
    assert in_order == expected
    assert sorted(r["row_index"] for r in indexed) == list(range(1, 20_001))
    sizes = [spark.read.parquet(f).count() for f in ordering.row_index(df, ["hot", "k"], ranges=5).inputFiles()]
    assert len(sizes) == 5 and max(sizes) < 20_000 / 3, "the hot value spans several ranges"


def test_row_index_splits_equal_rows(spark):
    same = spark.range(0, 10_000, 1, 4).select(F.lit("x").alias("v"))
    indexed = ordering.row_index(same, ["v"], ranges=4, unique=False)
    assert sorted(r["row_index"] for r in indexed.collect()) == list(range(1, 10_001))
    files = indexed.inputFiles()
    assert len(files) >= 3, "equal rows should spread over several ranges"


def test_row_index_per_null_group(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), (None, 9), (None, 2)], "g string, k int")
    assert rows(ordering.row_index(df, ["k"], ["g"])) == [("a", 1, 1), ("a", 3, 2), (None, 2, 1), (None, 9, 2)]
    assert ordering.row_index(df.limit(0), ["k"], ["g"]).collect() == []


def test_batches(spark):
    sizes = ordering.batch_ids(spark.range(95), ["id"], 10).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in sizes] == [10] * 9 + [5]
    assert ordering.batch_ids(spark.range(0), ["id"], 10).count() == 0


def test_page_shallow_equals_deep(spark, monkeypatch):
    df = spark.range(1000)
    shallow = rows(ordering.page(df, ["id"], 990, 50))
    monkeypatch.setattr("martweave.operators.ordering._SHALLOW_PAGE_ROWS", 0)
    assert rows(ordering.page(df, ["id"], 990, 50)) == shallow == [(i,) for i in range(990, 1000)]


def test_chunk_actions(spark):
    df = ordering.chunk_actions(spark.createDataFrame([(0,), (1,), (2,)], "chunk_id int"))
    assert [r["action"] for r in df.orderBy("chunk_id").collect()] == ["replace", "insert", "insert"]


# --- verification --------------------------------------------------------------------------


def test_checksum_sees_what_it_should(spark):
    base = spark.createDataFrame([(1, "a", None), (2, None, "a")], "k int, x string, y string")
    shuffled = spark.createDataFrame([(2, None, "a"), (1, "a", None)], base.schema)
    swapped = spark.createDataFrame([(1, None, "a"), (2, "a", None)], base.schema)
    twice = base.union(base)
    assert verify.same_content(base, shuffled)
    assert not verify.same_content(base, swapped)
    assert not verify.same_content(base, twice)
    assert not verify.same_content(twice, base.limit(1).union(base.limit(1)).union(base.limit(1)).union(base.limit(1)))
    assert verify.same_content(base.limit(0), shuffled.limit(0))
    assert not verify.same_content(base, base.drop("y"))


def test_checksum_does_not_overflow(spark):
    same = spark.range(0, 100_000).select(F.lit(3).alias("v"))
    assert verify.table_checksum(same).first()["row_count"] == 100_000


def test_bucket_checksums_locate_a_change(spark):
    left = spark.range(100).select("id", F.lit(0).alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 42, 1).otherwise(0))
    a, b = ({r["bucket"]: r["checksum"] for r in verify.bucket_checksums(d, ["id"], 8).collect()} for d in (left, right))
    assert sum(a[k] != b[k] for k in a) == 1


def test_row_diff(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n"), (5, "x"), (5, "y")], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d"), (None, "n"), (5, "y"), (5, "x")], left.schema)
    assert {r["k"]: r["status"] for r in verify.row_diff(left, right, ["k"]).collect()} == {
        1: "equal", 2: "changed", 3: "only_left", 4: "only_right", None: "equal", 5: "equal",
    }


def test_row_counts_shows_empty_tables(spark):
    assert rows(verify.row_counts({"a": spark.range(3), "b": spark.range(0)})) == [("a", 3), ("b", 0)]


def test_lookup_one(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "n string, v int")
    assert rows(verify.lookup_one(df, F.col("n") == "a")) == [("a", 1)]
    with pytest.raises(LookupError, match="no row"):
        verify.lookup_one(df, F.col("n") == "z")
    with pytest.raises(LookupError, match="more than one"):
        verify.lookup_one(df, F.col("n") == "b")
    assert verify.exists(df, F.col("v") > 2) and not verify.exists(df, F.col("v") > 3)


# --- schema comparison ---------------------------------------------------------------------

LISTING = "schema string, table string, column string, type string"
SOURCE = [
    ('"HR"', '"HR.EMP"', '"NAME"', "TEXT"),
    ('"HR"', '"HR.EMP"', '"ID"', "INT"),
    ('"HR"', '"HR.EMP"', '"ADDRESS"', "VARCHAR"),
    ('"HR"', '"HR.DEPT"', '"NAME"', "TEXT"),
    ('"HR"', '"HR.DEPT"', '"ID"', "INT"),
]


def test_schema_diff_worked_example(spark):
    source = spark.createDataFrame(SOURCE, LISTING)
    target = spark.createDataFrame([c for c in SOURCE if c[2] != '"ADDRESS"'], LISTING)
    assert rows(schema_diff(source, target)) == [
        ('"HR"', '"HR.EMP"', '"ADDRESS"', "VARCHAR", None, "missing_column")
    ]
    by_table = {r["table"]: r for r in schema_diff_by_table(source, target).collect()}
    assert [tuple(c) for c in by_table['"HR.EMP"']["missing_columns"]] == [('"ADDRESS"', "VARCHAR")]
    assert by_table['"HR.DEPT"']["missing_columns"] == []
    assert all(r["different_data_types"] == [] and r["source_only_content"] == [] for r in by_table.values())


def test_schema_diff_types_and_source_only(spark):
    source = spark.createDataFrame([("a", "t", "x", "int"), ("a", "u", "y", "int"), ("b", "t", "x", "int")], LISTING)
    target = spark.createDataFrame([("a", "t", "x", "INT"), ("a", "t", "only_here", "int")], LISTING)
    assert {(r["schema"], r["table"]): r["status"] for r in schema_diff(source, target).collect()} == {
        ("a", "t"): "type_differs", ("a", "u"): "source_only", ("b", "t"): "source_only",
    }


# --- scalars and backlog -------------------------------------------------------------------


def test_priority_classes(spark):
    df = spark.createDataFrame([("DLE_123",), ("MR_456",), ("NORMAL_789",), ("x_MR_y",), ("xMRy",), ("DLE_MR_1",)], "name string")
    strict = {r["name"]: r["priority"] for r in backlog.with_priority(df).collect()}
    assert strict == {"DLE_123": 1, "MR_456": 3, "NORMAL_789": 3, "x_MR_y": 2, "xMRy": 3, "DLE_MR_1": 1}
    assert {r["priority"] for r in backlog.with_priority(df, loose=True).where("name like '%MR%'").collect()} == {1, 2}


def test_dispatch_and_gate(spark):
    at = dt.datetime(2024, 1, 1)
    jobs = backlog.with_priority(
        spark.createDataFrame(
            [("job_1", at, "hyper"), ("DLE_1", at + dt.timedelta(1), "hyper"), ("a_MR_1", at, "hyper"),
             ("job_2", at, "extract"), ("job_0", at, "extract")],
            "name string, ts timestamp_ntz, stage string",
        )
    )
    order = {r["name"]: r["position"] for r in backlog.dispatch_order(jobs).collect()}
    assert order == {"DLE_1": 1, "a_MR_1": 2, "job_1": 3, "job_0": 1, "job_2": 2}
    assert {r["name"] for r in backlog.admissible(jobs).collect()} == {"DLE_1", "job_0", "job_2"}
    assert backlog.admissible(jobs.where("name <> 'DLE_1'")).count() == 4
    unstaged = jobs.withColumn("stage", F.when(F.col("name") != "job_0", F.col("stage")))
    assert {r["name"] for r in backlog.admissible(unstaged).collect()} == {"DLE_1", "job_0", "job_2"}
    assert backlog.first_per_stage(jobs, 1).count() == 2


def test_next_stage(spark):
    df = spark.createDataFrame([("extract", True), ("publish", True), ("hyper", False)], "s string, ok boolean")
    assert [r[0] for r in df.select(scalars.next_stage("s", F.col("ok"))).collect()] == ["hyper", "completed", "failed"]


def test_run_log_parsing(spark):
    lines = spark.createDataFrame(
        [("2024-01-01 00:00:00 - script_1.sh: started",), ("2024-01-01 00:00:05 - Job 7: succeeded",), ("noise",),
         ("2024-01-01 00:00:06 - Total: 3 - x: failed",)],
        "value string",
    )
    summary = {r["status"]: r["runs"] for r in backlog.run_summary(lines).collect()}
    assert summary == {"started": 1, "succeeded": 1, "failed": 1, "unparsed": 1}


def test_paths(spark):
    df = spark.createDataFrame(
        [("/a/b/fact.data",), ("s3://x/y/",), ("plain",), ("/d/.hidden",), ("http://h/p.tar.gz?q=/1#z",)], "p string"
    )
    got = [tuple(r) for r in df.select(scalars.path_name("p"), scalars.path_stem("p")).collect()]
    assert got == [("fact.data", "fact"), ("y", "y"), ("plain", "plain"), (".hidden", ".hidden"), ("p.tar.gz", "p.tar")]


def test_stage_counts(spark):
    df = spark.createDataFrame([("extract.started/a",), ("/x/extract.started/b",), ("hyper.pending/a",)], "path string")
    assert rows(backlog.stage_counts(df)) == [("extract", "started", 2), ("hyper", "pending", 1)]
