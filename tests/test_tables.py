"""Sources, sinks, configuration, releases, partition rewrites and staging, on real files."""

import datetime as dt
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader

from martweave.model import ForeignKey, TableSpec
from martweave.operators.verify import reconcile_files, same_content
from martweave.plans import publish
from martweave.plans.mart import actions_for, refresh_mart
from martweave.plans.partitions import delete_from_partitions, upsert_partitions
from martweave.plans.staging import run_staged, stage_by_config
from martweave.queries.files import copy_reconcile, file_inventory
from martweave.session import parked, scratch_path, scratch_root, scratch_scope
from martweave.sources import config, extracts, files, tables


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- scratch -------------------------------------------------------------------------------


def test_scratch_follows_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scope_removes_its_own_scratch_only(spark, tmp_path):
    from pathlib import Path

    before = parked(spark.range(3), "before")
    with scratch_scope(spark):
        inner = parked(before.union(spark.range(2)), "inner")
        inner.write.parquet(f"{tmp_path}/result")
        inside = [Path(f.removeprefix("file:")) for f in inner.inputFiles()]
        assert all(f.exists() for f in inside)
    assert not any(f.exists() for f in inside)
    assert before.count() == 3 and spark.read.parquet(f"{tmp_path}/result").count() == 5


# --- files ---------------------------------------------------------------------------------


def test_csv_explicit_and_inferred(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a,"b"', None), (2, None, 1.5)], "k int, s string, d double")
    files.write_csv(df, f"{tmp_path}/csv")
    assert rows(files.read_csv(spark, f"{tmp_path}/csv", df.schema)) == rows(df)
    assert rows(files.read_csv(spark, f"{tmp_path}/csv")) == rows(df)


def test_delimited_text_has_no_quoting(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('"x",1,2.5,p\n"y,2,,q\n')
    schema = "column1 string, column2 int, column3 double, partition_column string"
    assert rows(files.read_delimited(spark, f"{tmp_path}/in", schema)) == [('"x"', 1, 2.5, "p"), ('"y', 2, None, "q")]


def test_bounded_files(spark, tmp_path):
    files.write_bounded(spark.range(0, 250, 1, 1), f"{tmp_path}/b", 100)
    assert sorted(r["file_rows"] for r in files.rows_per_file(spark.read.parquet(f"{tmp_path}/b")).collect()) == [50, 100, 100]


def test_write_chunks(spark, tmp_path):
    files.write_chunks(spark.range(25), f"{tmp_path}/c", ["id"], 10)
    read = spark.read.parquet(f"{tmp_path}/c").groupBy("chunk_id").agg(F.min("id"), F.max("id"))
    assert rows(read) == [(0, 0, 9), (1, 10, 19), (2, 20, 24)]


def test_inventory_guard_and_reconcile(spark, tmp_path):
    for side in ("src", "copy"):
        (tmp_path / side).mkdir()
        for name, text in {"a.txt": "x" * 50, "b.txt": "y" * 50, "tiny.txt": "z"}.items():
            (tmp_path / side / name).write_text(text)
    (tmp_path / "copy" / "b.txt").write_text("Y" * 50)
    (tmp_path / "copy" / "a.txt").unlink()
    source, copy = (files.file_inventory(spark, f"{tmp_path}/{s}", hashed=True) for s in ("src", "copy"))
    reasons = {r["name"]: r["reason"] for r in source.select("name", files.size_reason(max_bytes=60).alias("reason")).collect()}
    assert reasons == {"a.txt": None, "b.txt": None, "tiny.txt": "too small"}
    assert [r["name"] for r in files.by_name(source).collect()] == ["a.txt", "b.txt", "tiny.txt"]
    assert {r["name"]: r["status"] for r in reconcile_files(source, copy).collect()} == {
        "a.txt": "only_left", "b.txt": "changed", "tiny.txt": "equal",
    }
    for one, other in ((source.drop("md5"), copy), (source, copy.withColumn("md5", F.lit(None).cast("string")))):
        # Equal lengths say nothing about content without both hashes.
        assert {r["name"]: r["status"] for r in reconcile_files(one, other).collect()} == {
            "a.txt": "only_left", "b.txt": "unverified", "tiny.txt": "unverified",
        }


def test_write_files_of_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_FILES_PER_FOLDER", 2)
    odd = [(1, "a"), (-2, None), (None, "c"), (1, "\u00e9"), (None, "d\ne"), (3, ""), (1, "a")]
    folders = files.write_files(spark.createDataFrame(odd, "k bigint, t string").coalesce(1), f"file://{tmp_path}/w", "k", "t")
    assert folders == [f"file://{tmp_path}/w/part-00000/{n:06d}" for n in range(2)]
    written = {f.name: sorted(f.read_bytes().decode().split("\n")) for f in (tmp_path / "w").rglob("*") if f.is_file()}
    assert written == {
        "k=1.txt": ["", "a", "a", "\u00e9"], "k=-2.txt": ["", ""], "k=3.txt": ["", ""],
        "k=__HIVE_DEFAULT_PARTITION__.txt": ["", "c", "d", "e"],
    }
    assert [f.name for f in (tmp_path / "w").iterdir()] == ["part-00000"]
    inventory = files.file_inventory(spark, folders, recursive=True, hashed=True)
    assert rows(inventory.select("name", "length")) == [
        ("k=-2.txt", 1), ("k=1.txt", 7), ("k=3.txt", 1), ("k=__HIVE_DEFAULT_PARTITION__.txt", 6),
    ]
    # Any name, a file per partition, and no rows at all.
    named = spark.createDataFrame([("a/b", "x"), ("..", "y"), ("a/b", "z")], "k string, t string").repartition(3).select("k", "t")
    found = files.file_inventory(spark, files.write_files(named, f"{tmp_path}/named", "k", "t"), recursive=True, hashed=True)
    assert found.agg(F.sum("length")).first()[0] == 6
    nothing = files.write_files(named.limit(0), f"{tmp_path}/none", "k", "t")
    assert files.file_inventory(spark, nothing, recursive=True, hashed=True).count() == 0


def test_write_files_hides_unfinished_attempts(spark, tmp_path):
    folders = files.write_files(spark.range(3, numPartitions=1).selectExpr("id AS k", "'x' AS t"), f"{tmp_path}/w", "k", "t")
    ended = tmp_path / "w" / ".part-00000-7" / "000000"
    ended.mkdir(parents=True)
    (ended / "k=0.txt").write_text("of an attempt that ended")
    for paths in (folders, f"{tmp_path}/w"):
        assert files.file_inventory(spark, paths, recursive=True, hashed=True).count() == 3
    with pytest.raises(FileExistsError):
        files.write_files(spark.range(1).selectExpr("id AS k", "'x' AS t"), f"{tmp_path}/w", "k", "t")


def test_files_beyond_two_gigabytes_have_no_hash(spark, tmp_path):
    (tmp_path / "small").write_text("x")
    with open(tmp_path / "large", "wb") as sparse:
        sparse.truncate(1 << 31)
    found = rows(files.file_inventory(spark, str(tmp_path), hashed=True).select("name", "length", "md5"))
    assert found == [("large", 1 << 31, None), ("small", 1, "9dd4e461268c8034f5c8564e155c67a6")]


def test_write_files_to_another_store(spark, tmp_path):
    # What is no local path to Spark goes through its own writer, with a folder per file.
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.files.link./w", f"file://{tmp_path}")
    folders = files.write_files(spark.range(3).selectExpr("id AS k", "'x' AS t"), "viewfs://files/w/x", "k", "t")
    found = files.file_inventory(spark, folders, recursive=True, hashed=True)
    assert rows(found.select(F.regexp_extract("path", "/w/x/(k=[0-9]+)/", 1), "length")) == [("k=0", 2), ("k=1", 2), ("k=2", 2)]


def _pages(spark, path, n):
    """Page n has 10 n bytes; of ten, one without TLS, one with a fragment, and one with both."""
    kind = F.col("id") % 10
    url = F.concat(F.when(kind.isin(0, 1), "http:").otherwise("https:"), F.lit("//a/"), F.when(kind.isin(1, 2), "#b").otherwise(""))
    html = F.expr("repeat('x', CAST(id * 10 AS INT))")
    spark.range(n).select(F.col("id").alias("page_id"), url.alias("url"), html.alias("html")).write.parquet(f"{path}/pages.parquet")


def _tasks(spark, query, path):
    """The query's rows, and how many tasks it took when Spark puts a single file of unknown cost into each."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")
    try:
        group = f"tasks-{path}"
        spark.sparkContext.setJobGroup(group, "")
        found = query(spark, path).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup(group)]
    return found, sum(tracker.getStageInfo(s).numTasks for j in jobs for s in j.stageIds if tracker.getStageInfo(s))


def test_copy_reconcile_packs_files_into_tasks(spark, tmp_path):
    _pages(spark, tmp_path, 300)
    found, n_tasks = _tasks(spark, copy_reconcile, str(tmp_path))
    status = {0: "changed", 1: "only_left", 2: "only_left"}
    assert {r["name"]: (r["left_rows"], r["right_rows"], r["status"]) for r in found} == {
        f"page_{n}": (1, int(n % 10 not in (1, 2)), status.get(n % 10, "equal")) for n in range(300)
    }
    assert len(found) == 300 and n_tasks < 150
    # Neither copy stays on disk once it is hashed.
    scratch = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    assert not list(scratch.rglob("page_id=*"))


def test_file_inventory_packs_files_into_tasks(spark, tmp_path):
    _pages(spark, tmp_path, 300)
    found, n_tasks = _tasks(spark, file_inventory, str(tmp_path))
    expected = []
    for n in range(300):
        text = b"x" * (10 * n) + b"\n"
        reason = "too small" if len(text) < 500 else "too large" if len(text) > 1500 else None
        expected.append((f"page_{n}", len(text), hashlib.md5(text).hexdigest(), reason))
    assert [tuple(r) for r in found] == sorted(expected) and n_tasks < 150


def test_inventory_lists_few_folders_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "_FILES_PER_FOLDER", 10)
    monkeypatch.setattr(files, "_FOLDERS_PER_LISTING", 3)
    sizes, load = [], DataFrameReader.load
    monkeypatch.setattr(DataFrameReader, "load", lambda self, path: sizes.append(len(path)) or load(self, path))
    texts = spark.range(95, numPartitions=1).selectExpr("id AS k", "CAST(id AS STRING) AS t")
    folders = files.write_files(texts, f"{tmp_path}/w", "k", "t")
    found = files.file_inventory(spark, folders, recursive=True, hashed=True)
    assert sizes == [3, 3, 3, 1]
    expected = [(f"k={n}.txt", hashlib.md5(f"{n}\n".encode()).hexdigest()) for n in range(95)]
    assert rows(found.select("name", "md5")) == sorted(expected, key=repr)


# --- extracts ------------------------------------------------------------------------------


def test_extract_listing_and_first_table(spark, tmp_path):
    root = f"{tmp_path}/extract"
    extracts.write_table(spark.range(3), root, "zeta")
    extracts.write_table(spark.range(5).withColumn("x", F.lit("a")), root, "alpha")
    extracts.write_table(spark.range(1), root, "aaa", schema="second")
    assert rows(extracts.list_tables(spark, root)) == [("public", "alpha"), ("public", "zeta"), ("second", "aaa")]
    assert extracts.first_table(spark, root).count() == 5
    assert extracts.read_table(spark, root, "aaa", "second").count() == 1
    listing = extracts.list_columns(spark, {"alpha": extracts.read_table(spark, root, "alpha")})
    assert rows(listing.select("table", "position", "column", "type")) == [("alpha", 1, "id", "bigint"), ("alpha", 2, "x", "string")]
    (tmp_path / "none").mkdir()
    assert extracts.first_table(spark, f"{tmp_path}/none") is None


def test_pieces_carry_their_name(spark, tmp_path):
    for name in ("part_1", "part_2", "other"):
        spark.range(2).write.parquet(f"{tmp_path}/{name}")
    pieces = extracts.read_pieces(spark, f"{tmp_path}/part_*").groupBy("piece").count()
    assert rows(pieces) == [("part_1", 2), ("part_2", 2)]


def test_split_extract_replaces_then_inserts(spark, tmp_path):
    for piece, tables_of_piece in {"x_2": {"a": 2, "b": 5}, "x_1": {"a": 1}, "y_1": {"a": 100}}.items():
        for name, n in tables_of_piece.items():
            extracts.write_table(spark.range(n), f"{tmp_path}/{piece}", name)
    pieces = extracts.read_split_extract(spark, f"{tmp_path}/x_*")
    assert {p: sorted(t) for p, t in pieces.items()} == {"x_1": ["a"], "x_2": ["a", "b"]}
    result = publish.apply_pieces({"a": spark.range(50), "b": spark.range(50)}, pieces)
    assert {name: df.count() for name, df in result.items()} == {"a": 3, "b": 5}


def test_profile_counts_nulls(spark):
    profile = extracts.profile_columns(spark.createDataFrame([(1, None), (2, None)], "a int, b string"), "t")
    assert rows(profile) == [("t", 2, 1, "a", "int", 0), ("t", 2, 2, "b", "string", 2)]


# --- configuration -------------------------------------------------------------------------

DOCUMENT = """{"merge_tables": [
  {"source_table": "fact_a", "foreign_keys": [{"target_table": "dim_x"}, {"target_table": "dim_y"}]},
  {"source_table": "fact_b", "foreign_keys": []},
  {"source_table": "fact_c", "foreign_keys": [{"target_table": "dim_x"}]}]}"""


@pytest.fixture
def entries(spark, tmp_path):
    (tmp_path / "merge.json").write_text(DOCUMENT)
    return config.read_json_config(spark, f"{tmp_path}/merge.json", root="merge_tables")


def requested(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "source_table string")


def test_json_document(spark, entries):
    assert rows(config.config_edges(entries)) == [
        ("fact_a", "dim_x"), ("fact_a", "dim_y"), ("fact_b", None), ("fact_c", "dim_x"),
    ]
    assert rows(config.targets_of(entries, "fact_a")) == [("dim_x",), ("dim_y",)]
    assert rows(config.targets_of(entries, "fact_b")) == []


def test_list_config_keys_are_exact(spark):
    lines = spark.createDataFrame(
        [('INTRA="fact_a, fact_b"',), ('NONINTRA="fact_c"',), ("# INTRA=x",), ("EMPTY=",), ("noise",)], "value string"
    )
    values = config.parse_list_config(lines)
    assert rows(values.where("key = 'INTRA'")) == [("INTRA", "fact_a"), ("INTRA", "fact_b")]
    assert values.count() == 3


def test_stage_plan_lists_each_table_once(spark, entries):
    plan = config.stage_plan(requested(spark, "fact_a", "fact_c", "fact_b"), entries)
    assert rows(plan) == [
        ("full", "dim_x"), ("full", "dim_y"),
        ("incremental", "fact_a"), ("incremental", "fact_b"), ("incremental", "fact_c"),
    ]
    assert rows(config.missing_sources(requested(spark, "fact_b", "fact_z"), entries)) == [("fact_z",)]


def test_staging(spark, entries, tmp_path):
    roots = {"incremental": f"{tmp_path}/inc", "full": f"{tmp_path}/full"}
    extracts.write_table(spark.range(7), roots["incremental"], "fact_c")
    extracts.write_table(spark.range(2), roots["full"], "dim_x")
    staging, log = f"{tmp_path}/staging", f"{tmp_path}/log"
    with pytest.raises(LookupError, match="fact_z"):
        stage_by_config(spark, requested(spark, "fact_z", "fact_c"), entries, roots, staging, "r0", log)
    assert not (tmp_path / "staging").exists()

    staged = stage_by_config(spark, requested(spark, "fact_c"), entries, roots, staging, "r1", log)
    assert {name: df.count() for name, df in staged.items()} == {("full", "dim_x"): 2, ("incremental", "fact_c"): 7}
    with pytest.raises(RuntimeError):
        run_staged(spark, staged, staging, lambda _: (_ for _ in ()).throw(RuntimeError("publish failed")))
    assert (tmp_path / "staging").exists(), "a failed run keeps its staged files"
    assert run_staged(spark, staged, staging, lambda t: t["incremental", "fact_c"].count()) == 7
    assert not (tmp_path / "staging").exists()

    with pytest.raises(Exception, match="dim_y|fact_a"):
        stage_by_config(spark, requested(spark, "fact_a"), entries, roots, f"{tmp_path}/s2", "r2", log)
    assert ("r1", "fact_c", "staged") in rows(spark.read.parquet(log).select("run_id", "name", "status"))


# --- catalogue tables ----------------------------------------------------------------------


def test_catalogue_table_life(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS life")
    schema = spark.createDataFrame([], "id int, name string, y int, m int").schema
    tables.create_table(spark, "life", schema, ["y", "m"], "orc", f"{tmp_path}/life")
    tables.create_table(spark, "life", schema, ["y", "m"], "orc", f"{tmp_path}/life")
    assert tables.partition_columns(spark, "life") == ["y", "m"]
    tables.append_to_table(spark.createDataFrame([(2024, 1, 1), (2024, 2, 2)], "Y int, m int, ID int"), "life")
    assert rows(spark.table("life")) == [(1, None, 2024, 1), (2, None, 2024, 2)]
    tables.overwrite_table_partitions(spark.createDataFrame([(9, 2024, 2), (8, 2025, 1)], "id int, y int, m int"), "life")
    assert rows(spark.table("life").select("id", "y", "m")) == [(1, 2024, 1), (8, 2025, 1), (9, 2024, 2)]
    tables.rename_table(spark, "life", "life_after")
    tables.add_table_column(spark, "life_after", "note", "string")
    assert spark.table("life_after").where("note IS NULL").count() == 3
    assert tables.preview_table(spark, "life_after", 2).count() == 2
    listing = extracts.list_catalog_columns(spark).where("table = 'life_after'").orderBy("position")
    assert [r["column"] for r in listing.collect()] == ["id", "name", "note", "y", "m"]
    spark.sql("DROP TABLE life_after")


def test_overwrite_needs_partitions(spark, tmp_path):
    tables.create_table(spark, "flat", spark.range(1).schema, [], "parquet", f"{tmp_path}/flat")
    with pytest.raises(ValueError, match="not partitioned"):
        tables.overwrite_table_partitions(spark.range(1), "flat")
    spark.sql("DROP TABLE flat")


def test_batched_load_equals_single_load(spark, tmp_path):
    for name, order in (("one", None), ("ten", ["id"])):
        tables.create_table(spark, f"load_{name}", spark.range(1).schema, [], "parquet", f"{tmp_path}/{name}")
        tables.load_batches(spark.range(37), f"load_{name}", order)
        assert spark.table(f"load_{name}").agg(F.count("*"), F.sum("id")).first()[:] == (37, 666)
        spark.sql(f"DROP TABLE load_{name}")


# --- releases ------------------------------------------------------------------------------


def test_releases_switch_together_and_carry_over(spark, tmp_path):
    root = f"{tmp_path}/mart"
    publish.publish_release(spark, root, {"dim": spark.range(3), "fact": spark.range(10)}, "r1")
    publish.publish_release(spark, root, {"fact": spark.range(20)}, "r2", {"fact": []})
    assert publish.read_published(spark, root, "fact").count() == 20
    assert publish.read_published(spark, root, "dim").count() == 3
    log = {r["table_name"]: r for r in publish.current_release(spark, root).collect()}
    assert "release=r1" in log["dim"]["path"] and "release=r2" in log["fact"]["path"]
    assert {r["run_id"] for r in log.values()} == {"r2"}

    publish.publish_release(spark, root, {"fact": spark.range(99)}, "r2")
    assert publish.read_published(spark, root, "fact").count() == 20, "publishing the current run again changes nothing"
    with pytest.raises(ValueError, match="earlier release"):
        publish.publish_release(spark, root, {"fact": spark.range(1)}, "r1")
    with pytest.raises(LookupError):
        publish.read_published(spark, root, "nope")


def test_published_tables_keep_columns_and_types(spark, tmp_path):
    df = spark.createDataFrame([("01", 1, None)], "month string, k int, note string")
    publish.publish_release(spark, f"{tmp_path}/mart", {"t": df}, partition_by={"t": ["month"]})
    read = publish.read_published(spark, f"{tmp_path}/mart", "t")
    assert read.schema == df.schema and rows(read) == rows(df)


def test_failed_release_leaves_the_current_one(spark, tmp_path):
    root = f"{tmp_path}/mart"
    publish.publish_release(spark, root, {"a": spark.range(5), "b": spark.range(5)}, "good")
    broken = spark.range(3).select(F.raise_error(F.lit("broken input")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="broken input"):
        publish.publish_release(spark, root, {"a": spark.range(50), "b": broken}, "bad")
    assert publish.read_published(spark, root, "a").count() == 5
    publish.publish_release(spark, root, {"a": spark.range(50), "b": spark.range(50)}, "bad")
    assert publish.read_published(spark, root, "b").count() == 50, "a failed run can be repeated"


def test_refresh_creates_then_updates(spark, tmp_path):
    root = f"{tmp_path}/mart"
    fact = TableSpec("fact", ("id",), (ForeignKey(("d",), "dim", ("k",)),), "fact")
    specs = [fact, TableSpec("dim", ("k",))]
    assert [(a.action, a.target) for a in actions_for(specs)] == [("replace", "dim"), ("upsert", "fact")]
    schema = "id int, d int, v string"
    first = spark.createDataFrame([(1, 1, "a"), (2, 2, "a"), (3, 9, "orphan")], schema)
    run = refresh_mart(spark, root, specs, {"dim": [spark.createDataFrame([(1,), (2,)], "k int")], "fact": [first]})
    assert rows(run.rejects["fact"].select("id", "reject_reasons")) == [(3, ["no match in dim"])]
    second = spark.createDataFrame([(2, 2, "b"), (4, 3, "b")], schema)
    dims = spark.createDataFrame([(2,), (3,)], "k int")
    refresh_mart(spark, root, specs, {"dim": [dims], "fact": [second]}, conditions={"fact": "id = 1"})
    assert rows(publish.read_published(spark, root, "fact")) == [(2, 2, "b"), (4, 3, "b")]
    assert rows(publish.read_published(spark, root, "dim")) == [(2,), (3,)]
    repeated = spark.createDataFrame([(5, 2, "x"), (5, 3, "y")], schema)
    with pytest.raises(ValueError, match="not unique"):
        refresh_mart(spark, root, specs, {"dim": [dims], "fact": [repeated]})
    assert publish.read_published(spark, root, "fact").count() == 2


def test_staged_table_is_checked(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    staged = publish.stage_table(df, f"{tmp_path}/t", ["k"])
    assert staged.row_count == 3 and same_content(spark.read.schema(df.schema).parquet(f"{tmp_path}/t").select("k", "v"), df)
    assert publish.stage_table(df.where("k > 5"), f"{tmp_path}/empty").row_count == 0
    real = publish.table_checksum
    monkeypatch.setattr(publish, "table_checksum", lambda d, c=None: real(d.limit(1) if c else d, c))
    with pytest.raises(publish.PublishError):
        publish.stage_table(df, f"{tmp_path}/damaged")


# --- partition rewrites --------------------------------------------------------------------


@pytest.fixture
def parted(spark, tmp_path):
    path = f"{tmp_path}/parted"
    data = [(1, "a", 2020, "x y"), (2, "b", 2020, "x y"), (3, "c", 2021, "p/q"), (4, "d", 2022, "z"), (5, "e", 2023, "z")]
    files.append_partitioned(spark.createDataFrame(data, "k int, v string, y int, s string"), path, ["y", "s"])
    return path


def modified(path):
    return {p: p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_upsert_rewrites_only_touched_partitions(spark, parted, tmp_path):
    untouched = {p for p in (tmp_path / "parted").rglob("*.parquet") if "y=2022" in str(p) or "y=2023" in str(p)}
    source = spark.createDataFrame([(1, "A", 2020, "x y"), (9, "N", 2024, "new")], "k int, v string, y int, s string")
    assert upsert_partitions(spark, parted, source, ["k"], ["y", "s"]) == 2
    assert rows(spark.read.parquet(parted).select("k", "v")) == [(1, "A"), (2, "b"), (3, "c"), (4, "d"), (5, "e"), (9, "N")]
    assert all(p.exists() for p in untouched)


def test_moved_rows_leave_and_empty_their_partition(spark, parted, tmp_path):
    source = spark.createDataFrame([(3, "moved", 2023, "z"), (1, "moved", 2023, "z")], "k int, v string, y int, s string")
    for _ in range(2):
        upsert_partitions(spark, parted, source, ["k"], ["y", "s"])
        table = spark.read.parquet(parted)
        assert rows(table.select("k", "v", "y")) == [
            (1, "moved", 2023), (2, "b", 2020), (3, "moved", 2023), (4, "d", 2022), (5, "e", 2023),
        ]
    assert not any("y=2021" in str(p) for p in (tmp_path / "parted").rglob("*.parquet")), "the emptied partition is gone"


def test_upsert_with_condition_spares_the_source(spark, parted):
    source = spark.createDataFrame([(4, "new", 2022, "z")], "k int, v string, y int, s string")
    upsert_partitions(spark, parted, source, ["k"], ["y", "s"], condition="y >= 2022")
    assert rows(spark.read.parquet(parted).select("k", "v")) == [(1, "a"), (2, "b"), (3, "c"), (4, "new")]


def test_fixed_partitions_are_not_searched(spark, parted):
    source = spark.createDataFrame([(2, "B", 2020, "x y")], "k int, v string, y int, s string")
    assert upsert_partitions(spark, parted, source, ["k"], ["y", "s"], rows_move=False) == 1
    assert rows(spark.read.parquet(parted).where("k = 2").select("v")) == [("B",)]


def test_partition_delete(spark, parted):
    assert delete_from_partitions(spark, parted, "k IN (1, 3)", ["y", "s"]) == 2
    assert rows(spark.read.parquet(parted).select("k")) == [(2,), (4,), (5,)]
    assert delete_from_partitions(spark, parted, "k = 77", ["y", "s"]) == 0
    nothing = spark.read.parquet(parted).limit(0)
    assert upsert_partitions(spark, parted, nothing, ["k"], ["y", "s"]) == 0


def test_null_partition_value(spark, tmp_path):
    path = f"{tmp_path}/nullable"
    files.append_partitioned(spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, v string, p string"), path, ["p"])
    upsert_partitions(spark, path, spark.createDataFrame([(1, "A", None), (3, "C", None)], "k int, v string, p string"), ["k"], ["p"])
    assert rows(spark.read.parquet(path)) == [(1, "A", None), (2, "b", "x"), (3, "C", None)]
    delete_from_partitions(spark, path, "p IS NULL", ["p"])
    assert rows(spark.read.parquet(path)) == [(2, "b", "x")]


def test_partition_names_keep_their_type(spark, tmp_path):
    path, schema = f"{tmp_path}/months", "k int, v string, m string"
    files.append_partitioned(spark.createDataFrame([(1, "a", "01"), (2, "b", "02")], schema), path, ["m"])
    upsert_partitions(spark, path, spark.createDataFrame([(1, "A", "01"), (3, "C", "01")], schema), ["k"], ["m"])
    assert rows(spark.read.schema(schema).parquet(path)) == [(1, "A", "01"), (2, "b", "02"), (3, "C", "01")]


def test_partition_names_that_would_change_are_refused(spark, tmp_path):
    path, schema = f"{tmp_path}/months", "k int, m string"
    files.append_partitioned(spark.createDataFrame([(1, "01"), (2, "01"), (3, "11")], schema), path, ["m"])
    with pytest.raises(ValueError, match="use text"):
        delete_from_partitions(spark, path, "k = 1", ["m"])
    with pytest.raises(ValueError, match="use text"):
        upsert_partitions(spark, path, spark.createDataFrame([(1, 1)], "k int, m int"), ["k"], ["m"])
    typed = spark.createDataFrame([], schema).schema
    assert delete_from_partitions(spark, path, "k = 1", ["m"], typed) == 1
    assert rows(spark.read.schema(typed).parquet(path)) == [(2, "01"), (3, "11")]


def test_too_many_partitions_are_refused(spark, parted):
    source = spark.read.parquet(parted)
    with pytest.raises(ValueError, match="more than 1 partitions"):
        upsert_partitions(spark, parted, source, ["k"], ["y", "s"], max_partitions=1)
    assert spark.read.parquet(parted).count() == 5
    assert upsert_partitions(spark, parted, source, ["k"], ["y", "s"], max_partitions=None) > 1


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("string", ["a+b", "a b", "50%", "x/y", "a=b:c", None, "%2B"]),
        ("date", [dt.date(2024, 1, 1), dt.date(2024, 12, 31), None]),
        ("timestamp_ntz", [dt.datetime(2024, 1, 1, 12, 30, 5), dt.datetime(2024, 1, 1), None]),
    ],
)
def test_rows_move_between_oddly_named_partitions(spark, tmp_path, kind, values):
    schema = f"k int, v string, p {kind}"
    typed = spark.createDataFrame([], schema).schema
    for i, value in enumerate(values):
        path = f"{tmp_path}/{kind}{i}"
        others = [(10 + j, "o", other) for j, other in enumerate(values) if j != i]
        files.append_partitioned(spark.createDataFrame([(1, "o", value), *others], schema), path, ["p"])
        goal = values[(i + 1) % len(values)]
        upsert_partitions(spark, path, spark.createDataFrame([(1, "n", goal)], schema), ["k"], ["p"])
        assert rows(spark.read.schema(typed).parquet(path)) == sorted([(1, "n", goal), *others], key=repr)


def test_many_partitions_of_two_columns(spark, tmp_path):
    path = f"{tmp_path}/many"
    source = spark.range(1500).select("id", F.lit("a").alias("v"), F.col("id").alias("p"), (F.col("id") % 7).alias("q"))
    files.append_partitioned(source, path, ["p", "q"])
    assert upsert_partitions(spark, path, source.withColumn("v", F.lit("b")), ["id"], ["p", "q"]) == 1500
    assert rows(spark.read.parquet(path).groupBy("v").count()) == [("b", 1500)]


def test_new_columns_do_not_vanish_in_a_partitioned_upsert(spark, parted):
    source = spark.read.parquet(parted).withColumn("extra", F.lit(1))
    with pytest.raises(ValueError, match="extra"):
        upsert_partitions(spark, parted, source, ["k"], ["y", "s"])


def test_any_text_survives_csv(spark, tmp_path):
    texts = [None, "", " blank ends ", 'quo"te', '""', "a,b", "line\nbreak", "cr\r\nlf", "\\", "\\,", '"', "é\t"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    files.write_csv(df, f"{tmp_path}/csv")
    assert rows(files.read_csv(spark, f"{tmp_path}/csv", df.schema, multi_line=True)) == rows(df)
    (tmp_path / "other.csv").write_text('n,t\n1,"say ""a, b"" twice"\n')
    assert rows(files.read_csv(spark, f"{tmp_path}/other.csv", df.schema)) == [(1, 'say "a, b" twice')]
    with pytest.raises(Exception, match="holds a separator or a line break"):
        files.write_delimited(df.where("n >= 5"), f"{tmp_path}/delimited")


def test_extracts_with_odd_names(spark, tmp_path):
    extracts.write_table(spark.range(3), f"{tmp_path}/a+b 50%25", "t+1")
    found = extracts.read_split_extract(spark, f"{tmp_path}/a*")
    assert {piece: {name: df.count() for name, df in tables_.items()} for piece, tables_ in found.items()} == {"a+b 50%25": {"t+1": 3}}


def test_a_table_staged_in_both_modes_keeps_both_copies(spark, tmp_path):
    roots = {mode: f"{tmp_path}/{mode}" for mode in ("incremental", "full")}
    for mode, n in (("incremental", 2), ("full", 9)):
        extracts.write_table(spark.range(n), roots[mode], "orders")
    extracts.write_table(spark.range(5), roots["incremental"], "lines")
    entries = spark.createDataFrame([("lines", [("orders",)]), ("orders", [])], config.ENTRY_SCHEMA)
    asked = spark.createDataFrame([("lines",), ("orders",)], "source_table string")
    staged = stage_by_config(spark, asked, entries, roots, f"{tmp_path}/staging", "r", f"{tmp_path}/log")
    assert {step: df.count() for step, df in staged.items()} == {("full", "orders"): 9, ("incremental", "lines"): 5, ("incremental", "orders"): 2}
    assert spark.read.parquet(f"{tmp_path}/log").count() == 3


def test_append_log(spark, tmp_path):
    row = spark.createDataFrame([(dt.datetime(2024, 1, 1), "r", "n", "ok")], "ts timestamp_ntz, run_id string, name string, status string")
    files.append_log(row, f"{tmp_path}/log")
    files.append_log(row, f"{tmp_path}/log")
    assert spark.read.parquet(f"{tmp_path}/log").count() == 2


def test_scratch_must_be_shared_on_a_cluster():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session(spark_master="yarn"))
    assert scratch_root(Session(spark_master="yarn", spark_checkpoint_dir="hdfs:///shared/")) == "hdfs:///shared"
    local = Session(spark_master="local[2]", spark_app_id="only-here")
    assert scratch_root(local) == scratch_root(local)
