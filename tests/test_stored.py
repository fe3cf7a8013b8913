"""Byte-bounded chunks, key index, schema lattice, digest trees and stored pages."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martweave.model import FACT, TableSpec
from martweave.operators.lattice import NoCommonType, common_fields, lattice, least_common
from martweave.operators.ordering import chunk_ids_by_bytes
from martweave.operators.verify import row_diff
from martweave.plans import hash_tree, pages
from martweave.plans.key_index import files_with_keys, update_key_index
from martweave.plans.merge import merge_extracts
from martweave.plans.partitions import delete_from_partitions, upsert_partitions
from martweave.sources.files import append_partitioned


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def by_rule(sizes, bound):
    """Chunk of each row by the rule of ``chunk_ids_by_bytes``, row by row."""
    stretch, start, placed = bound * 32, 0, []
    for size in sizes:
        placed.append((start // stretch, start, size))
        start += size
    most = {}
    for s, _, size in placed:
        most[s] = max(most.get(s, 0), size if size * 2 <= bound else 0)
    runs, keys = 0, []
    for s, at, size in placed:
        heavy = size * 2 > bound
        keys.append((s, runs + heavy, (at - s * stretch) // (bound - most[s])))
        runs += 2 * heavy
    order = {k: i for i, k in enumerate(sorted(set(keys)))}
    return [order[k] for k in keys]


@pytest.mark.parametrize("parts", [1, 7])
def test_chunks_are_bounded_in_bytes(spark, parts):
    rng = random.Random(4)
    sizes = [rng.choice([1, 3, 10, 10, 40, 49, 51, 90, 130]) if i < 500 else 7 for i in range(4000)]
    rows = spark.createDataFrame([(i if i else None, s) for i, s in enumerate(sizes)], "k bigint, n bigint").repartition(parts)
    found = {r.k or 0: r.chunk_id for r in chunk_ids_by_bytes(rows, ["k"], 100, F.col("n")).collect()}
    ids = [found[i] for i in range(4000)]
    assert ids == by_rule(sizes, 100)
    total, count = {}, {}
    for i, c in enumerate(ids):
        total[c], count[c] = total.get(c, 0) + sizes[i], count.get(c, 0) + 1
    assert sorted(total) == list(range(len(total)))
    assert all(b <= 100 or count[c] == 1 for c, b in total.items())
    # Even rows fill their chunks but for one row's worth, and one chunk in 32.
    even = {c for i, c in enumerate(ids) if i > 600}
    assert len(even) <= 1.1 * sum(sizes[600:]) / 93 + 2


def test_chunks_of_default_size_ties_and_nothing(spark):
    rows = spark.createDataFrame([(1, "é" * 10), (1, None), (1, "x"), (2, "y" * 100)], "k int, t string")
    found = chunk_ids_by_bytes(rows, ["k"], 40, unique=False).groupBy("chunk_id").agg(F.sum(F.octet_length(F.coalesce("t", F.lit(""))) + 3).alias("bytes"))
    assert sorted(r.bytes for r in found.collect()) in ([3, 27, 103], [30, 103], [7, 23, 103], [4, 26, 103], [33, 103])
    assert chunk_ids_by_bytes(rows.limit(0), ["k"], 40).count() == 0
    with pytest.raises(ValueError, match="positive"):
        chunk_ids_by_bytes(rows, ["k"], 0)


def test_no_window_spans_the_table(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit(5).cast("bigint").alias("n"))
    # Windows are over one row per range partition: the sort of the rows themselves is a plain one.
    plan = plan_of(chunk_ids_by_bytes(rows, ["k"], 50, F.col("n")))
    assert "SinglePartition" not in plan.split("FileScan")[0]


KEYED = "k bigint, name string, v int, p int"


def stored_by_p(spark, rows, path, schema=KEYED):
    append_partitioned(spark.createDataFrame(rows, schema), path, ["p"])


def content(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).select("k", "name", "v", "p").collect()), key=repr)


@pytest.mark.parametrize("keys", [["k"], ["name"], ["k", "name"]])
def test_upserts_with_and_without_index_agree(spark, tmp_path, keys):
    rows = [(i if i % 50 else None, f"n {i}", 0, i % 8) for i in range(400)]
    source = spark.createDataFrame([(7, "n 7", 1, 2), (16, "n 16", 1, 0), (1000, "new+1", 1, 99), (None, "n 50", 1, 3)], KEYED)
    results = []
    for kind in ("scan", "index", "stale", "absent"):
        path = str(tmp_path / f"t {kind}")
        stored_by_p(spark, rows, path)
        if kind in ("index", "stale"):
            assert update_key_index(spark, path, keys, ["p"]) >= 8
        if kind == "stale":
            # A partition is rewritten behind the index's back, with keys it does not know.
            moved = spark.createDataFrame([(1000, "new+1", 0, 5), (7, "n 7", 0, 5)], KEYED)
            append_partitioned(moved, path, ["p"])
        if kind == "stale":
            assert len(files_with_keys(spark, path, source, keys, ["p"], source.schema)) >= 3
        upsert_partitions(spark, path, source, keys, ["p"], key_index=kind != "scan")
        upsert_partitions(spark, path, source, keys, ["p"], key_index=kind != "scan")
        results.append(content(spark, path))
        if kind == "index":
            assert update_key_index(spark, path, keys, ["p"]) == 0
    assert results[0] == results[1] == results[3]
    if keys == ["k"]:
        assert results[2] == results[0]


def test_index_names_few_files(spark, tmp_path):
    path = str(tmp_path / "table")
    # Ascending keys: ranges decide. Shuffled keys: filters decide.
    stored_by_p(spark, [(i, f"{(i * 7919) % 8000}", 0, i // 1000) for i in range(8000)], path)
    schema = spark.read.parquet(path).schema
    one = spark.createDataFrame([(4321, f"{(4321 * 7919) % 8000}", 1, 4), (None, None, 1, 0)], KEYED)
    assert files_with_keys(spark, path, one, ["k"], ["p"], schema) is None
    for keys in (["k"], ["name"]):
        update_key_index(spark, path, keys, ["p"])
        found = files_with_keys(spark, path, one, keys, ["p"], schema)
        assert any("p=4" in f for f in found) and len(found) <= 2
        read = spark.read.schema(schema).option("basePath", path).parquet(*found)
        assert read.where("k = 4321").count() == 1 and len(read.inputFiles()) <= 2
    every = spark.read.parquet(path)
    assert len(files_with_keys(spark, path, every, ["k"], ["p"], schema)) == len(every.inputFiles())
    none = spark.createDataFrame([(-5, "nobody", 1, 4)], KEYED)
    assert files_with_keys(spark, path, none, ["k"], ["p"], schema) == []
    delete_from_partitions(spark, path, "k = 4321", ["p"], key_index=["k"])
    assert files_with_keys(spark, path, one, ["k"], ["p"], schema) == []


def test_least_common_types():
    i, lo, d, s, day, ntz, tz = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType(), T.TimestampNTZType(), T.TimestampType()
    for a, b, c in [
        (i, lo, lo), (lo, d, d), (T.FloatType(), i, d), (i, s, s), (d, s, s), (day, ntz, ntz), (day, tz, tz), (ntz, tz, s), (day, s, s), (T.NullType(), day, day),
        (T.DecimalType(10, 2), T.DecimalType(8, 4), T.DecimalType(12, 4)), (i, T.DecimalType(5, 2), T.DecimalType(12, 2)),
        (T.DecimalType(38, 0), T.DecimalType(38, 30), s), (T.BooleanType(), i, s),
        (T.ArrayType(i, False), T.ArrayType(lo), T.ArrayType(lo)), (T.MapType(s, i), T.MapType(s, d), T.MapType(s, d)),
        (T.StructType([T.StructField("a", i)]), T.StructType([T.StructField("B", s)]), T.StructType([T.StructField("a", i), T.StructField("B", s)])),
    ]:
        assert least_common(a, b) == c and least_common(b, a).simpleString().lower().replace("b:string,a:int", "a:int,b:string") == c.simpleString().lower()
    for a, b in [(T.BinaryType(), i), (T.ArrayType(i), s), (T.StructType(), s)]:
        with pytest.raises(NoCommonType, match="no common type"):
            least_common(a, b)


def test_all_clashes_are_named(spark):
    a = T.StructType([T.StructField("x", T.BinaryType()), T.StructField("y", T.ArrayType(T.IntegerType()))])
    b = T.StructType([T.StructField("X", T.IntegerType()), T.StructField("y", T.StringType())])
    with pytest.raises(NoCommonType, match=r"x: .*piece 0, piece 1\); y: "):
        common_fields([a, b])
    rows = [spark.createDataFrame([(bytearray(b"1"),)], "x binary"), spark.createDataFrame([(1,)], "x int")]
    with pytest.raises(NoCommonType, match="facts: x"):
        merge_extracts([TableSpec("facts", ("x",), kind=FACT)], {"facts": rows})


def test_columns_of_later_pieces_survive(spark):
    pieces = [spark.createDataFrame([(1, 2)], "id int, a int"), spark.createDataFrame([(2, 3.5)], "ID bigint, a double"), spark.createDataFrame([(3, 4, "kept")], "id int, a int, extra string")]
    merged = merge_extracts([TableSpec("t", ("id",), kind=FACT)], {"t": pieces})
    assert sorted(map(tuple, merged.tables["t"].collect())) == [(1, 2.0, None), (2, 3.5, None), (3, 4.0, "kept")]
    assert [f.nullable for f in merged.schemas["t"].fields] == [False, True, True]
    assert merged.changes["t"] == ((0, "id", "int", "bigint"), (0, "a", "int", "double"), (0, "extra", None, "string"), (1, "extra", None, "string"), (2, "id", "int", "bigint"), (2, "a", "int", "double"))
    assert lattice(pieces[:1]).changes == ()
    declared = merge_extracts([TableSpec("t", ("id",), kind=FACT, schema=pieces[0].schema)], {"t": pieces})
    assert declared.dropped["t"] == ((2, "extra"),) and declared.tables["t"].columns == ["id", "a"]


@pytest.fixture(scope="module")
def copies(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("digests")
    rows = spark.range(3000).select("id", (F.col("id") % 7).alias("v"), F.concat(F.lit("t"), "id").alias("t"))
    rows = rows.unionByName(spark.range(200).select(F.lit(5).cast("bigint").alias("id"), F.lit(1).cast("bigint").alias("v"), F.lit("hot").alias("t")))
    hash_tree.store_with_digests(rows, str(root / "a"), ["id"], 4, 3)
    return root, rows


def test_one_changed_row_opens_one_branch(spark, copies):
    root, rows = copies
    changed = rows.withColumn("t", F.when(F.col("id") == 1234, "other").otherwise(F.col("t"))).select("t", "v", "id")
    hash_tree.store_with_digests(changed, str(root / "b"), ["id"], 4, 3)
    diff = hash_tree.diff_stored(spark, str(root / "a"), str(root / "b"), ["id"])
    assert [tuple(r) for r in diff.rows.collect()] == [(1234, 1, 1, "changed")]
    # The root, then four children of one node on each level; one directory of each copy is read.
    assert (diff.leaves, diff.nodes) == (1, 1 + 3 * 4)
    assert plan_of(diff.rows).count("PartitionFilters: [isnotnull(_leaf") >= 2


def test_tree_finds_what_row_diff_finds(spark, copies):
    root, rows = copies
    other = rows.where("id % 10 <> 3").withColumn("v", F.when(F.col("id") < 40, -1).otherwise(F.col("v"))).unionByName(
        spark.range(9000, 9050).select("id", F.lit(0).cast("bigint").alias("v"), F.lit(None).cast("string").alias("t"))
    )
    hash_tree.store_with_digests(other, str(root / "c"), ["id"], 4, 3)
    diff = hash_tree.diff_stored(spark, str(root / "a"), str(root / "c"), ["id"])
    expected = row_diff(rows, other, ["id"]).where("status <> 'equal'")
    assert sorted(map(tuple, diff.rows.collect())) == sorted(map(tuple, expected.collect()))
    same = hash_tree.diff_stored(spark, str(root / "a"), str(root / "a"), ["id"])
    assert (same.rows.count(), same.leaves, same.nodes) == (0, 0, 1)


def test_an_empty_copy(spark, copies):
    root, rows = copies
    hash_tree.store_with_digests(rows.limit(0), str(root / "f"), ["id"], 4, 3)
    diff = hash_tree.diff_stored(spark, str(root / "f"), str(root / "a"), ["id"])
    assert diff.rows.groupBy("status").count().collect() == [("only_right", 3000)]


def test_trees_of_other_shape_are_refused(spark, copies):
    root, rows = copies
    hash_tree.store_with_digests(rows, str(root / "d"), ["id"], 2, 3)
    hash_tree.store_with_digests(rows.drop("t"), str(root / "e"), ["id"], 4, 3)
    for other in "de":
        with pytest.raises(ValueError, match="differ in the shape"):
            hash_tree.diff_stored(spark, str(root / "a"), str(root / other), ["id"])


def test_pages_in_turn_are_the_table(spark, tmp_path):
    rows = spark.range(1000).select("id", F.nullif(F.col("id") % 10, F.lit(0)).alias("v"), F.concat(F.lit("x"), "id").alias("t"))
    path = str(tmp_path / "pages")
    pages.store_pages(rows.repartition(6), path, ["v", "id"], rows_per_file=130)
    expected = [tuple(r) for r in rows.orderBy(F.asc_nulls_first("v"), "id").collect()]
    found = []
    for offset in range(0, 1100, 97):
        page = pages.read_page(spark, path, offset, 97)
        assert "Sort" not in plan_of(page) and "Exchange" not in plan_of(page)
        assert len(page.inputFiles()) <= 2
        own = sorted(page.collect(), key=lambda r: r["_row"])
        assert [r["_row"] for r in own] == list(range(offset + 1, min(offset + 97, 1000) + 1))
        found += [(r["id"], r["v"], r["t"]) for r in own]
    assert found == expected
    assert pages.read_page(spark, path, 5000, 10).count() == 0 and pages.read_page(spark, path, 0, 0).count() == 0
    for key in ((3, 500), (3, 503), (9, 999), (None, 400)):
        first = next((i for i, (i_, v, _) in enumerate(expected) if ((v is not None, v or 0), i_) >= ((key[0] is not None, key[0] or 0), key[1])), 1000)
        own = sorted(pages.read_from_key(spark, path, key, 5).collect(), key=lambda r: r["_row"])
        assert [(r["id"], r["v"], r["t"]) for r in own] == expected[first : first + 5]
    assert pages.read_from_key(spark, path, (99, 0), 5).count() == 0


def test_pages_of_ties_and_of_nothing(spark, tmp_path):
    rows = spark.range(300).select((F.col("id") % 2).alias("v"))
    pages.store_pages(rows, str(tmp_path / "ties"), ["v"], unique=False, rows_per_file=40)
    found = [r["v"] for k in range(6) for r in sorted(pages.read_page(spark, str(tmp_path / "ties"), 50 * k, 50).collect(), key=lambda r: r["_row"])]
    assert found == [0] * 150 + [1] * 150
    with pytest.raises(ValueError, match="positive"):
        pages.store_pages(rows, str(tmp_path / "x"), ["v"], rows_per_file=0)
    pages.store_pages(rows.limit(0), str(tmp_path / "none"), ["v"], rows_per_file=40)
    assert pages.read_page(spark, str(tmp_path / "none"), 0, 10).count() == 0


def test_two_publishers_lose_no_release(spark, tmp_path, monkeypatch):
    from martweave.plans import publish

    root = str(tmp_path / "mart")
    rows = {name: spark.range(n).withColumnRenamed("id", name) for n, name in enumerate("abc", start=3)}
    publish.publish_release(spark, root, rows, "first")
    stage, others = publish.stage_table, []

    def interleaved(other):
        """While a table is staged, another publisher gets ahead, once."""

        def staging(df, path, partition_by=()):
            if other not in others:
                others.append(other)
                monkeypatch.setattr(publish, "stage_table", stage)
                publish.publish_release(spark, root, {other: spark.range(10).withColumnRenamed("id", other)}, f"ahead-{other}")
            return stage(df, path, partition_by)

        monkeypatch.setattr(publish, "stage_table", staging)

    interleaved("b")
    publish.publish_release(spark, root, {"a": spark.range(7).withColumnRenamed("id", "a")}, "second")
    counts = {name: publish.read_published(spark, root, name).count() for name in "abc"}
    assert counts == {"a": 7, "b": 10, "c": 5}
    interleaved("c")
    with pytest.raises(publish.PublishConflict, match="ahead-c.* changed c"):
        publish.publish_release(spark, root, {"c": spark.range(1).withColumnRenamed("id", "c")}, "third")
    assert publish.read_published(spark, root, "c").count() == 10
    log = publish.release_log(spark, root).select("sequence", "run_id").distinct().orderBy("sequence").collect()
    assert [tuple(r) for r in log] == [(1, "first"), (2, "ahead-b"), (3, "second"), (4, "ahead-c")]
    # Content made from an old release conflicts as well, other tables do not.
    with pytest.raises(publish.PublishConflict):
        publish.publish_release(spark, root, {"c": spark.range(1).withColumnRenamed("id", "c")}, "fourth", base=1)
    publish.publish_release(spark, root, {"d": spark.range(1)}, "fifth", base=1)
    assert publish.current_sequence(spark, root) == 5


def test_intervals_merge_and_cover(spark):
    import datetime as dt

    from martweave.operators.gates import covered_seconds, merge_intervals

    rng, zero = random.Random(3), dt.datetime(2024, 1, 1)
    at = [(rng.choice(["a", "b", None]), *sorted((rng.randrange(2000), rng.randrange(2000)))) for _ in range(120)]
    at = [(g, s, min(e, s + 40)) for g, s, e in at] + [("a", 5, None), ("a", 50, 50)]

    def frame(rows):
        return spark.createDataFrame([(g, zero + dt.timedelta(seconds=s), None if e is None else zero + dt.timedelta(seconds=e)) for g, s, e in rows], "g string, s timestamp_ntz, e timestamp_ntz")

    merged = merge_intervals(frame(at), "s", "e", ["g"])
    closed = {g: {t for h, s, e in at if h == g and e is not None for t in range(s, e)} for g in ("a", "b", None)}
    expected = set()
    for g, own in closed.items():
        for t in own:
            if t - 1 not in own:
                end = t
                while end in own:
                    end += 1
                expected.add((g, zero + dt.timedelta(seconds=t), zero + dt.timedelta(seconds=end)))
    assert {tuple(r) for r in merged.collect()} == expected
    waits = [(rng.choice(["a", "b", "c", None]), s, s + rng.randrange(0, 400)) for s in (rng.randrange(2000) for _ in range(200))]
    found = covered_seconds(frame(waits), "s", "e", merged, "s", "e", ["g"]).collect()
    assert sorted(((r.g or "", r.s, r.e, r.covered_seconds) for r in found)) == sorted(
        (g or "", zero + dt.timedelta(seconds=s), zero + dt.timedelta(seconds=e), float(len(closed.get(g, set()) & set(range(s, e))))) for g, s, e in waits
    )
