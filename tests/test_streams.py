"""Folder streams drained with availableNow: nothing twice, nothing lost, replays converge."""

import datetime as dt

from pyspark.sql import functions as F

from martweave.sources import files
from martweave.streaming import arrivals as st

SCHEMA = "name string, ts timestamp_ntz, stage string"
AT = dt.datetime(2024, 1, 1)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def land(spark, path, data, schema=SCHEMA):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(str(path))


def test_arrivals_are_emitted_once(spark, tmp_path):
    inbox, out, checkpoint = (f"{tmp_path}/{n}" for n in ("inbox", "out", "checkpoint"))

    def drain():
        stream = st.tag_priority(st.watch_folder(spark, inbox, SCHEMA, files_per_trigger=1))
        st.drain_to_table(stream, out, checkpoint).awaitTermination()
        return rows(spark.read.parquet(out).select("name", "priority"))

    land(spark, inbox, [("DLE_1", AT, "extract"), ("b_MR_1", AT, "extract")])
    assert drain() == [("DLE_1", 1), ("b_MR_1", 2)]
    assert drain() == [("DLE_1", 1), ("b_MR_1", 2)]
    land(spark, inbox, [("job", AT, "extract")])
    assert drain() == [("DLE_1", 1), ("b_MR_1", 2), ("job", 3)]


def test_names_only(spark, tmp_path):
    (tmp_path / "inbox").mkdir()
    (tmp_path / "inbox" / "DLE_7.data").write_bytes(b"x" * 10)
    stream = st.tag_priority(st.watch_names(spark, f"{tmp_path}/inbox"))
    st.drain_to_table(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/out").select("name", "priority")) == [("DLE_7.data", 1)]


def test_repeats_across_files(spark, tmp_path):
    inbox = f"{tmp_path}/inbox"
    land(spark, inbox, [("a", AT, "extract"), ("b", AT, "extract")])
    land(spark, inbox, [("a", AT, "extract"), ("c", AT, "extract")])
    late = dt.datetime(2001, 1, 1)
    land(spark, inbox, [("late", late, "extract"), ("b", late, "publish")])

    def drain():
        stream = st.watch_folder(spark, inbox, SCHEMA, files_per_trigger=1).drop("source_file")
        st.drain_new(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", ["name"], ["ts"]).awaitTermination()
        return rows(spark.read.parquet(f"{tmp_path}/out").select("name"))

    assert drain() == [("a",), ("b",), ("c",), ("late",)]
    land(spark, inbox, [("d", late, "extract"), ("late", AT, "extract")])
    assert drain() == [("a",), ("b",), ("c",), ("d",), ("late",)]


def test_a_late_older_row_does_not_undo_a_newer_one(spark, tmp_path):
    path, inbox = f"{tmp_path}/table", f"{tmp_path}/inbox"
    schema = "k int, version int, p int"
    files.append_partitioned(spark.createDataFrame([(1, 5, 1), (2, 5, 2)], schema), path, ["p"])
    for version, checkpoint in ((4, "a"), (6, "b")):
        land(spark, f"{inbox}{version}", [(1, version, 1), (3, version, 1)], schema)
        for rows_move in (True, False):
            stream = st.watch_folder(spark, f"{inbox}{version}", schema).drop("source_file")
            st.drain_to_upserts(
                stream, path, f"{tmp_path}/{checkpoint}{rows_move}", ["k"], ["p"], latest_by=["version"], rows_move=rows_move
            ).awaitTermination()
        assert rows(spark.read.parquet(path)) == [(1, max(5, version), 1), (2, 5, 2), (3, version, 1)]


def test_upserts_converge_on_replay(spark, tmp_path):
    path, inbox = f"{tmp_path}/table", f"{tmp_path}/inbox"
    schema = "k int, v string, p int"
    files.append_partitioned(spark.createDataFrame([(1, "old", 1), (2, "old", 2)], schema), path, ["p"])
    land(spark, inbox, [(1, "new", 1), (3, "new", 1)], schema)

    def drain(checkpoint):
        stream = st.watch_folder(spark, inbox, schema).drop("source_file")
        st.drain_to_upserts(stream, path, f"{tmp_path}/{checkpoint}", ["k"], ["p"]).awaitTermination()
        return rows(spark.read.parquet(path))

    expected = [(1, "new", 1), (2, "old", 2), (3, "new", 1)]
    assert drain("first") == expected
    assert drain("lost-checkpoint") == expected, "the same files again leave the same table"


def test_late_log_entries_do_not_undo_newer_ones(spark, tmp_path):
    path, inbox = f"{tmp_path}/stages", f"{tmp_path}/inbox"
    schema = SCHEMA + ", bucket int"
    files.append_partitioned(spark.createDataFrame([("a", AT + dt.timedelta(5), "publish", 0)], schema), path, ["bucket"])
    land(spark, inbox, [("a", AT, "extract", 0), ("b", AT, "extract", 0), ("b", AT + dt.timedelta(1), "hyper", 0)], schema)
    stream = st.watch_folder(spark, inbox, schema).drop("source_file")
    st.drain_latest_stage(stream, path, f"{tmp_path}/checkpoint").awaitTermination()
    assert rows(spark.read.parquet(path).select("name", "stage")) == [("a", "publish"), ("b", "hyper")]


def test_empty_inbox(spark, tmp_path):
    (tmp_path / "inbox").mkdir()
    stream = st.watch_folder(spark, f"{tmp_path}/inbox", SCHEMA)
    st.drain_to_table(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    assert spark.read.schema(SCHEMA).parquet(f"{tmp_path}/out").agg(F.count("*")).first()[0] == 0


def test_bounded_repeats_replayed_and_late(spark, tmp_path):
    inbox, out, late, checkpoint = (f"{tmp_path}/{n}" for n in ("inbox", "out", "late", "checkpoint"))

    def drain():
        stream = st.watch_folder(spark, inbox, SCHEMA).drop("source_file")
        st.drain_new_within(stream, out, late, checkpoint, ["name"], "ts", "2 days").awaitTermination()
        return [rows(spark.read.parquet(p).select("name", "ts")) for p in (out, late)]

    day = dt.timedelta(days=1)
    land(spark, inbox, [("a", AT, "x"), ("b", AT + day, "x"), ("b", AT + day, "x")])
    assert drain() == [[("a", AT), ("b", AT + day)], []]
    land(spark, inbox, [("b", AT + day, "x"), ("c", AT + 9 * day, "x"), ("none", None, "x")])
    first = [[("a", AT), ("b", AT + day), ("c", AT + 9 * day)], [("none", None)]]
    assert drain() == first
    # Nothing new, then late rows: known or not, they can no longer be told apart and are kept aside.
    assert drain() == first
    land(spark, inbox, [("a", AT, "x"), ("new", AT + 2 * day, "x"), ("d", AT + 8 * day, "x")])
    assert drain() == [sorted([*first[0], ("d", AT + 8 * day)], key=repr), sorted([("a", AT), ("new", AT + 2 * day), ("none", None)], key=repr)]


def test_stage_machine_refuses_and_reports_stuck_jobs(spark, tmp_path):
    from martweave.streaming.stages import check_stages

    inbox, out, checkpoint = (f"{tmp_path}/{n}" for n in ("inbox", "out", "checkpoint"))

    def drain():
        judged = check_stages(st.watch_folder(spark, inbox, SCHEMA).drop("source_file"), "1 hour", "1 day")
        st.drain_to_table(judged, out, checkpoint).awaitTermination()
        return {(r.name, r.stage, r.after, r.outcome) for r in spark.read.parquet(out).collect()}

    hour = dt.timedelta(hours=1)
    land(spark, inbox, [("a", AT, "extract"), ("a", AT + hour, "publish"), ("a", AT + 2 * hour, "hyper"), ("b", AT, "hyper"), ("c", AT, "extract")])
    first = {("a", "extract", None, "accepted"), ("a", "publish", "extract", "refused"), ("a", "hyper", "extract", "accepted"), ("b", "hyper", None, "refused"), ("c", "extract", None, "accepted")}
    assert drain() == first
    land(spark, inbox, [("a", AT + 3 * hour, "publish"), ("a", AT + 4 * hour, "completed"), ("a", AT + 5 * hour, "completed"), ("d", AT + 72 * hour, "extract")])
    second = first | {("a", "publish", "hyper", "accepted"), ("a", "completed", "publish", "accepted"), ("a", "completed", "completed", "refused"), ("d", "extract", None, "accepted")}
    found = drain()
    land(spark, inbox, [("e", AT + 73 * hour, "extract")])
    found = drain()
    assert found - second - {("e", "extract", None, "accepted")} == {("c", "extract", "extract", "stuck")}
    land(spark, inbox, [("c", AT + 74 * hour, "hyper")])
    assert ("c", "hyper", "extract", "accepted") in drain()


def test_growing_files_are_read_once_and_whole(spark, tmp_path):
    from martweave.streaming.admission import admit, drain_admitted, entries

    inbox, ledger, out, checkpoint = tmp_path / "inbox", f"{tmp_path}/ledger", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    inbox.mkdir()

    def drain():
        drain_admitted(spark, ledger, out, checkpoint, "v string", "text").awaitTermination()
        return [r.v for r in spark.read.parquet(out).orderBy("position", "v").collect()]

    (inbox / "b +1.txt").write_text("b1\n")
    assert admit(spark, str(inbox), ledger) == 0 and entries(spark, ledger) is None
    with (inbox / "b +1.txt").open("a") as file:
        file.write("b2\n")
    (inbox / "a.txt").write_text("a1\n")
    assert admit(spark, str(inbox), ledger) == 0
    assert admit(spark, str(inbox), ledger) == 2
    assert drain() == ["b1", "b2", "a1"]
    assert admit(spark, str(inbox), ledger) == 0 and drain() == ["b1", "b2", "a1"]
    (inbox / "c.txt").write_text("c1\n")
    admit(spark, str(inbox), ledger)
    assert admit(spark, str(inbox), ledger) == 1 and drain() == ["b1", "b2", "a1", "c1"]
    assert [r.position for r in entries(spark, ledger).orderBy("position").collect()] == [1, 2, 3]
