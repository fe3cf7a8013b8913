"""Operators against plain-Python brute force on generated rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martweave.model import ForeignKey
from martweave.operators import actions, keys, ordering, verify

SETTINGS = settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
KEY = st.one_of(st.none(), st.integers(0, 5))
ROWS = st.lists(st.tuples(KEY, st.one_of(st.none(), st.sampled_from("abc"))), max_size=12)
SCHEMA = "k int, v string"


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@SETTINGS
@given(target=ROWS, source=ROWS)
def test_upsert(spark, target, source):
    result = actions.upsert(
        spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA), ["k"], latest_by=["v"]
    )
    order = lambda v: (v is not None, v or "")
    latest = {}
    for k, v in source:
        if k is not None and (k not in latest or order(v) > order(latest[k])):
            latest[k] = v
    expected = [r for r in target if r[0] is None or r[0] not in latest]
    expected += list(latest.items()) + [r for r in source if r[0] is None]
    assert bag(result.collect()) == bag(expected)


@SETTINGS
@given(left=ROWS, right=ROWS)
def test_row_diff(spark, left, right):
    def group(rows):
        found = {}
        for k, v in rows:
            found.setdefault(k, []).append(v)
        return {k: sorted(v, key=repr) for k, v in found.items()}

    a, b = group(left), group(right)
    expected = {}
    for k in a.keys() | b.keys():
        if k not in b:
            expected[k] = "only_left"
        elif k not in a:
            expected[k] = "only_right"
        else:
            expected[k] = "equal" if a[k] == b[k] else "changed"
    diff = verify.row_diff(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["k"]).collect()
    assert {r["k"]: r["status"] for r in diff} == expected
    assert {r["k"]: (r["left_rows"], r["right_rows"]) for r in diff} == {
        k: (len(a.get(k, [])), len(b.get(k, []))) for k in expected
    }


@SETTINGS
@given(left=ROWS, right=ROWS)
def test_same_content(spark, left, right):
    same = verify.same_content(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA))
    assert same == (bag(left) == bag(right))


@SETTINGS
@given(fact=ROWS, dimension=st.lists(KEY, max_size=6))
def test_foreign_keys_partition_the_fact(spark, fact, dimension):
    fk = ForeignKey(("k",), "d", ("id",))
    facts = spark.createDataFrame(fact, SCHEMA)
    dims = spark.createDataFrame([(d,) for d in dimension], "id int")
    known = {d for d in dimension if d is not None}
    assert bag(keys.fk_valid(facts, dims, fk).select("k", "v").collect()) == bag(r for r in fact if r[0] in known)
    assert bag(keys.fk_orphans(facts, dims, fk).select("k", "v").collect()) == bag(r for r in fact if r[0] not in known)


@SETTINGS
@given(rows=ROWS, ranges=st.integers(1, 4))
def test_row_index(spark, rows, ranges):
    numbered = [(k, v, i) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(numbered, "k int, v string, i int")
    indexed = ordering.row_index(df, ["v", "i"], ["k"], ranges=ranges).collect()
    order = lambda r: (r[1] is not None, r[1] or "", r[2])
    expected = []
    for key in {r[0] for r in numbered}:
        group = sorted((r for r in numbered if r[0] == key), key=order)
        expected += [(*r, position) for position, r in enumerate(group, start=1)]
    assert bag(indexed) == bag(expected)
