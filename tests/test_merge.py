"""Merge arms, history and the planner, on small inputs with known answers and against a plain model."""

import random

import pytest

from tidemark.operators import merge, scd2
from tidemark.operators.merge import MergeSpec
from tidemark.operators.survivors import survivors, with_keys
from tidemark.plans.commit import Facts, Table, plan_commit
from tidemark.plans.options import OptionError, Scd2Options, TableOptions, check_opened, check_parsed

COLUMNS = "id long, day string, seq int, name string, deleted boolean, arrival int"


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def unit(spark, *values):
    return spark.createDataFrame([(i, d, s, n, f, k) for k, (i, d, s, n, f) in enumerate(values)], COLUMNS)


def test_survivors(spark):
    df = unit(spark, (1, None, 5, "newest", None), (1, None, 3, "older", None))
    assert rows(survivors(df, ["id"], "arrival"), "name") == [("older",)]
    assert rows(survivors(df, ["id"], "arrival", ("seq", "desc")), "name") == [("newest",)]
    assert rows(survivors(df, ["id"], "arrival", ("seq", "asc")), "name") == [("older",)]
    nulls = unit(spark, (1, None, None, "null-seq", None), (1, None, 3, "valued", None))
    for way in ("asc", "desc"):
        assert rows(survivors(nulls, ["id"], "arrival", ("seq", way)), "name") == [("valued",)]
    none = unit(spark, (1, None, None, "first", None), (1, None, None, "last", None))
    assert rows(survivors(none, ["id"], "arrival", ("seq", "desc")), "name") == [("last",)]


def test_scope(spark):
    target = unit(spark, (1, "d1", 0, "d1-a", None), (2, "d1", 0, "d1-b", None), (3, "d2", 0, "d2-a", None), (4, None, 0, "none", None))
    stage = unit(spark, (1, "d1", 0, "d1-a2", None), (5, None, 0, "no scope", None))
    out = merge.delete_insert(target, stage, MergeSpec(("id",), "arrival", scope=("day",)))
    assert rows(out, "id", "name") == [(1, "d1-a2"), (3, "d2-a"), (4, "none"), (5, "no scope")]


@pytest.mark.parametrize("seed", range(4))
def test_arms_against_a_dict(spark, seed):
    rng = random.Random(seed)
    target = {i: f"old{i}" for i in range(8)}
    stage = [(rng.randrange(12), None, rng.choice([None, 1, 2, 3]), f"n{k}", rng.choice([None, True, False])) for k in range(20)]
    best = {}
    for k, (i, _, s, n, f) in enumerate(stage):
        order = (s is not None, s or 0, k)
        if i not in best or order > best[i][0]:
            best[i] = (order, n, f)
    want = {i: n for i, n in target.items() if i not in best} | {i: n for i, (_, n, f) in best.items() if f is not True}
    old = spark.createDataFrame(list(target.items()), "id long, name string")
    spec = MergeSpec(("id",), "arrival", ("seq", "desc"), "deleted")
    for arm in (merge.delete_insert, merge.upsert):
        assert dict(rows(arm(old, unit(spark, *stage), spec), "id", "name")) == want


def test_null_keys_fail(spark):
    with pytest.raises(Exception, match="null in merge key id"):
        with_keys(unit(spark, (None, None, 1, "x", None)), ["id"]).collect()


def test_flagged_roots_and_children(spark):
    roots = spark.createDataFrame([("r", True, 0), ("r", None, 1), ("q", True, 2)], "_sys_id string, deleted boolean, arrival int")
    kids = spark.createDataFrame([("k1", "r", 0), ("k2", "q", 1)], "_sys_id string, _sys_root_id string, arrival int")
    old = spark.createDataFrame([("k0", "r"), ("k9", "z")], "_sys_id string, _sys_root_id string")
    out = merge.merge_children(old, kids, roots, "_sys_id", "_sys_root_id", "arrival", "_sys_id", "arrival", "deleted")
    assert rows(out, "_sys_id") == [("k1",), ("k9",)]


def test_history(spark):
    one = lambda *v: spark.createDataFrame([(i, n, k) for k, (i, n) in enumerate(v)], "id long, name string, arrival int")
    h = scd2.first_history(one((1, "a"), (2, "b")).drop("x"), ["id"], "arrival", "2024-01-01 00:00:00").drop("arrival")
    h = scd2.scd2_merge(h, one((1, "a2"), (2, "b")), ["id"], "arrival", "2024-02-01 00:00:00")
    h = scd2.scd2_merge(h, one((1, "a3")), ["id"], "arrival", "2024-03-01 00:00:00")
    assert rows(h.groupBy("id").count(), "id", "count") == [(1, 3), (2, 1)]
    assert rows(h.filter("_valid_to is null"), "id", "name") == [(1, "a3"), (2, "b")]
    assert scd2.overlaps(h, ["id"]).count() == 0
    assert rows(scd2.as_of(h, "2024-01-15 00:00:00"), "id", "name") == [(1, "a"), (2, "b")]
    gone = scd2.scd2_merge(h, one((1, "a3")), ["id"], "arrival", "2024-04-01 00:00:00", absent="retire")
    assert rows(gone.filter("_valid_to is null"), "id") == [(1,)]
    same = scd2.scd2_merge(gone, one().limit(0), ["id"], "arrival", "2024-05-01 00:00:00", absent="retire")
    assert rows(same.filter("_valid_to is null"), "id") == [(1,)]  # an empty unit retires nothing
    back = scd2.scd2_merge(gone, one((2, "b")), ["id"], "arrival", "2024-05-01 00:00:00")
    assert rows(back.filter("id = 2 and _valid_to is null"), "name") == [("b",)]


def test_planner():
    scoped = Table("t", "merge", ("id",), TableOptions(merge_scope=("day",)))
    kinds = lambda ts, f: [s.kind for s in plan_commit(ts, f)]
    assert kinds([scoped], Facts("l", 0)) == ["scope_replace", "merge", "truncate_stage", "upsert_state", "insert_receipt"]
    assert kinds([scoped], Facts("l", 1, empty=frozenset("t"))) == ["truncate_stage", "upsert_state", "insert_receipt"]
    with pytest.raises(OptionError, match="merge_scope"):
        plan_commit([scoped], Facts("l", 1, published=frozenset("t")))
    assert kinds([Table("t", "replace")], Facts("l", 0))[:2] == ["clear_target", "insert"]
    assert kinds([Table("t", "replace")], Facts("l", 1, cleared=frozenset("t")))[0] == "insert"
    assert kinds([Table("t", "append")], Facts("l", 0, committed=True)) == ["truncate_stage"]
    with pytest.raises(OptionError, match="keyed"):
        plan_commit([Table("t", "merge", (), TableOptions(strategy="upsert"), keyed=False)], Facts("l", 0))


@pytest.mark.parametrize("options, why", [
    (TableOptions(hard_delete=""), "names no column"), (TableOptions(strategy="scd2", hard_delete="f"), "doesn't go with"),
    (TableOptions(merge_scope=()), "empty"), (TableOptions(merge_scope=("a", "a")), "twice"),
    (TableOptions(strategy="scd2", merge_scope=("a",)), "absent: retire"), (TableOptions(scd2=Scd2Options()), "strategy scd2"),
    (TableOptions(strategy="scd2", scd2=Scd2Options(boundary_timestamp="2024-01-01T00:00:00")), "RFC 3339"),
    (TableOptions(strategy="scd2", scd2=Scd2Options(boundary_timestamp="2024-01-01T00:00:00Z", active_record_timestamp="2024-01-01T01:00:00+01:00")), "marker"),
])
def test_parsed_options(options, why):
    with pytest.raises(OptionError, match=why):
        check_parsed("t", options)


def test_opened_options():
    for o, mode, columns, why in [(TableOptions(strategy="upsert"), "append", ["id"], "needs merge"), (TableOptions(), "merge", ["x"], "key column id"), (TableOptions(hard_delete="f"), "merge", ["id"], "missing"), (TableOptions(dedup_sort=("id", "asc")), "merge", ["id"], "key column"), (TableOptions(strategy="scd2"), "merge", ["id", "_valid_to"], "validity column")]:
        with pytest.raises(OptionError, match=why):
            check_opened("t", o, columns, mode, ["id"])
