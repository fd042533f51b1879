"""Merge semantics: insert-if-absent and column-subset upsert."""

import pytest

from ferrovia.operators import merge
from tests.conftest import rows


def test_insert_if_absent_null_keys_and_batch_duplicates(spark):
    tgt = spark.createDataFrame([("T1", "S1", 1, "old"), ("T2", None, 2, "old")], "t string, s string, k int, v string")
    src = spark.createDataFrame([("T1", "S1", 1, "new"),      # matched -> not inserted
                                 ("T2", None, 2, "new"),      # NULL key never matches -> inserted
                                 ("T3", "S3", 3, "new"),      # absent -> inserted
                                 ("T3", "S3", 3, "dup"),      # duplicate inside the batch -> also inserted
                                 ("", "", 4, "e1")], "t string, s string, k int, v string")
    new = merge.rows_to_insert(tgt, src, ["t", "s", "k"])
    assert rows(new, "v") == [("dup",), ("e1",), ("new",), ("new",)]
    merged = merge.insert_if_absent(tgt, src, ["t", "s", "k"])
    assert merged.count() == 6
    # empty-string keys do match each other
    again = merge.rows_to_insert(merged, spark.createDataFrame([("", "", 4, "e2")], src.schema), ["t", "s", "k"])
    assert again.count() == 0


def test_insert_if_absent_is_idempotent_for_non_null_keys(spark):
    tgt = spark.createDataFrame([(1, "a")], "k int, v string")
    src = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    once = merge.insert_if_absent(tgt, src, ["k"])
    twice = merge.insert_if_absent(once, src, ["k"])
    assert rows(once) == rows(twice) == [(1, "a"), (2, "b")]


def test_insert_prune_on_partition(spark):
    tgt = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "k int, day int, v string")
    src = spark.createDataFrame([(1, 10, "x"), (3, 20, "y")], "k int, day int, v string")
    assert rows(merge.rows_to_insert(tgt, src, ["k"], prune_on=["day"]), "k") == [(3,)]


def test_upsert_keep_and_refresh(spark):
    tgt = spark.createDataFrame([(1, 5, "old", 1.0), (2, 6, "keep", 2.0)], "k int, n int, name string, pct double")
    src = spark.createDataFrame([(1, 9, "renamed", None), (3, 1, "fresh", 3.0)], "k int, n int, name string, pct double")
    keep = {r.k: r for r in merge.upsert(tgt, src, ["k"], ["pct"], stale="keep").collect()}
    assert keep[1].n == 5 and keep[1].name == "old" and keep[1].pct is None   # update col follows NULL source
    assert keep[2].name == "keep" and keep[3].name == "fresh" and keep[3].n == 1
    ref = {r.k: r for r in merge.upsert(tgt, src, ["k"], ["pct"], stale="refresh").collect()}
    assert ref[1].n == 9 and ref[1].name == "renamed" and ref[2].pct == 2.0
    with pytest.raises(ValueError):
        merge.upsert(tgt, src, ["k"], stale="sometimes")


def test_upsert_table_partitioned_and_unique_check(spark, tmp):
    path = f"{tmp}/gold"
    a = spark.createDataFrame([(1, 20250101, 1), (2, 20250102, 1)], "id int, date_key int, v int")
    merge.upsert_table(spark, a, path, ["id", "date_key"], partition_by="date_key")
    b = spark.createDataFrame([(2, 20250102, 5), (3, 20250102, 7)], "id int, date_key int, v int")
    merge.upsert_table(spark, b, path, ["id", "date_key"], partition_by="date_key")
    got = rows(spark.read.parquet(path), "id", "date_key", "v")
    assert got == [(1, 20250101, 1), (2, 20250102, 5), (3, 20250102, 7)]
    # replaying the same batch changes nothing
    merge.upsert_table(spark, b, path, ["id", "date_key"], partition_by="date_key")
    assert rows(spark.read.parquet(path), "id", "date_key", "v") == got
    dup = spark.createDataFrame([(9, 20250103, 1), (9, 20250103, 2)], "id int, date_key int, v int")
    with pytest.raises(ValueError):
        merge.upsert_table(spark, dup, path, ["id", "date_key"], partition_by="date_key")


def test_insert_if_absent_table_and_ensure_built(spark, tmp):
    path = f"{tmp}/fact"
    a = spark.createDataFrame([("T", 20250101, 1)], "trip string, day int, v int")
    merge.insert_if_absent_table(spark, a, path, ["trip", "day"], "day")
    merge.insert_if_absent_table(spark, a.union(spark.createDataFrame([("U", 20250101, 2)], a.schema)),
                                 path, ["trip", "day"], "day")
    assert rows(spark.read.parquet(path), "trip", "v") == [("T", 1), ("U", 2)]
    calls = []

    def build():
        calls.append(1)
        return a
    merge.ensure_built(spark, f"{tmp}/once", build)
    merge.ensure_built(spark, f"{tmp}/once", build)
    assert len(calls) == 1


def test_insert_if_absent_idempotent_property(spark):
    from hypothesis import given, settings, strategies as st

    keys = st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["a", "b", ""])), max_size=8)

    @settings(max_examples=8, deadline=None)
    @given(keys, keys)
    def check(t, s):
        tgt = spark.createDataFrame(t, "k int, v string")
        src = spark.createDataFrame(s, "k int, v string")
        once = merge.insert_if_absent(tgt, src, ["k", "v"])
        twice = merge.insert_if_absent(once, src, ["k", "v"])
        assert rows(once) == rows(twice)
        # every source key is present afterwards, target rows are untouched
        assert {r for r in s} <= {tuple(r) for r in once.collect()}
        assert len(rows(once)) == len(t) + len([x for x in s if x not in set(t)])

    check()


def test_null_keys_do_not_pile_up(spark):
    target = spark.createDataFrame([(1, None, 1), (1, "b", 2)], "week int, agency string, n int")
    fresh = spark.createDataFrame([(1, None, 5)], "week int, agency string, n int")
    for _ in range(3):
        target = merge.upsert(target, fresh, ["week", "agency"], ["n"], "keep")
    assert sorted((r.agency or "", r.n) for r in target.collect()) == [("", 5), ("b", 2)]
