"""Merge semantics, each case also against a row-by-row brute force."""

import math
import random

import pytest
from conftest import rows

from clickloom.operators import MergeSpec, merge, merge_frames, merge_insert_only, merge_table, new_rows
from clickloom.sources import tables
from clickloom.workspace import stage_split

SPEC = MergeSpec(("k",), "v", ("v",))


def frame(spark, data, ddl="k int, v int, x int"):
    return spark.createDataFrame(data, ddl)


def brute(target, source, keys, watch, update, columns):
    """The merge, one row after the other."""
    index = {c: i for i, c in enumerate(columns)}

    def key(row):
        values = tuple(row[index[k]] for k in keys)
        return None if any(v is None for v in values) else values

    result = []
    for t in target:
        hits = [s for s in source if key(t) is not None and key(s) == key(t) and s[index[watch]] != t[index[watch]]]
        if len(hits) > 1:
            raise ValueError("two candidates")
        row = list(t)
        if hits:
            for c in update:
                row[index[c]] = hits[0][index[c]]
        result.append(tuple(row))
    known = {key(t) for t in target} - {None}
    return result + [s for s in source if key(s) not in known]


def ordered(data):
    return sorted(data, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_null_keys_repeats_and_updates(spark):
    target = frame(spark, [(1, 1, 0), (None, 9, 0), (3, 3, 0)])
    source = frame(spark, [(1, 2, 1), (None, 9, 1), (5, 5, 1), (5, 5, 1)])
    expected = [(1, 2, 0), (3, 3, 0), (None, 9, 0), (None, 9, 1), (5, 5, 1), (5, 5, 1)]
    assert rows(merge_frames(target, source, SPEC)) == ordered(expected)


def test_two_candidates_raise(spark):
    target, source = frame(spark, [(1, 1, 0)]), frame(spark, [(1, 7, 0), (1, 8, 0)])
    with pytest.raises(Exception, match="more than one source row"):
        merge_frames(target, source, SPEC).collect()
    with pytest.raises(Exception, match="more than one source row"):
        merge_frames(target, frame(spark, [(1, 7, 0), (1, 7, 0)]), SPEC).collect()
    with pytest.raises(Exception, match="more than one source row"):
        merge_frames(target, frame(spark, [(1, 7, 0), (1, 8, 0), (1, 9, 0)]), SPEC).collect()


def test_one_candidate_among_equal_rows(spark):
    target = frame(spark, [(1, 1, 0), (1, 1, 5), (2, 4, 0)])
    source = frame(spark, [(1, 1, 0), (1, 1, 0), (1, 2, 0), (2, 4, 0), (2, 4, 0)])
    assert rows(merge_frames(target, source, SPEC)) == [(1, 2, 0), (1, 2, 5), (2, 4, 0)]


def test_null_values_count_as_values(spark):
    target = frame(spark, [(1, None, 0), (2, 2, 0), (3, None, 0)])
    source = frame(spark, [(1, 1, 0), (2, None, 0), (3, None, 0)])
    assert rows(merge_frames(target, source, SPEC)) == ordered([(1, 1, 0), (2, None, 0), (3, None, 0)])


def test_empty_sides(spark):
    some, none = frame(spark, [(1, 1, 0), (1, 1, 0), (None, 2, 0)]), frame(spark, [])
    assert rows(merge_frames(none, some, SPEC)) == rows(some)
    assert rows(merge_frames(some, none, SPEC)) == rows(some)
    assert rows(merge_frames(none, none, SPEC)) == []


def test_null_safe_keys(spark):
    spec = MergeSpec(("k", "j"), "v", ("v",), null_safe_keys=True)
    ddl = "k int, j string, v int"
    target = frame(spark, [(None, "a", 1), (1, None, 1), (0, "", 1)], ddl)
    source = frame(spark, [(None, "a", 2), (1, None, 1), (0, None, 5), (None, None, 7)], ddl)
    expected = [(None, "a", 2), (1, None, 1), (0, "", 1), (0, None, 5), (None, None, 7)]
    assert rows(merge_frames(target, source, spec)) == ordered(expected)
    again = merge_frames(merge_frames(target, source, spec), source, spec)
    assert rows(again) == ordered(expected)


def test_insert_only_and_nan(spark):
    ddl = "k int, v double"
    target = frame(spark, [(1, 1.0), (2, math.nan)], ddl)
    source = frame(spark, [(1, 1.0), (1, 2.0), (2, math.nan), (3, 3.0), (3, 3.0)], ddl)
    got = rows(merge_insert_only(target, source, ["k", "v"], nan_never_matches=["v"]))
    assert [str(r) for r in got] == [str(r) for r in ordered([*rows(target), (1, 2.0), (2, math.nan), (3, 3.0), (3, 3.0)])]
    assert len(rows(new_rows(target, source, ["k", "v"]))) == 3


@pytest.mark.parametrize("seed", range(6))
def test_random_cases_against_brute_force(spark, seed):
    rng = random.Random(seed)

    def data(n, values):
        return [(rng.choice([None, *range(12)]), rng.choice(values), i) for i in range(n)]

    target = data(30, [None, 1])
    # One source row per key, or repeated ones that agree, so that most cases are legal.
    value = {k: rng.choice([None, 1, 2]) for k in range(12)}
    keys = [k for k in range(12) if rng.random() < 0.7]
    source = [(k, value[k], 100 + k) for k in keys] + [(None, 1, 200), (None, 1, 200)]
    source += [(k, value[k], 100 + k) for k in keys if not any(t[0] == k and t[1] != value[k] for t in target)]
    expected = brute(target, source, ["k"], "v", ["v", "x"], ["k", "v", "x"])
    spec = MergeSpec(("k",), "v", ("v", "x"))
    assert rows(merge_frames(frame(spark, target), frame(spark, source), spec)) == ordered(expected)


def test_merge_table_rewrites_only_changed_partitions(spark, db):
    name, ddl = f"{db}.t", "k int, v int, x int, d string"
    tables.ensure_table(spark, name, frame(spark, [], ddl).schema, ["d"])
    merge_table(spark, name, frame(spark, [(1, 1, 0, "a"), (2, 2, 0, "b"), (3, 3, 0, "c")], ddl), SPEC)
    before = {r["d"]: r["f"] for r in spark.sql(f"SELECT d, input_file_name() AS f FROM {name}").collect()}
    merge_table(spark, name, frame(spark, [(1, 7, 0, "a"), (3, 3, 9, "c"), (4, 4, 0, "b")], ddl), SPEC)
    assert rows(spark.table(name)) == [(1, 7, 0, "a"), (2, 2, 0, "b"), (3, 3, 0, "c"), (4, 4, 0, "b")]
    after = {r["k"]: r["f"] for r in spark.sql(f"SELECT k, input_file_name() AS f FROM {name}").collect()}
    assert after[1] != before["a"] and after[2] == before["b"] and after[3] == before["c"]


def test_merge_table_update_may_sit_in_another_partition(spark, db):
    # The key lacks the partition column and the update does not move the row.
    name, ddl = f"{db}.t", "k int, v int, d string"
    spec = MergeSpec(("k",), "d", ("v",))
    tables.ensure_table(spark, name, frame(spark, [], ddl).schema, ["d"])
    merge_table(spark, name, frame(spark, [(1, 1, "a"), (2, 2, "b")], ddl), spec)
    merge_table(spark, name, frame(spark, [(1, 9, "z"), (2, 8, "b")], ddl), spec)
    assert rows(spark.table(name)) == [(1, 9, "a"), (2, 2, "b")]


def test_merge_unpartitioned_table(spark, db):
    name = f"{db}.t"
    tables.ensure_table(spark, name, frame(spark, []).schema)
    for source in ([(1, 1, 0), (2, 2, 0)], [(1, 5, 0), (3, 3, 0)], [(1, 6, 0)]):
        merge_table(spark, name, frame(spark, source), SPEC)
    assert rows(spark.table(name)) == [(1, 6, 0), (2, 2, 0), (3, 3, 0)]


def test_failed_merge_changes_nothing(spark, db):
    name = f"{db}.t"
    tables.ensure_table(spark, name, frame(spark, []).schema)
    merge_table(spark, name, frame(spark, [(1, 1, 0)]), SPEC)
    with pytest.raises(Exception, match="more than one source row"):
        merge_table(spark, name, frame(spark, [(1, 7, 0), (1, 8, 0), (2, 2, 0)]), SPEC)
    assert rows(spark.table(name)) == [(1, 1, 0)]


def test_changes_kept_once_are_joined_once(spark):
    """Updates and inserts take other columns of the change set; kept, it is not joined for each of them."""
    target = frame(spark, [(1, 1, 1), (2, 2, 2), (2, 3, 2), (None, 4, 4)])
    source = frame(spark, [(1, 5, 1), (2, 2, 7), (3, 3, 3), (None, 4, 4)])
    lazy, once = merge_frames(target, source, SPEC), merge_frames(target, source, SPEC, once=True)
    assert rows(once) == rows(lazy)

    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    assert (joins(lazy), joins(once)) == (3, 1)


def test_rows_of_an_indexed_merge_are_shuffled_without_hashes(spark, db, monkeypatch):
    """The source meets what changed by hashes that are computed where they are compared."""
    plans = []

    def spy(change, *args):
        plans.append(change._jdf.queryExecution().optimizedPlan().toString())
        return stage_split(change, *args)

    monkeypatch.setattr(merge, "stage_split", spy)
    target = frame(spark, [(1, 1, 1), (2, 2, 2)])
    tables.ensure_table(spark, f"{db}.t", target.schema, ["x"])
    tables.append(spark, f"{db}.t", target)
    spec = MergeSpec(("k", "v"), indexed=True)
    merge_table(spark, f"{db}.t", frame(spark, [(1, 1, 1), (1, 9, 1), (3, 3, 3), (3, 3, 3), (None, 1, 1)]), spec)
    assert rows(spark.table(f"{db}.t")) == rows(frame(spark, [(1, 1, 1), (2, 2, 2), (1, 9, 1), (3, 3, 3), (3, 3, 3), (None, 1, 1)]))
    # The upper join's condition has the hash functions, not hash columns of the source.
    top = next(line for line in plans[0].splitlines() if "Join Inner" in line)
    assert top.count("xxhash64(") >= 3
