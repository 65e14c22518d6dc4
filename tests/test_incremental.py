"""Jobs that read only what changed, and what they leave alone."""

import random
from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from clickloom import schemas, shapes
from clickloom.operators.keyindex import KeyIndex
from clickloom.operators.merge import MergeSpec, _within, merge_frames, merge_table
from clickloom.operators.rows import explode_items, upto
from clickloom.operators.dedupe import latest_per_key
from clickloom.operators.skew import spread_join
from clickloom.plans import events, identity, interactions
from clickloom.plans.layout import Layout
from clickloom.sources import files, tables
from clickloom.sources.versions import Progress, on_days, partition_versions

DAY = [f"2024-01-{d:02}" for d in range(1, 31)]


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_filter_over_a_zipped_list(spark, sf_dir):
    df = explode_items(shapes.raw_data(spark, sf_dir), ["item_id", "item_name", "price"])
    filters = [line for line in (plan(df) + physical(df)).split("\n") if "Filter" in line]
    assert filters and not any("arrays_zip" in line or "get_json_object" in line for line in filters)
    odd = spark.createDataFrame(
        [(1, None, 7), (2, [], 7), (3, [None, ("a", 1), (None, None)], 7)], "id int, items array<struct<x:string,y:int>>, _place int"
    )
    got = explode_items(odd.withColumn("item", F.lit("old")), ["x", "y"])
    assert got.columns == ["id", "_place", "item"]
    assert rows(got.select("id", "item.x", "item.y")) == [(3, "a", 1), (3, None, None), (3, None, None)]


def plain_map(state):
    out = {}
    for device, user, _ in state:
        if user is not None:
            out[device] = max(user, out.get(device, user))
    return out


def test_device_map_follows_any_change_of_days(spark):
    rng = random.Random(4)
    schema = "user_pseudo_id string, user_id string, partition_date date"
    frame = lambda x: spark.createDataFrame([(d, u, date.fromisoformat(p)) for d, u, p in x], schema)
    for _ in range(6):
        devices = [None, *"abcdef"]
        day = lambda p: [(d, rng.choice([None, "1", "2", "3"]), p) for d in rng.sample(devices, rng.randint(0, 7))]
        others, was, now = [x for p in DAY[:2] for x in day(p)], day(DAY[2]), day(DAY[2])
        before, after = plain_map(others + was), plain_map(others + now)
        known = spark.createDataFrame(list(before.items()), "user_pseudo_id string, user_id string")
        got, changed = identity.update_map(known, frame(others), frame(was), frame(now))
        assert {r.user_pseudo_id: r.user_id for r in got.collect()} == after
        want = {d for d in before.keys() | after.keys() if before.get(d) != after.get(d)}
        assert sorted((r[0] for r in changed.collect()), key=str) == sorted(want, key=str)


@pytest.fixture
def layout(spark, db):
    return Layout(shards=db, events=db, train=db)


def load(spark, layout, raw, *days):
    name = layout.event("raw_data")
    tables.ensure_table(spark, name, raw.schema, ["partition_date"])
    for ds in days:
        tables.replace_days(spark, name, raw.where(F.col("partition_date") == F.lit(ds).cast("date")), [ds])


def test_event_jobs_equal_the_full_run(spark, layout, sf_dir):
    """Day by day with late devices, a corrected day and a day that shrinks: as if all was read each time."""
    raw, edited = shapes.raw_data(spark, sf_dir), shapes.raw_data(spark, sf_dir, edits=True)
    days = sorted(str(r[0]) for r in raw.select("partition_date").distinct().collect())[:6]
    spec = events.CART
    name, target = layout.event(spec.table), None
    steps = [(raw, days[:3]), (raw, days[3:5]), (edited, days[1:2]), (raw.where("event_timestamp % 2 = 0"), days[2:3]), (raw, days[5:])]
    for source, loaded in steps:
        load(spark, layout, source, *loaded)
        identity.run(spark, layout)
        whole = spark.table(layout.event("raw_data"))
        devices = identity.identity_map(whole)
        assert rows(spark.table(layout.event("user_pseudo_id"))) == rows(devices)
        full = events.extract(whole, devices, spec, days[-1]).cache()
        events.run(spark, layout, spec, days[-1])
        target = full if target is None else merge_frames(target, full, spec.merge)
        target = spark.createDataFrame(target.collect(), target.schema)
        assert rows(spark.table(name)) == rows(target)


def test_an_earlier_run_date_leaves_later_days_to_come(spark, layout, sf_dir):
    raw = shapes.raw_data(spark, sf_dir)
    days = sorted(str(r[0]) for r in raw.select("partition_date").distinct().collect())[:4]
    load(spark, layout, raw, *days)
    identity.run(spark, layout)
    events.run(spark, layout, events.VIEW, days[1])
    devices = spark.table(layout.event("user_pseudo_id"))
    first = events.extract(spark.table(layout.event("raw_data")), devices, events.VIEW, days[1])
    name = layout.event("view_item_event")
    assert rows(spark.table(name)) == rows(first)
    events.run(spark, layout, events.VIEW, days[3])
    both = merge_frames(first, events.extract(spark.table(layout.event("raw_data")), devices, events.VIEW, days[3]), events.VIEW.merge)
    assert rows(spark.table(name)) == rows(both)


def test_unchanged_days_are_not_read(spark, layout, sf_dir):
    raw = shapes.raw_data(spark, sf_dir)
    days = sorted(str(r[0]) for r in raw.select("partition_date").distinct().collect())[:3]
    load(spark, layout, raw, *days)
    name = layout.event("raw_data")
    progress = Progress(spark, f"{name}_seen")
    progress.note(partition_versions(spark, name))
    assert progress.changed(partition_versions(spark, name)) == []
    load(spark, layout, raw, days[1])
    again = Progress(spark, f"{name}_seen")
    assert again.changed(partition_versions(spark, name)) == [days[1]]
    again.note(partition_versions(spark, name), 3, upto=days[0])
    assert Progress(spark, f"{name}_seen").lowest_batch(days) == 0
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (partition_date = DATE'{days[2]}')")
    assert days[2] in again.changed(partition_versions(spark, name))


FACTS = "user_id string, item_id long, event_value double, timestamp long, event_type string, partition_date date"


def facts(spark, *data):
    found = [(u, i, float(v), t, "view", date.fromisoformat(DAY[d])) for u, i, v, t, d in data]
    return spark.createDataFrame(found, schemas.VIEW_ITEM_DATA)


def test_rerun_rewrites_no_partition(spark, db):
    name = f"{db}.facts"
    target = facts(spark, ("a", 1, 5, 10, 0), ("b", 1, 5, 11, 1), ("c", 2, 5, 12, 2))
    # Another day for two of them: one with another value, one with the same.
    source = facts(spark, ("a", 1, 7, 10, 3), ("b", 1, 5, 11, 3), ("d", 1, 1, 13, 2))
    tables.ensure_table(spark, name, target.schema, ["partition_date"])
    tables.append(spark, name, target)
    first = partition_versions(spark, name)
    merge_table(spark, name, source, interactions.FACT_MERGE)
    second = partition_versions(spark, name)
    assert {d for d in second if second[d] != first.get(d)} == {DAY[0], DAY[2]}
    want = rows(merge_frames(target, source, interactions.FACT_MERGE))
    assert rows(spark.table(name)) == want
    merge_table(spark, name, source, interactions.FACT_MERGE)
    assert partition_versions(spark, name) == second and rows(spark.table(name)) == want
    clash = facts(spark, ("a", 1, 7, 10, 3), ("a", 1, 8, 10, 4))
    with pytest.raises(Exception, match="more than one source row"):
        merge_table(spark, name, clash, interactions.FACT_MERGE)


def test_index_is_joined_in_place_and_notices_other_writers(spark, db):
    name = f"{db}.facts"
    target = facts(spark, *[(f"u{i}", i % 7, 1, i, i % 5) for i in range(200)])
    tables.ensure_table(spark, name, target.schema, ["partition_date"])
    tables.append(spark, name, target)
    spec = interactions.FACT_MERGE
    index = KeyIndex(spark, name, spec, ["partition_date"], F.lit(False))
    keyed, names = index.hashed(target.where("timestamp < 50"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts_of_key = index.table().groupBy(*names).agg(F.count("*").alias("n"))
        joined = keyed.select(*names).distinct().join(facts_of_key, names, "left")
        text = physical(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text  # of the source's keys
    assert joined.where("n = 1").count() == 50
    # A row written past the index is found all the same.
    tables.append(spark, name, facts(spark, ("late", 1, 1, 999, 6)))
    merge_table(spark, name, facts(spark, ("late", 1, 1, 999, 6), ("new", 1, 1, 1000, 6)), spec)
    assert spark.table(name).count() == 202
    assert spark.table(f"{name}__keys").count() == 202
    with pytest.raises(ValueError):
        KeyIndex(spark, name, MergeSpec(("user_id",), "event_value", indexed=True), ["partition_date"], F.lit(False))


def test_indexed_merges_equal_plain_ones(spark, db):
    rng = random.Random(8)
    for k, spec in enumerate((interactions.FACT_MERGE, interactions.INTERACTION_MERGE)):
        make = lambda n: facts(
            spark, *[(rng.choice(["a", "b", None]), rng.randrange(3), rng.choice([0.0, -0.0, 1, float("nan")]), rng.choice([1, 2, None]), rng.randrange(3)) for _ in range(n)]
        )
        target, source = make(25).dropDuplicates(list(spec.keys)), make(25).dropDuplicates(["user_id", "item_id", "timestamp"])
        target, source = (spark.createDataFrame(x.collect(), x.schema) for x in (target, source))
        name = f"{db}.t{k}"
        tables.ensure_table(spark, name, target.schema, ["partition_date"])
        tables.append(spark, name, target)
        merge_table(spark, name, source, spec)
        # As text, for NaN is not itself.
        assert list(map(str, rows(spark.table(name)))) == list(map(str, rows(merge_frames(target, source, spec))))


def test_helper_columns_clash_with_none_of_the_users(spark):
    df = spark.createDataFrame([(1, "a", 5, 6, 7), (1, "b", 5, 6, 7)], "k int, v string, _rank int, _spot int, _insert int")
    assert rows(latest_per_key(df, ["k"], F.desc("v"))) == [(1, "b", 5, 6, 7)]
    assert spread_join(df, df.select("k", F.lit(9).alias("_low")).distinct(), ["k"], "left", True).columns == [*df.columns, "_low"]
    names = "k int, v string, _rows int, _insert boolean, _low int, _chosen int, _changed int, _valued int, _values int"
    target = spark.createDataFrame([(1, "a", 1, True, 1, 1, 1, 1, 1)], names)
    source = spark.createDataFrame([(1, "b", 2, False, 2, 2, 2, 2, 2), (2, "c", 3, False, 3, 3, 3, 3, 3)], names)
    got = merge_frames(target, source, MergeSpec(("k",), "v", ("v", "_low")))
    assert rows(got) == [(1, "b", 1, True, 2, 1, 1, 1, 1), (2, "c", 3, False, 3, 3, 3, 3, 3)]
    events_ = spark.createDataFrame([(None, "d", 1, 2)], "user_id string, user_pseudo_id string, _device int, _known int")
    devices = spark.createDataFrame([("d", "u")], "user_pseudo_id string, user_id string")
    assert rows(identity.backfill_user(events_, devices)) == [("u", "d", 1, 2)]


def test_reload_fails_without_a_trace(spark, db):
    name = f"{db}.raw"
    data = [(1, date(2024, 1, 1)), (2, date(2024, 1, 2))]
    df = spark.createDataFrame(data, "x int, partition_date date")
    tables.ensure_table(spark, name, df.schema, ["partition_date"])
    tables.append(spark, name, df)
    before = partition_versions(spark, name)
    bad = df.withColumn("x", F.when(F.col("x") == 2, F.raise_error(F.lit("x")).cast("int")).otherwise(5))
    with pytest.raises(Exception):  # noqa: B017
        tables.reload_day(spark, name, bad, DAY[0])
    assert partition_versions(spark, name) == before and rows(spark.table(name)) == rows(df)
    for x in (7, 8, 9):
        tables.reload_day(spark, name, df.where("x = 1").withColumn("x", F.lit(x)), DAY[0])
        assert rows(spark.table(name)) == [(2, date(2024, 1, 2)), (x, date(2024, 1, 1))]
    # Writes after a switch go to the new folder, and so does an overwrite.
    tables.append(spark, name, df.where("x = 1"))
    assert spark.table(name).where("partition_date = '2024-01-01'").count() == 2
    tables.replace_days(spark, name, df.where("x = 1"), [DAY[0]])
    assert rows(spark.table(name)) == rows(df)
    # A shard without rows of its day empties it.
    tables.reload_day(spark, name, df.where("x = 2"), DAY[0])
    assert rows(spark.table(name)) == [(2, date(2024, 1, 2))] * 2


def test_exports_appear_when_they_are_whole(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.5), ("b", 2.0)], "user_id string, rows double")
    path = files.export_csv(df, str(tmp_path), "t", DAY[0], required=["user_id"])
    bad = df.withColumn("user_id", F.when(F.col("rows") > 1.9, F.col("user_id")))
    with pytest.raises(ValueError):
        files.export_csv(bad, str(tmp_path), "t", DAY[0], required=["user_id"])
    assert spark.read.option("header", True).csv(path).count() == 2
    assert [p.name for p in tmp_path.iterdir()] == [f"t_{DAY[0]}.csv"]
    files.export_csv(df.limit(1), str(tmp_path), "t", DAY[0])
    assert spark.read.option("header", True).csv(path).count() == 1


def test_upto_of_listed_days(spark, db):
    from clickloom.operators.gates import gate, listed_days

    df = spark.createDataFrame([(1, date(2024, 1, 3)), (2, date(2024, 1, 5))], "x int, partition_date date")
    tables.ensure_table(spark, f"{db}.t", df.schema, ["partition_date"])
    assert listed_days(spark, f"{db}.t") == []
    tables.append(spark, f"{db}.t", df)
    assert listed_days(spark, f"{db}.t", "2024-01-04") == ["2024-01-03"]
    assert gate(lambda: bool(listed_days(spark, f"{db}.none"))) is False
    assert upto(spark.table(f"{db}.t"), "2024-01-04").count() == 1


def days_read(df):
    return sorted({part.split("=")[1] for path in df.inputFiles() for part in path.split("/") if part.startswith("partition_date=")})


def test_scans_are_pruned_to_what_changed(spark, db, sf_dir):
    name = f"{db}.raw"
    raw = shapes.raw_data(spark, sf_dir)
    tables.ensure_table(spark, name, raw.schema, ["partition_date"])
    tables.append(spark, name, raw)
    days = sorted(partition_versions(spark, name))
    assert days_read(spark.table(name)) == days
    assert days_read(identity.device_days(spark.table(name).where(on_days(days[2:3])))) == days[2:3]
    some = raw.where(F.col("partition_date").isin([date.fromisoformat(d) for d in days[3:5]]))
    assert days_read(spark.table(name).where(_within(some, ["partition_date"]))) == days[3:5]
    assert days_read(spark.table(name).where(_within(some.limit(0), ["partition_date"]))) == []
