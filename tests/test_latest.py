"""Latest snapshot, current category and consistency."""

from pyspark.sql import functions as F

from snaptrail.layout import HISTORY_SCHEMA, Layout
from snaptrail.operators import lookup as lookup_module
from snaptrail.operators.categories import current_category
from snaptrail.operators.consistency import workspace_consistency
from snaptrail.operators.latest import latest_snapshot
from snaptrail.sources import tables
from tests.histories import category_map, history, random_rows
from tests.plans import final_plan

NO_MAP = []


def test_latest_is_global(spark):
    rows = [(1, 1, "s", "a"), (1, 2, "s", "a"), (2, 1, "s", "b")]
    found = latest_snapshot(history(spark, rows), category_map(spark, NO_MAP)).collect()
    assert [(r.workspace_id, r.setting_value) for r in found] == [(1, "b")]


def test_latest_columns(spark):
    found = latest_snapshot(history(spark, []), category_map(spark, NO_MAP))
    stored = [part.split()[0] for part in HISTORY_SCHEMA.split(", ")]
    assert found.columns == [*stored, "is_preview", "status"]
    assert found.count() == 0


def test_map_category_comes_before_the_rows_own(spark):
    rows = [(1, 1, s, "a", {"category": "own"}) for s in ("mapped", "unmapped", "null")]
    entries = category_map(spark, [("mapped", "map", "v", 1), ("null", None, "v", 1)])
    found = latest_snapshot(history(spark, rows), entries).collect()
    assert {r.setting_name: r.category for r in found} == {"mapped": "map", "unmapped": "own", "null": "own"}


def test_current_category_is_the_newest_over_all_label_sets(spark):
    # label set A, then B, then A again: A is cached and not stamped anew, so B's category stays
    entries = category_map(spark, [("s", "from A", "A", 1), ("s", "from B", "B", 2), ("t", "tie 2", "A", 1), ("t", "tie 1", "A", 1)])
    assert dict(map(tuple, current_category(entries).collect())) == {"s": "from B", "t": "tie 1"}
    assert dict(map(tuple, current_category(entries, "A").collect()))["s"] == "from A"


def test_big_category_map_gives_the_same(spark, monkeypatch):
    monkeypatch.setattr(lookup_module, "HEAVY_SHARE", 4)
    rows = [(1, w, "hot", str(w)) for w in range(50)] + [(1, w, f"s{w}", "x") for w in range(50)]
    entries = category_map(spark, [("hot", "h", "v", 1)] + [(f"s{i}", f"c{i}", "v", 1) for i in range(40)])
    frame = history(spark, rows)
    assert [r[0] for r in lookup_module.heavy_keys(frame, "setting_name").collect()] == ["hot"]
    whole = latest_snapshot(frame, entries)
    split = latest_snapshot(frame, entries, broadcast_bytes=0)
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))
    assert whole.where("category IS NOT NULL").count() == 90


def test_lookup_keeps_rows_without_a_key(spark):
    rows = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k STRING, n INT")
    side = spark.createDataFrame([("a", "x")], "k STRING, v STRING")
    expected = {(1, None), (2, "x"), (3, None)}
    for limit in (0, lookup_module.BROADCAST_BYTES):
        found = lookup_module.lookup(rows, side, "k", limit).collect()
        assert {(r.n, r.v) for r in found} == expected


def test_only_the_newest_partition_is_read(spark, tmp_path):
    path = str(tmp_path / "h")
    tables.append_snapshot(history(spark, random_rows(1)), path)
    stored = tables.read_history(spark, path)
    found = latest_snapshot(stored, category_map(spark, NO_MAP), tables.STORED_HISTORY)
    plan = final_plan(found)
    assert "PartitionFilters: [isnotnull(collected_on" in plan
    assert "EqualTo(collected_at,ScalarSubquery" in plan
    without = latest_snapshot(stored, category_map(spark, NO_MAP))
    assert sorted(map(str, found.collect())) == sorted(map(str, without.collect()))
    # one of the ten run directories is opened
    assert found.select(F.input_file_name().alias("f")).where("f NOT LIKE '%2024-01-10%'").count() == 0


def test_several_runs_a_day(spark, tmp_path):
    rows = history(spark, random_rows(2, runs=6))
    first = 1704088800000000
    half_days = rows.withColumn(
        "collected_at", F.expr(f"timestamp_micros({first} + (unix_micros(collected_at) - {first}) div 2)")
    )
    path = str(tmp_path / "h")
    tables.append_snapshot(half_days, path)
    stored = tables.read_history(spark, path)
    assert stored.select("collected_on").distinct().count() == 3
    for layout in (Layout(), tables.STORED_HISTORY):
        assert latest_snapshot(stored, category_map(spark, NO_MAP), layout).count() == rows.where(
            "collected_at = '2024-01-06 06:00:00'"
        ).count()


def consistency_of(spark, rows, entries=()):
    found = workspace_consistency(history(spark, rows), category_map(spark, list(entries))).collect()
    return {
        (r.setting_name, r.category): (r.distinct_values, r.workspace_count, r.consistency_status, r.sample_value)
        for r in found
    }


def test_consistency(spark):
    rows = [
        (1, 1, "old run", "a"),
        (2, 1, "same", "a"), (2, 2, "same", "a"),
        (2, 1, "differs", "b"), (2, 2, "differs", "a"),
        (2, 1, "sentinel", "a"), (2, 2, "sentinel", "<null>"),
        (2, 1, "null", None), (2, 2, "null", "a"),
        (2, 1, "all null", None),
        (2, None, "account", "a"),
    ]
    assert consistency_of(spark, rows) == {
        ("same", None): (1, 2, "CONSISTENT", "a"),
        ("differs", None): (2, 2, "INCONSISTENT", "a"),
        ("sentinel", None): (2, 2, "INCONSISTENT", "<null>"),
        ("null", None): (1, 2, "CONSISTENT", "a"),
        ("all null", None): (0, 1, "CONSISTENT", None),
    }


def test_consistency_is_per_category_unless_the_map_names_one(spark):
    rows = [(1, w, s, "a", {"category": f"c{w}"}) for w in (1, 2) for s in ("split", "joined")]
    assert set(consistency_of(spark, rows, [("joined", "map", "v", 1)])) == {
        ("split", "c1"), ("split", "c2"), ("joined", "map"),
    }
