"""Drift: one test per rule, then random histories against the full grid in DuckDB."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import oracle
from snaptrail.layout import HISTORY_SCHEMA, Layout
from snaptrail.operators import lookup as lookup_module
from snaptrail.operators.drift import drift, latest_drift
from tests.histories import category_map, day, history, random_rows
from tests.plans import final_plan

ANCHOR = [(run, 9, "anchor", "same") for run in range(1, 7)]  # makes every run exist


def changes(df):
    return sorted(
        (r.detected_at, r.setting_name, r.change_type, r.previous_value, r.new_value)
        for r in df.collect()
    )


def drift_of(spark, series, workspace=1):
    rows = [(run, workspace, "s", value) for run, value in series]
    return [(d, t, p, n) for d, _, t, p, n in changes(drift(history(spark, ANCHOR + rows)))]


@pytest.mark.parametrize(
    "series,expected",
    [
        ([(1, "a"), (2, "b")] + [(r, "b") for r in (3, 4, 5, 6)], [(day(2), "value_changed", "a", "b")]),
        ([(r, "a") for r in range(1, 7)], []),
        # the first run never drifts, the first sight later does
        ([(r, "a") for r in range(3, 7)], [(day(3), "added", None, "a")]),
        # letter case counts
        ([(r, "True" if r < 4 else "true") for r in range(1, 7)], [(day(4), "value_changed", "True", "true")]),
        # a sentinel between two values masks the change
        ([(1, "a"), (2, "<unavailable>")] + [(r, "b") for r in range(3, 7)], []),
        # missing -> sentinel -> value is never an addition
        ([(3, "<not-set>")] + [(r, "v") for r in range(4, 7)], []),
        # value -> sentinel -> missing is never a removal
        ([(1, "v"), (2, "<null>")], []),
        # a gap removes and adds again
        (
            [(1, "v"), (2, "v"), (4, "v"), (5, "v"), (6, "v")],
            [(day(3), "removed", "v", None), (day(4), "added", None, "v")],
        ),
        # a NULL value equals a missing row
        (
            [(1, "v"), (2, None), (3, None), (4, "v"), (5, "v"), (6, "v")],
            [(day(2), "removed", "v", None), (day(4), "added", None, "v")],
        ),
        # seen in the first run only
        ([(1, "v")], [(day(2), "removed", "v", None)]),
        # repeated observations of a cell count as their maximum
        ([(1, "a"), (2, "a"), (2, "b"), (3, "b"), (4, "b"), (5, "b"), (6, "b")], [(day(2), "value_changed", "a", "b")]),
    ],
)
def test_rules(spark, series, expected):
    assert drift_of(spark, series) == expected


def test_rows_without_workspace_share_the_key_of_workspace_zero(spark):
    rows = [(1, None, "s", "a"), (2, 0, "s", "b")]
    assert changes(drift(history(spark, rows))) == [(day(2), "s", "value_changed", "a", "b")]


def test_workspace_name_is_the_current_or_else_the_previous(spark):
    rows = [
        (1, 1, "kept", "a", {"workspace_name": "old"}),
        (2, 1, "kept", "b", {"workspace_name": "new"}),
        (1, 1, "gone", "a", {"workspace_name": "old"}),
        # a NULL value still carries the new name
        (1, 1, "null", "a", {"workspace_name": "old"}),
        (2, 1, "null", None, {"workspace_name": "new"}),
    ]
    names = {r.setting_name: r.workspace_name for r in drift(history(spark, rows)).collect()}
    assert names == {"kept": "new", "gone": "old", "null": "new"}


def test_category_comes_from_the_map_only(spark):
    rows = [(r, 1, s, str(r), {"category": "own"}) for r in (1, 2) for s in ("mapped", "unmapped")]
    found = drift(history(spark, rows), category_map(spark, [("mapped", "m", "v", 1)]))
    assert {r.setting_name: r.category for r in found.collect()} == {"mapped": "m", "unmapped": None}


def test_one_run_and_no_run(spark):
    assert drift(history(spark, ANCHOR[:1])).count() == 0
    assert drift(history(spark, [])).count() == 0
    assert latest_drift(history(spark, ANCHOR[:1])).count() == 0
    assert latest_drift(history(spark, [])).count() == 0


def test_change_date_is_utc_in_any_session_zone(spark):
    rows = history(spark, [(1, 1, "s", "a"), (2, 1, "s", "b")])
    late = rows.withColumn("collected_at", F.col("collected_at") + F.expr("INTERVAL 17 HOURS"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert [str(r.change_date) for r in drift(late).collect()] == ["2024-01-02"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def expected_from_grid(rows):
    frame = duckdb.connect()
    frame.execute(
        "CREATE TABLE history (collected_at TIMESTAMP, workspace_id BIGINT, workspace_name VARCHAR,"
        " setting_name VARCHAR, setting_value VARCHAR)"
    )
    frame.executemany(
        "INSERT INTO history VALUES (?, ?, ?, ?, ?)",
        [
            (day(run), ws, (renamed or {}).get("workspace_name", None if ws is None else f"ws-{ws}"), name, value)
            for run, ws, name, value, renamed in rows
        ],
    )
    steps = oracle.drift_steps("history")
    return Counter(
        frame.execute(
            f"WITH {steps} SELECT t, s, coalesce(label, plabel), change_type, pv, v FROM judged"
            " WHERE change_type IS NOT NULL"
        ).fetchall()
    )


def found(df):
    return Counter(
        (r.detected_at, r.setting_name, r.workspace_name, r.change_type, r.previous_value, r.new_value)
        for r in df.collect()
    )


@pytest.mark.parametrize("seed", range(6))
def test_random_history_equals_grid(spark, seed):
    rows = random_rows(seed)
    expected = expected_from_grid(rows)
    frame = history(spark, rows)
    assert {t for _, _, _, t, _, _ in expected} == {"added", "removed", "value_changed"}
    assert found(drift(frame)) == expected
    last = Counter({k: n for k, n in expected.items() if k[0] == day(10)})
    assert found(latest_drift(frame)) == last


def test_any_number_of_runs_and_heavy_runs(spark, monkeypatch):
    """The ways for time lines and side tables that are too big to order or broadcast whole."""
    rows = random_rows(7, settings=6, runs=60)
    rows += [(30, ws, f"bulk{i}", "x", None) for ws in (1, 2) for i in range(300)]
    monkeypatch.setattr(lookup_module, "HEAVY_SHARE", 4)
    frame = history(spark, rows)
    heavy = lookup_module.heavy_keys(frame, "collected_at").collect()
    assert [r.collected_at for r in heavy] == [day(30)]
    named = category_map(spark, [(f"s{i}", f"c{i}", "v", 1) for i in range(3)])
    big = drift(frame, named, small_timeline_bytes=0, broadcast_bytes=0)
    assert found(big) == expected_from_grid(rows)
    assert Counter(map(tuple, big.collect())) == Counter(map(tuple, drift(frame, named).collect()))


def test_lookup_of_a_big_map_reads_the_cells_of_one_shuffle(spark, tmp_path):
    history(spark, random_rows(5)).write.parquet(str(tmp_path / "h"))
    named = category_map(spark, [("s1", "c", "v", 1)])
    found = drift(spark.read.parquet(str(tmp_path / "h")), named, broadcast_bytes=0)
    assert found.collect()
    executed = found._jdf.queryExecution().executedPlan().toString()
    final = executed[: executed.rindex("== Initial Plan ==")]
    assert "ReusedExchange [setting_name" in final


def test_runs_may_be_given(spark):
    rows = history(spark, random_rows(3))
    runs = rows.select("collected_at").distinct()
    assert found(drift(rows, runs=runs)) == found(drift(rows))


def test_other_column_names(spark):
    rows = history(spark, random_rows(4))
    other = rows.selectExpr(
        "collected_at AS taken", "setting_name AS key", "workspace_id AS host", "setting_value AS state"
    )
    layout = Layout(run="taken", name="key", workspace="host", value="state", workspace_name=None)
    assert changes(drift(other, layout=layout)) == changes(drift(rows))


def test_plan_has_one_wide_shuffle_and_no_cross_join(spark, tmp_path):
    history(spark, random_rows(5)).write.parquet(str(tmp_path / "h"))
    plan = final_plan(drift(spark.read.parquet(str(tmp_path / "h"))))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "SortMergeJoin" not in plan
    assert plan.count("hashpartitioning(setting_name") == 1
    # the other columns of the history are not read
    assert "preview_phase" not in plan and "description" not in plan


def test_setting_filter_reaches_the_scan(spark, tmp_path):
    history(spark, random_rows(5)).write.parquet(str(tmp_path / "h"))
    frame = spark.read.parquet(str(tmp_path / "h"))
    plan = final_plan(drift(frame).where("setting_name = 's1'"))
    assert "EqualTo(setting_name,s1)" in plan


def test_schema(spark):
    fields = [(f.name, f.dataType.simpleString()) for f in drift(history(spark, ANCHOR)).schema]
    assert HISTORY_SCHEMA.startswith("collected_at TIMESTAMP")
    assert fields == [
        ("change_date", "date"),
        ("setting_name", "string"),
        ("workspace_name", "string"),
        ("category", "string"),
        ("change_type", "string"),
        ("previous_value", "string"),
        ("new_value", "string"),
        ("detected_at", "timestamp"),
    ]
