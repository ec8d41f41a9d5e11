"""Histories kept by run: repeated runs, stored changes and preview states, schemas, and what is read."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from snaptrail.operators import alerts
from snaptrail.operators.consistency import workspace_consistency
from snaptrail.operators.drift import drift
from snaptrail.operators.latest import latest_snapshot
from snaptrail.plans.datasets import collection_history
from snaptrail.sources import run_store
from snaptrail.sources.run_store import PathStore, merged_schema
from tests.histories import category_map, day, history, random_rows

BETA = {"preview_phase": "BETA"}


@pytest.fixture
def store(tmp_path):
    return PathStore(f"{tmp_path}/history", f"{tmp_path}/map")


def all_rows(df):
    return sorted(map(str, df.collect()))


def files_read(df):
    """Files that each scan of a query opened, subqueries included."""
    df.collect()
    found = []
    waiting = [df._jdf.queryExecution().executedPlan()]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            waiting.append(node.plan())
        elif name == "FileSourceScanExec":
            found.append(node.metrics().apply("numFiles").value())
        for children in (node.children(), node.subqueries()):
            waiting += [children.apply(i) for i in range(children.size())]
    return found


def with_previews(rows):
    """Every third setting is a preview, sometimes."""
    draw = random.Random(3)
    return [(*row[:4], {**(row[4] or {}), **(BETA if int(row[2][1:]) % 3 == 0 and draw.random() < 0.8 else {})}) for row in rows]


def test_stored_results_equal_those_of_the_whole_history(spark, store):
    """Runs in any order, some stored again with other rows, gaps, sentinels and repeated observations."""
    draw = random.Random(7)
    rows = with_previews(random_rows(4, settings=6, runs=6))
    order = [{1, 2, 4}, {5}, {3}, {5}, {6}, {2}]
    replaced = {2: [r for r in rows if r[0] == 2 and draw.random() < 0.5], 5: [r for r in rows if r[0] == 5 and r[2] != "s3"]}
    stored = {}
    for i, batch in enumerate(order):
        again = i in (3, 5)
        new = {run: replaced[run] if again else [r for r in rows if r[0] == run] for run in batch}
        stored |= new
        store.append_history(history(spark, [r for run in sorted(batch) for r in new[run]]))
    plain = history(spark, [r for run in stored for r in stored[run]])
    assert all_rows(store.history(spark).select(*plain.columns)) == all_rows(plain)
    assert all_rows(store.drift(spark)) == all_rows(drift(plain))
    for only_latest in (False, True):
        found = store.newly_enabled_previews(spark, only_latest)
        assert all_rows(found) == all_rows(alerts.newly_enabled_previews(plain, only_latest_run=only_latest))
    assert store.drift_alert(spark).first() == alerts.drift_alert(plain).first()
    layout, found = store.layout(spark), store.history(spark)
    assert all_rows(collection_history(found, layout)) == all_rows(collection_history(plain))
    no_map = category_map(spark, [])
    kept = [*plain.columns, "is_preview", "status"]
    assert all_rows(latest_snapshot(found, no_map, layout).select(*kept)) == all_rows(latest_snapshot(plain, no_map))
    assert all_rows(alerts.drift_alert_lines(found, layout)) == all_rows(alerts.drift_alert_lines(plain))


def test_only_files_of_the_newest_run_are_read(spark, store):
    no_map = category_map(spark, [])
    store.append_history(history(spark, [(run, 1, f"s{run % 3}", str(run), BETA) for run in range(1, 31)]))
    layout, rows = store.layout(spark), store.history(spark)
    assert files_read(latest_snapshot(rows, no_map, layout)) == [1]
    assert files_read(workspace_consistency(rows, no_map, layout)) == [1]
    assert files_read(alerts.drift_alert(rows, layout)) == [2]
    assert files_read(store.drift_alert(spark)) == [1]
    assert files_read(store.newly_enabled_previews(spark)) == [1]
    history_files = {row.f for row in rows.select(F.input_file_name().alias("f")).collect()}
    assert len(history_files) == 30
    counted = collection_history(rows, layout)
    assert [(r.settings_count, r.workspaces) for r in counted.collect()] == [(1, 1)] * 10
    assert re.findall(r"history/(\w+)", str(counted.inputFiles())) == ["runs"]


def test_storing_a_run_reads_its_neighbours_only(spark, store, monkeypatch):
    store.append_history(history(spark, [(run, 1, "s", str(run), BETA) for run in range(1, 9)]))
    read = []
    plain = PathStore.history
    monkeypatch.setattr(run_store, "drift", lambda rows, **more: read.append(rows) or drift(rows, **more))
    store.append_history(history(spark, [(9, 1, "s", "9", BETA)]))
    (rows,) = read
    assert {row.collected_at for row in rows.select("collected_at").collect()} == {day(8), day(9)}
    assert plain(store, spark).count() == 9
    states = run_store._partitions(spark, f"{store.history_path}/previews")
    assert len(states) <= run_store.STATES_KEPT


@pytest.mark.parametrize("step", ["_store_drift", "_store_previews", "_count"])
def test_a_run_is_there_once_after_a_failure(spark, store, monkeypatch, step):
    rows = [(run, 1, "s", str(run), BETA) for run in (1, 2)]
    store.append_history(history(spark, rows[:1]))
    with monkeypatch.context() as broken:
        broken.setattr(PathStore, step, lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            store.append_history(history(spark, rows[1:]))
    assert store.runs(spark).count() == 1
    for _ in range(2):
        store.append_history(history(spark, rows[1:]))
    assert store.history(spark).count() == 2 and store.runs(spark).count() == 2
    assert [r.change_type for r in store.drift(spark).collect()] == ["value_changed"]
    # A run that has no changes any more loses those it had.
    store.append_history(history(spark, [(2, 1, "s", "1", BETA)]))
    assert store.drift(spark).collect() == [] and store.history(spark).count() == 2


def test_columns_are_added_dropped_and_widened(spark, store):
    first = history(spark, [(1, 1, "s", "a")]).withColumns({"n": F.lit(1), "part": F.lit(0.5).cast("float")})
    second = history(spark, [(2, 1, "s", "a")]).withColumns({"n": F.lit(1 << 40), "added": F.lit("x")})
    third = history(spark, [(3, 1, "s", "a")]).drop("description").withColumn("n", F.lit(3).cast("short"))
    for batch in (first, second, third):
        store.append_history(batch)
    found = store.history(spark).orderBy("collected_at")
    assert [(r.n, r.part, r.added, r.description) for r in found.collect()] == [
        (1, 0.5, None, None),
        (1 << 40, None, "x", None),
        (3, None, None, None),
    ]
    assert dict(found.dtypes)["n"] == "bigint"
    with pytest.raises(ValueError, match="n is stored as bigint"):
        store.append_history(first.withColumn("n", F.lit("text")))
    assert store.history(spark).count() == 3
    assert merged_schema(first.schema, second.schema)["n"].dataType.simpleString() == "bigint"


def test_runs_without_a_time_zone_and_several_a_day(spark, store):
    zoneless = [F.expr(f"TIMESTAMP_NTZ '{t}'") for t in ("1969-12-31 23:59:59.5", "2024-03-31 02:30:00", "2024-03-31 02:30:00.000001")]
    for i, time in enumerate(zoneless):
        store.append_history(history(spark, [(1, 1, "s", str(i))]).withColumn("collected_at", time))
    found = store.runs(spark).orderBy("run_key").collect()
    assert [str(r.collected_at) for r in found] == [
        "1969-12-31 23:59:59.500000",
        "2024-03-31 02:30:00",
        "2024-03-31 02:30:00.000001",
    ]
    layout = store.layout(spark)
    assert [r.setting_value for r in latest_snapshot(store.history(spark), category_map(spark, []), layout).collect()] == ["2"]
    assert [(r.previous_value, r.new_value) for r in store.drift(spark).orderBy("detected_at").collect()] == [("0", "1"), ("1", "2")]


def test_nothing_stored(spark, store):
    layout = store.layout(spark)
    assert store.history(spark).count() == store.runs(spark).count() == store.drift(spark).count() == 0
    assert latest_snapshot(store.history(spark), category_map(spark, []), layout).count() == 0
    assert store.newly_enabled_previews(spark).count() == 0 and store.drift_alert(spark).first().drift_count == 0
    store.append_history(history(spark, []))
    assert store.history(spark).count() == store.runs(spark).count() == 0


def test_last_observations_may_be_merged_in_any_order(spark):
    draw = random.Random(11)
    rows = [(draw.randint(1, 6), draw.choice([None, 1]), f"s{draw.randint(0, 3)}", draw.choice(["on", "off", None]), BETA) for _ in range(80)]
    whole = alerts.last_two(alerts.preview_observations(history(spark, rows)))
    for cuts in (2, 5):
        parts = [history(spark, rows[i::cuts]) for i in draw.sample(range(cuts), cuts)]
        state = None
        for part in parts:
            seen = alerts.preview_observations(part)
            state = alerts.last_two(seen if state is None else alerts.observations(state).unionByName(seen))
        assert all_rows(state) == all_rows(whole)
