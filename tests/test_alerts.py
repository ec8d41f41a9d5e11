"""Alert rows, their text, and what the preview alert sees."""

import pytest

from snaptrail.layout import Layout
from snaptrail.operators import alerts
from tests.histories import day, history
from tests.plans import final_plan

BETA = {"preview_phase": "BETA"}


def only_row(df):
    (row,) = df.collect()
    return row


def lines(df):
    return sorted(row.line for row in df.collect())


def test_drift_alert_lines(spark):
    rows = [
        (1, 1, "b", "x"), (2, 1, "b", "y"),
        (1, None, "a", "x"),
        (2, 2, "c", "new"),
    ]
    frame = history(spark, rows)
    assert only_row(alerts.drift_alert(frame)).drift_count == 3
    assert lines(alerts.drift_alert_lines(frame)) == [
        "a [-]: removed (x -> (none))", "b [ws-1]: value_changed (x -> y)", "c [ws-2]: added ((none) -> new)"
    ]


def test_lines_are_numbered_in_a_fixed_order(spark):
    rows = [(run, ws, f"s{i:03}", str(run)) for run in (1, 2) for ws in (None, 1, 2) for i in range(150)]
    found = alerts.drift_alert_lines(history(spark, rows)).collect()
    found.sort(key=lambda row: row.number)
    assert [row.number for row in found] == list(range(1, 451))
    keys = [(row.setting_name, row.workspace_name or "") for row in found]
    assert keys == sorted(keys)
    previews = [(1, ws, f"p{i}", "true", BETA) for i in range(3) for ws in (2, 1)]
    found = sorted(alerts.preview_alert_lines(history(spark, previews)).collect(), key=lambda row: row.number)
    assert [(row.number, row.setting_name, row.workspace) for row in found] == [
        (1, "p0", 1), (2, "p0", 2), (3, "p1", 1), (4, "p1", 2), (5, "p2", 1), (6, "p2", 2)
    ]


def test_drift_alert_sees_the_newest_run_only(spark):
    rows = [(1, 1, "s", "x"), (2, 1, "s", "y"), (3, 1, "s", "y")]
    frame = history(spark, rows)
    assert only_row(alerts.drift_alert(frame)).drift_count == 0
    assert lines(alerts.drift_alert_lines(frame)) == []


@pytest.mark.parametrize("rows", [[], [(1, 1, "s", "true", BETA)]])
def test_one_row_even_without_anything_to_report(spark, rows):
    frame = history(spark, rows)
    assert only_row(alerts.drift_alert(frame)).drift_count == 0
    assert only_row(alerts.preview_alert(frame)).new_previews == len(rows)


@pytest.mark.parametrize("changes", [0, 1, 10_000])
def test_an_alert_is_one_row_and_fires_once(spark, changes):
    rows = spark.range(max(changes, 1)).selectExpr("concat('s', id) AS setting_name", "id")
    both = rows.crossJoin(spark.createDataFrame([(day(1), "x"), (day(2), "y" if changes else "x")], "collected_at TIMESTAMP, setting_value STRING"))
    frame = both.selectExpr("setting_name", "setting_value", "collected_at", "CAST(1 AS BIGINT) AS workspace_id", "'ws-1' AS workspace_name")
    row = only_row(alerts.evaluate(alerts.drift_alert(frame), "drift_count"))
    assert (row.drift_count, row.triggered) == (changes, changes > 0)
    assert alerts.drift_alert_lines(frame).count() == changes


def test_equal_lines_all_stay(spark):
    rows = [(run, ws, "s", str(run)) for run in (1, 2) for ws in range(1, 400)]
    found = lines(alerts.drift_alert_lines(history(spark, rows), Layout(workspace_name=None)))
    assert found == ["s [-]: value_changed (1 -> 2)"] * 399


@pytest.mark.parametrize(
    "series,fires",
    [
        ([(1, "true", "BETA")], True),  # first sight
        ([(1, "false", "BETA"), (2, "Enabled", "BETA")], True),
        ([(1, "on", "BETA"), (2, "true", "BETA")], False),
        ([(1, "true", "BETA"), (2, "false", "BETA")], False),
        ([(1, "<unavailable>", "BETA"), (2, "true", "BETA")], True),  # from a sentinel
        ([(1, None, "BETA"), (2, "true", "BETA")], True),
        # gaps are not seen: the last two observations count
        ([(1, "true", "BETA"), (5, "true", "BETA")], False),
        # observations in a non-preview phase are left out first, so this looks new
        ([(1, "true", "GA"), (2, "true", "BETA")], True),
        ([(1, "false", "BETA"), (2, "true", "GA")], False),
        ([(1, "true", None)], False),
    ],
)
def test_preview_alert(spark, series, fires):
    rows = [(run, 1, "s", value, {"preview_phase": phase}) for run, value, phase in series]
    assert only_row(alerts.preview_alert(history(spark, rows))).new_previews == int(fires)


def test_preview_alert_keeps_firing_for_vanished_settings(spark):
    rows = [(1, 1, "gone", "true", BETA), (2, 1, "other", "false", BETA)]
    frame = history(spark, rows)
    assert lines(alerts.preview_alert_lines(frame)) == ["gone [ws 1]: (new) -> true"]
    assert only_row(alerts.preview_alert(frame, only_latest_run=True)).new_previews == 0


def test_preview_text(spark):
    rows = [(1, None, "b", "off", BETA), (2, None, "b", "on", BETA), (2, 3, "a", "1", BETA)]
    assert lines(alerts.preview_alert_lines(history(spark, rows))) == ["a [ws 3]: (new) -> 1", "b [ws 0]: off -> on"]


def test_series_the_newest_run_did_not_see_go_before_the_ranking(spark):
    rows = [(1, 1, "gone", "true", BETA), (1, 1, "s", "off", BETA), (2, 1, "s", "on", BETA), (2, 1, "t", "on", {"preview_phase": "GA"})]
    frame = history(spark, rows)
    enabled = alerts.newly_enabled_previews(frame, only_latest_run=True)
    assert [row.setting_name for row in enabled.collect()] == ["s"]
    plan = final_plan(enabled)
    assert plan.index("WindowGroupLimit") < plan.index("LeftSemi")


def test_newly_enabled_rows(spark):
    rows = [(1, 1, "s", "off", BETA), (3, 1, "s", "on", BETA)]
    (row,) = alerts.newly_enabled_previews(history(spark, rows)).collect()
    assert (row.last_run, row.current_value, row.previous_value) == (day(3), "on", "off")


def test_long_series_are_cut_before_the_shuffle(spark):
    plan = final_plan(alerts.newly_enabled_previews(history(spark, [])))
    limit, shuffle = plan.index("WindowGroupLimit"), plan.index("Exchange")
    assert plan.count("+- WindowGroupLimit") == 2 and limit < shuffle < plan.rindex("+- WindowGroupLimit")


def test_evaluate(spark):
    alert = spark.createDataFrame([(0,), (2,), (None,)], "n BIGINT")
    assert [r.triggered for r in alerts.evaluate(alert, "n").collect()] == [False, True, False]
    assert [r.triggered for r in alerts.evaluate(alert, "n", 2).collect()] == [False, False, False]
