"""Whole collection runs, stored tables, schema evolution and views."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from snaptrail.operators import ingest
from snaptrail.plans.classification import by_row, classify_settings
from snaptrail.plans.collect import build_snapshot, collect
from snaptrail.plans.views import create_catalog_views, register_views
from snaptrail.sources import tables
from snaptrail.sources.run_store import PathStore
from tests.histories import category_map, day, history

PAYLOADS = "setting_name STRING, payload STRING, read_failed BOOLEAN, setting_type STRING, preview_phase STRING, description STRING"
IN_WORKSPACE = f"workspace_id BIGINT, workspace_name STRING, {PAYLOADS}"


def account(spark, value="1"):
    return spark.createDataFrame([("quota", f'{{"name":"quota","effective_integer_val":{{"value":{value}}}}}', False, None, None, "how much")], PAYLOADS)


def workspaces(spark, value="true"):
    rows = [
        (ws, f"ws-{ws}", "feature", f'{{"effective_boolean_val":{{"value":{value}}}}}', False, "BooleanSetting", "BETA", None)
        for ws in (1, 2)
    ]
    rows.append((2, "ws-2", "hidden", None, True, "StringSetting", None, ""))
    return spark.createDataFrame(rows, IN_WORKSPACE)


def first_label(text, labels):
    return F.get(labels, 0)


def run(spark, number, store, value="true", labels="a, b", classifier=first_label):
    rows = build_snapshot(account(spark), workspaces(spark, value), F.lit(day(number)), "acct")
    return collect(rows, store, classifier, F.lit(day(number)), labels)


@pytest.fixture
def paths(tmp_path):
    return PathStore(f"{tmp_path}/history", f"{tmp_path}/map")


@pytest.fixture
def catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS runs")
    yield tables.CatalogStore("runs.settings_history", "runs.setting_category_map")
    spark.sql("DROP DATABASE runs CASCADE")


@pytest.fixture(params=["paths", "catalog"])
def store(request):
    return request.getfixturevalue(request.param)


def test_snapshot_rows(spark):
    rows = build_snapshot(account(spark), workspaces(spark), F.lit(day(1)), "acct")
    found = {(r.workspace_id, r.setting_name): r for r in rows.collect()}
    assert len(found) == 4
    quota = found[None, "quota"].asDict()
    assert quota == {
        "collected_at": day(1), "account_id": "acct", "scope": "account", "workspace_id": None,
        "workspace_name": None, "setting_name": "quota", "setting_value": "1", "setting_type": "unknown",
        "source": "settings_v2", "category": None, "preview_phase": None, "description": "how much",
    }
    feature = found[1, "feature"]
    assert (feature.scope, feature.setting_value, feature.preview_phase) == ("workspace", "True", "BETA")
    assert found[2, "hidden"].setting_value == "<unavailable>"


def test_workspace_filter_keeps_the_account(spark):
    rows = build_snapshot(account(spark), workspaces(spark), F.lit(day(1)), workspace_ids=" 2 ,7")
    assert sorted((r.workspace_id or 0, r.setting_name) for r in rows.collect()) == [
        (0, "quota"), (2, "feature"), (2, "hidden"),
    ]
    assert {r.account_id for r in rows.collect()} == {"unknown"}
    assert ingest.only_workspaces(workspaces(spark), []).count() == 3


@pytest.mark.parametrize("given, wanted", [("", []), (" ", []), ("1,,3", [1, 3]), ("1, 3,", [1, 3]), (None, []), ([2], [2])])
def test_blank_workspace_ids_are_none(spark, given, wanted):
    assert ingest.workspace_ids(given) == wanted
    assert ingest.only_workspaces(workspaces(spark), given).count() == (len([w for w in (1, 2, 2) if w in wanted]) if wanted else 3)


def test_union_fills_columns_one_side_lacks(spark):
    both = ingest.snapshot_union(account(spark).withColumn("extra", F.lit(1)), workspaces(spark))
    assert {(r.workspace_id, r.extra) for r in both.collect()} == {(None, 1), (1, None), (2, None)}


def test_dry_run(spark):
    rows = history(spark, [(1, w, f"s{i:02}", "v" * 100) for w in (None, 1) for i in range(15)])
    found = ingest.dry_run(rows).collect()
    assert [(r.scope, r.setting_name) for r in found] == [("account", f"s{i:02}") for i in range(15)] + [
        ("workspace", f"s{i:02}") for i in range(5)
    ]
    assert {(r.setting_value, r.total_rows, r.more_rows) for r in found} == {("v" * 80, 30, 10)}
    few = ingest.dry_run(rows.limit(3)).collect()
    assert [(r.total_rows, r.more_rows) for r in few] == [(3, 0)] * 3


def test_runs_one_after_the_other(spark, store):
    run(spark, 1, store)
    stored = run(spark, 2, store, value="false")
    assert stored.count() == 8
    assert {r.category for r in stored.collect()} == {"a"}
    entries = store.categories(spark).select("classified_at").collect()
    assert [r.classified_at for r in entries] == [day(1)] * 3  # the second run classified nothing
    run(spark, 3, store, value="false", labels="b,c")
    assert store.categories(spark).count() == 6  # other labels: all anew

    drift = spark.sql("SELECT detected_at, change_type, count(*) FROM settings_drift GROUP BY ALL").collect()
    assert list(map(tuple, drift)) == [(day(2), "value_changed", 2)]
    latest = spark.sql("SELECT DISTINCT collected_at, category FROM settings_latest").collect()
    assert list(map(tuple, latest)) == [(day(3), "b")]
    status = spark.sql("SELECT setting_name, consistency_status FROM workspace_comparison ORDER BY ALL").collect()
    assert list(map(tuple, status)) == [("feature", "CONSISTENT"), ("hidden", "CONSISTENT")]
    alert = spark.sql(
        "SELECT count(*) FROM settings_drift WHERE detected_at = (SELECT max(collected_at) FROM settings_history)"
    )
    assert alert.first()[0] == 0


def test_failing_classifier_leaves_the_run_uncategorized(spark, paths):
    def failing(text, labels):
        return F.raise_error(F.lit("no model")).cast("string")

    stored = run(spark, 1, paths, classifier=failing)
    assert [r.category for r in stored.collect()] == [None] * 4
    stored = run(spark, 2, paths)
    assert {(r.collected_at, r.category) for r in stored.collect()} == {(day(1), None), (day(2), "a")}


def test_without_labels_nothing_is_classified(spark, paths):
    stored = run(spark, 1, paths, labels="")
    assert [r.category for r in stored.collect()] == [None] * 4


def test_nothing_stored_and_nothing_to_store(spark, tmp_path):
    path = str(tmp_path / "h")
    assert tables.read_history(spark, path).count() == 0
    tables.append_snapshot(history(spark, []), path)
    stored = tables.read_history(spark, path)
    assert stored.count() == 0
    register_views(stored, category_map(spark, []), tables.STORED_HISTORY)
    assert spark.table("settings_drift").count() == 0


def evolved(spark):
    first = history(spark, [(1, 1, "s", "a")])
    second = history(spark, [(2, 1, "s", "a")]).withColumn("deprecated_on", F.to_date("collected_at"))
    return first, second


def test_append_with_a_new_column(spark, tmp_path):
    path = str(tmp_path / "h")
    first, second = evolved(spark)
    for batch in (first, second, first.withColumn("collected_at", F.lit(day(3)))):
        tables.append_snapshot(batch, path)
    found = tables.read_history(spark, path).orderBy("collected_at").collect()
    assert [r.deprecated_on for r in found] == [None, datetime(2024, 1, 2).date(), None]
    assert [str(r.collected_on) for r in found] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    narrow = tables.read_history(spark, path, "collected_at TIMESTAMP, setting_name STRING")
    assert narrow.columns == ["collected_at", "setting_name", "collected_on"]


def test_a_date_gets_one_small_file_but_a_big_date_is_cut(spark, tmp_path):
    rows = history(spark, [(run, 1, f"s{i}", "v") for run in (1, 2, 3) for i in range(50)]).repartition(8)
    tables.append_snapshot(rows, str(tmp_path / "small"))
    assert len(list((tmp_path / "small").glob("*/*.parquet"))) == 3
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")
        tables.append_snapshot(rows, str(tmp_path / "big"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    assert len(list((tmp_path / "big").glob("collected_on=2024-01-02/*.parquet"))) > 1
    assert tables.read_history(spark, str(tmp_path / "big")).count() == 150


def test_append_without_adaptive_execution(spark, tmp_path):
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        rows = history(spark, [(1, 1, f"s{i}", "v") for i in range(40)]).repartition(4)
        tables.append_snapshot(rows, str(tmp_path / "h"))
        assert len(list((tmp_path / "h").glob("*/*.parquet"))) == 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture
def table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS evolve")
    yield "evolve.settings_history"
    spark.sql("DROP TABLE IF EXISTS evolve.settings_history")


def test_append_to_a_table_with_a_new_column(spark, table):
    first, second = evolved(spark)
    for batch in (first, second, first.withColumn("collected_at", F.lit(day(3))).drop("description")):
        tables.append_snapshot_to_table(batch, table)
    found = spark.table(table).orderBy("collected_at").collect()
    assert [r.deprecated_on for r in found] == [None, datetime(2024, 1, 2).date(), None]
    assert [r.setting_name for r in found] == ["s", "s", "s"]
    assert spark.table(table).columns[-2:] == ["deprecated_on", "collected_on"]


def test_labels_may_be_read_once_only(spark, paths):
    found = run(spark, 1, paths, labels=(label for label in ("a", "b"))).collect()
    assert {row.category for row in found} == {"a"}


@pytest.mark.parametrize("labels", ["", " , ", [" ", "\t"]])
def test_blank_labels_are_none(spark, paths, labels):
    def never(text, given):
        return F.raise_error(F.lit("called"))

    assert {row.category for row in run(spark, 1, paths, labels=labels, classifier=never).collect()} == {None}
    assert paths.categories(spark).count() == 0


def test_storage_failures_are_raised(spark, tmp_path):
    (tmp_path / "file").write_text("")
    broken = PathStore(f"{tmp_path}/history", f"{tmp_path}/file/map")
    with pytest.raises(Exception):
        run(spark, 1, broken)
    assert not (tmp_path / "history").exists()


def test_catalog_views_last_and_see_later_runs(spark, catalog):
    run(spark, 1, catalog)
    create_catalog_views(spark, catalog, "runs")
    run(spark, 2, catalog, value="false")
    run(spark, 3, catalog, value="null")
    other = spark.newSession()
    names = ("settings_latest", "workspace_comparison", "settings_drift")
    for name in names:
        lasting, of_session = other.table(f"runs.{name}"), spark.table(name)
        assert sorted(lasting.columns) == sorted(of_session.columns)
        order = of_session.columns
        rows = [sorted(map(str, df.select(*order).collect())) for df in (lasting, of_session)]
        assert rows[0] == rows[1] and rows[0]


def test_catalog_views_follow_new_columns(spark, catalog):
    run(spark, 1, catalog)
    create_catalog_views(spark, catalog, "runs")
    rows = history(spark, [(2, 1, "feature", "x")]).withColumn("deprecated_on", F.to_date("collected_at"))
    catalog.append_history(rows)
    found = spark.newSession().table("runs.settings_latest").select("setting_name", "deprecated_on").collect()
    assert [(r.setting_name, str(r.deprecated_on)) for r in found] == [("feature", "2024-01-02")]


def many(spark, n):
    return spark.range(n).selectExpr("concat('s', id) AS setting_name", "'' AS descr")


def poisoned(text, labels):
    bad = F.raise_error(F.concat(F.lit("no model for "), text)).cast("string")
    return F.when(text.isin("s7: ", "s301: "), bad).otherwise(F.get(labels, 0))


@pytest.mark.parametrize("batch_rows", [100_000, 64])
def test_a_text_that_fails_costs_only_its_own_category(spark, store, batch_rows):
    classify_settings(many(spark, 1000), store, "a,b", poisoned, F.lit(day(1)), batch_rows=batch_rows)
    entries = store.categories(spark)
    assert entries.where("category = 'a'").count() == entries.count() == 998
    failed = {r.setting_name: r.error for r in store.failures(spark).collect()}
    assert set(failed) == {"s7", "s301"} and all("no model for" in error for error in failed.values())
    classify_settings(many(spark, 1000), store, "a,b", first_label, F.lit(day(2)))
    assert {r.setting_name for r in store.categories(spark).where(F.col("classified_at") == day(2)).collect()} == set(failed)


def test_functions_fail_by_row(spark, paths):
    def pick(text, labels):
        if text == "s7: ":
            raise ValueError("odd")
        return labels[len(text) % 2]

    classify_settings(many(spark, 20), paths, "a,b", by_row(pick), F.lit(day(1)))
    found = {r.setting_name: r.category for r in paths.categories(spark).collect()}
    assert len(found) == 19 and found["s1"] == "a" and found["s11"] == "b"
    assert [(r.setting_name, r.error) for r in paths.failures(spark).collect()] == [("s7", "ValueError: odd")]


def test_a_classifier_that_is_down_is_given_up(spark, paths):
    def down(text, labels):
        return F.raise_error(F.lit("down")).cast("string")

    classify_settings(many(spark, 50), paths, "a,b", down, F.lit(day(1)), failed_jobs=12)
    assert paths.categories(spark).count() == 0
    assert paths.failures(spark).select("setting_name").distinct().count() == 50


def test_what_an_ended_run_staged_is_not_classified_again(spark, paths, monkeypatch):
    def broken(self, updates):
        raise OSError("storage")

    with monkeypatch.context() as patched:
        patched.setattr(PathStore, "append_categories", broken)
        with pytest.raises(OSError):
            classify_settings(many(spark, 10), paths, "a,b", first_label, F.lit(day(1)))
    assert paths.categories(spark).count() == 0

    def never(text, labels):
        return F.raise_error(F.lit("called")).cast("string")

    classify_settings(many(spark, 10), paths, "a,b", never, F.lit(day(2)))
    assert {r.classified_at for r in paths.categories(spark).collect()} == {day(1)}
    assert paths.failures(spark).count() == 0
