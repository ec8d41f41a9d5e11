"""Incremental classification and the category map."""

import pytest
from pyspark.sql import functions as F

from snaptrail.functions.values import label_array, labels_version
from snaptrail.operators import categories
from snaptrail.sources import tables
from tests.histories import category_map, day, history

LABELS = ["alpha", "beta"]


def version_of(spark, labels):
    return spark.range(1).select(labels_version(label_array(labels))).first()[0]


def by_length(text, labels):
    return F.get(labels, F.length(text) % F.size(labels))


def described(spark, rows):
    return history(spark, [(1, ws, name, "v", {"description": text}) for ws, name, text in rows])


def test_best_description(spark):
    rows = described(
        spark,
        [
            (2, "s", "from workspace 2"), (1, "s", "from workspace 1"), (None, "s", ""),
            (1, "t", "from workspace 1"), (None, "t", "from account"),
            (1, "none", None), (2, "none", ""),
        ],
    )
    found = {r.setting_name: r.descr for r in categories.distinct_settings(rows).collect()}
    assert found == {"s": "from workspace 1", "t": "from account", "none": ""}


def test_text_labels_and_time_of_new_entries(spark):
    settings = spark.createDataFrame([("a", "d"), ("b", None)], "setting_name STRING, descr STRING")
    new = categories.classify_new(
        settings,
        category_map(spark, []),
        [" beta", "alpha "],
        lambda text, labels: F.concat_ws("|", text, F.array_join(labels, ",")),
        F.lit(day(3)),
    )
    assert {r.setting_name: r.category for r in new.collect()} == {"a": "a: d|beta,alpha", "b": "b: |beta,alpha"}
    assert {(r.labels_version, r.classified_at) for r in new.collect()} == {(version_of(spark, LABELS), day(3))}


def test_only_unknown_settings_are_classified(spark):
    now = version_of(spark, LABELS)
    settings = spark.createDataFrame([(n, "") for n in "abcd"], "setting_name STRING, descr STRING")
    # b was classified as NULL, which counts as known; c only under another label set
    known = category_map(spark, [("a", "alpha", now, 1), ("b", None, now, 1), ("c", "x", "other", 1)])
    new = categories.classify_new(settings, known, LABELS, by_length, F.lit(day(2)))
    assert sorted(r.setting_name for r in new.collect()) == ["c", "d"]
    again = categories.classify_new(settings, categories.upsert(known, new), LABELS, by_length, F.lit(day(3)))
    assert again.count() == 0
    other = categories.classify_new(settings, categories.upsert(known, new), ["gamma"], by_length, F.lit(day(3)))
    assert other.count() == 4


def test_a_slow_classifier_may_be_spread(spark):
    settings = spark.range(40).selectExpr("concat('s', id) AS setting_name", "'' AS descr")

    def task(text, labels):
        return F.spark_partition_id().cast("string")

    def used(tasks):
        new = categories.classify_new(settings, category_map(spark, []), LABELS, task, F.lit(day(1)), tasks)
        return len({r.category for r in new.collect()})

    assert used(6) == 6 > used(1) == 1


def test_upsert(spark):
    old = category_map(spark, [("a", "x", "v1", 1), ("a", "x", "v2", 1), ("b", "x", "v1", 1)])
    new = category_map(spark, [("a", "y", "v1", 2), ("c", "y", "v1", 2)])
    found = {(r.setting_name, r.labels_version): (r.category, r.classified_at) for r in categories.upsert(old, new).collect()}
    assert found == {
        ("a", "v1"): ("y", day(2)), ("a", "v2"): ("x", day(1)), ("b", "v1"): ("x", day(1)), ("c", "v1"): ("y", day(2)),
    }


def test_apply_categories_uses_the_current_label_set_only(spark):
    now = version_of(spark, LABELS)
    rows = history(spark, [(1, 1, s, "v", {"category": "stale"}) for s in ("a", "b", "c", "d")])
    entries = category_map(spark, [("a", "alpha", now, 1), ("b", "x", "other", 1), ("d", "", now, 1)])
    applied = categories.apply_categories(rows, entries, LABELS)
    assert applied.columns == rows.columns
    assert {r.setting_name: r.category for r in applied.collect()} == {"a": "alpha", "b": None, "c": None, "d": ""}
    assert tuple(categories.classification_report(applied).first()) == (1, 4)


def test_stored_map_gives_the_newest_entry(spark, tmp_path):
    path = str(tmp_path / "map")
    assert tables.read_categories(spark, path).count() == 0
    tables.append_categories(category_map(spark, [("a", "x", "v1", 1), ("a", "z", "v2", 1)]), path)
    tables.append_categories(category_map(spark, [("a", "y", "v1", 2)]), path)
    found = {(r.setting_name, r.labels_version): r.category for r in tables.read_categories(spark, path).collect()}
    assert found == {("a", "v1"): "y", ("a", "v2"): "z"}


def test_classifier_may_be_a_pandas_udf(spark):
    pandas = pytest.importorskip("pandas")

    @F.pandas_udf("string")
    def pick(text: pandas.Series, labels: pandas.Series) -> pandas.Series:
        return pandas.Series([options[len(t) % len(options)] for t, options in zip(text, labels)])

    settings = spark.createDataFrame([("a", "d"), ("bb", "d")], "setting_name STRING, descr STRING")
    new = categories.classify_new(settings, category_map(spark, []), LABELS, pick, F.lit(day(1)))
    assert {r.setting_name: r.category for r in new.collect()} == {"a": "alpha", "bb": "beta"}


def test_repeated_entries_and_updates_never_multiply_rows(spark):
    now = version_of(spark, LABELS)
    rows = history(spark, [(1, 1, "s", "v"), (1, 2, "s", "v")])
    known = category_map(spark, [("s", "old", now, 1), ("s", "new", now, 2), ("s", "new", now, 2)])
    found = categories.apply_categories(rows, known, LABELS).collect()
    assert [row.category for row in found] == ["new", "new"]
    merged = categories.upsert(category_map(spark, [("s", "x", now, 1), ("t", "y", now, 1)]), known)
    assert sorted((r.setting_name, r.category) for r in merged.collect()) == [("s", "new"), ("t", "y")]
