"""Incremental classification of settings through a cached category map."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptrail.functions.values import label_array, labels_version
from snaptrail.operators.lookup import BROADCAST_BYTES, lookup

# A classifier gets the text to classify and the array of labels, and returns a string column;
# it may be built from Spark functions or wrap a pandas UDF. It may also return a struct of category and
# error, for texts that it fails on.
Classifier = Callable[[Column, Column], Column]

MAP_KEYS = ("setting_name", "labels_version")


def distinct_settings(
    rows: DataFrame,
    order_by: Sequence[str] = ("scope", "workspace_id"),
    name: str = "setting_name",
    description: str = "description",
) -> DataFrame:
    """One row per setting: ``setting_name`` and ``descr``, its first non-empty description.

    "First" is by ``order_by`` (account rows before workspace rows by default), then by the text
    itself, so the pick does not depend on how rows are spread. No description at all gives ''.
    """
    candidate = F.when(
        F.col(description) != "",
        F.struct(*[F.col(c) for c in order_by], F.col(description).alias("_descr")),
    )
    return rows.groupBy(F.col(name).alias("setting_name")).agg(
        F.coalesce(F.min(candidate)["_descr"], F.lit("")).alias("descr")
    )


def classify_new(
    settings: DataFrame,
    category_map: DataFrame,
    labels: Iterable[str] | str,
    classifier: Classifier,
    classified_at: Column,
    tasks: int | None = None,
) -> DataFrame:
    """Category-map rows for the settings that the map lacks under the current label set.

    ``settings`` comes from :func:`distinct_settings`. Settings already in the map for this label
    set are skipped, also when their category is NULL, so a warm map classifies nothing.
    ``tasks`` spreads a slow classifier: new settings are few bytes, which Spark would otherwise
    put into few tasks.
    """
    new = unclassified(settings, category_map, labels)
    return classified(new, labels, classifier, classified_at, tasks).drop("error")


def unclassified(settings: DataFrame, category_map: DataFrame, labels: Iterable[str] | str) -> DataFrame:
    """The rows of ``settings`` that the map has no entry for under the given label set."""
    known = category_map.where(F.col("labels_version") == labels_version(label_array(labels)))
    return settings.join(known.select("setting_name"), "setting_name", "left_anti")


def classified(
    settings: DataFrame,
    labels: Iterable[str] | str,
    classifier: Classifier,
    classified_at: Column,
    tasks: int | None = None,
) -> DataFrame:
    """Category-map rows for all of ``settings``, and ``error``, which a classifier may give with its result."""
    label_list = label_array(labels)
    text = F.concat(F.col("setting_name"), F.lit(": "), F.coalesce(F.col("descr"), F.lit("")))
    if tasks is not None:
        settings = settings.repartition(tasks, "setting_name")
    found = settings.select("setting_name", classifier(text, label_list).alias("_found"))
    category, error = F.col("_found"), F.lit(None).cast("string")
    if found.schema["_found"].dataType.typeName() == "struct":
        category, error = F.col("_found.category"), F.col("_found.error")
    return found.select(
        "setting_name",
        category.alias("category"),
        labels_version(label_list).alias("labels_version"),
        classified_at.alias("classified_at"),
        error.alias("error"),
    )


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str] = MAP_KEYS) -> DataFrame:
    """``target`` with the rows of ``updates`` in place of, or in addition to, its own by ``keys``.

    Of updates that repeat their keys, one stays: the newest where they say when they were
    classified, and otherwise the first by its values.
    """
    others = [F.col(c) for c in updates.columns if c not in keys]
    newest = [F.desc_nulls_last("classified_at")] if "classified_at" in updates.columns else []
    first = Window.partitionBy(*keys).orderBy(*newest, *others)
    single = updates.withColumn("_place", F.row_number().over(first)).where("_place = 1").drop("_place")
    return target.join(single, list(keys), "left_anti").unionByName(single)


def apply_categories(
    rows: DataFrame,
    category_map: DataFrame,
    labels: Iterable[str] | str,
    name: str = "setting_name",
    category: str = "category",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Set each row's category from the map's current label set; NULL where it has none.

    Of several entries for a setting the newest counts, so rows are never multiplied.
    """
    version = labels_version(label_array(labels))
    entries = category_map.where(F.col("labels_version") == version)
    newest = F.max_by("category", F.struct(F.coalesce("classified_at", F.lit("0001-01-01").cast("timestamp_ntz")), F.coalesce("category", F.lit(""))))
    current = entries.groupBy(F.col("setting_name").alias(name)).agg(newest.alias("_category"))
    looked_up = lookup(rows, current, name, broadcast_bytes)
    return looked_up.withColumn(category, F.col("_category")).select(*_with(rows.columns, category))


def classification_report(rows: DataFrame, category: str = "category") -> DataFrame:
    """One row: how many rows have a category, and how many there are."""
    return rows.agg(
        F.count(F.when(F.col(category) != "", 1)).alias("classified"), F.count("*").alias("total")
    )


def current_category(category_map: DataFrame, labels_version: str | None = None) -> DataFrame:
    """The newest category of each setting: over all label sets, or of the given one only."""
    if labels_version is not None:
        category_map = category_map.where(F.col("labels_version") == labels_version)
    newest = Window.partitionBy("setting_name").orderBy(
        F.desc_nulls_last("classified_at"),
        F.desc_nulls_last("labels_version"),
        F.asc_nulls_last("category"),
    )
    # Spark keeps one row per setting in each task before the shuffle (window group limit).
    ranked = category_map.withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") == 1).select("setting_name", "category")


def _with(columns: Sequence[str], column: str) -> list[str]:
    return list(columns) if column in columns else [*columns, column]
