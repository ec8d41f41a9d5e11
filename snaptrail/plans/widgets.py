"""What each dashboard widget shows of its dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settings_discovered(current: DataFrame) -> DataFrame:
    return current.agg(F.count_distinct("setting_name").alias("total_settings"))


def workspaces_scanned(current: DataFrame) -> DataFrame:
    scanned = F.when(F.col("scope") == "workspace", F.col("workspace_id"))
    return current.agg(F.count_distinct(scanned).alias("workspace_count"))


def preview_count(current: DataFrame) -> DataFrame:
    previews = F.when(F.col("is_preview"), F.col("setting_name"))
    return current.agg(F.count_distinct(previews).alias("preview_count"))


def settings_by_category(current: DataFrame) -> DataFrame:
    return current.groupBy("category").agg(F.count_distinct("setting_name").alias("setting_count"))


def settings_by_scope(current: DataFrame) -> DataFrame:
    return current.groupBy("scope").agg(F.count("setting_name").alias("setting_count"))


def previews_by_status(previews: DataFrame) -> DataFrame:
    return previews.groupBy("status").agg(F.count("setting_name").alias("feature_count"))


def previews_by_phase(previews: DataFrame) -> DataFrame:
    return previews.groupBy("preview_phase").agg(F.count("setting_name").alias("feature_count"))


def preview_table(previews: DataFrame) -> DataFrame:
    return previews.select("setting_name", "preview_phase", "workspace_name", "status", "description")


def changes_per_day(drift: DataFrame) -> DataFrame:
    return drift.groupBy("change_date").agg(F.count("setting_name").alias("changes"))


def change_details(drift: DataFrame) -> DataFrame:
    return drift.select(
        "change_date",
        "setting_name",
        "change_type",
        "workspace_name",
        "category",
        "previous_value",
        "new_value",
        "detected_at",
    )


def consistency_table(consistency: DataFrame) -> DataFrame:
    return consistency.select(
        "setting_name", "category", "consistency_status", "distinct_values", "workspace_count", "sample_value"
    )


def collection_history_table(collection_history: DataFrame) -> DataFrame:
    return collection_history.select("collected_at", "settings_count", "workspaces")
