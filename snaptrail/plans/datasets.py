"""The five datasets a dashboard page is built on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrail.layout import Layout
from snaptrail.operators.runs import newest_runs, rows_since

HISTORY_RUNS = 10


def current_settings(latest: DataFrame) -> DataFrame:
    return latest.select(
        "scope",
        "category",
        "setting_name",
        "setting_value",
        "workspace_id",
        "workspace_name",
        "is_preview",
        "status",
        "preview_phase",
    )


def preview_features(latest: DataFrame) -> DataFrame:
    return latest.where("is_preview").select(
        "setting_name",
        "description",
        "preview_phase",
        "workspace_name",
        "workspace_id",
        "setting_value",
        "status",
        "category",
    )


def drift_newest_first(drift: DataFrame) -> DataFrame:
    """Changes, newest first.

    The further sort columns let Spark split the changes of one big run over many sort ranges.
    """
    return drift.orderBy(
        F.desc("detected_at"), "setting_name", "workspace_name", "change_type", "previous_value", "new_value"
    )


def consistency_sorted(consistency: DataFrame) -> DataFrame:
    return consistency.select(
        "setting_name", "category", "distinct_values", "workspace_count", "sample_value", "consistency_status"
    ).orderBy("consistency_status", F.desc("distinct_values"), "setting_name", "category")


def collection_history(history: DataFrame, layout: Layout = Layout(), runs: int = HISTORY_RUNS) -> DataFrame:
    """Rows and workspaces of the newest runs. Only those runs are read in full, and none if they are known."""
    if layout.known_runs is not None:
        counted = layout.known_runs.table.select(layout.run, "settings_count", "workspaces")
        return counted.orderBy(F.desc(layout.run)).limit(runs)
    oldest = newest_runs(history, runs, layout).agg(F.min(layout.run)).scalar()
    return (
        rows_since(history, oldest, runs, layout)
        .groupBy(layout.run)
        .agg(
            F.count("*").alias("settings_count"),
            F.count_distinct(F.col(layout.workspace)).alias("workspaces"),
        )
        .orderBy(F.desc(layout.run))
        .limit(runs)
    )
