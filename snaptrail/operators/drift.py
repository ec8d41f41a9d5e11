"""What changed between neighbouring runs, without building the series-by-run grid.

A grid has a cell for every series (setting and workspace) and every run. Only cells that have an
observation in their own run or in the run before can hold a change, so each history row is sent to
two cells: as "current" to that of its own run, as "previous" to that of the next run. One grouped
maximum per cell then brings both sides together. Cells are small and independent: a series with
very many runs is spread over all tasks, and repeated rows of a cell are merged before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrail.functions import values
from snaptrail.layout import Layout
from snaptrail.operators.categories import current_category
from snaptrail.operators.lookup import BROADCAST_BYTES, lookup
from snaptrail.operators.runs import (
    SMALL_TIMELINE_BYTES,
    latest_run,
    previous_run,
    rows_since,
    with_neighbours,
)

COLUMNS = (
    "change_date",
    "setting_name",
    "workspace_name",
    "category",
    "change_type",
    "previous_value",
    "new_value",
    "detected_at",
)

_SERIES = ("setting_name", "_workspace")


def drift(
    history: DataFrame,
    category_map: DataFrame | None = None,
    layout: Layout = Layout(),
    runs: DataFrame | None = None,
    labels_version: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    small_timeline_bytes: int = SMALL_TIMELINE_BYTES,
) -> DataFrame:
    """One row per change: added, removed or value_changed against the run before.

    A missing row equals a NULL value; a sentinel masks a change; the first run never drifts.
    ``runs`` may give the run times where they are known without reading the history. Without
    ``category_map`` the category is NULL.
    """
    if runs is None:
        runs = history if layout.known_runs is None else layout.known_runs.table
    rows = _observations(history, layout)
    placed = with_neighbours(rows, runs, layout.run, small_timeline_bytes, broadcast_bytes)
    own_cell = F.when(~F.col("is_first"), F.col(layout.run))
    sides = placed.withColumn("_current", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn(
        "detected_at", F.when(F.col("_current"), own_cell).otherwise(F.col("next_run"))
    )
    cells = (
        sides.where(F.col("detected_at").isNotNull())
        .groupBy(*_SERIES, "detected_at")
        .agg(*_both_sides(F.col("_current")))
    )
    return _changes(cells, rows, category_map, labels_version, broadcast_bytes)


def latest_drift(
    history: DataFrame,
    category_map: DataFrame | None = None,
    layout: Layout = Layout(),
    labels_version: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The rows of :func:`drift` detected in the newest run, reading only the two newest runs."""
    newest, before = latest_run(history, layout), previous_run(history, layout)
    rows = _observations(rows_since(history, before, 2, layout), layout)
    cells = rows.groupBy(*_SERIES).agg(*_both_sides(F.col(layout.run) == newest))
    found = cells.withColumn("detected_at", newest)
    return _changes(found, rows, category_map, labels_version, broadcast_bytes)


def _observations(history: DataFrame, layout: Layout) -> DataFrame:
    return history.select(
        F.col(layout.name).alias("setting_name"),
        layout.workspace_key().alias("_workspace"),
        F.col(layout.run),
        F.col(layout.value).alias("_observed"),
        layout.workspace_label().alias("_observed_label"),
    )


def _both_sides(is_current: Column) -> list[Column]:
    """Current and previous state of a cell; repeated observations count as their maximum."""
    return [
        F.max(F.when(side, F.col(column))).alias(name)
        for side, column, name in (
            (is_current, "_observed", "_value"),
            (is_current, "_observed_label", "_label"),
            (~is_current, "_observed", "_previous"),
            (~is_current, "_observed_label", "_previous_label"),
        )
    ]


def _changes(
    cells: DataFrame,
    rows: DataFrame,
    category_map: DataFrame | None,
    labels_version: str | None,
    broadcast_bytes: int,
) -> DataFrame:
    changed = cells.withColumn(
        "change_type", values.change_type(F.col("_previous"), F.col("_value"))
    ).where(F.col("change_type").isNotNull())
    found = changed.select(
        values.utc_date(changed, "detected_at").alias("change_date"),
        "setting_name",
        F.coalesce("_label", "_previous_label").alias("workspace_name"),
        "change_type",
        F.col("_previous").alias("previous_value"),
        F.col("_value").alias("new_value"),
        "detected_at",
    )
    # A setting has at most two changes per observation; counting these needs one column.
    return categorized(found, category_map, labels_version, broadcast_bytes, rows.select("setting_name"))


def categorized(
    changes: DataFrame,
    category_map: DataFrame | None,
    labels_version: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Changes with the map's current ``category``, NULL without a map."""
    if category_map is None:
        found = changes.withColumn("category", F.lit(None).cast("string"))
    else:
        side = current_category(category_map, labels_version)
        bound = category_map.select("setting_name", "category")
        found = lookup(changes, side, "setting_name", broadcast_bytes, bound, keys)
    return found.select(*COLUMNS)
