"""Views over a history, for querying it in SQL: of a session, or lasting ones in the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from snaptrail.layout import Layout
from snaptrail.operators.consistency import workspace_consistency
from snaptrail.operators.drift import drift
from snaptrail.operators.latest import latest_snapshot
from snaptrail.sources.catalog_views import create_views
from snaptrail.sources.tables import CatalogStore, create_category_table, create_history_table


def register_views(history: DataFrame, category_map: DataFrame, layout: Layout = Layout()) -> None:
    """Create or replace the views of the two tables and of what is derived from them."""
    views = {
        "settings_history": history,
        "setting_category_map": category_map,
        "settings_latest": latest_snapshot(history, category_map, layout),
        "workspace_comparison": workspace_consistency(history, category_map, layout),
        "settings_drift": drift(history, category_map, layout),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)


def create_catalog_views(spark: SparkSession, store: CatalogStore, database: str) -> None:
    """Create or replace lasting views in ``database`` over the two tables of a catalog store.

    Other sessions can read ``settings_latest``, ``workspace_comparison`` and ``settings_drift``, and see
    the runs that were stored since, with columns that these added. They hold the same rows as the
    operators of these names. Making them reads no data.
    """
    create_history_table(spark, store.history_table)
    create_category_table(spark, store.map_table)
    create_views(spark, store.history_table, store.map_table, database)
