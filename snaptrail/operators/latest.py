"""The newest snapshot, enriched."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrail.functions import values
from snaptrail.layout import Layout
from snaptrail.operators.categories import current_category
from snaptrail.operators.lookup import BROADCAST_BYTES, lookup
from snaptrail.operators.runs import latest_rows


def latest_snapshot(
    history: DataFrame,
    category_map: DataFrame,
    layout: Layout = Layout(),
    labels_version: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """All columns of the newest run's rows, with ``category``, ``is_preview`` and ``status``.

    "Newest" is global: a workspace that the last run did not reach has no rows here. The map's
    category comes first, the one stored with the row is used where the map has none.
    """
    rows = with_category(latest_rows(history, layout), category_map, layout, labels_version, broadcast_bytes)
    return rows.select(
        *history.columns,
        values.is_preview(F.col(layout.phase)).alias("is_preview"),
        values.status(F.col(layout.value)).alias("status"),
    )


def with_category(
    rows: DataFrame,
    category_map: DataFrame,
    layout: Layout = Layout(),
    labels_version: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows with the map's current category in place of their own, where the map has one."""
    side = current_category(category_map, labels_version).select(
        F.col("setting_name").alias(layout.name), F.col("category").alias("_category")
    )
    resolved = F.coalesce(F.col("_category"), F.col(layout.category))
    bound = category_map.select("setting_name", "category")
    return lookup(rows, side, layout.name, broadcast_bytes, bound).withColumn(layout.category, resolved)
