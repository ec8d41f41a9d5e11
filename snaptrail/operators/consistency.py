"""Whether the workspaces of the newest run agree on a setting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrail.layout import Layout
from snaptrail.operators.latest import with_category
from snaptrail.operators.lookup import BROADCAST_BYTES
from snaptrail.operators.runs import latest_rows


def workspace_consistency(
    history: DataFrame,
    category_map: DataFrame,
    layout: Layout = Layout(),
    labels_version: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per setting (and category): distinct values, workspaces, status, a sample value.

    Sentinels count as values, NULL does not. The sample is the smallest value. The two distinct
    counts first de-duplicate by setting and value, and by setting and workspace, so the rows of
    one widespread setting are spread over tasks and only counts meet in the last step.
    """
    workspace_rows = latest_rows(history, layout).where(F.col(layout.scope) == "workspace")
    needed = workspace_rows.select(layout.name, layout.category, layout.value, layout.workspace)
    rows = with_category(needed, category_map, layout, labels_version, broadcast_bytes)
    distinct_values = F.count_distinct(F.col(layout.value))
    return rows.groupBy(
        F.col(layout.name).alias("setting_name"), F.col(layout.category).alias("category")
    ).agg(
        distinct_values.alias("distinct_values"),
        F.count_distinct(F.col(layout.workspace)).alias("workspace_count"),
        F.when(distinct_values > 1, "INCONSISTENT").otherwise("CONSISTENT").alias("consistency_status"),
        F.min(layout.value).alias("sample_value"),
    )
