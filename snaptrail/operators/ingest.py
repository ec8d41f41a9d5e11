"""From raw setting payloads to snapshot rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrail.functions.payload import with_payload_value

# What a row says when the payload table does not.
DEFAULT_SOURCE = "settings_v2"
UNKNOWN = "unknown"

PREVIEW_ROWS = 20
PREVIEW_VALUE_LENGTH = 80


def snapshot_rows(
    payloads: DataFrame,
    scope: str,
    collected_at: Column,
    account_id: str = UNKNOWN,
    source: str = DEFAULT_SOURCE,
) -> DataFrame:
    """History rows of one run from a payload table.

    Needs ``setting_name``, ``payload`` and ``read_failed``; takes ``setting_type``,
    ``preview_phase``, ``description``, ``workspace_id`` and ``workspace_name`` where present.
    Account rows have no workspace.
    """
    in_workspace = scope == "workspace"

    def given(column: str, type_: str = "string") -> Column:
        value = F.col(column) if column in payloads.columns else F.lit(None)
        return value.cast(type_).alias(column)

    def workspace(column: str, type_: str = "string") -> Column:
        return given(column, type_) if in_workspace else F.lit(None).cast(type_).alias(column)

    return with_payload_value(payloads).select(
        collected_at.alias("collected_at"),
        F.lit(account_id).alias("account_id"),
        F.lit(scope).alias("scope"),
        workspace("workspace_id", "bigint"),
        workspace("workspace_name"),
        "setting_name",
        "setting_value",
        F.coalesce(given("setting_type"), F.lit(UNKNOWN)).alias("setting_type"),
        F.lit(source).alias("source"),
        F.lit(None).cast("string").alias("category"),
        given("preview_phase"),
        given("description"),
    )


def snapshot_union(account_rows: DataFrame, workspace_rows: DataFrame) -> DataFrame:
    """Account rows followed by workspace rows; a column only one side has is NULL on the other."""
    return account_rows.unionByName(workspace_rows, allowMissingColumns=True)


def workspace_ids(ids: Iterable[int] | str | None) -> list[int]:
    """Workspace ids from a list or a comma-separated text, in which blank parts count as none."""
    parts = [part for part in ids.split(",") if part.strip()] if isinstance(ids, str) else ids or []
    return [int(part) for part in parts]


def only_workspaces(
    rows: DataFrame, ids: Iterable[int] | str | None, workspace: str = "workspace_id"
) -> DataFrame:
    """Rows of the given workspaces; of all when none are given."""
    wanted = workspace_ids(ids)
    return rows.where(F.col(workspace).isin(wanted)) if wanted else rows


def dry_run(rows: DataFrame) -> DataFrame:
    """What a run would write: its first rows with shortened values, the row count and the rest.

    First means account rows, then workspaces by id, each by setting name.
    """
    total = rows.agg(F.count("*")).scalar()
    first = rows.orderBy("scope", "workspace_id", "setting_name", "setting_value").limit(PREVIEW_ROWS)
    return first.select(
        "scope",
        "workspace_name",
        "setting_name",
        F.substring("setting_value", 1, PREVIEW_VALUE_LENGTH).alias("setting_value"),
        total.alias("total_rows"),
        F.greatest(total - PREVIEW_ROWS, F.lit(0)).cast("bigint").alias("more_rows"),
    )
