"""Lasting SQL views over the history and category map of a catalog.

A history table remembers the views over it as a table property, so that they follow its columns.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from snaptrail.functions.values import NON_PREVIEW_PHASES, OFF_VALUES, ON_VALUES, SENTINELS

# Pairs of category map and database, as JSON.
_PROPERTY = "snaptrail.views"


def create_views(spark: SparkSession, history_table: str, map_table: str, database: str) -> None:
    """Create or replace the three views, and have them made anew when the history gets new columns."""
    _create(spark, history_table, map_table, database)
    known = _remembered(spark, history_table)
    if [map_table, database] not in known:
        text = json.dumps([*known, [map_table, database]]).replace("'", "\\'")
        spark.sql(f"ALTER TABLE {history_table} SET TBLPROPERTIES ('{_PROPERTY}' = '{text}')")


def recreate_views(spark: SparkSession, history_table: str) -> None:
    """Make the views over a history anew, with all columns it has now."""
    for map_table, database in _remembered(spark, history_table):
        _create(spark, history_table, map_table, database)


def _remembered(spark: SparkSession, table: str) -> list[list[str]]:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(f"key = '{_PROPERTY}'").first()
    return json.loads(found.value) if found else []


def _create(spark: SparkSession, history_table: str, map_table: str, database: str) -> None:
    columns = spark.table(history_table).columns
    resolved = "coalesce(m.category, h.category) AS category"
    shown = ", ".join(resolved if c == "category" else f"h.`{c}`" for c in columns)
    latest = f"""
        SELECT {shown}, {_is_preview("h.preview_phase")} AS is_preview, {_status("h.setting_value")} AS status
        FROM {_newest(history_table)} h LEFT JOIN {_categories(map_table)} m ON m.setting_name = h.setting_name"""
    comparison = f"""
        SELECT setting_name, category, count(DISTINCT setting_value) AS distinct_values,
          count(DISTINCT workspace_id) AS workspace_count,
          if(count(DISTINCT setting_value) > 1, 'INCONSISTENT', 'CONSISTENT') AS consistency_status,
          min(setting_value) AS sample_value
        FROM (SELECT h.setting_name, {resolved}, h.setting_value, h.workspace_id
          FROM {_newest(history_table)} h LEFT JOIN {_categories(map_table)} m ON m.setting_name = h.setting_name
          WHERE h.scope = 'workspace')
        GROUP BY setting_name, category"""
    for name, query in (
        ("settings_latest", latest),
        ("workspace_comparison", comparison),
        ("settings_drift", _drift_sql(history_table, map_table)),
    ):
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {query}")


def _texts(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{value}'" for value in values) + ")"


def _is_preview(phase: str) -> str:
    return f"({phase} IS NOT NULL AND {phase} NOT IN {_texts(NON_PREVIEW_PHASES)})"


def _status(value: str) -> str:
    return f"""CASE WHEN lower({value}) IN {_texts(ON_VALUES)} THEN 'ENABLED'
                    WHEN lower({value}) IN {_texts(OFF_VALUES)} THEN 'DISABLED' ELSE 'OTHER' END"""


def _newest(table: str) -> str:
    """The rows of the newest run, which lies in the newest partition: no other is read."""
    newest_date = f"(SELECT max(collected_on) FROM {table})"
    newest = f"(SELECT max(collected_at) FROM {table} WHERE collected_on = {newest_date})"
    return f"(SELECT * FROM {table} WHERE collected_on = {newest_date} AND collected_at = {newest})"


def _categories(map_table: str) -> str:
    """The category that each setting was given last."""
    return f"""(SELECT setting_name, category FROM (
          SELECT *, row_number() OVER (PARTITION BY setting_name ORDER BY classified_at DESC NULLS LAST,
            labels_version DESC NULLS LAST, category ASC NULLS LAST) AS place FROM {map_table})
        WHERE place = 1)"""


def _drift_sql(history_table: str, map_table: str) -> str:
    """Each row goes to the cell of its own run and to that of the next; a cell compares both."""
    sentinels = _texts(SENTINELS)

    def side(column: str, current: bool) -> str:
        return f"max(if({'' if current else 'NOT '}is_current, {column}, NULL))"

    return f"""
        WITH links AS (
          SELECT collected_at AS run, lead(collected_at) OVER (ORDER BY collected_at) AS next_run,
            row_number() OVER (ORDER BY collected_at) = 1 AS is_first
          FROM (SELECT DISTINCT collected_at FROM {history_table})),
        sides AS (
          SELECT setting_name, coalesce(workspace_id, 0) AS workspace, workspace_name, setting_value, is_current,
            if(is_current, if(is_first, NULL, run), next_run) AS detected_at
          FROM {history_table} JOIN links ON collected_at = run
            LATERAL VIEW explode(array(true, false)) AS is_current),
        cells AS (
          SELECT setting_name, workspace, detected_at, {side("setting_value", True)} AS new_value,
            {side("setting_value", False)} AS previous_value,
            coalesce({side("workspace_name", True)}, {side("workspace_name", False)}) AS workspace_name
          FROM sides WHERE detected_at IS NOT NULL GROUP BY setting_name, workspace, detected_at),
        judged AS (
          SELECT *, CASE
              WHEN previous_value IN {sentinels} OR new_value IN {sentinels} THEN NULL
              WHEN previous_value IS NULL AND new_value IS NOT NULL THEN 'added'
              WHEN previous_value IS NOT NULL AND new_value IS NULL THEN 'removed'
              WHEN previous_value <> new_value THEN 'value_changed' END AS change_type
          FROM cells)
        SELECT date_from_unix_date(CAST(floor(unix_seconds(detected_at) / 86400) AS INT)) AS change_date,
          j.setting_name, j.workspace_name, m.category, j.change_type, j.previous_value, j.new_value, j.detected_at
        FROM judged j LEFT JOIN {_categories(map_table)} m ON m.setting_name = j.setting_name
        WHERE j.change_type IS NOT NULL"""
