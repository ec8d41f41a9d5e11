"""DuckDB SQL with the expected result of every registered query.

Drift is stated here as the full series-by-run grid, which the Spark operators never build.
"""

from oracle_fixtures import CATEGORY_MAP, HISTORY, PARTS_HISTORY, PAYLOADS

# Sentinel texts, on and off texts, phases that are no preview, default labels.
SENTINELS = "('<unavailable>', '<null>', '<not-set>')"
ON = "('true', 'enabled', '1', 'on')"
OFF = "('false', 'disabled', '0', 'off')"
PREVIEW = "coalesce(preview_phase NOT IN ('GA', 'None', '', 'PreviewPhase.GA'), false)"

LABELS = ("governance", "ingestion", "AI", "ML", "compute", "marketplace", "platform", "other")
LABEL_LIST = "[" + ", ".join(f"'{label}'" for label in LABELS) + "]"
VERSION = f"substr(sha256(array_to_string(list_sort({LABEL_LIST}), '|')), 1, 12)"

NEWEST = """
newest AS (SELECT * FROM history WHERE collected_at = (SELECT max(collected_at) FROM history))"""

CURRENT_CATEGORY = """
current_category AS (
  SELECT DISTINCT ON (setting_name) setting_name, category AS map_category FROM category_map
  ORDER BY setting_name, classified_at DESC, labels_version DESC, category)"""

LATEST = f"""
latest AS (
  SELECT newest.* REPLACE (coalesce(map_category, category) AS category), {PREVIEW} AS is_preview,
    CASE WHEN lower(setting_value) IN {ON} THEN 'ENABLED'
         WHEN lower(setting_value) IN {OFF} THEN 'DISABLED' ELSE 'OTHER' END AS status
  FROM newest LEFT JOIN current_category USING (setting_name))"""

CONSISTENCY = """
consistency AS (
  SELECT setting_name, category, count(DISTINCT setting_value) AS distinct_values,
    count(DISTINCT workspace_id) AS workspace_count,
    if(count(DISTINCT setting_value) > 1, 'INCONSISTENT', 'CONSISTENT') AS consistency_status,
    min(setting_value) AS sample_value
  FROM latest WHERE scope = 'workspace' GROUP BY setting_name, category)"""


def drift_steps(source: str, workspace_name: str = "workspace_name") -> str:
    return f"""
cells AS (
  SELECT setting_name AS s, coalesce(workspace_id, 0) AS w, collected_at AS t,
    max(setting_value) AS v, max({workspace_name}) AS label
  FROM {source} GROUP BY ALL),
grid AS (
  SELECT * FROM (SELECT DISTINCT s, w FROM cells) CROSS JOIN (SELECT DISTINCT t FROM cells)
  LEFT JOIN cells USING (s, w, t)),
steps AS (
  SELECT *, lag(v) OVER series AS pv, lag(label) OVER series AS plabel, row_number() OVER series AS step,
    coalesce(v NOT IN {SENTINELS}, false) AS has_value
  FROM grid WINDOW series AS (PARTITION BY s, w ORDER BY t)),
judged AS (
  SELECT *, CASE
      WHEN pv IS NULL THEN if(has_value, 'added', NULL)
      WHEN pv IN {SENTINELS} THEN NULL
      WHEN v IS NULL THEN 'removed'
      WHEN has_value AND v <> pv THEN 'value_changed' END AS change_type
  FROM steps WHERE step > 1)"""


DRIFT = f"""{drift_steps("history")},
drift AS (
  SELECT CAST(t AS DATE) AS change_date, s AS setting_name, coalesce(label, plabel) AS workspace_name,
    map_category AS category, change_type, pv AS previous_value, v AS new_value, t AS detected_at
  FROM judged LEFT JOIN current_category ON s = setting_name WHERE change_type IS NOT NULL)"""

CURRENT = """
current_ds AS (
  SELECT scope, category, setting_name, setting_value, workspace_id, workspace_name, is_preview, status, preview_phase
  FROM latest)"""

PREVIEWS = """
preview_ds AS (
  SELECT setting_name, description, preview_phase, workspace_name, workspace_id, setting_value, status, category
  FROM latest WHERE is_preview)"""

SNAPSHOT = f"""
read_values AS (
  SELECT *, CASE
      WHEN read_failed THEN '<unavailable>'
      WHEN payload IS NULL THEN '<null>'
      -- The last of members that repeat, and a number that is not whole as the text of its double.
      WHEN payload LIKE '%old%' THEN regexp_extract(payload, '.*"(?:string_val|value)":"([^"]*)"', 1)
      WHEN contains(payload, '"value":') AND NOT contains(payload, '_val"')
        THEN CAST(CAST(regexp_extract(payload, '"value":([^}}]*)', 1) AS DOUBLE) AS VARCHAR)
      WHEN json_type(payload, '$.effective_boolean_val.value') = 'BOOLEAN'
        THEN if(CAST(payload ->> '$.effective_boolean_val.value' AS BOOLEAN), 'True', 'False')
      ELSE coalesce(payload ->> '$.effective_string_val.value', payload ->> '$.effective_integer_val.value',
                    payload ->> '$.string_val.value', '<not-set>') END AS setting_value
  FROM payloads),
snapshot AS (
  SELECT TIMESTAMP '2024-02-01' AS collected_at, 'acct-1' AS account_id,
    if(user_id % 5 = 0, 'account', 'workspace') AS scope,
    if(user_id % 5 = 0, NULL, user_id % 5) AS workspace_id,
    if(user_id % 5 = 0, NULL, 'ws-' || user_id % 5) AS workspace_name,
    setting_name, setting_value, 'unknown' AS setting_type, 'settings_v2' AS source,
    CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS preview_phase, CAST(NULL AS VARCHAR) AS description
  FROM read_values)"""

BEST = """
best AS (
  SELECT DISTINCT ON (setting_name) setting_name, coalesce(description, '') AS descr FROM history
  ORDER BY setting_name, coalesce(description, '') = '', scope NULLS FIRST, workspace_id NULLS FIRST, description)"""

KNOWN_MAP = f"""
known_map AS (
  SELECT setting_name, category, if(labels_version = 'v_new', {VERSION}, labels_version) AS labels_version, classified_at
  FROM category_map)"""

CLASSIFIED = f"""
new_entries AS (
  SELECT setting_name, list_extract({LABEL_LIST}, 1 + length(setting_name || ': ' || descr) % {len(LABELS)}) AS category,
    {VERSION} AS labels_version, TIMESTAMP '2024-02-01' AS classified_at
  FROM best WHERE setting_name NOT IN (SELECT setting_name FROM known_map WHERE labels_version = {VERSION})),
updated_map AS (SELECT * FROM known_map UNION ALL SELECT * FROM new_entries),
categorized AS (
  SELECT newest.* REPLACE (m.category AS category) FROM newest
  LEFT JOIN updated_map m ON m.setting_name = newest.setting_name AND m.labels_version = {VERSION})"""

REPLACED = """
replacements AS (
  SELECT setting_name, 'reviewed' AS category, 'v_new' AS labels_version, TIMESTAMP '2024-02-01' AS classified_at
  FROM best)"""

ENABLED = f"""
enabled AS (
  SELECT setting_name, coalesce(workspace_id, 0) AS workspace, collected_at AS last_run,
    setting_value AS current_value, before AS previous_value
  FROM (SELECT *, lag(setting_value) OVER series AS before, lead(collected_at) OVER series AS later
        FROM history WHERE {PREVIEW}
        WINDOW series AS (PARTITION BY setting_name, coalesce(workspace_id, 0) ORDER BY collected_at))
  WHERE later IS NULL AND lower(setting_value) IN {ON} AND NOT coalesce(lower(before) IN {ON}, false))"""

_HISTORY = (HISTORY,)
_LATEST = (HISTORY, CATEGORY_MAP, NEWEST, CURRENT_CATEGORY, LATEST)
_CURRENT = (*_LATEST, CURRENT)
_PREVIEWS = (*_LATEST, PREVIEWS)
_CONSISTENCY = (*_LATEST, CONSISTENCY)
_DRIFT = (HISTORY, CATEGORY_MAP, CURRENT_CATEGORY, DRIFT)
_SNAPSHOT = (PAYLOADS, SNAPSHOT)
_CLASSIFY = (HISTORY, CATEGORY_MAP, NEWEST, BEST, KNOWN_MAP, CLASSIFIED)


def _sql(tables: tuple[str, ...], select: str) -> str:
    return "WITH " + ",".join(tables) + "\n" + select


def statements() -> dict[str, str]:
    return {
        # from payloads to stored snapshots
        "normalize_payloads": _sql(_SNAPSHOT, "SELECT event_id, setting_name, setting_value FROM read_values"),
        "snapshot_rows": _sql(_SNAPSHOT, "SELECT * FROM snapshot WHERE scope = 'workspace'"),
        "snapshot_union": _sql(_SNAPSHOT, "SELECT * FROM snapshot"),
        "workspace_filter": _sql(
            _SNAPSHOT, "SELECT * FROM snapshot WHERE scope = 'account' OR workspace_id IN (1, 3)"
        ),
        "append_evolve": _sql(
            _HISTORY,
            """SELECT *, CASE WHEN collected_at = (SELECT max(collected_at) FROM history)
                 THEN CAST(collected_at AS DATE) END AS deprecated_on, CAST(collected_at AS DATE) AS collected_on,
                 epoch_us(collected_at) AS run_key
               FROM history""",
        ),
        "dry_run": _sql(
            _SNAPSHOT,
            """SELECT scope, workspace_name, setting_name, substr(setting_value, 1, 80) AS setting_value,
                 (SELECT count(*) FROM snapshot) AS total_rows,
                 greatest((SELECT count(*) FROM snapshot) - 20, 0) AS more_rows
               FROM snapshot
               ORDER BY snapshot.scope, snapshot.workspace_id NULLS FIRST, snapshot.setting_name, snapshot.setting_value
               LIMIT 20""",
        ),
        # classification
        "best_description": _sql((HISTORY, BEST), "SELECT * FROM best"),
        "classify_incremental": _sql(_CLASSIFY, "SELECT * FROM new_entries"),
        "upsert_map": _sql(
            (HISTORY, CATEGORY_MAP, BEST, REPLACED),
            """SELECT setting_name, labels_version,
                 coalesce(r.category, m.category) AS category, coalesce(r.classified_at, m.classified_at) AS classified_at
               FROM category_map m FULL JOIN replacements r USING (setting_name, labels_version)""",
        ),
        "apply_categories": _sql(_CLASSIFY, "SELECT * FROM categorized"),
        "classification_report": _sql(
            _CLASSIFY, "SELECT count(nullif(category, '')) AS classified, count(*) AS total FROM categorized"
        ),
        "current_category": _sql(
            (CATEGORY_MAP, CURRENT_CATEGORY), "SELECT setting_name, map_category AS category FROM current_category"
        ),
        # state, consistency and drift
        "settings_latest": _sql(_LATEST, "SELECT * FROM latest"),
        "consistency": _sql(_CONSISTENCY, "SELECT * FROM consistency"),
        "drift": _sql(_DRIFT, "SELECT * FROM drift"),
        "drift_sparse_history": _sql(
            (PARTS_HISTORY, drift_steps("parts_history", "CAST(NULL AS VARCHAR)")),
            """SELECT CAST(t AS DATE) AS change_date, s AS setting_name, CAST(NULL AS VARCHAR) AS workspace_name,
                 CAST(NULL AS VARCHAR) AS category, change_type, pv AS previous_value, v AS new_value, t AS detected_at
               FROM judged WHERE change_type IS NOT NULL""",
        ),
        "latest_drift": _sql(
            _DRIFT, "SELECT * FROM drift WHERE detected_at = (SELECT max(collected_at) FROM history)"
        ),
        # the same over a stored history
        "stored_latest": _sql(_LATEST, "SELECT *, CAST(collected_at AS DATE) AS collected_on, epoch_us(collected_at) AS run_key FROM latest"),
        "stored_consistency": _sql(_CONSISTENCY, "SELECT * FROM consistency"),
        "stored_drift": _sql(_DRIFT, "SELECT * FROM drift"),
        "stored_alert_drift": _sql(
            _DRIFT,
            """SELECT count(*) AS drift_count, count(*) > 0 AS triggered
               FROM drift WHERE detected_at = (SELECT max(collected_at) FROM history)""",
        ),
        "stored_new_previews": _sql((HISTORY, ENABLED), "SELECT * FROM enabled"),
        "stored_collection_history": _sql(
            _HISTORY,
            """SELECT collected_at, count(*) AS settings_count, count(DISTINCT workspace_id) AS workspaces
               FROM history GROUP BY collected_at ORDER BY collected_at DESC LIMIT 10""",
        ),
        # alerts
        "alert_drift": _sql(
            _DRIFT,
            """SELECT count(*) AS drift_count, count(*) > 0 AS triggered
               FROM drift WHERE detected_at = (SELECT max(collected_at) FROM history)""",
        ),
        "alert_drift_lines": _sql(
            _DRIFT,
            """SELECT setting_name, workspace_name, change_type, previous_value, new_value,
                 format('{} [{}]: {} ({} -> {})', setting_name, coalesce(workspace_name, '-'), change_type,
                   coalesce(previous_value, '(none)'), coalesce(new_value, '(none)')) AS line,
                 row_number() OVER (ORDER BY setting_name NULLS FIRST, workspace_name NULLS FIRST,
                   change_type, previous_value NULLS FIRST, new_value NULLS FIRST) AS number
               FROM drift WHERE detected_at = (SELECT max(collected_at) FROM history)""",
        ),
        "alert_new_preview": _sql(
            (HISTORY, ENABLED), "SELECT count(*) AS new_previews, count(*) > 0 AS triggered FROM enabled"
        ),
        "alert_new_preview_lines": _sql(
            (HISTORY, ENABLED),
            """SELECT *, format('{} [ws {}]: {} -> {}', setting_name, workspace, coalesce(previous_value, '(new)'),
                 current_value) AS line,
                 row_number() OVER (ORDER BY setting_name NULLS FIRST, workspace) AS number FROM enabled""",
        ),
        # datasets
        "current_ds": _sql(_CURRENT, "SELECT * FROM current_ds"),
        "preview_ds": _sql(_PREVIEWS, "SELECT * FROM preview_ds"),
        "drift_newest_first": _sql(_DRIFT, "SELECT * FROM drift ORDER BY detected_at DESC"),
        "consistency_sorted": _sql(
            _CONSISTENCY, "SELECT * FROM consistency ORDER BY consistency_status, distinct_values DESC"
        ),
        "collection_history": _sql(
            _HISTORY,
            """SELECT collected_at, count(*) AS settings_count, count(DISTINCT workspace_id) AS workspaces
               FROM history GROUP BY collected_at ORDER BY collected_at DESC LIMIT 10""",
        ),
        # widgets
        "count_settings": _sql(_CURRENT, "SELECT count(DISTINCT setting_name) AS total_settings FROM current_ds"),
        "count_workspaces": _sql(
            _CURRENT,
            "SELECT count(DISTINCT workspace_id) FILTER (scope = 'workspace') AS workspace_count FROM current_ds",
        ),
        "count_previews": _sql(
            _CURRENT, "SELECT count(DISTINCT setting_name) FILTER (is_preview) AS preview_count FROM current_ds"
        ),
        "by_category": _sql(
            _CURRENT, "SELECT category, count(DISTINCT setting_name) AS setting_count FROM current_ds GROUP BY category"
        ),
        "by_scope": _sql(_CURRENT, "SELECT scope, count(setting_name) AS setting_count FROM current_ds GROUP BY scope"),
        "preview_by_status": _sql(
            _PREVIEWS, "SELECT status, count(setting_name) AS feature_count FROM preview_ds GROUP BY status"
        ),
        "preview_by_phase": _sql(
            _PREVIEWS, "SELECT preview_phase, count(setting_name) AS feature_count FROM preview_ds GROUP BY preview_phase"
        ),
        "preview_table": _sql(
            _PREVIEWS, "SELECT setting_name, preview_phase, workspace_name, status, description FROM preview_ds"
        ),
        "drift_per_day": _sql(
            _DRIFT, "SELECT change_date, count(setting_name) AS changes FROM drift GROUP BY change_date"
        ),
        "drift_details": _sql(
            _DRIFT,
            """SELECT change_date, setting_name, change_type, workspace_name, category, previous_value, new_value,
                 detected_at FROM drift""",
        ),
        "consistency_table": _sql(
            _CONSISTENCY,
            """SELECT setting_name, category, consistency_status, distinct_values, workspace_count, sample_value
               FROM consistency""",
        ),
        "collection_history_table": _sql(
            _HISTORY,
            """SELECT collected_at, count(*) AS settings_count, count(DISTINCT workspace_id) AS workspaces
               FROM history GROUP BY collected_at ORDER BY collected_at DESC LIMIT 10""",
        ),
        # filters
        "filter_workspace": _sql(_CURRENT, "SELECT * FROM current_ds WHERE workspace_name = 'ws-2'"),
        "filter_workspace_drift": _sql(_DRIFT, "SELECT * FROM drift WHERE workspace_name = 'ws-2'"),
        "filter_category": _sql(
            _PREVIEWS, "SELECT * FROM preview_ds WHERE category IN ('ingestion', 'platform')"
        ),
        "filter_category_consistency": _sql(
            _CONSISTENCY, "SELECT * FROM consistency WHERE category IN ('ingestion', 'platform')"
        ),
        "filter_values": _sql(
            _CURRENT,
            """SELECT workspace_name, count(*) FILTER (category IN ('ingestion', 'platform')) AS selectable_rows
               FROM current_ds GROUP BY workspace_name""",
        ),
        "filter_workspace_previews": _sql(_PREVIEWS, "SELECT * FROM preview_ds WHERE workspace_name = 'ws-2'"),
        "filter_category_current": _sql(
            _CURRENT, "SELECT * FROM current_ds WHERE category IN ('ingestion', 'platform')"
        ),
        "filter_category_drift": _sql(_DRIFT, "SELECT * FROM drift WHERE category IN ('ingestion', 'platform')"),
        "filter_values_drift": _sql(
            _DRIFT,
            """SELECT category, count(*) FILTER (workspace_name = 'ws-2') AS selectable_rows
               FROM drift GROUP BY category""",
        ),
        "filter_values_consistency": _sql(
            _CONSISTENCY, "SELECT category, count(*) AS selectable_rows FROM consistency GROUP BY category"
        ),
        "filter_values_previews": _sql(
            _PREVIEWS,
            """SELECT workspace_name, count(*) FILTER (category IN ('ingestion', 'platform')) AS selectable_rows
               FROM preview_ds GROUP BY workspace_name""",
        ),
        "filter_values_page": _sql(
            _CURRENT,
            """SELECT 'workspace_name' AS filter, workspace_name AS value,
                 count(*) FILTER (category IN ('ingestion', 'platform')) AS selectable_rows
               FROM current_ds GROUP BY workspace_name
               UNION ALL
               SELECT 'category', category, count(*) FILTER (workspace_name = 'ws-2') FROM current_ds GROUP BY category""",
        ),
        "cross_filter": _sql(
            _CURRENT,
            """SELECT scope, count(setting_name) AS setting_count FROM current_ds
               WHERE workspace_name = 'ws-2' AND category = 'ingestion' GROUP BY scope""",
        ),
    }
