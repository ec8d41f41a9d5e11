"""DuckDB SQL of the sample histories, as common table expressions."""

HISTORY = """
ranked_events AS (
  SELECT *, CAST(ts AS DATE) AS d, CAST(floor(user_id / 5) AS INT) AS n, user_id % 5 AS w,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS rn
  FROM events),
history AS (
  SELECT CAST(d AS TIMESTAMP) AS collected_at, 'acct-1' AS account_id,
    CASE WHEN w = 0 THEN 'account' ELSE 'workspace' END AS scope,
    CASE WHEN w = 0 THEN NULL ELSE w END AS workspace_id,
    CASE WHEN w = 0 THEN NULL ELSE concat('ws-', CAST(w AS VARCHAR)) END AS workspace_name,
    concat('setting_', CAST(n AS VARCHAR)) AS setting_name,
    CASE event_type WHEN 'click' THEN 'True' WHEN 'view' THEN 'disabled' WHEN 'purchase' THEN 'on'
      WHEN 'signup' THEN CASE WHEN value < 3 THEN NULL ELSE 'custom' END
      ELSE CASE WHEN value < 4 THEN '<unavailable>' WHEN value < 8 THEN '<not-set>' ELSE '<null>' END
    END AS setting_value,
    'StringSetting' AS setting_type, 'synthetic' AS source,
    CASE WHEN n % 20 = 9 THEN 'platform' ELSE NULL END AS category,
    CASE n % 7 WHEN 1 THEN 'GA' WHEN 2 THEN 'PreviewPhase.GA' WHEN 3 THEN 'BETA' WHEN 4 THEN 'PUBLIC_PREVIEW'
      WHEN 5 THEN 'PRIVATE_PREVIEW' WHEN 6 THEN 'None' ELSE NULL END AS preview_phase,
    concat('about setting ', CAST(n AS VARCHAR)) AS description
  FROM ranked_events WHERE rn = 1)"""

CATEGORY_MAP = """
setting_numbers AS (SELECT DISTINCT CAST(floor(user_id / 5) AS INT) AS i FROM events),
label_sets AS (
  SELECT 'v_old' AS lv, 0 AS shift, DATE '2024-01-01' AS d
  UNION ALL SELECT 'v_new', 1, DATE '2024-01-15'),
category_map AS (
  SELECT concat('setting_', CAST(i AS VARCHAR)) AS setting_name,
    CASE (i + shift) % 4 WHEN 0 THEN 'governance' WHEN 1 THEN 'ingestion' WHEN 2 THEN 'compute' ELSE 'other' END AS category,
    lv AS labels_version, CAST(d AS TIMESTAMP) AS classified_at
  FROM setting_numbers CROSS JOIN label_sets WHERE i % 10 <> 9 AND (lv = 'v_old' OR i % 2 = 0))"""

PAYLOADS = """
payloads AS (
  SELECT event_id, user_id, concat('setting_', CAST(user_id AS VARCHAR)) AS setting_name,
    CASE WHEN event_id % 30 = 3 THEN concat('{"name":"s","string_val":"old","string_val":"', event_type, '"}')
      WHEN event_id % 30 = 9 THEN concat('{"name":"s","string_val":{"value":"old","value":"', event_type, '"}}')
      WHEN event_id % 30 = 15
        THEN concat('{"name":"s","value":', ['1.0', '1e20', '-0.0', '1.50', '0.000015'][event_id // 30 % 5 + 1], '}')
    ELSE CASE event_id % 6
      WHEN 0 THEN concat('{"name":"s","effective_boolean_val":{"value":', CASE WHEN value < 5 THEN 'true' ELSE 'false' END, '}}')
      WHEN 1 THEN concat('{"name":"s","effective_string_val":{"value":"', event_type, '"}}')
      WHEN 2 THEN concat('{"name":"s","effective_integer_val":{"value":', CAST(user_id AS VARCHAR), '}}')
      WHEN 3 THEN concat('{"name":"s","string_val":{"value":"', event_type, '"}}')
      WHEN 4 THEN '{"name":"s"}' ELSE NULL END END AS payload,
    event_id % 12 = 5 AS read_failed
  FROM events)"""

PARTS_HISTORY = """
parts_history AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS collected_at, l_partkey % 5 AS workspace_id,
    concat('part_', CAST(l_partkey AS VARCHAR)) AS setting_name,
    max(concat(l_returnflag, l_linestatus)) AS setting_value
  FROM lineitem GROUP BY 1, 2, 3)"""
