"""Sample histories derived from the generated tables, for the registered queries and the bench."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Columns of the generated tables that are read here. Given to the reader, so that
# no job has to look into the files for them.
EVENTS_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"
LINEITEM_SCHEMA = "l_partkey BIGINT, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"


def settings_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All history columns: each user's last event of a day is one setting observation.

    Five users share a setting name; the first of them is the account, the others workspaces 1-4.
    """
    return spark.sql(
        """
        WITH last_of_day AS (
          SELECT user_id, to_date(ts) AS day, max(struct(event_id, event_type, value)) AS last
          FROM {events} GROUP BY user_id, to_date(ts)),
        observed AS (
          SELECT day, last.event_type AS kind, last.value AS value,
            CAST(floor(user_id / 5) AS INT) AS n, nullif(user_id % 5, 0) AS w
          FROM last_of_day)
        SELECT CAST(day AS TIMESTAMP_NTZ) AS collected_at, 'acct-1' AS account_id,
          if(w IS NULL, 'account', 'workspace') AS scope, w AS workspace_id,
          concat('ws-', CAST(w AS STRING)) AS workspace_name, concat('setting_', CAST(n AS STRING)) AS setting_name,
          CASE WHEN kind = 'click' THEN 'True' WHEN kind = 'view' THEN 'disabled' WHEN kind = 'purchase' THEN 'on'
               WHEN kind = 'signup' THEN if(value >= 3, 'custom', NULL)
               WHEN value < 4 THEN '<unavailable>' WHEN value < 8 THEN '<not-set>' ELSE '<null>' END AS setting_value,
          'StringSetting' AS setting_type, 'synthetic' AS source,
          if(n % 20 = 9, 'platform', NULL) AS category,
          get(array(NULL, 'GA', 'PreviewPhase.GA', 'BETA', 'PUBLIC_PREVIEW', 'PRIVATE_PREVIEW', 'None'), n % 7)
            AS preview_phase,
          concat('about setting ', CAST(n AS STRING)) AS description
        FROM observed
        """,
        events=_events(spark, sf_dir),
    )


def category_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two label sets; the newer one covers even settings only, and some settings have no entry."""
    return spark.sql(
        """
        WITH numbers AS (SELECT DISTINCT CAST(floor(user_id / 5) AS INT) AS i FROM {events}),
        entries AS (
          SELECT i, inline(array(struct('v_old' AS version, 0 AS shift, '2024-01-01' AS day),
                                 struct('v_new' AS version, 1 AS shift, '2024-01-15' AS day)))
          FROM numbers)
        SELECT concat('setting_', CAST(i AS STRING)) AS setting_name,
          get(array('governance', 'ingestion', 'compute', 'other'), (i + shift) % 4) AS category,
          version AS labels_version, CAST(day AS TIMESTAMP_NTZ) AS classified_at
        FROM entries WHERE i % 10 <> 9 AND (version = 'v_old' OR i % 2 = 0)
        """,
        events=_events(spark, sf_dir),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw JSON setting payload per event, in nine forms; some NULL, some failed to be read.

    Three of the forms, a member that repeats, one that repeats inside another and a number that is not
    whole, take the place of every fifth text each.
    """
    return spark.sql(
        """
        SELECT event_id, concat('setting_', CAST(user_id AS STRING)) AS setting_name,
          CASE WHEN event_id % 30 = 3 THEN concat('{{"name":"s","string_val":"old","string_val":"', event_type, '"}}')
            WHEN event_id % 30 = 9
              THEN concat('{{"name":"s","string_val":{{"value":"old","value":"', event_type, '"}}}}')
            WHEN event_id % 30 = 15 THEN concat('{{"name":"s","value":',
              element_at(array('1.0', '1e20', '-0.0', '1.50', '0.000015'), CAST(event_id / 30 AS INT) % 5 + 1), '}}')
          ELSE CASE event_id % 6
            WHEN 0 THEN concat('{{"name":"s","effective_boolean_val":{{"value":', CAST(value < 5 AS STRING), '}}}}')
            WHEN 1 THEN concat('{{"name":"s","effective_string_val":{{"value":"', event_type, '"}}}}')
            WHEN 2 THEN concat('{{"name":"s","effective_integer_val":{{"value":', CAST(user_id AS STRING), '}}}}')
            WHEN 3 THEN concat('{{"name":"s","string_val":{{"value":"', event_type, '"}}}}')
            WHEN 4 THEN '{{"name":"s"}}' END END AS payload,
          event_id % 12 = 5 AS read_failed, user_id
        FROM {events}
        """,
        events=_events(spark, sf_dir),
    )


def parts_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A large sparse history: monthly runs, a series per part, few of which ship in a given month."""
    return spark.sql(
        """
        SELECT CAST(trunc(l_shipdate, 'MM') AS TIMESTAMP_NTZ) AS collected_at, l_partkey % 5 AS workspace_id,
          concat('part_', CAST(l_partkey AS STRING)) AS setting_name,
          max(concat(l_returnflag, l_linestatus)) AS setting_value
        FROM {lineitem} GROUP BY trunc(l_shipdate, 'MM'), l_partkey
        """,
        lineitem=spark.read.schema(LINEITEM_SCHEMA).parquet(f"{sf_dir}/lineitem.parquet"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
