"""Stored tables: the snapshot history and the category map, as Parquet paths or catalog tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrail.functions.values import utc_date
from snaptrail.layout import CATEGORY_MAP_SCHEMA, HISTORY_SCHEMA, Layout
from snaptrail.operators.lookup import shared_folder
from snaptrail.sources.catalog_views import recreate_views
from snaptrail.sources.keyed_map import newest_entries

# The history is partitioned by the UTC date of the run.
RUN_DATE = "collected_on"
STORED_HISTORY = Layout(run_partition=RUN_DATE)

FAILURES = ("setting_name", "labels_version", "classified_at", "error")
FAILURES_SCHEMA = "setting_name STRING, labels_version STRING, classified_at TIMESTAMP, error STRING"

_NOTHING_STORED = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def append_snapshot(rows: DataFrame, path: str) -> None:
    """Append one or more runs to the Parquet history at ``path``; new columns are kept."""
    _stamped(rows).write.mode("append").partitionBy(RUN_DATE).parquet(path)


def read_history(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The history at ``path`` with the union of all columns ever written; empty if none is stored.

    The union is found by reading all file footers; giving ``schema`` saves that.
    """
    return _read(spark, path, schema, f"{HISTORY_SCHEMA}, {RUN_DATE} DATE")


def append_snapshot_to_table(rows: DataFrame, table: str) -> None:
    """Append runs to a catalog table, adding the columns it lacks, to the lasting views over it, too.

    The catalog keeps the schema, so readers of any number of files open no footers to find it.
    """
    create_history_table(rows.sparkSession, table)
    _append_to_table(_stamped(rows), table)


def create_history_table(spark: SparkSession, table: str) -> None:
    """Create an empty history table in the catalog unless it is there."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({HISTORY_SCHEMA}, {RUN_DATE} DATE) "
        f"USING parquet PARTITIONED BY ({RUN_DATE})"
    )


def create_category_table(spark: SparkSession, table: str) -> None:
    """Create an empty category-map table in the catalog unless it is there."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({CATEGORY_MAP_SCHEMA}) USING parquet")


def append_categories(updates: DataFrame, path: str) -> None:
    """Add category-map rows. The map is only ever appended to; readers take the newest of each."""
    updates.write.mode("append").parquet(path)


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    """The category map stored at ``path``; empty if none is stored."""
    return newest_entries(_read(spark, path, CATEGORY_MAP_SCHEMA, CATEGORY_MAP_SCHEMA))


@dataclass(frozen=True)
class CatalogStore:
    """History and category map as two catalog tables, created when first used."""

    history_table: str
    map_table: str

    def append_history(self, rows: DataFrame) -> None:
        append_snapshot_to_table(rows, self.history_table)

    def history(self, spark: SparkSession) -> DataFrame:
        create_history_table(spark, self.history_table)
        return spark.table(self.history_table)

    def layout(self, spark: SparkSession) -> Layout:
        return STORED_HISTORY

    def append_categories(self, updates: DataFrame) -> None:
        create_category_table(updates.sparkSession, self.map_table)
        _append_to_table(updates, self.map_table)

    def categories(self, spark: SparkSession) -> DataFrame:
        create_category_table(spark, self.map_table)
        return newest_entries(spark.table(self.map_table))

    def staging(self, spark: SparkSession) -> str:
        """The shared folder for results of classification that are on their way to the map."""
        return f"{shared_folder(spark)}/classification-{self.map_table}"

    def append_failures(self, failed: DataFrame) -> None:
        self._create_failures(failed.sparkSession)
        _append_to_table(failed.select(*FAILURES), f"{self.map_table}_failures")

    def failures(self, spark: SparkSession) -> DataFrame:
        """Every failed try to classify a setting: setting_name, labels_version, classified_at, error."""
        self._create_failures(spark)
        return spark.table(f"{self.map_table}_failures")

    def _create_failures(self, spark: SparkSession) -> None:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.map_table}_failures ({FAILURES_SCHEMA}) USING parquet")


def _append_to_table(rows: DataFrame, table: str) -> None:
    spark = rows.sparkSession
    stored = spark.table(table).columns
    added = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name not in stored]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(added)})")
        recreate_views(spark, table)
    aligned = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in spark.table(table).schema
    ]
    rows.select(*aligned).write.insertInto(table)


def _stamped(rows: DataFrame) -> DataFrame:
    """Rows with their run date, spread so that a date gets few files, and none of them huge.

    A rebalance brings a date's rows together and lets adaptive execution cut them into even
    tasks. Without it nothing would cut them, so rows are then written from where they are.
    """
    stamped = rows.withColumn(RUN_DATE, utc_date(rows, "collected_at"))
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return stamped
    return stamped.hint("rebalance", RUN_DATE)


def _read(spark: SparkSession, path: str, schema: str | None, if_empty: str) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read.option("mergeSchema", "true")
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in _NOTHING_STORED:
            raise
        return spark.createDataFrame([], if_empty)
