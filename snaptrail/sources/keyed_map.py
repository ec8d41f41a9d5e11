"""The category map as a stored table that is updated by key: touched buckets are rewritten, others stay.

Below one folder:

* ``entries``: the rows, a folder per update and in it one per bucket of setting names.
* ``commits``: one row per update and bucket, with the versions of the bucket that it replaces.

An update merges its rows with the present versions of their buckets, writes the result beside them, and then
appends all its commits as one file. Readers see all of that or nothing. Two writers that start from the same
version of a bucket leave two versions of it; readers take the newest entry of each key from both, so neither
loses a row, and the next update of the bucket makes one of them again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from snaptrail.layout import CATEGORY_MAP_SCHEMA
from snaptrail.sources.files import delete, names, read_or_empty

# Buckets of a new map. Of one that is stored, its own number counts.
BUCKETS = 64

_COMMITS = "bucket INT, buckets INT, version STRING, replaces ARRAY<STRING>"
_KEYS = ("setting_name", "labels_version")


@dataclass(frozen=True)
class KeyedMap:
    """A category map in a folder of Parquet files, with one row per setting and label set."""

    path: str
    buckets: int = BUCKETS

    def read(self, spark: SparkSession) -> DataFrame:
        """The present rows; empty if none are stored."""
        return self._read(spark, self._present(spark))

    def update(self, updates: DataFrame) -> None:
        """Put ``updates`` in place of the rows with their keys, or add them.

        Of rows with equal keys the one classified last stays, whichever side it is on. ``updates`` is computed
        once. An update that fails before its commits leaves the map as it was.
        """
        spark, version = updates.sparkSession, str(uuid.uuid4())
        present = self._present(spark)
        buckets = present[0].buckets if present else self.buckets
        bucket = F.pmod(F.xxhash64("setting_name"), F.lit(buckets)).cast("int")
        staged_path = f"{self.path}/staged/{version}"
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in self._schema(spark)]
        staged = updates.select(*columns).withColumn("bucket", bucket)
        try:
            staged.write.parquet(staged_path)
            staged = spark.read.schema(staged.schema).parquet(staged_path)
            # At most as many rows as there are buckets.
            touched = {row.bucket for row in staged.select("bucket").distinct().collect()}
            replaced = [row for row in present if row.bucket in touched]
            old = self._read(spark, replaced).withColumn("bucket", bucket)
            merged = newest_entries(old.unionByName(staged))
            merged.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/entries/{version}")
            commits = [(b, buckets, version, [r.version for r in replaced if r.bucket == b]) for b in sorted(touched)]
            if commits:
                spark.createDataFrame(commits, _COMMITS).coalesce(1).write.mode("append").parquet(f"{self.path}/commits")
        finally:
            delete(spark, staged_path)

    def remove_replaced(self, spark: SparkSession) -> None:
        """Delete versions that no reader needs: call it when none that started before the last update runs."""
        needed = {(row.version, f"bucket={row.bucket}") for row in self._present(spark)}
        for version in names(spark, f"{self.path}/entries"):
            for bucket in names(spark, f"{self.path}/entries/{version}"):
                if bucket.startswith("bucket=") and (version, bucket) not in needed:
                    delete(spark, f"{self.path}/entries/{version}/{bucket}")

    def _present(self, spark: SparkSession) -> list[Row]:
        """The version of each bucket, or the versions of concurrent writers: few rows per bucket."""
        commits = read_or_empty(spark, f"{self.path}/commits", _COMMITS)
        replaced = commits.select("bucket", F.explode("replaces").alias("version"))
        present = commits.join(replaced, ["bucket", "version"], "left_anti")
        return present.select("bucket", "buckets", "version").orderBy("bucket", "version").collect()

    def _read(self, spark: SparkSession, versions: list[Row]) -> DataFrame:
        if not versions:
            return spark.createDataFrame([], CATEGORY_MAP_SCHEMA)
        folders = [f"{self.path}/entries/{row.version}/bucket={row.bucket}" for row in versions]
        rows = spark.read.schema(CATEGORY_MAP_SCHEMA).parquet(*folders)
        # Within a version keys are unique.
        return rows if len({row.bucket for row in versions}) == len(versions) else newest_entries(rows)

    def _schema(self, spark: SparkSession):
        return spark.createDataFrame([], CATEGORY_MAP_SCHEMA).schema


def newest_entries(stored: DataFrame) -> DataFrame:
    """For each setting and label set, the category-map row classified last."""
    newest = Window.partitionBy(*_KEYS).orderBy(
        F.desc_nulls_last("classified_at"), F.asc_nulls_last("category")
    )
    return stored.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")
