"""Folders of stored tables: reading what may not be there yet, listing and deleting."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The Parquet files at ``path``, which may be a pattern; empty if there are none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def folder(spark: SparkSession, path: str):
    """The path and its file system, as the session's file system API has them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder; nothing if it isn't there."""
    place, files = folder(spark, path)
    return sorted(status.getPath().getName() for status in files.listStatus(place)) if files.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made, with all in it."""
    place, files = folder(spark, path)
    files.delete(place, True)
