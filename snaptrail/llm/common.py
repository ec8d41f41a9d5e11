"""What the operators of this package share: reading, lower-casing, folds, row keys and stored tables.

Operators read the columns they need by name and ignore all others, so that extra columns, whatever
their names, never clash with those an operator adds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snaptrail.operators.lookup import cut_lineage, shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that operators on texts need, as ``doc_id`` and ``text``; null texts are empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII takes the fast path, where both functions agree."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a document is kept for testing: crc32 of its id as text, modulo ``folds``, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def first_by_hash(rows: DataFrame, by: str, n: int) -> DataFrame:
    """Of each value of ``by`` the ``n`` rows whose doc_id has the smallest hash.

    Rows are ranked in slices of a value first, so that the last step, in one task per value, gets at most
    ``n`` rows of each slice however many rows the value has.
    """
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    rows = rows.withColumn("_slice", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(64)))
    for keys in ([by, "_slice"], [by]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        rows = rows.withColumn("_place", place).where(F.col("_place") <= n)
    return rows.drop("_place", "_slice")


def stored(df: DataFrame, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet to the folder that all executors share, and read on from there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4()}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(rows: DataFrame, *keys: str) -> DataFrame:
    """One row of those that agree in ``keys``, none of them null: the smallest by the other columns in order.

    Only rows that repeat are brought together; those that do not are never shuffled unless the keys of
    repeated rows are too many for a broadcast.
    """
    repeated = stored(rows.groupBy(*keys).count().where("count > 1").select(*keys))
    if repeated.isEmpty():
        return rows
    others = [c for c in rows.columns if c not in keys]
    smallest = rows.join(repeated, list(keys), "left_semi").groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row"))
    smallest = smallest.select(*keys, *(F.col("_row")[c].alias(c) for c in others))
    return rows.join(repeated, list(keys), "left_anti").unionByName(smallest)


__all__ = ["cut_lineage", "documents", "first_by_hash", "held_out", "lower_ascii", "once", "shared_folder", "stored", "table"]
