"""Joins against side tables whose size is checked before they are broadcast."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Side tables up to this many bytes are sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

# A key is heavy when it holds more than 1/HEAVY_SHARE of all rows, so there are fewer heavy
# keys than HEAVY_SHARE whatever the data looks like.
HEAVY_SHARE = 1000

_CELL_OVERHEAD_BYTES = 16


def size_in_bytes(df: DataFrame) -> int:
    """Measured size of a table: text length plus a fixed overhead for every cell (an action)."""
    cells = [f"coalesce(octet_length(CAST(`{c}` AS STRING)), 0)" for c in df.columns]
    row = " + ".join([*cells, str(_CELL_OVERHEAD_BYTES * len(cells))])
    return df.agg(F.expr(f"sum({row})")).first()[0] or 0


def lookup(
    rows: DataFrame,
    side: DataFrame,
    on: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    bound: DataFrame | None = None,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Left join ``rows`` to ``side``, which has one row per ``on``.

    A side table within ``broadcast_bytes`` is broadcast. A larger one is joined by a shuffle that
    no hot key can unbalance: rows of heavy keys never enter the shuffle, because the side rows of
    those few keys are broadcast to them instead. Where ``rows`` already comes out of a shuffle,
    both parts read the same one.

    Cheaper stand-ins may be given: ``bound``, a table at least as large as ``side``, to measure,
    and ``keys``, a table whose key counts are in proportion to those of ``rows``, to count.
    """
    if size_in_bytes(side if bound is None else bound) <= broadcast_bytes:
        return rows.join(F.broadcast(side), on, "left")
    heavy = F.broadcast(heavy_keys(rows if keys is None else keys, on))
    heavy_side = F.broadcast(side.join(heavy, on, "left_semi"))
    # Without this filter on both parts, only one of them would get it from the optimizer, and
    # they would no longer share what lies below them.
    keyed = rows.where(F.col(on).isNotNull())
    heavy_rows = keyed.join(heavy, on, "left_semi").join(heavy_side, on, "left")
    other_rows = keyed.join(heavy, on, "left_anti").join(side, on, "left")
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in side.schema if f.name != on}
    keyless = rows.where(F.col(on).isNull()).withColumns(nothing)
    return heavy_rows.unionByName(other_rows).unionByName(keyless)


def heavy_keys(rows: DataFrame, key: str) -> DataFrame:
    """The non-NULL keys that hold more than their share of the rows; below HEAVY_SHARE of them."""
    counts = rows.groupBy(key).agg(F.count("*").alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    is_heavy = F.col(key).isNotNull() & (F.col("_rows") * HEAVY_SHARE > total)
    return counts.where(is_heavy).select(key)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read on from there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="snaptrail-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder
