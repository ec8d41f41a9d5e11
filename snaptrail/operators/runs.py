"""The time line of a history: its newest run, and each run's neighbour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptrail.layout import Layout
from snaptrail.operators.lookup import BROADCAST_BYTES, cut_lineage, lookup, size_in_bytes

# Up to this many bytes of distinct runs are ordered in one task (about 500,000 runs).
SMALL_TIMELINE_BYTES = 12 * 1024 * 1024


def latest_run(history: DataFrame, layout: Layout = Layout()) -> Column:
    """The newest run of the whole history: a literal where runs are known, else a scalar subquery."""
    if layout.known_runs is not None:
        return layout.known_runs.run(0)
    return recent(history, 1, layout).agg(F.max(layout.run)).scalar()


def previous_run(history: DataFrame, layout: Layout = Layout()) -> Column:
    """The newest run before the latest one, in the same form; NULL when there is none."""
    if layout.known_runs is not None:
        return layout.known_runs.run(1)
    earlier = recent(history, 2, layout).where(F.col(layout.run) < latest_run(history, layout))
    return earlier.agg(F.max(layout.run)).scalar()


def latest_rows(history: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """Rows of the newest run.

    The subquery's result is known before the scan starts, so it reaches the file scan as a
    pushed filter, and with a run partition it also selects the directories to open.
    """
    return recent(history, 1, layout).where(F.col(layout.run) == latest_run(history, layout))


def rows_since(history: DataFrame, first: Column, within: int, layout: Layout = Layout()) -> DataFrame:
    """Rows of the run ``first`` and later, where ``first`` is one of the ``within`` newest runs."""
    return recent(history, within, layout).where(F.col(layout.run) >= first)


def newest_runs(history: DataFrame, count: int, layout: Layout = Layout()) -> DataFrame:
    """The ``count`` newest distinct runs, in one column."""
    if layout.known_runs is not None:
        return _newest(layout.known_runs.table, layout.run, count)
    return _newest(recent(history, count, layout), layout.run, count)


def recent(history: DataFrame, count: int, layout: Layout = Layout()) -> DataFrame:
    """A part of the history that holds its ``count`` newest runs.

    Every partition holds a run, so the newest ``count`` partitions are enough. Without a run
    partition this is the whole history.
    """
    if layout.run_partition is None:
        return history
    known = layout.known_runs
    if known is not None and known.newest and (known.all_of_them or count <= len(known.newest)):
        return history.where(F.col(layout.run_partition) >= known.newest[: max(count, 1)][-1][1])
    times = history if known is None else known.table
    oldest_needed = _newest(times, layout.run_partition, count).agg(F.min(layout.run_partition)).scalar()
    return history.where(F.col(layout.run_partition) >= oldest_needed)


def _newest(rows: DataFrame, column: str, count: int) -> DataFrame:
    return rows.select(column).distinct().orderBy(F.desc(column)).limit(count)


def with_neighbours(
    rows: DataFrame,
    runs: DataFrame,
    run: str = "collected_at",
    small_bytes: int = SMALL_TIMELINE_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows with ``next_run`` (NULL in the last run) and ``is_first`` (true in the first run).

    ``runs`` has the run times, repeated or not. The usual few thousand runs are ordered in one
    task and broadcast; their measured size decides, and any number of runs works.
    """
    distinct = runs.select(run).distinct()
    if size_in_bytes(distinct) <= small_bytes:
        links = _chained(distinct, run, Window.orderBy(run))
        return rows.join(F.broadcast(links), run, "left")
    return lookup(rows, _ranged_timeline(distinct, run), run, broadcast_bytes)


def _chained(runs: DataFrame, run: str, window) -> DataFrame:
    return runs.withColumns(
        {
            "next_run": F.lead(run).over(window),
            "is_first": F.row_number().over(window) == 1,
        }
    )


def _ranged_timeline(runs: DataFrame, run: str) -> DataFrame:
    """The same for any number of runs: chain inside range slices, then link slice to slice."""
    slices = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = runs.repartitionByRange(slices, run).withColumn("_slice", F.spark_partition_id())
    # Later steps read the slice numbers more than once, so they must be stored, not recomputed.
    ranged = cut_lineage(ranged)

    heads = ranged.groupBy("_slice").agg(F.min(run).alias("_head"))  # one row per slice
    by_slice = Window.orderBy("_slice")
    links = heads.select(
        "_slice",
        F.lead("_head").over(by_slice).alias("_next_head"),
        (F.row_number().over(by_slice) == 1).alias("_first_slice"),
    )
    inside = _chained(ranged, run, Window.partitionBy("_slice").orderBy(run))
    return inside.join(F.broadcast(links), "_slice").select(
        run,
        F.coalesce("next_run", "_next_head").alias("next_run"),
        (F.col("is_first") & F.col("_first_slice")).alias("is_first"),
    )
