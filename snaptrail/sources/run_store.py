"""A stored history that is kept by run: runs, schema, changes and preview states beside the rows.

Everything lies below one folder:

* ``rows``: the history, a partition per run. Storing a run replaces its partition, so a run that is stored
  again, or after a failure, is there once.
* ``runs``: one small row per stored run, written last. The newest runs and their sizes come from here.
* ``schema``: the union of all columns ever stored, so that no reader looks into files for it.
* ``drift``: the changes of each run against the run before. Storing a run compares it, and the run after it,
  with their neighbours and reads no other run.
* ``previews``: the last two observations of every preview series after a run. Storing a run merges its rows into
  the state before it.

One writer at a time; readers need no lock.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StructField,
    StructType,
    _parse_datatype_string,
)

from snaptrail.functions.values import utc_date
from snaptrail.layout import HISTORY_SCHEMA, KnownRuns, Layout
from snaptrail.operators import alerts
from snaptrail.operators.drift import categorized, drift
from snaptrail.sources import tables
from snaptrail.sources.files import delete, names, read_or_empty
from snaptrail.sources.keyed_map import KeyedMap

# Partitions of the history: the UTC date of the run, and the run in microseconds since 1970.
RUN_DATE = tables.RUN_DATE
RUN_KEY = "run_key"

# Runs whose partitions are known as literals.
LITERAL_RUNS = 10

# States of previews that are kept, to store the newest runs again without reading older ones.
STATES_KEPT = 3

_COUNTS_SCHEMA = f"{RUN_KEY} BIGINT, settings_count BIGINT, workspaces BIGINT"
_RUNS_SCHEMA = f"{_COUNTS_SCHEMA}, stored_at TIMESTAMP"

# Types that a stored column may be widened to, narrowest first.
_WIDER = ((ByteType(), ShortType(), IntegerType(), LongType()), (FloatType(), DoubleType()))


@dataclass(frozen=True)
class PathStore:
    """History by run, and category map, as folders of Parquet files."""

    history_path: str
    map_path: str

    def append_history(self, rows: DataFrame) -> None:
        """Store the runs in ``rows``; each replaces what was stored of it.

        ``rows`` is computed once, into a staged copy; nothing stored is touched before that is complete. A
        failure later on is mended by storing the same runs again.
        """
        spark = rows.sparkSession
        known = self._schema(spark)
        schema = merged_schema(known, _plain(rows.schema))
        staged_path = f"{self.history_path}/staged/{uuid.uuid4()}"
        rows = rows.withColumns({RUN_DATE: utc_date(rows, "collected_at"), RUN_KEY: _key(rows.schema, "collected_at")})
        kept = [F.col(f.name).cast(f.dataType) for f in schema if f.name in rows.columns]
        rows = rows.select(*kept, RUN_DATE, RUN_KEY)
        rows.write.parquet(staged_path)
        staged = spark.read.schema(rows.schema).parquet(staged_path)
        try:
            if known is None or schema != known:
                _append(spark.createDataFrame([(schema.json(),)], "columns STRING"), self._path("schema"))
            counts = self._count(staged).collect()
            if counts:
                _replace(_spread(staged, RUN_KEY), self._path("rows"), RUN_DATE, RUN_KEY)
                times = self._neighbours(spark, [row[RUN_KEY] for row in counts])
                self._store_drift(spark, schema, times)
                self._store_previews(spark, schema, times)
                stored = spark.createDataFrame(counts, _COUNTS_SCHEMA).withColumn("stored_at", F.current_timestamp())
                _append(stored.coalesce(1), self._path("runs"))
        finally:
            delete(spark, staged_path)

    def history(self, spark: SparkSession) -> DataFrame:
        """All stored rows with the union of all columns; empty if none is stored. Opens no file of them."""
        return self._rows(spark, self._schema(spark) or _unwritten())

    def runs(self, spark: SparkSession) -> DataFrame:
        """One row per stored run: collected_at, run_key, settings_count and workspaces."""
        return self._runs(spark, _run_type(self._schema(spark)))

    def layout(self, spark: SparkSession) -> Layout:
        """The layout of the stored history, with its newest runs as literals (two small jobs)."""
        kind = _run_type(self._schema(spark))
        runs = self._runs(spark, kind)
        newest = runs.orderBy(F.desc(RUN_KEY)).limit(LITERAL_RUNS + 1).select(RUN_KEY).collect()
        literals = [(_run(kind, F.lit(row[0])), F.lit(row[0])) for row in newest[:LITERAL_RUNS]]
        known = KnownRuns(runs, tuple(literals), len(newest) <= LITERAL_RUNS, F.lit(None).cast(kind))
        return Layout(run_partition=RUN_KEY, known_runs=known)

    def drift(
        self, spark: SparkSession, category_map: DataFrame | None = None, newest_run_only: bool = False
    ) -> DataFrame:
        """The stored changes, in the form of :func:`snaptrail.operators.drift.drift`."""
        stored = self._derived(spark, "drift", _changes_schema(_run_type(self._schema(spark))))
        if newest_run_only:
            stored = stored.where(F.col(RUN_KEY) == F.lit(self._newest_key(spark)))
        return categorized(stored.where("change_type IS NOT NULL"), category_map)

    def drift_alert(self, spark: SparkSession) -> DataFrame:
        """The same as :func:`snaptrail.operators.alerts.drift_alert`, from the newest run's changes only."""
        return self.drift(spark, newest_run_only=True).agg(F.count("*").alias("drift_count"))

    def newly_enabled_previews(self, spark: SparkSession, only_latest_run: bool = False) -> DataFrame:
        """The same as :func:`snaptrail.operators.alerts.newly_enabled_previews`, from the newest state only."""
        kind, newest = _run_type(self._schema(spark)), self._newest_key(spark)
        found = alerts.just_enabled(self._previews(spark, kind, newest))
        return found.where(F.col("last_run") == _run(kind, F.lit(newest))) if only_latest_run else found

    def append_categories(self, updates: DataFrame) -> None:
        """Update the category map by key; see :class:`snaptrail.sources.keyed_map.KeyedMap`."""
        KeyedMap(self.map_path).update(updates)

    def categories(self, spark: SparkSession) -> DataFrame:
        return KeyedMap(self.map_path).read(spark)

    def staging(self, spark: SparkSession) -> str:
        """The folder for results of classification that are on their way to the map."""
        return f"{self.map_path}/classification"

    def append_failures(self, failed: DataFrame) -> None:
        _append(failed.select(*tables.FAILURES), f"{self.map_path}/failures")

    def failures(self, spark: SparkSession) -> DataFrame:
        """Every failed try to classify a setting: setting_name, labels_version, classified_at, error."""
        return read_or_empty(spark, f"{self.map_path}/failures", tables.FAILURES_SCHEMA)

    def _path(self, part: str) -> str:
        return f"{self.history_path}/{part}"

    def _schema(self, spark: SparkSession) -> StructType | None:
        """All entries of the schema table together; it has one for each time the schema grew."""
        entries = read_or_empty(spark, self._path("schema"), _parse_datatype_string("columns STRING")).collect()
        schemas = [StructType.fromJson(json.loads(row.columns)) for row in entries]
        merged = None
        for schema in sorted(schemas, key=len):
            merged = merged_schema(merged, schema)
        return merged

    def _rows(self, spark: SparkSession, schema: StructType) -> DataFrame:
        partitions = [StructField(RUN_DATE, DateType()), StructField(RUN_KEY, LongType())]
        return read_or_empty(spark, self._path("rows"), StructType([*schema.fields, *partitions]))

    def _runs(self, spark: SparkSession, kind: DataType) -> DataFrame:
        entries = read_or_empty(spark, self._path("runs"), _parse_datatype_string(_RUNS_SCHEMA))
        newest = F.max_by(F.struct("settings_count", "workspaces"), "stored_at")
        by_run = entries.groupBy(RUN_KEY).agg(newest.alias("_last"))
        run = _run(kind, F.col(RUN_KEY)).alias("collected_at")
        return by_run.select(run, RUN_KEY, "_last.settings_count", "_last.workspaces")

    def _newest_key(self, spark: SparkSession) -> int | None:
        runs = read_or_empty(spark, self._path("runs"), _parse_datatype_string(_RUNS_SCHEMA))
        return runs.agg(F.max(RUN_KEY)).first()[0]

    def _count(self, staged: DataFrame) -> DataFrame:
        return staged.groupBy(RUN_KEY).agg(
            F.count("*").alias("settings_count"), F.count_distinct("workspace_id").alias("workspaces")
        )

    def _derived(self, spark: SparkSession, part: str, schema: str) -> DataFrame:
        return read_or_empty(spark, self._path(part), _parse_datatype_string(f"{schema}, {RUN_KEY} BIGINT"))

    def _neighbours(self, spark: SparkSession, keys: list[int]) -> _Neighbours:
        """Of the time line, including runs that are being stored, what touches the runs ``keys``."""
        runs = read_or_empty(spark, self._path("runs"), _parse_datatype_string(_RUNS_SCHEMA)).select(RUN_KEY)
        every = runs.union(spark.createDataFrame([(key,) for key in keys], f"{RUN_KEY} BIGINT")).distinct()
        before, newest = F.lag(RUN_KEY).over(Window.orderBy(RUN_KEY)), F.max(RUN_KEY).over(Window.partitionBy())
        times = every.select(RUN_KEY, before.alias("before"), newest.alias("newest"))
        touched = times.where(F.col(RUN_KEY).isin(keys) | F.col("before").isin(keys)).collect()
        befores = {row[RUN_KEY]: row.before for row in touched}
        return _Neighbours(min(keys), befores, touched[0].newest)

    def _store_drift(self, spark: SparkSession, schema: StructType, times: _Neighbours) -> None:
        """Compare the stored runs and the runs after them with the runs before them."""
        kind, compared = _run_type(schema), sorted(times.before)
        read = sorted({*compared, *(key for key in times.before.values() if key is not None)})
        rows = self._rows(spark, schema).where(F.col(RUN_KEY).isin(read))
        line = spark.createDataFrame([(key,) for key in read], f"{RUN_KEY} BIGINT").select(_run(kind, F.col(RUN_KEY)).alias("collected_at"))
        changes = drift(rows, runs=line).drop("category")
        changes = changes.withColumn(RUN_KEY, _key(changes.schema, "detected_at"))
        # A run that is read as the one before only is compared with a wrong one, or with none.
        changes = changes.where(F.col(RUN_KEY).isin(compared))
        # A row without a change makes sure that the partition of a run without changes is replaced, too.
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in changes.schema if f.name != RUN_KEY]
        empty = spark.createDataFrame([(key,) for key in compared], f"{RUN_KEY} BIGINT").select(*nothing, RUN_KEY)
        _replace(_spread(changes.unionByName(empty), RUN_KEY), self._path("drift"), RUN_KEY)

    def _previews(self, spark: SparkSession, kind: DataType, key: int | None) -> DataFrame:
        observed = f"ARRAY<STRUCT<run: {kind.simpleString()}, observed: STRING>>"
        stored = self._derived(spark, "previews", f"setting_name STRING, workspace BIGINT, observations {observed}")
        return stored.where((F.col(RUN_KEY) == F.lit(key)) & F.col("setting_name").isNotNull()).drop(RUN_KEY)

    def _store_previews(self, spark: SparkSession, schema: StructType, times: _Neighbours) -> None:
        """The state after the newest run: that before the first of the stored runs, and all rows since."""
        before, newest = times.before[times.first], times.newest
        rows = self._rows(spark, schema)
        states = _partitions(spark, self._path("previews"))
        if before in states:
            rows = rows.where(F.col(RUN_KEY) >= times.first)
        observed = alerts.preview_observations(rows).withColumn("workspace", F.col("workspace").cast("long"))
        if before in states:
            state = self._previews(spark, _run_type(schema), before)
            observed = alerts.observations(state).unionByName(observed)
        state = alerts.last_two(observed)
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in state.schema]
        state = state.unionByName(spark.range(1).select(*nothing)).withColumn(RUN_KEY, F.lit(newest).cast("long"))
        _replace(_spread(state, RUN_KEY), self._path("previews"), RUN_KEY)
        # States of older runs that the stored ones follow or replace, and those that nobody needs.
        for old in sorted(key for key in states if key < newest):
            if old >= times.first or old in sorted(states | {newest})[:-STATES_KEPT]:
                delete(spark, f"{self._path('previews')}/{RUN_KEY}={old}")


@dataclass(frozen=True)
class _Neighbours:
    """The first of the runs being stored, the run before each of them and of the runs after them, the newest run."""

    first: int
    before: dict[int, int | None]
    newest: int


def merged_schema(stored: StructType | None, new: StructType) -> StructType:
    """The columns of both, stored ones first. A column of two types gets the wider one, or is refused."""
    if stored is None:
        return new
    types = {f.name: f.dataType for f in stored}
    for field in new:
        types[field.name] = _wider(field.name, types.get(field.name, field.dataType), field.dataType)
    return StructType([StructField(name, kind) for name, kind in types.items()])


def _wider(name: str, one: DataType, other: DataType) -> DataType:
    if one == other:
        return one
    for chain in _WIDER:
        if one in chain and other in chain:
            return max(one, other, key=chain.index)
    raise ValueError(f"column {name} is stored as {one.simpleString()} and can't become {other.simpleString()}")


def _plain(schema: StructType) -> StructType:
    """Without partition columns, as any rows may lack a value later."""
    return StructType([StructField(f.name, f.dataType) for f in schema if f.name not in (RUN_DATE, RUN_KEY)])


def _run_type(schema: StructType | None) -> DataType:
    return (schema or _unwritten())["collected_at"].dataType


def _changes_schema(run_type: DataType) -> str:
    return (
        "change_date DATE, setting_name STRING, workspace_name STRING, change_type STRING, previous_value STRING, "
        f"new_value STRING, detected_at {run_type.simpleString()}"
    )


def _key(schema: StructType, column: str) -> Column:
    """Microseconds since 1970 of a run, which a time without zone counts in UTC."""
    if schema[column].dataType.typeName() == "timestamp":
        return F.unix_micros(column)
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {column})")


def _run(kind: DataType, key: Column) -> Column:
    if kind.typeName() == "timestamp":
        return F.timestamp_micros(key)
    day, rest = F.floor(key / F.lit(86_400_000_000)), F.pmod(key, F.lit(86_400_000_000))
    start = F.date_from_unix_date(day.cast("int")).cast("timestamp_ntz")
    return start + F.make_dt_interval(secs=(rest / 1_000_000).cast("decimal(18,6)"))


def _unwritten() -> StructType:
    """The columns of a history in which nothing is stored yet."""
    return _plain(_parse_datatype_string(HISTORY_SCHEMA))


def _spread(rows: DataFrame, column: str) -> DataFrame:
    """Rows of a partition together, cut into files of even size where adaptive execution can."""
    adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    return rows.hint("rebalance", column) if adaptive else rows


def _append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def _replace(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write rows, in place of what the partitions they lie in held; others stay."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def _partitions(spark: SparkSession, path: str) -> set[int]:
    return {int(name.split("=")[1]) for name in names(spark, path) if name.startswith(f"{RUN_KEY}=")}
