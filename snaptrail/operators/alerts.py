"""Alert results: one row that says how much there is to report, and the lines that say what."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptrail.functions.values import is_on, is_preview
from snaptrail.layout import Layout
from snaptrail.operators.drift import latest_drift
from snaptrail.operators.numbering import numbered
from snaptrail.operators.runs import latest_rows


def drift_alert(history: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """One row: ``drift_count``, the number of changes found by the newest run."""
    return latest_drift(history, layout=layout).agg(F.count("*").alias("drift_count"))


def drift_alert_lines(history: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """One row per change found by the newest run, with the ``line`` that reports it and its ``number``.

    Numbers run from 1 to the number of changes in the order of the other columns, nulls first, so the
    report as one text is its lines in the order of ``number``. They are counted over range partitions;
    no task sees all lines.
    """
    line = F.concat(
        "setting_name",
        F.lit(" ["),
        _or("workspace_name", "-"),
        F.lit("]: "),
        "change_type",
        F.lit(" ("),
        _or("previous_value", "(none)"),
        F.lit(" -> "),
        _or("new_value", "(none)"),
        F.lit(")"),
    )
    changes = latest_drift(history, layout=layout)
    columns = ["setting_name", "workspace_name", "change_type", "previous_value", "new_value"]
    return numbered(changes.select(*columns, line.alias("line")), *columns)


def preview_alert(
    history: DataFrame, layout: Layout = Layout(), only_latest_run: bool = False
) -> DataFrame:
    """One row: ``new_previews``, the number of preview settings that were just switched on."""
    enabled = newly_enabled_previews(history, layout, only_latest_run)
    return enabled.agg(F.count("*").alias("new_previews"))


def preview_alert_lines(
    history: DataFrame, layout: Layout = Layout(), only_latest_run: bool = False
) -> DataFrame:
    """One row per preview setting that was just switched on, with the ``line`` that reports it and its ``number``.

    Numbers run from 1 in the order of setting_name and workspace, which name a row.
    """
    line = F.concat(
        "setting_name",
        F.lit(" [ws "),
        F.col("workspace").cast("string"),
        F.lit("]: "),
        _or("previous_value", "(new)"),
        F.lit(" -> "),
        _or("current_value", "(none)"),
    )
    enabled = newly_enabled_previews(history, layout, only_latest_run)
    return numbered(enabled.withColumn("line", line), "setting_name", "workspace")


def newly_enabled_previews(
    history: DataFrame, layout: Layout = Layout(), only_latest_run: bool = False
) -> DataFrame:
    """One row per preview series that is on in its last observation and was not in the one before.

    Compares each series' last observation as a preview with the one before, however long ago
    either was. ``only_latest_run`` leaves out series that the newest run did not see as a preview;
    their rows go before anything is ranked.
    """

    observed = preview_observations(history, layout)
    if only_latest_run:
        seen = preview_observations(latest_rows(history, layout), layout).select("setting_name", "workspace").distinct()
        observed = observed.join(seen, ["setting_name", "workspace"], "left_semi")
    return just_enabled(last_two(observed))


def preview_observations(rows: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """setting_name, workspace, run and observed value of rows whose setting was a preview."""
    return rows.where(is_preview(F.col(layout.phase))).select(
        F.col(layout.name).alias("setting_name"),
        layout.workspace_key().alias("workspace"),
        F.col(layout.run).alias("run"),
        F.col(layout.value).alias("observed"),
    )


def last_two(observed: DataFrame) -> DataFrame:
    """One row per series with its ``observations`` (run, observed): the last two, the last one first.

    What is left of parts of a history can be brought together: the last two of several such tables,
    taken apart by :func:`observations`, are those of all their rows.
    """
    newest_first = Window.partitionBy("setting_name", "workspace").orderBy(
        F.desc("run"), F.desc_nulls_last("observed")
    )
    # Each task passes on two rows per series at most (window group limit), however long it is.
    ranked = observed.withColumn("_age", F.row_number().over(newest_first)).where("_age <= 2")

    def at(age: int) -> Column:
        return F.max(F.when(F.col("_age") == age, F.struct("run", "observed")))

    pairs = ranked.groupBy("setting_name", "workspace").agg(F.array_compact(F.array(at(1), at(2))).alias("observations"))
    return pairs


def observations(last: DataFrame) -> DataFrame:
    """The rows that :func:`last_two` was made of, as far as it kept them."""
    return last.select("setting_name", "workspace", F.inline("observations"))


def just_enabled(last: DataFrame) -> DataFrame:
    """Series that are on in their last observation and were not in the one before."""
    now, before = (F.get("observations", age)["observed"] for age in (0, 1))
    pairs = last.select(
        "setting_name",
        "workspace",
        F.get("observations", 0)["run"].alias("last_run"),
        now.alias("current_value"),
        before.alias("previous_value"),
    )
    return pairs.where(is_on(F.col("current_value")) & ~is_on(F.col("previous_value")))


def evaluate(alert: DataFrame, column: str, threshold: float = 0) -> DataFrame:
    """Add ``triggered``: whether the alert's number is above the threshold."""
    return alert.withColumn("triggered", F.coalesce(F.col(column) > F.lit(threshold), F.lit(False)))


def _or(column: str, text: str) -> Column:
    return F.coalesce(F.col(column), F.lit(text))
