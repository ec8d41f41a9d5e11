"""Column expressions that give meaning to setting values, phases, times and label sets."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Texts stored in place of a value that could not be read.
UNAVAILABLE = "<unavailable>"
NULL_VALUE = "<null>"
NOT_SET = "<not-set>"
SENTINELS = (UNAVAILABLE, NULL_VALUE, NOT_SET)

# Lower-case texts that mean a switch is on or off.
ON_VALUES = ("true", "enabled", "1", "on")
OFF_VALUES = ("false", "disabled", "0", "off")

# Phases that mean "not a preview" (case-sensitive).
NON_PREVIEW_PHASES = ("GA", "None", "", "PreviewPhase.GA")


def is_reliable(value: Column) -> Column:
    """True for a value that was really read; false for NULL and for a sentinel."""
    return value.isNotNull() & ~value.isin(*SENTINELS)


def is_on(value: Column) -> Column:
    """True for an on-value in any case; false (never NULL) for everything else."""
    return F.coalesce(F.lower(value).isin(*ON_VALUES), F.lit(False))


def is_preview(phase: Column) -> Column:
    return phase.isNotNull() & ~phase.isin(*NON_PREVIEW_PHASES)


def status(value: Column) -> Column:
    return (
        F.when(F.lower(value).isin(*ON_VALUES), "ENABLED")
        .when(F.lower(value).isin(*OFF_VALUES), "DISABLED")
        .otherwise("OTHER")
    )


def change_type(previous: Column, current: Column) -> Column:
    """How a value changed between two neighbouring runs; NULL when it did not.

    NULL stands for "no observation". A sentinel is neither a value nor an absence, so a step
    into or out of one is no change.
    """
    return (
        F.when(previous.isNull() & is_reliable(current), "added")
        .when(is_reliable(previous) & current.isNull(), "removed")
        .when(is_reliable(previous) & is_reliable(current) & (previous != current), "value_changed")
    )


def utc_date(df: DataFrame, column: str) -> Column:
    """Calendar date of a timestamp in UTC, whatever the session time zone is."""
    if df.schema[column].dataType.typeName() == "timestamp":
        days = F.floor(F.unix_seconds(column) / F.lit(86400))
        return F.date_from_unix_date(days.cast("int"))
    return F.to_date(column)


def label_names(labels: Iterable[str] | str) -> tuple[str, ...]:
    """Trimmed, non-empty labels, from any iterable (read once) or a comma-separated text."""
    given = labels.split(",") if isinstance(labels, str) else labels
    return tuple(trimmed for label in given if (trimmed := label.strip(" \t\r\n")))


def label_array(labels: Iterable[str] | str) -> Column:
    """Trimmed, non-empty labels as an array column, from a list or a comma-separated text."""
    return F.array(*map(F.lit, label_names(labels))).cast("array<string>")


def labels_version(labels: Column) -> Column:
    """Short hash of a label set that does not depend on the order of the labels."""
    return F.substring(F.sha2(F.array_join(F.array_sort(labels), "|"), 256), 1, 12)
