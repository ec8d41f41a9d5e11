"""Dashboard filters: pick a workspace, pick categories, click a value."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matches(
    workspace: str | None = None,
    categories: Sequence[str] = (),
    clicked: Mapping[str, object] | None = None,
) -> Column:
    """The condition a page's filters put on every dataset that has the columns.

    ``workspace`` is one name or None for all, ``categories`` any number or none for all, and
    ``clicked`` maps columns to values picked in other widgets (None picks the missing value).
    """
    conditions = [F.lit(True)]
    if workspace is not None:
        conditions.append(F.col("workspace_name") == workspace)
    if categories:
        conditions.append(F.col("category").isin(*categories))
    for column, value in (clicked or {}).items():
        conditions.append(F.col(column).eqNullSafe(F.lit(value)))
    return reduce(Column.__and__, conditions)


def filtered(
    dataset: DataFrame,
    workspace: str | None = None,
    categories: Sequence[str] = (),
    clicked: Mapping[str, object] | None = None,
) -> DataFrame:
    """The dataset's rows that pass the page's filters; widgets then aggregate these."""
    return dataset.where(matches(workspace, categories, clicked))


def filter_values(dataset: DataFrame, column: str, others: Column | None = None) -> DataFrame:
    """Every value a filter offers, and how many of its rows pass the other filters."""
    passing = F.lit(True) if others is None else others
    return dataset.groupBy(column).agg(F.count_if(passing).alias("selectable_rows"))


def page_filter_values(dataset: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """The values of all filters of a page in one pass: filter, value (as text), selectable_rows.

    ``conditions`` maps the column of each filter to the condition that this filter itself puts on rows.
    As in :func:`filter_values`, a value counts the rows that pass all *other* filters, and every value
    is listed, the missing one too. The dataset is read once, however many filters there are: rows are
    counted per task for each filter (grouping sets) before they are shuffled.
    """
    columns = list(conditions)
    if not columns:
        raise ValueError("a page without filters has no values")
    counts = [
        F.count_if(reduce(Column.__and__, [conditions[o] for o in columns if o != c], F.lit(True))).alias(f"_rows_{i}")
        for i, c in enumerate(columns)
    ]
    # Grouping on copies, so that conditions see the values of all columns in every set.
    copies = [f"_filter_{i}" for i in range(len(columns))]
    copied = dataset.withColumns({copy: F.col(c) for copy, c in zip(copies, columns)})
    grouped = copied.groupingSets([[copy] for copy in copies], *copies).agg(
        *counts, *(F.grouping(copy).alias(f"_out_{i}") for i, copy in enumerate(copies))
    )

    def of_its_filter(values: Sequence[Column]) -> Column:
        return reduce(
            lambda other, i: F.when(F.col(f"_out_{i}") == 0, values[i]).otherwise(other),
            range(len(columns)),
            F.lit(None),
        )

    return grouped.select(
        of_its_filter([F.lit(c) for c in columns]).alias("filter"),
        of_its_filter([F.col(copy).cast("string") for copy in copies]).alias("value"),
        of_its_filter([F.col(f"_rows_{i}") for i in range(len(columns))]).alias("selectable_rows"),
    )
