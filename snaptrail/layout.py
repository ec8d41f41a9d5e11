"""Table schemas, and the column names by which operators find their inputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column names and types of the two stored tables.
HISTORY_SCHEMA = (
    "collected_at TIMESTAMP NOT NULL, account_id STRING NOT NULL, scope STRING NOT NULL, "
    "workspace_id BIGINT, workspace_name STRING, setting_name STRING NOT NULL, "
    "setting_value STRING, setting_type STRING, source STRING, category STRING, "
    "preview_phase STRING, description STRING"
)
CATEGORY_MAP_SCHEMA = (
    "setting_name STRING, category STRING, labels_version STRING, classified_at TIMESTAMP"
)


@dataclass(frozen=True, eq=False)
class KnownRuns:
    """The runs of a stored history, known without reading it.

    ``table`` has one row per run: the run, its partition, ``settings_count`` and ``workspaces``. ``newest``
    holds literals for the newest of them, newest first: the run and its partition. ``all_of_them`` says
    whether there are no others. ``nothing`` stands for a run where there is none.
    """

    table: DataFrame
    newest: tuple[tuple[Column, Column], ...]
    all_of_them: bool
    nothing: Column

    def run(self, age: int) -> Column:
        return self.newest[age][0] if age < len(self.newest) else self.nothing


@dataclass(frozen=True)
class Layout:
    """Names of the history columns an operator reads.

    ``workspace_name`` may be None for histories without one. ``run_partition`` names a
    partition column that grows with ``run`` (such as the run's date); with it, operators
    that look at the newest runs only open the newest partitions. With ``known_runs`` they open no
    other files even to find out which partitions these are.
    """

    run: str = "collected_at"
    name: str = "setting_name"
    workspace: str = "workspace_id"
    workspace_name: str | None = "workspace_name"
    value: str = "setting_value"
    scope: str = "scope"
    category: str = "category"
    phase: str = "preview_phase"
    run_partition: str | None = None
    known_runs: KnownRuns | None = None

    def workspace_key(self) -> Column:
        """The workspace part of a series key: rows without a workspace share key 0."""
        return F.coalesce(F.col(self.workspace), F.lit(0))

    def workspace_label(self) -> Column:
        if self.workspace_name is None:
            return F.lit(None).cast("string")
        return F.col(self.workspace_name)
