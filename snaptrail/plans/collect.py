"""One collection run: payload tables in, classified snapshot appended, views refreshed."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrail.functions.values import label_names
from snaptrail.operators import categories, ingest
from snaptrail.plans.classification import classify_settings
from snaptrail.plans.views import register_views
from snaptrail.sources import tables
from snaptrail.sources.run_store import PathStore

logger = logging.getLogger(__name__)

# Fixed value: the label set used when none is configured.
DEFAULT_LABELS = "governance,ingestion,AI,ML,compute,marketplace,platform,other"


def build_snapshot(
    account_payloads: DataFrame,
    workspace_payloads: DataFrame,
    collected_at: Column,
    account_id: str = ingest.UNKNOWN,
    workspace_ids: Iterable[int] | str | None = None,
) -> DataFrame:
    """All rows of one run: the account's, then those of the chosen workspaces."""
    chosen = ingest.only_workspaces(workspace_payloads, workspace_ids)
    return ingest.snapshot_union(
        ingest.snapshot_rows(account_payloads, "account", collected_at, account_id),
        ingest.snapshot_rows(chosen, "workspace", collected_at, account_id),
    )


def collect(
    rows: DataFrame,
    store: PathStore | tables.CatalogStore,
    classifier: categories.Classifier,
    classified_at: Column,
    labels: Iterable[str] | str = DEFAULT_LABELS,
    classifier_tasks: int | None = None,
) -> DataFrame:
    """Classify the rows of a run, append them to the history and return the whole history.

    Classification is best effort: settings that the classifier fails on stay without a category in
    this run, are kept with the error among the store's failures, and are tried again in the next run.
    Failures of storage are raised, and nothing of the run is appended then. Blank labels count as none, and without labels nothing
    is classified.
    """
    spark = rows.sparkSession
    labels = label_names(labels)
    if labels:
        settings = categories.distinct_settings(rows)
        classify_settings(settings, store, labels, classifier, classified_at, classifier_tasks)
        rows = categories.apply_categories(rows, store.categories(spark), labels)
    else:
        logger.warning("no labels given, settings stay uncategorized")
        rows = rows.withColumn("category", F.lit(None).cast("string"))
    store.append_history(rows)
    history = store.history(spark)
    register_views(history, store.categories(spark), store.layout(spark))
    return history
