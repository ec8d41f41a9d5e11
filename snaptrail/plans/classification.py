"""Classification of new settings that loses no result: not to one bad text, a lost executor or an ended run.

Settings without an entry are written to a staging folder of the store and numbered. Batches of them go through
the classifier, each straight into files of its own, so that no result is ever computed again. A batch that
fails is cut into parts, down to the one text that fails, which gets a row with the error. All results then go
to the map, and the errors to a table of failures; what a run staged and did not hand over, the next one does.
"""

from __future__ import annotations

import logging
import uuid
from collections import deque
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrail.operators import categories
from snaptrail.operators.numbering import numbered
from snaptrail.sources.files import delete, names, read_or_empty
from snaptrail.sources.run_store import PathStore
from snaptrail.sources.tables import CatalogStore

logger = logging.getLogger(__name__)

# Settings that go through the classifier in one job.
BATCH_ROWS = 100_000

# Parts that a failed batch is cut into.
PARTS = 8

# Failed jobs after which a classifier counts as down: what is left gets the last error, and is tried again next time.
FAILED_JOBS = 200

ERROR_LENGTH = 500

_RESULTS = "setting_name STRING, category STRING, labels_version STRING, classified_at TIMESTAMP, error STRING"


def classify_settings(
    settings: DataFrame,
    store: PathStore | CatalogStore,
    labels: Iterable[str] | str,
    classifier: categories.Classifier,
    classified_at: Column,
    tasks: int | None = None,
    batch_rows: int = BATCH_ROWS,
    failed_jobs: int = FAILED_JOBS,
) -> None:
    """Bring the map of ``store`` up to date with ``settings`` (setting_name, descr).

    A text that fails has no entry, so that it is tried again in the next run, and a row in ``store.failures``.
    Failures of storage before and after the classifier runs are raised. One call at a time for a store.
    """
    spark = settings.sparkSession
    for earlier in names(spark, store.staging(spark)):
        _hand_over(store, f"{store.staging(spark)}/{earlier}", spark)
    folder = f"{store.staging(spark)}/{uuid.uuid4()}"
    new = categories.unclassified(settings, store.categories(spark), labels)
    number = numbered(new, "setting_name")
    number.write.parquet(f"{folder}/new")
    new = spark.read.schema(number.schema).parquet(f"{folder}/new")
    total = new.count()
    todo = deque((first, min(first + batch_rows, total + 1)) for first in range(1, total + 1, batch_rows))
    failures = 0
    while todo:
        first, end = todo.popleft()
        batch = new.where(F.col("number").between(first, end - 1))
        path = f"{folder}/done/{first}-{end}-{uuid.uuid4()}"
        try:
            categories.classified(batch, labels, classifier, classified_at, tasks).write.parquet(path)
            continue
        except Exception as error:  # any failure of a user's classifier surfaces here
            failures += 1
            message = str(error)[:ERROR_LENGTH]
        if end - first == 1 or failures >= failed_jobs:
            if failures >= failed_jobs:
                todo.clear()
                logger.error("classification given up at setting %d of %d: %s", first, total, message)
                batch = new.join(_names(spark, folder), "setting_name", "left_anti")
            _failed(batch, labels, classified_at, message).write.parquet(f"{path}-failed")
        else:
            size = -(-(end - first) // PARTS)
            todo.extend((at, min(at + size, end)) for at in range(first, end, size))
    _hand_over(store, folder, spark)


def by_row(function: Callable[[str, list[str]], str | None]) -> categories.Classifier:
    """A classifier of a Python function of a text and the labels; a text it fails on gets the error as its result.

    No job fails for it, so nothing is tried twice. Texts come in Arrow batches.
    """
    def classify(texts: pd.Series, labels: pd.Series) -> pd.DataFrame:
        found = []
        for text, options in zip(texts, labels):
            try:
                found.append((function(text, list(options)), None))
            except Exception as error:  # whatever a user's function raises
                found.append((None, f"{type(error).__name__}: {error}"[:ERROR_LENGTH]))
        return pd.DataFrame(found, columns=["category", "error"], dtype=object)

    return F.pandas_udf(classify, "category STRING, error STRING")


def _failed(batch: DataFrame, labels: Iterable[str] | str, classified_at: Column, message: str) -> DataFrame:
    nothing = lambda text, options: F.lit(None).cast("string")
    return categories.classified(batch, labels, nothing, classified_at).withColumn("error", F.lit(message))


def _results(spark: SparkSession, folder: str) -> DataFrame:
    return read_or_empty(spark, f"{folder}/done/*", _RESULTS)


def _names(spark: SparkSession, folder: str) -> DataFrame:
    return _results(spark, folder).select("setting_name")


def _hand_over(store: PathStore | CatalogStore, folder: str, spark: SparkSession) -> None:
    """Bring staged results to the map and staged errors to the failures, then drop the staging folder.

    Doing it again changes nothing in the map, which is updated by key.
    """
    results = _results(spark, folder)
    found = results.groupBy().agg(F.count("error").alias("failed"), F.count("*").alias("results")).first()
    if found.results > found.failed:
        store.append_categories(results.where("error IS NULL").drop("error"))
    if found.failed:
        logger.error("%d settings stay uncategorized, as the classifier failed on them", found.failed)
        store.append_failures(results.where("error IS NOT NULL").drop("category"))
    delete(spark, folder)
