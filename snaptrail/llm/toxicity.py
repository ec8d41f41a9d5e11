"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A text counts its hashed n-grams. The logarithm of a count times the feature's naive Bayes log-count ratio
is its value, the vector is scaled to length 1, and a logistic regression is fitted on top.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrail.llm.common import documents, first_by_hash, stored
from snaptrail.llm.ngrams import ngram_buckets, texts

SIZES = (5, 7)
BITS = 18

# Features of fewer training documents are worth nothing.
MIN_DOCUMENTS = 3

# Labelled documents of each class that the classifier is fitted on, those with the smallest hashes.
# Their features reach the driver in blocks, and lie there in a temporary file.
LABELLED_PER_CLASS = 2_500

# Features that the driver holds at once, or as many as one document has.
BLOCK_FEATURES = 2_000_000


@dataclass
class ToxicityModel:
    ratio: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, text: np.ndarray) -> float:
        buckets, logs = ngram_logs(text)
        values = self.ratio[buckets] * logs
        length = float(np.sqrt(values @ values))
        logit = (float(values @ self.weight[buckets]) / length if length else 0.0) + self.bias
        return float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))


def ngram_logs(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct buckets of a text, and log(1 + count) of each."""
    counts = np.bincount(ngram_buckets(text, SIZES, BITS))
    buckets = np.flatnonzero(counts)
    return buckets, np.log1p(counts[buckets])


def sample_features(docs: DataFrame, labels: DataFrame, per_class: int = LABELLED_PER_CLASS) -> DataFrame:
    """doc_id, toxic and the features of up to ``per_class`` labelled documents of each class.

    ``labels`` has doc_id and toxic (0 or 1; other values and nulls are left out; of repeated ids the
    largest counts). Of documents that repeat an id, the text with the smallest hash is taken.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    present = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = first_by_hash(present, "toxic", per_class)
    # At most 2 * per_class rows.
    labelled = docs.join(F.broadcast(chosen.select("doc_id", "toxic")), "doc_id")
    labelled = labelled.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))

    def featurized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngram_logs(text) for text in texts(batch["text"])]
            buckets = pa.array([buckets.astype(np.int32) for buckets, _ in found], pa.list_(pa.int32()))
            logs = pa.array([logs.astype(np.float32) for _, logs in found], pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["toxic"], buckets, logs], ["doc_id", "toxic", "buckets", "logs"]
            )

    return labelled.mapInArrow(featurized, "doc_id long, toxic int, buckets array<int>, logs array<float>")


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = LABELLED_PER_CLASS, block_features: int = BLOCK_FEATURES
) -> ToxicityModel | None:
    """Learn from ``labels`` (doc_id, toxic); None unless both classes are among the documents."""
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    features = stored(sample_features(documents(docs), labels, per_class))
    sizes = features.select("doc_id", "toxic", F.size("buckets").alias("size")).toArrow().combine_chunks().sort_by("doc_id")
    if len(set(sizes["toxic"].to_pylist())) < 2:
        return None
    # Runs of ids of so many features in all, or of one document.
    block = np.cumsum(sizes["size"].to_numpy()) // block_features
    ids, toxic = sizes["doc_id"].to_numpy(), sizes["toxic"].to_numpy() == 1
    starts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    edges = [*starts.tolist(), len(ids)]
    with tempfile.TemporaryFile() as file:
        shapes, counts, documents_of = [], np.ones((2, 1 << BITS)), np.zeros(1 << BITS, np.int64)
        for first, end in zip(edges[:-1], edges[1:]):
            table = features.where(F.col("doc_id").between(int(ids[first]), int(ids[end - 1]))).toArrow()
            table = table.combine_chunks().sort_by("doc_id")
            lists = table["buckets"].combine_chunks()
            rows = np.repeat(np.arange(first, end, dtype=np.int32), lists.value_lengths().to_numpy())
            buckets, logs = lists.flatten().to_numpy(), table["logs"].combine_chunks().flatten().to_numpy()
            for side in (0, 1):
                of_side = toxic[rows] == (side == 0)
                counts[side] += np.bincount(buckets[of_side], logs[of_side], minlength=1 << BITS)
            documents_of += np.bincount(buckets, minlength=1 << BITS)
            for column in (rows, buckets.astype(np.int32), logs.astype(np.float32)):
                file.write(column.data)
            shapes.append(len(rows))
            del table, lists, rows, buckets, logs
        ratio = np.log(counts[0] / counts[0].sum()) - np.log(counts[1] / counts[1].sum())
        ratio[documents_of < MIN_DOCUMENTS] = 0
        single = ratio.astype(np.float32)

        def blocks() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            file.seek(0)
            for n in shapes:
                columns = np.frombuffer(file.read(12 * n), np.int32).reshape(3, n)
                yield columns[0], columns[1], single[columns[1]] * columns[2].view(np.float32)

        lengths = np.zeros(len(ids))
        for rows, _, values in blocks():
            lengths += np.bincount(rows, values**2, minlength=len(ids))
        scale = 1 / np.maximum(np.sqrt(lengths), 1e-12).astype(np.float32)
        weight, bias = _logistic(blocks, scale, toxic.astype(float))
    return ToxicityModel(ratio, weight, bias)


def _logistic(
    blocks: Callable[[], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]],
    scale: np.ndarray,
    labels: np.ndarray,
    steps: int = 100,
    rate: float = 10.0,
) -> tuple[np.ndarray, float]:
    """Logistic regression by gradient steps with momentum; both classes weigh the same.

    A fixed number of plain steps favours features that many documents share, which rare ones need not.
    ``blocks`` gives row, bucket and value of the features, whole documents in each; ``scale`` is the factor
    of each document.
    """
    weight, bias, speed, bias_speed = np.zeros(1 << BITS), 0.0, np.zeros(1 << BITS), 0.0
    importance = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    for _ in range(steps):
        single, gradient = weight.astype(np.float32), np.zeros(1 << BITS)
        # A document without features has the bias as its logit.
        errors = (1 / (1 + np.exp(-np.clip(bias, -30, 30))) - labels) * importance
        for rows, buckets, values in blocks():
            if not len(rows):
                continue
            own = slice(int(rows[0]), int(rows[-1]) + 1)
            local = rows - rows[0]
            sums = np.bincount(local, values * single[buckets], minlength=own.stop - own.start)
            logits = sums * scale[own] + bias
            errors[own] = (1 / (1 + np.exp(-np.clip(logits, -30, 30))) - labels[own]) * importance[own]
            part = (errors[own] * scale[own]).astype(np.float32)
            gradient += np.bincount(buckets, values * part[local], minlength=1 << BITS)
        speed = 0.9 * speed + gradient
        bias_speed = 0.9 * bias_speed + errors.sum()
        weight -= rate * speed
        bias -= 0.1 * rate * bias_speed
    return weight, bias


def score(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) for every row and whole text of ``docs``.

    Null and empty texts have the n-grams of two spaces only, too few for any, and get the model's
    bias. Without a model (no labels of both classes) every score is 0. Repeated rows and ids are each
    scored; an empty table gives an empty result.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(text) if model else 0.0 for text in texts(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores, pa.float64())], ["doc_id", "score"])

    rows = documents(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    result = rows.mapInArrow(scored, f"doc_id {id_type}, score double")
    return result.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
