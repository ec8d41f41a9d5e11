"""Language identification by nearest centroid.

A text, its letters and spaces only, is a TF-IDF vector of hashed byte n-grams, scaled to length 1. Each language has several
centroids, found by clustering its training vectors. The centroid with the largest cosine names the
language. Texts far from all centroids are rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrail.llm.common import documents, first_by_hash, stored
from snaptrail.llm.ngrams import letters, ngram_buckets, texts

SIZES = (1, 2, 3)
BITS = 12

# Training documents of each language, those with the smallest hashes, and languages that are learned, those with
# the most documents. Centroids are all that reaches the driver: CENTROIDS * LANGUAGES rows of 2**BITS numbers.
TRAINING_PER_LANGUAGE = 400
LANGUAGES = 1000

CENTROIDS = 4

# A text is rejected when its cosine is below this share of a low quantile of those that training texts of its
# language have, cut to its length: to the largest of LENGTHS, in bytes of letters and spaces, up to it.
REJECT_SHARE = 0.8
REJECT_QUANTILE = 0.01
LENGTHS = np.array([4, 8, 16, 32, 64, 128, 256, 512])

HAS_LETTER = r"\p{L}"

UNDETERMINED = "und"


@dataclass
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    # Of each language, for each of LENGTHS.
    reject_below: np.ndarray

    def cosines(self, counts: np.ndarray) -> np.ndarray:
        """Rows of n-gram counts against the columns of centroids."""
        return tf_idf(counts, self.idf) @ self.centroids.T

    def nearest(self, text: np.ndarray) -> tuple[int, float]:
        """Language and cosine of the centroid nearest to a text."""
        cosines = self.cosines(ngram_counts(text))
        best = int(np.argmax(cosines))
        return int(self.owner[best]), float(np.clip(cosines[best], 0, 1))


def ngram_counts(text: np.ndarray) -> np.ndarray:
    return np.bincount(ngram_buckets(letters(text), SIZES, BITS), minlength=1 << BITS).astype(np.float32)


def tf_idf(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    vectors = np.log1p(counts) * idf
    return vectors / np.maximum(np.linalg.norm(vectors, axis=-1, keepdims=True), 1e-12)


def clusters(vectors: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Up to ``k`` centroids of unit vectors: start far apart, then alternate as k-means by cosine does."""
    centroids = vectors[:1]
    while len(centroids) < min(k, len(vectors)):
        nearest = (vectors @ centroids.T).max(axis=1)
        centroids = np.vstack([centroids, vectors[np.argmin(nearest)][None]])
    for _ in range(rounds):
        member = np.argmax(vectors @ centroids.T, axis=1)
        means = [vectors[member == i].mean(axis=0) if (member == i).any() else c for i, c in enumerate(centroids)]
        centroids = np.array(means)
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    return centroids


def fit(
    docs: DataFrame, lang_col: str = "lang", per_language: int = TRAINING_PER_LANGUAGE, languages: int = LANGUAGES
) -> LanguageModel | None:
    """Learn from texts with a letter and a non-null language; None if there is no such row.

    Of a language with more than ``per_language`` ids, those with the smallest hashes are taken. An id that
    repeats with another language counts for the smallest, and with another text for that with the smallest
    hash. Of more than ``languages`` languages those with the most ids are learned, the smallest name first among
    equals. Counting and clustering are done in tasks, one language at a time.
    """
    docs = docs.where(F.col("text").rlike(HAS_LETTER))
    named = docs.select("doc_id", F.col(lang_col).alias("lang")).where("lang IS NOT NULL AND doc_id IS NOT NULL")
    named = named.groupBy("doc_id").agg(F.min("lang").alias("lang"))
    # At most ``languages`` rows.
    learned = stored(named.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).select("lang"))
    named = named.join(F.broadcast(learned), "lang", "left_semi")
    chosen = first_by_hash(named, "lang", per_language)
    training = documents(docs).join(F.broadcast(chosen.select("doc_id", "lang")), "doc_id")
    training = stored(training.groupBy("doc_id", "lang").agg(F.min_by("text", F.xxhash64("text")).alias("text")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [ngram_counts(text) for text in texts(batch["text"])]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["lang"], pa.array(counts, pa.list_(pa.float32()))], ["doc_id", "lang", "counts"]
            )

    id_type = training.schema["doc_id"].dataType.simpleString()
    counts = stored(training.mapInArrow(counted, f"doc_id {id_type}, lang string, counts array<float>"))

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, found = 0, np.zeros(1 << BITS, np.int64)
        for batch in batches:
            rows += len(batch)
            found += (_rows(batch["counts"]) > 0).sum(axis=0)
        # Place -1 is the number of documents.
        columns = [np.arange(-1, 1 << BITS), np.concatenate([[rows], found])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["place", "n"])

    sums = counts.select("counts").mapInArrow(present, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    totals = np.zeros(1 + (1 << BITS), np.int64)
    for place, n in sums.collect():
        totals[place + 1] = n
    if not totals[0]:
        return None
    idf = (np.log((1 + totals[0]) / (1 + totals[1:])) + 1).astype(np.float32)

    def clustered(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id").combine_chunks()
        found = clusters(tf_idf(_rows(table["counts"].combine_chunks()), idf), CENTROIDS).astype(np.float32)
        return pa.table({"lang": [table["lang"][0].as_py()] * len(found), "place": range(len(found)), "centroid": list(found)})

    kinds = "lang string, place long, centroid array<float>"
    found = sorted(counts.groupBy("lang").applyInArrow(clustered, kinds).collect())
    languages = sorted({row.lang for row in found})
    owner = [languages.index(row.lang) for row in found]
    centroids = [np.array(row.centroid, np.float32) for row in found]
    centroids = np.vstack(centroids)
    model = LanguageModel(languages, idf, centroids, np.array(owner), np.zeros((len(languages), len(LENGTHS))))
    model.reject_below = _bounds(training, model)
    return model


def _rows(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, 1 << BITS)


def _bounds(training: DataFrame, model: LanguageModel) -> np.ndarray:
    """The cosine below which a text is rejected, of each language and each of LENGTHS."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in texts(batch["text"]):
                text = letters(text)
                found += [(size, *model.nearest(text[:n])) for size, n in enumerate(LENGTHS) if n <= len(text)]
            arrays = [pa.array([row[i] for row in found], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["size", "language", "cosine"])

    table = training.select("text").mapInArrow(cut, "size long, language long, cosine double").toArrow()
    size, language, cosine = (table[c].to_numpy() for c in ("size", "language", "cosine"))
    bounds = np.zeros((len(model.languages), len(LENGTHS)))
    for i in range(len(model.languages)):
        for k in range(len(LENGTHS)):
            own = cosine[(language == i) & (size == k)]
            # Of a length that no training text has, the bound is that of the one before.
            bounds[i, k] = REJECT_SHARE * np.quantile(own, REJECT_QUANTILE) if len(own) else bounds[i, max(k - 1, 0)]
    return bounds


def predict(
    docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, lang_pred, score and rejected for every row and whole text of ``docs``.

    ``score`` is the cosine to the nearest centroid, 0 to 1. ``rejected`` marks texts too far from all
    centroids, and texts that are null or have no letter: these are ``und`` with score 0, as is every text
    if there is no model. A text far from all centroids still names its nearest language. Ties go to
    the language first in order. Repeated rows and ids are each predicted; an empty table gives an empty
    result.
    """

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, far = [], [], []
            for text, has_letter in zip(texts(batch["text"]), batch["has_letter"].to_pylist()):
                if not has_letter or model is None:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    far.append(True)
                    continue
                lang, score = model.nearest(text)
                size = max(0, int(np.searchsorted(LENGTHS, len(letters(text)), side="right")) - 1)
                langs.append(model.languages[lang])
                scores.append(score)
                far.append(score < float(model.reject_below[lang, size]))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(far, pa.bool_())],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    rows = documents(docs, id_col, text_col).withColumn("has_letter", F.col("text").rlike(HAS_LETTER))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predicted, f"doc_id {id_type}, lang_pred string, score double, rejected boolean")
