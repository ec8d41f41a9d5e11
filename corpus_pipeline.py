"""A training corpus in five stages, each written as Parquet and read again by the next.

Documents of no known language go, of near duplicates one stays, passages of benchmarks are cut out by
document, sources are mixed to their weights, and what is left becomes token ids in files.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snaptrail.llm import language_id, token_files
from snaptrail.llm.common import held_out, once, shared_folder, stored, table
from snaptrail.llm.decontamination import contamination
from snaptrail.llm.mixing import mix
from snaptrail.llm.near_dedup import near_groups
from snaptrail.operators.numbering import numbered

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
TOKENIZER = "byte_bpe_50k.json"

# Near duplicates share this part of their five-word shingles, in percent.
NEAR_PERCENT = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language identifier does not reject; it learns from the labelled ones."""
    model = language_id.fit(docs.where(~held_out(F.col("doc_id"))))
    docs = _keyed(docs)
    return _kept(docs, language_id.predict(docs, model, "_key").where("NOT rejected"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id, and of equal rows one.

    Each different text of an id is compared by itself, as are texts without an id, which come last.
    """
    docs = once(_keyed(docs), "_key")
    groups = near_groups(docs, NEAR_PERCENT, "_key").select(F.col("doc_id").alias("_key"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_key")
    first = docs.select("_key", "doc_id").join(groups, "_key").groupBy("component_id").agg(F.min(order).alias("first"))
    return _kept(docs, first.select(F.col("first._key").alias("doc_id")))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    docs = _keyed(docs)
    found = contamination(docs, table(spark, sf_dir, "benchmark"), "_key")
    return _kept(docs, found.where("NOT contaminated"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: taken / size times, halves rounded up.

    A document that the front of its shard's last round ends in is in or out as a whole.
    """
    docs = _keyed(docs, *COLUMNS)
    times = F.expr("CAST((2 * taken + size) div (2 * greatest(size, 1)) AS INT)").alias("times")
    # Rows that agree in all columns have a key in common, and the sum of what each of them is taken.
    times = mix(docs, key_col="_key").select(F.col("key").alias("doc_id"), times).where("times > 0")
    times = times.groupBy("doc_id").agg(F.sum("times").cast("int").alias("times"))
    repeats = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("_repeat")
    return _kept(once(docs, "_key"), times, "times").select(*COLUMNS, repeats).select(*COLUMNS)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all documents; returns where each document lies in them."""
    path = f"{shared_folder(spark)}/corpus-{uuid.uuid4()}"
    token_files.write(docs, public_tokenizers.path(TOKENIZER), path)
    return token_files.checksums(spark, path)


def _keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """Adds ``_key``, a long that rows share which agree in ``columns``, and no others: what one decision holds for.

    That is the id where no other row has it. Rows that repeat an id, or have none, get numbers below all ids, by
    their SHA-256; only these rows are shuffled.
    """
    docs, columns = docs.select(*COLUMNS), columns or ("doc_id", "text")
    repeated = docs.groupBy(F.col("doc_id").alias("_id")).count().where("count > 1 OR _id IS NULL").select("_id")
    repeated = stored(repeated)
    if repeated.isEmpty():
        return docs.withColumn("_key", F.col("doc_id"))
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    alone = docs.join(repeated, same, "left_anti").withColumn("_key", F.col("doc_id"))
    # The length and a mark for null keep columns apart that are hashed together.
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), c), F.lit("-")) for c in columns]
    several = docs.join(repeated, same, "left_semi").withColumn("_digest", F.sha2(F.concat(*parts), 256))
    lowest = docs.agg(F.coalesce(F.least(F.min("doc_id"), F.lit(0)), F.lit(0)).cast("long")).first()[0]
    numbers = numbered(several.select("_digest").distinct(), "_digest")
    numbers = stored(numbers.select("_digest", (F.lit(lowest) - F.col("number")).alias("_key")))
    return alone.unionByName(several.join(numbers, "_digest").drop("_digest"))


def _kept(docs: DataFrame, chosen: DataFrame, *columns: str) -> DataFrame:
    """Rows of ``docs`` whose key is a chosen doc_id, with ``columns`` of the choice."""
    chosen = chosen.select(F.col("doc_id").alias("_key"), *columns).dropDuplicates(["_key"])
    return docs.join(chosen, "_key").select(*COLUMNS, *columns)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", near_duplicates),
    ("decontamination", uncontaminated),
    ("mixing", mixed),
    ("token_files", tokenized),
]

# Languages, signatures and tokens are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; every result but the last is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
