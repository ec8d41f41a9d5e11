"""The registered queries of this package, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from snaptrail.llm import language_id, token_files, toxicity, whitening
from snaptrail.llm.common import UPPER, held_out, shared_folder, table
from snaptrail.llm.decontamination import contamination
from snaptrail.llm.exact_dedup import exact_groups
from snaptrail.llm.mixing import mix
from snaptrail.llm.near_dedup import near_groups
from snaptrail.llm.preferences import format_pairs, swapped_replies
from snaptrail.llm.prefix_trie import prefix_nodes, shared_starts, turn_ids
from snaptrail.llm.relative_lz import remove_duplicate_spans
from snaptrail.llm.repeats import remove_repeats
from snaptrail.llm.url_filter import filter_urls

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_exact_dedup": _exact_dedup,
        "op2_preferences": _preferences,
        "op3_token_files": _token_files,
        "op4_toxicity": _toxicity,
        "op5_decontamination": _decontamination,
        "op6_repeats": _repeats,
        "op7_near_dedup": _near_dedup,
        "op8_url_filter": _url_filter,
        "op9_mix_sources": _mix_sources,
        "op10_language_id": _language_id,
        "op11_duplicate_spans": _duplicate_spans,
        "op12_whitening": _whitening,
        "op13_prefix_trie": _prefix_trie,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": EXACT_DEDUP, "op2_preferences": PREFERENCES, "op5_decontamination": DECONTAMINATION}


LOWER = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"

EXACT_DEDUP = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(lowered) AS text_sha256
FROM (SELECT doc_id, {LOWER} AS lowered FROM documents)
WINDOW same AS (PARTITION BY lowered)"""

# Each conversation up to its last reply, against the same with the last reply of its neighbour.
PREFERENCES = """
WITH turns AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM turns),
replies AS (SELECT conv_id, max(n) AS last, max_by(text, n) AS text FROM numbered WHERE role = 'assistant' GROUP BY conv_id),
pairs AS (SELECT r.conv_id, r.last, r.text AS good, other.text AS bad
    FROM replies r LEFT JOIN replies other ON other.conv_id = xor(r.conv_id, 1)),
sides AS (SELECT *, good = bad IS NOT DISTINCT FROM true AS same FROM pairs),
prompts AS (SELECT s.conv_id, coalesce(string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY n)
      FILTER (WHERE n < last OR same), '') AS prompt
    FROM sides s JOIN numbered USING (conv_id) WHERE n <= last GROUP BY s.conv_id)
SELECT conv_id AS pair_id, if(same, last, last - 1) AS n_prompt_turns, prompt,
  if(same, '', '<|assistant|>' || chr(10) || good || '<|end|>' || chr(10)) AS chosen,
  if(same, '', '14:' || (14 + length(good) + 7)) AS chosen_mask,
  if(same OR bad IS NULL, '', '<|assistant|>' || chr(10) || bad || '<|end|>' || chr(10)) AS rejected,
  if(same OR bad IS NULL, '', '14:' || (14 + length(bad) + 7)) AS rejected_mask
FROM sides JOIN prompts USING (conv_id)"""


WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH item_words AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
windows AS (SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win, least(10, len(w)) AS n
    FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS w FROM documents),
placed AS (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc_words, (SELECT DISTINCT n FROM windows)),
hits AS (SELECT DISTINCT r, p, placed.n AS n, item_id FROM placed JOIN windows
    ON windows.n = placed.n AND win = list_slice(w, p, p + placed.n - 1)),
covered AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM hits) GROUP BY r),
named AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT r, item_id FROM hits) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""


def _exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


URL_RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)


def _url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def _mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def _toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(documents, labels.where(~held_out(F.col("doc_id"))))
    scores = toxicity.score(documents, model)
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def _language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = language_id.fit(documents.where(~held_out(F.col("doc_id"))))
    found = language_id.predict(documents, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


TOKENIZER = "byte_bpe_50k.json"


def _token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4()}"
    token_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), path)
    return token_files.checksums(spark, path)


def _decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("item_ids", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", items.alias("items_sha256"), "contaminated")


def _near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), percent=85)


def _preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = format_pairs(swapped_replies(table(spark, sf_dir, "conversations")))
    return pairs.select(
        "pair_id",
        F.col("n_prompt_turns").cast("long").alias("n_prompt_turns"),
        "prompt",
        "chosen",
        _spans("chosen_mask"),
        "rejected",
        _spans("rejected_mask"),
    )


def _spans(mask: str) -> Column:
    """Spans as text, such as ``14:31,60:75``."""
    return F.array_join(F.transform(mask, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(mask)


def _repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_repeats(table(spark, sf_dir, "documents"))
    spans = F.size("spans").cast("long").alias("n_spans")
    return cleaned.select("doc_id", "n_bytes", "n_removed", spans, F.sha2("kept", 256).alias("kept_sha256"))


def _prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = prefix_nodes(shared_starts(turn_ids(table(spark, sf_dir, "conversations"))))
    return nodes.withColumnRenamed("saved", "saved_tokens")


def _whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    rows = whitening.whiten(vectors, whitening.fit(vectors))
    return rows.withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def _duplicate_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove_duplicate_spans(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    factors = F.size("factors").cast("long").alias("n_factors")
    return cleaned.select("doc_id", "n_words", "n_removed", kept, factors)
