"""Benchmark decontamination as a set join with prefix filter.

An item is a set of windows of consecutive words, and a window is a set of shingles of three words. A
document contains a window only if it contains all its shingles, so one of them is enough to find it: its
necessary prefix, the shingle that is rarest among the documents. Documents are joined by these prefixes,
candidates are bounded by position and length, and the rest are compared word by word.

Documents never enter a shuffle. The windows of a benchmark are broadcast in blocks of a bounded number,
one pass over the documents each, so a benchmark of any size is searched for completely.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrail.llm.common import cut_lineage, documents, lower_ascii, stored

WINDOW_WORDS = 10
SHINGLE_WORDS = 3

# Windows, or shingles, that are broadcast at once: about 20 MB.
BLOCK_ROWS = 200_000

_OCCURRENCE = {"start": "int", "end": "int", "window_id": "long"}

NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z) runs of letters, digits and characters beyond ASCII."""
    return F.array_remove(F.split(lower_ascii(text), NO_WORD), "")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window_words: int = WINDOW_WORDS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_ids and contaminated for every row of ``docs``.

    A document word inside any occurrence of a window of an item is hit. ``item_ids`` are those of items with
    an occurring window, as sorted text. Items shorter than a window are one window; items without words,
    without text or without id are ignored. A null or empty text has no words. Rows that repeat are
    each judged; an empty benchmark or table is fine.
    """
    rows = documents(docs, id_col, text_col).withColumn("key", F.sha2("text", 256))
    rows = rows.withColumn("words", words(F.col("text")))
    windows, items = item_windows(benchmark, item_col, item_text_col, window_words)
    found = stored(occurrences(rows, windows, block_rows))
    per_doc = found.groupBy("doc_id", "key").agg(
        F.collect_set(F.struct("start", "end")).alias("spans"),
        F.array_sort(F.collect_set("window_id")).alias("windows"),
    )
    per_doc = stored(per_doc.select("doc_id", "key", _covered(F.col("spans")).alias("n_hit"), "windows"))
    per_doc = per_doc.join(_items_of(per_doc.select("windows").distinct(), items), "windows").drop("windows")
    per_doc = per_doc.select(*(F.col(c).alias(f"_{c}") for c in per_doc.columns))
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("key") == F.col("_key"))
    every = rows.select("doc_id", "key", F.size("words").cast("long").alias("n_words"))
    n_hit = F.coalesce("_n_hit", F.lit(0)).cast("long")
    item_ids = F.coalesce("_item_ids", F.array().cast("array<string>"))
    return every.join(per_doc, same, "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(item_ids).cast("long").alias("n_items"),
        item_ids.alias("item_ids"),
        (n_hit > 0).alias("contaminated"),
    )


def item_windows(
    benchmark: DataFrame, item_col: str, text_col: str, window_words: int
) -> tuple[DataFrame, DataFrame]:
    """The different windows (window_id, window, n), and the items they come from (window_id, item_id)."""
    items = benchmark.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item_id"), words(F.coalesce(F.col(text_col), F.lit(""))).alias("words")
    )
    n = F.size("words")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), n - window_words + 1)))
    placed = items.where(n > 0).select("item_id", "words", starts.alias("first"))
    placed = placed.select("item_id", F.slice("words", F.col("first"), F.lit(window_words)).alias("window"))
    # The numbers are final once written.
    different = placed.select("window").distinct()
    windows = cut_lineage(different.select(F.monotonically_increasing_id().alias("window_id"), "window", F.size("window").alias("n")))
    return windows, stored(placed.join(windows, "window").select("window_id", "item_id").distinct())


def _items_of(sets: DataFrame, items: DataFrame) -> DataFrame:
    """For each different set of windows (windows), the sorted ids of all items they come from (item_ids).

    Documents that share all their windows share one list, however many they are.
    """
    named = sets.select("windows", F.explode("windows").alias("window_id")).join(items, "window_id")
    return named.groupBy("windows").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))


def occurrences(rows: DataFrame, windows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, key, start, end, window_id of each occurrence of a window in ``rows`` (doc_id, key, words)."""
    size = F.least(F.lit(SHINGLE_WORDS), F.col("n"))
    shingles = windows.select(
        "window", "n", "window_id", size.alias("size"), F.explode(F.sequence(F.lit(0), F.col("n") - size)).alias("offset")
    )
    hashes = [_shingle(F.col("window"), F.col("offset"), k) for k in range(1, SHINGLE_WORDS + 1)]
    shingles = cut_lineage(shingles.withColumn("shingle", F.element_at(F.array(*hashes), F.col("size"))))
    # At most SHINGLE_WORDS different sizes, and in practice one.
    sizes = [row["size"] for row in shingles.select("size").distinct().orderBy("size").collect()]
    parts = []
    for k in sizes:
        of_size = shingles.where(F.col("size") == k)
        wanted = of_size.select("shingle").distinct()
        counts = [
            _positions(rows, k).select("shingle").join(F.broadcast(block), "shingle").groupBy("shingle").count()
            for block in _blocks(wanted, block_rows)
        ]
        counts = cut_lineage(reduce(DataFrame.unionByName, counts))
        # The rarest shingle of each window; a window with one that no document has cannot occur.
        ordered = of_size.join(counts, "shingle", "left").withColumn("count", F.coalesce("count", F.lit(0)))
        prefix = ordered.groupBy("window", "n", "window_id").agg(
            F.min(F.struct("count", "shingle", "offset")).alias("rarest")
        )
        prefix = prefix.where("rarest.count > 0").select("window", "n", "window_id", "rarest.shingle", "rarest.offset")
        for block in _blocks(cut_lineage(prefix), block_rows):
            parts.append(_verified(_positions(rows, k), block))
    if not parts:
        nothing = [F.lit(None).cast(kind).alias(name) for name, kind in _OCCURRENCE.items()]
        return rows.select("doc_id", "key", *nothing).where(F.lit(False))
    return reduce(DataFrame.unionByName, parts)


def _shingle(words: Column, at: Column, size: int) -> Column:
    return F.xxhash64(*(F.get(words, at + i) for i in range(size)))


def _positions(rows: DataFrame, size: int) -> DataFrame:
    """Each position of each document with the hash of its shingle."""
    exploded = rows.select("doc_id", "key", "words", F.posexplode("words").alias("pos", "word"))
    rest = (F.get("words", F.col("pos") + i) for i in range(1, size))
    return exploded.select("doc_id", "key", "words", "pos", F.xxhash64("word", *rest).alias("shingle"))


def _verified(positions: DataFrame, prefix: DataFrame) -> DataFrame:
    prefix = prefix.withColumnRenamed("shingle", "prefix")
    start = F.col("pos") - F.col("offset")
    candidate = F.col("shingle") == F.col("prefix")
    bounds = (start >= 0) & (start + F.col("n") <= F.size("words"))
    # Guarded, as a slice cannot start before the first word.
    same = F.when(bounds, F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("n")) == F.col("window"))
    matches = positions.join(F.broadcast(prefix), candidate & same)
    return matches.select("doc_id", "key", start.alias("start"), (start + F.col("n")).alias("end"), "window_id")


def _blocks(table: DataFrame, block_rows: int) -> list[DataFrame]:
    """``table`` in parts of about ``block_rows`` rows; one job counts it."""
    n = max(1, -(-table.count() // block_rows))
    return [table.where(F.pmod(F.xxhash64("shingle"), F.lit(n)) == i) if n > 1 else table for i in range(n)]


def _covered(spans: Column) -> Column:
    """Number of positions in a union of spans; there are at most a few for each word of a document."""
    step = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("reach")),
        lambda acc, span: F.struct(
            (acc["sum"] + F.greatest(F.lit(0), span["end"] - F.greatest(span["start"], acc["reach"]))).alias("sum"),
            F.greatest(acc["reach"], span["end"]).alias("reach"),
        ),
    )
    return step["sum"]
