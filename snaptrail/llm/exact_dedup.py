"""Exact duplicates by deterministic block naming.

A text is cut into blocks of a fixed number of characters. Equal blocks get the same integer name,
then adjacent pairs of names are named again, level by level, until one name stands for the whole
text. Two texts are equal exactly when they end with the same name on the same level.

Texts are compared by name, and names are given without collisions. Names of blocks are positions
in the sorted list of distinct blocks. A block finds its name through a seeded 128-bit digest, so
that its text is shuffled once only; the digest is used after it was shown, over all blocks, that
no two different blocks share it, and drawn again with the next seed otherwise.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaptrail.llm.common import cut_lineage, documents, lower_ascii, stored

# Characters of a block. Most texts are a block or two; a text of 1 GB needs 18 levels.
BLOCK_CHARS = 4096

# Stands for "no right neighbour"; names are never negative.
NOTHING = -1

# Rows of one key that a task writes at once.
PART_COPIES = 1 << 16

Digest = Callable[[Column, int], Column]


def digest128(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("a"), F.xxhash64(F.lit(2 * seed + 1), block).alias("b"))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
    digest: Digest = digest128,
) -> DataFrame:
    """One row per row of ``docs``: its group of equal texts and whether it is the one that stays.

    Columns: doc_id, keep_id (largest doc_id of the group), group_size (rows), kept, text_sha256.
    Texts are equal when identical after lower-casing A-Z only. Null texts are empty. An empty table
    gives an empty result. Rows that repeat both id and text all appear, and one of them is kept.
    Rows without an id count, and stay only if no row of their group has an id.
    """
    rows = documents(docs, id_col, text_col).withColumn("text", lower_ascii(F.col("text")))
    rows = rows.withColumn("sha", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    # The key of a row: its id, and what tells apart rows that share one. Equal rows are one key.
    keys = stored(rows.groupBy("doc_id", "sha").agg(F.count("*").alias("copies")))
    named = _identities(rows, block_chars, digest)
    groups = named.join(keys.select("doc_id", "sha", "copies"), _same_key(named, keys)).select(
        keys["doc_id"], keys["sha"], "copies", "level", "name"
    )
    groups = cut_lineage(groups)
    sizes = groups.groupBy("level", "name").agg(
        F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")
    )
    found = groups.join(cut_lineage(sizes), ["level", "name"])
    return _copies(found.select("doc_id", "keep_id", "group_size", "sha", "copies")).select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 0)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _copies(keys: DataFrame) -> DataFrame:
    """Each key as often as it has rows, numbered from 0 as ``copy``.

    A key of very many rows is first cut into parts, which are dealt out.
    """
    one = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    few = keys.where(F.col("copies") <= PART_COPIES).select("*", one)
    last = F.expr(f"(copies - 1) div {PART_COPIES}")
    parts = keys.where(F.col("copies") > PART_COPIES)
    parts = parts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("part")).repartition("sha", "part")
    first = F.col("part") * PART_COPIES
    in_part = F.explode(F.sequence(first, F.least(first + PART_COPIES, "copies") - 1)).alias("copy")
    return few.unionByName(parts.select("*", in_part).drop("part"))


def _same_key(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["sha"] == right["sha"])


def _identities(rows: DataFrame, block_chars: int, digest: Digest) -> DataFrame:
    """doc_id, sha, level, name: one row per key."""
    names, seed = _block_names(rows, block_chars, digest)
    symbols = (
        _blocks(rows, block_chars)
        .select("doc_id", "sha", "at", "blocks", digest(F.col("block"), seed).alias("digest"))
        .select("doc_id", "sha", "at", "blocks", "digest.*")
        .distinct()
        .join(names, ["a", "b"])
        .select("doc_id", "sha", "at", "blocks", "name")
    )
    symbols = cut_lineage(symbols)
    done = []
    for level in count():
        done.append(symbols.where("blocks = 1").select("doc_id", "sha", F.lit(level).alias("level"), "name"))
        symbols = symbols.where("blocks > 1")
        if symbols.isEmpty():
            break
        symbols = _named_pairs(symbols)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def _blocks(rows: DataFrame, block_chars: int) -> DataFrame:
    blocks = F.greatest(F.lit(1), F.ceil(F.length("text") / block_chars)).cast("int")
    return rows.select(
        "doc_id", "sha", "text", blocks.alias("blocks"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("at")
    ).select("doc_id", "sha", "blocks", "at", F.substring("text", F.col("at") * block_chars + 1, F.lit(block_chars)).alias("block"))


def _block_names(rows: DataFrame, block_chars: int, digest: Digest) -> tuple[DataFrame, int]:
    """The name of each distinct block by its digest, and the first seed without a collision.

    A name is the place of the block in its sorted partition, with the partition's number in front.
    """
    for seed in count():
        distinct = _blocks(rows, block_chars).select(digest(F.col("block"), seed).alias("digest"), "block").distinct()
        names = (
            distinct.sortWithinPartitions("block")
            .select("digest.*", F.monotonically_increasing_id().alias("name"))
        )
        names = stored(names)
        if names.groupBy("a", "b").count().where("count > 1").isEmpty():
            return names, seed


def _named_pairs(symbols: DataFrame) -> DataFrame:
    """Each two neighbours of a document become one symbol."""
    odd = F.col("at") % 2 == 1
    pairs = symbols.groupBy("doc_id", "sha", F.expr("at div 2").cast("int").alias("at")).agg(
        F.first("blocks").alias("blocks"),
        F.max(F.when(~odd, F.col("name"))).alias("left_name"),
        F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(NOTHING)).alias("right_name"),
    )
    pairs = cut_lineage(pairs)
    names = (
        pairs.select("left_name", "right_name")
        .distinct()
        .sortWithinPartitions("left_name", "right_name")
        .withColumn("name", F.monotonically_increasing_id())
    )
    half = F.expr("(blocks + 1) div 2").cast("int")
    named = pairs.join(cut_lineage(names), ["left_name", "right_name"])
    return cut_lineage(named.select("doc_id", "sha", "at", half.alias("blocks"), "name"))
