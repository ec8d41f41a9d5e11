"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Every source gets a target of words. Targets and documents are counted in blocks of equal size. The
blocks of the mix are apportioned to the sources by the highest quotients size / (2 seats + 1), those
of a source to parts of its shards, and those of a part to its shards, in the same way. A shard then selects its quota of blocks in a seeded
order of its documents: whole rounds over all blocks first, then the blocks at the front.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptrail.llm.common import cut_lineage

WEIGHTS = (1, 2, 3)

# No source and no document is used more often than this.
MAX_REPEATS = 3

# Words of a block. It bounds how far a source can be from its target, so it is small.
BLOCK_WORDS = 8

# Words of a shard, the unit that one task selects from.
SHARD_WORDS = 500_000

# Shards of a source that one task apportions. More of them are apportioned part by part.
PART_SHARDS = 4096

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")), F.lit(0)).cast(
        "long"
    )


def apportion(sizes: np.ndarray, seats: int, most: np.ndarray) -> np.ndarray:
    """Seats for parties of ``sizes`` by Sainte-Laguë, none above ``most``; ties go to the earlier party.

    The divisor is found by bisection, as the largest that still gives out all seats; what it gives out
    in excess are ties, of which the last are taken back. Seats beyond the sum of ``most`` stay empty.
    """
    sizes, most = np.asarray(sizes, dtype=float), np.asarray(most, dtype=np.int64)
    most = np.where(sizes > 0, most, 0)
    seats = min(int(seats), int(most.sum()))
    if seats <= 0:
        return np.zeros(len(sizes), dtype=np.int64)

    def given(quotient: float) -> np.ndarray:
        # Seat k (from 1) has the quotient size / (2 k - 1): those at or above ``quotient`` are won.
        return np.minimum(np.floor((sizes / quotient + 1) / 2), most).astype(np.int64)

    low, high = sizes[sizes > 0].min() / (2.0 * (seats + most.max()) + 2), 2 * sizes.max()
    while given(low).sum() < seats:
        low /= 2
    for _ in range(200):
        middle = (low + high) / 2
        if middle in (low, high):
            break
        low, high = (middle, high) if given(middle).sum() >= seats else (low, middle)
    won = given(low)
    excess = int(won.sum()) - seats
    if excess:
        last = sizes / np.maximum(2 * won - 1, 1)
        last[won == 0] = np.inf
        # Tied last seats, taken from the end of the list.
        order = np.lexsort((-np.arange(len(sizes)), last))
        won[order[:excess]] -= 1
    return won


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds ``target`` to one row per source (source, source_size).

    Sources in order of code points, null last, take ``weights`` in turn and share the sum of all sizes
    by them. No target exceeds ``max_repeats`` times the size of its source; what is cut off is shared
    by weight among the others, again and again. In one closed step: sources reach their limit in the
    order of limit / weight, so the first source that does not, marks all those that do.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    limits = sizes.withColumn("weight", weight.cast("double")).withColumn(
        "limit", F.lit(max_repeats).cast("double") * F.col("source_size")
    )
    by_reach = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source"))
    before = by_reach.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_reach.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest_words = F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    rest_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    shares = limits.withColumn("level", rest_words / rest_weight)
    free = F.col("limit") >= F.col("level") * F.col("weight")
    level = F.first(F.when(free, F.col("level")), ignorenulls=True).over(everything)
    return shares.withColumn(
        "target", F.least("limit", F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    ).select("source", "source_size", "target")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = 0,
    key_col: str | None = None,
) -> DataFrame:
    """doc_id, source, size, source_size, target and taken for every row of ``docs``, and ``key`` if it is named.

    ``size`` counts words, ``taken`` how many of them the mix takes, repeats counted. The sum of taken
    over a source is within a few blocks of its target, and never above ``max_repeats`` times its size;
    neither is it for any row. Null texts and texts of white space have no words and are never taken. A
    null source is a source of its own. Ties, and rows that repeat an id, are ordered by id, then by
    size; rows that agree in both are taken by ``key_col``, or without it in any order, which gives the same
    rows. An empty table gives an empty result.
    """
    key = [F.col(key_col).alias("key")] if key_col else []
    by_key = ["key"] if key_col else []
    words = word_count(F.col(text_col))
    # The text is part of it, so that rows without an id, or of one id, are spread over the shards.
    draw = F.xxhash64(F.lit(seed), F.col(id_col), words, F.col(text_col)).alias("draw")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words.alias("size"), draw, *key
    )
    rows = cut_lineage(rows)
    sized = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = targets(sized, weights, max_repeats)
    sources = _quotas(
        sources.withColumn("party", F.lit(0)), ["party"], "source", "target", "target", block_words, max_repeats, "blocks"
    ).drop("party")
    # Shards of about equal size; a source with a third of all rows has that share of all shards.
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))
    sources = cut_lineage(sources.withColumn("shards", shards))
    rows = _with(rows, sources, ["source"]).withColumn("shard", F.pmod(F.col("draw"), F.col("shards")))
    # Pre-aggregated before the shuffle: one row per shard.
    cells = rows.groupBy("source", "shard").agg(
        F.sum("size").alias("words"), F.first("blocks").alias("source_blocks")
    )
    cells = cut_lineage(cells.withColumn("part", F.floor(F.col("shard") / PART_SHARDS)))
    parts = cells.groupBy("source", "part").agg(
        F.sum("words").alias("words"), F.first("source_blocks").alias("source_blocks")
    )
    parts = _quotas(parts, ["source"], "part", "words", "source_blocks", block_words, max_repeats, "part_blocks")
    cells = _with(cells, parts.select("source", "part", "part_blocks"), ["source", "part"])
    cells = _quotas(cells, ["source", "part"], "shard", "words", "part_blocks", block_words, max_repeats, "quota")
    cells = cut_lineage(cells.select("source", "shard", "words", "quota"))
    rows = _with(rows, cells, ["source", "shard"])
    seeded = Window.partitionBy("source", "shard").orderBy(F.hash("draw"), "draw", "doc_id", "size", *by_key)
    before = F.coalesce(
        F.sum("size").over(seeded.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")
    )
    quota_words = F.least(F.col("quota") * block_words, F.col("words") * max_repeats)
    rounds = F.when(F.col("words") > 0, F.floor(quota_words / F.col("words"))).otherwise(0)
    front = F.greatest(F.lit(0), F.least(F.col("size"), quota_words - rounds * F.col("words") - before))
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (rounds * F.col("size") + front).cast("long").alias("taken"),
        *by_key,
    )


def _with(rows: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """Join on keys of which the source may be null; Spark splits hot keys of this join by itself."""
    side = side.select(*(F.col(c).alias(f"_{c}") if c in on else F.col(c) for c in side.columns))
    same = [rows[c].eqNullSafe(side[f"_{c}"]) for c in on]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return rows.join(side, condition).drop(*(f"_{c}" for c in on))


def _quotas(
    parties: DataFrame,
    house: list[str],
    party: str,
    size: str,
    total: str,
    block_words: int,
    max_repeats: int,
    name: str,
) -> DataFrame:
    """Apportion the blocks of each ``house`` to its parties by ``size``.

    For sources the house has as many blocks as all targets make up; below them, ``total`` is the number
    of blocks that a source, or a part of its shards, was given.
    """
    of_sources = party == "source"

    def apportioned(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(party, na_position="last", ignore_index=True)
        seats = round(group[total].sum() / block_words) if of_sources else int(group[total].iloc[0])
        words = group["source_size"] if of_sources else group["words"]
        most = -(-(words.to_numpy() * max_repeats) // block_words)
        group[name] = apportion(group[size].to_numpy(), seats, most)
        return group

    schema = parties.withColumn(name, F.lit(0).cast("long")).schema
    return parties.groupBy(*house).applyInPandas(_typed(apportioned, schema.names), schema)


def _typed(function: Callable[[pd.DataFrame], pd.DataFrame], names: list[str]):
    return lambda group: function(group)[names]
