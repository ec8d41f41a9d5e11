"""Preference formatting: the common start of two conversations as prompt, the rest as masked completions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a turn is written. What the reply itself consists of, its text and END, is learned; the rest is not.
START, AFTER_ROLE, END, AFTER_END = "<|", "|>\n", "<|end|>", "\n"

LEARNED_ROLE = "assistant"


def turn_lists(turns: DataFrame, key: str) -> DataFrame:
    """``key`` and ``turns``: the turns (turn, role, text) of each conversation in order.

    Null roles and texts are empty. Repeated rows of a turn count once; different ones follow each other by
    role and text. Turns without a number come first. Rows without a key belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    turn = F.struct(F.col("turn"), role, text)
    grouped = turns.where(F.col(key).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(turn)).alias("turns"))
    return grouped.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Format ``pairs`` (pair_id, chosen, rejected), the sides being arrays of (role, text).

    Adds n_prompt_turns, prompt, and for each side its completion and mask. The prompt is the longest run
    of turns at the start of both sides, rendered once. A mask is an array of (start, end), in characters
    of its completion, of what is to be learned: replies and their end marks. If one side is the start of
    the other, its completion is empty. A null side has no turns. Every row gives one row.
    """
    empty = F.array().cast("array<struct<role:string,text:string>>")
    sides = {side: F.coalesce(F.col(side), empty) for side in ("chosen", "rejected")}
    pairs = pairs.select("pair_id", *(turns.alias(side) for side, turns in sides.items()))
    both = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    different = F.array_position(both, False).cast("int")
    common = F.when(different > 0, different - 1).otherwise(F.size("chosen"))
    pairs = pairs.withColumn("n_prompt_turns", common)
    columns = [F.col("pair_id"), F.col("n_prompt_turns"), _text(F.slice("chosen", 1, F.col("n_prompt_turns"))).alias("prompt")]
    for side in ("chosen", "rejected"):
        rest = F.slice(side, F.col("n_prompt_turns") + 1, F.size(side))
        columns += [_text(rest).alias(side), _mask(rest).alias(f"{side}_mask")]
    return pairs.select(*columns)


def _opening(turn: Column) -> Column:
    return F.concat(F.lit(START), turn["role"], F.lit(AFTER_ROLE))


def _text(turns: Column) -> Column:
    parts = F.transform(turns, lambda t: F.concat(_opening(t), t["text"], F.lit(END + AFTER_END)))
    return F.array_join(parts, "")


def _mask(turns: Column) -> Column:
    """Spans of the learned parts, by adding up the lengths of turns."""
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(_opening(turn))
        end = start + F.length(turn["text"]) + len(END)
        span = F.struct(start.alias("start"), end.alias("end"))
        learned = F.when(turn["role"] == LEARNED_ROLE, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((end + len(AFTER_END)).alias("at"), learned.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
    return F.aggregate(turns, start, step, lambda state: state["spans"])


def swapped_replies(conversations: DataFrame) -> DataFrame:
    """Pairs (pair_id, chosen, rejected) out of plain conversations (conv_id, turn, role, text).

    Chosen is a conversation up to its last reply. Rejected has the last reply of its neighbour, conv_id
    XOR 1, in that place, and ends before it if the neighbour has none. Conversations without a reply make
    no pair.
    """
    lists = turn_lists(conversations, "conv_id")
    last = F.size("turns") - F.coalesce(
        F.array_position(F.reverse(F.transform("turns", lambda t: t["role"] == LEARNED_ROLE)), True), F.lit(0)
    ).cast("int") + 1
    answered = lists.where(F.exists("turns", lambda t: t["role"] == LEARNED_ROLE)).withColumn("last", last)
    replies = answered.select(
        F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.slice("turns", F.col("last"), F.lit(1)).alias("other")
    )
    rejected = F.concat(F.slice("turns", F.lit(1), F.col("last") - 1), F.coalesce("other", F.slice("turns", 1, 0)))
    chosen = F.slice("turns", F.lit(1), F.col("last"))
    return answered.join(replies, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"), chosen.alias("chosen"), rejected.alias("rejected")
    )
