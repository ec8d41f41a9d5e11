"""Tries of conversations against one that is built prefix by prefix."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from snaptrail.llm import queries as llm
from snaptrail.llm.prefix_trie import prefix_nodes, shared_starts, turn_ids

SF_DIR = "/root/testdata/sf0.001"
TURNS = "conv_id long, turn long, role string, text string"


def branched(rows):
    """Conversations of the query's contract: ids and their lists of (role, text)."""
    turns = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            turns[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(found)] for c, found in turns.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in own}
    return {c: own.get(c - c % 100, [])[: heads[c]] + own[c][heads[c] :] for c in own}


def brute_nodes(convs):
    members = defaultdict(list)
    for c in sorted(convs):
        for d in range(len(convs[c]) + 1):
            members[tuple(convs[c][:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, inside in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(inside) - 1) * len(path[-1][1]) if path else 0
    ends = {path: [c for c in inside if len(convs[c]) == len(path)] for path, inside in members.items()}
    return sorted(
        (
            inside[0],
            len(path),
            members[path[:-1]][0] if path else None,
            len(inside),
            children[path],
            leaves[path],
            saved[path],
            hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest(),
        )
        for path, inside in members.items()
    )


def collected(df):
    return sorted(tuple(row) for row in df.collect())


@pytest.mark.parametrize("width", [2, 8])
def test_nodes_equal_brute_force(spark, width):
    random.seed(width)
    convs = {}
    for c in range(60):
        start = convs[random.randrange(c)] if c else []
        start = start[: random.randint(0, len(start))]
        convs[c] = start + [(random.choice("ua"), random.choice(["x", "éé", ""])) for _ in range(random.choice([0, 1, 2, 9]))]
    convs |= {100 + i: [("u", "same")] * 13 for i in range(5)} | {200: [("u", str(i)) for i in range(40)]}
    rows = [(c, i, role, text) for c, turns in convs.items() for i, (role, text) in enumerate(turns)]
    ids = turn_ids(spark.createDataFrame(rows, TURNS).repartition(5))
    none = [(c, None, None, None) for c, turns in convs.items() if not turns]
    ids = ids.union(spark.createDataFrame(none, "conv_id long, place long, turn_id long, n_chars long"))
    assert collected(prefix_nodes(ids, width)) == brute_nodes(convs)


def test_edges(spark):
    """Null turns first, null roles and texts, repeated rows, rows of no conversation, clashing columns, empty tables."""
    rows = [(7, 2, None, "b"), (7, None, "user", None), (7, 2, None, "b"), (8, 1, "user", ""), (8, 2, "", "b"), (8, 3, "", "b")]
    rows += [(None, 1, "user", "of none")] + [(105, i, "user", "long " * 20_000) for i in range(3)] + [(100, 1, None, None)]
    rows += [(c, 5, "user", f"own {c}") for c in range(200, 300, 7)]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS + ", block int, prior string, number int")
    assert collected(prefix_nodes(shared_starts(turn_ids(table.repartition(3))))) == brute_nodes(branched(rows))
    for empty in (table.limit(0), table.where("conv_id IS NULL")):
        assert prefix_nodes(shared_starts(turn_ids(empty))).collect() == []


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/conversations.parquet").select(*"conv_id turn role text".split()).collect()]
    found = llm.queries()["op13_prefix_trie"](spark, SF_DIR)
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    assert found.columns == names and [kind for _, kind in found.dtypes] == ["bigint"] * 7 + ["string"]
    assert collected(found) == brute_nodes(branched(rows))
