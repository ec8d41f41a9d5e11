"""Connected components of a graph that is given by its edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrail.llm.common import cut_lineage

# Links that one task connects, of a group or of a part of its links.
TASK_LINKS = 50_000


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node that can be reached) for every node of ``edges`` (a, b).

    Each round hooks the root of either end of an edge to the smaller one, and halves the paths to roots.
    Hubs are no problem: minima are taken before the shuffle, and Spark splits the hot keys of joins.
    Rounds grow with the logarithm of the longest path.
    """
    edges = cut_lineage(edges.select("a", "b").where("a <> b").distinct())
    parents = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    parents = cut_lineage(parents.withColumn("parent", F.col("node")))
    while not edges.isEmpty():
        # Every edge is one between roots here.
        hooks = edges.select(F.greatest("a", "b").alias("root"), F.least("a", "b").alias("smaller"))
        hooks = cut_lineage(hooks.groupBy("root").agg(F.min("smaller").alias("smaller")))
        roots = _flattened(hooks)
        parents = cut_lineage(_renamed(parents, "parent", roots))
        edges = _renamed(_renamed(edges, "a", roots), "b", roots).where("a <> b").distinct()
        edges = cut_lineage(edges)
    return parents.withColumnRenamed("parent", "component")


def _flattened(hooks: DataFrame) -> DataFrame:
    """root, smaller with ``smaller`` a root that is hooked to none; each round goes three hooks up."""
    while True:
        second = hooks.select(F.col("root").alias("smaller"), F.col("smaller").alias("second"))
        third = hooks.select(F.col("root").alias("second"), F.col("smaller").alias("third"))
        jumped = hooks.join(second, "smaller", "left").join(third, "second", "left")
        jumped = cut_lineage(jumped.select("root", F.coalesce("third", "second", "smaller").alias("smaller"), "third"))
        hooks = jumped.select("root", "smaller")
        if jumped.where("third IS NOT NULL").isEmpty():
            return hooks


def _renamed(table: DataFrame, column: str, roots: DataFrame) -> DataFrame:
    roots = roots.select(F.col("root").alias(column), "smaller")
    joined = table.join(roots, column, "left").withColumn(column, F.coalesce("smaller", column))
    return joined.select(*table.columns)


def components_within(edges: DataFrame, group: str, task_links: int = TASK_LINKS) -> DataFrame:
    """The same for edges that lie inside groups; no task gets the links of a group with more than ``task_links``.

    Links of a larger group are dealt into parts, each of which leaves a spanning forest, again and again
    while that at least halves them. Groups that are too large even then take rounds of joins.
    """

    def connected(table: pa.Table) -> pa.Table:
        nodes, root, _ = _united(table)
        return pa.table({"node": nodes, "component": nodes[root]})

    def spanning(table: pa.Table) -> pa.Table:
        return table.select([group, "a", "b"]).take(pa.array(_united(table)[2], pa.int64()))

    edges = cut_lineage(edges.select(group, "a", "b"))
    kind = edges.schema[group].dataType.simpleString()
    small, before = [], None
    while True:
        counts = edges.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("_links"))
        large = cut_lineage(counts.where(F.col("_links") > task_links))
        total = large.agg(F.sum("_links")).first()[0]
        if not total:
            small.append(edges)
            break
        within = edges.join(large, F.col(group) == F.col("_group"), "left_anti")
        small.append(within)
        edges = edges.join(large, F.col(group) == F.col("_group"))
        if before is not None and 2 * total > before:
            found = components(edges)
            break
        before = total
        parts = F.ceil(2 * F.col("_links") / task_links)
        parted = edges.select(group, "a", "b", F.pmod(F.xxhash64("a", "b"), parts).alias("_part"))
        parted = parted.groupBy(group, "_part").applyInArrow(spanning, f"{group} {kind}, a long, b long")
        edges = cut_lineage(parted)
    result = None if not total else found
    for part in small:
        part = part.groupBy(group).applyInArrow(connected, "node long, component long")
        result = part if result is None else result.unionByName(part)
    return result


def _united(table: pa.Table) -> tuple[np.ndarray, list[int], list[int]]:
    """Nodes in order, the place of each one's smallest reachable node, and the links that united two."""
    nodes, ends = np.unique(np.concatenate([table["a"].to_numpy(), table["b"].to_numpy()]), return_inverse=True)
    root, used = list(range(len(nodes))), []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for place, (a, b) in enumerate(ends.reshape(2, -1).T.tolist()):
        low, high = sorted((find(a), find(b)))
        if low != high:
            root[high] = low
            used.append(place)
    return nodes, [find(i) for i in range(len(nodes))], used
