"""Near duplicates: SuperMinHash signatures, banding, verification on full sets, and grouping.

A document is the set of its word shingles. Documents with the same set are one node. Signatures are cut
into bands; documents that agree in a band are candidates, and candidates that hang together form a
coarse group, so that every link lies inside one. Inside coarse groups full sets are compared, in pairs of
blocks of bounded size, and each pair of blocks returns a spanning forest of its links rather than all
of them. The components of the links are the groups of near duplicates.

SuperMinHash deals an element's ranks out along a random permutation of the signature: in round j its value
is between j and j + 1. A place that was reached in an earlier round can't change in a later one, so the
rounds stop when all places are filled: after one or two for long documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrail.llm.common import cut_lineage, documents, stored
from snaptrail.llm.components import components, components_within
from snaptrail.llm.ngrams import LOWER, texts

SHINGLE_WORDS = 5

# A pair as similar as 0.85 agrees in no band with a probability of 6e-9, one of 0.8 with 5e-6.
BANDS = 40
BAND_ROWS = 6

# Nodes of a block; a task holds the sets of two blocks.
BLOCK_NODES = 512

# The links of coarse groups of up to so many blocks are connected by node ids in few tasks, TASK_LINKS in each.
GROUP_BLOCKS = 200

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the SplitMix64 finalizer)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of the distinct word shingles of a text, sorted. Words are cut at ASCII white space."""

    _base = np.uint64(0x5851F42D4C957F2D)
    _inverse = np.uint64(pow(0x5851F42D4C957F2D, -1, 1 << 64))
    _blank = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
    _values = mixed(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)

    def __init__(self, words: int = SHINGLE_WORDS):
        self.words = words
        self.factors = mixed(np.arange(1000, 1000 + words, dtype=np.uint64)) | np.uint64(1)
        self._powers(1 << 16)

    def _powers(self, n: int) -> None:
        ones = np.ones(n, np.uint64)
        self.power, self.inverse = ones * self._base, ones * self._inverse
        self.power[0] = self.inverse[0] = 1
        self.power, self.inverse = np.cumprod(self.power), np.cumprod(self.inverse)

    def __call__(self, text: np.ndarray) -> np.ndarray:
        if len(text) >= len(self.power):
            self._powers(2 * len(text))
        blank = np.concatenate([[True], self._blank[text], [True]])
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return np.zeros(0, np.uint64)
        # Hash of a prefix, by which that of a word is a difference.
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self._values[LOWER[text]] * self.power[: len(text)])])
        hashes = mixed((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        n = max(1, len(hashes) - self.words + 1)
        size = min(self.words, len(hashes))
        shingles = np.full(n, np.uint64(size))
        for i in range(size):
            shingles += hashes[i : i + n] * self.factors[i]
        return np.unique(mixed(shingles))


def signature(elements: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash of a set of well-mixed 64-bit integers: round and rank of each place's minimum."""
    places = np.full(size, np.iinfo(np.uint64).max)
    permutation = None
    for j in range(size):
        drawn = mixed(elements + np.uint64((j + 1) * int(_GOLDEN) % (1 << 64)))
        rank = (np.uint64(j) << np.uint64(32)) | (drawn >> np.uint64(32))
        k = j + (((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(size - j)) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            first, place = k, k
        else:
            if permutation is None:
                # The swap of round 0, which most documents never need.
                permutation = np.tile(np.arange(size, dtype=np.int16), (len(elements), 1))
                every = np.arange(len(elements))
                permutation[every, first] = 0
                permutation[every, 0] = first
            place = permutation[every, k]
            permutation[every, k] = permutation[:, j]
            permutation[:, j] = place
        np.minimum.at(places, place, rank)
        if places.max() < np.iinfo(np.uint64).max:
            break
    return places


def band_keys(places: np.ndarray, bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    factors = mixed(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
    keys = mixed(places).reshape(bands, rows) * factors
    return mixed(keys.sum(axis=1, dtype=np.uint64) + mixed(np.arange(bands, dtype=np.uint64) + np.uint64(7)))


def _described(rows: DataFrame, bands: int, band_rows: int) -> DataFrame:
    """doc_id, fingerprint of the set (two integers), n_shingles, bands."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        salts = mixed(np.arange(1, 3, dtype=np.uint64) * _GOLDEN)
        for batch in batches:
            prints, sizes, keys = [], [], []
            for text in texts(batch["text"]):
                shingles = shingler(text)
                prints.append([mixed(shingles ^ salt).sum(dtype=np.uint64) for salt in salts])
                sizes.append(len(shingles))
                found = band_keys(signature(shingles, bands * band_rows), bands, band_rows) if len(shingles) else ()
                keys.append(np.asarray(found, np.uint64).view(np.int64))
            prints = np.array(prints, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(prints[:, 0]),
                    pa.array(prints[:, 1]),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                ["doc_id", "print_a", "print_b", "n_shingles", "bands"],
            )

    schema = "doc_id long, print_a long, print_b long, n_shingles long, bands array<long>"
    return rows.mapInArrow(describe, schema)


def near_groups(
    docs: DataFrame,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: int = BANDS,
    band_rows: int = BAND_ROWS,
    block_nodes: int = BLOCK_NODES,
    group_blocks: int = GROUP_BLOCKS,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Documents are linked when 100 * intersection >= percent * union of their sets of five-word shingles
    (A-Z lower-cased; a text of fewer words is one shingle). ``component_id`` is the smallest doc_id that
    links reach; the document that has it is kept. Null texts and texts without words have no shingles
    and are linked with nothing. Rows that share an id are one document with all their texts. Rows
    without an id are linked with nothing, have no component_id and are kept. An empty table gives an
    empty result.

    Ids must be integers. Equality of shingles is that of their 64-bit hashes.
    """
    rows = documents(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    described = stored(_described(rows, bands, band_rows))
    named = described.where("doc_id IS NOT NULL AND n_shingles > 0")
    # One node per different set: the smallest id that has it.
    sets = named.groupBy("print_a", "print_b").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"))
    sets = stored(sets)
    placed = cut_lineage(_placed(components(_candidates(sets)), block_nodes))
    links = _links(rows, placed, percent)
    several = _several(named)
    if several.isEmpty() and placed.where(F.col("blocks") > group_blocks).isEmpty():
        groups = components_within(links, "component")
    else:
        groups = components(links.select("a", "b").unionByName(_same_id(named, sets, several)))
    own = named.select("doc_id", "print_a", "print_b").join(sets.select("print_a", "print_b", "node"), ["print_a", "print_b"])
    # All texts of an id are in one component, so the smallest of any of them is it.
    own = own.join(groups, "node", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "node")).alias("component"))
    result = described.select("doc_id", "n_shingles").join(own, "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return result.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))


def _several(named: DataFrame) -> DataFrame:
    """Ids that repeat with different sets."""
    prints = F.struct("print_a", "print_b")
    ends = named.groupBy("doc_id").agg(F.min(prints).alias("low"), F.max(prints).alias("high"))
    return ends.where("low <> high").select("doc_id")


def _same_id(named: DataFrame, sets: DataFrame, several: DataFrame) -> DataFrame:
    """Edges between the sets of an id that repeats with different texts."""
    repeated = named.join(several, "doc_id").join(sets.select("print_a", "print_b", "node"), ["print_a", "print_b"])
    return repeated.select(F.col("node").alias("a"), F.col("doc_id").alias("b"))


def _candidates(sets: DataFrame) -> DataFrame:
    """Edges from each node to the smallest node of its bucket."""
    keyed = sets.select("node", F.explode("bands").alias("band"))
    smallest = keyed.groupBy("band").agg(F.min("node").alias("a"), F.max("node").alias("largest"))
    shared = smallest.where("a < largest").select("band", "a")
    return keyed.join(shared, "band").where("node <> a").select("a", F.col("node").alias("b")).distinct()


def _placed(coarse: DataFrame, block_nodes: int) -> DataFrame:
    """Each node of a coarse group in one of its blocks."""
    sizes = coarse.groupBy("component").agg(F.count("*").alias("nodes"))
    placed = coarse.join(sizes, "component").withColumn("blocks", F.ceil(F.col("nodes") / block_nodes).cast("int"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    return placed.select(F.col("node").alias("doc_id"), "component", "blocks", block.alias("block"))


def _links(rows: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """Verified links (component, a, b) that connect what all links inside coarse groups connect."""
    shingled = rows.join(placed, "doc_id").mapInArrow(
        _shingled, "doc_id long, component long, blocks int, block int, shingles binary"
    )
    # A block meets each other block of its group, and itself, in a task of their own.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = shingled.select("doc_id", "component", "block", "shingles", other)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    pairs = pairs.select("doc_id", "component", low.alias("low"), high.alias("high"), "block", "shingles")

    def verify(table: pa.Table) -> pa.Table:
        nodes = table["doc_id"].to_numpy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table["shingles"]]
        found = forest(nodes, sets, table["block"].to_numpy(), percent)
        group = pa.array([table["component"][0].as_py()] * len(found), pa.int64())
        ends = (pa.array([link[i] for link in found], pa.int64()) for i in range(2))
        return pa.Table.from_arrays([group, *ends], ["component", "a", "b"])

    schema = "component long, a long, b long"
    return pairs.groupBy("component", "low", "high").applyInArrow(verify, schema)


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        sets = pa.array([shingler(text).tobytes() for text in texts(batch["text"])], pa.binary())
        columns = ["doc_id", "component", "blocks", "block"]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in columns), sets], [*columns, "shingles"])


def forest(nodes: np.ndarray, sets: list[np.ndarray], block: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links of two blocks, without those that connect what is connected.

    Pairs inside a block are compared where the block meets itself, so two blocks compare across only.
    """
    two = len(np.unique(block)) == 2
    lengths = np.array([len(s) for s in sets])
    order = np.argsort(lengths, kind="stable")
    nodes, sets, block, lengths = nodes[order], [sets[i] for i in order], block[order], lengths[order]
    vocabulary, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(lengths)
    marked = np.zeros(len(vocabulary), dtype=np.int32)
    root = np.arange(len(nodes))
    found = []
    for i in range(len(nodes) - 1):
        # Longer sets up to 100 / percent times as long can be similar enough.
        last = np.searchsorted(lengths, lengths[i] * 100 // percent, side="right")
        others = np.arange(i + 1, last)
        others = others[(root[others] != root[i]) & ((block[others] != block[i]) | (not two))]
        if not len(others):
            continue
        own = flat[ends[i] - lengths[i] : ends[i]]
        marked[own] = 1
        first = others[0]
        start = ends[first] - lengths[first]
        shared = np.add.reduceat(marked[flat[start : ends[last - 1]]], ends[first:last] - lengths[first:last] - start)
        marked[own] = 0
        shared = shared[others - first]
        similar = others[100 * shared >= percent * (lengths[i] + lengths[others] - shared)]
        for j in similar:
            if root[j] != root[i]:
                found.append((int(nodes[i]), int(nodes[j])))
                root[root == root[j]] = root[i]
    return found
