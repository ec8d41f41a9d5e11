"""The trie of all prefixes of all conversations, by ROLLUP over positional columns of turn ids.

Equal turns (role and text) get one integer id. The ids of a conversation stand side by side in blocks of
``width`` columns, and one ROLLUP over these columns aggregates all prefixes of a block together, its
``grouping_id`` telling how deep each is. Conversations that are longer than a block go on in the next one,
keyed by the node that the block before ended in. Conversations that are alone in their node share nothing
further down, so that the node of each of their blocks is known, and all of these are rolled up at once:
rounds are as many as the longest *shared* prefix has blocks.

A node is known by its smallest member and its depth. Sums over subtrees take a second ROLLUP, over the nodes
and over what conversations bring from their later blocks.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from snaptrail.llm.common import cut_lineage, shared_folder
from snaptrail.operators.numbering import numbered

# Turns of a block; a conversation of up to so many needs one round.
WIDTH = 8

# Conversations whose ids agree but for the last two digits may share a start of fewer than so many turns.
FAMILY = 100
STARTS = 6


def turn_ids(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, place (from 0), turn_id (from 1) and n_chars (code points of the text) of every turn.

    Turns are in the order of ``turn_col``, null first; those that tie are ordered by the SHA-256 of role and
    text. Null roles and texts are empty. Repeated rows are turns of their own. Rows without a conversation
    belong to none and are left out. Texts are hashed where they are read and never shuffled, and rows are
    placed in range partitions, so that a conversation of any length is spread over tasks.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.col(turn_col).alias("turn"),
        F.unhex(F.sha2(content, 256)).alias("digest"),
        F.length(text).cast("long").alias("n_chars"),
    )
    rows = cut_lineage(numbered(cut_lineage(rows), "conv_id", "turn", "digest"))
    ids = rows.groupBy("digest").agg(F.min("number").alias("turn_id"))
    firsts = rows.groupBy("conv_id").agg(F.min("number").alias("first"))
    place = (F.col("number") - F.col("first")).alias("place")
    return rows.join(ids, "digest").join(firsts, "conv_id").select("conv_id", place, "turn_id", "n_chars")


def shared_starts(ids: DataFrame) -> DataFrame:
    """Each conversation behind the first turns of its family's first one, in the form of ``turn_ids``.

    Conversation c takes the first h turns of conversation c - c % FAMILY (all if it has fewer, none if there
    is no such), h being the CRC-32 of c in decimal modulo STARTS, and goes on with its own turns after its
    first h. One that is left without turns has one row, in which all but ``conv_id`` is null.
    """
    of_id = F.col("conv_id")
    convs = cut_lineage(ids.groupBy("conv_id").agg(F.count("turn_id").alias("n_own")))
    sizes = convs.select(of_id.alias("base"), F.col("n_own").alias("n_base"))
    convs = convs.withColumn("base", of_id - of_id % FAMILY)
    convs = convs.withColumn("h", F.crc32(of_id.cast("string").cast("binary")) % STARTS)
    convs = convs.join(sizes, "base", "left").withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0))))
    convs = cut_lineage(convs)
    place = F.col("place") - F.col("h") + F.col("shared")
    own = ids.join(convs, "conv_id").where("place >= h").select("conv_id", place.alias("place"), "turn_id", "n_chars")
    starts = ids.where((of_id % FAMILY == 0) & (F.col("place") < STARTS - 1))
    starts = starts.select(of_id.alias("base"), "place", "turn_id", "n_chars")
    taken = convs.join(starts, "base").where("place < h").select("conv_id", "place", "turn_id", "n_chars")
    nothing = (F.lit(None).cast("long").alias(c) for c in ("place", "turn_id", "n_chars"))
    turnless = convs.where("shared = 0 AND n_own <= h").select("conv_id", *nothing)
    return own.unionByName(taken).unionByName(turnless)


def prefix_nodes(ids: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per node, all counts long: conv_id (smallest member), depth, parent_conv_id (null for the root),
    n_convs (members), n_children, n_leaves (childless nodes of the subtree), saved (sum over the subtree of
    members but one, times ``n_chars`` of the node's last turn) and ends_sha256.

    ``ids`` has conv_id, place, turn_id and n_chars; a row with a null place is a conversation without turns,
    which is a member of the root only. ``ends_sha256`` hashes the ids of the conversations that end in the node,
    decimal, ascending, joined by commas. Repeated conversations are members of the same nodes. An empty table
    has no nodes. Members are never listed: they are counted, and the hash streams over sorted rows.
    """
    columns = [f"t{k + 1}" for k in range(width)]
    ids = cut_lineage(ids.select("conv_id", "place", "turn_id", "n_chars"))
    blocks = _blocks(ids, columns)

    # Top down: the nodes of each block, and the node each conversation reaches in it. What a round finds is
    # appended to tables, so that plans do not grow with rounds.
    rolled, keyed, reached = (_Rounds(ids.sparkSession) for _ in range(3))
    current = keyed.add(blocks.where("block = 0").withColumn("prior", F.lit(0).cast("long")))
    if current.isEmpty():
        return ids.sparkSession.createDataFrame([], NODES)
    later = F.col("length") > (F.col("block") + 1) * width
    while not current.isEmpty():
        nodes = rolled.add(_rolled_up(current, columns))
        nodes = nodes.select("block", "prior", "level", *columns, F.col("conv_id").alias("node"), "n_convs")
        level = F.least(F.col("length") - F.col("block") * width, F.lit(width)).cast("int")
        at = current.withColumn("level", level).join(nodes, ["block", "prior", "level", *columns])
        at = reached.add(at.select("conv_id", "block", "length", "node", "n_convs"))
        onward = at.where(later & (F.col("n_convs") > 1))
        onward = onward.select("conv_id", (F.col("block") + 1).alias("block"), F.col("node").alias("prior"))
        current = keyed.add(blocks.join(onward, ["conv_id", "block"]))
    alone = reached.all().where(later & (F.col("n_convs") == 1)).select("conv_id", F.col("block").alias("after"))
    tails = blocks.join(alone, "conv_id").where("block > after").drop("after")
    tails = keyed.add(tails.withColumn("prior", F.col("conv_id")))
    rolled.add(_rolled_up(tails, columns))
    ends = reached.all().where(~later).select("conv_id", "node", "length")
    ends = ends.unionByName(tails.where(~later).select("conv_id", F.col("conv_id").alias("node"), "length"))

    nodes = rolled.all().withColumn("depth", F.col("block") * width + F.col("level"))
    nodes = cut_lineage(nodes)
    owned = cut_lineage(nodes.groupBy("conv_id").agg(F.min("depth").alias("first")))
    parents = cut_lineage(_parents(nodes, owned, columns))
    children = parents.where("depth > 0").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")
    ).agg(F.count("*").alias("n_children"))
    sums = _subtrees(nodes, owned, keyed.all(), ids, columns)
    key = ["conv_id", "depth"]
    found = parents.join(children, key, "left").join(sums, key, "left")
    found = found.join(_digests(ends), key, "left")
    return found.select(
        *key,
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        # What is not summed has one member: one leaf, and nothing to save.
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved", F.lit(0).cast("long")).alias("saved"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long,"
    " ends_sha256 string"
)


class _Rounds:
    """A table in the folder all executors share, to which each round adds rows of one schema."""

    def __init__(self, spark: SparkSession):
        self.spark, self.path, self.count, self.schema = spark, f"{shared_folder(spark)}/{uuid.uuid4()}", 0, None

    def add(self, rows: DataFrame) -> DataFrame:
        """Store ``rows``; returns them as they are read back."""
        path, self.count, self.schema = f"{self.path}/round={self.count}", self.count + 1, rows.schema
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def all(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path).drop("round")


def _blocks(ids: DataFrame, columns: list[str]) -> DataFrame:
    """conv_id, block, length (of the conversation) and its turn ids side by side, 0 where there is none."""
    width = len(columns)
    block = F.coalesce(F.floor(F.col("place") / width), F.lit(0)).alias("block")
    at = [F.max(F.when(F.col("place") % width == k, F.col("turn_id"))) for k in range(width)]
    at = [F.coalesce(turn, F.lit(0).cast("long")).alias(c) for turn, c in zip(at, columns)]
    lengths = ids.groupBy("conv_id").agg(F.count("turn_id").alias("length"))
    return cut_lineage(ids.groupBy("conv_id", block).agg(*at).join(lengths, "conv_id"))


def _rollup(rows: DataFrame, columns: list[str], aggregates: str) -> DataFrame:
    """block, prior, level, the prefix (0 beyond ``level``) and ``aggregates`` of all prefixes that are nodes.

    The empty prefix is a node in the first block only; in others it is that of the block before.
    """
    turns = ", ".join(columns)
    found = rows.sparkSession.sql(
        f"SELECT block, prior, {len(columns)} - bit_count(grouping_id()) AS level, {turns}, {aggregates}"
        f" FROM {{rows}} GROUP BY block, prior, ROLLUP({turns})",
        rows=rows,
    )
    last = F.when(F.col("level") > 0, F.get(F.array(*columns), F.col("level") - 1))
    found = found.where((last != 0) | ((F.col("level") == 0) & (F.col("block") == 0)))
    prefix = (F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in columns)
    others = [c for c in found.columns if c not in columns]
    return found.select(*others, *prefix)


def _rolled_up(rows: DataFrame, columns: list[str]) -> DataFrame:
    return _rollup(rows, columns, "min(conv_id) AS conv_id, count(*) AS n_convs, max(length) AS longest")


def _parents(nodes: DataFrame, owned: DataFrame, columns: list[str]) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs.

    A conversation is the smallest member of the nodes of its path from some depth on. Only the first of them
    has a parent of another name, which is looked up by its prefix; it has two members at least.
    """
    nodes = nodes.join(owned, "conv_id")
    first, in_block = F.col("depth") == F.col("first"), (F.col("level") > 1) | (F.col("block") == 0)
    kept = ["conv_id", "depth", "n_convs"]
    known = F.when(F.col("depth") == 0, None).when(~first, F.col("conv_id")).otherwise(F.col("prior"))
    looked_up = first & in_block & (F.col("depth") > 0)
    rest = nodes.where(~looked_up).select(*kept, known.alias("parent_conv_id"))
    prefix = [F.when(F.col("level") == k + 1, 0).otherwise(F.col(c)).alias(c) for k, c in enumerate(columns)]
    tops = nodes.where(looked_up).select(*kept, "block", "prior", (F.col("level") - 1).alias("level"), *prefix)
    above = nodes.where("n_convs > 1").select(
        F.col("conv_id").alias("parent_conv_id"), "block", "prior", "level", *columns
    )
    tops = tops.join(above, ["block", "prior", "level", *columns])
    return rest.unionByName(tops.select(*rest.columns))


def _subtrees(
    nodes: DataFrame, owned: DataFrame, keyed: DataFrame, ids: DataFrame, columns: list[str]
) -> DataFrame:
    """conv_id, depth, n_leaves and saved of all nodes with several members, and of some with one.

    What a node saves is spread over its members: each but the smallest brings the node's characters. So what
    lies in later blocks is a sum over conversations, and what lies in the same block one over nodes.
    """
    width = len(columns)
    key = ["block", "prior", *columns]
    leaf = F.col("longest") == F.col("depth")
    chars = ids.select("conv_id", (F.col("place") + 1).alias("depth"), "n_chars")
    several = nodes.where("n_convs > 1").join(chars, ["conv_id", "depth"], "left")
    saves = F.coalesce((F.col("n_convs") - 1) * F.col("n_chars"), F.lit(0))
    at_nodes = several.select(*key, "conv_id", leaf.cast("long").alias("n_leaves"), saves.alias("saved"))
    single = nodes.where((F.col("n_convs") == 1) & leaf)
    at_leaves = single.select(*key, "conv_id", F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved"))

    onward = keyed.where(F.col("length") > (F.col("block") + 1) * width)
    leaves = nodes.where(leaf).select("conv_id", F.lit(1).cast("long").alias("n_leaves"))
    zero = F.lit(0).cast("long")
    # Characters that a conversation shares with a smaller one, beyond the first block.
    shared = ids.where(F.col("place") >= width).join(owned, "conv_id", "left").where("first IS NULL OR place + 1 < first")
    shared = shared.groupBy("conv_id", F.floor(F.col("place") / width).alias("of")).agg(F.sum("n_chars").alias("chars"))
    sharing = onward.join(shared, "conv_id", "left_semi").select("conv_id", "block", zero.alias("chars"))
    by_block = sharing.union(shared.select("conv_id", "of", "chars")).groupBy("conv_id", "block").agg(F.sum("chars").alias("chars"))
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    within = by_block.select("conv_id", "block", F.sum("chars").over(deeper).alias("saved"))
    later = onward.join(leaves, "conv_id", "left").join(within, ["conv_id", "block"], "left")
    later = later.select(
        *key,
        F.lit(None).cast("long").alias("conv_id"),
        F.coalesce("n_leaves", zero).alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved"),
    )
    rows = at_nodes.unionByName(at_leaves).unionByName(later)
    found = _rollup(rows, columns, "min(conv_id) AS conv_id, sum(n_leaves) AS n_leaves, sum(saved) AS saved")
    depth = (F.col("block") * width + F.col("level")).alias("depth")
    return found.where("conv_id IS NOT NULL").select("conv_id", depth, "n_leaves", "saved")


def _digests(ends: DataFrame) -> DataFrame:
    """conv_id and depth of each node that conversations end in, and the hash of these as ``ends_sha256``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, digest = None, None
        for batch in batches:
            done = []
            keys = list(zip(batch["node"].to_pylist(), batch["length"].to_pylist()))
            members = pc.cast(batch["conv_id"], pa.string()).to_pylist()
            starts = [i for i, key in enumerate(keys) if i == 0 or key != keys[i - 1]]
            for start, end in zip(starts, [*starts[1:], len(keys)]):
                listed = ",".join(members[start:end]).encode()
                if keys[start] == open_key:
                    digest.update(b"," + listed)
                    continue
                if open_key is not None:
                    done.append((*open_key, digest.hexdigest()))
                open_key, digest = keys[start], hashlib.sha256(listed)
            yield _batch(done)
        if open_key is not None:
            yield _batch([(*open_key, digest.hexdigest())])

    def _batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        types = (pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(column, kind) for column, kind in zip(columns, types)]
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", "depth", "ends_sha256"])

    ends = ends.select("node", "length", "conv_id")
    ordered = ends.repartition("node", "length").sortWithinPartitions("node", "length", "conv_id")
    return ordered.mapInArrow(hashed, "conv_id long, depth long, ends_sha256 string")
