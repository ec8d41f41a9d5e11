"""Removal of repeated byte strings, found by column-wise construction over aligned pieces of many documents.

A string of ``length`` bytes is repeated if it also starts earlier in the collection. Every such string
holds an anchor, the smallest of its short grams, which depends on nothing but the string, so equal strings
hold equal anchors at equal places. Anchors are gathered by value, each with the hash of all that can stand
around it in one string. Among equal surroundings only the first is not repeated, and what is left are
the few anchors whose surroundings differ.

Those are decided by construction over the collection of their pieces, column by column. Each round
inserts one symbol of every piece and renews the rank of its prefix among all pieces; the round in which
two pieces part is their common prefix. One such construction runs to the right of the anchors and one to
the left, and a string is repeated where the ranks on both sides agree with those of an earlier piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snaptrail.llm.common import documents, once, stored
from snaptrail.llm.near_dedup import mixed
from snaptrail.llm.ngrams import texts
from snaptrail.operators.numbering import numbered

LENGTH = 100

# A power of two; shorter grams meet by chance, longer ones make more anchors.
GRAM = 32

# Bytes of text whose anchors a task merges before it sends them.
CHUNK_BYTES = 48 << 20

# Pieces that are put in order at once, and more only if one anchor has more.
CHUNK_PIECES = 50_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)


class Anchors:
    """Anchors of a text: value and place of each, and the hash of all strings around it."""

    def __init__(self, length: int, gram: int):
        self.length, self.gram = length, gram
        self._powers(1 << 16)

    def _powers(self, n: int) -> None:
        def powers(base: int) -> np.ndarray:
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            return np.cumprod(factors)

        self.power, self.inverse = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))

    def __call__(self, text: np.ndarray) -> tuple[np.ndarray, ...]:
        """value, place, start and end of the surroundings, and their hash."""
        if len(text) < self.length:
            return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3, np.zeros(0, np.uint64))
        if len(text) >= len(self.power):
            self._powers(2 * len(text))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[text] * self.power[: len(text)])])
        n = len(text) - self.gram + 1
        grams = mixed((sums[self.gram :] - sums[:-self.gram]) * self.inverse[:n])
        width = self.length - self.gram + 1
        smallest = sliding(grams, width, np.minimum)
        pad = np.zeros(width - 1, np.uint64)
        largest = sliding(np.concatenate([pad, smallest, pad]), width, np.maximum)
        places = np.flatnonzero(largest == grams)
        starts = np.maximum(places - width + 1, 0)
        ends = np.minimum(places + self.length, len(text))
        around = mixed((sums[ends] - sums[starts]) * self.inverse[starts] + _GOLDEN * (places - starts).astype(np.uint64))
        around = mixed(around + (ends - places).astype(np.uint64))
        return grams[places], places, starts, ends, around


def sliding(values: np.ndarray, width: int, function: np.ufunc) -> np.ndarray:
    """``function`` over each ``width`` neighbours, by doubling."""
    done = 1
    while 2 * done <= width:
        values = function(values[:-done], values[done:])
        done *= 2
    return function(values[: len(values) - (width - done)], values[width - done :]) if done < width else values


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    chunk_bytes: int = CHUNK_BYTES,
    chunk_pieces: int = CHUNK_PIECES,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start, end) and kept (binary) for every row of ``docs``.

    Each byte is removed that a string of ``length`` bytes covers which also starts earlier: in a document
    with a smaller id, or in the same one before. All is judged on the input; matches never cross documents.
    Texts are UTF-8 bytes, null is empty. Rows that agree in id and text are one document. Different texts of
    one id stand one after the other, by SHA-256. Rows without an id come before all others. Ids may be of any
    type that Spark can order.
    """
    rows = _placed(documents(docs, id_col, text_col))
    # Copies of a row would find their own text repeated.
    single = once(rows, "doc")
    first = stored(_sorted_anchors(single, length, gram, chunk_bytes))
    spans = first.where("place IS NULL").select("doc", "start", "end")
    open_anchors = first.where("place IS NOT NULL")
    spans = spans.unionByName(_decided(single, open_anchors, length, gram, chunk_pieces))
    by_text = _by_text(spans)
    joined = rows.join(by_text, "doc", "left")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _cut,
        f"doc_id {id_type}, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary",
    )


def _by_text(spans: DataFrame) -> DataFrame:
    """Spans of one text together; they are as many as its anchors at most."""
    return spans.groupBy("doc").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def _placed(rows: DataFrame) -> DataFrame:
    """Adds ``doc``, a long by which different texts are told apart and ordered.

    That is the id, if each row has one of its own and it is an integer. Otherwise it is a text's number in
    the order of ids, rows without one first, and of the texts' SHA-256.
    """
    integer = rows.schema["doc_id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    repeated = rows.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL")
    if integer and repeated.isEmpty():
        return rows.withColumn("doc", F.col("doc_id").cast("long"))
    rows = rows.withColumn("hash", F.sha2("text", 256))
    different = rows.select(F.col("doc_id").alias("_id"), F.col("hash").alias("_hash")).distinct()
    different = stored(numbered(different, "_id", "_hash", column="doc"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash"))
    return rows.join(different, same).select("doc_id", "text", "doc")


_ANCHOR_SCHEMA = "value long, around long, doc long, place long, start long, end long"
_ANCHOR_COLUMNS = ["value", "around", "doc", "place", "start", "end"]


def _sorted_anchors(rows: DataFrame, length: int, gram: int, chunk_bytes: int) -> DataFrame:
    """Spans known to be repeated (place is null), and first anchors of values with several surroundings."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, parts, size = Anchors(length, gram), [], 0
        for batch in batches:
            for text, doc in zip(texts(batch["text"]), batch["doc"].to_pylist()):
                value, place, start, end, around = anchors(text)
                if len(value):
                    where = np.array([place, start, end], np.int64)
                    parts.append((value, around, np.full(len(value), doc, np.int64), *where))
                size += len(text)
                if size >= chunk_bytes:
                    yield from _combined(parts)
                    parts, size = [], 0
        yield from _combined(parts)

    def _combined(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        """Of equal surroundings in a chunk the first is sent; others are repeated for sure."""
        if parts:
            value, around, doc, place, start, end = (np.concatenate(column) for column in zip(*parts))
            order = np.lexsort((place, doc, around, value))
            value, around, doc, place, start, end = (c[order] for c in (value, around, doc, place, start, end))
            repeated = np.concatenate([[False], (value[1:] == value[:-1]) & (around[1:] == around[:-1])])
            yield from _batches(
                [c[~repeated] for c in (value.view(np.int64), around.view(np.int64), doc, place, start, end)]
            )
            yield from _batches(_spans(doc[repeated], start[repeated], end[repeated]), spans=True)

    def _spans(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
        long_enough = end - start >= length
        doc, start, end = merged(doc[long_enough], start[long_enough], end[long_enough])
        return [mixed(doc.view(np.uint64) ^ start.view(np.uint64)).view(np.int64), np.zeros_like(doc), doc, doc, start, end]

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted; one anchor is held back until it is known whether its value has other surroundings."""
        held: list[np.ndarray] | None = None
        shown = False
        for batch in batches:
            is_span = batch["place"].is_null().to_numpy(zero_copy_only=False)
            columns = [batch[c].fill_null(0).to_numpy() if c == "place" else batch[c].to_numpy() for c in _ANCHOR_COLUMNS]
            yield from _batches([c[is_span] for c in columns], spans=True)
            columns = [c[~is_span] for c in columns]
            carried = held is not None
            if carried:
                columns = [np.concatenate([h, c]) for h, c in zip(held, columns)]
            value, around, doc, place, start, end = columns
            if not len(value):
                continue
            same_value = np.concatenate([[False], value[1:] == value[:-1]])
            repeated = same_value & np.concatenate([[False], around[1:] == around[:-1]])
            yield from _batches(_spans(doc[repeated], start[repeated], end[repeated]), spans=True)
            lead = np.flatnonzero(~repeated)
            # ``open`` leads share their value with a lead before or after.
            value_of, with_before = value[lead], same_value[lead]
            with_before[0] |= carried and shown
            with_after = np.concatenate([with_before[1:] & (value_of[1:] == value_of[:-1]), [False]])
            is_open = with_before | with_after
            last = lead[-1]
            sent = lead[is_open]
            # The last lead stays until the next batch; what was sent of it is not sent again.
            sent = sent[(sent != last)] if not carried or not shown else sent[(sent != last) & (sent != 0)]
            yield from _batches([c[sent] for c in columns])
            last_open = bool(is_open[-1])
            already = carried and shown and last == 0
            if last_open and not already:
                yield from _batches([c[last : last + 1] for c in columns])
            held, shown = [c[last : last + 1] for c in columns], last_open
        return

    raw = rows.select("doc", "text").mapInArrow(found, _ANCHOR_SCHEMA)
    ordered = raw.repartition("value").sortWithinPartitions("value", "around", "doc", "place")
    return ordered.mapInArrow(firsts, _ANCHOR_SCHEMA)


def _batches(columns: list[np.ndarray], spans: bool = False, rows: int = 100_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(columns[0]), rows):
        arrays = [pa.array(c[at : at + rows]) for c in columns]
        if spans:
            arrays[3] = pa.nulls(len(arrays[0]), pa.int64())
        yield pa.RecordBatch.from_arrays(arrays, _ANCHOR_COLUMNS)


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of spans that touch; those of one document must not differ by whole texts."""
    order = np.lexsort((end, start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    # Ends ascend with starts, as surroundings of anchors do.
    reach = end.copy()
    fresh = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])])
    first = np.flatnonzero(fresh)
    return doc[first], start[first], np.maximum.reduceat(end, first)


def _decided(rows: DataFrame, open_anchors: DataFrame, length: int, gram: int, chunk_pieces: int) -> DataFrame:
    """doc, start, end of what is repeated around anchors whose surroundings differ."""
    wanted = open_anchors.groupBy("doc").agg(F.collect_list(F.struct("value", "place")).alias("anchors"))
    holders = rows.join(wanted, "doc")
    side = length - gram

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["anchors"]
            ends = lists.offsets.to_numpy()
            values, places = (lists.values.field(i).to_numpy() for i in range(2))
            for text, doc, first, last in zip(texts(batch["text"]), batch["doc"].to_pylist(), ends[:-1], ends[1:]):
                padded = np.zeros(len(text) + 2 * side, np.uint8)
                padded[side : side + len(text)] = text
                at = places[first:last]
                pieces = padded[at[:, None] + np.arange(2 * side + gram)]
                left, right = np.minimum(at, side), np.minimum(len(text) - at - gram, side)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(values[first:last]),
                        pa.array(np.full(len(at), doc)),
                        pa.array(places[first:last]),
                        pa.array(left.astype(np.int32)),
                        pa.array(right.astype(np.int32)),
                        pa.array([piece.tobytes() for piece in np.delete(pieces, np.s_[side : side + gram], 1)], pa.binary()),
                    ],
                    ["value", "doc", "place", "left", "right", "piece"],
                )

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_values(batches, chunk_pieces):
            pieces = np.frombuffer(b"".join(table["piece"].to_pylist()), np.uint8).reshape(-1, 2 * side)
            value, doc, place, left, right = (table[c].to_numpy() for c in ("value", "doc", "place", "left", "right"))
            low, high = repeated_sides(value, doc, place, left, right, pieces, side)
            hit = np.flatnonzero(low >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[hit]), pa.array(place[hit] - low[hit]), pa.array(place[hit] + gram + high[hit])],
                ["doc", "start", "end"],
            )

    pieces = holders.select("doc", "text", "anchors").mapInArrow(
        cut, "value long, doc long, place long, left int, right int, piece binary"
    )
    return pieces.repartition("value").sortWithinPartitions("value").mapInArrow(decide, "doc long, start long, end long")


def whole_values(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Tables of at least ``rows`` rows, cut between values only."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(map(len, waiting)) >= rows:
            table = pa.Table.from_batches(waiting)
            value = table["value"].to_numpy()
            cut = int(np.searchsorted(value, value[-1]))
            if cut:
                yield table.slice(0, cut)
            waiting = table.slice(cut).to_batches()
    if waiting:
        yield pa.Table.from_batches(waiting)


def repeated_sides(
    value: np.ndarray,
    doc: np.ndarray,
    place: np.ndarray,
    left: np.ndarray,
    right: np.ndarray,
    pieces: np.ndarray,
    side: int,
) -> tuple[np.ndarray, np.ndarray]:
    """How far to the left and right of its anchor each piece is repeated; -1 on the left if it is not.

    ``pieces`` holds ``side`` bytes before and after the anchor, of which ``left`` and ``right`` are text.
    """
    order = np.lexsort((place, doc, value))
    value, left, right, pieces = value[order], left[order], right[order], pieces[order]
    n = len(value)
    ranks = np.cumsum(np.concatenate([[0], value[1:] != value[:-1]])).astype(np.int64)

    def inserted(ranks: np.ndarray, symbol: np.ndarray, ended: np.ndarray) -> np.ndarray:
        """Ranks of prefixes with one more symbol; a prefix that left its text equals no other."""
        keys = ranks * 257 + np.where(ended, 256, symbol)
        distinct, new = np.unique(keys, return_inverse=True)
        return np.where(ended, len(distinct) + np.arange(n), new)

    rights = [ranks]
    for j in range(side):
        rights.append(inserted(rights[-1], pieces[:, side + j], right <= j))
    rights = [r.astype(np.int32) for r in rights]
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    lefts = ranks
    for j in range(side + 1):
        if j:
            lefts = inserted(lefts, pieces[:, side - j], left < j)
        keys = lefts * (2 * n + 1) + rights[side - j]
        _, first, member = np.unique(keys, return_index=True, return_inverse=True)
        repeated = first[member] != np.arange(n)
        low[repeated] = j
        high[repeated & (high < 0)] = side - j
    back = np.empty(n, np.int64)
    back[order] = np.arange(n)
    return low[back], high[back]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        sizes, removed, spans, kept = [], [], [], []
        for text, found in zip(texts(batch["text"]), batch["spans"].to_pylist()):
            change = np.zeros(len(text) + 1, np.int32)
            for span in found or ():
                change[span["start"]] += 1
                change[span["end"]] -= 1
            gone = np.cumsum(change[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            sizes.append(len(text))
            removed.append(int(gone.sum()))
            spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])])
            kept.append(text[~gone].tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(kind)), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
        )
