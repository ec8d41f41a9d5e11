"""Duplicate word spans by relative Lempel-Ziv parsing: documents are factored against all indexed blocks.

The collection in ascending order of documents is the reference. Tasks cut it into blocks of documents and
index the phrases of each: around every word gram that is the smallest of some window of ``window`` words stand
the words that a window with it can hold. Equal windows have equal smallest grams at equal places, so whatever
repeats a window is found under the grams of it, whichever block it is in. Only those entries of all blocks are
asked, by a shuffle on the gram; to hold every document against every block would take documents times blocks.

A phrase that an earlier one equals is a match as a whole. Where a gram has several phrases, a match ends inside
of them: there, at the boundaries of factors, windows are looked up one by one in the same way. Matches that go
on in the same place of the reference are joined, and each document is parsed from left to right, greedily:
the match that reaches farthest is the next factor. Words outside of factors are kept.

Of equal phrases a block sends one, so that no key of a shuffle has more rows than there are blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from snaptrail.llm.common import documents, stored
from snaptrail.llm.near_dedup import mixed
from snaptrail.llm.ngrams import texts
from snaptrail.llm.repeats import sliding
from snaptrail.operators.numbering import numbered

# Words of a window.
WINDOW = 20

# Words of a gram; shorter ones meet by chance more often, longer ones make more phrases.
GRAM = 5

# Bytes of text of a block.
BLOCK_BYTES = 24 << 20

# Room for the words before and behind a gram's start, beside its place.
_SIDE_BITS = 12

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_BLANK = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


class Phrases:
    """Hashes of the words, grams, windows and phrases of a text."""

    def __init__(self, window: int = WINDOW, gram: int = GRAM):
        if not 0 < gram <= window < 1 << _SIDE_BITS:
            raise ValueError(f"a gram has 1 word at least, a window one gram at least and less than {1 << _SIDE_BITS} words")
        self.window, self.gram = window, gram
        self.factors = mixed(np.arange(1, 2 * window + 1, dtype=np.uint64) * _GOLDEN).reshape(2, window) | np.uint64(1)
        self._powers(1 << 16)

    def _powers(self, n: int) -> None:
        def powers(base: int) -> np.ndarray:
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            return np.cumprod(factors)

        self.power, self.inverse = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))

    def _sums(self, values: np.ndarray) -> np.ndarray:
        """Hashes of all prefixes; that of a part is a difference, times the inverse power of its start."""
        if len(values) >= len(self.power):
            self._powers(2 * len(values))
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.power[: len(values)])])

    def words(self, text: np.ndarray) -> np.ndarray:
        blank = np.concatenate([[True], _BLANK[text], [True]])
        edges = np.flatnonzero(blank[1:] != blank[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = self._sums(_BYTES[text])
        return mixed((sums[ends] - sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))

    def _grams(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Hash of each gram, the smallest of each window, and the grams of a window."""
        n = len(words) - self.gram + 1
        grams = np.zeros(n, np.uint64)
        for i in range(self.gram):
            grams += words[i : i + n] * self.factors[0, i]
        grams, width = mixed(grams), self.window - self.gram + 1
        return grams, sliding(grams, width, np.minimum), width

    def __call__(self, text: np.ndarray) -> tuple[np.ndarray, ...]:
        """gram, hash of the phrase, place of the gram, start and end of the phrase, in words."""
        words = self.words(text)
        if len(words) < self.window:
            return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
        grams, smallest, width = self._grams(words)
        pad = np.zeros(width - 1, np.uint64)
        places = np.flatnonzero(sliding(np.concatenate([pad, smallest, pad]), width, np.maximum) == grams)
        starts = np.maximum(places - width + 1, 0)
        ends = np.minimum(places + self.window, len(words))
        sums = self._sums(words)
        around = mixed((sums[ends] - sums[starts]) * self.inverse[starts] + _GOLDEN * (places - starts).astype(np.uint64))
        return grams[places], mixed(around + (ends - places).astype(np.uint64)), places, starts, ends

    def windows(self, text: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, ...]:
        """Two hashes and the start of each window whose smallest gram is at one of ``places``."""
        words = self.words(text)
        grams, smallest, width = self._grams(words)
        starts = places[:, None] - np.arange(width)
        inside = (starts >= 0) & (starts < len(smallest))
        inside &= smallest[np.where(inside, starts, 0)] == grams[places][:, None]
        starts = np.unique(starts[inside])
        hashes = np.zeros((2, len(starts)), np.uint64)
        for i in range(self.window):
            hashes += words[starts + i] * self.factors[:, i : i + 1]
        low, high = mixed(hashes)
        return low, high, starts


def remove_duplicate_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_removed, factors and kept (text) of every row of ``docs``.

    Words are what ASCII white space separates, as they are; null has none. A word is removed if it lies in
    ``window`` consecutive words that also start earlier: in a document with a smaller id or in the same one
    before. All is judged on the input, and no match goes over the end of a document. ``factors`` are the removed
    spans, each with the place in the reference that it repeats: start, end, source (doc_id), source_start, in
    words. Kept words are joined by one space.

    Rows that agree in id and text are one document, and each is cut like it. Different texts of one id stand one
    after the other, by their SHA-256; rows without an id come before all others. An id may be of any type
    that Spark can order. Equality of phrases and of windows is that of 128 bits of hashes.
    """
    rows, single = _placed(documents(docs, id_col, text_col))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    phrases = Phrases(window, gram)

    found = stored(_matches(_phrases(single, phrases, id_type, block_bytes)))
    several = found.where(F.size("places") > 0).groupBy("doc_id", "copy")
    several = several.agg(F.flatten(F.collect_list("places")).alias("places"))
    boundaries = _joined(single, several, "inner")
    spans = found.select("doc_id", "copy", "spans").unionByName(
        stored(_window_matches(_windows(boundaries, phrases, id_type, block_bytes)))
    )
    spans = spans.where(F.size("spans") > 0).groupBy("doc_id", "copy").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    factors = f"array<struct<start:int,end:int,source:{id_type},source_start:int>>"
    result = f"doc_id {id_type}, n_words long, n_removed long, factors {factors}, kept string"
    return _joined(rows, spans, "left").mapInArrow(_parsed, result)


def _placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, copy, which tells different texts of one id apart, and text: of all rows, and of each document once.

    Only rows whose id repeats are shuffled for this.
    """
    repeated = stored(rows.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_id")))
    alone = rows.select("doc_id", F.lit(0).cast("long").alias("copy"), "text")
    if repeated.isEmpty():
        return alone, alone
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    alone = alone.join(repeated, same, "left_anti")
    rows = rows.join(repeated, same, "left_semi").withColumn("digest", F.sha2("text", 256))
    texts_of = numbered(rows.select("doc_id", "digest").distinct(), "doc_id", "digest", column="copy")
    texts_of = stored(texts_of.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "copy"))
    rows = rows.join(texts_of, same & (F.col("digest") == F.col("_digest"))).select("doc_id", "copy", "text")
    once = rows.groupBy("doc_id", "copy").agg(F.any_value("text").alias("text"))
    return alone.unionByName(rows), alone.unionByName(once)


def _joined(rows: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    lists = lists.withColumnsRenamed({"doc_id": "_id", "copy": "_copy"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy"))
    return rows.join(lists, same, how).drop("_id", "_copy")


def _span_type(id_type: str) -> str:
    return f"array<struct<start:int,end:int,source:{id_type},source_copy:long,source_start:int>>"


class _Block:
    """Documents that a task indexes together; numbers of documents are their places in the order of all."""

    def __init__(self, keys: list[tuple], id_type: pa.DataType):
        order = sorted(range(len(keys)), key=lambda i: ([] if keys[i][0] is None else [keys[i][0]], keys[i][1]))
        self.number = np.empty(len(keys), np.int64)
        self.number[order] = np.arange(len(keys))
        self.ids = pa.array([keys[i][0] for i in order], id_type)
        self.copies = pa.array([keys[i][1] for i in order], pa.int64())

    def lists(self, doc: np.ndarray, fields: dict[str, np.ndarray]) -> pa.ListArray:
        """A list per document, of structs or of single values; ``source`` is the number of a document."""
        order = np.argsort(doc, kind="stable")
        ends = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=len(self.ids)))])
        arrays = {}
        for name, values in fields.items():
            values = values[order]
            if name == "source":
                places = pa.array(values)
                arrays |= {"source": self.ids.take(places), "source_copy": self.copies.take(places)}
            else:
                arrays[name] = pa.array(values.astype(np.int32))
        items = pa.StructArray.from_arrays(list(arrays.values()), list(arrays)) if len(arrays) > 1 else arrays[name]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), items)

    def spans(self, *found: np.ndarray) -> pa.ListArray:
        doc, start, end, source, source_start = chained(*found)
        return self.lists(doc, {"start": start, "end": end, "source": source, "source_start": source_start})


def chained(doc: np.ndarray, start: np.ndarray, end: np.ndarray, source: np.ndarray, source_start: np.ndarray) -> tuple:
    """Matches joined where they touch and go on in the same place of the reference."""
    order = np.lexsort((start, start - source_start, source, doc))
    doc, start, end, source, source_start = (c[order] for c in (doc, start, end, source, source_start))
    if not len(doc):
        return doc, start, end, source, source_start
    shift = start - source_start
    apart = (doc[1:] != doc[:-1]) | (source[1:] != source[:-1]) | (shift[1:] != shift[:-1])
    group = np.concatenate([[0], np.cumsum(apart)])
    # The farthest end so far of the group, by numbers that grow with groups.
    room = int(end.max()) + 1
    reach = np.maximum.accumulate(end + group * room) - group * room
    fresh = np.concatenate([[True], apart | (start[1:] > reach[:-1])])
    first = np.flatnonzero(fresh)
    return doc[first], start[first], np.maximum.reduceat(end, first), source[first], source_start[first]


def _in_blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[list[tuple], list, list]]:
    """Keys, texts and lists of places of documents, ``block_bytes`` of text or a bit more at a time."""
    keys, held, places, size = [], [], [], 0
    for batch in batches:
        lists = batch["places"] if "places" in batch.schema.names else [None] * len(batch)
        columns = (batch["doc_id"].to_pylist(), batch["copy"].to_pylist(), texts(batch["text"]), lists)
        for doc_id, copy, text, of_doc in zip(*columns):
            keys.append((doc_id, copy))
            held.append(text)
            places.append(of_doc)
            size += len(text)
            if size >= block_bytes:
                yield keys, held, places
                keys, held, places, size = [], [], [], 0
    if keys:
        yield keys, held, places


def _phrases(docs: DataFrame, phrases: Phrases, id_type: str, block_bytes: int) -> DataFrame:
    """The index entries of all blocks: phrases (kind 0), and grams that have several phrases in a block (kind 1).

    What a block knows about its documents for sure comes as lists (kind 2): ``spans`` that repeat another of the
    same block, and ``places`` of grams with several phrases.
    """

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, held, _ in _in_blocks(batches, block_bytes):
            block = _Block(keys, arrow_id)
            parts = [phrases(text) for text in held]
            doc = np.repeat(block.number, [len(p[0]) for p in parts])
            value, around, place, start, end = (np.concatenate(column) for column in zip(*parts))
            order = np.lexsort((place, doc, around, value))
            value, around, doc, place, start, end = (c[order] for c in (value, around, doc, place, start, end))
            same = np.concatenate([np.zeros(min(1, len(value)), bool), value[1:] == value[:-1]])
            again = same.copy()
            again[1:] &= around[1:] == around[:-1]
            first = np.maximum.accumulate(np.where(again, 0, np.arange(len(value))))[again]
            spans = block.spans(doc[again], start[again], end[again], doc[first], start[first])
            lead = np.flatnonzero(~again)
            with_before = same[lead]
            several = with_before | np.append(with_before[1:], False)[: len(lead)]
            sent, boundary = lead[~several], lead[several]
            packed = (place << (2 * _SIDE_BITS)) | ((place - start) << _SIDE_BITS) | (end - place)
            yield from _batches(0, value[sent], around[sent], block, doc[sent], packed[sent])
            grams = value[boundary[~with_before[several]]]
            yield from _batches(1, grams, None, block, None, None)
            # Rows of documents are dealt out like those of phrases.
            dealt = mixed(np.arange(len(keys), dtype=np.uint64) + np.uint64(len(value)) * _GOLDEN)
            places = block.lists(doc[boundary], {"place": place[boundary]})
            yield from _batches(2, dealt, None, block, np.arange(len(keys)), None, spans, places)

    def _batches(kind, value, around, block, doc, packed, spans=None, places=None, rows: int = 50_000):
        for at in range(0, len(value), rows):
            part = slice(at, at + rows)
            n = len(value[part])
            longs = [pa.nulls(n, pa.int64()) if c is None else pa.array(c[part].view(np.int64)) for c in (value, around, packed)]
            if doc is None:
                ids, copies = pa.nulls(n, arrow_id), pa.nulls(n, pa.int64())
            else:
                ids, copies = (c.take(pa.array(doc[part])) for c in (block.ids, block.copies))
            lists = [pa.nulls(n, kind_) if c is None else c[part].cast(kind_) for c, kind_ in ((spans, span_list), (places, place_list))]
            columns = [pa.array(np.full(n, kind, np.int8)), longs[0], longs[1], ids, copies, longs[2], *lists]
            yield pa.RecordBatch.from_arrays(columns, "kind value around doc_id copy at spans places".split())

    arrow_id, span_list, place_list = _arrow_types(docs)
    schema = f"kind tinyint, value long, around long, doc_id {id_type}, copy long, at long"
    return docs.mapInArrow(indexed, f"{schema}, spans {_span_type(id_type)}, places array<int>")


def _arrow_types(docs: DataFrame) -> tuple[pa.DataType, pa.DataType, pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(docs.schema["doc_id"].dataType)
    fields = [("start", pa.int32()), ("end", pa.int32()), ("source", arrow_id), ("source_copy", pa.int64()), ("source_start", pa.int32())]
    return arrow_id, pa.list_(pa.struct(fields)), pa.list_(pa.int32())


def _earliest(*key: str, place: str) -> Window:
    """Entries of a key, phrases first, in the order of the reference; as many as blocks at most."""
    order = ("kind", "doc_id", "copy", place)
    return Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def _span(start: Column, end: Column, first: str, first_start: Column, id_type: str) -> Column:
    span = F.struct(
        start.cast("int").alias("start"),
        end.cast("int").alias("end"),
        F.col(f"{first}.doc_id").alias("source"),
        F.col(f"{first}.copy").alias("source_copy"),
        first_start.cast("int").alias("source_start"),
    )
    return F.array(span).cast(_span_type(id_type))


def _matches(entries: DataFrame) -> DataFrame:
    """doc_id, copy, spans and places of entries that equal an earlier one, or whose gram has several phrases."""
    same = _earliest("value", place="at")
    entries = entries.withColumns(
        {
            "first": F.first(F.struct("doc_id", "copy", "at")).over(same),
            "several": (F.min("around").over(same) != F.max("around").over(same)) | (F.max(F.col("kind") == 1).over(same)),
        }
    )
    id_type = entries.schema["doc_id"].dataType.simpleString()

    def unpacked(at: Column) -> tuple[Column, Column, Column]:
        place, side = F.shiftright(at, 2 * _SIDE_BITS), F.lit((1 << _SIDE_BITS) - 1)
        return place, place - F.shiftright(at, _SIDE_BITS).bitwiseAND(side), place + at.bitwiseAND(side)

    place, start, end = unpacked(F.col("at"))
    phrase, several = F.col("kind") == 0, F.coalesce("several", F.lit(False))
    itself = F.struct("doc_id", "copy", "at").eqNullSafe(F.col("first"))
    span = _span(start, end, "first", unpacked(F.col("first.at"))[1], id_type)
    spans = F.when(phrase & ~several & ~itself, span).when(F.col("kind") == 2, F.col("spans"))
    places = F.when(phrase & several, F.array(place.cast("int"))).when(F.col("kind") == 2, F.col("places"))
    found = entries.select(
        "doc_id",
        "copy",
        F.coalesce(spans, F.array().cast(_span_type(id_type))).alias("spans"),
        F.coalesce(places, F.array().cast("array<int>")).alias("places"),
    )
    return found.where((F.size("spans") > 0) | (F.size("places") > 0))


def _windows(docs: DataFrame, phrases: Phrases, id_type: str, block_bytes: int) -> DataFrame:
    """Index entries of the windows at boundaries (kind 0), and spans that repeat one of the same block (kind 2)."""

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, held, lists in _in_blocks(batches, block_bytes):
            block = _Block(keys, arrow_id)
            parts = [phrases.windows(text, np.unique(of_doc.values.to_numpy())) for text, of_doc in zip(held, lists)]
            doc = np.repeat(block.number, [len(p[0]) for p in parts])
            low, high, start = (np.concatenate(column) for column in zip(*parts))
            order = np.lexsort((start, doc, high, low))
            low, high, doc, start = (c[order] for c in (low, high, doc, start))
            again = np.concatenate([np.zeros(min(1, len(low)), bool), (low[1:] == low[:-1]) & (high[1:] == high[:-1])])
            first = np.maximum.accumulate(np.where(again, 0, np.arange(len(low))))[again]
            spans = block.spans(doc[again], start[again], start[again] + phrases.window, doc[first], start[first])
            sent = np.flatnonzero(~again)
            yield from _batches(0, low[sent], high[sent], block, doc[sent], start[sent])
            dealt = mixed(np.arange(len(keys), dtype=np.uint64) + np.uint64(len(low)) * _GOLDEN)
            yield from _batches(2, dealt, dealt, block, np.arange(len(keys)), None, spans)

    def _batches(kind, low, high, block, doc, start, spans=None, rows: int = 50_000):
        for at in range(0, len(low), rows):
            part = slice(at, at + rows)
            n = len(low[part])
            ids, copies = (c.take(pa.array(doc[part])) for c in (block.ids, block.copies))
            columns = [pa.array(np.full(n, kind, np.int8)), *(pa.array(c[part].view(np.int64)) for c in (low, high)), ids, copies]
            columns.append(pa.nulls(n, pa.int32()) if start is None else pa.array(start[part].astype(np.int32)))
            columns.append(pa.nulls(n, span_list) if spans is None else spans[part].cast(span_list))
            yield pa.RecordBatch.from_arrays(columns, "kind low high doc_id copy start spans".split())

    arrow_id, span_list, _ = _arrow_types(docs)
    schema = f"kind tinyint, low long, high long, doc_id {id_type}, copy long, start int, spans {_span_type(id_type)}"
    return docs.mapInArrow(indexed, schema).withColumn("window", F.lit(phrases.window))


def _window_matches(entries: DataFrame) -> DataFrame:
    """doc_id, copy and spans of windows that equal an earlier one."""
    id_type = entries.schema["doc_id"].dataType.simpleString()
    first = F.first(F.struct("doc_id", "copy", "start")).over(_earliest("low", "high", place="start"))
    entries = entries.withColumn("first", first)
    itself = F.struct("doc_id", "copy", "start").eqNullSafe(F.col("first"))
    span = _span(F.col("start"), F.col("start") + F.col("window"), "first", F.col("first.start"), id_type)
    spans = F.when((F.col("kind") == 0) & ~itself, span).when(F.col("kind") == 2, F.col("spans"))
    found = entries.select("doc_id", "copy", F.coalesce(spans, F.array().cast(_span_type(id_type))).alias("spans"))
    return found.where(F.size("spans") > 0)


def greedy(start: np.ndarray, end: np.ndarray, source: np.ndarray, source_start: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Parse from left to right: of the matches that begin at or before a word, the one that reaches farthest."""
    factors, at = [], 0
    best: tuple[int, int, int, int] | None = None
    order = np.lexsort((-end, start))
    matches = zip(*(c[order].tolist() for c in (start, end, source, source_start)))
    pending = next(matches, None)
    while pending is not None or best is not None:
        while pending is not None and pending[0] <= at:
            if best is None or pending[1] > best[1]:
                best = pending
            pending = next(matches, None)
        if best is not None and best[1] > at:
            factors.append((at, best[1], best[2], best[3] + at - best[0]))
            at = best[1]
        elif pending is not None:
            # Words that no match covers are kept.
            at, best = pending[0], None
        else:
            break
    return factors


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n_words, n_removed, factors, kept = [], [], [], []
        for text, spans in zip(batch["text"], batch["spans"]):
            words = text.as_buffer().to_pybytes().split()
            found, sources = [], []
            if spans.is_valid:
                items = spans.values
                sources = items.field("source").to_pylist()
                # Texts of one id are told apart; numbers stand for sources.
                numbers = {}
                keys = zip(sources, items.field("source_copy").to_pylist())
                source = np.array([numbers.setdefault(key, len(numbers)) for key in keys], np.int64)
                sources = [key[0] for key in numbers]
                start, end, source_start = (items.field(c).to_numpy().astype(np.int64) for c in ("start", "end", "source_start"))
                matches = chained(np.zeros_like(start), start, end, source, source_start)
                found = greedy(*matches[1:])
            pieces, at = [], 0
            for start, end, *_ in found:
                pieces += words[at:start]
                at = end
            pieces += words[at:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(pieces))
            factors.append([{"start": a, "end": b, "source": sources[s], "source_start": c} for a, b, s, c in found])
            kept.append(b" ".join(pieces).decode())
        id_type = batch.schema.field("doc_id").type
        fields = [("start", pa.int32()), ("end", pa.int32()), ("source", id_type), ("source_start", pa.int32())]
        columns = [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        columns += [pa.array(factors, pa.list_(pa.struct(fields))), pa.array(kept, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, "doc_id n_words n_removed factors kept".split())
