"""Token ids in Parquet files: one list column, with encodings, row groups and page indexes set on purpose.

Files hold documents in the order of their ids, file after file. Ids of tokens are list elements, encoded by
dictionary while a column chunk's dictionary fits its page and by delta otherwise (format version 2).
Small pages with an index let a reader fetch the tokens of a few documents, or the lengths of all of them
without any token.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import count, repeat
from string import ascii_letters, digits

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snaptrail.llm.common import documents

END_OF_DOCUMENT = 0

ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 128 << 10
PAGE_ROWS = 1000
DICTIONARY_BYTES = 512 << 10

# Documents of a file at most: a task that needs a longer part of the order writes several files.
FILE_ROWS = 500_000

WRITER = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": DICTIONARY_BYTES,
    "parquet.block.size": ROW_GROUP_BYTES,
    "parquet.page.size": PAGE_BYTES,
    "parquet.page.row.count.limit": PAGE_ROWS,
    "compression": "zstd",
    "maxRecordsPerFile": FILE_ROWS,
}

# Pieces of text whose ids a task remembers, and their characters. Beyond either, it keeps the most used half.
REMEMBERED = 400_000
REMEMBERED_CHARACTERS = 16 << 20

# Bytes of texts that a task cuts and looks up at a time, besides one longer text.
PART_BYTES = 1 << 20

# White space, and characters that not every version of Unicode calls so: no piece starts with them after a space.
_BLANK = "[\\s\u180e\u200b\u2060\ufeff]"
# Pieces that may follow each other, or a line break, in one text: neither end is blank but for one space before it.
_WORD = re.compile(f" ?(?!{_BLANK}).*(?<!{_BLANK})", re.DOTALL)
# The first three bytes of characters beyond ASCII that are blank; of two bytes, with any third.
_BLANK_CHARACTERS = [c.encode() for c in map(chr, range(0x80, 0x10000)) if re.match(_BLANK, c)]
_BLANK_3 = [int.from_bytes(c, "big") for c in _BLANK_CHARACTERS if len(c) == 3]
_BLANK_2 = [int.from_bytes(c, "big") for c in _BLANK_CHARACTERS if len(c) == 2]

# Kinds of bytes: control characters, the space, other white space, and visible ones up to a byte beyond ASCII.
_CONTROL, _SPACE, _BREAK, _APOSTROPHE, _LETTER, _DIGIT, _SIGN, _BEYOND = range(8)
_KIND = np.full(256, _CONTROL, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[0x80:] = _BEYOND
_KIND[0x09:0x0E] = _BREAK
for _kind, _characters in ((_SPACE, " "), (_APOSTROPHE, "'"), (_LETTER, ascii_letters), (_DIGIT, digits)):
    _KIND[list(_characters.encode())] = _kind

# What the kinds of two bytes in a row, 8 * first + second, tell: a word starts with the second, or with the first; the
# second is a break after a visible character, or the first is one before; a space meets a byte beyond ASCII.
_STARTS_SECOND, _STARTS_FIRST, _INTO_BREAK, _FROM_BREAK, _SPACE_BEYOND = (1 << n for n in range(5))


def _told_by_pairs() -> np.ndarray:
    first, second = np.divmod(np.arange(256), 8)
    visible, next_visible = (np.isin(kind, [_APOSTROPHE, _LETTER, _DIGIT, _SIGN]) for kind in (first, second))
    runs, next_runs = (np.isin(kind, [_LETTER, _DIGIT, _SIGN]) for kind in (first, second))
    starts_second = visible & np.isin(second, [_SPACE, _BREAK]) | runs & next_runs & (first != second)
    told = starts_second * _STARTS_SECOND + ((first == _SPACE) & next_visible) * _STARTS_FIRST
    told += (visible & (second == _BREAK)) * _INTO_BREAK + ((first == _BREAK) & next_visible) * _FROM_BREAK
    return (told + ((first == _SPACE) & (second == _BEYOND)) * _SPACE_BEYOND).astype(np.uint8)


_TOLD = _told_by_pairs()


class Encoder:
    """Token ids of whole texts, equal to what the tokenizer gives, with the ids of pieces remembered.

    A byte-level tokenizer splits a text into words first. So a text may be cut where a word certainly
    starts, see ``word_starts``, and the pieces, most of them seen before, be encoded on their own. Texts
    with a special token of the tokenizer, which is searched before words are split, are encoded whole, and
    so are all texts with a tokenizer that does more than that: any normalizer, another splitter than the
    byte-level one, or one that adds a space.
    """

    def __init__(self, tokenizer_path: str):
        # Tasks already use all cores.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.in_pieces = splits_at_spaces(json.loads(self.tokenizer.to_str()))
        # Line breaks are put between new pieces, so none may be part of a special token.
        self.in_pieces &= not any("\n" in token for token in self.special)
        vocabulary = self.tokenizer.get_vocab()
        # Each character of a byte-level token stands for a byte.
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, id_ in vocabulary.items():
            self.bytes_of[id_] = len(token)
        self.place = Places()
        self.lengths, self.starts, self.uses = (Growing(np.int64) for _ in range(3))
        self.flat = Growing(np.uint32)

    def batch(self, texts: list[str]) -> list[np.ndarray]:
        if not self.in_pieces or not texts:
            return self._whole(texts)
        whole = [at for at, text in enumerate(texts) if any(token in text for token in self.special)]
        others = list(texts)
        for at in whole:
            others[at] = ""
        found = self._in_pieces(others)
        for at, ids in zip(whole, self._whole([texts[at] for at in whole])):
            found[at] = ids
        if len(self.place) > REMEMBERED or self.place.characters > REMEMBERED_CHARACTERS:
            self._forget()
        return found

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(encoding.ids, np.uint32) for encoding in found]

    def _in_pieces(self, texts: list[str]) -> list[np.ndarray]:
        encoded = [text.encode() for text in texts]
        data = np.frombuffer(b"".join(encoded), np.uint8)
        ends = np.cumsum([len(text) for text in encoded])
        starts = np.flatnonzero(word_starts(data, ends))
        buffers = [None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)]
        pieces = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode()
        places = self._places(pieces.dictionary)[pieces.indices.to_numpy()]
        ids, sums = self._joined(places), np.append(0, np.cumsum(self.lengths.values[places]))
        return np.split(ids, sums[np.searchsorted(starts, ends)][:-1])

    def _places(self, pieces: pa.Array) -> np.ndarray:
        """Where the ids of different pieces are; those of new ones are added."""
        texts, sizes = pieces.to_numpy(zero_copy_only=False), pc.binary_length(pieces).to_numpy()
        places = np.fromiter(map(self.place.get, texts, repeat(-1)), np.int64, len(texts))
        new = np.flatnonzero(places < 0)
        places[new] = np.arange(len(self.place), len(self.place) + len(new))
        self.place.add(texts[new].tolist())
        self._learn(texts[new], sizes[new])
        self.uses.values[places] += 1
        return places

    def _learn(self, new: np.ndarray, sizes: np.ndarray) -> None:
        """Encode new pieces, many in one text, and cut the ids where the bytes of a piece end."""
        is_word = np.fromiter((_WORD.fullmatch(piece) is not None for piece in new), bool, len(new))
        words, others = np.flatnonzero(is_word), np.flatnonzero(~is_word)
        lengths, starts = np.zeros((2, len(new)), np.int64)
        for start in range(0, len(words), 1000):
            some = words[start : start + 1000]
            # A space starts a word. Words without one follow a line break, an id of its own.
            breaks = np.fromiter((piece[0] != " " for piece in new[some]), np.int64, len(some))
            parted = ("\n" + piece if after else piece for piece, after in zip(new[some], breaks))
            ids = self._whole(["".join(parted)])[0]
            ends = np.searchsorted(np.cumsum(self.bytes_of[ids]), np.cumsum(sizes[some] + breaks)) + 1
            firsts = np.append(0, ends[:-1]) + breaks
            lengths[some], starts[some] = ends - firsts, self.flat.used + firsts
            self.flat.extend(ids)
        for at, ids in zip(others, self._whole(new[others].tolist())):
            lengths[at], starts[at] = len(ids), self.flat.used
            self.flat.extend(ids)
        self.lengths.extend(lengths)
        self.starts.extend(starts)
        self.uses.extend(np.zeros(len(new), np.int64))

    def _forget(self) -> None:
        """Keep the pieces that most batches had, as many as fill half of either bound."""
        pieces = np.array(list(self.place), object)
        order = np.argsort(-self.uses.values[: len(pieces)], kind="stable")[: REMEMBERED // 2]
        characters = np.cumsum([len(piece) for piece in pieces[order]])
        order = order[: np.searchsorted(characters, REMEMBERED_CHARACTERS // 2, "right")]
        ids, lengths, uses = self._joined(order), self.lengths.values[order], self.uses.values[order]
        self.place = Places()
        self.place.add(pieces[order].tolist())
        self.lengths, self.starts, self.uses = (Growing(np.int64) for _ in range(3))
        self.flat = Growing(np.uint32)
        self.flat.extend(ids)
        self.lengths.extend(lengths)
        self.starts.extend(np.cumsum(lengths) - lengths)
        self.uses.extend(uses // 2)

    def _joined(self, places: np.ndarray) -> np.ndarray:
        lengths, starts = self.lengths.values[places], self.starts.values[places]
        ends = np.cumsum(lengths)
        if not len(ends):
            return np.zeros(0, np.uint32)
        return self.flat.values[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1])]


def splits_at_spaces(settings: dict) -> bool:
    """Whether a tokenizer, by its settings, only splits texts byte-level, each space starting a new word."""
    splitter = settings.get("pre_tokenizer") or {}
    return (
        settings["model"]["type"] == "BPE"
        and splitter.get("type") == "ByteLevel"
        and splitter.get("use_regex", True)
        and not splitter.get("add_prefix_space", True)
        and not any(settings.get(part) for part in ("normalizer", "truncation", "padding"))
        and not settings["model"].get("continuing_subword_prefix")
        and not settings["model"].get("end_of_word_suffix")
    )


@cache
def encoder_of(tokenizer_path: str) -> Encoder:
    """One for each Python worker, which keeps it from task to task."""
    return Encoder(tokenizer_path)


class Places(dict):
    """Numbers pieces in the order in which they come; ``characters`` are those of all of them."""

    characters = 0

    def add(self, pieces: list[str]) -> None:
        self.update(zip(pieces, count(len(self))))
        self.characters += sum(map(len, pieces))


class Growing:
    """An array to append to."""

    def __init__(self, kind: type):
        self.values, self.used = np.zeros(1 << 12, kind), 0

    def extend(self, more: np.ndarray) -> None:
        need = self.used + len(more)
        if need > len(self.values):
            self.values = np.concatenate([self.values[: self.used], np.zeros(need, self.values.dtype)])
        self.values[self.used : need] = more
        self.used = need


def word_starts(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a word of a byte-level tokenizer starts at each byte of UTF-8 texts in a row, which end at ``ends``.

    Words are runs of letters, of digits or of signs, each with one space before it or an apostrophe's
    ending, or white space. So one certainly starts with each text; with white space behind a visible
    character; with a space before one; where ASCII letters, digits and signs other than the apostrophe
    meet; and behind a line break or tab that is alone between two of them. Others are not told.
    """
    kinds = _translated(data, _KIND)
    pairs = kinds[:-1] * np.uint8(8) + kinds[1:]
    # No pair spans two texts: such ones count as two control characters, which start no word.
    pairs[ends[(ends > 0) & (ends < len(data))] - 1] = _CONTROL
    told = _translated(pairs, _TOLD)
    starts = np.zeros(len(data), bool)
    starts[1:] = told & _STARTS_SECOND
    starts[:-1] |= (told & _STARTS_FIRST) > 0
    starts[2:] |= ((told[:-1] & _INTO_BREAK) > 0) & ((told[1:] & _FROM_BREAK) > 0)
    beyond = np.flatnonzero(told & _SPACE_BEYOND)
    one, two, three = (data[np.minimum(beyond + n, len(data) - 1)].astype(np.int64) for n in (1, 2, 3))
    two |= one << 8
    blank = np.isin(two, _BLANK_2) | np.isin(two << 8 | three, _BLANK_3)
    starts[beyond[~blank]] = True
    firsts = np.append(0, ends)
    starts[firsts[firsts < len(data)]] = True
    return starts


def _translated(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    return np.frombuffer(data.tobytes().translate(table.tobytes()), np.uint8)


def cut(text: str) -> list[str]:
    """Cut at the spaces that start a word; joined by spaces, the pieces give the text."""
    data = np.frombuffer(text.encode(), np.uint8)
    spaces = np.flatnonzero(word_starts(data, np.array([len(data)])) & (data == ord(" ")))
    starts, ends = np.append(0, spaces + 1), np.append(spaces, len(data))
    return [data[start:end].tobytes().decode() for start, end in zip(starts, ends)]


def encode(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_OF_DOCUMENT
) -> DataFrame:
    """doc_id, n_tokens, token_ids: the ids of every whole text, and ``end_id`` at their end.

    Null and empty texts have the end id only. Texts are encoded whole, however long; rows that repeat
    are encoded each, and an empty table gives an empty result.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False).astype(np.int64))
            firsts = np.flatnonzero(np.diff(ends // PART_BYTES, prepend=-1))
            for start, end in zip(firsts, np.append(firsts[1:], len(batch))):
                part = batch.slice(start, end - start)
                found = [np.append(ids, np.uint32(end_id)) for ids in encoder.batch(part["text"].to_pylist())]
                lengths = [len(ids) for ids in found]
                offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
                lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(found).view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(lengths, pa.int64()), lists], ["doc_id", "n_tokens", "token_ids"]
                )

    rows = documents(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(encoded, f"doc_id {id_type}, n_tokens long, token_ids array<int>")


def write(
    docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode ``docs`` and write the files in ascending order of ids, nulls first, ties by text.

    The file names ascend with the ids, in files of ``FILE_ROWS`` documents at most. Rows that repeat are
    written as often as they are there; an empty table gives a file without rows. Texts, which are shorter than their ids, are what is shuffled.
    """
    rows = documents(docs, id_col, text_col)
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    encode(ordered, tokenizer_path).write.options(**WRITER).parquet(path)


def index(spark: SparkSession, path: str) -> DataFrame:
    """file, row, doc_id, start, n_tokens of every document; reads lengths and ids of documents, no token.

    ``start`` counts the ids of all documents before, over all files.
    """
    files = _files(spark, path)
    return _with_starts(files.select("file", "row", "doc_id", "n_tokens"), files)


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the tokens in the files.

    ids_crc32 is the unsigned crc32 of the ids as little-endian unsigned 32-bit integers.
    """

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["token_ids"]
            flat, ends = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
            crcs = [zlib.crc32(flat[start:end]) for start, end in zip(ends[:-1], ends[1:])]
            lengths, crcs = pa.array(np.diff(ends), pa.int64()), pa.array(crcs, pa.int64())
            yield pa.RecordBatch.from_arrays([batch["file"], batch["row"], batch["doc_id"], lengths, crcs], names)

    names = ["file", "row", "doc_id", "n_tokens", "ids_crc32"]
    files = _files(spark, path)
    id_type = files.schema["doc_id"].dataType.simpleString()
    schema = f"file string, row long, doc_id {id_type}, n_tokens long, ids_crc32 long"
    read = files.select("file", "row", "doc_id", "token_ids").mapInArrow(summed, schema)
    return _with_starts(read, files).select("doc_id", "start", "n_tokens", "ids_crc32")


def _files(spark: SparkSession, path: str) -> DataFrame:
    place = (F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    return spark.read.parquet(path).select("*", *place)


def _with_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Adds ``start``: sums of lengths within each file, after one sum for each file before."""
    per_file = files.groupBy("file").agg(F.sum("n_tokens").alias("file_tokens"))
    # One row per file; names of equal length sort as their numbers do.
    before = Window.orderBy(F.length("file"), "file").rowsBetween(Window.unboundedPreceding, -1)
    per_file = per_file.select("file", F.coalesce(F.sum("file_tokens").over(before), F.lit(0)).alias("file_start"))
    in_file = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("file_start") + F.coalesce(F.sum("n_tokens").over(in_file), F.lit(0))
    return rows.join(per_file, "file").withColumn("start", start).drop("file_start")
