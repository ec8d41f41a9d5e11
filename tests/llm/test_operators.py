"""The operators on small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

from __future__ import annotations

import hashlib
import json
import random
import re
import zlib
from itertools import groupby, product

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from snaptrail.llm import decontamination, language_id, mixing, token_files, toxicity
from snaptrail.llm.components import components
from snaptrail.llm.decontamination import contamination
from snaptrail.llm.exact_dedup import exact_groups
from snaptrail.llm.mixing import apportion, mix
from snaptrail.llm.near_dedup import Shingler, band_keys, forest, mixed, near_groups, signature
from snaptrail.llm.preferences import format_pairs, swapped_replies
from snaptrail.llm.repeats import remove_repeats
from snaptrail.llm.url_filter import filter_urls

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = str.maketrans(UPPER, UPPER.lower())
LONG = "word " * 30_000

EDGE_TEXTS = [
    (1, "The same Text, twice over and over again é"),
    (2, "the same text, twice over and over again é"),
    (2, "the same text, twice over and over again é"),
    (3, None),
    (4, ""),
    (5, " \n\t"),
    (6, LONG),
    (7, LONG + "end"),
    (8, "É"),
    (9, "é"),
    (10, "12 345 !"),
    (None, "no id here at all, none"),
    (None, "no id here at all, none"),
    (None, None),
    (11, "one text of an id that repeats"),
    (11, "another text of that same id"),
]


@pytest.fixture(scope="module")
def edge(spark):
    """The edge cases, with columns whose names operators use themselves."""
    rows = [(i, t, "en" if i else None, None if i == 4 else f"s{(i or 0) % 3}", 0, "x", 1, 2) for i, t in EDGE_TEXTS]
    schema = "doc_id long, text string, lang string, source string, n_chars long, name string, key int, words int"
    return spark.createDataFrame(rows, schema).repartition(3)


def sets_of(docs):
    """Distinct five-word shingles by brute force."""
    found = {}
    for doc_id, text in docs:
        words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
        found[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    return found


@pytest.mark.parametrize("block_chars", [1, 3, 4096])
def test_exact_groups_equal_grouping_by_text(spark, block_chars):
    random.seed(block_chars)
    docs = [(i, "".join(random.choice("abAé") for _ in range(random.randint(0, 4)))) for i in range(150)]
    docs += [(1000 + i, "abcdefgh" * i) for i in range(1, 6)] + [(2000 + i, "abcdefgh" * i) for i in range(1, 6)]
    result = exact_groups(spark.createDataFrame(docs, "doc_id long, text string"), block_chars=block_chars).collect()
    groups = {}
    for doc_id, text in docs:
        groups.setdefault(text.translate(LOWER), []).append(doc_id)
    expected = {
        (i, max(ids), len(ids), i == max(ids), hashlib.sha256(text.encode()).hexdigest())
        for text, ids in groups.items()
        for i in ids
    }
    assert {tuple(row) for row in result} == expected
    assert len(result) == len(docs)


def test_exact_groups_draw_again_after_a_collision(spark):
    from pyspark.sql import functions as F

    seeds = []

    def digest(block, seed):
        seeds.append(seed)
        bits = F.length(block) if seed == 0 else F.xxhash64(F.lit(seed), block)
        return F.struct(bits.cast("long").alias("a"), F.lit(0).cast("long").alias("b"))

    docs = spark.createDataFrame([(1, "ab"), (2, "cd"), (3, "ab")], "doc_id long, text string")
    result = {row.doc_id: row.keep_id for row in exact_groups(docs, digest=digest).collect()}
    assert result == {1: 3, 2: 2, 3: 3}
    assert seeds[0] == 0 and seeds[-1] == 1


def test_exact_groups_of_edge_cases(edge):
    rows = exact_groups(edge).collect()
    assert len(rows) == len(EDGE_TEXTS)
    by_id = {row.doc_id: row for row in rows}
    assert by_id[1].keep_id == 2 and by_id[1].group_size == 3 and not by_id[1].kept
    assert sum(row.kept for row in rows if row.keep_id == 2) == 1
    assert by_id[3].keep_id == 4 and not by_id[3].kept
    assert by_id[8].keep_id == 8 and by_id[9].keep_id == 9
    nameless = [row for row in rows if row.doc_id is None]
    assert sorted((row.keep_id or 0, row.group_size, row.kept) for row in nameless) == [(0, 2, False), (0, 2, True), (4, 3, False)]


def test_preferences_have_one_prompt_and_two_masked_ends(spark):
    turns = "array<struct<role:string,text:string>>"
    pairs = spark.createDataFrame(
        [
            (1, [("user", "q"), ("assistant", "good")], [("user", "q"), ("assistant", "bad"), ("user", "why")]),
            (2, [("user", "q")], [("user", "q")]),
            (3, None, [("assistant", "a")]),
            (4, [("user", "q"), ("assistant", "a")], [("user", "q")]),
        ],
        f"pair_id long, chosen {turns}, rejected {turns}",
    )
    rows = {row.pair_id: row for row in format_pairs(pairs).collect()}
    assert rows[1].prompt == "<|user|>\nq<|end|>\n" and rows[1].n_prompt_turns == 1
    assert rows[1].chosen == "<|assistant|>\ngood<|end|>\n"
    for side, learned in (("chosen", ["good<|end|>"]), ("rejected", ["bad<|end|>"])):
        text, mask = rows[1][side], rows[1][f"{side}_mask"]
        assert [text[start:end] for start, end in mask] == learned
    assert (rows[2].chosen, rows[2].rejected, rows[2].chosen_mask) == ("", "", [])
    assert (rows[3].prompt, rows[3].chosen, rows[3].n_prompt_turns) == ("", "", 0)
    assert rows[4].rejected == "" and rows[4].n_prompt_turns == 1


def test_swapped_replies_of_edge_cases(spark):
    turns = [
        (0, 0, "user", "a", 1), (0, 1, "assistant", "b", 1), (0, 1, "assistant", "b", 1), (0, 2, "user", None, 1),
        (1, 0, "user", "c", 1), (1, 1, "assistant", "d", 1),
        (2, 0, "user", "alone", 1), (2, 1, "assistant", LONG, 1),
        (4, 0, None, "no reply", 1), (None, 0, "assistant", "x", 1),
    ]
    conversations = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, turns int")
    rows = {row.pair_id: row for row in swapped_replies(conversations).collect()}
    assert rows.keys() == {0, 1, 2}
    assert [t.text for t in rows[0].chosen] == ["a", "b"] and [t.text for t in rows[0].rejected] == ["a", "d"]
    assert [t.text for t in rows[2].rejected] == ["alone"]
    assert swapped_replies(conversations.limit(0)).count() == 0


def test_token_files_give_back_what_the_tokenizer_gives(spark, edge, tmp_path):
    path = str(tmp_path / "tokens")
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write(edge, vocabulary, path)
    rows = token_files.checksums(spark, path).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(vocabulary)
    expected = {}
    for doc_id, text in EDGE_TEXTS:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        expected.setdefault(doc_id, []).append((len(ids), zlib.crc32(ids)))
    assert [row.doc_id is not None for row in rows] == sorted(row.doc_id is not None for row in rows)
    ids = [row.doc_id for row in rows if row.doc_id is not None]
    assert ids == sorted(ids)
    start = 0
    for row in rows:
        assert row.start == start
        expected[row.doc_id].remove((row.n_tokens, row.ids_crc32))
        start += row.n_tokens
    assert not any(expected.values())
    by_file = token_files.index(spark, path)
    assert {(r.start, r.n_tokens) for r in by_file.collect()} == {(r.start, r.n_tokens) for r in rows}
    plan = by_file._jdf.queryExecution().executedPlan().toString()
    assert "token_ids" not in plan


def test_token_files_have_encodings_row_groups_and_indexes(spark, tmp_path):
    import pyarrow.parquet as pq

    path = tmp_path / "tokens"
    docs = spark.createDataFrame([(i, f"text number {i} " * 50) for i in range(3000)], "doc_id long, text string")
    token_files.write(docs, public_tokenizers.path("byte_bpe_50k.json"), str(path))
    for file in path.glob("*.parquet"):
        for group in range((meta := pq.ParquetFile(file).metadata).num_row_groups):
            tokens = meta.row_group(group).column(2)
            assert tokens.has_offset_index and meta.row_group(group).column(0).has_column_index
            assert set(tokens.encodings) & {"RLE_DICTIONARY", "DELTA_BINARY_PACKED"}
            assert meta.row_group(group).total_byte_size <= 2 * token_files.ROW_GROUP_BYTES


def test_encoder_equals_tokenizer_on_odd_spaces_and_special_tokens():
    random.seed(5)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer = token_files.Encoder(vocabulary), Tokenizer.from_file(vocabulary)
    parts = ["a", " ", "  ", "\n", "'s", "é", "1", "#", "\u180e", "\u200b", "\u2003", "\x85", "\x1c", "<|endoftext|>", "中", "\x00"]
    texts = ["".join(random.choices(parts, k=random.randint(0, 30))) for _ in range(3000)]
    for text, ids in zip(texts, encoder.batch(texts)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert " ".join(token_files.cut(text)) == text


def test_encoder_equals_tokenizers_that_do_more_than_split():
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    encoder, tokenizer = token_files.Encoder(vocabulary), Tokenizer.from_file(vocabulary)
    assert not encoder.in_pieces
    texts = ["Some  UPPER case", "", "  é中 x", "don't <|endoftext|> stop", "a\n\nb"]
    for text, ids in zip(texts, encoder.batch(texts)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    settings = json.loads(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).to_str())
    assert token_files.splits_at_spaces(settings)
    spaced = settings["pre_tokenizer"] | {"add_prefix_space": True}
    for other in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": None}, {"pre_tokenizer": spaced}):
        assert not token_files.splits_at_spaces(settings | other)


def test_encoder_forgets_by_characters(monkeypatch):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer = token_files.Encoder(vocabulary), Tokenizer.from_file(vocabulary)
    monkeypatch.setattr(token_files, "REMEMBERED_CHARACTERS", 50)
    for i in range(5):
        texts = ["x" * 100 + f" word{i} and " + "y" * 40, "and word"]
        assert [ids.tolist() for ids in encoder.batch(texts)] == [tokenizer.encode(t).ids for t in texts]
        assert encoder.place.characters < 100


def test_encoder_cuts_where_words_start():
    random.seed(6)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer = token_files.Encoder(vocabulary), Tokenizer.from_file(vocabulary)
    parts = ["a", "s", "Zz", "7", ".", "'", "\"", "_", " ", "\n", "\t", "\r\n", "\x1f", "\x7f", "\xa0", "\u0301", "é", "—", "中", "\u3000"]
    texts = ["".join(some) for some in product(parts, repeat=3)]
    texts += ["".join(random.choices(parts, k=random.randint(4, 25))) for _ in range(5000)]
    for start in range(0, len(texts), 1000):
        for text, ids in zip(texts[start : start + 1000], encoder.batch(texts[start : start + 1000])):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
            assert " ".join(token_files.cut(text)) == text


def test_encoder_encodes_a_word_once_whatever_signs_follow():
    encoder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    encoder.batch([f"a word{sign} word{sign}\nword" for sign in ["", *",.;:!?)]"]])
    assert set(encoder.place) == {"a", " word", "word", "\n", *",.;:!?)]"}


def test_encoder_forgets_what_was_used_least(monkeypatch):
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer = token_files.Encoder(vocabulary), Tokenizer.from_file(vocabulary)
    monkeypatch.setattr(token_files, "REMEMBERED", 20)
    for i in range(50):
        texts = [f"often and again, rare{chr(97 + i % 26) * (i + 3)}", "again and often"]
        assert [ids.tolist() for ids in encoder.batch(texts)] == [tokenizer.encode(t).ids for t in texts]
        assert len(encoder.place) <= 20
        assert {" and", " again", " often", ","} <= set(encoder.place)


def test_token_files_cut_texts_in_parts_of_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "PART_BYTES", 10)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["", "a b", "long " * 20, "", "c", "d" * 10, "e", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    tokenizer = Tokenizer.from_file(vocabulary)
    rows = token_files.encode(docs, vocabulary).orderBy("doc_id").collect()
    assert [row.token_ids for row in rows] == [tokenizer.encode(text or "").ids + [0] for text in texts]


def test_token_files_are_rolled(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(token_files.WRITER, "maxRecordsPerFile", 7)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(100)], "doc_id long, text string")
    token_files.write(docs, public_tokenizers.path("byte_bpe_50k.json"), str(tmp_path / "tokens"))
    assert len(list((tmp_path / "tokens").glob("*.parquet"))) >= 100 // 7
    rows = token_files.checksums(spark, str(tmp_path / "tokens")).orderBy("doc_id").collect()
    starts = np.cumsum([0] + [row.n_tokens for row in rows])
    assert [row.doc_id for row in rows] == list(range(100))
    assert [row.start for row in rows] == starts[:-1].tolist()


def test_toxicity_learns_and_handles_edge_cases(spark, edge):
    random.seed(1)
    plain = [random.choice("bcdfg") + random.choice("aeiou") + random.choice("lmnrst") for _ in range(40)]
    docs = []
    for i in range(400):
        words = random.choices(plain, k=60)
        if i % 4 == 0:
            words[10] = words[30] = words[50] = "hatefulword"
        docs.append((i, " ".join(words)))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)] + [(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(table, labels)
    rows = {row.doc_id: row for row in toxicity.score(table, model).collect()}
    assert all(rows[i].predicted == int(i % 4 == 0) for i in range(300, 400))
    odd = toxicity.score(edge, model).collect()
    assert len(odd) == len(EDGE_TEXTS) and all(0 <= row.score <= 1 for row in odd)
    assert toxicity.fit(table, labels.where("toxic = 1")) is None
    assert {row.score for row in toxicity.score(edge, None).collect()} == {0.0}


def test_toxicity_fit_does_not_depend_on_its_blocks_and_takes_2500_of_each_class(spark):
    random.seed(11)
    words = ["".join(random.choices("abcdefghij", k=6)) for _ in range(60)]
    docs = [(i, " ".join(random.choices(words[:40] if i % 3 else words[20:], k=random.randint(0, 60)))) for i in range(200)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in docs], "doc_id long, toxic int")
    whole, parts = toxicity.fit(table, labels), toxicity.fit(table, labels, block_features=5_000)
    assert np.allclose(whole.ratio, parts.ratio, atol=1e-6) and np.allclose(whole.weight, parts.weight, rtol=1e-3, atol=1e-3)
    many = spark.range(2 * 2_600).selectExpr("id AS doc_id", "'some text' AS text", "CAST(id % 2 AS INT) AS toxic")
    assert toxicity.sample_features(many.select("doc_id", "text"), many.select("doc_id", "toxic")).count() == 2 * 2_500


def brute_contamination(docs, items, size=10):
    def words(text):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))

    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1)) if w and item is not None else ():
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    result = {}
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for length in {len(window) for window in windows}:
            for i in range(len(w) - length + 1):
                if items_ := windows.get(tuple(w[i : i + length])):
                    hit.update(range(i, i + length))
                    found |= items_
        result[doc_id] = (len(w), len(hit), sorted(found))
    return result


@pytest.mark.parametrize("block_rows", [7, 200_000])
def test_contamination_equals_brute_force(spark, block_rows):
    random.seed(2)
    items = [(i, " ".join(random.choices("abcd", k=random.randint(0, 16)))) for i in range(25)]
    items += [(None, "a b"), (30, None), (31, items[3][1]), (32, "?!"), (33, "rare"), (34, "two rare")]
    docs = [(i, " ".join(random.choices(["a", "B", "c", "d,", "rare"], k=random.randint(0, 200)))) for i in range(60)]
    docs += [(100, None), (101, ""), (102, "RARE")]
    result = contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        block_rows=block_rows,
    )
    found = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in result.collect()}
    assert found == brute_contamination(docs, items)


def test_contamination_of_edge_cases(spark, edge):
    items = spark.createDataFrame([(7, "word " * 12), (8, "no id here at all, none")], "item_id long, text string")
    rows = contamination(edge, items).collect()
    assert len(rows) == len(EDGE_TEXTS)
    by_id = {row.doc_id: row for row in rows if row.doc_id is not None}
    assert by_id[6].n_hit == 30_000 and by_id[6].item_ids == ["7"]
    assert sum(row.contaminated for row in rows if row.doc_id is None) == 2
    empty = contamination(edge, items.limit(0)).collect()
    assert len(empty) == len(EDGE_TEXTS) and not any(row.contaminated for row in empty)
    assert contamination(edge.limit(0), items).count() == 0


def test_a_passage_that_all_share_is_stored_once_per_document(spark):
    passage = " ".join(f"w{i}" for i in range(10))
    docs = spark.createDataFrame([(i, f"d{i} {passage} e{i}") for i in range(60)], "doc_id long, text string")
    items = spark.createDataFrame([(i, f"a{i} {passage} b{i}") for i in range(50)], "item_id long, text string")
    windows, named = decontamination.item_windows(items, "item_id", "text", 10)
    rows = docs.select("doc_id", F.lit("k").alias("key"), decontamination.words(F.col("text")).alias("words"))
    found = decontamination.occurrences(rows, windows)
    assert (windows.count(), named.count(), found.count()) == (101, 150, 60)
    assert decontamination._items_of(found.groupBy("doc_id").agg(F.collect_set("window_id").alias("windows")).select("windows").distinct(), named).count() == 1
    ids = sorted(str(i) for i in range(50))
    result = contamination(docs, items).collect()
    assert {(r.n_hit, r.n_items, tuple(r.item_ids)) for r in result} == {(10, 50, tuple(ids))}


def brute_repeats(docs, length):
    seen, result = set(), {}
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if (string := data[i : i + length]) in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(string)
        spans = sum(1 for key, _ in groupby(gone) if key)
        result[doc_id] = (len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone) if not g))
    return result


@pytest.mark.parametrize("gram, chunk_bytes, chunk_pieces", [(8, 2_000, 40), (4, 1 << 30, 1 << 20)])
def test_repeats_equal_brute_force(spark, gram, chunk_bytes, chunk_pieces):
    random.seed(3)
    base = "".join(random.choices("abc ", k=200))
    docs = []
    for i in range(150):
        parts = []
        for _ in range(random.randint(0, 6)):
            at = random.randint(0, 190)
            parts.append("".join(random.choices("abcé", k=15)) if random.random() < 0.5 else base[at : at + random.randint(1, 60)])
        docs.append((i, "".join(parts)))
    docs += [(500, None), (501, ""), (502, "a" * 3000), (503, "ab" * 700)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    result = remove_repeats(table, length=20, gram=gram, chunk_bytes=chunk_bytes, chunk_pieces=chunk_pieces)
    found = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in result.collect()}
    assert found == brute_repeats(docs, 20)


def test_repeats_of_edge_cases(edge):
    rows = remove_repeats(edge).collect()
    assert len(rows) == len(EDGE_TEXTS)
    by_id = {row.doc_id: row for row in rows}
    assert by_id[6].n_bytes == len(LONG) and by_id[6].n_removed == len(LONG) - 5
    # All of it stands in document 6 already, but for what touches the new end.
    assert bytes(by_id[7].kept) == b"end"
    assert by_id[3].n_bytes == 0 and by_id[3].spans == []
    assert remove_repeats(edge.limit(0)).count() == 0


def test_repeats_keep_rows_that_repeat_with_their_id(spark):
    random.seed(9)
    a, b, c, d = ("".join(random.choices("abcdefgh ", k=500)) for _ in range(4))
    # A part of each long text comes again, so that anchors with different surroundings are decided too.
    docs = [(1, a), (1, a), (None, b), (None, b), (2, c), (2, c), (2, d), (3, a[50:300] + d), (4, b[100:400] + "x"), (None, "short")]
    distinct = sorted(set(docs), key=lambda row: (row[0] is not None, row[0] or 0))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    rows = remove_repeats(table).collect()
    assert len(rows) == len(docs)
    found = {(r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in rows}
    expected = {(i, *result[:2], result[3]) for (i, _), result in zip(distinct, brute_repeats(
        [(place, text) for place, (_, text) in enumerate(distinct)], 100).values())}
    assert found == expected
    assert sorted(r.n_removed for r in rows if r.doc_id in (1, None)) == [0] * 5


@pytest.mark.parametrize("block_nodes, group_blocks", [(4, 200), (4, 1), (512, 200)])
def test_near_groups_equal_brute_force(spark, block_nodes, group_blocks):
    random.seed(4)
    vocabulary = [f"w{i}" for i in range(500)]
    docs = []
    for family in range(12):
        words = random.choices(vocabulary, k=random.randint(40, 200))
        for _ in range(8):
            changed = list(words)
            for _ in range(random.randint(0, 4)):
                changed[random.randrange(len(changed))] = random.choice(vocabulary)
            docs.append((len(docs) * 7 % 1009, " ".join(changed)))
    docs += [(5000, None), (5001, ""), (5002, "only four words here"), (5003, "Only  four words\there")]
    sets = sets_of(docs)
    group = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = {i: low if g == high else g for i, g in group.items()}
    table = spark.createDataFrame(docs, "doc_id long, text string")
    rows = near_groups(table, 85, block_nodes=block_nodes, group_blocks=group_blocks).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert found == {i: (len(sets[i]), group[i], group[i] == i) for i in sets}


def test_near_groups_of_edge_cases(edge):
    rows = near_groups(edge).collect()
    assert len(rows) == len(EDGE_TEXTS)
    by_id = {row.doc_id: row for row in rows}
    assert by_id[2].component_id == 1 and not by_id[2].kept
    assert by_id[4].component_id == 4 and by_id[4].n_shingles == 0
    assert by_id[11].kept
    assert all(row.kept and row.component_id is None for row in rows if row.doc_id is None)
    assert near_groups(edge.limit(0)).count() == 0


def test_signatures_estimate_similarity_with_less_variance():
    random_bits = np.random.default_rng(0)
    for n in (30, 300):
        estimates = []
        for _ in range(80):
            elements = mixed(random_bits.integers(1, 1 << 62, 2 * n).astype(np.uint64))
            first, second = elements[: n], np.concatenate([elements[: n // 2], elements[n : 2 * n - n // 2]])
            estimates.append((signature(first, 120) == signature(second, 120)).mean())
        similarity = (n // 2) / (2 * n - n // 2)
        assert abs(np.mean(estimates) - similarity) < 0.02
        assert np.std(estimates) < (similarity * (1 - similarity) / 120) ** 0.5


def test_shingler_and_bands_know_equal_sets():
    shingler = Shingler()
    a, b = (np.frombuffer(t.encode(), np.uint8) for t in ("A b c  d e f a b c d e", "a B c d e f a b\tc d e"))
    assert np.array_equal(shingler(a), shingler(b)) and len(shingler(a)) == 6
    assert len(shingler(np.zeros(0, np.uint8))) == 0
    assert np.array_equal(band_keys(signature(shingler(a), 240)), band_keys(signature(shingler(b), 240)))
    assert len(shingler(np.frombuffer(("x y " * 50_000).encode(), np.uint8))) == 2


def test_forest_connects_all_links_of_two_blocks():
    sets = [np.arange(i, i + 100, dtype=np.uint64) for i in range(0, 60, 2)]
    nodes = np.arange(30)
    links = forest(nodes, sets, np.zeros(30, int), 85)
    assert len(links) == 29
    across = forest(nodes, sets, nodes % 2, 85)
    assert len(across) == 29 and all((a + b) % 2 for a, b in across)


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(400, 399), (9, 9)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100} and {found[i] for i in range(200, 401)} == {7}


def test_components_within_bound_the_links_of_a_task(spark, monkeypatch):
    from snaptrail.llm import components as module

    def dense(first, n):
        return [(a, b) for a in range(first, first + n) for b in range(a + 1, first + n)]

    path = [(i, i + 1) for i in range(1000, 1300)]
    groups = {1: dense(0, 40), 2: path, 3: [(2000, 2001), (2002, 2003)], 4: dense(3000, 60) + dense(3100, 5)}
    rows = [(g, a, b) for g, links in groups.items() for a, b in links]
    table = spark.createDataFrame(rows, "grp long, a long, b long").repartition(4)
    united = module._united

    def bounded(links):
        # Parts are dealt by hash, so that some get more than others.
        assert len(links) <= 100, len(links)
        return united(links)

    monkeypatch.setattr(module, "_united", bounded)
    found = {r.node: r.component for r in module.components_within(table, "grp", task_links=100).collect()}
    expected = {i: 0 for i in range(40)} | {i: 1000 for i in range(1000, 1301)} | {2000: 2000, 2001: 2000, 2002: 2002, 2003: 2002}
    expected |= {i: 3000 for i in range(3000, 3060)} | {i: 3100 for i in range(3100, 3105)}
    assert found == expected


def test_url_filter_rules_and_classifier(spark):
    rules = (("net/", "block"), ("example.net/en/", "allow"))
    urls = [
        (1, "http://a.b.NET/x?q#f", "a.b.net", "/x", "net/", "block"),
        (2, "https://www.Example.net/en/a", "www.example.net", "/en/a", "example.net/en/", "allow"),
        (3, "http://net", "net", "", None, None),
        (4, None, "", "", None, None),
        (5, "no scheme/net/", "", "", None, None),
        (6, "http://badexample.net/en/", "badexample.net", "/en/", "net/", "block"),
        (7, "http://É.net/" + "x" * 50_000, "É.net", "/" + "x" * 50_000, "net/", "block"),
        (None, "x://net/://y", "net", "/://y", "net/", "block"),
    ]
    urls += [(100 + i, f"http://site{i}.net/cheap-pills/{i}", f"site{i}.net", f"/cheap-pills/{i}", "net/", "block") for i in range(40)]
    urls += [(200 + i, f"http://example.net/en/news/{i}", "example.net", f"/en/news/{i}", "example.net/en/", "allow") for i in range(40)]
    pages = spark.createDataFrame([(i, url, "rule", 0) for i, url, *_ in urls], "page_id long, url string, host string, score int")
    rows = {row.page_id: row for row in filter_urls(pages, rules).collect()}
    for page_id, _, host, path, rule, verdict in urls:
        assert (rows[page_id].host, rows[page_id].path, rows[page_id].rule) == (host, path, rule)
        assert rows[page_id].verdict == verdict if verdict else rows[page_id].verdict in ("allow", "block")
    new = spark.createDataFrame([(1, "http://other.org/cheap-pills/9"), (2, "http://other.org/en/news/9")], "page_id long, url string")
    known = filter_urls(pages, rules).where("rule IS NOT NULL").select("host", "path", "verdict")
    judged = {row.page_id: row.verdict for row in filter_urls(new, (), labelled=known).collect()}
    assert judged == {1: "block", 2: "allow"}
    assert filter_urls(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in filter_urls(pages, (), labelled=known.limit(0)).collect()} == {"allow"}


def highest_quotients(sizes, seats, most):
    won = [0] * len(sizes)
    for _ in range(seats):
        quotients = [(s / (2 * w + 1), -i) for i, (s, w, m) in enumerate(zip(sizes, won, most)) if w < m and s > 0]
        if not quotients:
            break
        won[-max(quotients)[1]] += 1
    return won


def test_apportionment_equals_highest_quotients():
    random.seed(6)
    for _ in range(300):
        sizes = [random.choice([0, 1, 2, 3, 7, 10, 1000]) for _ in range(random.randint(1, 8))]
        most, seats = [random.randint(0, 30) for _ in sizes], random.randint(0, 60)
        assert apportion(np.array(sizes), seats, np.array(most)).tolist() == highest_quotients(sizes, seats, most)


def test_mix_comes_near_its_targets_and_keeps_its_limits(spark, edge):
    random.seed(7)
    docs = [(i, "w " * random.randint(0, 200), random.choice(["big"] * 6 + ["a", "c", None])) for i in range(600)]
    docs += [(1000, "few words only", "tiny")]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    rows = mix(table, shard_words=2_000).collect()
    assert sorted(rows) == sorted(mix(table.repartition(5), shard_words=2_000).collect())
    assert all(0 <= row.taken <= 3 * row.size for row in rows)
    taken, target, size = {}, {}, {}
    for row in rows:
        taken[row.source] = taken.get(row.source, 0) + row.taken
        target[row.source], size[row.source] = row.target, row.source_size
    assert all(abs(taken[s] - target[s]) <= 24 for s in taken)
    # By code point and null last, weights are 1, 2, 3, 1, 2; what is over the limit is shared again.
    weights, total = dict(zip(["a", "big", "c", "tiny", None], [1, 2, 3, 1, 2])), sum(size.values())
    expected, free, left = {}, set(weights), total
    while True:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > 3 * size[s]}
        if not over:
            break
        expected |= {s: 3.0 * size[s] for s in over}
        left, free = left - sum(3 * size[s] for s in over), free - over
    expected |= {s: level * weights[s] for s in free}
    assert all(abs(expected[s] - target[s]) < 1e-6 for s in expected)
    assert len(mix(edge).collect()) == len(EDGE_TEXTS)
    assert mix(edge.limit(0)).count() == 0


def test_mix_apportions_many_shards_in_parts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PART_SHARDS", 4)
    docs = [(i, "w " * (1 + i % 90), "big" if i % 5 else None) for i in range(2000)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mix(table, shard_words=1_000).collect()
    assert len(rows) == 2000 and all(0 <= row.taken <= 3 * row.size for row in rows)
    for source in ("big", None):
        some = [row for row in rows if row.source == source]
        # Only where a part or shard ends within a block can words be missing.
        assert abs(sum(row.taken for row in some) - some[0].target) <= 0.01 * some[0].target


def test_mix_spreads_rows_without_id(spark):
    docs = [(None, f"{i} words here", "s") for i in range(4000)]
    table = spark.createDataFrame(docs, "doc_id long, text string, source string")
    found = mix(table, shard_words=600)
    assert found.count() == 4000
    shards = table.select((F.xxhash64(F.lit(0), "doc_id", F.lit(3).cast("long"), "text") % 20).alias("shard"))
    assert max(row["count"] for row in shards.groupBy("shard").count().collect()) < 400
    assert sum(row.taken for row in found.collect()) == 12_000


def test_language_id_learns_rejects_and_handles_edge_cases(spark, edge):
    random.seed(8)
    syllables = {"xx": ["ka", "to", "mi", "ru"], "yy": ["schl", "ung", "ü", "eit"], "zz": ["д", "жа", "во"]}
    docs = []
    for i in range(240):
        lang = ("xx", "yy", "zz")[i % 3]
        words = ["".join(random.choices(syllables[lang], k=random.randint(1, 4))) for _ in range(random.randint(3, 80))]
        docs.append((i, " ".join(words), lang if i < 180 else None))
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language_id.fit(table)
    rows = {row.doc_id: row for row in language_id.predict(table, model).collect()}
    assert all(rows[i].lang_pred == ("xx", "yy", "zz")[i % 3] and not rows[i].rejected for i in range(240))
    strange = spark.createDataFrame([(1, "漢字漢字漢字"), (2, "123"), (3, None), (4, "")], "doc_id long, text string")
    odd = {row.doc_id: row for row in language_id.predict(strange, model).collect()}
    assert all(row.rejected for row in odd.values())
    assert odd[1].lang_pred in model.languages and {odd[i].lang_pred for i in (2, 3, 4)} == {"und"}
    assert len(language_id.predict(edge, model).collect()) == len(EDGE_TEXTS)
    assert language_id.fit(table.where("lang IS NULL")) is None
    assert {row.lang_pred for row in language_id.predict(edge, None).collect()} == {"und"}


def test_language_id_rejects_a_language_left_out_of_the_fit_despite_odd_rows(spark):
    random.seed(10)
    syllables = {"xx": ["ka", "to", "mi", "ru"], "yy": ["schl", "ung", "ing", "eit"], "left": ["gwy", "fod", "ddo", "pwl"]}
    docs = []
    for i in range(450):
        lang = ("xx", "yy", "left")[i % 3]
        docs.append((i, " ".join("".join(random.choices(syllables[lang], k=3)) for _ in range(random.randint(10, 80))), lang))
    odd = [(1000, "q", "xx"), (1001, "?? 12", "xx"), (1002, None, "yy"), (1003, "vw", "yy")]
    table = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string")
    model = language_id.fit(table.where("lang <> 'left' AND (doc_id % 2 = 0 OR doc_id >= 1000)"))
    rows = {row.doc_id: row for row in language_id.predict(table, model).collect()}
    rejected = {lang: [rows[i].rejected for i, _, own in docs if own == lang] for lang in syllables}
    assert sum(rejected["left"]) > 0.95 * len(rejected["left"])
    assert sum(rejected["xx"] + rejected["yy"]) < 0.02 * 300


def test_a_text_may_have_any_number_of_rows_and_an_id_any_number_of_texts(spark, monkeypatch):
    from snaptrail.llm import exact_dedup

    monkeypatch.setattr(exact_dedup, "PART_COPIES", 4)
    docs = [(1, "same")] * 23 + [(2, "SAME")] * 4 + [(None, "x")] * 5 + [(3, "alone")]
    rows = exact_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert len(rows) == len(docs) and sum(r.kept for r in rows) == 3
    assert {(r.doc_id, r.keep_id, r.group_size) for r in rows if r.keep_id == 2} == {(1, 2, 27), (2, 2, 27)}
    # Different texts of one id, and of none, never share spans; ids may be texts.
    repeated = "abcdefghijklmnopqrstuvwxyz0123"
    texts_of = [(i, f"{n:04d}" + repeated) for n, i in enumerate(["a", "a", None, None, "b"])]
    cleaned = remove_repeats(spark.createDataFrame(texts_of, "doc_id string, text string"), length=20, gram=4).collect()
    kept = sorted((r.doc_id or "", bytes(r.kept)) for r in cleaned)
    assert sum(len(text) > 20 for _, text in kept) == 1 and len(kept) == 5
    assert all(len(text) < 20 for i, text in kept if i)


def test_more_languages_than_are_learned(spark):
    rows = [(f"d{n}-{i}", f"{chr(97 + n % 26)}{chr(97 + n // 26)} " * (3 + i), f"l{n:03d}") for n in range(201) for i in range(2)]
    rows += [(f"more-{i}", "zz yy xx " * 4, "l200") for i in range(3)]
    table = spark.createDataFrame(rows, "doc_id string, text string, lang string").repartition(3)
    model = language_id.fit(table)
    assert len(model.languages) == 201
    few = language_id.fit(table, languages=3)
    assert few.languages == ["l000", "l001", "l200"]
    found = language_id.predict(table, model).select("doc_id", "lang_pred").collect()
    assert len(found) == len(rows)
