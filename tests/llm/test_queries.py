"""Registered queries against DuckDB or brute force, and the pipeline against its operators."""

import zlib

import pytest

import corpus_pipeline
from snaptrail.llm import queries as llm
from tests.compare import connect, duckdb_rows, spark_rows
from tests.llm.test_operators import brute_contamination, sets_of

SF_DIR = "/root/testdata/sf0.001"
QUERIES = llm.queries()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()


@pytest.mark.parametrize("name", llm.oracle_sql())
def test_query_equals_oracle(spark, name):
    columns, rows = spark_rows(QUERIES[name](spark, SF_DIR))
    assert (columns, rows) == duckdb_rows(connect(SF_DIR), llm.oracle_sql()[name])


@pytest.mark.parametrize("name", ["op1_exact_dedup", "op5_decontamination", "op8_url_filter"])
def test_native_queries_have_no_python_stage(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not [word for word in ("Python", "Pandas", "InArrow") if word in plan]


def test_held_out_accuracy(spark, docs):
    langs = {row.doc_id: row.lang for row in docs}
    rows = QUERIES["op10_language_id"](spark, SF_DIR).collect()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    held = [row.lang_pred == langs[row.doc_id] for row in rows if row.held_out]
    assert sum(held) / len(held) > 0.9
    scores = QUERIES["op4_toxicity"](spark, SF_DIR).collect()
    assert len(scores) == len(docs) and all(row.predicted == (row.score >= 0.5) for row in scores)


def test_stages_make_the_pipeline(spark, docs):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    clean = corpus_pipeline.known_language(spark, table, SF_DIR)
    assert clean.columns == table.columns and clean.count() == len(docs)
    near = corpus_pipeline.near_duplicates(spark, table, SF_DIR).collect()
    sets = sets_of((row.doc_id, row.text) for row in docs)
    kept = {row.doc_id for row in near}
    for row in docs:
        similar = [
            i for i in sets if i != row.doc_id and 100 * len(sets[i] & sets[row.doc_id]) >= 80 * len(sets[i] | sets[row.doc_id])
        ]
        if not similar:
            assert row.doc_id in kept
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    expected = brute_contamination([(r.doc_id, r.text) for r in docs], [(r.item_id, r.text) for r in items])
    apart = corpus_pipeline.uncontaminated(spark, table, SF_DIR).collect()
    assert {row.doc_id for row in apart} == {i for i, (_, hit, _) in expected.items() if not hit}
    last = corpus_pipeline.run(spark, SF_DIR).orderBy("start").collect()
    assert {row.doc_id for row in last} <= kept & {row.doc_id for row in apart}
    assert [row.start for row in last] == [sum(r.n_tokens for r in last[:i]) for i in range(len(last))]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_take_edge_cases(spark, name, stage):
    from tests.llm.test_operators import EDGE_TEXTS

    rows = [(i, t, "en" if i == 1 else None, None, None) for i, t in EDGE_TEXTS]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for given in (table, table.limit(0)):
        result = stage(spark, given, SF_DIR)
        assert name == "token_files" or result.columns == given.columns
        assert result.count() <= 3 * given.count()


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_stages_decide_by_row_where_ids_repeat_or_are_null(spark, docs):
    leak = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").first().text
    clean = "one clean text of more than five words that no other text is like"
    other = "something else entirely is written here and it shares nothing at all"
    near = " ".join(f"w{i}" for i in range(200))
    pairs = [(None, clean), (None, leak), (7, other), (7, leak)]
    table = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in pairs], DOCS).repartition(2)
    apart = corpus_pipeline.uncontaminated(spark, table, SF_DIR).collect()
    assert {(r.doc_id, r.text) for r in apart} == {(None, clean), (7, other)} and len(apart) == 2

    known = [(r.doc_id, r.text, r.lang, r.source, 1) for r in docs]
    odd = [(None, docs[0].text, None, "a", 1), (None, "123 456", None, "a", 1), (-7, docs[1].text, None, "a", 1), (-7, "7 8", None, "a", 1)]
    clean_rows = corpus_pipeline.known_language(spark, spark.createDataFrame(known + odd, DOCS), SF_DIR).collect()
    texts = {(r.doc_id, r.text) for r in clean_rows}
    assert {(None, docs[0].text), (-7, docs[1].text)} <= texts and not {(None, "123 456"), (-7, "7 8")} & texts

    rows = [(5, other), (5, other), (None, clean), (None, clean), (8, near), (8, near + " end"), (9, near + " and"), (None, near), (9, "quite alone")]
    table = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS).repartition(3)
    kept = corpus_pipeline.near_duplicates(spark, table, SF_DIR).collect()
    assert len(kept) == 4
    assert {(r.doc_id, r.text) for r in kept if r.doc_id != 8} == {(5, other), (None, clean), (9, "quite alone")}


def test_mixing_takes_each_row_as_often_as_the_mix_does(spark):
    from collections import Counter

    from snaptrail.llm.mixing import mix

    rows = [(i, f"{word} " * (4 + i), None, "a", 1) for i, word in enumerate(["x", "y"] * 60)]
    rows += [(None, f"no{i} id " * 8, None, "b", 1) for i in range(20)] + [(1, "same row " * 4, None, "b", 1)] * 9
    table = spark.createDataFrame(rows, DOCS).repartition(3)
    found = Counter((r.doc_id, len(r.text.split())) for r in corpus_pipeline.mixed(spark, table, SF_DIR).collect())
    expected = Counter()
    for r in mix(table).collect():
        expected[r.doc_id, r["size"]] += (2 * r.taken + r["size"]) // (2 * r["size"])
    assert found == +expected
