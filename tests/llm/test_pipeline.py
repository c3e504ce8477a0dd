"""The pipeline against a brute-force version, and the queries against their SQL."""

import os
from collections import Counter

import pytest
from llm_cases import documents, hits, jaccard, lines_left, odd_rows

import corpus_pipeline
from check import compare, oracle
from waybill.llm import catalog, language_id

FOLDER = os.environ.get("WAYBILL_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("name", list(catalog.SQL))
def test_same_as_sql(spark, name):
    problems = compare(catalog.QUERIES[name](spark, FOLDER), oracle(FOLDER), catalog.SQL[name])
    assert [p for p in problems if not p.startswith("note")] == []


def test_every_operator_has_its_query():
    names = list(catalog.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(
        range(1, 14))
    assert "pipeline" in names


def test_pipeline_is_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet")
             .select("item_id", "text").collect()]
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    lang = {r.row.doc_id: r for r in language_id.language_id(docs).collect()}
    rows = [r for r in rows if lang[r[0]].lang_pred != "und"]
    rows = [(r[0], t, r[2], r[3], len(t)) for r, t in zip(rows, lines_left(rows), strict=True)]
    keep = {c for _, _, c in jaccard(rows)}
    rows = [r for r in rows if r[0] in keep]
    rows = [r for r, (_, places, _) in zip(rows, hits(rows, bench), strict=True) if not places]
    got = corpus_pipeline.run(spark, FOLDER).collect()
    by_id = {r[0]: r for r in rows}
    assert 0 < len(got) <= len(rows)
    for r in got:
        assert tuple(r)[:5] == by_id[r.doc_id] and 1 <= r.copies <= 3
    assert len({r.doc_id for r in got}) == len(got)
    # the stage before the mix keeps exactly the brute-force rows
    out = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, FOLDER)
        assert out.columns == docs.columns
    assert Counter(tuple(r) for r in out.collect()) == Counter(rows)


def test_stages_take_odd_rows_and_empty_tables(spark):
    docs = documents(spark, odd_rows())
    for rows in (docs, docs.limit(0)):
        out = rows
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, rows, FOLDER).columns == docs.columns
            stage(spark, rows, FOLDER).count()
            out = stage(spark, out, FOLDER)
        out = corpus_pipeline.STAGES[-1][1](spark, out, FOLDER)
        assert out.columns == [*docs.columns, "copies"]
        out.collect()


def test_stages_take_a_column_of_the_mix_s_own_name(spark):
    docs = documents(spark, odd_rows()).selectExpr("*", "0 as copies")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert out.columns == [*docs.columns, "copies_"] and out.count() > 0


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = corpus_pipeline.identify_language(spark, docs, FOLDER)
    assert kept.count() == docs.where("text rlike '[a-zA-Z]'").count()
