"""The pipeline: stages in order, columns kept, and its result against its own parts."""

import re

import corpus_pipeline as P
from splatlake.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark, documents):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = docs.collect()
    kept = P.language_id(spark, docs, FOLDER)
    assert kept.columns == docs.columns and kept.count() == len(rows)  # all have letters
    single = P.near_duplicates(spark, kept, FOLDER)
    groups = {r.doc_id: r.component_id for r in queries.QUERIES["op3_ngram_jaccard"](spark, FOLDER).collect()}
    assert {r.doc_id for r in single.collect()} == {i for i, c in groups.items() if i == c} and single.columns == docs.columns
    mixed = P.mix_sources(spark, single, FOLDER)
    assert mixed.columns == docs.columns and 0 < mixed.count() <= single.count()


def test_near_duplicates_with_odd_ids(spark, documents):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (2, "other words"), (None, "a b c d e f g"), (3, None), (3, None), (4, "")]
    left = [(r.doc_id, r.text) for r in P.near_duplicates(spark, documents(rows), FOLDER).collect()]
    assert sorted(left, key=str) == sorted([(1, rows[0][1]), (2, "a b c d e f g"), (2, "other words"), (None, rows[0][1]), (3, None), (4, "")], key=str)


def test_all_queries_are_there():
    import __spark_entry__ as entry

    assert {m[0] for n in entry.queries() if (m := re.match(r"op\d+(?=_)", n))} == {f"op{i}" for i in range(1, 14)} and "pipeline" in entry.queries()
