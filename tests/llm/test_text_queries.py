"""The registered queries against SQL or brute force on the given tables, and the pipeline."""

from __future__ import annotations

import os
import zlib

import duckdb
import pytest

import brute
import corpus_pipeline
from weftgraph.llm import queries as text_queries
from weftgraph.llm.sql import oracle_sql

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_agrees_with_sql(spark, duck, name):
    found = text_queries.queries()[name](spark, FOLDER)
    want = duck.sql(oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(want.columns)
    nulls_first = lambda row: [(v is not None, v) for v in row]
    got = sorted((tuple(r) for r in found.select(*columns).collect()), key=nulls_first)
    assert got == sorted(want.select(", ".join(columns)).fetchall(), key=nulls_first)


def texts(duck):
    return duck.sql("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def test_suffix_query(spark, duck):
    rows = texts(duck)
    found = text_queries.op5_suffix_dedup(spark, FOLDER).orderBy("doc_id").collect()
    want = brute.bytes_removed([t for _, t in rows], 400)
    assert [tuple(r) for r in found] == [(d, *w) for (d, _), w in zip(rows, want)]


def test_jaccard_query(spark, duck):
    found = text_queries.op9_jaccard_join(spark, FOLDER).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute.linked_components(texts(duck))


def test_language_query_is_right_on_held_out_documents(spark, duck):
    folder = "/root/testdata/sf0.01"
    labels = dict(duck.sql(f"SELECT doc_id, lang FROM '{folder}/documents.parquet'").fetchall())
    rows = text_queries.op4_language(spark, folder).collect()
    assert len(rows) == len(labels)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    judged = [r["lang_pred"] == labels[r["doc_id"]] for r in rows if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(judged) / len(judged) > 0.95


def test_language_model_query_beats_its_base_on_held_out_documents(spark):
    rows = [r for r in text_queries.op7_language_model(spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_pipeline(spark, duck):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, FOLDER)
        if name != "token_output":
            assert result.columns == columns
        path = corpus_pipeline.Scratch(spark).folder(name)
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = [r["doc_id"] for r in docs.orderBy(corpus_pipeline.place_in_files(docs)).collect()]
    # Each stage on all its predecessor kept, by plain means.
    own = [(d, t) for d, t in texts(duck) if d in set(kept["language_id"])]
    groups = brute.linked_components(own)
    assert sorted(kept["near_duplicates"]) == sorted(d for d, (_, c) in groups.items() if d == c)
    hit = text_queries.op3_decontaminate(spark, FOLDER).where("contaminated").collect()
    assert sorted(kept["decontamination"]) == sorted(set(kept["near_duplicates"]) - {r["doc_id"] for r in hit})
    assert sorted(kept["mixing"]) == sorted(kept["decontamination"])
    final = docs.orderBy("start").collect()
    assert [r["doc_id"] for r in final] == kept["mixing"]
    assert all(b["start"] == a["start"] + a["n_tokens"] for a, b in zip(final, final[1:]))
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, final))
