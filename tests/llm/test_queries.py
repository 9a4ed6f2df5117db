"""The registered training-data queries: SQL where SQL can express them, and the
pipeline's stages on whole tables."""

from __future__ import annotations

import zlib

import pytest

import corpus_pipeline
from marketlake.llm.catalog import QUERIES
from marketlake.llm.oracles import ORACLES
from tests.conftest import SF_CHECK, SF_SMALL, plan_text
from tools.oracle_check import duck, rows_key

NATIVE = ["op1_line_dedup", "op5_url_filters", "op6_chat_formatting"]
PYTHON = ("Python", "Pandas", "Arrow")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, SF_CHECK)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SF_CHECK).execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_key(df.columns, rows) == rows_key(columns, cur.fetchall())


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    text = plan_text(QUERIES[name](spark, SF_SMALL))
    assert not any(p in text for p in PYTHON)


def test_all_operators_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.columns == columns, name
    assert 0 < docs.count() <= before
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL)
    assert set(columns) < set(last.columns)
    assert [s for s, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "minhash_dedup", "mixing", "bpe_encoding"]


def test_quality_on_held_out_labels(spark):
    rows = QUERIES["op7_quality"](spark, SF_CHECK).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_CHECK}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0.0 <= r.score <= 1.0 and r.predicted == (r.score >= 0.3) for r in rows)
    judged = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in judged) >= 0.95 * len(judged)
    good = [r for r in judged if labels[r.doc_id] == 1]
    assert sum(r.predicted for r in good) >= 0.97 * len(good)
