"""The registered queries: against SQL where there is any, and the pipeline's stages against brute force."""

from __future__ import annotations

import os
import re

import duckdb
import pytest
import sentencepiece
from oracle_check import differences
from test_similar import plain_kept

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tillmark.llm.pieces import MODEL_FILE
from tillmark.llm.queries import LLM_ORACLES, LLM_REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
NATIVE = ("op2_exact_dedup", "op4_secret_scan", "op7_fingerprints")


def test_all_are_registered():
    assert {*LLM_REGISTRY, "pipeline"} <= set(queries()) and set(LLM_ORACLES) <= set(oracle_sql())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in LLM_REGISTRY} == set(range(1, 14))


@pytest.mark.parametrize("name", list(LLM_ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    assert differences(LLM_REGISTRY[name](spark, SF_DIR), con, LLM_ORACLES[name]) == ""


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, name):
    plan = LLM_REGISTRY[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoopJoin|ExternalRDD", plan)


def test_stages_equal_brute_force(odd, spark):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    stages = dict(corpus_pipeline.STAGES)
    docs = stages["language"](spark, odd, SF_DIR)
    assert docs.columns == odd.columns and {1, 2, 5, 9}.isdisjoint(r.doc_id for r in docs.collect())
    before = {(r.doc_id, r.text) for r in docs.collect()}
    docs = stages["exact_dedup"](spark, docs, SF_DIR)
    best = {}
    for i, t in before:
        best[low(t)] = max(best.get(low(t), -1), -1 if i is None else i)
    kept = sorted((-1 if r.doc_id is None else r.doc_id, low(r.text)) for r in docs.collect())
    assert docs.columns == odd.columns and kept == sorted((i, t) for t, i in best.items())
    unnamed = 1 << 60  # rows without an id come last
    want = plain_kept([(unnamed if r.doc_id is None else r.doc_id, r.text) for r in docs.collect()])
    docs = stages["near_dedup"](spark, docs, SF_DIR)
    assert docs.columns == odd.columns and sorted(unnamed if r.doc_id is None else r.doc_id for r in docs.collect()) == want
    here = {(r.doc_id, r.text) for r in docs.collect()}
    docs = stages["mixture"](spark, docs, SF_DIR)
    assert docs.columns == odd.columns and {(r.doc_id, r.text) for r in docs.collect()} <= here
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)
    out = stages["sentencepiece"](spark, docs, SF_DIR).collect()
    assert len(out) == docs.count() and all(r.ids == library.encode(r.text) and r.n_tokens == len(r.ids) for r in out)


def test_stages_and_their_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixture", "sentencepiece"]
