from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
from cases import documents, odd_rows
from test_llm_ngram_join import brute, shingles
from test_llm_packing import check, ids_of

from millrace.llm.common import cut
from millrace.llm.mixing import mix


def test_stages_in_turn(spark, sf_dir):
    """Every stage's rows against what it was given."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    given = {}
    for name, stage in corpus_pipeline.STAGES:
        given[name] = docs
        docs = cut(stage(spark, docs, sf_dir))
    first = spark.read.parquet(f"{sf_dir}/documents.parquet").columns
    assert all(d.columns == first for d in given.values())

    known = given["exact_dedup"].collect()
    assert len(known) >= 0.99 * given["language_id"].count()
    last_of = {}
    for r in known:
        last_of[r.text] = max(r.doc_id, last_of.get(r.text, -1))
    unique = given["ngram_join"].collect()
    assert sorted(r.doc_id for r in unique) == sorted(last_of.values())
    roots = brute({r.doc_id: shingles(r.text) for r in unique})
    apart = given["mixing"].collect()
    assert sorted(r.doc_id for r in apart) == sorted(set(roots.values()))
    taken = defaultdict(int)
    for r in given["packing"].collect():
        taken[r.doc_id] += 1
    assert taken == {r.doc_id: r.copies for r in mix(given["mixing"]).collect() if r.copies}
    pieces = docs.collect()
    check([r.asDict() for r in pieces], [r.text for r in given["packing"].collect()])
    assert {r.doc_id: r.doc_tokens for r in pieces} == {r.doc_id: len(ids_of(r.text)) for r in given["packing"].collect()}


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    documents(spark, odd_rows()).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_no_documents(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
