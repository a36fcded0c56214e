from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from cases import documents, odd_rows, prose

from millrace.llm import mixing
from millrace.llm.mixing import mix, mixed, targets, word_count
from millrace.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def wanted(sizes: dict) -> dict:
    """Shared by weight; what is above a cap is shared anew among the others until nothing is."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in full)
        share = sum(weight[s] for s in names if s not in full)
        out = {s: 3.0 * sizes[s] if s in full else rest * weight[s] / share for s in names}
        over = {s for s in names if s not in full and out[s] > 3 * sizes[s]}
        if not over:
            return out
        full |= over


def check(rows: list, longest_miss: bool = True) -> None:
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
    want = wanted(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
    for s in sizes:
        assert targets[s] == pytest.approx(want[s])
        most = max(r["size"] for r in rows if r["source"] == s)
        assert abs(taken[s] - want[s]) <= most + 1


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r for r in docs.collect()}
    first = sorted(map(tuple, QUERIES["op4_mixing"](spark, sf_dir).collect()))
    rows = [dict(zip(("doc_id", "size", "source_size", "target", "taken"), r, strict=True)) for r in first]
    for r in rows:
        r["source"] = texts[r["doc_id"]].source
        assert r["size"] == len(WORD.findall(texts[r["doc_id"]].text or ""))
    check(rows)
    assert sorted(map(tuple, QUERIES["op4_mixing"](spark, sf_dir).collect())) == first


def test_odd_rows(spark):
    docs = documents(spark, odd_rows())
    found = mix(docs)
    assert found.columns == [*(c for c in docs.columns if c != "size"), "size", "source_size", "target", "copies", "taken"]
    rows = [r.asDict() for r in found.collect()]
    assert len(rows) == len(odd_rows())
    check(rows)
    assert {r["taken"] for r in rows if not (r["text"] or "").strip()} == {0}


def test_stage_repeats_rows(spark):
    docs = documents(spark, odd_rows())
    again = mixed(docs)
    assert again.columns == docs.columns
    copies = defaultdict(int)
    for r in mix(docs).collect():
        copies[(r.doc_id, r.text)] += r.copies
    got = defaultdict(int)
    for r in again.collect():
        got[(r.doc_id, r.text)] += 1
    assert got == {k: n for k, n in copies.items() if n}


@pytest.mark.parametrize("chunk", [100_000, 7])
def test_one_size_for_very_many(spark, monkeypatch, chunk):
    monkeypatch.setattr(mixing, "CHUNK", chunk)
    rows = [(i, prose(1, 10), "a") for i in range(300)] + [(1000 + i, prose(i, 1 + i % 40), "b") for i in range(200)]
    found = [r.asDict() for r in mix(documents(spark, [*rows, *((5000 + i, "one", "c") for i in range(50))])).collect()]
    check(found)
    copies = {r["copies"] for r in found if r["source"] == "a"}
    assert max(copies) - min(copies) <= 1


def test_rates_are_tilted_by_size(spark):
    """Within a source whose target is below its size, longer documents get fewer copies."""
    rows = [(i, prose(i, 10 if i % 2 else 200), "c") for i in range(400)] + [(9000 + i, prose(i, 50), "a") for i in range(400)]
    found = mix(documents(spark, rows)).filter("source = 'c'").groupBy("size").avg("copies").collect()
    mean = {r[0]: r[1] for r in found}
    assert mean[200] < mean[10]


def test_empty_tables(spark):
    assert mix(documents(spark, [])).collect() == []
    assert [r.taken for r in mix(documents(spark, [(1, None, "a"), (2, "", None)])).collect()] == [0, 0]


def test_very_many_sources(spark):
    """Targets against the plain rule; no window holds all sources, and no chunk all documents without an id."""
    rng = random.Random(1)
    sizes = {(None if k == 7 else f"s{k:05d}é"): rng.choice([0, 1, 5, 50, rng.randrange(5000)]) for k in range(3000)}
    found = targets(spark.createDataFrame(list(sizes.items()), "source string, words long"))
    want = wanted(sizes)
    rows = found.collect()
    assert len(rows) == 3000 and all(r.target == pytest.approx(want[r.source], rel=1e-9) for r in rows)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    assert {r.sid: r.source for r in rows} == dict(enumerate(order, 1))
    plan = found._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and not re.search("Python|Arrow", plan)


def test_documents_without_ids_are_dealt_over_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 10)
    docs = documents(spark, [(None, prose(k, 6), "a") for k in range(400)] + [(k, prose(k, 9), "b") for k in range(100)])
    check([r.asDict() for r in mix(docs).collect()])
    place = mix(docs).filter("doc_id is null").groupBy("copies").count().collect()
    assert len(place) <= 2


def test_word_count(spark):
    texts = ["", None, " a ", "a\tb\nc\x0bd\x0ce\rf g", "é x  y", "x" * 10_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(word_count(df.t)).collect()]
    assert got == [len(WORD.findall(t or "")) for t in texts]


def test_plan_has_no_python(spark, sf_dir):
    plan = QUERIES["op4_mixing"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
