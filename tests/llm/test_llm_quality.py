from __future__ import annotations

import zlib

import numpy as np
from cases import documents, odd_rows, prose

from millrace.llm import quality
from millrace.llm.common import held_out
from millrace.llm.quality import CHUNK, STEP, STRIDE, WIDTH, Network, chunk_count, fit, score, train
from millrace.llm.queries import QUERIES
from pyspark.sql import functions as F


def slow(net: Network, data: bytes) -> float:
    """The network chunk by chunk and position by position."""
    n = chunk_count(len(data))
    padded = np.frombuffer(data, np.uint8).tolist() + [32] * (n * STRIDE + STEP + WIDTH)
    units = []
    for c in range(n):
        best = np.full(net.filters.shape[2], -np.inf)
        for p in range(c * STRIDE, c * STRIDE + CHUNK):
            best = np.maximum(best, sum(net.filters[k, padded[p + k]] for k in range(WIDTH)))
        units.append(np.maximum(np.maximum(best + net.bias, 0) @ net.hidden + net.hidden_bias, 0))
    u = np.array(units)
    logit = float(np.concatenate([u.mean(0), u.max(0), u.min(0)]) @ net.last + net.last_bias[0])
    return 1 / (1 + np.exp(-logit))


def test_scores_against_a_plain_reading(monkeypatch):
    net = Network.fresh(3)
    net.last *= 5
    texts = [prose(k, n).encode() for k, n in enumerate((0, 1, 9, 30, 33, 40, 200, 400))] + [b"\x00\xff" * 300, "é中🙂".encode() * 40]
    want = [slow(net, t) for t in texts]
    assert np.allclose(net.score(texts), want, atol=1e-4)
    monkeypatch.setattr(quality, "_PIECE", 2 * STRIDE)  # every text alone, long ones in pieces
    assert np.allclose(net.score(texts), want, atol=1e-4)


def test_chunks_cover_whole_texts():
    for n in range(0, 3000, 7):
        assert (chunk_count(n) - 1) * STRIDE + CHUNK >= n
        assert chunk_count(n) == 1 or (chunk_count(n) - 2) * STRIDE + CHUNK < n


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = Network.fresh(1)
    for part in (net.bias, net.last_bias):
        part += rng.normal(0, 0.3, part.shape).astype(np.float32)
    net = Network(*[p.astype(np.float64) for p in net.parts()])
    windows = rng.integers(97, 105, (5, 40 + WIDTH - 1)).astype(np.uint8)
    bounds, label, weight = np.array([0, 2]), np.array([1.0, 0.0]), np.array([1.0, 3.0])

    def loss() -> float:
        total = sum(net.filters[k][windows[:, k : k + 40]] for k in range(WIDTH)).max(axis=1)
        hidden = np.maximum(np.maximum(total + net.bias, 0) @ net.hidden + net.hidden_bias, 0)
        logit = net._combined(total, bounds) @ net.last + net.last_bias
        assert hidden.shape[0] == 5
        p = 1 / (1 + np.exp(-logit))
        return float(-(weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).sum() / weight.sum())

    for part, grad in zip(net.parts(), net.gradients(windows, bounds, label, weight), strict=True):
        flat, slope = part.reshape(-1), np.asarray(grad).reshape(-1)
        for i in rng.choice(len(flat), min(len(flat), 12), replace=False):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - slope[i]) < 1e-3


def test_held_out_accuracy(spark, sf_dir):
    """The tables of this size have too few labels; those of the next one teach, this one's are not among them."""
    known = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    net = train(docs, known.filter(~held_out(F.col("doc_id"))))
    sized = docs.select("doc_id", F.octet_length("text").alias("size"))
    found = score(docs, net).join(known, "doc_id").join(sized, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in found) >= 0.975 * len(found)
    long = [r for r in found if r.size > 12 * STRIDE]
    assert len(long) > 100 and sum(r.predicted == r.quality for r in long) >= 0.99 * len(long)


def test_training_sees_every_chunk_as_scoring_does():
    """No text is shortened and no chunk reaches over a seam."""
    for n in (0, 10, 300, 5000, 40_000):
        text = bytes(np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8))
        seen = quality._windows(text)
        assert len(seen) == chunk_count(n)
        padded = text + b" " * (CHUNK * 2)
        assert all(bytes(w) == padded[k * STRIDE : k * STRIDE + CHUNK + WIDTH - 1] for k, w in enumerate(seen))


def test_sample_is_bounded_by_documents(spark):
    """Labels and rows of one document that repeat stay one row, and its label counts as often."""
    rows = [(i, f"text {i} {k}", "a") for i in range(40) for k in range(1 + 50 * (i == 3))]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(3, 1)] * 500, "doc_id long, quality int")
    found = quality._sample(documents(spark, rows), labels, 1000).collect()
    assert sorted(r.doc_id for r in found) == list(range(40))
    assert {r.weight for r in found if r.doc_id != 3} == {1.0} and [r.weight for r in found if r.doc_id == 3] == [501.0]


def test_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(quality, "PART_ROWS", 10)
    monkeypatch.setattr(quality, "ROUNDS", 2)
    docs = documents(spark, [(k, prose(k, 30) if k % 2 else "$$$ " * 30, "a") for k in range(60)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int")
    first, second = train(docs, labels), train(docs.repartition(7), labels)
    assert all((a == b).all() for a, b in zip(first.parts(), second.parts(), strict=True))


def test_query(spark, sf_dir):
    rows = QUERIES["op10_quality"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_odd_rows(spark):
    net = fit([prose(k, 40).encode() for k in range(20)] + [b"$$$ " * 40] * 20, np.array([1.0] * 20 + [0.0] * 20), np.ones(40))
    found = score(documents(spark, odd_rows()), net).collect()
    assert len(found) == len(odd_rows()) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (5, 6)}) == 1
    assert [r.predicted for r in found if r.doc_id == 1] == [1]
    assert score(documents(spark, []), net).collect() == []


def test_too_little_to_learn(spark):
    docs = documents(spark, odd_rows())
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0), (3, 7)], "doc_id long, quality int")
    assert train(docs, labels.filter("false")) == 0.5 and train(docs, labels) == 1.0
    assert {r.score for r in score(docs, 0.5).collect()} == {0.5}
