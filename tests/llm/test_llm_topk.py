from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.topk import Best, Group, Turned, first_bounds, paired, principal_axes, products, quantised, segment_edges, statistics, top_k

VECTORS = "vec_id long, embedding array<float>, score int, rank string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], VECTORS).repartition(3)


def brute(rows, asked, k):
    def whole(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            return None
        return [int(np.floor(256 * float(np.float32(x)))) for x in v]

    usable = [(i, w) for i, v in rows if i is not None and (w := whole(v)) is not None]
    out = []
    for q, a in usable:
        if asked(q):
            found = [(-sum(x * y for x, y in zip(a, b, strict=True)), c) for c, b in usable if c != q and len(a) == len(b)]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(found)[:k])]
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_against_brute_force(spark, block_bytes):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 20)]) for i in range(300)]
    rows += [(400 + i, rows[i][1]) for i in range(20)]  # ties
    rows += [(500 + i, [float(x) for x in rng.normal(0, 1, 3)]) for i in range(4)]  # of another length
    rows += [(600, None), (610, []), (620, []), (630, [1.0, None]), (640, [float("nan")] * 20), (650, [float("inf")] * 20)]
    rows += [(None, rows[0][1]), (660, [0.0] * 20), (670, [-1e9] * 20), (680, [3e9] * 20)]
    df = vectors(spark, rows)
    found = top_k(df, df.filter("vec_id % 10 = 0"), block_bytes=block_bytes)
    assert sorted(map(tuple, found.collect())) == brute(rows, lambda i: i % 10 == 0, 5)


def test_repeated_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [0.5, 0.5])]
    df = vectors(spark, rows)
    found = sorted(map(tuple, top_k(df, df.filter("vec_id = 0")).collect()))
    one = [(0, 1, 1, 131072), (0, 2, 1, 131072), (0, 3, 2, 32768)]
    assert found == sorted(one * 2)


def test_empty_tables(spark):
    df = vectors(spark, [(1, [1.0])])
    assert top_k(df, df.filter("false")).collect() == [] and top_k(df.filter("false"), df).collect() == []
    assert top_k(df, df).collect() == []


whole = st.lists(st.lists(st.integers(-400, 400), min_size=7, max_size=7), min_size=1, max_size=6)


@settings(max_examples=100, deadline=None)
@given(whole, whole, st.sampled_from([0.0, 1 / 8, 1 / 2, 5 / 8, 1.0]), st.booleans())
def test_statistics_bound_products(a, b, leading, turn):
    x, y = np.array(a, float), np.array(b, float)
    axes = principal_axes(x) if turn else np.eye(7)
    edges = segment_edges(7, leading)
    bound = statistics(x @ axes, edges) @ statistics(y @ axes, edges).T
    exact = products(x, y)
    assert (bound + 1e-9 * np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)) + 1e-6 >= exact).all()
    assert (exact == [[sum(p * q for p, q in zip(u, v, strict=True)) for v in b] for u in a]).all()
    pairs = [(i, j) for i in range(len(x)) for j in range(len(y))]
    assert paired(x[[i for i, _ in pairs]], y[[j for _, j in pairs]]).tolist() == [exact[i, j] for i, j in pairs]


def test_axes_are_orthogonal():
    rng = np.random.default_rng(2)
    for sample in (rng.normal(0, 100, (50, 12)), np.zeros((3, 5)), np.empty((0, 4)), rng.normal(0, 1e150, (4, 9)), np.empty((5, 0))):
        axes = principal_axes(sample)
        assert np.allclose(axes.T @ axes, np.eye(sample.shape[1]), atol=1e-12)


def test_bounds_drop_pairs_of_the_table(sf_dir):
    """On the embeddings given, more than half of all pairs get no exact distance."""
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    (_, m), = quantised(table["embedding"])
    ids = np.arange(len(m))
    some = np.random.default_rng(0).choice(len(m), 500, replace=False)
    axes, asked = principal_axes(m[some]), ids[::50]
    group = Group(asked, asked, m[asked], axes, first_bounds(asked, m[asked], some, m[some], 5), 5)
    for at in range(0, len(m), 400):
        group.meet(ids[at : at + 400], Turned(m[at : at + 400], axes))
    assert group.met == len(asked) * len(m) and group.pairs < 0.5 * group.met
    score = products(m[asked], m)
    score[ids[None, :] == asked[:, None]] = -(1 << 62)
    for row, q in enumerate(asked):
        best = np.lexsort((ids, -score[row]))[:5]
        assert group.best.id[group.best.row == row].tolist() == best.tolist()


@pytest.mark.parametrize("sample", [0, 10, 2048])
def test_queries_from_outside(spark, sample):
    """Queries that are no vectors themselves, larger than these, and some that share an id with one of them."""
    rng = np.random.default_rng(8)
    inside = [(i, [float(x) for x in rng.normal(0, 0.3, 12)]) for i in range(60)]
    outside = [(1000 + i, [float(x) for x in rng.normal(0, 3, 12)]) for i in range(30)] + [(5, [9.0] * 12), (7, [1.0] * 3)]
    found = top_k(vectors(spark, inside), vectors(spark, outside), sample=sample)
    whole = lambda v: np.floor(256 * np.float32(v).astype(float))
    want = []
    for q, a in outside:
        scored = sorted((-int(whole(a) @ whole(b)), i) for i, b in inside if i != q and len(a) == len(b))
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:5])]
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_large_numbers_stay_exact():
    a, b = np.array([[2.0**40 + 1, 3.0]]), np.array([[2.0**40 - 1, 7.0], [-(2.0**40), 0.0]])
    assert products(a, b).tolist() == [[(2**40 + 1) * (2**40 - 1) + 21 if (2**80) < 2**63 else 2**63 - 1, -(2**63 - 1)]]
    c = np.array([[2.0**30 + 1, 3.0]])
    assert products(c, c).tolist() == [[(2**30 + 1) ** 2 + 9]]


def test_quantised_leaves_out_unusable_rows():
    column = pa.array([[0.5, -0.001], None, [1.0], [float("nan"), 1.0], [None, 1.0], []], pa.list_(pa.float32()))
    found = {v.shape[1]: (rows.tolist(), v.tolist()) for rows, v in quantised(column)}
    assert found == {2: ([0], [[128.0, -1.0]]), 1: ([2], [[256.0]]), 0: ([5], [[]])}


def test_best_keeps_smaller_ids_of_ties():
    best = Best(1, 2)
    for ids in ([9, 4], [7, 1]):
        best.add(np.zeros(2, int), np.array(ids), np.array([5, 5]))
    assert best.id.tolist() == [1, 4] and best.least.tolist() == [5]
