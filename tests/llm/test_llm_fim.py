from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from cases import documents, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm.fim import RankIndex, fill_in_middle, restored, transform_block

TOKEN = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def plain(i, t):
    """A row by the rules, without an index."""
    text = t or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return i, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = ("".join(tokens[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if h4 % 100 < 20:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def rows_of(found):
    return sorted([tuple(r) for r in found], key=str)


ODD = [
    *odd_rows(),
    *[(k, f"{prose(k, 30)} é中\U0001f642 {'ab1' * k}\n\n", "a") for k in range(100, 160)],
    *[(k, f"holds a {m} mark", "a") for k, m in enumerate(("<P>", "<S>", "<M>", "<p>", "<S", "<<M", "P>"), 200)],
    *[(k, "<S" + "<" * (k % 5) + "M>" + ">" * (k % 3), "b") for k in range(210, 240)],
    (300, "x" * 20_000 + " " + "y " * 20_000 + "中" * 20_000, "a"),  # stretches of different slope
]


@pytest.mark.parametrize(("error", "block"), [(127, 8 << 20), (0, 1000), (3, 100_000)])
def test_odd_rows(spark, error, block):
    made = fill_in_middle(documents(spark, ODD), error, block)
    got = made.select("*", restored(F.col("form"), F.col("output")).alias("back")).collect()
    assert rows_of(r[:6] for r in got) == rows_of(plain(i, t) for i, t, _ in ODD)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t, _ in ODD)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    assert fill_in_middle(documents(spark, [])).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab Z9é中\U0001f642<PSM>\n", max_size=40), max_size=8), st.sampled_from([0, 1, 127]))
def test_blocks(texts, error):
    if not texts:
        return
    got = transform_block(list(range(len(texts))), [t.encode() for t in texts], error)
    want = [plain(i, t) for i, t in enumerate(texts)]
    assert [(*r[:5], r[5].decode()) for r in got] == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=400), st.integers(0, 127))
def test_index_is_exact_and_bounded(steps, error):
    offsets = np.cumsum(steps)
    index = RankIndex(offsets, error)
    ranks = np.arange(len(offsets))
    assert (index.offsets(ranks) == offsets).all()
    assert np.abs(index.predict(ranks) - offsets).max() <= error


def test_index_of_long_texts_is_small():
    """One segment for hundreds of boundaries, over more than one doubling."""
    rng = np.random.default_rng(1)
    offsets = np.cumsum(rng.integers(1, 9, 1_000_000))
    index = RankIndex(offsets)
    assert (index.offsets(np.arange(len(offsets))) == offsets).all()
    assert len(index.firsts) < len(offsets) / 300
    assert index.residuals.dtype == np.int8
