from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from unittest.mock import patch

import numpy as np
import pytest
from cases import documents, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import ngram_join
from millrace.llm.common import map_batches
from millrace.llm.components import components
from millrace.llm.ngram_join import least_overlap, linked, needed, ngram_groups, one_of_each_group, prefix_length, t_occurrences
from millrace.llm.queries import QUERIES
from millrace.llm.shingles import _SEGMENT, sets_of, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text: str | None) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute(sets: dict) -> dict:
    """Smallest member of everything that chains of links reach."""
    at: dict = {i: i for i in sets}

    def root(x):
        while at[x] != x:
            x = at[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                a, b = sorted((root(i), root(j)))
                at[b] = a
    return {i: root(i) for i in sets}


def test_query_against_brute_force(spark, sf_dir):
    rows = QUERIES["op1_ngram_join"](spark, sf_dir).collect()
    sets = {r.doc_id: shingles(r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = brute(sets)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == sorted(
        (i, len(s), want[i]) for i, s in sets.items()
    )
    assert len(set(want.values())) < len(want)


def test_odd_rows(spark):
    found = ngram_groups(documents(spark, odd_rows())).collect()
    assert len(found) == len(odd_rows())
    got = {r.doc_id: r for r in found if r.doc_id is not None}
    assert [got[i].component_id for i in (1, 2, 3, 4)] == [1, 1, 1, 4]
    assert [(got[i].n_shingles, got[i].component_id) for i in (5, 6, 7)] == [(0, 5), (0, 6), (0, 7)]
    assert got[8].component_id == got[9].component_id == 8 and got[8].n_shingles == 1
    assert got[10].component_id == got[11].component_id == 10
    assert {(r.n_shingles, r.component_id) for r in found if r.doc_id is None} == {(6, None), (0, None)}


def test_stage_keeps_one_of_each_group(spark):
    docs = documents(spark, odd_rows())
    kept = one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 4, 5, 6, 7, 8, 10, 12, 13]


def test_empty_table(spark):
    assert ngram_groups(documents(spark, [])).collect() == []


@pytest.mark.parametrize("block_words", [1_000_000, 400])
def test_groups_beyond_a_block(spark, block_words):
    rng = random.Random(5)
    rows = []
    for g in range(3):
        base = prose(100 + g, 80).split()
        for k in range(25):
            words = [*base]
            for _ in range(rng.randrange(3)):
                words[rng.randrange(80)] = f"edit{rng.randrange(10_000)}"
            rows.append((1000 * g + k, " ".join(words), "a"))
    want = brute({i: shingles(t) for i, t, _ in rows})
    found = ngram_groups(documents(spark, rows), block_words=block_words).collect()
    assert {r.doc_id: r.component_id for r in found} == want


def test_texts_of_a_large_group_are_not_read_once_a_block(spark):
    """Near copies and pairs in one candidate group of many blocks: a text is searched a few times, and no link is lost."""
    rng = random.Random(6)
    passage = prose(77, 60)
    rows = []
    for g in range(30):
        base = prose(600 + g, 60).split()
        for k in range(40 if g == 0 else 2):
            words = [*base]
            words[rng.randrange(60)] = f"edit{rng.randrange(10_000)}"
            rows.append((100 * g + k, " ".join(words) + " " + passage, "a"))
    want = brute({i: shingles(t) for i, t, _ in rows})
    searched = []

    def counted(df, run, schema):
        if schema == "a string, b string":
            searched.append(df.count())
        return map_batches(df, run, schema)

    with patch.object(ngram_join, "map_batches", counted):
        found = ngram_groups(documents(spark, rows), block_words=400).collect()
    assert {r.doc_id: r.component_id for r in found} == want
    assert len(set(want.values())) == 30
    blocks = sum(len(shingles(t)) for _, t, _ in rows) // 400
    assert blocks > 20 and 2 * len(rows) <= sum(searched) < 8 * len(rows)


def test_sets_that_are_apart_meet(spark):
    rng = random.Random(7)
    sets = [
        (f"{k:032x}", k, rng.randrange(1, 40), "m" if k % 3 else f"o{k % 7}" if k < 150 else f"p{k}", 1 + k % 2) for k in range(200)
    ]
    sets += [("x", 500, 5, "only", 9), ("y", 501, 5, "only", 9)]
    dealt = ngram_join._apart(spark.createDataFrame(sets, "set_id string, doc_id long, n long, own string, root long"), 300)
    groups = defaultdict(set)
    for r in dealt.collect():
        groups[r.group].add(r.doc_id)
    met = {(a, b) for g in groups.values() for a in g for b in g}
    apart = {(a, b) for _, a, _, o, r in sets for _, b, _, p, q in sets if r == q and o != p}
    roots = {k: r for _, k, _, _, r in sets}
    assert apart <= met and all(roots[a] == roots[b] for a, b in met)
    assert not any(500 in g or 501 in g for g in groups.values())
    mains = {k for _, k, _, o, _ in sets if o == "m"}
    assert len({(a, b) for a, b in met if a in mains and b in mains}) < len(mains) ** 2 / 3


def test_postings_past_the_shards_lose_nothing(spark):
    """Lists that are common in a task go out beside the shards; sets must find them, and those that are alone, as before."""
    rng = random.Random(8)
    passage = prose(9, 30)
    rows = []
    for g in range(4):
        base = prose(300 + g, 90).split()
        for k in range(40 if g == 0 else 3):
            words = [*base]
            words[rng.randrange(90)] = f"edit{rng.randrange(10_000)}"
            rows.append((100 * g + k, " ".join(words) + " " + passage, "a"))
    rows += [(1000 + k, prose(500 + k, 60) + " " + passage, "a") for k in range(20)]
    want = brute({i: shingles(t) for i, t, _ in rows})
    assert {r.doc_id: r.component_id for r in ngram_groups(documents(spark, rows)).collect()} == want
    assert len(set(want.values())) < 30


def test_common_passage_links_nobody(spark):
    passage = prose(9, 60)
    rows = [(i, prose(200 + i, 100) + " " + passage, "a") for i in range(30)]
    found = ngram_groups(documents(spark, rows)).collect()
    assert all(r.doc_id == r.component_id for r in found)


def test_hashes_do_not_depend_on_neighbours_or_length():
    texts = ["A b  C d e f", "", None, "x", "a B c\nd\tE f ", "a" * (_SEGMENT + 5) + " tail of it all " + "é" * 9]
    alone = [list(sets_of([t]))[0] for t in texts]
    together = list(sets_of(texts))
    assert all(np.array_equal(x, y) for x, y in zip(alone, together, strict=True))
    assert np.array_equal(alone[0], alone[4]) and len(alone[1]) == len(alone[2]) == 0
    long = " ".join(f"w{k}" for k in range(700_000))
    assert len(long) > 2 * _SEGMENT
    assert np.array_equal(word_hashes(long.encode())[-3:], word_hashes(b"w699997 w699998 w699999"))
    assert len(word_hashes(long.encode())) == 700_000


sorted_lists = st.lists(st.lists(st.integers(0, 30), unique=True).map(sorted), max_size=12)


@settings(max_examples=200, deadline=None)
@given(sorted_lists, st.integers(1, 8))
def test_t_occurrences(lists, least):
    counts = Counter(x for one in lists for x in one)
    arrays = [np.array(x, np.int64) for x in lists]
    for heap in (0, 10_000):
        with patch.object(ngram_join, "_HEAP", heap):
            member, count = t_occurrences(arrays, least)
        assert list(zip(member.tolist(), count.tolist(), strict=True)) == sorted((x, n) for x, n in counts.items() if n >= least)


small_sets = st.lists(st.sets(st.integers(0, 25), min_size=1, max_size=20), min_size=1, max_size=14)


@settings(max_examples=200, deadline=None)
@given(small_sets)
def test_links_connect_as_all_links_would(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    at = list(range(len(sets)))
    for a, b in linked(arrays):
        both = len(sets[a] & sets[b])
        assert 100 * both >= 75 * len(sets[a] | sets[b])
        at = [at[a] if x == at[b] else x for x in at]
    want = brute({i: frozenset(s) for i, s in enumerate(sets)})
    assert [[x == y for y in at] for x in at] == [[want[i] == want[j] for j in want] for i in want]


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 60), min_size=1), st.sets(st.integers(0, 60), min_size=1))
def test_linked_sets_share_enough_of_their_prefixes(a, b):
    if 100 * len(a & b) >= 75 * len(a | b):
        x, y = (set(sorted(s)[: prefix_length(len(s))]) for s in (a, b))
        assert len(a & b) >= least_overlap(len(a))
        assert len(x & y) >= max(needed(len(a)), needed(len(b))) >= 1


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 50), (7, 3), (100, 51), (200, 201), (None, 3)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {i: 0 for i in range(41)} | {50: 50, 51: 50, 100: 50, 200: 200, 201: 200}
    assert len(found) == 46
    chain = [(k, k + 1) for k in range(500)]
    random.Random(1).shuffle(chain)
    rows = components(spark.createDataFrame(chain, "a long, b long").repartition(13)).collect()
    assert len(rows) == 501 and {r.root for r in rows} == {0}
    assert components(spark.createDataFrame([("b", "c"), ("c", "a")], "a string, b string").filter("a = 'x'")).collect() == []
