from __future__ import annotations

import itertools
import textwrap
from collections import Counter

from cases import documents, odd_rows, prose
from hypothesis import given, settings
from hypothesis import strategies as st
import pytest

from millrace.llm import licenses
from millrace.llm.licenses import differing, find_licenses, nearest, scan, templates
from millrace.llm.queries import QUERIES

# fixed values: the notices in the test tables
NOTICES = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
}


def test_query_against_the_notices_planted(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    want = sorted((d.doc_id, name) for d in docs for text, name in NOTICES.items() for _ in range(d.text.count(text)))
    found = QUERIES["op3_license_scan"](spark, "/root/testdata/sf0.01").collect()
    assert sorted((r.doc_id, r.license) for r in found) == want and want
    texts = {d.doc_id: d.text for d in docs}
    assert {NOTICES[texts[r.doc_id][r.start : r.end] + "."] for r in found} == {r.license for r in found}


def test_every_template_is_found_in_prose():
    for name, text in templates():
        found = find_licenses(f"{prose(1, 40)}\n{text}\n{prose(2, 40)}")
        assert [f[0] for f in found] == [name], text


@pytest.mark.parametrize(
    ("text", "names"),
    [
        (None, []),
        ("", []),
        ("we have licensed nothing under any license", []),
        ("This work is licensed under the GNU General Public License, version 4.", []),
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("Licensed under CC BY-ND 4.0.", ["CC-BY-ND-4.0"]),
        ("Licensed under CC BY-XX 4.0.", []),
        ("RELEASED  under\nthe mit license", ["MIT"]),
        ("Released under the MIT License and licensed under CC BY 4.0", ["MIT", "CC-BY-4.0"]),
        ("SPDX-License-Identifier: AGPL-3.0", ["AGPL-3.0"]),
    ],
)
def test_wordings(text, names):
    assert [f[0] for f in find_licenses(text)] == names


def test_differences_are_listed():
    (only,) = find_licenses("Released under our MIT License")
    assert only[0] == "MIT" and only[4:] == (["the"], ["our"])
    assert differing("a b c".split(), "a x c d".split()) == (["b"], ["x", "d"])


def test_odd_rows(spark):
    rows = [*odd_rows(), (20, "é" * 500 + "\n" + "Released under the MIT License.", "a"), (21, "license " * 50_000, "a")]
    found = [tuple(r) for r in scan(documents(spark, rows)).collect()]
    assert [(f[0], f[1], f[2], f[3]) for f in found] == [(20, "MIT", 501, 531)]
    assert scan(documents(spark, [])).collect() == []


words = st.lists(st.sampled_from("abcd"), max_size=7)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=1, max_size=5), words)
def test_nearest_run(template, block):
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[j - 1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    cost, begin, end = nearest(template, block)
    every = [edits(template, block[a:b]) for a in range(len(block) + 1) for b in range(a, len(block) + 1)]
    assert cost == min(every) == edits(template, block[begin:end])


def wrapped(text: str, width: int, hyphens: bool, prefix: str, gap: str) -> str:
    lines = textwrap.wrap(text, width, break_on_hyphens=hyphens, break_long_words=False)
    return gap.join(prefix + line for line in lines)


@pytest.mark.parametrize("width", [20, 30, 40, 60, 80, 100])
@pytest.mark.parametrize("hyphens", [True, False])
@pytest.mark.parametrize(("prefix", "gap"), [("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", "\n"), ("", "\n\n"), ("    ", "\n")])
def test_every_template_at_any_wrapping(width, hyphens, prefix, gap):
    for name, text in templates():
        notice = wrapped(text, width, hyphens, prefix, gap)
        for whole in (notice, f"{prose(1, 30)}\n\n{notice}\n\n{prose(2, 30)}"):
            assert [f[0] for f in find_licenses(whole)] == [name], notice


def test_hyphenated_words():
    text = "Permission is hereby granted, free of charge, to any per-\n  son obtaining a copy of this soft-\nware and asso-\nciated documentation files"
    whole = next(t for n, t in templates() if n == "MIT" and t.startswith("Permission"))
    rest = whole[whole.index("files") + 5 :]
    ((name, begin, end, _, missing, extra),) = find_licenses(text + rest)
    assert (name, begin, missing, extra) == ("MIT", 0, [], []) and end <= len(text + rest)


def test_skipping_loses_no_template():
    """A notice that lacks as many words as it may still passes the look at the whole text."""
    _, library = licenses._library()
    for t in library:
        spare = int(licenses.MOST_DIFFERENT * len(t.words))
        gone = [w for w in sorted(t.words, key=len, reverse=True) if w not in t.telling][:spare]
        left = list(t.words)
        for w in gone:
            left.remove(w)
        assert t.may_be_in(" ".join(left)) and t.may_hold(Counter(left))


def test_windows_hold_every_run(monkeypatch):
    monkeypatch.setattr(licenses, "_READ", 900)
    text = " ".join(f"w{k}" for k in range(5000))
    seen = [[int(w[1:]) for w, _, _ in part] for part in licenses.windows(text)]
    assert all(part == list(range(part[0], part[-1] + 1)) for part in seen)
    reach = licenses._reach()
    assert all(any(part[0] <= k and k + reach - 1 <= part[-1] for part in seen) for k in range(5000 - reach + 1))


@pytest.mark.parametrize("at", [0.0, 0.5, 1.0])
def test_notices_in_a_line_of_a_megabyte(at):
    words = prose(5, 200_000).split()
    words = words[: next(i for i, n in enumerate(itertools.accumulate(len(w) + 1 for w in words)) if n >= 1 << 20)]
    place = int(at * len(words))
    for notice, name in NOTICES.items():
        text = " ".join([*words[:place], notice, *words[place:]])
        assert [(f[0], text[f[1] : f[2]] + ".") for f in find_licenses(text)] == [(name, notice)]


def test_every_template_is_found_at_every_place_of_a_long_line():
    for name, text in templates():
        for k in range(0, 700, 61):
            found = find_licenses(f"{prose(1, k)} {text} {prose(2, 700 - k)}" if k else f"{text} {prose(2, 700)}")
            assert [f[0] for f in found] == [name], (text, k)


def test_repeated_notices_are_all_found():
    text = "\n".join(f"{prose(k, 5)} Released under the MIT License. {prose(k + 50, 5)}" for k in range(30))
    assert [f[0] for f in find_licenses(text)] == ["MIT"] * 30
    assert [f[0] for f in find_licenses("Licensed under CC BY 4.0. Licensed under CC BY 4.0.")] == ["CC-BY-4.0"] * 2
