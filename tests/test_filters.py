import json
import random

import pytest
from pyspark.sql import functions as F

from helpers import event, plan, rows, texts, topic
from millrace.functions.decode import decode_raw, may_hold_false, may_mention, text
from millrace.operators import edits
from millrace.operators.filters import filter_domain, filter_human
from millrace.plans.pipelines import filter_edits, filter_job, find_event, typed_edits, writer_job
from millrace.schemas import ALLOWED_DOMAINS, COORDINATES


def passes(spark, value):
    return filter_edits(topic(spark, [value])).count() == 1


@pytest.mark.parametrize(
    "domain, bot, expected",
    [
        ("en.wikipedia.org", False, True),
        ("www.wikidata.org", False, True),
        ("commons.wikimedia.org", False, True),
        ("en.wikipedia.org", True, False),
        ("de.wikipedia.org", False, False),
        ("uk.wikipedia.org", False, False),
        (None, False, False),
        ("en.wikipedia.org", None, False),
        ("en.wikipedia.org", "false", False),
        ("en.wikipedia.org", 0, False),
        ("EN.wikipedia.org", False, False),
    ],
)
def test_matrix(spark, domain, bot, expected):
    assert passes(spark, event(domain=domain, bot=bot)) is expected


def test_missing_flag_and_odd_performer(spark):
    without = event()
    del without["performer"]["user_is_bot"]
    assert not passes(spark, without)
    assert not passes(spark, event(performer="x"))
    assert not passes(spark, {"meta": {"domain": None}, "performer": {"user_is_bot": False}})


def test_one_of_three_passes(spark):
    values = [event(user="ann"), event(user="robot", bot=True), event(user="olena", domain="uk.wikipedia.org")]
    assert rows(filter_edits(topic(spark, values))) == [("ann", "en.wikipedia.org", "2026-03-04T05:06:07Z", "Start")]


def test_four_fields(spark):
    assert filter_edits(topic(spark, [event()])).columns == ["user_id", "domain", "created_at", "page_title"]


def test_raw_text_is_not_misjudged(spark):
    """Escapes in the text hide neither a domain nor a word that only looks like a number."""
    escaped = json.dumps(event(user="esc")).replace("en.wikipedia.org", "\\u0065n.wikipedia\\u002Eorg")
    spaced = json.dumps(event(user="spaced"), indent=3)
    assert rows(filter_edits(topic(spark, [escaped, spaced])), "user_id") == [("esc",), ("spaced",)]
    number = json.dumps(event(user="num")).replace('"en.wikipedia.org"', "1e2")
    assert rows(filter_edits(topic(spark, [number]), ["100.0"]), "user_id") == [("num",)]
    slash = json.dumps(event(user="sl", domain="a/b")).replace("/", "\\/")
    assert rows(filter_edits(topic(spark, [slash]), ["a/b"]), "user_id") == [("sl",)]


def test_looking_at_the_text_changes_no_result(spark):
    rng = random.Random(7)
    words = ["en.wikipedia.org", "x", "a-b", "www.wikidata.org", "en.wikipedia.or", "é", "false"]

    def scramble(word):
        return "".join(f"\\u{ord(c):04x}" if rng.random() < 0.1 else c for c in word)

    values = []
    for i in range(400):
        made = json.dumps(event(domain="DOMAIN", user=f"u{i}", bot=rng.choice([True, False, None, "false", 0])), ensure_ascii=False)
        values.append(made.replace("DOMAIN", scramble(rng.choice(words))))
    records = topic(spark, values)
    whole = edits.select_edits(filter_human(filter_domain(decode_raw(records))))
    assert whole.count() > 20
    assert texts(filter_edits(records)) == texts(whole)
    assert records.filter(may_mention(text(), ALLOWED_DOMAINS) & may_hold_false(text())).count() < 300


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_allow_list_as_a_table(spark, broadcast_rows):
    values = [event(domain=d, user=f"u{i}") for i, d in enumerate(["a", "b", "a", None, "c", "a"] * 20)]
    values += [event(domain="a", user="same")] * 30
    decoded = decode_raw(topic(spark, values), COORDINATES)
    allowed = spark.createDataFrame([("a",), ("c",), ("a",), (None,)], "name string")
    for spread in (None, F.xxhash64(*COORDINATES)):
        got = filter_domain(decoded, allowed, broadcast_rows=broadcast_rows, spread=spread)
        assert got.count() == 110
        assert {r[0] for r in got.select("meta.domain").distinct().collect()} == {"a", "c"}
        assert got.columns == decoded.columns
        assert ("_salt" in plan(got)) == (broadcast_rows == 0)


def test_allow_list_as_a_table_in_the_job(spark):
    values = [event(domain=d, user=f"u{i}") for i, d in enumerate(["a", "b", "c"])]
    allowed = spark.createDataFrame([("a",), ("c",)], "name string")
    assert rows(filter_edits(topic(spark, values), allowed), "user_id") == [("u0",), ("u2",)]
    assert filter_job(topic(spark, values), allowed).count() == 2


@pytest.mark.parametrize("wanted", ["b-1", "12", "1e2", "a/b"])
def test_find_event(spark, wanted):
    escaped = json.dumps(event(id="b-1")).replace("b-1", "\\u0062-1")
    slash = json.dumps(event(id="a/b")).replace("a/b", "a\\/b")
    records = topic(spark, [event(id="b-1"), event(id="b-10"), event(id=12), event(id="12"), event(id="1e2"), "bad", escaped, slash])
    expected = {"b-1": 2, "12": 2, "1e2": 1, "a/b": 1}[wanted]
    assert rows(find_event(records, wanted), "meta.id") == [(wanted,)] * expected
    assert find_event(records, wanted + "x").count() == 0


PROCESSED = [
    ('{"user_id":"u","domain":"d","created_at":"2026-05-01T10:00:00Z","page_title":"p"}', "passed"),
    ('{"user_id":"","domain":"d","created_at":"2026-05-01T10:00:00Z","page_title":""}', "passed"),
    ('{"domain":"d","created_at":"2026-05-01T10:00:00Z","page_title":"p"}', "incomplete"),
    ('{"user_id":"u","domain":null,"created_at":"2026-05-01T10:00:00Z","page_title":"p"}', "incomplete"),
    ('{"user_id":"u","domain":"d","page_title":"p"}', "incomplete"),
    ("{}", "incomplete"),
    ('{"user_id":"u","domain":"d","created_at":"soon","page_title":"p"}', "bad_timestamp"),
    ('{"user_id":"u","domain":"d","created_at":"12:30:00","page_title":"p"}', "bad_timestamp"),
    ('{"user_id":"u","domain":"","created_at":"2026-05-01T10:00:00Z","page_title":"p"}', "empty_domain"),
    ("{", "bad_json"),
    ("[]", "bad_json"),
    ("", "bad_json"),
    (None, "bad_json"),
]


def test_outcomes_of_the_writer(spark):
    records = topic(spark, [v for v, _ in PROCESSED], partitions=1)
    classified = edits.classify_processed(records).orderBy("offset")
    assert [r.outcome for r in classified.collect()] == [o for _, o in PROCESSED]
    assert typed_edits(records).count() == writer_job(records).count() == 2
    rejected = edits.rejects(classified).orderBy("offset").collect()
    assert [(r.raw, r.reason) for r in rejected] == [p for p in PROCESSED if p[1] != "passed"]


def test_outcomes_of_the_filter(spark):
    values = [event(), event(bot=True), event(bot=None), event(domain="x"), event(domain=None), "{}", "bad", "[1]", None]
    classified = edits.classify_raw(topic(spark, values, partitions=1)).orderBy("offset")
    assert [r.outcome for r in classified.collect()] == [
        "passed", "not_human", "not_human", "other_domain", "other_domain", "other_domain", "bad_json", "bad_json", "bad_json",
    ]
    assert [r.offset for r in edits.rejects(classified).collect()] == [6, 7, 8]


def test_bad_time_fails_no_query(spark):
    records = topic(spark, [v for v, _ in PROCESSED])
    assert rows(typed_edits(records), "user_id", "page_title") == [("", ""), ("u", "p")]


def test_the_jobs_do_not_shuffle(spark):
    for job in (filter_job, writer_job):
        assert "Exchange" not in plan(job(topic(spark, [event()])))
