import pytest
from pyspark.sql import functions as F

from helpers import event, plan, rows, topic
from millrace.functions.decode import (
    decode_processed,
    decode_raw,
    encode_processed,
    flatten_legacy,
    is_json,
    is_json_object,
    json_or_null,
    text,
)
from millrace.schemas import PROCESSED_EVENT, RAW_EVENT

FLAT = ("meta.id", "meta.dt", "meta.domain", "performer.user_text", "performer.user_is_bot", "page_title")


def one(spark, value):
    return tuple(decode_raw(topic(spark, [value])).select(*FLAT).first())


def test_schema_names():
    assert RAW_EVENT.names == ["meta", "performer", "page_title"]
    assert PROCESSED_EVENT.names == ["user_id", "domain", "created_at", "page_title"]


def test_whole_event(spark):
    assert one(spark, event(id="1", title="T", user="U")) == (
        "1", "2026-03-04T05:06:07Z", "en.wikipedia.org", "U", False, "T",
    )


@pytest.mark.parametrize("value", ["not a json", '{"meta":{"id":"1"', "", None, "[1]", '[{"page_title":"x"}]', "3", '"x"', "null", "{}", "NaN"])
def test_nothing_decoded_keeps_the_row(spark, value):
    assert one(spark, value) == (None,) * 6


@pytest.mark.parametrize(
    "value, expected",
    [
        ('{"performer":{"user_text":"u","user_is_bot":"false"},"page_title":"t"}', (None, None, None, "u", None, "t")),
        ('{"performer":{"user_text":"u","user_is_bot":0},"page_title":"t"}', (None, None, None, "u", None, "t")),
        ('{"performer":{"user_text":"u","user_is_bot":null}}', (None, None, None, "u", None, None)),
        ('{"performer":"x","meta":{"id":"1"},"page_title":"t"}', ("1", None, None, None, None, "t")),
        ('{"page_title":123}', (None,) * 5 + ("123",)),
        ('{"page_title":{"a":1}}', (None,) * 5 + ('{"a":1}',)),
        ('{"page_title":"a","page_title":"b"}', (None,) * 5 + ("b",)),
        ('{"Page_Title":"a"}', (None,) * 6),
        ('{"page_title":"a","other":[1,2]}', (None,) * 5 + ("a",)),
        ('{"page_title":"a"} trailing', (None,) * 5 + ("a",)),
        ('{"page_title":"\\u0443\\ud83d\\ude00"}', (None,) * 5 + ("у😀",)),
    ],
)
def test_partly_decoded(spark, value, expected):
    assert one(spark, value) == expected


def test_one_row_per_record(spark):
    values = [event(), "bad", None, "{}", "[]"]
    assert decode_raw(topic(spark, values), ("partition", "offset")).count() == 5


def test_encode_leaves_out_nulls_and_decode_restores_them(spark):
    given = [("u", "d", "t", "p"), ("u", None, None, "p"), (None,) * 4]
    df = spark.createDataFrame(given, PROCESSED_EVENT)
    encoded = encode_processed(df)
    assert [r.value for r in encoded.collect()] == [
        '{"user_id":"u","domain":"d","created_at":"t","page_title":"p"}', '{"user_id":"u","page_title":"p"}', "{}",
    ]
    assert rows(decode_processed(encoded)) == sorted(given, key=str)


JSON_KINDS = [
    ('{"a":1}', True, True), (' \n{"a":1}', True, True), ("[1]", True, False), ("3", True, False), ('"{x"', True, False),
    ("null", True, False), ("bad", False, False), ("", False, False), (None, False, False), ('{"a":', False, False),
    ('{"a":1,"a":2}', True, True), ("{bad", False, False),
]


def test_json_kinds(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _, _) in enumerate(JSON_KINDS)], "i int, v string")
    got = df.select("i", is_json(F.col("v")), is_json_object(F.col("v"))).orderBy("i").collect()
    assert [(r[1], r[2]) for r in got] == [(a, b) for _, a, b in JSON_KINDS]


def test_parse_or_null(spark):
    values = ['{"domain": "c", "bot": false}', "{no", None, '{"domain": "uk"}']
    p = json_or_null(text())
    got = topic(spark, values, partitions=1).orderBy("offset").select(
        p.isNull(), F.try_variant_get(p, "$.domain", "string"), F.try_variant_get(p, "$.user", "string")
    )
    assert [tuple(r) for r in got.collect()] == [(False, "c", None), (True, None, None), (True, None, None), (False, "uk", None)]


LEGACY = [
    ('{"meta":{"id":"1","dt":"d"},"page_title":"t","performer":{"user_text":"u"}}', ("1", "t", "u", "d")),
    ('{"page_title":"t"}', (None, "t", None, None)),
    ("{}", (None,) * 4),
    ('{"meta":null,"page_title":"t"}', (None,) * 4),
    ('{"meta":"x","page_title":"t"}', (None,) * 4),
    ('{"meta":{"id":"1"},"performer":[1],"page_title":"t"}', (None,) * 4),
    ('{"meta":{"id":"1"},"performer":null,"page_title":"t"}', (None,) * 4),
    ('{"meta":{"id":"1","id":"2"},"page_title":"t"}', ("2", "t", None, None)),
    ("[1]", (None,) * 4),
    ("null", (None,) * 4),
    ("bad", (None,) * 4),
    (None, (None,) * 4),
]


def test_legacy_flatten(spark):
    got = flatten_legacy(topic(spark, [v for v, _ in LEGACY], partitions=1), ("offset",)).orderBy("offset")
    assert [tuple(r)[1:] for r in got.collect()] == [expected for _, expected in LEGACY]


def test_predicates_do_not_repeat_the_parse(spark):
    df = decode_raw(topic(spark, [event()]))
    df = df.filter(F.col("meta.domain") == "x").filter(F.col("performer.user_is_bot") == F.lit(False))
    assert plan(df).count("from_json") == 1
