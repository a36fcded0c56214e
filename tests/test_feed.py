import json

import pytest

from millrace.operators.feed import feed_messages, publishable, unpublishable
from millrace.plans.pipelines import publish_feed
from millrace.sources.feed_files import read_frames

FEED = """:ok

event: message
id: 1
data: {"a":1}

data:{"b":2}

event: heartbeat
data:

: comment
data: {"c":
data:  3}


retry: 10

data: not json

id: 2
data: null
data

database: {"x":1}
"""


def write(tmp_path, text, newline="\n"):
    path = tmp_path / "feed.txt"
    path.write_bytes(text.replace("\n", newline).encode("utf-8"))
    return str(path)


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_frames(spark, tmp_path, newline):
    messages = feed_messages(read_frames(spark, write(tmp_path, FEED, newline), newline))
    assert [r.data for r in messages.collect()] == ['{"a":1}', '{"b":2}', '{"c":\n 3}', "not json", "null"]
    assert [bytes(r.value).decode() for r in publishable(messages).collect()] == ['{"a":1}', '{"b":2}', '{"c":\n 3}', "null"]
    assert [tuple(r) for r in unpublishable(messages).collect()] == [("not json", "bad_json")]


def test_text_goes_through_unchanged(spark, tmp_path):
    odd = '{"z": 1, "a": "\\u00e9 é", "a": 1.50}'
    assert bytes(publish_feed(read_frames(spark, write(tmp_path, f"data: {odd}\n\n"))).first().value).decode() == odd


def test_splits_lose_and_repeat_nothing(spark, tmp_path):
    frames = [f"id: {i}\ndata: " + json.dumps({"i": i, "pad": "x" * (i % 57)}) for i in range(3000)]
    path = write(tmp_path, "\n\n".join(frames) + "\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4099")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = read_frames(spark, path)
        assert read.rdd.getNumPartitions() > 20
        got = sorted(json.loads(bytes(r.value))["i"] for r in publish_feed(read).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == list(range(3000))
