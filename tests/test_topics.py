import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import event, topic
from millrace.plans.pipelines import filter_job, writer_job
from millrace.schemas import TOPIC_RECORD, require
from millrace.sources.topics import (
    Topic,
    append_topic,
    coordinate_headers,
    end_offsets,
    from_offsets,
    latest_start,
    number_records,
    numbered_records,
    publish_values,
    replace_batch,
    read_topic,
    source_seq,
    stream_topic,
)


def test_a_topic_is_in_one_place():
    for bad in ({}, {"path": "p", "servers": "s"}):
        with pytest.raises(ValueError):
            Topic("input", **bad)


def test_append_and_read(spark, tmp_path):
    t = Topic("input", path=str(tmp_path / "input"))
    append_topic(topic(spark, [event(), "bad"]), t)
    append_topic(topic(spark, [None]), t)
    got = require(read_topic(spark, t), TOPIC_RECORD)
    assert got.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
    assert got.count() == 3 and not got.isStreaming
    assert stream_topic(spark, t).isStreaming
    with pytest.raises(ValueError):
        stream_topic(spark, t, start="latest")


def test_required_columns(spark):
    records = topic(spark, [event()])
    with pytest.raises(ValueError, match="offset: absent"):
        require(records.drop("offset"), TOPIC_RECORD)
    with pytest.raises(ValueError, match="partition: string instead of int"):
        require(records.withColumn("partition", F.lit("0")), TOPIC_RECORD)


def test_offset_ranges(spark):
    records = topic(spark, [str(i) for i in range(20)], partitions=3)
    got = from_offsets(records, {0: 2, 1: 5, 2: 0}, {0: 4, 2: 1}).select("partition", "offset").collect()
    assert sorted(map(tuple, got)) == [(0, 2), (0, 3), (1, 5), (1, 6), (2, 0)]
    assert from_offsets(records, {}).count() == 0


def test_source_coordinates_survive_a_broker(spark):
    """A broker numbers and stamps records anew; the order of writes stays that of their sources."""
    values = [event(title=f"t{i}", user="same") for i in range(6)]
    processed = filter_job(topic(spark, values))
    at_broker = processed.withColumn("headers", coordinate_headers()).withColumns(
        {"partition": F.lit(0), "offset": 100 - F.col("offset"), "timestamp": F.lit(dt.datetime(2030, 1, 1))}
    )
    want = processed.select(source_seq(processed).alias("seq")).collect()
    got = at_broker.select(source_seq(at_broker).alias("seq")).collect()
    assert sorted(want) == sorted(got)
    assert sorted(r.seq for r in writer_job(at_broker).collect()) == sorted(r.seq for r in want)


def test_records_without_headers_have_their_own_place(spark):
    records = topic(spark, [event()])
    for headers in ("null", "array()", "array(named_struct('key', 'other', 'value', cast('1' as binary)))"):
        kind = "array<struct<key:string,value:binary>>"
        with_headers = records.withColumn("headers", F.expr(f"cast({headers} as {kind})"))
        assert with_headers.select(source_seq(with_headers)).first() == records.select(source_seq(records)).first()


def test_processed_records_have_the_table_key(spark):
    got = filter_job(topic(spark, [event(user="u", title="t")])).first()
    assert bytes(got.key) == b'{"domain":"en.wikipedia.org","created_at":"2026-03-04T05:06:07Z","user_id":"u"}'
    assert got.topic == "processed" and (got.partition, got.offset) == (0, 0)


def _values(spark, n, first=0):
    return spark.range(first, first + n, 1, 5).select(F.col("id").cast("string").cast("binary").alias("value"))


def _places(records):
    return sorted(map(tuple, records.select("partition", "offset").collect()))


def test_numbered_records(spark):
    got = number_records(_values(spark, 1000), Topic("input", path="/nowhere", partitions=3), {0: 7, 2: 100})
    places = _places(require(got, TOPIC_RECORD))
    for partition, first in ((0, 7), (1, 0), (2, 100)):
        offsets = [o for p, o in places if p == partition]
        assert offsets == list(range(first, first + len(offsets)))
    again = number_records(_values(spark, 1000).repartition(3), Topic("input", path="/nowhere", partitions=3), {0: 7, 2: 100})
    columns = ("partition", "offset", "value")
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, again.select(*columns).collect()))


def test_values_are_numbered_in_order_of_their_position(spark):
    values = _values(spark, 200).withColumn("position", F.lit(1000) - F.col("value").cast("string").cast("int"))
    got = number_records(values, Topic("input", path="/nowhere", partitions=1)).orderBy("offset").collect()
    assert [int(bytes(r.value)) for r in got] == list(range(199, -1, -1))


def test_a_partition_is_numbered_by_several_tasks(spark):
    """In the same order as by one, with values that are alike in several ranges."""
    plain = _values(spark, 600).withColumn("position", (F.lit(1000) - F.col("value").cast("string").cast("int")) % 50)
    alike = spark.range(0, 900, 1, 4).select(F.lit("alike").cast("binary").alias("value"), F.lit(None).cast("int").alias("position"))
    for values in (plain.unionByName(alike), plain.unionByName(alike).drop("position"), plain.filter("false")):
        for partitions in (1, 3):
            t = Topic("input", path="/nowhere", partitions=partitions)
            columns = ("partition", "offset", "value")
            want = sorted(map(tuple, number_records(values, t, {0: 7}).select(*columns).collect()))
            with numbered_records(values, t, {0: 7}) as got:
                tasks = got.filter("partition = 0").select(F.spark_partition_id().alias("p")).distinct().count()
                assert sorted(map(tuple, require(got, TOPIC_RECORD).select(*columns).collect())) == want
            assert tasks > 1 or not want


def test_published_values_are_numbered_on(spark, tmp_path):
    t = Topic("input", path=str(tmp_path / "input"))
    assert end_offsets(spark, t) == {}
    for _ in range(2):
        publish_values(_values(spark, 50), t)
    publish_values(_values(spark, 30, 50), t, "run-1", 0)
    publish_values(_values(spark, 30, 50), t, "run-1", 0)  # published again: nothing new
    publish_values(_values(spark, 20, 80), t, "run-1", 1)
    got = read_topic(spark, t)
    assert got.count() == got.select("partition", "offset").distinct().count() == 150
    ends = end_offsets(spark, t)
    assert sum(ends.values()) == 150
    assert _places(got) == [(p, o) for p, end in sorted(ends.items()) for o in range(end)]


def test_publishing_does_not_read_history(spark, tmp_path):
    t = Topic("input", path=str(tmp_path / "input"))
    publish_values(_values(spark, 50), t)
    old = next(p for p in (tmp_path / "input").rglob("part-*.parquet") if "_ends" not in str(p))
    old.write_bytes(b"no longer readable")
    publish_values(_values(spark, 50, 50), t)
    assert sum(end_offsets(spark, t).values()) == 100


def test_a_publication_that_stopped_half_way_goes_on(spark, tmp_path):
    import shutil

    t = Topic("input", path=str(tmp_path / "input"))
    publish_values(_values(spark, 50), t, "run", 0)
    before = _places(read_topic(spark, t))
    shutil.rmtree(tmp_path / "input" / "_ends")  # the records are there, their ends are not yet
    publish_values(_values(spark, 50), t, "run", 0)
    assert _places(read_topic(spark, t)) == before
    publish_values(_values(spark, 10, 50), t, "run", 1)
    assert sum(end_offsets(spark, t).values()) == 60


def test_a_folder_from_its_latest_record(spark, tmp_path):
    t = Topic("input", path=str(tmp_path / "input"))
    append_topic(topic(spark, [event(title=f"t{i}") for i in range(5)]), t)
    start = latest_start(spark, t, str(tmp_path / "start"))
    assert start == {0: 3, 1: 2}
    later = topic(spark, [event(title="new"), event(title="newer")]).withColumn("offset", F.col("offset") + 3)
    append_topic(later, t)
    assert latest_start(spark, t, str(tmp_path / "start")) == start
    out = stream_topic(spark, t, start).writeStream.format("memory").queryName("from_latest")
    out.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert _places(spark.table("from_latest")) == [(0, 3), (1, 3)]


def test_a_batch_that_is_there_is_left_alone(spark, tmp_path):
    t = Topic("input", path=str(tmp_path / "input"))
    assert replace_batch(topic(spark, ["a", "b"]), t, "run", 0)
    assert not replace_batch(topic(spark, ["c"]), t, "run", 0)
    assert read_topic(spark, t).count() == 2


def test_a_broker_is_asked_for_only_with_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_topic(spark, Topic("input", servers="nowhere:9092")).count()
