import datetime as dt

from pyspark.sql import functions as F

from helpers import event, plan, topic
from millrace.operators import metrics

UTC = dt.timezone.utc


def by_partition(df, *columns):
    return {r.partition: tuple(r[c] for c in columns) for r in df.collect()}


def test_topic_scan(spark):
    got = metrics.topic_scan(topic(spark, ["x"] * 5))
    assert by_partition(got, "topic", "n_records", "first_offset", "last_offset") == {0: ("input", 3, 0, 2), 1: ("input", 2, 0, 1)}


def test_lag_counts_consumed_not_kept(spark):
    records = topic(spark, [event(bot=True)] * 7, partitions=3)
    none = metrics.positions(records.limit(0))
    assert by_partition(metrics.consumer_lag(records, none), "lag") == {0: (3,), 1: (2,), 2: (2,)}
    read = metrics.positions(records.filter("partition = 0 and offset < 2"))
    assert by_partition(metrics.consumer_lag(records, read), "next_offset", "lag") == {0: (2, 1), 1: (0, 2), 2: (0, 2)}
    assert by_partition(metrics.consumer_lag(records, metrics.positions(records)), "lag") == {0: (0,), 1: (0,), 2: (0,)}


def test_positions_of_several_batches(spark):
    records = topic(spark, ["x"] * 6, partitions=1)
    positions = metrics.positions(records.filter("offset < 2")).unionByName(metrics.positions(records.filter("offset < 4")))
    assert by_partition(metrics.consumer_lag(records, positions), "next_offset", "lag") == {0: (4, 2)}


def test_positions_from_progress(spark):
    got = metrics.positions_from_progress(spark, ['{"input":{"0":5,"1":7}}', {"processed": {"0": 2}}])
    assert sorted(map(tuple, got.collect())) == [("input", 0, 5), ("input", 1, 7), ("processed", 0, 2)]
    assert metrics.positions_from_progress(spark, []).count() == 0


def test_freshness(spark):
    records = topic(spark, ["x"] * 4)
    now = F.lit(dt.datetime(2026, 5, 1, 0, 1, tzinfo=UTC))
    got = metrics.topic_freshness(records, now)
    assert by_partition(got, "idle_seconds") == {0: (58.0,), 1: (57.0,)}
    assert metrics.topic_freshness(records).columns == ["topic", "partition", "last_timestamp"]


def test_throughput(spark):
    got = metrics.topic_throughput(topic(spark, ["x"] * 90, partitions=1), "1 minute")
    assert sorted(r.n_records for r in got.collect()) == [30, 60]


def test_stage_counts(spark):
    raw = topic(spark, [event(), event(bot=True), "bad", event(domain="x"), event()])
    processed = topic(spark, ['{"user_id":"u"}', "bad"], "processed")
    got = {(r.stage, r.outcome): r.n for r in metrics.stage_counts(raw, processed).collect()}
    assert got == {
        ("filter", "passed"): 2, ("filter", "not_human"): 1, ("filter", "bad_json"): 1, ("filter", "other_domain"): 1,
        ("writer", "incomplete"): 1, ("writer", "bad_json"): 1,
    }


def test_only_the_needed_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    topic(spark, [event()]).write.parquet(path)
    df = spark.read.parquet(path)
    assert "ReadSchema: struct<topic:string,partition:int,offset:bigint>" in plan(metrics.positions(df))
    assert "ReadSchema: struct<topic:string,timestamp:timestamp>" in plan(metrics.topic_throughput(df))
