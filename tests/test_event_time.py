import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import event, texts, topic
from millrace.operators import metrics
from millrace.sources.topics import Topic, append_topic, read_topic
from millrace.streaming import event_time, runners
from millrace.streaming.progress import ObservedTotals

START = dt.datetime(2026, 5, 1, tzinfo=dt.timezone.utc)


@pytest.fixture
def place(tmp_path):
    class Place:
        input = Topic("input", path=str(tmp_path / "input"))
        output = Topic("input", path=str(tmp_path / "output"))
        checkpoints = str(tmp_path / "checkpoints")
        out = str(tmp_path / "out")
        arrived = str(tmp_path / "arrived")

    return Place


def at(spark, minutes, partition=0, first=0):
    """Records at the given minutes, numbered on."""
    records = topic(spark, ["x"] * len(minutes), partitions=1)
    moved = F.element_at(F.array(*[F.lit(START + dt.timedelta(minutes=m)) for m in minutes]), (F.col("offset") + 1).cast("int"))
    return records.withColumn("timestamp", moved).withColumns({"partition": F.lit(partition), "offset": F.col("offset") + first})


def run(writer, name, place):
    stream = runners.start(writer, name, place.checkpoints, until_caught_up=True)
    stream.awaitTermination()
    return stream


def minutes(row_time, utc):
    return round((row_time - utc("2026-05-01T00:00:00")).total_seconds() / 60)


def test_late_records_are_counted_apart(spark, place, utc):
    listener = ObservedTotals()
    spark.streams.addListener(listener)
    try:
        # the watermark is 0 for the first part, 150 for the second: what belongs to windows that end by then is late
        for part in (at(spark, [0, 10, 70, 150, 210]), at(spark, [5, 59, 60, 100, 119, 130, 151, 220], first=5)):
            append_topic(part, place.input)
            run(event_time.running_throughput_stream(spark, place.input, place.out, lateness="1 hour"), "running", place)
            run(runners.throughput_stream(spark, place.input, place.arrived), "arrived", place)
    finally:
        for _ in range(50):
            if sum(listener.late.values()) >= 2:
                break
            __import__("time").sleep(0.2)
        spark.streams.removeListener(listener)
    got = {minutes(r.window_start, utc): (r.n_records, r.n_late) for r in event_time.late_of(spark, place.out, place.arrived).collect()}
    assert got == {0: (2, 2), 60: (1, 3), 120: (3, 0), 180: (2, 0)}
    assert sum(listener.late.values()) >= 2  # Spark's own figure: one a window and task


def test_no_records(spark, place):
    assert event_time.read_running(spark, place.out).collect() == []
    assert event_time.late_of(spark, place.out, place.arrived).collect() == []
    assert metrics.idle_gaps(metrics.topic_sessions(topic(spark, []))).collect() == []


def test_windows_close_once_and_state_survives_a_restart(spark, place, utc):
    for part in (at(spark, [0, 30, 70]), at(spark, [59, 80, 130], first=3), at(spark, [200], first=6)):
        append_topic(part, place.input)
        run(event_time.closed_throughput_stream(spark, place.input, place.out, lateness="1 hour"), "closed", place)
    got = [(minutes(r.window_start, utc), r.n_records) for r in spark.read.parquet(place.out).collect()]
    assert sorted(got) == [(0, 3), (60, 2)]  # half of either window came before a restart


def test_replayed_micro_batch_replaces_its_totals(spark, place):
    append_topic(at(spark, [0, 1, 2]), place.input)
    for _ in range(2):  # a lost checkpoint: another run beside the first
        stream = event_time.running_throughput_stream(spark, place.input, place.out)
        run(stream, "running", place)
        place.checkpoints += "-lost"
    assert [r.n_records for r in event_time.read_running(spark, place.out).collect()] == [3]


def test_idle_gaps(spark, utc):
    records = at(spark, [0, 20, 45, 120, 121, 300]).unionByName(at(spark, [7], partition=1))
    rows = metrics.idle_gaps(metrics.topic_sessions(records, "30 minutes")).collect()
    got = sorted((r.partition, minutes(r.first_timestamp, utc), minutes(r.last_timestamp, utc), r.n_records, r.idle_seconds) for r in rows)
    assert [g[:4] for g in got] == [(0, 0, 45, 3), (0, 120, 121, 2), (0, 300, 300, 1), (1, 7, 7, 1)]
    assert [g[4] for g in got] == [None, 4500.0, 10740.0, None]


def test_sessions_as_a_stream(spark, place, utc):
    """A session that goes on after a restart is one; one that may still grow is not told."""
    for part in (at(spark, [0, 20]), at(spark, [45, 120], first=2), at(spark, [300], first=4)):
        append_topic(part, place.input)
        run(event_time.sessions_stream(spark, place.input, place.out, "30 minutes", "1 hour"), "sessions", place)
    rows = spark.read.schema(event_time.SESSIONS).parquet(place.out).collect()
    assert sorted((minutes(r.first_timestamp, utc), minutes(r.last_timestamp, utc), r.n_records) for r in rows) == [(0, 45, 3), (120, 120, 1)]


def test_each_record_once(spark, place):
    first = topic(spark, [event(user=f"u{i}") for i in range(40)], partitions=2)
    again = first.filter("offset >= 10").unionByName(first.filter("offset < 15"))
    for part in (first.filter("offset < 12"), first.filter("offset between 5 and 19"), again):
        append_topic(part, place.input)
        run(event_time.unique_topic_stream(spark, place.input, place.output, "1 hour"), "unique", place)
    assert texts(read_topic(spark, place.output)) == texts(first)


def test_state_of_places_stays_bounded(spark, place):
    """An hour's records at a time, of which half are repeated by the next hour: state holds places of three hours, one before
    and one after the watermark, and those of the micro-batch."""
    listener = ObservedTotals()
    spark.streams.addListener(listener)
    held = []
    try:
        for hour in range(6):
            append_topic(at(spark, [60 * hour + m for m in range(60)], first=60 * hour), place.input)
            if hour:
                append_topic(at(spark, [60 * (hour - 1) + m for m in range(30, 60)], first=60 * (hour - 1) + 30), place.input)
            listener.state_rows.clear()
            run(event_time.unique_topic_stream(spark, place.input, place.output, "1 hour"), "unique", place)
            for _ in range(50):
                if listener.state_rows:
                    break
                __import__("time").sleep(0.2)
            held.append(max(listener.state_rows.values()))
    finally:
        spark.streams.removeListener(listener)
    out = read_topic(spark, place.output)
    assert out.count() == out.select("partition", "offset").distinct().count() == 360
    assert max(held) <= 180 and held[-1] == held[3]
