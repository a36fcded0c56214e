import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from helpers import event, texts, topic
from millrace.functions.decode import decode_processed
from millrace.operators import keyed, metrics
from millrace.operators.edits import RAW_OUTCOMES
from millrace.plans.pipelines import filter_edits, filter_job, writer_job
from millrace.schemas import TOPIC_RECORD
from millrace.sources.edits_table import Batch, EditsTable
from millrace.sources.topics import Topic, append_topic, read_topic
from millrace.streaming import runners
from millrace.streaming.progress import ObservedTotals


@pytest.fixture
def place(tmp_path):
    class Place:
        input = Topic("input", path=str(tmp_path / "input"))
        processed = Topic("processed", path=str(tmp_path / "processed"))
        checkpoints = str(tmp_path / "checkpoints")
        side = str(tmp_path / "side")
        table = str(tmp_path / "edits")

    return Place


def run(writer, name, place):
    stream = runners.start(writer, name, place.checkpoints, until_caught_up=True)
    stream.awaitTermination()
    return stream


def events(n, first=0):
    return [
        event(user=f"u{i % 3}", title=f"t{i}", domain=["en.wikipedia.org", "www.wikidata.org", "x"][i % 3], bot=i % 5 == 0)
        if i % 7 else "bad"
        for i in range(first, first + n)
    ]


def both(spark, place, table):
    run(runners.filter_stream(spark, place.input, place.processed), runners.FILTER_QUERY, place)
    run(runners.edits_stream(spark, place.processed, table, side=place.side), runners.WRITER_QUERY, place)


def test_stream_equals_batch(spark, place):
    records = topic(spark, events(60))
    append_topic(records, place.input)
    table = EditsTable(spark, place.table)
    both(spark, place, table)
    assert texts(decode_processed(read_topic(spark, place.processed))) == texts(filter_edits(records))
    assert texts(table.current()) == texts(keyed.current_rows(writer_job(filter_job(records))))


def test_resumes_where_it_stopped(spark, place):
    table = EditsTable(spark, place.table)
    append_topic(topic(spark, events(30)), place.input)
    both(spark, place, table)
    before = read_topic(spark, place.processed).count()
    both(spark, place, table)
    assert read_topic(spark, place.processed).count() == before
    later = topic(spark, events(30, 100)).withColumn("offset", F.col("offset") + 1000)
    append_topic(later, place.input)
    both(spark, place, table)
    assert read_topic(spark, place.processed).count() == before + filter_edits(later).count()
    assert sorted((b.writer, b.batch_id) for b in table.committed()) == [("edits", 0), ("edits", 1)]
    assert len({b.run for b in table.committed()}) == 1  # the checkpoint's
    whole = read_topic(spark, place.input)
    assert texts(table.current()) == texts(keyed.current_rows(writer_job(filter_job(whole))))


@pytest.mark.parametrize("fits", [True, False])
def test_allow_list_as_a_table(spark, place, monkeypatch, fits):
    monkeypatch.setattr("millrace.operators.filters.fits_broadcast", lambda df, rows: fits)
    append_topic(topic(spark, events(60)), place.input)
    allowed = spark.createDataFrame([("www.wikidata.org",), ("x",)], "name string")
    run(runners.filter_stream(spark, place.input, place.processed, allowed), runners.FILTER_QUERY, place)
    got = texts(decode_processed(read_topic(spark, place.processed)))
    assert got == texts(filter_edits(topic(spark, events(60)), ["www.wikidata.org", "x"]))


def test_rows_as_they_come(spark, place):
    append_topic(filter_job(topic(spark, events(60))), place.processed)
    table = EditsTable(spark, place.table)
    run(runners.edits_stream(spark, place.processed, table, arrange=False), runners.WRITER_QUERY, place)
    assert texts(table.current()) == texts(keyed.current_rows(writer_job(read_topic(spark, place.processed))))


def test_drop_and_pass(spark, place):
    values = [
        event(user="bot", bot=True), event(user="uk", domain="uk.wikipedia.org"), event(user="wd", domain="www.wikidata.org"),
    ]
    append_topic(topic(spark, values), place.input)
    table = EditsTable(spark, place.table)
    both(spark, place, table)
    assert [table.current().filter(F.col("user_id") == u).count() for u in ("bot", "uk", "wd")] == [0, 0, 1]


@pytest.mark.parametrize("max_per_trigger", [None, 10])
def test_side_outputs(spark, place, max_per_trigger):
    table = EditsTable(spark, place.table)
    good = '{"user_id":"u","domain":"d","created_at":"2026-05-01T10:00:00Z","page_title":"p"}'
    append_topic(topic(spark, [good, "bad", '{"user_id":"u"}'], "processed"), place.processed)
    stream = runners.edits_stream(spark, place.processed, table, max_per_trigger=max_per_trigger, side=place.side)
    run(stream, runners.WRITER_QUERY, place)
    append_topic(topic(spark, [good, good, good, "{", good], "processed").withColumn("offset", F.col("offset") + 2), place.processed)
    assert sorted((r.partition, r.lag) for r in metrics.consumer_lag(
        read_topic(spark, place.processed), runners.read_ledger(spark, place.side)).collect()) == [(0, 3), (1, 3)]
    run(runners.edits_stream(spark, place.processed, table, side=place.side), runners.WRITER_QUERY, place)
    rejects = runners.read_rejects(spark, place.side)
    assert sorted((r.raw, r.reason) for r in rejects.collect()) == [("bad", "bad_json"), ("{", "bad_json"), ('{"user_id":"u"}', "incomplete")]
    counts = runners.read_ledger(spark, place.side).select("partition", "n_read", "bad_json", "incomplete", "passed")
    assert sorted(map(tuple, counts.collect())) == [(0, 2, 0, 1, 1), (0, 3, 0, 0, 3), (1, 1, 1, 0, 0), (1, 2, 1, 0, 1)]
    lag = metrics.consumer_lag(read_topic(spark, place.processed), runners.read_ledger(spark, place.side))
    assert {r.lag for r in lag.collect()} == {0}


def test_no_side_outputs_yet(spark, place):
    assert runners.read_ledger(spark, place.side).count() == 0
    assert runners.read_rejects(spark, place.side).count() == 0


def test_observed_counts(spark, place):
    listener = ObservedTotals()
    spark.streams.addListener(listener)
    try:
        append_topic(topic(spark, events(40)), place.input)
        run(runners.observed_filter_stream(spark, place.input, place.processed), runners.FILTER_QUERY, place)
        until = time.time() + 20
        while listener.totals.get(runners.FILTER_QUERY, {}).get("n_read") != 40 and time.time() < until:
            time.sleep(0.1)
        totals = listener.totals[runners.FILTER_QUERY]
        assert totals["n_read"] == 40 and totals["bad_json"] == 6
        assert totals["passed"] == read_topic(spark, place.processed).count() == filter_edits(topic(spark, events(40))).count()
    finally:
        spark.streams.removeListener(listener)


def test_failure_surfaces(spark, place):
    append_topic(topic(spark, events(3)), place.input)

    def fail(batch, batch_id):
        raise RuntimeError("no space")

    writer = spark.readStream.schema(TOPIC_RECORD).parquet(place.input.path).writeStream.foreachBatch(fail)
    with pytest.raises(Exception, match="no space"):
        run(writer, "failing", place)


def test_a_batch_that_failed_half_way_is_run_again(spark, place, monkeypatch):
    append_topic(filter_job(topic(spark, events(40))), place.processed)
    table = EditsTable(spark, place.table)
    write_side = runners._write_side

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(runners, "_write_side", fail)
    with pytest.raises(Exception, match="lost"):
        run(runners.edits_stream(spark, place.processed, table, side=place.side), runners.WRITER_QUERY, place)
    written = table.read_log().count()
    monkeypatch.setattr(runners, "_write_side", write_side)
    run(runners.edits_stream(spark, place.processed, table, side=place.side), runners.WRITER_QUERY, place)
    assert table.read_log().count() == written > 0
    assert [(b.writer, b.batch_id) for b in table.committed()] == [("edits", 0)]
    assert runners.read_ledger(spark, place.side).agg(F.sum("n_read")).first()[0] == written


def test_throughput_counts_every_record_however_late(spark, place, tmp_path):
    start = dt.datetime(2026, 5, 1, tzinfo=dt.timezone.utc)
    out = str(tmp_path / "out")

    def land(*minutes):
        rows = [(None, b"x", "input", 0, i, start + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)]
        append_topic(spark.createDataFrame(rows, TOPIC_RECORD).coalesce(1), place.input)

    def go():
        run(runners.throughput_stream(spark, place.input, out, "10 minutes"), "throughput", place)
        got = runners.read_throughput(spark, out)
        want = metrics.topic_throughput(read_topic(spark, place.input), "10 minutes")
        assert texts(got) == texts(want)
        return got.count()

    assert runners.read_throughput(spark, out).count() == 0
    land(1, 2, 12)
    assert go() == 2
    land(3, 26)
    assert go() == 3
    land(4, 50)  # long after its window
    assert go() == 4


def test_a_lost_checkpoint_loses_no_rows(spark, place, tmp_path):
    """The topic holds other records by the time the writer starts over, with a compaction in between or without."""
    table = EditsTable(spark, place.table)
    rows = []
    for k, compacted in enumerate((False, True, False)):
        source = Topic("processed", path=str(tmp_path / f"processed{k}"))
        values = [event(user=f"u{k}", title=f"t{i}") for i in range(5)]
        append_topic(filter_job(topic(spark, values).withColumn("offset", F.col("offset") + 100 * k)), source)
        rows.append(read_topic(spark, source))
        place.checkpoints = str(tmp_path / f"checkpoints{k}")
        run(runners.edits_stream(spark, source, table, side=place.side), runners.WRITER_QUERY, place)
        if compacted:
            table.compact()
            table.vacuum()
    whole = rows[0].unionByName(rows[1]).unionByName(rows[2])
    assert texts(table.current()) == texts(keyed.current_rows(writer_job(whole)))
    assert runners.read_ledger(spark, place.side).agg(F.sum("n_read")).first()[0] == 15


def test_a_batch_run_again_after_a_compaction_leaves_the_table_alone(spark, place, monkeypatch):
    append_topic(filter_job(topic(spark, events(40))), place.processed)
    table = EditsTable(spark, place.table)
    write_side = runners._write_side

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(runners, "_write_side", fail)
    with pytest.raises(Exception, match="lost"):
        run(runners.edits_stream(spark, place.processed, table, side=place.side), runners.WRITER_QUERY, place)
    table.compact()
    before = texts(table.current())
    monkeypatch.setattr(runners, "_write_side", write_side)
    run(runners.edits_stream(spark, place.processed, table, side=place.side), runners.WRITER_QUERY, place)
    assert texts(table.current()) == before
    assert runners.read_ledger(spark, place.side).agg(F.sum("n_read")).first()[0] == read_topic(spark, place.processed).count()


def test_the_filter_accounts_for_what_it_leaves_out(spark, place):
    append_topic(topic(spark, events(40)).repartition(4), place.input)
    stream = runners.kept_filter_stream(spark, place.input, place.processed, place.side, max_per_trigger=1)
    run(stream, runners.FILTER_QUERY, place)
    assert texts(decode_processed(read_topic(spark, place.processed))) == texts(filter_edits(topic(spark, events(40))))
    assert {r.raw for r in runners.read_rejects(spark, place.side).collect()} == {"bad"}
    counts = runners.read_ledger(spark, place.side, RAW_OUTCOMES)
    totals = counts.agg(*[F.sum(x).alias(x) for x in ("n_read", *RAW_OUTCOMES)]).first()
    assert totals.n_read == 40 == sum(totals[x] for x in RAW_OUTCOMES) and totals.bad_json == 6
    table = EditsTable(spark, place.table)
    run(runners.edits_stream(spark, place.processed, table), runners.WRITER_QUERY, place)
    assert table.current().count() > 0


def test_feed_batches_are_replayed_once_and_numbered_without_gaps(spark, place, tmp_path, monkeypatch):
    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.txt").write_text("".join(f'id: {i}\ndata: {{"n": {i}}}\n\n' for i in range(30)) + "data: bad\n\n")
    write_side = runners._write_side

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(runners, "_write_side", fail)
    with pytest.raises(Exception, match="lost"):
        run(runners.feed_stream(spark, str(feed), place.input, side=place.side), runners.FEED_QUERY, place)
    monkeypatch.setattr(runners, "_write_side", write_side)
    (feed / "b.txt").write_text("".join(f'id: {i}\ndata: {{"n": {i}}}\n\n' for i in range(30, 50)))
    run(runners.feed_stream(spark, str(feed), place.input, side=place.side), runners.FEED_QUERY, place)
    got = read_topic(spark, place.input)
    assert sorted(bytes(r.value) for r in got.collect()) == sorted(b'{"n": %d}' % i for i in range(50))
    for partition, n, first, last in got.groupBy("partition").agg(F.count("*"), F.min("offset"), F.max("offset")).collect():
        assert (first, last) == (0, n - 1), partition
    counts = runners.read_feed_ledger(spark, place.side)
    assert tuple(counts.agg(F.sum("n_read"), F.sum("sent"), F.sum("bad_json")).first()) == (51, 50, 1)
    assert [tuple(r) for r in runners.read_feed_rejects(spark, place.side).collect()] == [("bad", "bad_json")]
