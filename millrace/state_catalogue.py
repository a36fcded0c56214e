"""Queries on state and time: event-time figures, duplicates, changes, lists that change, indexes.

They add to `millrace.catalogue.QUERIES`, by the same rules.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import fixtures
from millrace.catalogue import LOOKUP_USER, PLACE, QUERIES, _full_log, _instant, _run, query
from millrace.functions.decode import decode_processed, decode_raw, text
from millrace.operators import drift, keyed, metrics
from millrace.operators.as_of import allowed_as_of
from millrace.plans import pipelines
from millrace.schemas import EDIT_LOG, INPUT_TOPIC, PROCESSED_TOPIC
from millrace.session import workspace
from millrace.sources import feed_files, partitioned, raw_variant, title_index, zorder
from millrace.sources import feed_source as feed_source_
from millrace.sources.topics import Topic, append_topic, read_topic
from millrace.streaming import changes, event_time, runners

__all__ = ["QUERIES"]

CUTS = (dt.datetime(2024, 1, 10, 12, 30), dt.datetime(2024, 1, 20, 12, 30))
LATENESS_DAYS = 2
LATE_EVERY = 13  # one event of so many arrives last
IDLE_MINUTES = 30
TITLES_ENDING = "7"
FEED_SPLIT = 1 << 17


def _slices(records: DataFrame, cuts=CUTS) -> list[DataFrame]:
    """Records by time, in as many parts as the cuts make."""
    at = F.col("timestamp")
    first = [records.filter(at < _instant(cuts[0]))]
    middle = [records.filter((at >= _instant(a)) & (at < _instant(b))) for a, b in zip(cuts, cuts[1:])]
    return [*first, *middle, records.filter(at >= _instant(cuts[-1]))]


def _place(spark: SparkSession, name: str) -> Topic:
    return Topic(name, path=f"{workspace(spark, 'topic')}/{name}")


def _in_turn(spark: SparkSession, topic: Topic, parts: list[DataFrame], *streams) -> None:
    """Land one part after the other; after each, start every stream again from its checkpoint until it is caught up."""
    checkpoints = workspace(spark, "checkpoints")
    for part in parts:
        append_topic(part, topic)
        for k, stream in enumerate(streams):
            _run(stream(), f"stream-{k}", checkpoints)


def _raw_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nothing = F.lit(None).cast("binary")
    return fixtures.raw_places(spark, sf_dir).select(nothing.alias("key"), nothing.alias("value"), "topic", *PLACE, "timestamp")


@query
def stream_throughput_late(spark, sf_dir):
    """Running hourly counts under a watermark, over a feed whose last part is late; what came too late is counted apart."""
    records = _raw_places(spark, sf_dir)
    number = F.col("offset") * fixtures.PARTITIONS + F.col("partition")
    late = records.filter(number % LATE_EVERY == 0)
    topic = _place(spark, INPUT_TOPIC)
    counted, arrived = workspace(spark, "running"), workspace(spark, "arrived")
    lateness = f"{LATENESS_DAYS} days"
    _in_turn(
        spark,
        topic,
        [*_slices(records.filter(number % LATE_EVERY != 0)), late],
        lambda: event_time.running_throughput_stream(spark, topic, counted, lateness=lateness),
        lambda: runners.throughput_stream(spark, topic, arrived),
    )
    return event_time.late_of(spark, counted, arrived)


@query
def stream_throughput_closed(spark, sf_dir):
    """Hourly counts, each window once when it is closed; the stream is started again in the middle of windows."""
    topic, out = _place(spark, INPUT_TOPIC), f"{workspace(spark, 'closed')}/windows"
    _in_turn(spark, topic, _slices(_raw_places(spark, sf_dir)), lambda: event_time.closed_throughput_stream(spark, topic, out))
    return spark.read.schema(event_time.WINDOWS).parquet(out)


@query
def topic_idle(spark, sf_dir):
    """Stretches of each partition without an idle half hour, and the seconds nothing came before each."""
    sessions = metrics.topic_sessions(fixtures.raw_places(spark, sf_dir), f"{IDLE_MINUTES} minutes")
    return metrics.idle_gaps(sessions)


@query
def stream_sessions(spark, sf_dir):
    """The same stretches as a stream, those that can grow no more."""
    topic, out = _place(spark, INPUT_TOPIC), f"{workspace(spark, 'sessions')}/closed"
    stream = lambda: event_time.sessions_stream(spark, topic, out, f"{IDLE_MINUTES} minutes")
    _in_turn(spark, topic, _slices(_raw_places(spark, sf_dir)), stream)
    return spark.read.schema(event_time.SESSIONS).parquet(out)


@query
def topic_unique(spark, sf_dir):
    """A topic whose writer was started again twice, at other boundaries, with every record once."""
    records = pipelines.filter_job(fixtures.raw_topic(spark, sf_dir))
    first, second, third = _slices(records)
    again = second.filter(F.col("timestamp") >= _instant(CUTS[1] - dt.timedelta(days=1)))
    source, target = _place(spark, PROCESSED_TOPIC), _place(spark, PROCESSED_TOPIC)
    stream = lambda: event_time.unique_topic_stream(spark, source, target, f"{LATENESS_DAYS} days")
    _in_turn(spark, source, [first, second, again.unionByName(third).unionByName(third), records], stream)
    return decode_processed(read_topic(spark, target), (*PLACE, "timestamp"))


@query
def edits_changes(spark, sf_dir):
    """The whole log as a stream, in an order that puts deletes first; its changes replayed."""
    log, out = f"{workspace(spark, 'log')}/log", workspace(spark, "changes")
    checkpoints = workspace(spark, "checkpoints")
    whole = _full_log(spark, sf_dir)
    for part in (whole.filter("op = 'del' or day(d) % 2 = 0"), whole):  # the second part brings the first one's writes again
        part.write.mode("append").parquet(log)
        _run(changes.changes_stream(spark.readStream.schema(EDIT_LOG).parquet(log), out), "changes", checkpoints)
    return changes.replayed(changes.read_changes(spark, out))


@query
def filter_domain_as_of(spark, sf_dir):
    """Events on domains that the list allowed at their time."""
    decoded = decode_raw(fixtures.raw_topic(spark, sf_dir), (*PLACE, "timestamp"))
    on_list = allowed_as_of(decoded, fixtures.allow_list_versions(spark, sf_dir))
    return on_list.select(*PLACE, F.col("meta.domain").alias("domain"))


@query
def stream_filter_as_of(spark, sf_dir):
    """The filter as a stream, with a list that gets its later versions while the stream runs."""
    versions = fixtures.allow_list_versions(spark, sf_dir)
    listed = f"{workspace(spark, 'list')}/versions"
    source, target, checkpoints = _place(spark, INPUT_TOPIC), _place(spark, PROCESSED_TOPIC), workspace(spark, "checkpoints")
    since = F.col("valid_from")
    bounds = [None, *CUTS, None]
    for part, low, high in zip(_slices(fixtures.raw_topic(spark, sf_dir)), bounds, bounds[1:]):
        new = versions if low is None else versions.filter(since >= _instant(low))
        (new if high is None else new.filter(since < _instant(high))).write.mode("append").parquet(listed)
        append_topic(part, source)
        stream = runners.versioned_filter_stream(spark, source, target, lambda s: s.read.parquet(listed))
        _run(stream, runners.FILTER_QUERY, checkpoints)
    return decode_processed(read_topic(spark, target), PLACE)


@query
def lookup_titles(spark, sf_dir):
    """Rows of many titles through an index that is bucketed as the rows are."""
    name = f"edits_{uuid.uuid4().hex}"
    title_index.write_indexed(keyed.current_rows(_full_log(spark, sf_dir)), name, workspace(spark, "indexed"), 8)
    titles = fixtures.source_events(spark, sf_dir).select("title").filter(F.col("title").endswith(TITLES_ENDING))
    return title_index.with_titles(spark, name, titles)


@query
def lookup_keys(spark, sf_dir):
    """Rows of many keys; only their directories are read."""
    path = f"{workspace(spark, 'edits')}/rows"
    partitioned.write_partitioned(keyed.current_rows(_full_log(spark, sf_dir)), path)
    return partitioned.rows_of_keys(spark.read.parquet(path), fixtures.wanted_keys(spark, sf_dir))


@query
def field_drift(spark, sf_dir):
    """Fields of the raw events by domain and day, with types and counts."""
    return drift.field_counts(fixtures.raw_topic(spark, sf_dir))


@query
def schema_drift(spark, sf_dir):
    """The schema that all raw events of a domain and day fit."""
    return drift.merged_schemas(fixtures.raw_topic(spark, sf_dir))


@query
def feed_source(spark, sf_dir):
    """Feed files read in small byte ranges, as a batch."""
    feed_source_.register(spark)
    folder = f"{workspace(spark, 'feed')}/frames"
    feed_files.write_frames(fixtures.feed_frames(spark, sf_dir), folder)
    frames = spark.read.format("feed").option("splitBytes", FEED_SPLIT).load(folder)
    return pipelines.publish_feed(frames).select(text().alias("value"))


@query
def stream_feed_source(spark, sf_dir):
    """Feed files as logs, read as a stream that is started again after more files have come."""
    feed_source_.register(spark)
    folder, out, checkpoints = f"{workspace(spark, 'feed')}/frames", f"{workspace(spark, 'fed')}/values", workspace(spark, "checkpoints")
    frames = fixtures.feed_frames(spark, sf_dir)
    for k in range(2):
        feed_files.write_frames(frames.filter(F.pmod(F.xxhash64("value"), F.lit(2)) == k), f"{folder}/{k}")
        read = spark.readStream.format("feed").option("splitBytes", FEED_SPLIT).load(folder)
        sent = pipelines.publish_feed(read).select(text().alias("value"))
        _run(sent.writeStream.format("parquet").option("path", out).outputMode("append"), "feed", checkpoints)
    return spark.read.parquet(out)


@query
def variant_events(spark, sf_dir):
    """Raw events landed as VARIANT, some of their paths read back."""
    path = f"{workspace(spark, 'variant')}/events"
    raw_variant.land(fixtures.raw_topic(spark, sf_dir), path)
    return raw_variant.read(spark, path).select(
        *PLACE,
        raw_variant.field("meta.id").alias("meta_id"),
        raw_variant.field("meta.dt").alias("meta_dt"),
        raw_variant.field("meta.domain").alias("meta_domain"),
        raw_variant.field("performer.user_text").alias("user_text"),
        raw_variant.field("performer.user_is_bot", "boolean").alias("user_is_bot"),
        raw_variant.field("page_title").alias("page_title"),
    )


@query
def lookup_user_zordered(spark, sf_dir):
    """A user's rows from a table in Z-order of user and time."""
    path = f"{workspace(spark, 'zorder')}/rows"
    zorder.write_zordered(keyed.current_rows(_full_log(spark, sf_dir)), path, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.read.parquet(path).filter(F.col("user_id") == LOOKUP_USER)
