"""Every operator and pipeline as a query over a folder of tables.

Each reads the whole `events` table, from which the topics are derived (`millrace.fixtures`), and
returns columns that a SQL check computes straight from `events` (`millrace.oracles`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace import fixtures
from millrace.functions.decode import (
    decode_processed,
    decode_raw,
    flatten_legacy,
    is_json,
    is_json_object,
    json_or_null,
    text,
)
from millrace.functions.scalars import canonical_uuid
from millrace.operators import edits, feed, filters, keyed, metrics
from millrace.plans import pipelines
from millrace.schemas import (
    ALLOWED_DOMAINS,
    INPUT_TOPIC,
    LEGACY_EVENT,
    PROCESSED_EVENT,
    PROCESSED_TOPIC,
    TOPIC_RECORD,
    require,
)
from millrace.session import configure, workspace
from millrace.sources import feed_files
from millrace.sources.edits_table import EditsTable
from millrace.sources.topics import Topic, append_topic, from_offsets, read_topic
from millrace.streaming import runners

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# parameters of single queries; the SQL checks use the same
EVENT_ID = "542"
LOOKUP = {"domain": "en.wikipedia.org", "created_at": dt.datetime(2024, 1, 6), "user_id": "user_4"}
LOOKUP_USER = "user_8"
LOOKUP_TITLE = "Page_33"
TIMELINE_DOMAIN = "commons.wikimedia.org"
TIMELINE_BEFORE = dt.datetime(2024, 1, 25, 12)
HEAD_ROWS = 10
TRUNCATED_AT = dt.datetime(2024, 1, 15, 12)
CONSUMED_UNTIL = dt.datetime(2024, 1, 20)
NOW = dt.datetime(2024, 2, 1)
STARTING_OFFSETS = {0: 10, 1: 0, 2: 7, 3: 20}
PLACE = ("partition", "offset")


def query(build: Query) -> Query:
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _without_zone(build(configure(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


def _without_zone(df: DataFrame) -> DataFrame:
    """UTC wall-clock times, the way the tables themselves hold them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if f.dataType == T.TimestampType() else F.col(f.name)
            for f in df.schema
        ]
    )


def _instant(value: dt.datetime):
    return F.lit(keyed.as_utc(value))


def _land(spark: SparkSession, records: DataFrame, name: str, batches: int = 1) -> tuple[Topic, int]:
    """Records as a topic in a folder, in files by ranges of offsets, as many as the session shuffles into.

    Also how many files a micro-batch may have for the topic to be read in about `batches` of them.
    """
    topic = Topic(name, path=f"{workspace(spark, 'topic')}/{name}")
    n = max(batches, int(spark.conf.get("spark.sql.shuffle.partitions")))
    append_topic(records.repartitionByRange(n, "offset"), topic)
    return topic, -(-n // batches)


def _edit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the two jobs together write for the whole input topic."""
    return pipelines.writer_job(pipelines.filter_job(fixtures.raw_topic(spark, sf_dir)))


def _merged_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _edit_log(spark, sf_dir).unionByName(fixtures.flag_updates(spark, sf_dir))


def _full_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merged_log(spark, sf_dir).unionByName(fixtures.tombstones(spark, sf_dir))


# --- topics and decoding ------------------------------------------------------------------


@query
def topic_scan(spark, sf_dir):
    topic, _ = _land(spark, fixtures.raw_topic(spark, sf_dir), INPUT_TOPIC)
    return metrics.topic_scan(require(read_topic(spark, topic), TOPIC_RECORD, "topic"))


@query
def topic_from_offsets(spark, sf_dir):
    records = from_offsets(fixtures.raw_topic(spark, sf_dir), STARTING_OFFSETS)
    return records.select("topic", *PLACE, "timestamp", text().alias("value"))


@query
def decode_raw_events(spark, sf_dir):
    return decode_raw(fixtures.raw_topic(spark, sf_dir), PLACE).select(
        *PLACE,
        F.col("meta.id").alias("meta_id"),
        F.col("meta.dt").alias("meta_dt"),
        F.col("meta.domain").alias("meta_domain"),
        F.col("performer.user_text").alias("user_text"),
        F.col("performer.user_is_bot").alias("user_is_bot"),
        "page_title",
    )


@query
def json_validity(spark, sf_dir):
    raw = fixtures.raw_topic(spark, sf_dir).select(*PLACE, text().alias("raw"))
    return raw.select(
        *PLACE,
        is_json(F.col("raw")).alias("is_json"),
        is_json_object(F.col("raw")).alias("is_object"),
        F.try_variant_get(json_or_null(F.col("raw")), "$.page_title", "string").alias("page_title"),
    )


@query
def rejects(spark, sf_dir):
    first = edits.rejects(edits.classify_raw(fixtures.raw_topic(spark, sf_dir)))
    second = edits.rejects(edits.classify_processed(fixtures.uneven_processed_topic(spark, sf_dir)))
    return first.unionByName(second)


# --- filtering and projection -------------------------------------------------------------


@query
def filter_domain(spark, sf_dir):
    decoded = decode_raw(fixtures.raw_topic(spark, sf_dir), PLACE)
    return filters.filter_domain(decoded).select(*PLACE, F.col("meta.domain").alias("domain"))


@query
def filter_domain_list(spark, sf_dir):
    """The allow-list comes as a table: domains with an event whose flag is missing on day one."""
    events = fixtures.source_events(spark, sf_dir)
    allowed = events.filter(F.col("is_bot").isNull() & (F.col("day") == _instant(dt.datetime(2024, 1, 1)))).select("domain")
    decoded = decode_raw(fixtures.raw_topic(spark, sf_dir), PLACE)
    return filters.filter_domain(decoded, allowed).select(*PLACE, F.col("meta.domain").alias("domain"))


@query
def filter_human(spark, sf_dir):
    decoded = decode_raw(fixtures.raw_topic(spark, sf_dir), PLACE)
    return filters.filter_human(decoded).select(
        *PLACE, F.col("performer.user_text").alias("user_text"), F.col("performer.user_is_bot").alias("user_is_bot")
    )


@query
def filter_edits(spark, sf_dir):
    return pipelines.filter_edits(fixtures.raw_topic(spark, sf_dir))


@query
def find_event(spark, sf_dir):
    found = pipelines.find_event(fixtures.raw_topic(spark, sf_dir), EVENT_ID, PLACE)
    return found.select(*PLACE, F.col("meta.id").alias("meta_id"), F.col("meta.domain").alias("domain"), "page_title")


@query
def encode_processed(spark, sf_dir):
    processed = pipelines.filter_job(fixtures.raw_topic(spark, sf_dir))
    return processed.select("topic", *PLACE, "timestamp", text("key").alias("key"), text("value").alias("value"))


@query
def decode_processed_events(spark, sf_dir):
    return decode_processed(fixtures.uneven_processed_topic(spark, sf_dir), PLACE)


@query
def edits_clean(spark, sf_dir):
    return pipelines.typed_edits(fixtures.uneven_processed_topic(spark, sf_dir), keep=PLACE)


# --- the keyed table ----------------------------------------------------------------------


@query
def edits_current(spark, sf_dir):
    return keyed.latest_rows(_edit_log(spark, sf_dir)).select(*PROCESSED_EVENT.names)


@query
def edits_cell_merge(spark, sf_dir):
    return keyed.current_rows(_merged_log(spark, sf_dir))


@query
def edits_delete(spark, sf_dir):
    return keyed.current_rows(_full_log(spark, sf_dir))


@query
def edits_truncate(spark, sf_dir):
    return keyed.current_rows(_full_log(spark, sf_dir), TRUNCATED_AT)


@query
def edits_count(spark, sf_dir):
    return keyed.count_rows(keyed.current_rows(_full_log(spark, sf_dir)))


@query
def edits_key_check(spark, sf_dir):
    return keyed.key_check(keyed.current_rows(_full_log(spark, sf_dir)))


@query
def edits_layout(spark, sf_dir):
    """Rows in each stored directory, and how many are out of order within their file."""
    table = _stored(spark, _full_log(spark, sf_dir))
    table.compact()
    stored = table.layout().filter("n_rows > 0")  # a directory may hold deleted keys alone
    return stored.select("domain", F.col("d").cast("string").alias("d"), "n_rows", "n_unordered")


def _stored(spark: SparkSession, log: DataFrame) -> EditsTable:
    table = EditsTable(spark, workspace(spark, "edits"))
    table.write_batch(log, "backfill", 0)
    return table


@query
def edits_stored(spark, sf_dir):
    """Written to the table's folders by three writers, and read back."""
    table = EditsTable(spark, workspace(spark, "edits"))
    table.write_batch(_edit_log(spark, sf_dir), "edits", 0)
    table.write_batch(fixtures.flag_updates(spark, sf_dir), "flags", 0, arrange=False)
    table.write_batch(fixtures.tombstones(spark, sf_dir), "cleaner", 0)
    return table.current()


@query
def edits_compacted(spark, sf_dir):
    """Compacted twice, with writes before, between and after."""
    table = EditsTable(spark, workspace(spark, "edits"))
    table.write_batch(fixtures.tombstones(spark, sf_dir), "cleaner", 0)
    table.compact()
    table.write_batch(_edit_log(spark, sf_dir), "edits", 0)
    table.compact()
    table.write_batch(fixtures.flag_updates(spark, sf_dir), "flags", 0)
    return table.current()


@query
def lookup_key(spark, sf_dir):
    return keyed.lookup_key(_stored(spark, _merged_log(spark, sf_dir)).read_log(), **LOOKUP)


@query
def lookup_user(spark, sf_dir):
    return _stored(spark, _full_log(spark, sf_dir)).current(keyed.key_predicate(user_id=LOOKUP_USER))


@query
def lookup_title(spark, sf_dir):
    return keyed.lookup_title(_stored(spark, _full_log(spark, sf_dir)).read_log(), LOOKUP_TITLE)


@query
def lookup_title_compacted(spark, sf_dir):
    table = _stored(spark, _merged_log(spark, sf_dir))
    table.compact()
    table.write_batch(fixtures.tombstones(spark, sf_dir), "cleaner", 0)
    return table.with_title(LOOKUP_TITLE)


@query
def count_compacted(spark, sf_dir):
    """The number of rows, for most directories from the manifest."""
    table = _stored(spark, _merged_log(spark, sf_dir))
    table.compact()
    table.write_batch(fixtures.tombstones(spark, sf_dir), "cleaner", 0)
    return table.count()


@query
def table_truncated(spark, sf_dir):
    """Dropped and made anew, truncated, and written to again by the second writer."""
    table = _stored(spark, _edit_log(spark, sf_dir))
    table.drop()
    table.write_batch(_edit_log(spark, sf_dir), "edits", 0)
    table.truncate()
    table.write_batch(fixtures.flag_updates(spark, sf_dir), "flags", 0)
    return table.current()


@query
def domain_timeline(spark, sf_dir):
    """A page of the stored table: days after the instant are not read."""
    table = _stored(spark, _full_log(spark, sf_dir))
    page = keyed.domain_timeline(table.current(keyed.older_than(TIMELINE_DOMAIN, TIMELINE_BEFORE)), TIMELINE_DOMAIN)
    # numbers the domain's rows, so that their order shows in the result
    order = Window.partitionBy("domain").orderBy(*keyed.newest_first())
    return page.withColumn("position", F.row_number().over(order).cast("bigint"))


@query
def edits_head(spark, sf_dir):
    first = keyed.head(_stored(spark, _full_log(spark, sf_dir)).current(), HEAD_ROWS)
    # numbers the ten rows that are left, so that their order shows in the result
    order = Window.orderBy("domain", *keyed.newest_first())
    return first.withColumn("position", F.row_number().over(order).cast("bigint"))


# --- figures ------------------------------------------------------------------------------


@query
def topic_throughput(spark, sf_dir):
    raw = fixtures.raw_places(spark, sf_dir).select("topic", "timestamp")
    processed = pipelines.filter_job(fixtures.raw_topic(spark, sf_dir)).select("topic", "timestamp")
    return metrics.topic_throughput(raw.unionByName(processed))


@query
def topic_freshness(spark, sf_dir):
    return metrics.topic_freshness(fixtures.raw_places(spark, sf_dir), _instant(NOW))


@query
def consumer_lag(spark, sf_dir):
    raw = fixtures.raw_places(spark, sf_dir)
    consumed = raw.filter((F.col("timestamp") < _instant(CONSUMED_UNTIL)) & (F.col("partition") != 3))
    return metrics.consumer_lag(raw, metrics.positions(consumed))


@query
def stage_counts(spark, sf_dir):
    return metrics.stage_counts(fixtures.raw_topic(spark, sf_dir), fixtures.uneven_processed_topic(spark, sf_dir))


# --- feed and older forms -----------------------------------------------------------------


def _landed_feed(spark: SparkSession, sf_dir: str) -> str:
    folder = f"{workspace(spark, 'feed')}/frames"
    feed_files.write_frames(fixtures.feed_frames(spark, sf_dir), folder)
    return folder


def _landed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_files.read_frames(spark, _landed_feed(spark, sf_dir))


@query
def feed_decode(spark, sf_dir):
    return pipelines.publish_feed(_landed_frames(spark, sf_dir)).select(text().alias("value"))


@query
def feed_rejects(spark, sf_dir):
    return feed.unpublishable(feed.feed_messages(_landed_frames(spark, sf_dir)))


@query
def uuid_normalize(spark, sf_dir):
    ids = fixtures.source_events(spark, sf_dir).select("event_id", fixtures.mixed_uuid(F.col("event_id")).alias("given"))
    return ids.withColumn("uuid", canonical_uuid(F.col("given")))


@query
def legacy_flatten(spark, sf_dir):
    return flatten_legacy(fixtures.raw_topic(spark, sf_dir), PLACE)


@query
def legacy_normalize(spark, sf_dir):
    return pipelines.legacy_rows(fixtures.raw_topic(spark, sf_dir, fixtures.mixed_uuid(F.col("event_id"))))


# --- streams ------------------------------------------------------------------------------


def _run(writer, name: str, checkpoints: str):
    stream = runners.start(writer, name, checkpoints, until_caught_up=True)
    stream.awaitTermination()
    return stream


def _filter_to_folder(spark: SparkSession, source: Topic, checkpoints: str, files_at_once: int | None = None) -> Topic:
    target = Topic(PROCESSED_TOPIC, path=f"{workspace(spark, 'topic')}/{PROCESSED_TOPIC}")
    stream = runners.filter_stream(spark, source, target, max_per_trigger=files_at_once)
    _run(stream, runners.FILTER_QUERY, checkpoints)
    return target


@query
def stream_filter(spark, sf_dir):
    source, at_once = _land(spark, fixtures.raw_topic(spark, sf_dir), INPUT_TOPIC, batches=3)
    return decode_processed(read_topic(spark, _filter_to_folder(spark, source, workspace(spark, "checkpoints"), at_once)))


@query
def stream_edits(spark, sf_dir):
    """Both jobs as streams, over a topic in between."""
    checkpoints = workspace(spark, "checkpoints")
    source, at_once = _land(spark, fixtures.raw_topic(spark, sf_dir), INPUT_TOPIC, batches=2)
    target = _filter_to_folder(spark, source, checkpoints, at_once)
    table = EditsTable(spark, workspace(spark, "edits"))
    _run(runners.edits_stream(spark, target, table), runners.WRITER_QUERY, checkpoints)
    return table.current().select(*PROCESSED_EVENT.names)


def _write_anew(spark: SparkSession, source: Topic, table: EditsTable, at_once: int | None) -> None:
    """The writer stream, with a checkpoint that has been lost."""
    stream = runners.edits_stream(spark, source, table, max_per_trigger=at_once)
    _run(stream, runners.WRITER_QUERY, workspace(spark, "checkpoints"))


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.filter_job(fixtures.raw_topic(spark, sf_dir))


@query
def replay_idempotent(spark, sf_dir):
    """The writer stream loses its checkpoint after it has written, and starts over."""
    source, at_once = _land(spark, _processed(spark, sf_dir), PROCESSED_TOPIC, batches=2)
    table = EditsTable(spark, workspace(spark, "edits"))
    for _ in range(2):
        _write_anew(spark, source, table, at_once)
    return table.current().select(*PROCESSED_EVENT.names)


@query
def replay_other_boundaries(spark, sf_dir):
    """The same, but by then the topic has lost its first half, and micro-batches are of another size."""
    records = _processed(spark, sf_dir)
    early = F.col("timestamp") < _instant(CONSUMED_UNTIL)
    table = EditsTable(spark, workspace(spark, "edits"))
    for part, batches in ((records.filter(early), 3), (records.filter(~early), 1)):
        source, at_once = _land(spark, part, PROCESSED_TOPIC, batches=batches)
        _write_anew(spark, source, table, at_once)
    return table.current().select(*PROCESSED_EVENT.names)


@query
def replay_after_compaction(spark, sf_dir):
    """The same, with a compaction and a vacuum in between."""
    records = _processed(spark, sf_dir)
    early = F.col("timestamp") < _instant(CONSUMED_UNTIL)
    table = EditsTable(spark, workspace(spark, "edits"))
    for part in (records.filter(early), records):
        source, at_once = _land(spark, part, PROCESSED_TOPIC, batches=2)
        _write_anew(spark, source, table, at_once)
        table.compact()
        table.vacuum()
    return table.current().select(*PROCESSED_EVENT.names)


@query
def stream_legacy(spark, sf_dir):
    """The older single job as a stream, from the earliest record."""
    records = fixtures.raw_topic(spark, sf_dir, fixtures.mixed_uuid(F.col("event_id")))
    source, _ = _land(spark, records, INPUT_TOPIC)
    out = f"{workspace(spark, 'legacy')}/rows"
    _run(runners.legacy_stream(spark, source, out), "legacy", workspace(spark, "checkpoints"))
    return spark.read.schema(T.StructType([*LEGACY_EVENT[:3], T.StructField("dt", T.TimestampType())])).parquet(out)


def _fed_topic(spark: SparkSession, sf_dir: str, partitions: int, runs: int = 1, side: str | None = None) -> Topic:
    """The feed's messages as a topic; in several `runs` each from a folder of its own, all published twice."""
    source = Topic(INPUT_TOPIC, path=f"{workspace(spark, 'topic')}/{INPUT_TOPIC}", partitions=partitions)
    frames = fixtures.feed_frames(spark, sf_dir)
    for k in range(runs):
        folder = f"{workspace(spark, 'feed')}/frames"
        feed_files.write_frames(frames.filter(F.pmod(F.xxhash64("value"), F.lit(runs)) == k), folder)
        _run(runners.feed_stream(spark, folder, source, side=side), runners.FEED_QUERY, workspace(spark, "checkpoints"))
    return source


@query
def feed_to_table(spark, sf_dir):
    """Feed files to edits table, three streams in a row. The topic has one partition, so that the frames' own
    numbers order the writes."""
    checkpoints = workspace(spark, "checkpoints")
    target = _filter_to_folder(spark, _fed_topic(spark, sf_dir, 1), checkpoints)
    table = EditsTable(spark, workspace(spark, "edits"))
    _run(runners.edits_stream(spark, target, table), runners.WRITER_QUERY, checkpoints)
    return table.current().select("domain", "created_at", "user_id", "page_title")


@query
def feed_lag(spark, sf_dir):
    """Over a topic that the feed has written in several batches: offsets without gaps or repeats, so that the lag of
    a reader that has read nothing is the number of records."""
    topic = _fed_topic(spark, sf_dir, 4, runs=3)
    records = read_topic(spark, topic)
    nothing = spark.createDataFrame([], metrics.POSITION_SCHEMA)
    lag = metrics.consumer_lag(records, nothing).groupBy("topic").agg(F.sum("lag").alias("lag"), F.sum("end_offset").alias("n_ends"))
    places = records.groupBy("topic", *PLACE[:1], PLACE[1]).agg(F.count(F.lit(1)).alias("n"))
    counts = places.groupBy("topic").agg(F.sum("n").alias("n_records"), F.count_if(F.col("n") > 1).alias("n_repeated"))
    return counts.join(lag, "topic")


@query
def feed_stream_counts(spark, sf_dir):
    """What the feed read, sent and skipped, from its ledger."""
    side = workspace(spark, "side")
    _fed_topic(spark, sf_dir, 4, runs=2, side=side)
    counts = runners.read_feed_ledger(spark, side)
    return counts.agg(*[F.sum(name).alias(name) for name in ("n_read", *feed.FEED_OUTCOMES)])


def _uneven_writer_run(spark: SparkSession, sf_dir: str, until: dt.datetime | None = None) -> tuple[Topic, str]:
    """Run the writer with its side outputs over the first part of the uneven topic, then land the rest."""
    records = fixtures.uneven_processed_topic(spark, sf_dir)
    first = records if until is None else records.filter(F.col("timestamp") < _instant(until))
    source, at_once = _land(spark, first, PROCESSED_TOPIC, batches=2)
    table = EditsTable(spark, workspace(spark, "edits"))
    side = workspace(spark, "side")
    stream = runners.edits_stream(spark, source, table, max_per_trigger=at_once, side=side)
    _run(stream, runners.WRITER_QUERY, workspace(spark, "checkpoints"))
    if until is not None:
        append_topic(records.filter(F.col("timestamp") >= _instant(until)), source)
    return source, side


@query
def stream_rejects(spark, sf_dir):
    return runners.read_rejects(spark, _uneven_writer_run(spark, sf_dir)[1])


@query
def stream_counts(spark, sf_dir):
    ledger = runners.read_ledger(spark, _uneven_writer_run(spark, sf_dir)[1])
    return ledger.agg(*[F.sum(name).alias(name) for name in ("n_read", *edits.PROCESSED_OUTCOMES)])


@query
def stream_lag(spark, sf_dir):
    source, side = _uneven_writer_run(spark, sf_dir, CONSUMED_UNTIL)
    return metrics.consumer_lag(read_topic(spark, source), runners.read_ledger(spark, side))


def _kept_filter_run(spark: SparkSession, sf_dir: str) -> tuple[Topic, str]:
    source, at_once = _land(spark, fixtures.raw_topic(spark, sf_dir), INPUT_TOPIC, batches=3)
    target = Topic(PROCESSED_TOPIC, path=f"{workspace(spark, 'topic')}/{PROCESSED_TOPIC}")
    side = workspace(spark, "side")
    stream = runners.kept_filter_stream(spark, source, target, side, ALLOWED_DOMAINS, max_per_trigger=at_once)
    _run(stream, runners.FILTER_QUERY, workspace(spark, "checkpoints"))
    return target, side


@query
def stream_filter_rejects(spark, sf_dir):
    return runners.read_rejects(spark, _kept_filter_run(spark, sf_dir)[1])


@query
def stream_observed(spark, sf_dir):
    """Counts of the filter stream, from its ledger, and what it has written."""
    target, side = _kept_filter_run(spark, sf_dir)
    names = ("n_read", *edits.RAW_OUTCOMES, "n_written")
    counts = runners.read_ledger(spark, side, edits.RAW_OUTCOMES)
    written = metrics.topic_scan(read_topic(spark, target)).withColumnRenamed("n_records", "n_written")
    return counts.unionByName(written, allowMissingColumns=True).agg(*[F.sum(name).alias(name) for name in names])


@query
def stream_throughput(spark, sf_dir):
    """Hourly counts as a stream."""
    source, at_once = _land(spark, fixtures.raw_topic(spark, sf_dir), INPUT_TOPIC, batches=3)
    out = workspace(spark, "throughput")
    stream = runners.throughput_stream(spark, source, out, max_per_trigger=at_once)
    _run(stream, "throughput", workspace(spark, "checkpoints"))
    return runners.read_throughput(spark, out)
