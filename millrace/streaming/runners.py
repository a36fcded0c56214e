"""Running the pipelines as streams.

Each query has its own checkpoint, below one durable folder, and is started again from it after a
failure: nothing here catches a query's exception. Delivery to a topic is at least once; the edits
table takes a repeated record as the same write.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.functions.decode import encode_processed, record_key
from millrace.operators.edits import (
    PASSED,
    PROCESSED_OUTCOMES,
    RAW_OUTCOMES,
    classify_processed,
    classify_raw,
    clean_edits,
    rejects,
    select_edits,
)
from millrace.operators.feed import FEED_OUTCOMES, classify_messages, feed_messages, message_rejects, publishable
from millrace.operators.keyed import upserts
from millrace.operators.metrics import POSITION_SCHEMA, counters, ledger, topic_throughput
from millrace.plans.pipelines import filter_edits_as_of, filter_job, legacy_rows, publish_feed, writer_job
from millrace.schemas import ALLOWED_DOMAINS, COORDINATES, REJECT
from millrace.sources import files
from millrace.sources.edits_table import Batch, EditsTable
from millrace.sources.feed_files import stream_frames
from millrace.sources.topics import (
    Topic,
    append_topic,
    as_topic,
    publish_values,
    replace_batch,
    source_seq,
    stream_topic,
    topic_writer,
)

FEED_QUERY = "feed"
FILTER_QUERY = "filter"
WRITER_QUERY = "edits"


def start(
    writer: DataStreamWriter, name: str, checkpoints: str, every: str | None = None, until_caught_up: bool = False
) -> StreamingQuery:
    """Start under `name` with the checkpoint that belongs to it.

    Runs micro-batches without pause, or `every` interval, or `until_caught_up` with what is there.
    """
    writer = writer.option("checkpointLocation", f"{checkpoints.rstrip('/')}/{name}")
    if until_caught_up:
        writer = writer.trigger(availableNow=True)
    elif every is not None:
        writer = writer.trigger(processingTime=every)
    return writer.queryName(f"{name}@{checkpoints}").start()


def run_of(batch: DataFrame) -> str:
    """The id of the streaming query a micro-batch belongs to, as its checkpoint keeps it."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def filter_stream(
    spark: SparkSession,
    source: Topic,
    target: Topic,
    allowed: Sequence[str] | DataFrame = ALLOWED_DOMAINS,
    starting: str | Mapping[int, int] = "earliest",
    max_per_trigger: int | None = None,
) -> DataStreamWriter:
    """Raw topic -> processed topic. See `kept_filter_stream` for one that accounts for what it leaves out."""
    raw = stream_topic(spark, source, starting, max_per_trigger)
    return topic_writer(filter_job(raw, allowed, target.name), target)


def versioned_filter_stream(
    spark: SparkSession,
    source: Topic,
    target: Topic,
    versions: Callable[[SparkSession], DataFrame],
    starting: str | Mapping[int, int] = "earliest",
    max_per_trigger: int | None = None,
) -> DataStreamWriter:
    """The same with a list that changes while the stream runs: `versions` reads it anew for every micro-batch, and a
    record is held against the version of its own time."""

    def write(batch: DataFrame, batch_id: int) -> None:
        edits = filter_edits_as_of(batch, versions(batch.sparkSession), COORDINATES)
        encoded = as_topic(encode_processed(edits.withColumn("key", record_key()), ("key", *COORDINATES)), target.name)
        if target.path is not None:
            replace_batch(encoded, target, run_of(batch), batch_id)
        else:
            append_topic(encoded, target)

    return stream_topic(spark, source, starting, max_per_trigger).writeStream.foreachBatch(write).outputMode("append")


def kept_filter_stream(
    spark: SparkSession,
    source: Topic,
    target: Topic,
    side: str,
    allowed: Sequence[str] = ALLOWED_DOMAINS,
    starting: str | Mapping[int, int] = "earliest",
    max_per_trigger: int | None = None,
) -> DataStreamWriter:
    """The same, with rejects and exact counts in a `side` folder as `edits_stream` has them.

    Every record is decoded for it, once, also those that the plain form sorts out by their raw text.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        classified = classify_raw(batch, allowed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            edits = select_edits(classified.filter(F.col("outcome") == PASSED), COORDINATES)
            encoded = as_topic(encode_processed(edits.withColumn("key", record_key()), ("key", *COORDINATES)), target.name)
            if target.path is not None:
                replace_batch(encoded, target, run_of(batch), batch_id)
            else:
                append_topic(encoded, target)
            _write_side(side, FILTER_QUERY, batch, batch_id, rejects(classified), ledger(classified, RAW_OUTCOMES))
        finally:
            classified.unpersist()

    return stream_topic(spark, source, starting, max_per_trigger).writeStream.foreachBatch(write).outputMode("append")


def observed_filter_stream(
    spark: SparkSession,
    source: Topic,
    target: Topic,
    allowed: Sequence[str] = ALLOWED_DOMAINS,
    starting: str | Mapping[int, int] = "earliest",
    max_per_trigger: int | None = None,
) -> DataStreamWriter:
    """The same, with counts per outcome in every progress report, under `filter`.

    Counted in passing, in the job that does the work. Every record is decoded for it, also those
    that the plain form sorts out by their raw text.
    """
    raw = stream_topic(spark, source, starting, max_per_trigger)
    seen = classify_raw(raw, allowed).observe(FILTER_QUERY, *counters(RAW_OUTCOMES))
    edits = select_edits(seen.filter(F.col("outcome") == PASSED), COORDINATES)
    encoded = encode_processed(edits.withColumn("key", record_key()), ("key", *COORDINATES))
    return topic_writer(as_topic(encoded, target.name), target)


def edits_stream(
    spark: SparkSession,
    source: Topic,
    table: EditsTable,
    writer: str = WRITER_QUERY,
    starting: str | Mapping[int, int] = "earliest",
    max_per_trigger: int | None = None,
    side: str | None = None,
    arrange: bool = True,
) -> DataStreamWriter:
    """Processed topic -> edits table. `arrange` is explained at `EditsTable.write_batch`.

    With a `side` folder every micro-batch also leaves there the records it could not use
    (`rejects/`) and, per topic partition, the position it read up to and its counts per outcome
    (`ledger/`), all out of one decoding. A micro-batch that is run again replaces its outputs, or leaves
    the table alone if a compaction has taken them in; a stream that has lost its checkpoint is another run.
    """
    processed = stream_topic(spark, source, starting, max_per_trigger, with_headers=source.servers is not None)

    def put(rows: DataFrame, run: str, batch_id: int) -> None:
        if not table.holds(Batch(writer, batch_id, run)):
            table.write_batch(rows, writer, batch_id, arrange, run)

    def write(batch: DataFrame, batch_id: int) -> None:
        if side is None:
            put(writer_job(batch), run_of(batch), batch_id)
            return
        placed = batch.withColumn("seq", source_seq(batch))
        classified = classify_processed(placed, ("seq",)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            put(upserts(clean_edits(classified), F.col("seq")), run_of(batch), batch_id)
            counts = ledger(classified, PROCESSED_OUTCOMES)
            _write_side(side, writer, batch, batch_id, rejects(classified), counts)
        finally:
            classified.unpersist()

    return processed.writeStream.foreachBatch(write).outputMode("append")


def feed_stream(
    spark: SparkSession,
    path: str,
    target: Topic,
    newline: str = "\n",
    side: str | None = None,
    max_per_trigger: int | None = None,
) -> DataStreamWriter:
    """Feed files, as they land in a folder -> raw topic. With a `side` folder, messages that are skipped and
    counts of those sent and skipped are left there for each micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if side is None:
            publish_values(publish_feed(batch), target, run_of(batch), batch_id)
            return
        classified = classify_messages(feed_messages(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            publish_values(publishable(classified.drop("outcome")), target, run_of(batch), batch_id)
            counts = classified.agg(*counters(FEED_OUTCOMES))
            _write_side(side, FEED_QUERY, batch, batch_id, message_rejects(classified), counts)
        finally:
            classified.unpersist()

    return stream_frames(spark, path, newline, max_per_trigger).writeStream.foreachBatch(write).outputMode("append")


def legacy_stream(
    spark: SparkSession,
    source: Topic,
    path: str,
    starting: str | Mapping[int, int] = "earliest",
    max_per_trigger: int | None = None,
) -> DataStreamWriter:
    """Raw topic -> rows of the older single job, appended to a folder."""
    rows = legacy_rows(stream_topic(spark, source, starting, max_per_trigger))
    return rows.writeStream.format("parquet").option("path", path).outputMode("append")


def _write_side(side: str, writer: str, batch: DataFrame, batch_id: int, left_out: DataFrame, counts: DataFrame) -> None:
    at = f"writer={writer}/{files.batch_name(run_of(batch), batch_id)}"
    for kind, rows in (("rejects", left_out), ("ledger", counts)):
        rows.write.options(**files.MARKED).mode("overwrite").parquet(f"{side.rstrip('/')}/{kind}/{at}")


def read_ledger(
    spark: SparkSession, side: str, outcomes: Sequence[str] = PROCESSED_OUTCOMES, writer: str = "*"
) -> DataFrame:
    """Positions and counts left by all finished micro-batches, one row for each and topic partition."""
    counts = ", ".join(f"{name} BIGINT" for name in ("n_read", *outcomes))
    return _read_side(spark, side, "ledger", f"{POSITION_SCHEMA}, {counts}", writer)


def read_feed_ledger(spark: SparkSession, side: str) -> DataFrame:
    """Counts left by the feed's finished micro-batches, one row for each."""
    counts = ", ".join(f"{name} BIGINT" for name in ("n_read", *FEED_OUTCOMES))
    return _read_side(spark, side, "ledger", counts, FEED_QUERY)


def read_rejects(spark: SparkSession, side: str, writer: str = "*") -> DataFrame:
    """Records that finished micro-batches could not use."""
    return _read_side(spark, side, "rejects", REJECT, writer)


def read_feed_rejects(spark: SparkSession, side: str) -> DataFrame:
    """Messages that the feed's finished micro-batches skipped."""
    return _read_side(spark, side, "rejects", "raw STRING, reason STRING", FEED_QUERY)


def _read_side(spark: SparkSession, side: str, kind: str, schema: T.StructType | str, writer: str) -> DataFrame:
    marks = files.glob(spark, f"{side.rstrip('/')}/{kind}/writer={writer}/run=*/batch_id=*/_SUCCESS")
    if not marks:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[mark.rsplit("/", 1)[0] for mark in marks])


def throughput_stream(
    spark: SparkSession, source: Topic, path: str, interval: str = "1 hour", max_per_trigger: int | None = None
) -> DataStreamWriter:
    """Records per window as a stream: each micro-batch leaves its counts, `read_throughput` adds them up.

    No state is kept and no record comes too late; a micro-batch that is run again replaces its counts.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = topic_throughput(batch, interval)
        at = f"{path.rstrip('/')}/{files.batch_name(run_of(batch), batch_id)}"
        counts.write.options(**files.MARKED).mode("overwrite").parquet(at)

    records = stream_topic(spark, source, max_per_trigger=max_per_trigger).select("topic", "timestamp")
    return records.writeStream.foreachBatch(write).outputMode("append")


def read_throughput(spark: SparkSession, path: str) -> DataFrame:
    """Records per topic and window over all finished micro-batches so far."""
    schema = "topic STRING, window_start TIMESTAMP, n_records BIGINT"
    marks = files.glob(spark, f"{path.rstrip('/')}/run=*/batch_id=*/_SUCCESS")
    if not marks:
        return spark.createDataFrame([], schema)
    counts = spark.read.schema(schema).parquet(*[mark.rsplit("/", 1)[0] for mark in marks])
    return counts.groupBy("topic", "window_start").agg(F.sum("n_records").alias("n_records"))
