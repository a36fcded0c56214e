"""Pipeline figures as queries: counts, throughput, freshness, lag.

All are aggregations with a partial step in every task, over a handful of columns.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.edits import classify_processed, classify_raw
from millrace.schemas import ALLOWED_DOMAINS

POSITION_SCHEMA = "topic STRING, partition INT, next_offset BIGINT"


def topic_scan(topic: DataFrame) -> DataFrame:
    """Records per partition and the offsets they span."""
    return topic.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def topic_freshness(topic: DataFrame, now: Column | None = None) -> DataFrame:
    """Newest record per partition and, given `now`, for how long nothing has come."""
    out = topic.groupBy("topic", "partition").agg(F.max("timestamp").alias("last_timestamp"))
    if now is None:
        return out
    idle = F.unix_micros(now) - F.unix_micros("last_timestamp")
    return out.withColumn("idle_seconds", (idle / F.lit(1_000_000)).cast("double"))


def topic_throughput(topic: DataFrame, interval: str = "1 hour") -> DataFrame:
    """Records per topic and time window, by broker time."""
    counts = topic.groupBy("topic", F.window("timestamp", interval)).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.select("topic", F.col("window.start").alias("window_start"), "n_records")


def topic_sessions(topic: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Stretches of records of a partition in which nothing is missing for as long as `gap`, by broker time.

    Sessions are merged within each task first, so that a partition with most of the records sends few rows on.
    """
    session = F.session_window("timestamp", gap).alias("session")
    counts = topic.groupBy("topic", "partition", session).agg(
        F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"), F.count(F.lit(1)).alias("n_records")
    )
    return counts.drop("session").select("topic", "partition", "first_timestamp", "last_timestamp", "n_records")


def idle_gaps(sessions: DataFrame) -> DataFrame:
    """Sessions with the seconds nothing came before each; null for the first one of a partition.

    A window holds a partition's sessions, of which there are no more than its time span has gaps.
    """
    before = F.lag("last_timestamp").over(Window.partitionBy("topic", "partition").orderBy("first_timestamp"))
    idle = (F.unix_micros("first_timestamp") - F.unix_micros(before)) / F.lit(1_000_000)
    return sessions.withColumn("idle_seconds", idle.cast("double"))


def positions(consumed: DataFrame) -> DataFrame:
    """Where a reader stands after consuming these records: the next offset per partition.

    To be taken before any filter. A record that a filter drops has been consumed.
    """
    return consumed.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def consumer_lag(topic: DataFrame, committed: DataFrame) -> DataFrame:
    """Records per partition that a reader at `committed` has still to read.

    `committed` may hold several positions of a partition; the furthest counts. A partition without
    one counts from its first record. Both sides of the join are
    aggregated to one row per partition first.
    """
    ends = topic.groupBy("topic", "partition").agg(
        F.min("offset").alias("start_offset"), (F.max("offset") + 1).alias("end_offset")
    )
    at = committed.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))
    return ends.join(at, ["topic", "partition"], "left").select(
        "topic",
        "partition",
        "end_offset",
        F.coalesce("next_offset", "start_offset").alias("next_offset"),
        (F.col("end_offset") - F.coalesce("next_offset", "start_offset")).alias("lag"),
    )


def positions_from_progress(spark: SparkSession, end_offsets: Sequence[str | Mapping]) -> DataFrame:
    """Positions from the `endOffset` of a broker source in a streaming progress report:
    `{"topic": {"partition": next_offset}}`. A stream commits no offsets to a consumer group, so
    this is where its position is to be had. One short text per source, not data."""
    reports = [end if isinstance(end, Mapping) else json.loads(end) for end in end_offsets]
    rows = [
        (topic, int(partition), int(next_offset))
        for report in reports
        for topic, partitions in report.items()
        for partition, next_offset in partitions.items()
    ]
    return spark.createDataFrame(rows, POSITION_SCHEMA)


def counters(outcomes: Sequence[str]) -> list[Column]:
    """Aggregates over classified records, one per outcome; fit for `agg` and `observe`."""
    return [
        F.count(F.lit(1)).alias("n_read"),
        *[F.count_if(F.col("outcome") == name).alias(name) for name in outcomes],
    ]


def ledger(classified: DataFrame, outcomes: Sequence[str]) -> DataFrame:
    """Next offset and counts per outcome, for every partition in a batch of classified records."""
    return classified.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"), *counters(outcomes))


def stage_counts(raw: DataFrame, processed: DataFrame, allowed: Sequence[str] = ALLOWED_DOMAINS) -> DataFrame:
    """What each stage read, kept, filtered out and rejected: one row per stage and outcome.

    Each topic is read once. Outcomes that did not occur have no row.
    """
    first = classify_raw(raw, allowed).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    second = classify_processed(processed).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
    return first.select(F.lit("filter").alias("stage"), "outcome", "n").unionByName(
        second.select(F.lit("writer").alias("stage"), "outcome", "n")
    )
