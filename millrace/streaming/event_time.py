"""Figures and duplicates by event time, with state that a watermark bounds.

The event time of a record is the time its topic gave it. State is kept by Spark in the stream's checkpoint, so a stream that
is started again goes on where it was. What is older than the watermark (the latest time seen before the micro-batch, less the
allowed lateness) is too late: windows it would belong to are closed. How many records were too late is the difference
between what has arrived, which `runners.throughput_stream` counts without a watermark, and what was counted in time
(`late_records`); `progress.ObservedTotals.late` has Spark's own running figure. Records without a time belong to no
window. No records leave no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.metrics import topic_sessions, topic_throughput
from millrace.schemas import COORDINATES
from millrace.sources import files
from millrace.sources.topics import Topic, as_topic, source_seq, stream_topic, topic_writer
from millrace.streaming.runners import read_throughput, run_of

WINDOWS = "topic STRING, window_start TIMESTAMP, n_records BIGINT"
SESSIONS = "topic STRING, partition INT, first_timestamp TIMESTAMP, last_timestamp TIMESTAMP, n_records BIGINT"


def _timed(spark: SparkSession, source: Topic, lateness: str, max_per_trigger: int | None) -> DataFrame:
    return stream_topic(spark, source, max_per_trigger=max_per_trigger).withWatermark("timestamp", lateness)


def running_throughput_stream(
    spark: SparkSession, source: Topic, path: str, interval: str = "1 hour", lateness: str = "1 hour", max_per_trigger: int | None = None
) -> DataStreamWriter:
    """Records per window as they stand: each micro-batch leaves the new totals of the windows it changed, which
    `read_running` puts together. A micro-batch that is run again replaces its totals."""

    def write(batch: DataFrame, batch_id: int) -> None:
        at = f"{path.rstrip('/')}/{files.batch_name(run_of(batch), batch_id)}"
        batch.write.options(**files.MARKED).mode("overwrite").parquet(at)

    counts = topic_throughput(_timed(spark, source, lateness, max_per_trigger), interval)
    return counts.writeStream.foreachBatch(write).outputMode("update")


def read_running(spark: SparkSession, path: str) -> DataFrame:
    """Records per topic and window, as the finished micro-batches of `running_throughput_stream` have left them."""
    marks = files.glob(spark, f"{path.rstrip('/')}/run=*/batch_id=*/_SUCCESS")
    if not marks:
        return spark.createDataFrame([], WINDOWS)
    totals = spark.read.schema(WINDOWS).parquet(*[mark.rsplit("/", 1)[0] for mark in marks])
    return totals.groupBy("topic", "window_start").agg(F.max("n_records").alias("n_records"))  # totals only grow


def closed_throughput_stream(
    spark: SparkSession, source: Topic, path: str, interval: str = "1 hour", lateness: str = "1 hour", max_per_trigger: int | None = None
) -> DataStreamWriter:
    """Records per window, each window once, when the watermark has passed its end."""
    counts = topic_throughput(_timed(spark, source, lateness, max_per_trigger), interval)
    return counts.writeStream.format("parquet").option("path", path).outputMode("append")


def late_records(counted: DataFrame, arrived: DataFrame) -> DataFrame:
    """Per topic and window how many records were counted in time (`n_records`) and how many came too late (`n_late`)."""
    at = ["topic", "window_start"]
    both = arrived.withColumnRenamed("n_records", "n_arrived").join(counted, at, "left")
    in_time = F.coalesce("n_records", F.lit(0))
    return both.select(*at, in_time.alias("n_records"), (F.col("n_arrived") - in_time).alias("n_late"))


def late_of(spark: SparkSession, running: str, arrivals: str) -> DataFrame:
    """`late_records` of the folders that `running_throughput_stream` and `runners.throughput_stream` write."""
    return late_records(read_running(spark, running), read_throughput(spark, arrivals))


def sessions_stream(
    spark: SparkSession, source: Topic, path: str, gap: str = "30 minutes", lateness: str = "1 hour", max_per_trigger: int | None = None
) -> DataStreamWriter:
    """Stretches of records without an idle `gap`, per topic and partition, each once it can grow no more."""
    sessions = topic_sessions(_timed(spark, source, lateness, max_per_trigger), gap)
    return sessions.writeStream.format("parquet").option("path", path).outputMode("append")


def unique_records(records: DataFrame, within: str) -> DataFrame:
    """Records once each, by the place they had in their source, if they recur `within` that much event time.

    State holds a place until the watermark has passed its record's time by `within`, so its size follows the topic's rate.
    Records older than the watermark are dropped: replayed ones, whose first copy has passed, and first ones that come later
    than `within`, which must be chosen for the source's disorder.
    """
    timed = records.withWatermark("timestamp", within)
    return timed.dropDuplicatesWithinWatermark(["topic", "partition", "offset"])


def unique_topic_stream(
    spark: SparkSession, source: Topic, target: Topic, within: str = "1 day", max_per_trigger: int | None = None
) -> DataStreamWriter:
    """A topic that holds records more than once, because their writer was started again -> one that holds each once."""
    records = stream_topic(spark, source, max_per_trigger=max_per_trigger, with_headers=source.servers is not None)
    place = source_seq(records)  # a broker has numbered the second copy anew
    records = unique_records(records.withColumns({name: place[name] for name in COORDINATES}), within)
    return topic_writer(as_topic(records, target.name), target)
