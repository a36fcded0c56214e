"""Topics: a broker's, or a folder of Parquet files with the same columns.

The broker binding needs the `spark-sql-kafka-0-10` package (Scala 2.13 build for Spark 4) on the
session's classpath. Without it only folders can be read and written.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.schemas import COORDINATES, PROCESSED_TOPIC, SEQ, TOPIC_RECORD
from millrace.sources import files

_HEADER_PREFIX = "source."
_ENDS_FOLDER = "_ends"  # readers of a folder pass over names that begin so
_ENDS = "partition int, next_offset long"


@dataclass(frozen=True)
class Topic:
    """A topic by name, at a broker (`servers`) or in a folder (`path`).

    A folder has one kind of writer: either one stream with a file sink, whose file log then says what is in
    it, or batches (`append_topic`, `replace_batch`, `publish_values`). `options` go to the broker's reader and
    writer.
    """

    name: str
    path: str | None = None
    servers: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    partitions: int = 4  # among which a folder's new records are dealt

    def __post_init__(self) -> None:
        if (self.path is None) == (self.servers is None):
            raise ValueError("a topic is either in a folder or at a broker")


def _broker_options(topic: Topic) -> dict[str, str]:
    return {"kafka.bootstrap.servers": topic.servers, **topic.options}


def read_topic(
    spark: SparkSession, topic: Topic, start: str = "earliest", end: str = "latest", with_headers: bool = False
) -> DataFrame:
    """All records between two positions, as a batch."""
    if topic.path is not None:
        return spark.read.schema(TOPIC_RECORD).option("recursiveFileLookup", "true").parquet(topic.path)
    reader = spark.read.format("kafka").options(**_broker_options(topic))
    reader = reader.option("subscribe", topic.name).option("includeHeaders", str(with_headers).lower())
    return reader.option("startingOffsets", start).option("endingOffsets", end).load()


def stream_topic(
    spark: SparkSession,
    topic: Topic,
    start: str | Mapping[int, int] = "earliest",
    max_per_trigger: int | None = None,
    with_headers: bool = False,
) -> DataFrame:
    """The topic as a stream.

    `start` matters only until a checkpoint exists. `earliest`, the default, leaves no gap. At a broker it may
    be `latest`; in either place it may be the first offset of each partition, where others begin with
    their first record (`latest_start` finds and keeps a folder's ends). `max_per_trigger` bounds a
    micro-batch: in records at a broker, in files in a folder.
    """
    if topic.path is not None:
        if start == "latest":
            raise ValueError("a folder's latest position is where it ended when the stream was made: see latest_start")
        reader = spark.readStream.schema(TOPIC_RECORD).option("recursiveFileLookup", "true")
        if max_per_trigger is not None:
            reader = reader.option("maxFilesPerTrigger", max_per_trigger)
        records = reader.parquet(topic.path)
        return records if start == "earliest" else records.filter(_not_before(start))
    if not isinstance(start, str):
        start = json.dumps({topic.name: {str(k): v for k, v in start.items()}})
    reader = spark.readStream.format("kafka").options(**_broker_options(topic))
    reader = reader.option("subscribe", topic.name).option("includeHeaders", str(with_headers).lower())
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.option("startingOffsets", start).load()


def from_offsets(
    records: DataFrame, start: Mapping[int, int], end: Mapping[int, int] | None = None
) -> DataFrame:
    """Records of the named partitions from their `start` offset on and before their `end`, if they
    have one. Reaches the file scan."""
    wanted = F.lit(False)
    for partition, first in start.items():
        here = (F.col("partition") == partition) & (F.col("offset") >= first)
        if end is not None and partition in end:
            here = here & (F.col("offset") < end[partition])
        wanted = wanted | here
    return records.filter(wanted)


def _not_before(start: Mapping[int, int]) -> Column:
    """Records from each partition's offset on, and all of partitions without one."""
    earlier = F.lit(False)
    for partition, first in start.items():
        earlier = earlier | ((F.col("partition") == partition) & (F.col("offset") < first))
    return ~earlier


def latest_start(spark: SparkSession, topic: Topic, path: str) -> dict[int, int]:
    """The ends of a folder's partitions when this was first asked for with `path`, which keeps them.

    To be kept with a stream's checkpoint, so that the stream starts at the same place each time.
    """
    if not files.exists(spark, f"{path}/_SUCCESS"):
        ends = end_offsets(spark, topic)
        out = spark.createDataFrame(sorted(ends.items()), _ENDS).coalesce(1).write.options(**files.MARKED)
        out.mode("overwrite").parquet(path)
    return {r["partition"]: r["next_offset"] for r in spark.read.schema(_ENDS).parquet(path).collect()}


def append_topic(records: DataFrame, topic: Topic) -> None:
    """Append a batch of records."""
    if topic.path is not None:
        records.select(*TOPIC_RECORD.names).write.mode("append").parquet(topic.path)
    else:
        writer = _for_broker(records).write.format("kafka").options(**_broker_options(topic))
        writer.option("topic", topic.name).save()


def replace_batch(records: DataFrame, topic: Topic, run: str, batch_id: int) -> bool:
    """Write one batch of records to a folder's own place for it. One that is there whole is left as it is:
    its records may have been read. Returns whether it was written."""
    path = f"{topic.path}/{files.batch_name(run, batch_id)}"
    if files.exists(records.sparkSession, f"{path}/_SUCCESS"):
        return False
    records.select(*TOPIC_RECORD.names).write.options(**files.MARKED).mode("overwrite").parquet(path)
    return True


def publish_values(values: DataFrame, topic: Topic, run: str = "batch", batch_id: int | None = None) -> None:
    """Add values that have no place yet as new records without a key.

    In a folder a batch goes on numbering where the one before it ended, and one that is published again
    changes nothing. Beside its records it leaves the ends of the partitions, so that no history is read.
    """
    if topic.path is None:
        writer = values.select("value").write.format("kafka").options(**_broker_options(topic))
        writer.option("topic", topic.name).save()
        return
    spark = values.sparkSession
    done = _published(spark, topic)
    if batch_id is None:
        batch_id = max((n for r, n in done if r == run), default=-1) + 1
    if (run, batch_id) in done:
        return
    starts = end_offsets(spark, topic, done)
    if not files.exists(spark, f"{topic.path}/{files.batch_name(run, batch_id)}/_SUCCESS"):
        with numbered_records(values, topic, starts) as numbered:
            replace_batch(numbered, topic, run, batch_id)
    written = spark.read.schema(TOPIC_RECORD).parquet(f"{topic.path}/{files.batch_name(run, batch_id)}")
    grown = written.groupBy("partition").agg((F.max("offset") + 1).alias("next_offset"))
    ends = starts | {r["partition"]: r["next_offset"] for r in grown.collect()}  # one number a partition
    out = spark.createDataFrame(sorted(ends.items()), _ENDS).coalesce(1).write.options(**files.MARKED)
    out.mode("overwrite").parquet(f"{topic.path}/{_ENDS_FOLDER}/{files.batch_name(run, batch_id)}")


def _published(spark: SparkSession, topic: Topic) -> set[tuple[str, int]]:
    """Runs and numbers of the batches that are there whole, with their ends."""
    marks = files.glob(spark, f"{topic.path}/{_ENDS_FOLDER}/run=*/batch_id=*/_SUCCESS")
    found = (re.search(r"/run=([^/]+)/batch_id=(\d+)/_SUCCESS$", mark) for mark in marks)
    return {(m[1], int(m[2])) for m in found}


def end_offsets(spark: SparkSession, topic: Topic, done: set[tuple[str, int]] | None = None) -> dict[int, int]:
    """One past the last offset of each partition of a folder.

    From the ends that the last published batch of every run has left; of a folder without such, from its records.
    """
    done = _published(spark, topic) if done is None else done
    last: dict[str, int] = {}
    for run, batch_id in done:
        last[run] = max(batch_id, last.get(run, -1))
    if last:
        paths = [f"{topic.path}/{_ENDS_FOLDER}/{files.batch_name(*x)}" for x in sorted(last.items())]
        rows = spark.read.schema(_ENDS).parquet(*paths)
    elif not files.exists(spark, topic.path):
        return {}
    else:
        rows = read_topic(spark, topic).select("partition", (F.col("offset") + 1).alias("next_offset"))
    found = rows.groupBy("partition").agg(F.max("next_offset").alias("next_offset")).collect()
    return {r["partition"]: r["next_offset"] for r in found}


def topic_writer(records: DataFrame, topic: Topic) -> DataStreamWriter:
    """A stream writer that appends; the caller adds checkpoint, trigger and start."""
    if topic.path is not None:
        writer = records.select(*TOPIC_RECORD.names).writeStream.format("parquet")
        return writer.option("path", topic.path).outputMode("append")
    writer = _for_broker(records).writeStream.format("kafka").options(**_broker_options(topic))
    return writer.option("topic", topic.name).outputMode("append")


def as_topic(df: DataFrame, name: str = PROCESSED_TOPIC) -> DataFrame:
    """`key`, `value` and source coordinates as records of a topic in a folder.

    A record keeps the partition, offset and timestamp of the record it was made from: unlike a
    broker's own numbers, these order the writes to a key, and a replay brings the same ones again.
    """
    return df.withColumn("topic", F.lit(name)).withColumn("value", F.col("value").cast("binary")).select(
        *TOPIC_RECORD.names
    )


def number_records(values: DataFrame, topic: Topic, starts: Mapping[int, int] | None = None) -> DataFrame:
    """Values without coordinates as new records for a folder, which has no broker to number them.

    Each goes to one of the topic's partitions and gets the next offset there, without gaps, from `starts` on. In
    order of `position` where values have such a column, else of their hash; either way a batch that is made
    again gets the same numbers. Within a partition of the topic this is one sort in one task: for batches that are
    read in one, see `numbered_records`.
    """
    order = Window.partitionBy("partition").orderBy(*_position(values), F.xxhash64("value"), "value")
    first = F.lit(0).cast("long")
    for partition, offset in (starts or {}).items():
        first = F.when(F.col("partition") == partition, F.lit(offset).cast("long")).otherwise(first)
    return _stamped(_dealt(values, topic).withColumn("offset", F.row_number().over(order) - 1 + first), topic)


@contextmanager
def numbered_records(values: DataFrame, topic: Topic, starts: Mapping[int, int] | None = None) -> Iterator[DataFrame]:
    """The same numbers, by as many tasks as the values are read in; the records are there within the `with` block.

    The order of a partition's records is cut into ranges, which are sorted and kept on the executors' disks. What ranges
    hold of each partition is counted, one number each, so that each knows the offset it begins with. Records that are
    alike may stand in several ranges.
    """
    n = values.rdd.getNumPartitions()
    if n <= 1:
        yield number_records(values, topic, starts)
        return
    spark = values.sparkSession
    order = ["partition", *(["position"] if _position(values) else []), "_hash", "_other"]
    hashed = _dealt(values, topic).withColumns({"_hash": F.xxhash64("value"), "_other": F.xxhash64(F.lit(1), "value")})
    ranges = hashed.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(n, *order, "_tie")
    kept = ranges.sortWithinPartitions(*order, "value").select(
        "partition", "value", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("_at")
    )
    kept = kept.persist(StorageLevel.DISK_ONLY)
    try:
        held = kept.groupBy("partition", "_range").agg(F.count(F.lit(1)).alias("n"), F.min("_at").alias("least")).collect()
        ends, begins = dict(starts or {}), []
        for r in sorted(held):  # ranges are in order
            end = ends.get(r["partition"], 0)
            begins.append((r["partition"], r["_range"], end - r["least"]))
            ends[r["partition"]] = end + r["n"]
        first = F.broadcast(spark.createDataFrame(begins, "partition int, _range int, _begin long"))
        placed = kept.join(first, ["partition", "_range"]).withColumn("offset", F.col("_at") + F.col("_begin"))
        yield _stamped(placed, topic)
    finally:
        kept.unpersist()


def _position(values: DataFrame) -> list[Column]:
    return [F.col("position")] if "position" in values.columns else []


def _dealt(values: DataFrame, topic: Topic) -> DataFrame:
    """Values with the topic's partition they go to."""
    return values.withColumn("partition", F.pmod(F.xxhash64("value"), F.lit(topic.partitions)).cast("int"))


def _stamped(placed: DataFrame, topic: Topic) -> DataFrame:
    stamped = placed.withColumn("key", F.lit(None).cast("binary")).withColumn("timestamp", F.current_timestamp())
    return as_topic(stamped, topic.name)


def _for_broker(records: DataFrame) -> DataFrame:
    """A broker numbers records itself, so the source coordinates go along as headers."""
    return records.select("key", "value", coordinate_headers().alias("headers"))


def coordinate_headers() -> Column:
    stamps = {"timestamp": F.unix_micros("timestamp"), "partition": F.col("partition"), "offset": F.col("offset")}
    return F.array(
        *[
            F.struct(
                F.lit(_HEADER_PREFIX + name).alias("key"),
                stamps[name].cast("string").cast("binary").alias("value"),
            )
            for name in COORDINATES
        ]
    )


def source_seq(records: DataFrame) -> Column:
    """The coordinates that order a record's write: those in its headers, else its own."""
    own = F.struct(*COORDINATES).cast(SEQ)
    if "headers" not in records.columns:
        return own

    def header(name: str) -> Column:
        found = F.filter("headers", lambda h: h["key"] == F.lit(_HEADER_PREFIX + name))
        return F.get(found, F.lit(0))["value"].cast("string").try_cast("bigint")

    carried = F.struct(
        F.timestamp_micros(header("timestamp")).alias("timestamp"),
        header("partition").cast("int").alias("partition"),
        header("offset").alias("offset"),
    ).cast(SEQ)
    return F.when(header("offset").isNotNull(), carried).otherwise(own)
