"""A wide-column store as source and sink of the edits table, in place of files.

Needs the store's Spark connector (`spark-cassandra-connector`, Scala 2.13 build) on the classpath.
It is not part of this environment, so this binding has been reviewed but never run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from millrace.operators.keyed import latest_rows
from millrace.plans.pipelines import writer_job
from millrace.schemas import PROCESSED_EVENT
from millrace.sources.topics import Topic, stream_topic

FORMAT = "org.apache.spark.sql.cassandra"


def read_rows(spark: SparkSession, keyspace: str, table: str) -> DataFrame:
    """Current rows. The store merges writes itself; key predicates are pushed to it."""
    return spark.read.format(FORMAT).options(keyspace=keyspace, table=table).load()


def append_rows(rows: DataFrame, keyspace: str, table: str, consistency: str = "ONE") -> None:
    """Upsert rows by key; nulls leave cells untouched."""
    writer = rows.write.format(FORMAT).options(keyspace=keyspace, table=table).mode("append")
    writer = writer.option("spark.cassandra.output.ignoreNulls", "true")
    writer.option("spark.cassandra.output.consistency.level", consistency).save()


def store_stream(
    spark: SparkSession, source: Topic, keyspace: str, table: str, max_per_trigger: int | None = None
) -> DataStreamWriter:
    """Processed topic -> store.

    The store orders writes by arrival. Within a micro-batch the last write of a key is picked here;
    between micro-batches the order is the topic's, which its key makes right per table key.
    """
    processed = stream_topic(spark, source, max_per_trigger=max_per_trigger, with_headers=source.servers is not None)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = latest_rows(writer_job(batch)).select(*PROCESSED_EVENT.names)
        append_rows(rows, keyspace, table)

    return processed.writeStream.foreachBatch(write).outputMode("append")
