"""Rates of the main paths, and the alternatives that were weighed, on a larger topic.

The topic is `events` of $BENCH_SF_DIR repeated $COPIES times with new event and user numbers.
Prints one line per measurement: best of three, and records per second.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from bench import session  # noqa: E402
from millrace import fixtures  # noqa: E402
from millrace.functions.decode import decode_raw, text  # noqa: E402
from millrace.operators import keyed  # noqa: E402
from millrace.operators.edits import select_edits  # noqa: E402
from millrace.operators.filters import allowed_domain, filter_domain, filter_human, human  # noqa: E402
from millrace.plans import pipelines  # noqa: E402
from millrace.schemas import KEY, RAW_EVENT  # noqa: E402
from millrace.session import configure, workspace  # noqa: E402
from millrace.sources.edits_table import EditsTable  # noqa: E402
from millrace.sources.topics import Topic, read_topic  # noqa: E402
from millrace.streaming import runners  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
COPIES = int(os.environ.get("COPIES", "60"))


def made(spark: SparkSession, folder: str) -> Topic:
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    n, users = events.agg(F.max("event_id") + 1, F.max("user_id") + 1).first()
    copy = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))).alias("copy")
    more = events.repartition(spark.sparkContext.defaultParallelism * 2, "event_id").select("*", copy)
    more = more.withColumn("event_id", F.col("event_id") + F.col("copy") * n)
    more = more.withColumn("user_id", F.col("user_id") + F.col("copy") * users)
    more.drop("copy").write.parquet(f"{folder}/events.parquet")
    fixtures.raw_topic(spark, folder).write.parquet(f"{folder}/input")
    return Topic("input", path=f"{folder}/input")


def main() -> None:
    spark = configure(session())
    folder = workspace(spark, "rates")
    source = made(spark, folder)
    raw = read_topic(spark, source)

    def show(what: str, records: int, run, times: int = 3) -> None:
        best = None
        for _ in range(times):
            begin = time.perf_counter()
            run()
            took = time.perf_counter() - begin
            best = took if best is None else min(best, took)
        print(f"| {what} | {best:.2f} s | {records / best / 1e6:.2f} M/s |", flush=True)

    def every_row(df: DataFrame):
        return lambda: df.write.format("noop").mode("overwrite").save()

    n = raw.count()
    parsed = raw.select(F.from_json(text(), RAW_EVENT).alias("data")).select("data.*")
    show("filter: parse per predicate (chained filters)", n, every_row(select_edits(parsed.filter(allowed_domain()).filter(human()))))
    show("filter: one parse", n, every_row(select_edits(filter_human(filter_domain(decode_raw(raw))))))
    show("filter: one parse, of records that may pass (default)", n, every_row(pipelines.filter_edits(raw)))
    show("filter job, with encoding", n, every_row(pipelines.filter_job(raw)))

    checkpoints, processed = f"{folder}/checkpoints", Topic("processed", path=f"{folder}/processed")

    def stream(writer, name):
        return lambda: runners.start(writer, name, checkpoints, until_caught_up=True).awaitTermination()

    show("filter job as a stream", n, stream(runners.filter_stream(spark, source, processed), "filter"), 1)
    records = read_topic(spark, processed)
    kept = records.count()
    show("writer job", kept, every_row(pipelines.writer_job(records)))
    table = EditsTable(spark, f"{folder}/edits")
    show("writer job as a stream, to the table", kept, stream(runners.edits_stream(spark, processed, table), "edits"), 1)
    other = EditsTable(spark, f"{folder}/other")
    as_they_come = runners.edits_stream(spark, processed, other, arrange=False)
    show("the same, rows written as they come", kept, stream(as_they_come, "other"), 1)

    log = table.read_log()
    newest = Window.partitionBy(*KEY).orderBy(F.desc("seq"))
    ranked = log.withColumn("nth", F.row_number().over(newest)).filter("nth = 1").drop("nth")
    show("last write wins: row_number", kept, every_row(ranked))
    show("last write wins: max of (seq, cells)", kept, every_row(keyed.latest_rows(log)))
    show("cell merge with deletes", kept, every_row(keyed.current_rows(log)))
    show("table read, not compacted", kept, every_row(table.current()))
    show("compaction", kept, table.compact, 1)
    show("table read, compacted", kept, every_row(table.current()))
    spark.stop()


if __name__ == "__main__":
    main()
