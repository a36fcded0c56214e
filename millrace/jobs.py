"""The pipelines as jobs (or with `spark-submit` and this package in `--py-files`).

    python -m millrace.jobs filter  --input INPUT  --output PROCESSED --checkpoints DIR [--side DIR]
    python -m millrace.jobs writer  --input PROCESSED --table DIR --checkpoints DIR [--side DIR]
    python -m millrace.jobs publish --feed DIR --output INPUT --checkpoints DIR [--side DIR]
    python -m millrace.jobs legacy  --input INPUT --output DIR --checkpoints DIR
    python -m millrace.jobs throughput|freshness --input TOPIC
    python -m millrace.jobs lag     --input TOPIC --side DIR
    python -m millrace.jobs compact [--full] [--vacuum] --table DIR
    python -m millrace.jobs vacuum|truncate|drop|count|check --table DIR
    python -m millrace.jobs find    --table DIR [--domain D] [--user U] [--title T] [--limit N] [--output DIR]

A topic is a folder, or a topic name where `--servers` (or the environment's KAFKA_BROKER) names a
broker; then the broker's Spark package must be on the classpath. Jobs run until stopped, or with
`--until-caught-up` until they have read what there is. A failure ends the process with its error;
started again, a job goes on from its checkpoint. Master, memory and shuffle sizes are the session's.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.keyed import head, key_check, key_predicate, newest_first
from millrace.operators.metrics import consumer_lag, topic_freshness, topic_throughput
from millrace.schemas import ALLOWED_DOMAINS, INPUT_TOPIC, PROCESSED_TOPIC
from millrace.session import configure
from millrace.sources.edits_table import EditsTable
from millrace.sources.topics import Topic, latest_start, read_topic
from millrace.streaming import runners

FIGURES = ("throughput", "freshness", "lag")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="jobs")
    jobs = parser.add_subparsers(dest="job", required=True)

    def stream(name: str, source: str | None) -> argparse.ArgumentParser:
        job = jobs.add_parser(name)
        job.add_argument("--checkpoints", required=True)
        job.add_argument("--servers", default=os.environ.get("KAFKA_BROKER"))
        job.add_argument("--every", help="time between micro-batches, e.g. '10 seconds'")
        job.add_argument("--until-caught-up", action="store_true")
        if source is not None:
            job.add_argument("--input", default=source)
            job.add_argument("--starting", choices=("earliest", "latest"), default="earliest", help="without a checkpoint")
            job.add_argument("--max-per-trigger", type=int)
        return job

    job = stream("filter", INPUT_TOPIC)
    job.add_argument("--output", default=PROCESSED_TOPIC)
    job.add_argument("--domains", nargs="+", default=list(ALLOWED_DOMAINS))
    job.add_argument("--observe", action="store_true", help="report counts per outcome with every micro-batch")
    job.add_argument("--side", help="folder for rejects and exact counts")
    job = stream("writer", PROCESSED_TOPIC)
    job.add_argument("--table", required=True)
    job.add_argument("--name", default=runners.WRITER_QUERY)
    job.add_argument("--side")
    job = stream("publish", None)
    job.add_argument("--feed", required=True)
    job.add_argument("--output", default=INPUT_TOPIC)
    job.add_argument("--side", help="folder for skipped messages and exact counts")
    job = stream("legacy", INPUT_TOPIC)
    job.add_argument("--output", required=True)
    for name in FIGURES:
        job = jobs.add_parser(name)
        job.add_argument("--input", default=INPUT_TOPIC)
        job.add_argument("--servers", default=os.environ.get("KAFKA_BROKER"))
        job.add_argument("--output", help="write the result there instead of showing it")
        if name == "lag":
            job.add_argument("--side", required=True, help="folder with the reader's ledger")
    for name in ("compact", "vacuum", "truncate", "drop", "count", "check", "find"):
        job = jobs.add_parser(name)
        job.add_argument("--table", required=True)
        if name == "compact":
            job.add_argument("--full", action="store_true")
            job.add_argument("--vacuum", action="store_true", help="afterwards, if no older reader is still running")
        if name == "find":
            job.add_argument("--domain")
            job.add_argument("--user")
            job.add_argument("--title")
            job.add_argument("--limit", type=int, help="all rows that match by default, 10 if nothing is asked for")
            job.add_argument("--output", help="write the rows there instead of showing them")
    return parser


def _topic(place: str, name: str, servers: str | None) -> Topic:
    return Topic(place, servers=servers) if servers else Topic(name, path=place)


def _starting(spark: SparkSession, args: argparse.Namespace, source: Topic) -> str | dict[int, int]:
    if args.starting == "latest" and source.path is not None:
        return latest_start(spark, source, f"{args.checkpoints.rstrip('/')}/start-of-{args.job}")
    return args.starting


def _stream(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "publish":
        writer = runners.feed_stream(spark, args.feed, _topic(args.output, INPUT_TOPIC, args.servers), side=args.side)
        name = runners.FEED_QUERY
    elif args.job == "legacy":
        source = _topic(args.input, INPUT_TOPIC, args.servers)
        writer = runners.legacy_stream(spark, source, args.output, _starting(spark, args, source), args.max_per_trigger)
        name = "legacy"
    elif args.job == "filter":
        source, target = _topic(args.input, INPUT_TOPIC, args.servers), _topic(args.output, PROCESSED_TOPIC, args.servers)
        rest = (args.domains, _starting(spark, args, source), args.max_per_trigger)
        if args.side:
            writer = runners.kept_filter_stream(spark, source, target, args.side, *rest)
        else:
            build = runners.observed_filter_stream if args.observe else runners.filter_stream
            writer = build(spark, source, target, *rest)
        name = runners.FILTER_QUERY
    else:
        source, table = _topic(args.input, PROCESSED_TOPIC, args.servers), EditsTable(spark, args.table)
        writer = runners.edits_stream(
            spark, source, table, args.name, _starting(spark, args, source), args.max_per_trigger, args.side
        )
        name = args.name
    runners.start(writer, name, args.checkpoints, args.every, args.until_caught_up).awaitTermination()


def _figures(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    records = read_topic(spark, _topic(args.input, INPUT_TOPIC, args.servers))
    if args.job == "throughput":
        return topic_throughput(records).orderBy("topic", "window_start")
    if args.job == "freshness":
        return topic_freshness(records, F.current_timestamp()).orderBy("topic", "partition")
    positions = runners.read_ledger(spark, args.side).select("topic", "partition", "next_offset")
    return consumer_lag(records, positions).orderBy("topic", "partition")


def _find(table: EditsTable, args: argparse.Namespace) -> DataFrame:
    where = key_predicate(args.domain, user_id=args.user)
    # the title is a cell, so it comes first and the key columns narrow its result
    rows = table.current(where) if args.title is None else table.with_title(args.title).filter(where)
    asked = args.domain is not None or args.user is not None or args.title is not None
    if args.limit is None and asked:
        return rows if args.output else rows.orderBy("domain", *newest_first())
    return head(rows, 10 if args.limit is None else args.limit)


def _put(result: DataFrame, output: str | None) -> DataFrame:
    """Write the result, or show every row of it."""
    if output:
        result.write.parquet(output)
    else:
        rows = result.collect()  # what is to be read on a screen
        if rows:
            result.sparkSession.createDataFrame(rows, result.schema).show(len(rows), truncate=False)
        else:
            result.limit(0).show(truncate=False)
    return result


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> DataFrame | int | None:
    args = _parser().parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName(f"millrace-{args.job}").getOrCreate())
    if args.job in ("filter", "writer", "publish", "legacy"):
        _stream(spark, args)
        return None
    if args.job in FIGURES:
        return _put(_figures(spark, args), args.output)
    table = EditsTable(spark, args.table)
    if args.job in ("compact", "vacuum", "truncate", "drop"):
        done = table.compact(args.full) if args.job == "compact" else getattr(table, args.job)()
        if args.job == "compact" and args.vacuum:
            table.vacuum()
        print(done)
        return done
    if args.job == "find":
        return _put(_find(table, args), args.output)
    return _put(table.count() if args.job == "count" else key_check(table.current()), None)


if __name__ == "__main__":
    main()
