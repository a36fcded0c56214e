import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import event, plan, rows, topic
from millrace.operators import as_of, drift
from millrace.operators.as_of import VERSIONS, allowed_as_of
from millrace.plans.pipelines import filter_edits_as_of

UTC = dt.timezone.utc


def t(hour):
    return dt.datetime(2026, 5, 1, tzinfo=UTC) + dt.timedelta(hours=hour)


LIST = [
    ("a", t(1), t(3)), ("a", t(5), None), ("a", t(9), t(9)), ("a", t(10), t(12)), ("a", t(10), t(11)),
    ("b", t(0), None), ("c", None, None), (None, t(0), None), ("e", t(4), t(2)),
]


def valid(domain, at):
    begun = [v for v in LIST if v[0] == domain and domain is not None and v[1] is not None and at is not None and v[1] <= at]
    if not begun:
        return False
    last = max(v[1] for v in begun)
    return any(v[2] is None or v[2] > at for v in begun if v[1] == last)


EVENTS = [(k, d, None if h is None else t(h / 2)) for k, (d, h) in enumerate((d, h) for d in ("a", "b", "c", "e", "x", None) for h in (*range(26), None))]


@pytest.mark.parametrize("bound", [100, 0])
def test_version_of_the_time_decides(spark, bound):
    events = spark.createDataFrame(EVENTS, "k long, domain string, timestamp timestamp")
    found = allowed_as_of(events, spark.createDataFrame(LIST, VERSIONS), "domain", broadcast_rows=bound, salts=5)
    assert found.columns == events.columns
    assert rows(found, "k") == rows(spark.createDataFrame([(k,) for k, d, at in EVENTS if valid(d, at)], "k long"))
    empty = spark.createDataFrame([], VERSIONS)
    assert allowed_as_of(events, empty, "domain", broadcast_rows=bound).collect() == []
    assert allowed_as_of(events.limit(0), spark.createDataFrame(LIST, VERSIONS), "domain", broadcast_rows=bound).collect() == []


def test_a_hot_domain_is_split_and_no_row_is_multiplied(spark):
    """A long list: events of one domain go to as many tasks as there are salts, each with one row per event."""
    many = spark.range(2000).select(F.lit("a").alias("domain"), (F.lit(t(0)) + F.make_dt_interval(secs=F.col("id"))).alias("valid_from"))
    versions = many.withColumn("valid_to", F.lit(None).cast("timestamp"))
    events = spark.range(9000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "a").otherwise(F.concat(F.lit("x"), "id")).alias("domain"))
    events = events.withColumn("timestamp", F.lit(t(2)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = allowed_as_of(events, versions, "domain", broadcast_rows=10, salts=16)
        tasks = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
        text = plan(found)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(r["count"] for r in tasks) == 3000 and len(tasks) > 1 and max(r["count"] for r in tasks) < 3000
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_job_with_versions(spark):
    values = [event(domain="a", user=f"u{k}", bot=k == 2) for k in range(4)] + ["bad", event(domain="x")]
    records = topic(spark, values, partitions=1)
    since = dt.datetime(2026, 5, 1, 0, 0, 1, tzinfo=UTC)
    versions = spark.createDataFrame([("a", since, None)], VERSIONS)
    assert rows(filter_edits_as_of(records, versions), "user_id") == [("u1",), ("u3",)]


def test_fields_nobody_listed(spark):
    values = [event(extra={"deep": {"er": 1}}), event(extra=7), event(extra=[1, 2]), event(domain=None), "bad", "[]", None, "{}"]
    found = drift.field_counts(topic(spark, values))
    got = {(r.domain, r.field, r.type): r.n for r in found.collect()}
    en = "en.wikipedia.org"
    assert got[en, "extra", "OBJECT"] == got[en, "extra", "BIGINT"] == got[en, "extra", "ARRAY"] == 1
    assert got[en, "extra.deep", "OBJECT"] == got[en, "extra.deep.er", "BIGINT"] == 1
    assert got[en, "performer.user_is_bot", "BOOLEAN"] == 3 and got[None, "meta.domain", "VOID"] == 1
    schemas = {r.domain: (r.n_events, r.schema) for r in drift.merged_schemas(topic(spark, values)).collect()}
    assert schemas[en][0] == 3 and "extra: VARIANT" in schemas[en][1] and schemas[None][0] == 2
    assert drift.field_counts(topic(spark, [])).collect() == []
