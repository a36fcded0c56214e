import datetime as dt
import re

from pyspark.sql import functions as F

from helpers import plan, texts
from millrace.schemas import EDIT_ROW
from millrace.sources import partitioned, title_index

UTC = dt.timezone.utc


def table(spark, n=400):
    rows = [
        (f"u{k % 37}", f"d{k % 5}", None if k % 11 == 0 else f"t{k % 23}", dt.datetime(2026, 5, 1 + k % 9, tzinfo=UTC), k % 2 == 0) for k in range(n)
    ]
    return spark.createDataFrame(rows, EDIT_ROW).dropDuplicates(["domain", "created_at", "user_id"])


def test_title_index_joins_without_a_shuffle(spark, tmp_path):
    rows = table(spark)
    title_index.write_indexed(rows, "t_indexed", str(tmp_path), 4)
    titles = spark.createDataFrame([("t1",), ("t7",), ("none",), (None,), ("t1",)], "title string")
    found = title_index.with_titles(spark, "t_indexed", titles)
    assert texts(found) == texts(rows.filter(F.col("page_title").isin("t1", "t7")))
    text = plan(found)
    assert "SortMergeJoin" in text and "Bucketed: true" in text
    below = text[text.index("SortMergeJoin") :]
    assert "Exchange hashpartitioning(domain" not in below and "Exchange hashpartitioning(created_at" not in below
    title_index.write_indexed(rows.limit(0), "t_indexed", str(tmp_path), 4)  # written anew
    assert title_index.with_titles(spark, "t_indexed", titles).collect() == []


def test_titles_reach_the_scan_of_the_index(spark, tmp_path):
    title_index.write_indexed(table(spark), "t_pushed", str(tmp_path), 4)
    one = spark.table("t_pushed_titles").filter("page_title = 't3'")
    assert "EqualTo(page_title,t3)" in plan(one)


def test_many_keys_read_their_directories_only(spark, tmp_path):
    rows = table(spark)
    path = str(tmp_path / "rows")
    partitioned.write_partitioned(rows, path)
    wanted = [("d1", dt.datetime(2026, 5, 2, tzinfo=UTC), f"u{k}") for k in range(37)] + [("d2", dt.datetime(2027, 1, 1, tzinfo=UTC), "u1"), (None, None, None)]
    keys = spark.createDataFrame(wanted, "domain string, created_at timestamp, user_id string")
    found = partitioned.rows_of_keys(spark.read.parquet(path), keys)
    want = rows.filter((F.col("domain") == "d1") & (F.dayofmonth("created_at") == 2))
    assert want.count() > 0 and texts(found) == texts(want)
    assert "dynamicpruning" in plan(found).lower()
    listed = found.select(F.input_file_name().alias("f")).distinct().collect()
    assert {re.search(r"domain=(\w+)/d=([\d-]+)", r.f).groups() for r in listed} == {("d1", "2026-05-02")}
    found.collect()
    node = _scan(found._jdf.queryExecution().executedPlan())
    whole = len(spark.read.parquet(path).inputFiles())
    assert 0 < node.metrics().apply("numFiles").value() < whole / 5
    beyond = partitioned.rows_of_keys(spark.read.parquet(path), keys, broadcast_rows=3)
    assert texts(beyond) == texts(want)


def _scan(physical):
    """The scan of the rows, in the plan that ran."""
    if physical.nodeName().startswith("AdaptiveSparkPlan"):
        return _scan(physical.executedPlan())
    if physical.nodeName().endswith("QueryStage"):
        return _scan(physical.plan())
    if physical.nodeName().startswith("Scan parquet") or physical.nodeName().startswith("FileScan"):
        return physical
    for child in [physical.children().apply(k) for k in range(physical.children().size())]:
        if (found := _scan(child)) is not None:
            return found
    return None


def test_variant_paths_reach_the_scan(spark, tmp_path):
    from helpers import event, topic
    from millrace.sources import raw_variant

    path = str(tmp_path / "v")
    values = [event(user=f"u{k}", domain="ab"[k % 2], extra={"n": k}) for k in range(200)] + ["bad", "[]", None, event(bot="perhaps")]
    raw_variant.land(topic(spark, values), path)
    read = raw_variant.read(spark, path)
    found = read.filter(raw_variant.field("meta.domain") == "a").select(raw_variant.field("extra.n", "int").alias("n"))
    assert sorted(r.n for r in found.collect()) == list(range(0, 200, 2))
    text = plan(found)
    assert "ReadSchema: struct<event:struct<" in text and "EqualTo(event.`" in text and "performer" not in text
    assert sorted((r.raw or "") for r in read.filter("event is null").collect()) == ["", "[]", "bad"]
    assert read.filter(raw_variant.field("performer.user_is_bot", "boolean").isNull() & F.col("event").isNotNull()).count() == 1
    day = read.filter("d = date'2026-05-02'")
    assert "PartitionFilters: [isnotnull(d" in plan(day)


def test_zorder_skips_row_groups_for_either_column(spark, tmp_path):
    """Row groups that the statistics leave for a lookup, by user and by day, against the order of either column."""
    import glob

    import pyarrow.parquet as pq

    from millrace.sources import zorder

    rows = spark.range(60_000).select(
        F.format_string("user_%05d", F.pmod(F.xxhash64("id"), F.lit(2000))).alias("user_id"),
        F.timestamp_seconds(F.lit(1_780_000_000) + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(90)) * 86400).alias("created_at"),
        F.col("id").alias("k"),
    ).cache()
    files = 64

    def left(path):
        """Share of row groups that may hold one user, and one day."""
        user = day = total = 0
        when = spark.range(1).select(F.timestamp_seconds(F.lit(1_780_000_000 + 40 * 86400))).first()[0].astimezone(dt.timezone.utc)
        for file in glob.glob(f"{path}/*.parquet"):
            meta = pq.ParquetFile(file).metadata
            for g in range(meta.num_row_groups):
                a, b = (meta.row_group(g).column(c).statistics for c in (0, 1))
                user += a.min <= "user_00777" <= a.max
                day += b.min.replace(tzinfo=dt.timezone.utc) <= when <= b.max.replace(tzinfo=dt.timezone.utc)
                total += 1
        return user / total, day / total

    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    try:
        z, by_user, by_day = (str(tmp_path / n) for n in ("z", "u", "d"))
        zorder.write_zordered(rows, z, files)
        rows.repartitionByRange(files, "user_id").sortWithinPartitions("user_id").write.parquet(by_user)
        rows.repartitionByRange(files, "created_at").sortWithinPartitions("created_at").write.parquet(by_day)
    finally:
        spark.conf.unset("spark.sql.parquet.outputTimestampType")
    found = left(z)
    assert max(found) <= 0.3  # an eighth in theory
    assert left(by_user)[1] > 0.9 and left(by_day)[0] > 0.9  # where the plain orders skip nothing
    assert texts(spark.read.parquet(z)) == texts(rows)


def test_interleaved_bits(spark):
    from millrace.sources import zorder

    df = spark.range(64).select((F.col("id") % 8).alias("a"), F.floor(F.col("id") / 8).alias("b"))
    got = {(r.a, r.b): r.z for r in df.select("a", "b", zorder.interleaved(F.col("a"), F.col("b"), 3).alias("z")).collect()}
    assert got == {(a, b): sum((a >> k & 1) << (2 * k + 1) | (b >> k & 1) << (2 * k) for k in range(3)) for a in range(8) for b in range(8)}
