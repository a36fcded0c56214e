import datetime as dt
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from helpers import plan
from millrace.operators import keyed
from millrace.sources.edits_table import Batch, EditsTable
from replay import START, collected, log_rows, random_writes, replay

KEY = ("en.wikipedia.org", START, "u")


@pytest.fixture
def table(spark, tmp_path):
    return EditsTable(spark, str(tmp_path / "edits"))


def test_write_and_read(spark, table):
    other = ("x", START, "v")
    table.write_batch(log_rows(spark, [(KEY, "up", (START, 0, 1), "T", None), (other, "up", (START, 0, 2), "T", None)]), "w", 0)
    assert collected(table.current().filter("user_id = 'u'")) == [(*KEY, "T", None)]


def test_empty_table(table):
    assert table.current().count() == 0 and table.generation() is None and table.committed() == set()


def test_a_batch_without_rows(spark, table):
    table.write_batch(log_rows(spark, []), "w", 0)
    assert table.current().count() == 0 and table.committed() == {Batch("w", 0)}
    table.write_batch(log_rows(spark, []), "w", 1, arrange=False)
    assert table.compact() == 0 and table.current().count() == 0
    writes = random_writes(20, 10)
    table.write_batch(log_rows(spark, writes), "w", 2)
    assert collected(table.current()) == replay(writes)
    table.compact()
    assert collected(table.current()) == replay(writes)


def test_days_are_utc_days(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            EditsTable(spark, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("arrange", [False, True])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_batches_of_several_writers(spark, table, arrange, adaptive):
    writes = random_writes(900, 11)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        for i, part in enumerate((writes[:300], writes[300:600], writes[600:])):
            table.write_batch(log_rows(spark, part), f"w{i % 2}", i, arrange)
        assert collected(table.current()) == replay(writes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert table.committed() == {Batch("w0", 0), Batch("w1", 1), Batch("w0", 2)}


def test_a_batch_written_twice_is_there_once(spark, table):
    writes = random_writes(200, 12)
    for _ in range(2):
        table.write_batch(log_rows(spark, writes), "w", 0)
    assert table.read_log().count() == len(writes)


def test_an_unfinished_batch_does_not_count(spark, table):
    writes = random_writes(400, 13)
    table.write_batch(log_rows(spark, writes[:200]), "w", 0)
    table.write_batch(log_rows(spark, writes[200:]), "w", 1)
    os.remove(f"{table.root}/log/writer=w/run=batch/batch_id=1/_SUCCESS")
    assert collected(table.current()) == replay(writes[:200])


def test_odd_domains(spark, table):
    odd = ["123", "1e3", "a/b=c", "2026-05-01", "x y", "ü%"]
    table.write_batch(log_rows(spark, [((d, START, "u"), "up", (START, 0, i), "t", None) for i, d in enumerate(odd)]), "w", 0)
    assert sorted(r.domain for r in table.current().collect()) == sorted(odd)
    table.compact()
    assert sorted(r.domain for r in table.current().collect()) == sorted(odd)


def test_batches_are_marked_on_any_cluster(spark, table):
    conf, name = spark._jsc.hadoopConfiguration(), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf.set(name, "false")
    try:
        table.write_batch(log_rows(spark, random_writes(20, 9)), "w", 0)
        assert table.compact() == 0 and table.generation() == 0
    finally:
        conf.unset(name)
    assert table.committed() == {Batch("w", 0)}


def test_a_batch_leaves_few_files(spark, table):
    table.write_batch(log_rows(spark, random_writes(500, 9)).repartition(8), "w", 0)
    parts = [f for _, _, names in os.walk(f"{table.root}/log") for f in names if f.endswith(".parquet")]
    assert len(parts) == 9  # three domains, three days


def test_writer_names(spark, table):
    with pytest.raises(ValueError):
        table.write_batch(log_rows(spark, random_writes(3, 1)), "a/b", 0)


def test_compaction_changes_nothing(spark, table):
    """Writes come late and out of order around compactions, deletes included."""
    writes = random_writes(1500, 14)
    random.Random(1).shuffle(writes)
    for i in range(5):
        table.write_batch(log_rows(spark, writes[i * 300 : (i + 1) * 300]), "w", i)
        if i in (0, 2, 3):
            assert table.compact() == {0: 0, 2: 1, 3: 2}[i]
        assert collected(table.current()) == replay(writes[: (i + 1) * 300])
    assert table.compact() == 3 and table.compact() == 3
    rest = writes[1500:]
    table.write_batch(log_rows(spark, rest), "w", 5)
    assert collected(table.current()) == replay(writes)
    assert table.count().first().n_rows == len(replay(writes))
    assert table.vacuum() == 5 and table.committed() == {Batch("w", 5)}
    assert collected(table.current()) == replay(writes)
    assert table.compact(full=True) == 4
    assert collected(table.current()) == replay(writes)
    assert table.vacuum() == 1 and os.listdir(f"{table.root}/base") == ["generation=4"]
    assert collected(table.current()) == replay(writes)


def test_compaction_rewrites_only_what_was_written_to(spark, table):
    table.write_batch(log_rows(spark, [((d, START, "u"), "up", (START, 0, 1), "t", None) for d in "abc"]), "w", 0)
    table.compact()
    table.write_batch(log_rows(spark, [(("b", START, "u"), "up", (START, 0, 2), "n", None)]), "w", 1)
    table.compact()
    assert sorted(x for x in os.listdir(f"{table.root}/base/generation=1") if "=" in x) == ["domain=b"]
    assert [(r[0], r[3]) for r in collected(table.current())] == [("a", "t"), ("b", "n"), ("c", "t")]


def scanned(df):
    """Rows that the scans of a table folder bring, by the plan that has run."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("Scan parquet") and "/base" in node.toString():
            found.append(node.metrics().apply("numOutputRows").value())
        children = [node.children().apply(i) for i in range(node.children().size())]
        if name == "AdaptiveSparkPlan":
            children.append(node.executedPlan())
        if "QueryStage" in name:
            children.append(node.plan())
        for child in children:
            walk(child)

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_compacted_directories_are_read_once_and_without_the_merge(spark, table):
    """Other generations and directories are not opened, quiet ones not shuffled."""
    def rows(day, first, title):
        at = START + dt.timedelta(days=day)
        return [(("a", at, f"u{i}"), "up", (at, 0, i), title, None) for i in range(first, first + 100)]

    table.write_batch(log_rows(spark, rows(0, 0, "x") + rows(1, 0, "x") + rows(2, 0, "x")), "w", 0)
    table.compact()
    assert scanned(table.current()) == 300
    table.write_batch(log_rows(spark, rows(1, 100, "y")), "w", 1)
    assert scanned(table.current()) == 300  # 200 as they are, 100 to be merged
    table.compact()
    assert scanned(table.current()) == 400  # not the 100 of day 1 in the older generation
    assert table.current().count() == 400
    assert scanned(table.with_title("y")) == 200  # that of day 1
    at = START + dt.timedelta(days=2)
    assert scanned(table.current(keyed.key_predicate("a", at, "u5"))) <= 100


def test_an_unfinished_compaction_does_not_count(spark, table):
    writes = random_writes(300, 16)
    table.write_batch(log_rows(spark, writes[:200]), "w", 0)
    table.compact()
    table.write_batch(log_rows(spark, writes[200:]), "w", 1)
    table.compact()
    os.remove(f"{table.root}/manifest/generation=1/_SUCCESS")
    assert table.generation() == 0
    assert collected(table.current()) == replay(writes)
    assert table.compact() == 1
    assert collected(table.current()) == replay(writes)


def test_truncate(spark, table):
    writes = random_writes(300, 17)
    table.write_batch(log_rows(spark, writes[:200]), "w", 0)
    assert table.truncate() == 0
    assert table.current().count() == 0
    table.write_batch(log_rows(spark, writes[200:]), "w", 1)
    assert collected(table.current()) == replay(writes[200:])
    table.compact()
    assert collected(table.current()) == replay(writes[200:])
    assert table.truncate() == 2 and table.current().count() == 0


def test_key_predicates_go_below_the_merge(spark, table):
    writes = random_writes(600, 18)
    table.write_batch(log_rows(spark, writes), "w", 0)
    table.compact()
    table.write_batch(log_rows(spark, writes[:50]), "w", 1)
    domain, created_at, user = replay(writes)[0][:3]
    got = table.current(keyed.key_predicate(domain, created_at, user))
    assert collected(got) == [replay(writes)[0]]
    scan = plan(keyed.lookup_key(table.read_log(), domain, created_at, user))
    pruned = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]", scan)
    assert "(domain#" in pruned[1] and "(d#" in pruned[1]
    assert f"EqualTo(user_id,{user})" in pruned[2] and "EqualTo(created_at," in pruned[2]


def test_cell_predicates_do_not_go_below_the_merge(spark, table):
    table.write_batch(log_rows(spark, [(KEY, "up", (START, 0, 1), "old", None), (KEY, "up", (START, 0, 2), "new", None)]), "w", 0)
    with pytest.raises(Exception, match="page_title"):
        table.current(F.col("page_title") == "old")
    assert table.current().filter(F.col("page_title") == "old").count() == 0


def test_titles_after_compaction(spark, table):
    writes = random_writes(1200, 19)
    random.Random(2).shuffle(writes)
    for i in range(3):
        table.write_batch(log_rows(spark, writes[i * 400 : (i + 1) * 400]), "w", i)
        if i != 2:
            table.compact()
        for title in ("t4", "t7", "none"):
            expected = [r for r in replay(writes[: (i + 1) * 400]) if r[3] == title]
            for broadcast_rows in (10_000, 0):
                assert collected(table.with_title(title, broadcast_rows)) == expected


def test_an_overwritten_title_is_not_found(spark, table):
    table.write_batch(log_rows(spark, [(KEY, "up", (START, 0, 1), "old", None)]), "w", 0)
    table.compact()
    assert table.with_title("old").count() == 1
    table.write_batch(log_rows(spark, [(KEY, "up", (START, 0, 2), "new", None)]), "w", 1)
    assert table.with_title("old").count() == 0
    assert table.with_title("new").count() == 1


def test_batches_of_other_runs_and_absorbed_ones_are_not_replaced(spark, table):
    first, second = random_writes(60, 20), random_writes(60, 21)
    table.write_batch(log_rows(spark, first), "w", 0, run="a")
    table.write_batch(log_rows(spark, second), "w", 0, run="b")
    assert collected(table.current()) == replay(first + second)
    table.compact()
    with pytest.raises(ValueError, match="already"):
        table.write_batch(log_rows(spark, second), "w", 0, run="a")
    assert collected(table.current()) == replay(first + second)
    assert table.vacuum() == 2 and collected(table.current()) == replay(first + second)


@pytest.mark.parametrize(
    "key",
    [("", START, "u"), (None, START, "u"), ("a", START, None), ("a", None, "u"), ("a", "12345-01-01", "u"), ("a", "0000-01-01", "u")],
)
def test_keys_that_are_none_are_refused(spark, table, key):
    table.write_batch(log_rows(spark, random_writes(30, 22)), "w", 0)
    domain, at, user = key
    rows = log_rows(spark, [(KEY, "up", (START, 0, 1), "T", None)])
    if at != START:
        rows = rows.withColumn("created_at", F.lit(at).cast("timestamp")).withColumn("d", F.to_date("created_at"))
    rows = rows.withColumn("domain", F.lit(domain)).withColumn("user_id", F.lit(user))
    for batch_id, op in ((1, "up"), (2, "del")):
        with pytest.raises(Exception, match="a key needs"):
            table.write_batch(rows.withColumn("op", F.lit(op)), "w", batch_id)
    table.compact()
    table.write_batch(log_rows(spark, random_writes(30, 23)), "w", 3)
    table.compact()
    assert collected(table.current()) == replay(random_writes(30, 22) + random_writes(30, 23))


def test_times_at_the_ends_of_the_years_are_kept(spark, table):
    keys = [("a", dt.datetime(year, 1, 1, tzinfo=dt.timezone.utc), "u") for year in (1, 9999)]
    rows = log_rows(spark, [(k, "up", (START, 0, i), "T", None) for i, k in enumerate(keys)])
    table.write_batch(rows, "w", 0)
    table.compact()
    table.write_batch(rows, "w", 1)
    table.compact()
    assert table.current().count() == table.count().first().n_rows == 2
    assert sorted(x.name[1] for x in table.manifest()) == ["0001-01-01", "9999-01-01"]


def jobs_of(spark, build):
    """Spark jobs that run while a result is built, before anyone asks for its rows."""
    spark.sparkContext.setJobGroup("counted", "")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_reads_of_a_compacted_table_start_no_job_over_data(spark, table):
    writes = random_writes(300, 24)
    table.write_batch(log_rows(spark, writes[:200]), "w", 0)
    table.compact()
    table.write_batch(log_rows(spark, writes[200:]), "w", 1)
    assert jobs_of(spark, table.current) <= 2  # the manifest's names, the absorbed batches' names
    assert jobs_of(spark, lambda: table.with_title("t4")) <= 7  # and one search, of several stages


def test_counts_and_layout(spark, table):
    writes = random_writes(900, 25)
    table.write_batch(log_rows(spark, writes[:600]), "w", 0)
    table.compact()
    stored = {(x.name, x.n_rows) for x in table.manifest()}
    got = table.layout().collect()
    assert {((r.domain, str(r.d)), r.n_rows) for r in got} == stored and not any(r.n_unordered for r in got)
    assert sum(n for _, n in stored) == len(replay(writes[:600])) == table.count().first().n_rows
    assert all(x.n_states >= x.n_rows and x.n_files and x.n_bytes for x in table.manifest())
    table.write_batch(log_rows(spark, writes[600:]), "w", 1)
    assert table.count().first().n_rows == len(replay(writes))
    table.drop()
    assert table.current().count() == table.count().first().n_rows == 0 and table.generation() is None
    table.write_batch(log_rows(spark, writes), "w", 0)
    assert collected(table.current()) == replay(writes)


def test_rows_out_of_order_are_seen(spark, table):
    table.write_batch(log_rows(spark, random_writes(300, 26)), "w", 0)
    table.compact()
    held = max(table.manifest(), key=lambda x: x.n_states)
    folder = f"{table.root}/base/generation=0/{held.directory}"
    rows = spark.read.parquet(folder).coalesce(1).sortWithinPartitions("created_at").collect()
    schema = spark.read.parquet(folder).schema
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(folder)
    assert sum(r.n_unordered for r in table.layout().collect()) > 0


def test_days_after_the_instant_are_not_read(spark, table):
    rows = []
    for day in range(4):
        at = START + dt.timedelta(days=day)
        rows += [(("a", at, f"u{i}"), "up", (at, 0, i), "t", None) for i in range(50)]
    table.write_batch(log_rows(spark, rows), "w", 0)
    table.compact()
    before = START + dt.timedelta(days=1)
    page = keyed.domain_timeline(table.current(keyed.older_than("a", before)), "a", before)
    assert page.count() == 50 and scanned(table.current(keyed.older_than("a", before))) <= 100


def test_titles_of_more_keys_than_may_be_broadcast(spark, table):
    table.write_batch(log_rows(spark, [((f"d{i % 7}", START, f"u{i}"), "up", (START, 0, i), "T", None) for i in range(300)]), "w", 0)
    table.compact()
    found = table.with_title("T", broadcast_rows=10)
    assert found.count() == 300 and "LocalTableScan" not in plan(found)
