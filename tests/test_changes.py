import datetime as dt
import random

from pyspark.sql import functions as F

from helpers import texts
from millrace.operators import keyed
from millrace.schemas import EDIT_LOG
from millrace.streaming import changes, runners

UTC = dt.timezone.utc
DAY = dt.datetime(2026, 5, 1, tzinfo=UTC)


def write(user, second, op="up", title=None, bot=None, domain="d", offset=0):
    seq = (DAY + dt.timedelta(seconds=second), 0, offset)
    return (DAY, user, title, bot, op, seq, None, None, None, domain, DAY.date())


def run_parts(spark, tmp_path, parts):
    log, out = str(tmp_path / "log"), str(tmp_path / "changes")
    for part in parts:
        spark.createDataFrame(part, EDIT_LOG).write.mode("append").parquet(log)
        stream = changes.changes_stream(spark.readStream.schema(EDIT_LOG).parquet(log), out)
        runners.start(stream, "changes", str(tmp_path / "checkpoints"), until_caught_up=True).awaitTermination()
    return changes.read_changes(spark, out)


def told(found, user):
    rows = found.filter(F.col("user_id") == user).orderBy("version").collect()
    return [(r.version, r.change, r.page_title, r.user_is_bot) for r in rows]


def test_rows_and_retractions(spark, tmp_path):
    found = run_parts(
        spark,
        tmp_path,
        [
            [write("a", 1, title="one"), write("b", 5, "del"), write("c", 1, title="x", bot=True), write("e", 3)],
            [write("a", 1, title="one"), write("b", 4, title="old"), write("c", 2, title=None, bot=False)],  # a replay; an older write
            [write("a", 3, "del"), write("b", 6, title="new"), write("c", 0, title="older"), write("e", 3, "del")],
            [write("a", 4, bot=True), write("a", 2, title="too old"), write("b", 6, "del"), write("c", 2, "del")],
        ],
    )
    assert told(found, "a") == [(1, "row", "one", None), (2, "gone", None, None), (3, "row", None, True)]
    assert told(found, "b") == [(1, "row", "new", None), (2, "gone", None, None)]
    assert told(found, "c") == [(1, "row", "x", True), (2, "row", "x", False), (3, "gone", None, None)]
    assert told(found, "e") == [(1, "row", None, None), (2, "gone", None, None)]
    rows = changes.replayed(found).collect()
    assert [(r.user_id, r.page_title, r.user_is_bot) for r in rows] == [("a", None, True)]


def test_any_order_gives_the_table(spark, tmp_path):
    """Writes of few keys in any order, in parts that overlap; equal places among them."""
    rng = random.Random(4)
    log = []
    for n in range(400):
        kind = rng.choice(["up", "up", "up", "del"])
        cells = {"title": rng.choice([None, "t1", "t2", "t3"]), "bot": rng.choice([None, True, False])} if kind == "up" else {}
        log.append(write(f"u{rng.randrange(12)}", rng.randrange(60), kind, domain=rng.choice("de"), offset=rng.randrange(2), **cells))
    rng.shuffle(log)
    found = run_parts(spark, tmp_path, [log[:150], log[100:300], log[250:], log])
    want = keyed.current_rows(spark.createDataFrame(log, EDIT_LOG))
    assert texts(changes.replayed(found)) == texts(want)
    per_key = found.groupBy("domain", "created_at", "user_id").agg(F.count("*").alias("n"), F.max("version").alias("last"))
    assert per_key.filter("n != last").count() == 0  # numbered without gaps


def test_nothing_yet(spark, tmp_path):
    assert changes.replayed(changes.read_changes(spark, str(tmp_path / "none"))).collect() == []


def test_state_by_group(spark, tmp_path):
    """Many keys, some null in part, take few states and calls; they are told as one by one."""
    log = [write(f"u{k % 1500}", k % 7, "del" if k % 11 == 0 else "up", title=f"t{k % 5}", bot=k % 3 == 0) for k in range(3000)]
    log += [write(None, 2, title="n"), write(None, 3, bot=True), write("x", 1, title="m", domain=None)]
    place, out, checkpoint = (str(tmp_path / name) for name in ("log", "changes", "checkpoints"))
    spark.createDataFrame(log, EDIT_LOG).write.parquet(place)
    stream = changes.changes_stream(spark.readStream.schema(EDIT_LOG).parquet(place), out, groups=16)
    query = runners.start(stream, "changes", checkpoint, until_caught_up=True)
    query.awaitTermination()
    assert 0 < query.lastProgress.stateOperators[0].numRowsTotal <= 16
    found = changes.replayed(changes.read_changes(spark, out))
    assert texts(found) == texts(keyed.current_rows(spark.createDataFrame(log, EDIT_LOG)))
    assert found.filter("user_id IS NULL AND page_title = 'n' AND user_is_bot").count() == 1
