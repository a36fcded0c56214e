import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import plan
from millrace.operators import keyed
from millrace.schemas import EDIT_LOG, EDIT_ROW, SEQ
from replay import START, collected, log_rows, random_writes, replay

KEY = ("en.wikipedia.org", START, "u")


def at(n):
    return (START + dt.timedelta(seconds=n), 0, n)


def current(spark, *writes):
    return [r[3:] for r in collected(keyed.current_rows(log_rows(spark, writes)))]


def test_second_write_replaces_the_first(spark):
    assert current(spark, (KEY, "up", at(1), "old", None), (KEY, "up", at(2), "new", None)) == [("new", None)]
    assert current(spark, (KEY, "up", at(2), "new", None), (KEY, "up", at(1), "old", None)) == [("new", None)]


def test_null_leaves_a_cell_alone(spark):
    assert current(spark, (KEY, "up", at(1), "T", None), (KEY, "up", at(2), None, False)) == [("T", False)]


def test_write_without_cells_makes_a_row(spark):
    assert current(spark, (KEY, "up", at(1), None, None)) == [(None, None)]


def test_delete_and_write_again(spark):
    gone = ((KEY, "up", at(1), "T", True), (KEY, "del", at(2), None, None))
    assert current(spark, *gone) == []
    assert current(spark, *gone, (KEY, "up", at(3), "N", None)) == [("N", None)]
    assert current(spark, *gone, (KEY, "up", at(2), "N", None)) == []


def test_all_fields_come_back(spark):
    log = log_rows(spark, [(KEY, "del", at(1), None, None), (KEY, "up", at(2), "T", False)])
    assert collected(keyed.current_rows(log)) == [(*KEY, "T", False)]
    assert keyed.current_rows(log).schema == EDIT_ROW


def test_equal_place_is_still_determined(spark):
    writes = [(KEY, "up", at(1), t, None) for t in ("b", "c", "a")]
    assert current(spark, *writes) == current(spark, *reversed(writes)) == [("c", None)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_replay_in_any_order(spark, seed):
    writes = random_writes(4000, seed)
    expected = replay(writes)
    assert 20 < len(expected) < 200
    random.Random(seed).shuffle(writes)
    log = log_rows(spark, writes).repartition(5)
    assert collected(keyed.current_rows(log)) == expected
    assert collected(keyed.current_rows(log.unionByName(log.limit(500)))) == expected


def test_merge_in_parts(spark):
    """Merged parts merge to the same as the whole."""
    writes = random_writes(600, 3)
    states = [keyed.merge_states(keyed.to_states(log_rows(spark, part))) for part in (writes[:200], writes[200:500], writes[400:])]
    merged = keyed.merge_states(states[0].unionByName(states[1]).unionByName(states[2]))
    assert collected(keyed.live_rows(merged)) == replay(writes)


def test_latest_rows(spark):
    writes = [w for w in random_writes(800, 4) if w[1] == "up"]
    last = {w[0]: w for w in sorted(writes, key=lambda w: w[2])}
    expected = sorted(((*k, w[3], w[4]) for k, w in last.items()), key=str)
    assert collected(keyed.latest_rows(log_rows(spark, writes))) == expected


def test_truncate_by_time(spark):
    writes = random_writes(900, 5)
    cut = START + dt.timedelta(seconds=150)
    got = collected(keyed.current_rows(log_rows(spark, writes), cut))
    assert got == replay([w for w in writes if w[2][0] > cut])


def test_keys_below_a_millisecond_meet(spark):
    rows = [("d", START + dt.timedelta(microseconds=m), "u", f"t{m}", m) for m in (100, 900, 1000)]
    df = spark.createDataFrame(rows, "domain string, created_at timestamp, user_id string, page_title string, n int")
    seq = F.struct(F.lit(START).alias("timestamp"), F.lit(0).alias("partition"), F.col("n").cast("long").alias("offset")).cast(SEQ)
    log = keyed.log_check(keyed.upserts(df, seq, "w", 1))
    assert log.schema.names == EDIT_LOG.names
    assert {r[1].microsecond: r[3] for r in collected(keyed.current_rows(log))} == {0: "t900", 1000: "t1000"}


def test_lookups(spark):
    writes = random_writes(2000, 6)
    log, whole = log_rows(spark, writes), replay(writes)
    domain, created_at, user = whole[3][:3]
    assert collected(keyed.lookup_key(log, domain, created_at, user)) == [whole[3]]
    assert collected(keyed.lookup_key(log, domain, created_at.replace(tzinfo=None), user)) == [whole[3]]
    assert collected(keyed.lookup_user(log, user)) == [r for r in whole if r[2] == user]
    titled = [r for r in whole if r[3] == "t4"]
    assert titled
    for broadcast_rows in (10_000, 0):
        assert collected(keyed.lookup_title(log, "t4", broadcast_rows)) == titled
    assert keyed.lookup_title(log, "no such title").count() == 0


def test_overwritten_title_is_not_found(spark):
    log = log_rows(spark, [(KEY, "up", at(1), "old", None), (KEY, "up", at(2), "new", None)])
    assert keyed.lookup_title(log, "old").count() == 0
    assert keyed.lookup_title(log, "new").count() == 1


def test_order(spark):
    rows = keyed.current_rows(log_rows(spark, random_writes(1500, 7)))
    whole = collected(rows)
    newest_first = sorted((r for r in whole if r[0] == "a"), key=lambda r: (-r[1].timestamp(), r[2]))

    def listed(df):
        return [(r.domain, r.created_at.astimezone(dt.timezone.utc), r.user_id) for r in df.collect()]

    assert listed(keyed.domain_timeline(rows, "a")) == [r[:3] for r in newest_first]
    before = newest_first[4][1]
    assert listed(keyed.domain_timeline(rows, "a", before)) == [r[:3] for r in newest_first if r[1] < before]
    by_table = sorted(whole, key=lambda r: (r[0], -r[1].timestamp(), r[2]))
    assert listed(keyed.head(rows, 7)) == [r[:3] for r in by_table[:7]]
    assert keyed.count_rows(rows).first()[0] == len(whole)


def test_key_check(spark):
    rows = keyed.current_rows(log_rows(spark, random_writes(500, 8)))
    n = rows.count()
    assert tuple(keyed.key_check(rows).first()) == (n, n, 0, 0)
    twice = rows.unionByName(rows.limit(2)).unionByName(spark.createDataFrame([(None, "d", None, START, None)], EDIT_ROW))
    assert tuple(keyed.key_check(twice).first()) == (n + 3, n + 1, 2, 1)
    with pytest.raises(ValueError, match="user_is_bot"):
        keyed.key_check(rows.drop("user_is_bot"))
    with pytest.raises(ValueError, match="created_at: string instead of timestamp"):
        keyed.key_check(rows.withColumn("created_at", F.col("created_at").cast("string")))


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    p = plan(keyed.current_rows(log_rows(spark, [(KEY, "up", at(1), "T", None)])))
    assert p.count("Exchange hashpartitioning(created_at") == 1
    assert "partial_max" in p.split("Exchange")[1]
    assert "SinglePartition" not in p
