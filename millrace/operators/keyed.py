"""The keyed edits table as data: write log -> state per key -> current rows.

A key's state is the latest of everything that happened to it: its last upsert, its last delete and,
for every cell, its last non-null value together with the write that set it. States of one key merge
by taking the later of each part. That merge is associative, commutative and idempotent, so input
order, replayed batches and compaction don't change what the table holds.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import CELLS, DELETE, EDIT_LOG, EDIT_ROW, KEY, KEY_STATE, SEQ, UPSERT, require
from millrace.session import BROADCAST_ROWS

# The key as the merge groups by it. Rows are sorted on it, by the first column's leading bytes for
# as long as these differ, so the column with the most values comes first.
_GROUPING = ("created_at", "user_id", "domain")
_STATE_PARTS = [name for name in KEY_STATE.names if name not in KEY]


# --- writes -------------------------------------------------------------------------------


def upserts(rows: DataFrame, seq: Column, writer: str | None = None, batch_id: int | None = None) -> DataFrame:
    """Log rows that set the non-null cells of `rows`; a cell column may be absent."""
    return _log_rows(rows, UPSERT, seq, writer, batch_id)


def deletes(keys: DataFrame, seq: Column, writer: str | None = None, batch_id: int | None = None) -> DataFrame:
    """Log rows that delete whole keys."""
    return _log_rows(keys.drop(*CELLS), DELETE, seq, writer, batch_id)


def _log_rows(rows: DataFrame, op: str, seq: Column, writer: str | None, batch_id: int | None) -> DataFrame:
    cells = [
        (F.col(name) if name in rows.columns else F.lit(None)).cast(EDIT_ROW[name].dataType).alias(name)
        for name in CELLS
    ]
    created_at = F.date_trunc("millisecond", F.col("created_at"))
    return rows.select(
        created_at.alias("created_at"),
        F.col("user_id"),
        *cells,
        F.lit(op).alias("op"),
        seq.cast(SEQ).alias("seq"),
        F.lit(writer).cast("string").alias("writer"),
        F.lit(None).cast("string").alias("run"),
        F.lit(batch_id).cast("bigint").alias("batch_id"),
        F.col("domain"),
        F.to_date(created_at).alias("d"),
    )


# --- states -------------------------------------------------------------------------------


def to_states(log: DataFrame) -> DataFrame:
    """Each log row as the state it alone would leave. Row by row, no shuffle."""
    up = F.col("op") == UPSERT

    def cell(name: str) -> Column:
        return F.when(up & F.col(name).isNotNull(), F.struct(F.col("seq"), F.col(name).alias("value"))).alias(name)

    return log.select(
        *KEY,
        F.when(up, F.col("seq")).alias("up_seq"),
        F.when(F.col("op") == DELETE, F.col("seq")).alias("del_seq"),
        *[cell(name) for name in CELLS],
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state per key.

    A plain aggregation: each task first reduces what it holds of a key to one row, so a key with a
    third of all writes sends one row per task through the shuffle. The shuffle is on the whole key.
    Among cells of equal `seq` the greater value wins, which keeps the result determined.
    """
    merged = states.groupBy(*_GROUPING).agg(*[F.max(part).alias(part) for part in _STATE_PARTS])
    return merged.select(*KEY_STATE.names)


def after_delete(seq: str) -> Column:
    """Was a state's part set after its key's last delete?"""
    return F.col(seq).isNotNull() & (F.col("del_seq").isNull() | (F.col(seq) > F.col("del_seq")))


def live_rows(states: DataFrame) -> DataFrame:
    """Merged states -> table rows. A delete also beats a write of the very same `seq`."""
    cells = {name: F.when(after_delete(f"{name}.seq"), F.col(f"{name}.value")) for name in CELLS}
    return states.filter(after_delete("up_seq")).select(
        "user_id", "domain", cells["page_title"].alias("page_title"), "created_at", cells["user_is_bot"].alias("user_is_bot")
    )


def written_until(log: DataFrame, instant: dt.datetime | None) -> DataFrame:
    """Forget writes up to and including `instant` (a truncate). A plain filter, pushed to the scan."""
    return log if instant is None else log.filter(F.col("seq.timestamp") > F.lit(as_utc(instant)))


def current_rows(log: DataFrame, truncated_at: dt.datetime | None = None) -> DataFrame:
    """The table a log amounts to: last write wins per cell, nulls leave a cell alone, deletes count."""
    return live_rows(merge_states(to_states(written_until(log, truncated_at))))


def latest_rows(log: DataFrame) -> DataFrame:
    """Last whole row per key, for logs of complete upserts only: less state than `current_rows`."""
    newest = F.max(F.struct("seq", *CELLS)).alias("_row")
    return log.groupBy(*_GROUPING).agg(newest).select(
        "user_id", "domain", "_row.page_title", "created_at", "_row.user_is_bot"
    )


# --- reads --------------------------------------------------------------------------------


def as_utc(instant: dt.datetime) -> dt.datetime:
    """An instant in UTC; one without a zone is taken to be in UTC, not in the driver's zone."""
    return instant.astimezone(dt.timezone.utc) if instant.tzinfo else instant.replace(tzinfo=dt.timezone.utc)


def key_predicate(
    domain: str | None = None, created_at: dt.datetime | None = None, user_id: str | None = None
) -> Column:
    """Equality on the given key columns, with the day that follows from `created_at`.

    Holds or fails for all writes of a key alike, so it goes below the merge, where `domain` and
    `d` prune directories and `user_id` reaches the file scan.
    """
    where = F.lit(True)
    if domain is not None:
        where = where & (F.col("domain") == domain)
    if created_at is not None:
        # the table knows no time finer than a millisecond
        whole = as_utc(created_at.replace(microsecond=created_at.microsecond // 1000 * 1000))
        where = where & (F.col("created_at") == F.lit(whole)) & (F.col("d") == F.lit(whole.date()))
    if user_id is not None:
        where = where & (F.col("user_id") == user_id)
    return where


def lookup_key(log: DataFrame, domain: str, created_at: dt.datetime, user_id: str) -> DataFrame:
    return current_rows(log.filter(key_predicate(domain, created_at, user_id)))


def lookup_user(log: DataFrame, user_id: str) -> DataFrame:
    return current_rows(log.filter(key_predicate(user_id=user_id)))


def set_title(page_title: str) -> Column:
    """Log rows that write the given title."""
    return (F.col("page_title") == page_title) & (F.col("op") == UPSERT)


def lookup_title(log: DataFrame, page_title: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose current title is the given one.

    The title is a cell: a log row with it may since be overwritten, so the condition holds only
    after the merge. Only keys that ever had the title can qualify, and just their writes are merged:
    by a broadcast if the keys are few, else by a join on the whole key, which no domain or day makes uneven.
    """
    key = [*KEY, "d"]  # the day as well, to prune directories
    had_it = log.filter(set_title(page_title)).select(*key).distinct()
    found = had_it.limit(broadcast_rows + 1).toArrow()  # one search: what was found is what gets broadcast
    if found.num_rows <= broadcast_rows:
        had_it = F.broadcast(log.sparkSession.createDataFrame(found))
    return current_rows(log.join(had_it, key, "left_semi")).filter(F.col("page_title") == page_title)


def newest_first() -> list[Column]:
    return [F.desc("created_at"), F.asc("user_id")]


def domain_timeline(rows: DataFrame, domain: str, before: dt.datetime | None = None) -> DataFrame:
    """Rows of one domain, newest first, optionally only those older than an instant (paging).

    The sort is a range partitioning on (created_at, user_id), unique within a domain. Of a stored table
    take `EditsTable.current(older_than(domain, before))`: that reads no day after `before`.
    """
    rows = rows.filter(F.col("domain") == domain)
    if before is not None:
        rows = rows.filter(F.col("created_at") < F.lit(as_utc(before)))
    return rows.orderBy(*newest_first())


def older_than(domain: str, before: dt.datetime | None = None) -> Column:
    """A domain's keys before an instant, with the days that follow from it, to go below the merge."""
    where = F.col("domain") == domain
    if before is not None:
        at = as_utc(before)
        where = where & (F.col("created_at") < F.lit(at)) & (F.col("d") <= F.lit(at.date()))
    return where


def head(rows: DataFrame, n: int = 10) -> DataFrame:
    """The first `n` rows in table order. Each task keeps its own first `n`; nothing is sorted whole."""
    return rows.orderBy("domain", *newest_first()).limit(n)


def count_rows(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("n_rows"))


def layout(rows: DataFrame) -> DataFrame:
    """Rows per directory of the table."""
    return rows.groupBy("domain", F.to_date("created_at").alias("d")).agg(F.count(F.lit(1)).alias("n_rows"))


def key_check(rows: DataFrame) -> DataFrame:
    """One row: how many rows and keys there are, and how many keys occur more than once or hold a
    NULL. Raises if the columns are not the declared ones."""
    require(rows, EDIT_ROW, "edits table")
    per_key = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    null_key = F.col("domain").isNull() | F.col("created_at").isNull() | F.col("user_id").isNull()
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_repeated_keys"),
        F.count_if(null_key).alias("n_null_keys"),
    )


def log_check(log: DataFrame) -> DataFrame:
    return require(log, EDIT_LOG, "edit log")
