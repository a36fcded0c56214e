"""An allow-list that changes: events are held against the version of the list that was valid at their time.

A list has rows `domain, valid_from, valid_to`. Of a domain's versions the one with the latest `valid_from` at or before an
event's time decides: the event passes if that version has no `valid_to` or one after the event's time. Events before a
domain's first version, and domains without one, do not pass. Of versions with one `valid_from` the one valid
longest decides; a null `valid_from` is no version, and null domains and times never pass.

A domain's versions become one sorted array, so that the join is on the domain alone and brings an event one row, whatever
the number of versions; a range join would bring one for every version before it. The arrays are as large as the list, which is
broadcast when its measured size allows. Beyond that, copies of each domain's array are dealt over `salts` tasks, since one
domain may have a third of all events. An array lies in one row: a domain's versions, not its events, have to fit in memory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.filters import ALLOW_LIST_SALTS
from millrace.session import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast

VERSIONS = "domain STRING, valid_from TIMESTAMP, valid_to TIMESTAMP"
_LIST = "_versions"


def version_arrays(versions: DataFrame) -> DataFrame:
    """One row per domain: its versions by `valid_from`, an open end as the latest one."""
    known = versions.filter(F.col("domain").isNotNull() & F.col("valid_from").isNotNull())
    end = F.coalesce(F.unix_micros("valid_to"), F.lit((1 << 63) - 1))
    longest = known.groupBy("domain", F.unix_micros("valid_from").alias("since")).agg(F.max(end).alias("until"))
    every = F.sort_array(F.collect_list(F.struct("since", "until"))).alias(_LIST)
    return longest.groupBy(F.col("domain").alias("_listed")).agg(every)


def _valid(at: Column) -> Column:
    """Is an event's time within the last version that begins at or before it?"""
    micros = F.unix_micros(at)
    begun = F.filter(_LIST, lambda v: v["since"] <= micros)
    return F.coalesce(F.try_element_at(begun, F.lit(-1))["until"] > micros, F.lit(False))


def allowed_as_of(
    events: DataFrame,
    versions: DataFrame,
    domain: str = "meta.domain",
    at: str = "timestamp",
    spread: Column | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int = ALLOW_LIST_SALTS,
) -> DataFrame:
    """Events whose domain is on the list as of their time. `spread` is a number that differs from row to row."""
    names = events.columns
    lists = version_arrays(versions)
    if fits_broadcast(versions.select("domain", "valid_from", "valid_to"), broadcast_rows, BROADCAST_BYTES):
        found = events.join(F.broadcast(lists), F.col(domain) == F.col("_listed"))
    else:
        salted = lists.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        dealt = F.pmod(F.xxhash64(*names) if spread is None else spread, F.lit(salts)).cast("int")
        found = events.join(salted, (F.col(domain) == F.col("_listed")) & (dealt == F.col("_salt")))
    return found.filter(_valid(F.col(at))).select(*names)
