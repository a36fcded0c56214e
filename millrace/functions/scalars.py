"""Scalar expressions on event text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_instant(value: Column) -> Column:
    """Event time text as a timestamp of millisecond precision, NULL where it is none.

    Text must at least hold a year, month and day: without that guard `12:30:00` would become a
    time of the day the query runs. Years are 1 to 9999, also in UTC, which other readers of the table
    can hold as well. Never fails on bad text. Cut to milliseconds because the value is part of the
    table key, and the table knows no finer time.
    """
    dated = value.rlike(r"^\s*[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}")
    instant = F.date_trunc("millisecond", F.when(dated, value.try_cast("timestamp")))
    return F.when(in_range(instant), instant)


def in_range(instant: Column) -> Column:
    """Is the instant within the years 1 to 9999? False for NULL."""
    return F.coalesce(F.year(instant).between(1, 9999), F.lit(False))


def canonical_uuid(value: Column) -> Column:
    """A UUID in its lower-case dashed form, NULL where the text is none.

    Takes plain, dashed, braced and `urn:uuid:` notations; dashes may stand anywhere.
    """
    bare = F.replace(F.replace(value, F.lit("urn:"), F.lit("")), F.lit("uuid:"), F.lit(""))
    digits = F.replace(F.regexp_replace(bare, r"^[{}]+|[{}]+$", ""), F.lit("-"), F.lit(""))
    dashed = F.regexp_replace(F.lower(digits), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return F.when(digits.rlike("^[0-9A-Fa-f]{32}$"), dashed)
