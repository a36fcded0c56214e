"""Row filters on decoded events. NULL never passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.schemas import ALLOWED_DOMAINS
from millrace.session import BROADCAST_ROWS, fits_broadcast

# Copies of each allow-list row when the list is too long to broadcast.
ALLOW_LIST_SALTS = 64


def allowed_domain(allowed: Sequence[str] = ALLOWED_DOMAINS, column: str = "meta.domain") -> Column:
    return F.col(column).isin(list(allowed))


def human(column: str = "performer.user_is_bot") -> Column:
    """Only an explicit `false`. A missing, null or mistyped flag is not human."""
    return F.col(column) == F.lit(False)


def filter_domain(
    df: DataFrame,
    allowed: Sequence[str] | DataFrame = ALLOWED_DOMAINS,
    column: str = "meta.domain",
    broadcast_rows: int = BROADCAST_ROWS,
    spread: Column | None = None,
    salts: int = ALLOW_LIST_SALTS,
) -> DataFrame:
    """Keep events of the allowed domains: a short list, or a one-column DataFrame of any length.

    `spread` is a number that differs from row to row, for a list too long to broadcast; by default
    a hash of the whole row. Where many rows may be equal give one of their coordinates. `salts` is the
    number of tasks that one domain's rows are then dealt to.
    """
    if not isinstance(allowed, DataFrame):
        return df.filter(allowed_domain(allowed, column))

    names = allowed.select(F.col(allowed.columns[0]).alias("_allowed")).distinct()
    if fits_broadcast(names, broadcast_rows):
        return df.join(F.broadcast(names), F.col(column) == F.col("_allowed"), "left_semi")

    # A domain may hold a third of all events, so its rows are dealt to several tasks. The salt
    # comes from the row itself, so that a task that is run again computes the same one.
    salted = names.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = F.xxhash64(*df.columns) if spread is None else spread
    row_salt = F.pmod(spread, F.lit(salts)).cast("int")
    return df.join(salted, (F.col(column) == F.col("_allowed")) & (row_salt == F.col("_salt")), "left_semi")


def filter_human(df: DataFrame, column: str = "performer.user_is_bot") -> DataFrame:
    return df.filter(human(column))


def with_id(decoded: DataFrame, event_id: str) -> DataFrame:
    """Raw events with the given `meta.id`."""
    return decoded.filter(F.col("meta.id") == F.lit(event_id))
