"""Raw event -> edit, edit -> typed row, and why a record goes no further."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.decode import decode_processed, decode_raw, is_json_object, text
from millrace.functions.scalars import parse_instant
from millrace.operators.filters import allowed_domain, human
from millrace.schemas import ALLOWED_DOMAINS, PROCESSED_EVENT, RAW_EVENT, REJECT

PASSED = "passed"
# reasons
BAD_JSON = "bad_json"
INCOMPLETE = "incomplete"
BAD_TIMESTAMP = "bad_timestamp"
EMPTY_DOMAIN = "empty_domain"
# not rejected, only filtered out
OTHER_DOMAIN = "other_domain"
NOT_HUMAN = "not_human"

RAW_OUTCOMES = (BAD_JSON, OTHER_DOMAIN, NOT_HUMAN, PASSED)
PROCESSED_OUTCOMES = (BAD_JSON, INCOMPLETE, BAD_TIMESTAMP, EMPTY_DOMAIN, PASSED)
REASONS = (BAD_JSON, INCOMPLETE, BAD_TIMESTAMP, EMPTY_DOMAIN)

_PLACE = ("topic", "partition", "offset", "timestamp")


def select_edits(decoded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The four fields of an edit under their processed names."""
    return decoded.select(
        *keep,
        F.col("performer.user_text").alias("user_id"),
        F.col("meta.domain").alias("domain"),
        F.col("meta.dt").alias("created_at"),
        F.col("page_title"),
    )


def clean_edits(processed: DataFrame) -> DataFrame:
    """Type `created_at` and keep complete rows. An empty domain cannot be a partition key."""
    return (
        processed.withColumn("created_at", parse_instant(F.col("created_at")))
        .dropna(subset=PROCESSED_EVENT.names)
        .filter(F.col("domain") != "")
    )


def _nothing_decoded(names: Sequence[str]) -> Column:
    nothing = F.lit(True)
    for name in names:
        nothing = nothing & F.col(name).isNull()
    return nothing


def _unreadable(names: Sequence[str], raw: str) -> Column:
    # Only rows with nothing decoded are looked at again, so the second parse is rare.
    return F.when(_nothing_decoded(names), ~is_json_object(F.col(raw))).otherwise(F.lit(False))


def raw_outcome(allowed: Sequence[str] = ALLOWED_DOMAINS, raw: str = "raw") -> Column:
    """What becomes of a decoded raw event in the filter job."""
    return (
        F.when(_unreadable(RAW_EVENT.names, raw), BAD_JSON)
        .when(~F.coalesce(allowed_domain(allowed), F.lit(False)), OTHER_DOMAIN)
        .when(~F.coalesce(human(), F.lit(False)), NOT_HUMAN)
        .otherwise(PASSED)
    )


def processed_outcome(raw: str = "raw") -> Column:
    """What becomes of a decoded processed event, `created_at` still text, in the table writer."""
    missing = F.lit(False)
    for name in PROCESSED_EVENT.names:
        missing = missing | F.col(name).isNull()
    return (
        F.when(_unreadable(PROCESSED_EVENT.names, raw), BAD_JSON)
        .when(missing, INCOMPLETE)
        .when(parse_instant(F.col("created_at")).isNull(), BAD_TIMESTAMP)
        .when(F.col("domain") == "", EMPTY_DOMAIN)
        .otherwise(PASSED)
    )


def classify_raw(topic: DataFrame, allowed: Sequence[str] = ALLOWED_DOMAINS) -> DataFrame:
    """Every raw record with its place, text, decoded fields and `outcome`."""
    decoded = decode_raw(topic.withColumn("raw", text()), (*_PLACE, "raw"))
    return decoded.withColumn("outcome", raw_outcome(allowed))


def classify_processed(topic: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every processed record with its place, text, decoded fields and `outcome`."""
    decoded = decode_processed(topic.withColumn("raw", text()), (*_PLACE, "raw", *keep))
    return decoded.withColumn("outcome", processed_outcome())


def rejects(classified: DataFrame) -> DataFrame:
    """Records no later stage will see, whole, with their place and reason. Records that a filter
    drops on purpose are not among them."""
    kept = classified.filter(F.col("outcome").isin(*REASONS))
    return kept.withColumnRenamed("outcome", "reason").select(*REJECT.names)
