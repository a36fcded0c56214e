"""The pipelines as pure functions from DataFrame to DataFrame.

No source and no sink inside: the same function is a batch query, a backfill or a stream. None of
them shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.decode import (
    decode,
    decode_processed,
    decode_raw,
    encode_processed,
    flatten_legacy,
    may_hold_false,
    may_mention,
    record_key,
    text,
)
from millrace.functions.scalars import canonical_uuid, parse_instant
from millrace.operators.as_of import allowed_as_of
from millrace.operators.edits import clean_edits, select_edits
from millrace.operators.feed import feed_messages, publishable
from millrace.operators.filters import filter_domain, filter_human, with_id
from millrace.operators.keyed import upserts
from millrace.schemas import ALLOWED_DOMAINS, COORDINATES, PROCESSED_TOPIC, RAW_EVENT
from millrace.sources.topics import as_topic, source_seq


# What of a raw event the filter job looks at: all but `meta.id`.
_META = T.StructType([field for field in RAW_EVENT["meta"].dataType if field.name != "id"])
_LOOKED_AT = T.StructType([T.StructField("meta", _META), RAW_EVENT["performer"], RAW_EVENT["page_title"]])


def filter_edits(
    raw_topic: DataFrame, allowed: Sequence[str] | DataFrame = ALLOWED_DOMAINS, keep: Sequence[str] = ()
) -> DataFrame:
    """Raw topic -> human edits on allowed domains, four fields, `created_at` still text.

    Records whose text shows that they cannot pass are not parsed at all.
    """
    raw_topic = raw_topic.filter(may_hold_false(text()))
    if isinstance(allowed, DataFrame):
        decoded = decode(raw_topic, _LOOKED_AT, list(dict.fromkeys((*keep, *COORDINATES))))
        on_list = filter_domain(decoded, allowed, spread=F.xxhash64(*COORDINATES))
    else:
        decoded = decode(raw_topic.filter(may_mention(text(), allowed)), _LOOKED_AT, keep)
        on_list = filter_domain(decoded, allowed)
    return select_edits(filter_human(on_list), keep)


def filter_edits_as_of(raw_topic: DataFrame, versions: DataFrame, keep: Sequence[str] = (), **bounds: int) -> DataFrame:
    """Raw topic -> human edits on domains that `versions` of the list allowed at the time of their record."""
    decoded = decode(raw_topic.filter(may_hold_false(text())), _LOOKED_AT, list(dict.fromkeys((*keep, *COORDINATES))))
    on_list = allowed_as_of(decoded, versions, spread=F.xxhash64(*COORDINATES), **bounds)
    return select_edits(filter_human(on_list), keep)


def find_event(raw_topic: DataFrame, event_id: str, keep: Sequence[str] = ()) -> DataFrame:
    """Raw events with the given `meta.id`, decoded. Only records whose text may hold it are parsed."""
    return with_id(decode_raw(raw_topic.filter(may_mention(text(), [event_id])), keep), event_id)


def filter_job(
    raw_topic: DataFrame, allowed: Sequence[str] | DataFrame = ALLOWED_DOMAINS, name: str = PROCESSED_TOPIC
) -> DataFrame:
    """Raw topic -> processed topic."""
    edits = filter_edits(raw_topic, allowed, keep=COORDINATES)
    return as_topic(encode_processed(edits.withColumn("key", record_key()), ("key", *COORDINATES)), name)


def typed_edits(processed_topic: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Processed topic -> complete, typed rows."""
    return clean_edits(decode_processed(processed_topic, keep))


def writer_job(processed_topic: DataFrame) -> DataFrame:
    """Processed topic -> log rows of the edits table."""
    placed = processed_topic.withColumn("seq", source_seq(processed_topic))
    return upserts(typed_edits(placed, keep=("seq",)), F.col("seq"))


def publish_feed(frames: DataFrame) -> DataFrame:
    """Feed frames -> topic values."""
    return publishable(feed_messages(frames))


def legacy_rows(raw_topic: DataFrame) -> DataFrame:
    """The older single job: flatten, bring the id into one form, cast the time, keep rows with an id."""
    flat = flatten_legacy(raw_topic)
    return (
        flat.withColumn("id", canonical_uuid(F.col("id")))
        .withColumn("dt", parse_instant(F.col("dt")))
        .filter(F.col("id").isNotNull())
    )
