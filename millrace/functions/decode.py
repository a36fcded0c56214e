"""JSON text to columns and back, all as native expressions.

Known differences from a strict parser: text after a complete top-level object is ignored rather
than an error, and `NaN` literals are an error.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import KEY, PROCESSED_EVENT, RAW_EVENT


def text(value: Column | str = "value") -> Column:
    """A topic value's UTF-8 bytes as text."""
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def decode(df: DataFrame, schema: T.StructType, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Decode the JSON of `value` into the fields of `schema`, next to the `keep` columns.

    Every input row yields one row; text that is no JSON object yields NULL in every field, and a
    field of the wrong type yields NULL in that field alone.

    Goes through a generator, not a struct column: a predicate on a decoded field would otherwise
    be pushed below the projection together with a copy of the parse, once per predicate.
    """
    return df.select(*keep, F.inline(F.array(F.from_json(text(value), schema))))


def decode_raw(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """`meta`, `performer`, `page_title` of raw events."""
    return decode(df, RAW_EVENT, keep)


def decode_processed(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """`user_id`, `domain`, `created_at` (still text), `page_title` of processed events."""
    return decode(df, PROCESSED_EVENT, keep)


def encode_processed(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The four processed fields as one JSON `value`; NULL fields are left out of the text."""
    return df.select(*keep, F.to_json(F.struct(*PROCESSED_EVENT.names)).alias("value"))


def record_key() -> Column:
    """The topic key of a processed event: the whole table key, so that writes to one table key
    stay in one partition, in order, and a busy domain still spreads over all partitions."""
    return F.to_json(F.struct(*KEY)).cast("binary")


def is_json(value: Column) -> Column:
    """Whether the text is JSON of any kind, the literal `null` included; False for NULL."""
    return F.get_json_object(value, "$").isNotNull()


def is_json_object(value: Column) -> Column:
    """Whether the text is a JSON object; False for NULL."""
    return F.coalesce(value.rlike(r"^\s*\{") & is_json(value), F.lit(False))


def json_or_null(value: Column) -> Column:
    """The parsed value, or NULL for text that is not JSON; absent fields read as NULL later."""
    return F.try_parse_json(value)


def may_mention(value: Column, words: Sequence[str]) -> Column:
    r"""False only where no JSON string in the text can equal one of `words`.

    A cheap look at the raw text before the parse. Exact: a plain ASCII word stands in the text as
    it is unless a character of it is written as a \u00.. escape, and rows with one pass as well.
    Words for which this does not hold (numbers, or with other characters) let every row pass.
    """
    if not all(_stands_as_is(word) for word in words):
        return F.lit(True)
    seen = F.lit(False)
    for word in (*words, "\\u00"):
        seen = seen | value.contains(word)
    return seen


def may_hold_false(value: Column) -> Column:
    """False only where no JSON value in the text is `false`. There is one way to write it."""
    return value.contains("false")


def _stands_as_is(word: str) -> bool:
    try:
        float(word)  # a JSON number may be decoded to other digits than it is written with
        return False
    except ValueError:
        return bool(word) and word.isascii() and all(c.isalnum() or c in ".-_" for c in word)


_LEGACY_SHAPE = "meta VARIANT, performer VARIANT, page_title STRING"


def flatten_legacy(df: DataFrame, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """`id`, `page_title`, `user_text`, `dt` of raw events, in the older single-job form.

    The whole row is NULL for bad JSON, a root that is no object, and a `meta` or `performer` that
    is there but no object; where `meta` or `performer` is missing only its fields are NULL.
    """
    shaped = df.select(*keep, F.inline(F.array(F.from_json(text(value), _LEGACY_SHAPE))))

    def absent_or_object(name: str) -> Column:
        return F.coalesce(F.schema_of_variant(name).startswith("OBJECT"), F.lit(True))

    usable = absent_or_object("meta") & absent_or_object("performer")

    def field(parent: str, name: str) -> Column:
        return F.when(usable, F.try_variant_get(parent, f"$.{name}", "string"))

    return shaped.select(
        *keep,
        field("meta", "id").alias("id"),
        F.when(usable, F.col("page_title")).alias("page_title"),
        field("performer", "user_text").alias("user_text"),
        field("meta", "dt").alias("dt"),
    )
