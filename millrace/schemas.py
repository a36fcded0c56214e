"""The fixed, hand-declared schemas. Nothing is inferred and every field is nullable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- fixed values the pipelines share with the systems around them -------------------------
INPUT_TOPIC = "input"
PROCESSED_TOPIC = "processed"
ALLOWED_DOMAINS = ("en.wikipedia.org", "www.wikidata.org", "commons.wikimedia.org")

TOPIC_RECORD = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RAW_EVENT = T.StructType(
    [
        T.StructField(
            "meta",
            T.StructType(
                [
                    T.StructField("id", T.StringType()),
                    T.StructField("dt", T.StringType()),
                    T.StructField("domain", T.StringType()),
                ]
            ),
        ),
        T.StructField(
            "performer",
            T.StructType(
                [
                    T.StructField("user_text", T.StringType()),
                    T.StructField("user_is_bot", T.BooleanType()),
                ]
            ),
        ),
        T.StructField("page_title", T.StringType()),
    ]
)

PROCESSED_EVENT = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("created_at", T.StringType()),
        T.StructField("page_title", T.StringType()),
    ]
)

EDIT_ROW = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("page_title", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("user_is_bot", T.BooleanType()),
    ]
)

LEGACY_EVENT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("page_title", T.StringType()),
        T.StructField("user_text", T.StringType()),
        T.StructField("dt", T.StringType()),
    ]
)

# Where a record sat in the source topic. Compared field by field it is a total order over the
# records of one topic, and so the order in which writes to one key win.
COORDINATES = ("timestamp", "partition", "offset")
SEQ = T.StructType([TOPIC_RECORD[name] for name in COORDINATES])

# --- the keyed table ----------------------------------------------------------------------
KEY = ("domain", "created_at", "user_id")
CELLS = ("page_title", "user_is_bot")
UPSERT, DELETE = "up", "del"

# One row per write. `d` is the day of `created_at`; it and `domain` are directory levels.
EDIT_LOG = T.StructType(
    [
        T.StructField("created_at", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("page_title", T.StringType()),
        T.StructField("user_is_bot", T.BooleanType()),
        T.StructField("op", T.StringType()),
        T.StructField("seq", SEQ),
        T.StructField("writer", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("domain", T.StringType()),
        T.StructField("d", T.DateType()),
    ]
)


def cell_type(name: str) -> T.StructType:
    """A cell with the write that set it; ordered by that write first."""
    return T.StructType([T.StructField("seq", SEQ), T.StructField("value", EDIT_ROW[name].dataType)])


# What is known about one key: its last upsert, its last delete, and its cells.
KEY_STATE = T.StructType(
    [
        T.StructField("domain", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("up_seq", SEQ),
        T.StructField("del_seq", SEQ),
        *[T.StructField(name, cell_type(name)) for name in CELLS],
    ]
)

REJECT = T.StructType(
    [
        *[TOPIC_RECORD[name] for name in ("topic", "partition", "offset", "timestamp")],
        T.StructField("raw", T.StringType()),
        T.StructField("reason", T.StringType()),
    ]
)


def require(df: DataFrame, schema: T.StructType, what: str = "input") -> DataFrame:
    """Return `df` if it has every column of `schema` with its type, else raise ValueError."""
    have = {field.name: field.dataType for field in df.schema}
    wrong = [
        f"{field.name}: {have[field.name].simpleString() if field.name in have else 'absent'}"
        f" instead of {field.dataType.simpleString()}"
        for field in schema
        if have.get(field.name) is None or not _same(have[field.name], field.dataType)
    ]
    if wrong:
        raise ValueError(f"{what} does not have the declared columns: " + "; ".join(wrong))
    return df


def _same(a: T.DataType, b: T.DataType) -> bool:
    return a.simpleString() == b.simpleString()
