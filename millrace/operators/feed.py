"""Landed event-feed text to topic records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.decode import is_json

SENT, BAD_JSON = "sent", "bad_json"
FEED_OUTCOMES = (SENT, BAD_JSON)


def frame_data(frame: Column) -> Column:
    """The payload of one feed frame: its `data` lines, joined by line feeds.

    Comment lines and other fields are skipped and one blank after the colon is not part of the
    data, as the event-stream format has it. '' where the frame has no data.
    """
    lines = F.regexp_extract_all(frame, F.lit(r"(?m)^data:[ ]?(.*?)\r?$"), F.lit(1))
    return F.array_join(lines, "\n")


def frame_id(frame: Column) -> Column:
    """What the frame's last `id` line says, NULL where it has none. Numbers in the order of numbers."""
    lines = F.regexp_extract_all(frame, F.lit(r"(?m)^id:[ ]?(.*?)\r?$"), F.lit(1))
    found = F.when(F.size(lines) > 0, F.element_at(lines, -1))
    return F.struct(found.try_cast("bigint").alias("number"), found.alias("text"))


def feed_messages(frames: DataFrame, frame: str = "value") -> DataFrame:
    """Frames -> `data` and `position` (the frame's own id), frames without data left out."""
    read = frames.select(frame_data(F.col(frame)).alias("data"), frame_id(F.col(frame)).alias("position"))
    return read.filter(F.length("data") > 0)


def classify_messages(messages: DataFrame) -> DataFrame:
    """Messages with `outcome`: whether they are sent on."""
    return messages.withColumn("outcome", F.when(is_json(F.col("data")), SENT).otherwise(BAD_JSON))


def publishable(messages: DataFrame) -> DataFrame:
    """Messages whose data is JSON, as topic values, text unchanged."""
    sent = classify_messages(messages).filter(F.col("outcome") == SENT)
    return sent.select(F.col("data").cast("binary").alias("value"), "position")


def unpublishable(messages: DataFrame) -> DataFrame:
    """Messages that are skipped, with their whole text and the reason."""
    return message_rejects(classify_messages(messages))


def message_rejects(classified: DataFrame) -> DataFrame:
    skipped = classified.filter(F.col("outcome") != SENT)
    return skipped.select(F.col("data").alias("raw"), F.col("outcome").alias("reason"))
