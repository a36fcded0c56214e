"""Landed event-feed files: text frames that end with a blank line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_frames(spark: SparkSession, path: str, newline: str = "\n") -> DataFrame:
    """One row per frame, in column `value`. Files are split and read in parallel.

    `newline` is the line end of the files. One landing folder holds files of one kind.
    """
    return spark.read.option("lineSep", newline * 2).text(path)


def stream_frames(spark: SparkSession, path: str, newline: str = "\n", max_per_trigger: int | None = None) -> DataFrame:
    """The same, as files land in the folder, at most `max_per_trigger` files at a time."""
    reader = spark.readStream.option("lineSep", newline * 2)
    if max_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.text(path)


def write_frames(frames: DataFrame, path: str, newline: str = "\n") -> None:
    """Write column `value` as frames."""
    frames.select("value").write.option("lineSep", newline * 2).text(path)
