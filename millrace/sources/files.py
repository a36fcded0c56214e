"""The few file-system calls the edits table needs, through Hadoop's API, so any storage works."""

from __future__ import annotations

from pyspark.sql import SparkSession


# Writer options for outputs that count once their `_SUCCESS` is there, whatever the cluster's default.
MARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match, in order; none if there are no such paths."""
    where = _path(spark, pattern)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return sorted(status.getPath().toString() for status in found or [])


def delete(spark: SparkSession, path: str) -> None:
    where = _path(spark, path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    where = _path(spark, path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def sizes(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Paths that match with their lengths."""
    where = _path(spark, pattern)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return sorted((status.getPath().toString(), status.getLen()) for status in found or [])


def batch_name(run: str, batch_id: int) -> str:
    """The folder of one batch of one run, below what belongs to its writer."""
    return f"run={run}/batch_id={batch_id}"
