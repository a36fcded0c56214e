"""Small helpers the operators of this folder share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.session import ship, workspace

FOLDS = 5
BATCH_ROWS = 1_000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def _give_back() -> None:
    """Return what a task has freed to the system: its Python process goes on to serve other stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _tidy(run: Callable) -> Callable:
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _give_back()

    return tidied


def map_batches(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """`df.mapInArrow` with this package on the executors.

    Rows hold whole texts, so a batch is `BATCH_ROWS` of them unless the session asks for another number than
    Spark's default, which is meant for rows of numbers.
    """
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_BATCH_CONF) == "10000":
        spark.conf.set(_BATCH_CONF, BATCH_ROWS)
    return df.mapInArrow(_tidy(run), schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one. It goes when the session's JVM ends."""
    path = workspace(spark, name)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def cut(df: DataFrame) -> DataFrame:
    """`df` written to the shared folder as Parquet and read from there: lineage ends here."""
    path = folder(df.sparkSession, "cut") + "/t"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(key: Column) -> Column:
    """Rows whose fold is 0: CRC-32 of the key as decimal text, modulo `FOLDS`."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
