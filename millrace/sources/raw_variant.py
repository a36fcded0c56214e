"""Raw events at rest as VARIANT: parsed once when they land, any path read later without parsing again.

Spark shreds the common paths into Parquet columns of their own when it writes (`spark.sql.variant.inferShreddingSchema`), and
reads only those that a query takes (`variant_get` reaches the scan). Text that is no JSON keeps its bytes beside a null
`event`. Records lie in directories by the day of their topic time; those without one in the null day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.decode import is_json_object, json_or_null, text
from millrace.schemas import COORDINATES

_SHREDDED = {
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
}


def land(raw_topic: DataFrame, path: str) -> None:
    """Append records of a raw topic."""
    for name, value in _SHREDDED.items():
        raw_topic.sparkSession.conf.set(name, value)
    raw = raw_topic.select("topic", *COORDINATES, text().alias("raw"))
    event = F.when(is_json_object(F.col("raw")), json_or_null(F.col("raw")))
    rows = raw.select(
        "topic", *COORDINATES, event.alias("event"), F.when(event.isNull(), F.col("raw")).alias("raw"), F.to_date("timestamp").alias("d")
    )
    rows.hint("rebalance", "d").write.mode("append").partitionBy("d").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    for name, value in _SHREDDED.items():
        spark.conf.set(name, value)
    return spark.read.parquet(path)


def field(path: str, kind: str = "string") -> Column:
    """A field of `event` by its path, such as `meta.id`; cast to `kind`, null where it is absent or cannot be."""
    return F.try_variant_get("event", f"$.{path}", kind)
