"""Which fields raw events have, listed or not, with their types and counts, by domain and day.

Every field is found by taking the parsed value apart, so none has to be declared. Text that is no JSON object is not
counted. An event without a domain counts under a null one. Each group's rows are counted in every task first; what
is shuffled grows with the kinds of fields, not with the events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.decode import is_json_object, json_or_null, text

DEPTH = 3
_GROUP = ("domain", "day")


def type_name(value: Column) -> Column:
    """The kind of a variant, without what is inside an object or array."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _parsed(raw_topic: DataFrame) -> DataFrame:
    raw = raw_topic.select(text().alias("raw"), F.date_trunc("day", "timestamp").alias("day"))
    whole = raw.filter(is_json_object(F.col("raw"))).select("day", json_or_null(F.col("raw")).alias("whole"))
    return whole.select(F.try_variant_get("whole", "$.meta.domain", "string").alias("domain"), "day", "whole")


def field_counts(raw_topic: DataFrame, depth: int = DEPTH) -> DataFrame:
    """`domain, day, field, type, n`: how often a field, by its path, holds a value of a type. Elements of arrays are not
    taken apart, nor objects below `depth`."""
    spark = raw_topic.sparkSession
    level = _parsed(raw_topic).select(*_GROUP, F.lit("").alias("path"), F.col("whole").alias("inside"))
    counts = None
    for n in range(depth):
        parts = level.lateralJoin(spark.tvf.variant_explode(F.col("inside").outer()))
        path = F.concat("path", F.when(F.col("path") != "", ".").otherwise(""), "key").alias("path")
        fields = parts.select(*_GROUP, path, F.col("value").alias("inside")).withColumn("type", type_name(F.col("inside")))
        found = fields.groupBy(*_GROUP, F.col("path").alias("field"), "type").agg(F.count(F.lit(1)).alias("n"))
        counts = found if counts is None else counts.unionByName(found)
        level = fields.filter(F.col("type") == "OBJECT").drop("type")
    return counts


def merged_schemas(raw_topic: DataFrame) -> DataFrame:
    """`domain, day, n_events, schema`: the least schema that all events of a group fit."""
    return _parsed(raw_topic).groupBy(*_GROUP).agg(
        F.count(F.lit(1)).alias("n_events"), F.schema_of_variant_agg("whole").alias("schema")
    )
