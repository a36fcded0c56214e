"""Current rows with an index by title: two tables bucketed alike on the whole key, joined without a shuffle.

The rows are bucketed and sorted by key. The index holds a title and a key per row; it has the same buckets, sorted by
title, so that a lookup reads the few row groups of a bucket that may hold the titles. Rows without a title are not in the
index. Both are plain Spark tables; they are written anew when the rows have changed enough.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import KEY
from millrace.session import broadcast_if_small

BUCKETS = 64


def write_indexed(rows: DataFrame, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Tables `<name>_rows` and `<name>_titles`, below `path`; tables of these names are replaced."""
    dealt = rows.repartition(buckets, *KEY)  # as a bucketed write deals them: one file a bucket

    def save(part: DataFrame, kind: str, *order: str) -> None:
        writer = part.write.format("parquet").bucketBy(buckets, *KEY).sortBy(*order).option("path", f"{path.rstrip('/')}/{kind}")
        writer.mode("overwrite").saveAsTable(f"{name}_{kind}")

    save(dealt, "rows", *KEY)
    save(dealt.filter(F.col("page_title").isNotNull()).select("page_title", *KEY), "titles", "page_title", *KEY)


def with_titles(spark: SparkSession, name: str, titles: DataFrame) -> DataFrame:
    """Rows whose title is among those of the first column of `titles`. Neither table is shuffled."""
    wanted = titles.select(F.col(titles.columns[0]).alias("page_title")).distinct()
    keys = spark.table(f"{name}_titles").join(broadcast_if_small(wanted), "page_title", "left_semi").select(*KEY)
    return spark.table(f"{name}_rows").join(keys.hint("merge"), list(KEY), "left_semi")
