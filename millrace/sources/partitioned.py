"""Current rows in directories by domain and day, and the lookup of many keys in them at once.

Keys come as a table. Which directories they are in is found at run time from the table itself (dynamic partition
pruning): only these are listed into the scan, without a word about them in the query. Keys beyond the bound of a broadcast
are joined by a shuffle on the whole key, and prune nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.schemas import KEY
from millrace.session import BROADCAST_ROWS, fits_broadcast


def write_partitioned(rows: DataFrame, path: str) -> None:
    dated = rows.withColumn("d", F.to_date("created_at"))
    dated.hint("rebalance", "domain", "d").sortWithinPartitions("domain", "d", F.desc("created_at"), "user_id").write.partitionBy(
        "domain", "d"
    ).mode("overwrite").parquet(path)


def rows_of_keys(rows: DataFrame, keys: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of a table by `write_partitioned` whose key is among `keys(domain, created_at, user_id)`."""
    # every text passes this predicate: pruning at run time looks for one before it prepares itself
    wanted = keys.filter(F.col("user_id") >= F.lit("")).select(*KEY, F.to_date("created_at").alias("d")).distinct()
    if fits_broadcast(wanted, broadcast_rows):
        wanted = F.broadcast(wanted)
    return rows.join(wanted, [*KEY, "d"], "left_semi").drop("d")
