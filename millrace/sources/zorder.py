"""Current rows in Z-order of user and time, so that lookups by either column skip most row groups.

Users and times are cut into `1 << BITS` ranges each of about equally many rows; the numbers of a row's two ranges, with
their bits in turn, are its place on the curve. Rows are range-partitioned by place and sorted within, so that a row group
covers few ranges of either column, and the least and greatest values that Parquet keeps of it rule it out for most
lookups. The ranges' borders are a row each, at most `1 << BITS` of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6
COLUMNS = ("user_id", "created_at")


def interleaved(a: Column, b: Column, bits: int = BITS) -> Column:
    """Bits of two whole numbers in turn, those of `a` above those of `b`."""
    place = F.lit(0).cast("long")
    for k in range(bits):
        for value, at in ((b, 2 * k), (a, 2 * k + 1)):
            place = place.bitwiseOR(F.shiftleft(F.shiftright(value.cast("long"), k).bitwiseAND(F.lit(1).cast("long")), at))
    return place


def _borders(rows: DataFrame, column: str, bits: int) -> list:
    """Values that cut a column's rows into about equal ranges: of ranges by a sort, the first value of each."""
    n = 1 << bits
    known = rows.filter(F.col(column).isNotNull()).select(column)
    ranged = known.repartitionByRange(n, column).groupBy(F.spark_partition_id().alias("part")).agg(F.min(column).alias("first"))
    return sorted({r["first"] for r in ranged.collect()})[1:]


def _number(column: str, borders: list) -> Column:
    """Which range a value is in; nulls are in the first."""
    listed = F.array(*[F.lit(x) for x in borders]) if borders else F.array()
    return F.coalesce(F.size(F.filter(listed, lambda x: x <= F.col(column))), F.lit(0)) if borders else F.lit(0)


def write_zordered(rows: DataFrame, path: str, files: int, bits: int = BITS, columns: tuple[str, str] = COLUMNS) -> None:
    """Write rows as `files` files along the curve. `rows` is read three times."""
    first, second = (_number(c, _borders(rows, c, bits)) for c in columns)
    placed = rows.withColumn("_z", interleaved(first, second, bits))
    placed.repartitionByRange(files, "_z").sortWithinPartitions("_z", *columns).drop("_z").write.mode("overwrite").parquet(path)
