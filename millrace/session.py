"""Session settings the semantics rest on, and where scratch and checkpoints go."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side of a join is broadcast when it has been counted to be no larger than this.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on. Master, memory and shuffle sizing stay the caller's."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # a repeated key in an object keeps its last value, as in the JSON decoders elsewhere here
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared folder of `spark.checkpoint.dir`. It goes when the session's JVM ends.

    A local session that names no such folder gets a temporary one; executors on other machines could not see it.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if shared:
        path = f"{shared.rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"
    elif re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        path = tempfile.mkdtemp(prefix=f"millrace-{name}-")
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def ship(spark: SparkSession) -> None:
    """Let the executors import this package, also where it is not installed on them."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parent
    file = os.path.join(tempfile.mkdtemp(prefix="millrace-code-"), "millrace.zip")
    with zipfile.ZipFile(file, "w") as code:
        for source in sorted(root.rglob("*.py")):
            code.write(source, source.relative_to(root.parent))
    context.addPyFile(file)
    _shipped.add(context.applicationId)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows. The optimizer knows, and leaves out what would be joined with or added to them."""
    nothing = [F.lit(None).cast(field.dataType).alias(field.name) for field in schema]
    return spark.range(1).select(*nothing).filter(F.lit(False))


def fits_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Measure `df`, no further than the bounds, to learn whether it may be broadcast.

    For flat rows: text counts with its length, every other column with 16 bytes.
    """
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType == T.StringType()]
    width = F.lit(16 * len(df.columns))
    for length in texts:
        width = width + length
    n, total = df.limit(rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= rows and total <= size


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """`df` marked for broadcast when its measured size allows it, else `df` as it is."""
    return F.broadcast(df) if fits_broadcast(df) else df
