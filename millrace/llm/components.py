"""Connected components of a graph given by its edges.

Every task first replaces its own edges by a forest of depth one: each node it knows, linked to the least
node its edges reach. In a round the rows of a node meet in one task, which makes one forest of them, and
every row then points to where its root points. Nothing but such rows moves, and a node that is linked to
very many others has one row a task. Rounds end when each node has one root and no root has another; the
number of rounds grows with the logarithm of the longest chain. Nodes and labels stay on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, map_batches, shuffle_partitions


def forest(edges: Iterator[tuple]) -> dict:
    """Every node of the edges with the least node it is connected to."""
    up: dict = {}

    def root(x):
        top = x
        while (next_ := up.setdefault(top, top)) != top:
            top = next_
        while x != top:
            up[x], x = top, up[x]
        return top

    for a, b in edges:
        p, q = root(a), root(b)
        if p < q:
            up[q] = p
        elif q < p:
            up[p] = q
    return {x: root(x) for x in list(up)}


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = None

    def edges() -> Iterator[tuple]:
        nonlocal kind
        for batch in batches:
            kind = batch.schema.field(0).type
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

    rows = [(x, r) for x, r in forest(edges()).items() if x != r]
    for at in range(0, len(rows), 100_000):
        part = list(zip(*rows[at : at + 100_000], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c in part], names=["node", "root"])


def _is_star(rows: DataFrame) -> bool:
    """Has each node one root, and no root another?"""
    seen = rows.select("node").unionAll(rows.select(F.col("root").alias("node")).distinct())
    return seen.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """`edges(a, b)` to `(node, root)` for every node of an edge; root is the least node reachable.

    Repeated edges and loops are allowed, edges with a null end are left out; a node that has loops alone is not
    listed. No edges give no rows.
    """
    kind = edges.schema["a"].dataType.simpleString()
    schema, parts = f"node {kind}, root {kind}", shuffle_partitions(edges.sparkSession)
    given = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a != b")
    rows = cut(map_batches(given, _forests, schema))
    while not _is_star(rows):
        met = cut(map_batches(rows.repartition(parts, "node"), _forests, schema))
        above = met.groupBy(F.col("node").alias("root")).agg(F.min("root").alias("top"))
        rows = cut(met.join(above, "root", "left").select("node", F.coalesce("top", "root").alias("root")).distinct())
    return rows.unionAll(rows.select(F.col("root").alias("node"), "root").distinct())
