"""Exact top-k search by inner product, pruned with segment statistics from coarse to fine.

Components become floor(256 * x), so that scores are whole numbers. The distance of a query and a candidate
is their negated score. Cut into segments, vectors have a mean m and a deviation d (root of the squared
differences' sum) in each, and by the Cauchy-Schwarz inequality

    distance >= -sum over segments of (length * m_q * m_c + d_q * d_c)

Vectors are turned first, which changes no inner product: into the principal axes of a bounded sample of the vectors, those
with most of the variance in front. On each level some leading axes are segments of their own and the others
four long ones; with few leading axes the bound is cheap and loose, with more of them tighter. Pairs whose lower bound
exceeds the k-th best distance known for the query are dropped level by level; survivors get their exact distance,
from the whole numbers. Bounds leave room for the rounding of turned components.

Queries go out in blocks of bounded size, and each block meets every candidate where that lies. A first k-th best is
known from the sampled vectors, which are candidates; each task goes on from there and sends at most k candidates for a
query, often none. Queries need not be among the vectors. A window per query picks the k best of them.

Vectors that are null or hold a null or non-finite component take no part; vectors of different length are
never compared. Ties go to the smaller vec_id. Rows with the query's vec_id are the query's own; a repeated query is
answered once for each row, a repeated candidate counts as often as it occurs. Scores beyond 64 bits are cut off
there. Null ids take no part. No queries give no rows. Columns other than `vec_id` and `embedding` are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut, folder, map_batches

K = 5
SCALE = 256
LEADING = (1 / 8, 1 / 2, 5 / 8)  # of the axes, on each level
REST = 4  # segments of the others
SAMPLE = 2_048  # vectors that give axes and first bounds; whatever they are, results are the same
_MOST_TURNED = 2_048  # longer vectors are not turned
BLOCK_BYTES = 16 << 20
_QUERIES, _CANDIDATES = 512, 2048
_LARGEST = (1 << 63) - 1


def quantised(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every length of vector: row numbers and whole-number components (as doubles) of the usable rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    valid = np.asarray(column.is_valid())
    lengths = np.where(valid, np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)), -1).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null components become NaN
    ends = np.cumsum(np.maximum(lengths, 0))
    for length in np.unique(lengths[lengths >= 0]):
        rows = np.flatnonzero(lengths == length)
        values = flat[(ends[rows] - length)[:, None] + np.arange(length)[None, :]]
        fine = np.isfinite(values).all(axis=1)
        yield rows[fine], np.floor(values[fine] * SCALE)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of whole-number matrices, cut off at 64 bits."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    top = np.abs(a).max() * np.abs(b).max() * a.shape[1]
    if top < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in m] for m in (a, b)]
    found = [[sum(x * y for x, y in zip(p, q, strict=True)) for q in whole[1]] for p in whole[0]]
    return np.array([[max(-_LARGEST, min(_LARGEST, x)) for x in row] for row in found], np.int64)


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows with rows, as `products` has them."""
    if np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1] < 1 << 53:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    return np.array([products(a[i : i + 1], b[i : i + 1])[0, 0] for i in range(len(a))], np.int64)


def segment_edges(length: int, leading: float) -> np.ndarray:
    """Bounds of the segments of a level: single leading axes, then up to `REST` long segments."""
    single = int(length * leading)
    return np.unique(np.append(np.arange(single), np.linspace(single, length, REST + 1).astype(int)))


def statistics(m: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Rows whose inner product bounds that of the rows of `m` from above: scaled means and deviations of segments."""
    if m.shape[1] == 0:
        return np.zeros((len(m), 1))
    sizes = np.diff(edges)
    means = np.add.reduceat(m, edges[:-1], axis=1) / sizes
    long = np.flatnonzero(sizes > 1)
    away = [np.sqrt(((m[:, edges[k] : edges[k + 1]] - means[:, k : k + 1]) ** 2).sum(axis=1)) for k in long]
    return np.column_stack([means * np.sqrt(sizes), *away])


def principal_axes(sample: np.ndarray) -> np.ndarray:
    """An orthogonal matrix, by whose columns the sample's rows vary ever less."""
    length = sample.shape[1]
    if not len(sample) or not 0 < length <= _MOST_TURNED:
        return np.eye(length)
    scale = max(np.abs(sample).max(), 1.0)
    return np.linalg.eigh((sample / scale).T @ (sample / scale))[1][:, ::-1]


class Turned:
    """Vectors of equal length with their statistics on every level, and their norms."""

    def __init__(self, m: np.ndarray, axes: np.ndarray) -> None:
        self.m = m
        turned = m @ axes
        self.stats = [statistics(turned, segment_edges(m.shape[1], leading)) for leading in LEADING]
        self.norm = np.sqrt((m * m).sum(axis=1))


class Best:
    """The k best candidates known for each query of a group: greater score first, then smaller id."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.row, self.id, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.least = np.full(n, -np.inf)

    def add(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        row, ids, score = (np.concatenate(x) for x in ((self.row, row), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        keep = place < self.k
        last = place == self.k - 1
        self.least[row[last]] = np.maximum(self.least[row[last]], score[last])
        self.row, self.id, self.score = row[keep], ids[keep], score[keep]


class Group:
    """Some queries of equal length and what is known of their k-th best."""

    def __init__(self, keys: np.ndarray, ids: np.ndarray, m: np.ndarray, axes: np.ndarray, least: np.ndarray, k: int) -> None:
        self.keys, self.ids, self.own = keys, ids, Turned(m, axes)
        self.best = Best(len(ids), k)
        self.best.least = least.copy()
        self.met = self.pairs = 0

    def meet(self, ids: np.ndarray, others: Turned) -> None:
        self.met += len(self.ids) * len(ids)
        alive = np.ones((len(self.ids), len(ids)), bool)
        room = 1e-9 * np.outer(self.own.norm, others.norm) + 1e-6
        for own, other in zip(self.own.stats, others.stats, strict=True):
            rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            if not len(rows):
                return
            at = np.ix_(rows, columns)
            alive[at] &= own[rows] @ other[columns].T + room[at] >= self.best.least[rows, None]
        row, column = np.nonzero(alive & (self.ids[:, None] != ids[None, :]))
        self.pairs += len(row)
        if not len(row):
            return
        if 8 * len(row) < alive.size:  # few are left: each on its own
            exact = paired(self.own.m[row], others.m[column])
        else:
            rows, columns = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
            exact = products(self.own.m[rows], others.m[columns])[np.searchsorted(rows, row), np.searchsorted(columns, column)]
        good = exact >= self.best.least[row]
        if good.any():
            self.best.add(row[good], ids[column[good]], exact[good])


def first_bounds(ids: np.ndarray, m: np.ndarray, sampled: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query among the sampled vectors, its own rows left out."""
    least = np.full(len(ids), -np.inf)
    if len(sample) < k:
        return least
    for at in range(0, len(ids), _QUERIES):
        part = slice(at, at + _QUERIES)
        near = products(m[part], sample).astype(np.float64)
        near[ids[part, None] == sampled[None, :]] = -np.inf
        least[part] = np.partition(near, len(sample) - k, axis=1)[:, len(sample) - k]
    # from whole numbers beyond 2^53 these may be rounded up
    return np.where(np.abs(least) < 1 << 53, least, least - np.abs(least) * 1e-15)


def _search(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[int, list[Group]] = {}
        for batch in batches:
            every = batch.column("vec_id").to_numpy(zero_copy_only=False)
            for rows, values in quantised(batch.column("embedding")):
                length = values.shape[1]
                if length not in sent.value:
                    continue
                if length not in groups:
                    keys, ids, m, least, axes = sent.value[length]
                    parts = [slice(a, a + _QUERIES) for a in range(0, len(ids), _QUERIES)]
                    groups[length] = [Group(keys[p], ids[p], m[p].astype(np.float64), axes, least[p], k) for p in parts]
                for a in range(0, len(rows), _CANDIDATES):
                    ids, others = every[rows[a : a + _CANDIDATES]].astype(np.int64), Turned(values[a : a + _CANDIDATES], sent.value[length][4])
                    for group in groups[length]:
                        group.meet(ids, others)
        for group in (g for found in groups.values() for g in found):
            best = group.best
            columns = [group.keys[best.row], group.ids[best.row], best.id, best.score]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.astype(np.int64)) for c in columns], names=["query_key", "query_id", "vec_id", "score"]
            )

    return run


def _sampled(rows: DataFrame, n: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and components of some vectors by length, about `n` in all and never more than twice as many."""
    total = rows.count()
    place = F.pmod(F.xxhash64("vec_id", F.lit(9)), F.lit(1 << 30))
    part = rows.filter(place < min(1.0, n / max(total, 1)) * (1 << 30)).limit(2 * n).toArrow()
    ids = part.column("vec_id").to_numpy()
    return {values.shape[1]: (ids[at].astype(np.int64), values) for at, values in quantised(part.column("embedding"))}


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES, sample: int = SAMPLE) -> DataFrame:
    """`query_id, rank, vec_id, score`: each query's k best of `vectors`; both are `(vec_id, embedding)`."""
    spark = vectors.sparkSession
    kind = "array<double>"
    rows = vectors.filter("vec_id IS NOT NULL").select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind))
    asked = queries.filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    asked = asked.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind))
    size = asked.agg(F.sum(16 + 8 * F.size("embedding"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    if blocks > 1:  # read once for all blocks
        path = folder(spark, "asked") + "/t"
        asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).write.partitionBy("block").parquet(path)
        asked = spark.read.parquet(path)
    known = _sampled(rows, sample)
    found, first = [], 0
    for block in range(blocks):
        part = asked if blocks == 1 else asked.filter(F.col("block") == block)
        part = part.select("vec_id", "embedding").orderBy("vec_id").toArrow()  # of bounded size
        ids = part.column("vec_id").to_numpy()
        held = {}
        for at, values in quantised(part.column("embedding")):
            length = values.shape[1]
            sampled, some = known.get(length, (np.empty(0, np.int64), np.empty((0, length))))
            own = ids[at].astype(np.int64)
            least = first_bounds(own, values, sampled, some, k)
            small = values.size == 0 or np.abs(values).max() < 1 << 15
            held[length] = (first + at, own, values.astype(np.int16) if small else values, least, principal_axes(some))
        first += len(ids)
        sent = spark.sparkContext.broadcast(held)
        near = map_batches(rows, _search(sent, k), "query_key long, query_id long, vec_id long, score long")
        if blocks == 1:
            found.append(near)
        else:
            found.append(cut(near))
            sent.unpersist()
    every = found[0]
    for more in found[1:]:
        every = every.unionAll(more)
    best = Window.partitionBy("query_key").orderBy(F.desc("score"), "vec_id")
    return (
        every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
