r"""Periodic runs of words by internal pattern matching: wavelet-tree range successors over a suffix array.

Words are `[^\x20\x09-\x0D]+`. A run is a stretch of words with smallest period q (words q apart are identical), of at least
`EXPONENT` * q and `LEAST` words, that no neighbouring word extends. All runs are found, exactly:

* Texts of a block are one sequence of symbols (text, word), so that nothing recurs across texts. Prefix doubling sorts its
  suffixes and, on the way, classes all stretches of 1, 2, 4 and so on words; only those in classes of several are sorted on.
* The sequence is cut into dyadic blocks, on every level m those of m words. A block's class is an interval of the suffix
  array, and a wavelet matrix over the array's values gives the interval's next value on either side of the block: its nearest
  occurrences. Those no more than m words away start a progression whose difference is a candidate period. A run of
  period q holds a whole block with q <= m < 2q, and that block's next occurrence to one side lies in the run, because
  the run has 4q words; it is q away, because the root of a run is primitive.
* Candidates are extended to both sides by binary lifting over the classes. Of equal stretches the smallest period holds.

Blocks are whole texts of about `BLOCK` words, the longer ones of an Arrow batch together; a longer text is a block alone. A
task needs about 8 bytes a word for each doubling and each bit of the longest text's length. Null and empty texts have no
words and no runs. A null doc_id is kept, and counts as empty text where repeats are planted. Repeated rows have equal
results. Other columns are not looked at. No documents give no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches

EXPONENT = 4
LEAST = 6
BLOCK = 1 << 18
RUN = "struct<start:bigint,length:bigint,period:bigint>"
SCHEMA = f"doc_id bigint, runs array<{RUN}>, collapsed string"


class RangeSuccessor:
    """A wavelet matrix over small whole numbers: counts and order statistics of ranges, for many ranges at once."""

    def __init__(self, values: np.ndarray, bits: int) -> None:
        self.levels = []
        for bit in range(bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            before = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(one, out=before[1:])
            self.levels.append((bit, before, len(values) - int(before[-1])))
            values = np.concatenate((values[~one], values[one]))

    def below(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values in [low, high) are less than x."""
        count = np.zeros(len(low), dtype=np.int32)
        for bit, before, zeros in self.levels:
            a, b = before[low], before[high]
            one = (x >> bit & 1).astype(bool)
            count += np.where(one, (high - low) - (b - a), 0)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return count

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest value in [low, high), counted from 0."""
        value = np.zeros(len(low), dtype=np.int32)
        for bit, before, zeros in self.levels:
            a, b = before[low], before[high]
            less = (high - low) - (b - a)
            one = n >= less
            n = np.where(one, n - less, n)
            value |= one.astype(np.int32) << bit
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return value

    def neighbours(self, low: np.ndarray, high: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The greatest value below x and the least above it in [low, high), which holds x; -1 where there is none."""
        rank = self.below(low, high, x)
        out = []
        for n in (rank - 1, rank + 1):
            there = (n >= 0) & (n < high - low)
            found = np.full(len(x), -1, dtype=np.int32)
            found[there] = self.nth(low[there], high[there], n[there])
            out.append(found)
        return out[0], out[1]


def _groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place and size of each one's group in sorted keys."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = False
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    firsts = np.flatnonzero(new)
    sizes = np.diff(np.append(firsts, len(new)))
    return np.repeat(firsts, sizes), np.repeat(sizes, sizes)


def doubled(symbols: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray], list[tuple[np.ndarray, ...]]]:
    """Suffix array; per level the class of the stretch of 2^level symbols at each place, as the least place of the class
    in the suffix array (and -1 behind the end); per level place, class and class size of aligned blocks that recur.

    Suffixes that agree in more symbols than the last level has are in any order.
    """
    total = len(symbols)
    suffixes = np.argsort(symbols, kind="stable").astype(np.int32)
    first, size = _groups(symbols[suffixes])
    classes = np.full(total + 1, -1, dtype=np.int32)
    classes[suffixes] = first
    open_, size = suffixes[size > 1], size[size > 1]
    levels, blocks, m = [classes], [], 1
    while True:
        aligned = open_ & (m - 1) == 0
        at = open_[aligned]
        blocks.append((at, classes[at], size[aligned].astype(np.int32)))
        if not len(open_) or 2 * m > longest:
            return suffixes, levels, blocks
        old = classes[open_].astype(np.int64)
        key = old * (total + 2) + classes[np.minimum(open_ + m, total)] + 1
        order = np.argsort(key)
        open_, old, key = open_[order], old[order], key[order]
        slots = old + np.arange(len(old)) - _groups(old)[0]
        suffixes[slots] = open_
        first, size = _groups(key)
        classes = classes.copy()
        classes[open_] = slots[first]
        levels.append(classes)
        open_, size = open_[size > 1], size[size > 1]
        m *= 2


def extended(levels: list[np.ndarray], at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far to the left and right of `at` symbols equal those a period on: first and end place of the equal ones."""
    left, right = at.copy(), at.copy()
    for level in range(len(levels) - 1, -1, -1):
        classes, m = levels[level], 1 << level
        right = np.where(classes[right] == classes[right + period], right + m, right)
        back = np.maximum(left - m, 0)
        same = (left >= m) & (classes[back] == classes[np.minimum(back + period, len(classes) - 1)])
        left = np.where(same, back, left)
    return left, right


def find_runs(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(start, end, period) of all runs in texts that begin at `starts`, by start and period; symbols of different
    texts differ."""
    total = len(symbols)
    lengths = np.diff(np.append(starts, total))
    longest = int(lengths.max(initial=0))
    if longest < LEAST:
        return np.zeros((0, 3), dtype=np.int64)
    origin = np.repeat(starts, lengths).astype(np.int32)
    suffixes, levels, blocks = doubled(symbols, longest)
    tree = RangeSuccessor(suffixes - origin[suffixes], max(1, (longest - 1).bit_length()))
    places, periods = [], []
    for level, (at, low, size) in enumerate(blocks):
        own = at - origin[at]
        before, after = tree.neighbours(low, low + size, own)
        for first, second in ((before, own), (own, after)):
            near = (first >= 0) & (second >= 0) & (second - first <= 1 << level)
            places.append(first[near] + origin[at[near]])
            periods.append(second[near] - first[near])
    at, period = np.concatenate(places), np.concatenate(periods)
    left, right = extended(levels, at, period)
    found = np.stack((left, right + period, period), axis=1).astype(np.int64)
    found = found[found[:, 1] - found[:, 0] >= np.maximum(LEAST, EXPONENT * found[:, 2])]
    found = np.unique(found, axis=0)
    # periods of a stretch beyond its smallest are multiples of that
    smallest = np.ones(len(found), dtype=bool)
    smallest[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[smallest]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def planted(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """In one document of ten words from a place on repeat a period; place and period come from the id's CRC-32."""
    h = zlib.crc32(b"" if doc_id is None else b"%d" % doc_id)
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def runs_of_block(texts: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """(start, length, period) of each text's runs, and the text with a single period of every run, for texts as words."""
    ids: defaultdict[bytes, int] = defaultdict()
    ids.default_factory = ids.__len__
    lengths = np.array([len(words) for words in texts], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    words_in = np.fromiter((ids[w] for words in texts for w in words), dtype=np.int64, count=int(lengths.sum()))
    symbols = np.repeat(np.arange(len(texts)), lengths) * len(ids) + words_in
    found = find_runs(symbols, starts)
    gone = np.zeros(len(symbols) + 1, dtype=np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 1], -1)
    kept = np.cumsum(gone)[:-1] == 0
    bounds = np.searchsorted(found[:, 0], np.append(starts, len(symbols)))
    for words, start, first, last in zip(texts, starts.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if first == last:
            yield [], b" ".join(words)
            continue
        stays = np.flatnonzero(kept[start : start + len(words)]).tolist()
        yield [(a - start, b - a, q) for a, b, q in found[first:last].tolist()], b" ".join([words[k] for k in stays])


def _blocks(rows: list[tuple[int | None, list[bytes]]], size: int) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    block, held = [], 0
    for row in sorted(rows, key=lambda row: len(row[1])):
        if block and held + len(row[1]) > size:
            yield block
            block, held = [], 0
        block.append(row)
        held += len(row[1])
    if block:
        yield block


def periodic_runs(docs: DataFrame, plant: bool = False, block: int = BLOCK) -> DataFrame:
    """`doc_id, runs, collapsed` of every row of `docs(doc_id, text)`, runs by start and period; with `plant` of the
    text after `planted`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        for batch in batches:
            rows = []
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                words = [] if t is None else t.split()  # of bytes: at exactly the white space above
                rows.append((i, planted(words, i) if plant else words))
            for part in _blocks(rows, block):
                runs, texts = zip(*runs_of_block([words for _, words in part]), strict=True)
                named = [[{"start": a, "length": n, "period": q} for a, n, q in found] for found in runs]
                arrays = [pa.array([i for i, _ in part], pa.int64()), pa.array(named, kind), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "runs", "collapsed"])

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)


def longest_run(runs: Column) -> Column:
    """The run with the greatest length, of these the first, of these that of the smallest period. Null if there is none."""
    ranked = F.transform(runs, lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"], r.alias("run")))
    return F.array_max(ranked)["run"]
