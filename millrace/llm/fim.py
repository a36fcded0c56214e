r"""Fill-in-middle documents, cut by a piecewise-linear learned rank index over token boundaries.

Tokens are `[A-Za-z]+|[^A-Za-z]`, left to right over code points. Where a text of n tokens is cut comes from its id
alone: h1 to h4 are the first four groups of eight hex digits of the SHA-256 of `1:` and the decimal doc_id. The prefix ends after
the smaller of h1 % (n + 1) and h2 % (n + 1) tokens, the middle after the larger. One in ten documents, empty texts and texts that
hold a marker stay plain; of the others one in five is put suffix first (spm), the rest prefix first (psm).

The index maps a boundary's rank to its offset. All boundaries of a block of texts are fitted by a greedy run of
segments: a segment grows for as long as some line through its first boundary stays within `ERROR` bytes of all the others,
found with running least and greatest slopes over doubled stretches. Its slope and each boundary's residual, one signed
byte, are stored. A cut is looked up by its segment, predicted by the line and set right by its residual, which is exact.
A text's last boundary is the next one's first, so that ranks within a block are the texts' tokens counted on.

Blocks are whole texts of about `BLOCK` bytes, and a longer text is a block alone, with about 30 bytes of memory for each of
its own. Null texts count as empty and have no tokens. A null doc_id counts as empty decimal text. Repeated rows are
transformed alike. Other columns are not looked at. No documents give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches

ERROR = 127  # bytes; a residual is one signed byte
BLOCK = 8 << 20
PLAIN_FROM = 90  # of 100
SPM_BELOW = 20  # of 100
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_LETTER = np.zeros(256, dtype=bool)
_LETTER[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", dtype=np.uint8)] = True


class RankIndex:
    """Rank to offset, exact, over ascending `offsets`: segments of lines and a signed byte for each rank."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR) -> None:
        if not 0 <= error <= 127:
            raise ValueError("a residual is one signed byte")
        offsets = np.asarray(offsets, dtype=np.int64)
        firsts, slopes = _segments(offsets, error)
        self.firsts = np.array(firsts, dtype=np.int64)
        self.slopes = np.array(slopes, dtype=np.float64)
        self.bases = offsets[self.firsts]
        lengths = np.diff(np.append(self.firsts, len(offsets)))
        within = np.arange(len(offsets)) - np.repeat(self.firsts, lengths)
        lines = np.repeat(self.bases, lengths) + np.rint(np.repeat(self.slopes, lengths) * within).astype(np.int64)
        self.residuals = (offsets - lines).astype(np.int8)

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        """Offsets by the lines alone, at most the error off."""
        at = np.searchsorted(self.firsts, ranks, side="right") - 1
        return self.bases[at] + np.rint(self.slopes[at] * (ranks - self.firsts[at])).astype(np.int64)

    def offsets(self, ranks: np.ndarray) -> np.ndarray:
        return self.predict(ranks) + self.residuals[ranks]


def _segments(offsets: np.ndarray, error: int) -> tuple[list[int], list[float]]:
    """First ranks and slopes of the segments, each as long as a line through its first offset allows."""
    firsts, slopes = [], []
    begin, total, stretch = 0, len(offsets), 1024
    while begin < total:
        low, high, done = -np.inf, np.inf, 1
        while begin + done < total:
            steps = np.arange(done, min(done + stretch, total - begin))
            rise = offsets[begin + steps[0] : begin + steps[-1] + 1] - offsets[begin]
            least = np.maximum.accumulate(np.append(low, (rise - error) / steps))[1:]
            most = np.minimum.accumulate(np.append(high, (rise + error) / steps))[1:]
            # a hair's breadth of room, so that rounding never takes a line over its bound
            fits = int(np.argmax(np.append(least > most - 1e-9, True)))
            if fits:
                low, high = least[fits - 1], most[fits - 1]
            done += fits
            if fits < len(steps):
                break
            stretch = min(2 * stretch, 1 << 16)
        firsts.append(begin)
        slopes.append(0.0 if done == 1 else (low + high) / 2)
        stretch = min(max(64, done), 1 << 16)
        begin += done
    return firsts, slopes


def boundaries(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets where a token begins in the bytes of texts that begin at `starts`, and the last offset; also how many
    tokens lie before each text and at the end."""
    letter = _LETTER[data]
    begins = (data & 0xC0) != 0x80
    begins[1:] &= ~(letter[1:] & letter[:-1])
    texts = starts[starts < len(data)]
    begins[texts] = True
    offsets = np.append(np.flatnonzero(begins), len(data))
    return offsets, np.searchsorted(offsets, np.append(starts, len(data)))


def draws(doc_id: int | None) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else b"%d" % doc_id)).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in (0, 4, 8, 12))


def arranged(form: str, prefix: bytes, middle: bytes, suffix: bytes) -> bytes:
    if form == SPM:
        return b"".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return b"".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def _chars(data: bytes) -> int:
    return len(data) if data.isascii() else len(data.decode())


def transform_block(ids: list[int | None], texts: list[bytes], error: int = ERROR) -> Iterator[tuple]:
    """Rows of `SCHEMA` for some whole texts, by one index over all of their boundaries."""
    joined = b"".join(texts)
    starts = np.cumsum([0, *map(len, texts)])[:-1]
    offsets, before = boundaries(np.frombuffer(joined, dtype=np.uint8), starts)
    counts = np.diff(before)
    index = RankIndex(offsets, error)
    seeds = [draws(i) for i in ids]
    cuts = np.sort(np.array([[a % (n + 1), b % (n + 1)] for (a, b, _, _), n in zip(seeds, counts.tolist(), strict=True)]), axis=1)
    found = (index.offsets((cuts + before[:-1, None]).ravel()).reshape(-1, 2) - starts[:, None]).tolist()
    for i, text, n, (_, _, h3, h4), (first, second) in zip(ids, texts, counts.tolist(), seeds, found, strict=True):
        if not text or h3 % 100 >= PLAIN_FROM or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
            yield i, n, PLAIN, None, None, text
            continue
        form = SPM if h4 % 100 < SPM_BELOW else PSM
        prefix, middle = text[:first], text[first:second]
        yield i, n, form, _chars(prefix), _chars(middle), arranged(form, prefix, middle, text[second:])


def _blocks(rows: list[tuple[int | None, bytes]], size: int) -> Iterator[list[tuple[int | None, bytes]]]:
    block, held = [], 0
    for row in rows:
        if block and held + len(row[1]) > size:
            yield block
            block, held = [], 0
        block.append(row)
        held += len(row[1])
    if block:
        yield block


def fill_in_middle(docs: DataFrame, error: int = ERROR, block: int = BLOCK) -> DataFrame:
    """`doc_id, n, form, prefix_chars, middle_chars, output` of every row of `docs(doc_id, text)`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            texts = (b"" if t is None else t for t in batch.column("text").cast(pa.binary()).to_pylist())
            rows = list(zip(batch.column("doc_id").to_pylist(), texts, strict=True))
            for part in _blocks(rows, block):
                ids, held = zip(*part, strict=True)
                columns = list(zip(*transform_block(list(ids), list(held), error), strict=True))
                arrays = [pa.array(c, pa.binary() if t == pa.string() else t).cast(t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return map_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run, SCHEMA)


def restored(form: Column, output: Column) -> Column:
    """The text an output was made of. In a text without markers the first marker of each kind is the operator's own."""
    p, s, m = (F.locate(mark.decode(), output) for mark in (PREFIX, SUFFIX, MIDDLE))
    between = lambda a, b: output.substr(a + 3, b - a - 3)
    middle = output.substr(m + 3, F.length(output))
    psm = F.concat(between(p, s), middle, between(s, m))
    spm = F.concat(between(p, m), middle, between(s, p))
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)
