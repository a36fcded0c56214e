"""Packing documents into token windows with lexically close neighbours (sharded BM25).

A document's signature is one of its ids and a hash of five running ones. The id is the least of a hash that favours
high ids, which byte pair vocabularies give to rare tokens, so that two documents share it as probably as their bags
are alike (weighted min-hash); the other part is the least hash of all runs of five, which tells documents of the same
few ids apart and keeps near copies together. A bounded sample of documents says how signatures are spread and how many ids there are; by it, documents
are dealt in order of signature to tasks of about `shard_tokens` ids to be looked up, by the id
alone where that gives tasks of like size. A signature that alone is too large is spread over its share by a hash of doc_id and text.

A task tokenises its part of the documents; after the shuffle a task packs one shard. Whole windows of a long
document become sequences of their own at once. The rest of every document is indexed: BM25 weights of ids that many
members hold are rows over all members, those of other ids inverted lists. A window begins with a seed; all its ids
score the documents of the shard not used yet, which are placed in order of score as long as they fit, however many
they are. What room then is left is filled with the head of the best one that did not fit, and the rest of that
document is the seed of the next window, so that windows are full. A task that gets more than one and a half times
`shard_tokens` goes on with a second shard, the window open at the end of the first goes on in it; only the last
window of a task is padded.

A null or empty text is the end id alone. Rows that repeat a doc_id are packed one by one; rows alike in both columns
go to one task. No rows give no rows. Texts of any length are read whole. Columns other than `doc_id` and `text` are not
looked at. The sequence numbers depend on the sample, as does which documents meet; a rerun over the same files
gives the same rows.
"""

from __future__ import annotations

import json
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, shuffle_partitions

WINDOW = 2048
END_ID = 1
SHARD_TOKENS = 8_000_000
SAMPLE = 4_000
K1, B = 1.2, 0.75
_COMMON = 8  # an id that one member in so many holds has a row over all of them
_RUN = 5
_LONG = 1 << 20
_SAFE_CUT = regex.compile(r"(?<=[A-Za-z])(?= [A-Za-z])")
_WHITE_RUN = regex.compile(r"\s\s")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def _vocabulary(file: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Ranks of a vocabulary's tokens, and its special tokens."""
    with open(file, encoding="utf-8") as opened:
        spec = json.load(opened)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    of = _byte_of_char()
    return {bytes(of[c] for c in token): k for token, k in spec["model"]["vocab"].items() if token not in special}, special


@lru_cache(maxsize=2)
def _encoding(vocabulary: str, ahead: bool = False):
    """The vocabulary's encoding; the same without a look ahead, for texts without runs of white space.

    The pattern looks ahead only to leave the last character of a white run to the next word. Without such runs that
    branch decides nothing, and a pattern without it is matched in one pass.
    """
    import public_tokenizers
    import tiktoken

    pattern, branch = public_tokenizers.PATTERN, r"\s+(?!\S)|"
    if not ahead and pattern.endswith(branch + r"\s+"):
        pattern = pattern.replace(branch, "")
    ranks, special = _vocabulary(vocabulary)
    return tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)


def token_ids(text: str | None, vocabulary: str) -> np.ndarray:
    """The vocabulary's ids of the whole text; no ids are added."""
    if not text:
        return np.empty(0, np.uint32)
    if any(s in text for s in _vocabulary(vocabulary)[1]):
        return np.array(_encoding(vocabulary, True).encode(text, allowed_special="all"), np.uint32)
    encoding = _encoding(vocabulary, _WHITE_RUN.search(text) is not None)
    parts, at = [], 0
    while len(text) - at > _LONG and (found := _SAFE_CUT.search(text, at + _LONG)):
        parts.append(_encoded(encoding, text[at : found.start()]))
        at = found.start()
    parts.append(_encoded(encoding, text[at:] if at else text))
    return np.concatenate(parts) if at else parts[0]


def _encoded(encoding, text: str) -> np.ndarray:
    try:
        return encoding.encode_to_numpy(text, disallowed_special=())
    except UnicodeEncodeError:  # half a surrogate pair
        return np.array(encoding.encode_ordinary(text), np.uint32)


class LexicalShard:
    """BM25 over bags of ids, with members that can be taken out."""

    def __init__(self, bags: list[np.ndarray]) -> None:
        n = len(bags)
        lengths = np.array([len(b) for b in bags], np.float64)
        terms, counts = [], []
        for bag in bags:
            own, count = np.unique(bag, return_counts=True)
            terms.append(own)
            counts.append(count.astype(np.float32))
        member = np.repeat(np.arange(n, dtype=np.int32), [len(t) for t in terms])
        term = np.concatenate(terms) if n else np.empty(0, np.uint32)
        tf = np.concatenate(counts) if n else np.empty(0, np.float32)
        del terms, counts
        narrow = np.uint16 if len(term) == 0 or term.max() < 1 << 16 else np.uint32
        order = np.argsort(term.astype(narrow, copy=False), kind="stable")
        term, member, tf = term[order], member[order], tf[order]
        del order
        self.terms, starts = np.unique(term, return_index=True)
        bounds = np.append(starts, len(term))
        del term
        df = np.diff(bounds)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        norm = (K1 * (1 - B + B * lengths / max(lengths.mean(), 1)) if n else lengths).astype(np.float32)
        weight = tf * np.float32(K1 + 1)
        tf += norm[member]
        weight /= tf
        del tf
        weight *= np.repeat(idf.astype(np.float32), df)
        common = df * _COMMON >= n
        self.row = np.where(common, np.cumsum(common) - 1, -1)
        self.rows = np.zeros((int(common.sum()), n), np.float32)
        for k in np.flatnonzero(common):
            held = slice(bounds[k], bounds[k + 1])
            self.rows[self.row[k], member[held]] = weight[held]
        rare = ~np.repeat(common, df)
        self.member, self.weight = member[rare], weight[rare]
        self.bounds = np.append(0, np.cumsum(np.where(common, 0, df)))
        self.unused = np.ones(n, bool)
        self.listed = np.arange(n)  # members that rows and lists still hold, by their place there
        self._next = 0

    def _compact(self) -> None:
        """Leave used members out of rows and lists."""
        live = self.unused[self.listed]
        place = np.cumsum(live) - 1
        self.listed, self.rows = self.listed[live], np.compress(live, self.rows, axis=1)
        held = live[self.member]
        self.bounds = np.append(0, np.cumsum(held))[self.bounds]
        self.member, self.weight = place[self.member[held]].astype(np.int32), self.weight[held]

    def scores(self, bag: np.ndarray) -> np.ndarray:
        """Scores by all ids of the bag, of the members in `listed`; 0 for those used or without an id of it."""
        if 4 * np.count_nonzero(self.unused) < 3 * len(self.listed):
            self._compact()
        ids = np.unique(bag)
        at = np.searchsorted(self.terms, ids)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == ids)] if len(self.terms) else at[:0]
        row = self.row[at]
        lists = [slice(self.bounds[k], self.bounds[k + 1]) for k in at[row < 0].tolist()]
        score = np.zeros(len(self.listed), np.float32)
        if lists:
            member = np.concatenate([self.member[s] for s in lists])
            score += np.bincount(member, np.concatenate([self.weight[s] for s in lists]), len(score))
        for k in row[row >= 0].tolist():
            score += self.rows[k]
        score *= self.unused[self.listed]
        return score

    def neighbours(self, bag: np.ndarray) -> list[int]:
        """All unused members that share an id with the bag, in order of their score; ties in order of number."""
        score = self.scores(bag)
        found = np.flatnonzero(score > 0)
        return self.listed[found[np.argsort(-score[found], kind="stable")]].tolist()

    def any_unused(self) -> int | None:
        while self._next < len(self.unused) and not self.unused[self._next]:
            self._next += 1
        return self._next if self._next < len(self.unused) else None


class Packer:
    """Places pieces; remembers the open window. A piece: (document, start, ids, sequence, offset)."""

    def __init__(self, first: int, window: int) -> None:
        self.window, self._next = window, first
        self._sequence, self._offset = first, 0
        self._seed = np.empty(0, np.uint32)

    def _new(self) -> int:
        self._next += 1
        return self._next - 1

    def whole(self, document: object, ids: np.ndarray) -> Iterator[tuple]:
        """The full windows of a document, each a sequence of its own."""
        for at in range(0, len(ids) - self.window + 1, self.window):
            yield document, at, ids[at : at + self.window], self._new(), 0

    def _put(self, document: object, start: int, ids: np.ndarray) -> tuple:
        if self._offset == 0:
            self._sequence = self._new()
        piece = (document, start, ids, self._sequence, self._offset)
        self._offset = (self._offset + len(ids)) % self.window
        self._seed = ids
        return piece

    def rests(self, rests: list[tuple[object, int, np.ndarray]]) -> Iterator[tuple]:
        """Documents' rests, each shorter than a window, with their neighbours. The last window stays open."""
        shard = LexicalShard([r[2] for r in rests])
        lengths = np.array([len(r[2]) for r in rests], np.int64)
        tail: tuple[object, int, np.ndarray] | None = None
        while True:
            if tail is not None:  # the rest of a cut document begins this window
                piece, tail = tail, None
                yield self._put(*piece)
            elif self._offset == 0:
                first = shard.any_unused()
                if first is None:
                    return
                shard.unused[first] = False
                yield self._put(*rests[first])
            score = shard.scores(self._seed)
            sizes = lengths[shard.listed]
            while True:
                fitting = np.where(sizes <= self.window - self._offset, score, 0)
                at = int(fitting.argmax()) if len(fitting) else 0
                if len(fitting) == 0 or fitting[at] <= 0:
                    break
                score[at] = 0
                k = int(shard.listed[at])
                shard.unused[k] = False
                yield self._put(*rests[k])
                if self._offset == 0:
                    break
            if self._offset == 0:
                continue
            at = int(score.argmax()) if len(score) else 0
            k = int(shard.listed[at]) if len(score) and score[at] > 0 else shard.any_unused()
            if k is None:
                return
            shard.unused[k] = False
            document, start, ids = rests[k]
            room = self.window - self._offset
            if len(ids) > room:
                tail = (document, start + room, ids[room:])
            yield self._put(document, start, ids[:room])

    def pack(self, documents: list[np.ndarray]) -> Iterator[tuple]:
        """All pieces of a list of documents, which go by their number in it."""
        rests = []
        for k, ids in enumerate(documents):
            yield from self.whole(k, ids)
            if left := len(ids) % self.window:
                rests.append((k, len(ids) - left, ids[len(ids) - left :]))
        yield from self.rests(rests)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _draws(n: int) -> np.ndarray:
    """For every id below n: a fixed draw from an exponential distribution, whose rate is the id's number."""
    own = np.arange(1, n + 1, dtype=np.uint64)
    return -np.log(((_mixed(own) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / own.astype(np.float64)


def signature(ids: np.ndarray, n: int) -> int:
    """One of the ids, which are below n, and 42 bits of the least hash of five running ones."""
    wide = np.zeros(max(len(ids), _RUN), np.uint64)
    wide[: len(ids)] = ids
    runs = np.zeros(len(wide) - _RUN + 1, np.uint64)
    for k in range(_RUN):
        runs += wide[k : k + len(runs)]
        runs *= np.uint64(0x9E3779B97F4A7C15)
    least = _mixed(runs.min()[None])[0] >> np.uint64(22)
    return (int(ids[_draws(n)[ids].argmin()]) % (1 << 21) << 42) | int(least)


class Dealer:
    """Deals documents to tasks by signature, so that tasks get about equally many ids.

    Documents that agree in the id go to one task if those of the sample hold at most a quarter of a task's share.
    Else those that agree in the whole signature do. One that is still larger, and repeats in the sample, is spread
    over its share.
    """

    def __init__(self, signatures: np.ndarray, sizes: np.ndarray, tasks: int) -> None:
        order = np.argsort(signatures, kind="stable")
        self.signatures, self.tasks = signatures[order], tasks
        self.bounds = np.append(0.0, np.cumsum(sizes[order])) / max(float(sizes.sum()), 1.0) * tasks

    def place(self, mark: int, own: int) -> float:
        """From 0 to `tasks`; the whole part is the task. `own` is 32 bits of the document itself."""
        for shift in (42, 0):
            least = mark >> shift << shift
            a, b = np.searchsorted(self.signatures, [least, least + (1 << shift)])
            if self.bounds[b] - self.bounds[a] <= 0.25:
                break
        else:
            shift = -1
        if shift >= 0 or b - a < 2:  # one point for all that agree so far: of their own span or, if not sampled, of the one before
            own = zlib.crc32((mark >> max(shift, 0)).to_bytes(8, "little"))
            a = max(a - 1, 0) if a == b else a
        return min(float(self.bounds[a] + (self.bounds[b] - self.bounds[a]) * own / (1 << 32)), np.nextafter(self.tasks, 0))


def _signed(vocabulary: str, end_id: int, window: int):
    """Signatures, ids to be looked up and ids in whole windows, of sampled rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = max(_encoding(vocabulary).n_vocab, end_id + 1)
        for batch in batches:
            ids = [np.append(token_ids(t.as_py(), vocabulary), np.uint32(end_id)) for t in batch.column("text")]
            marks = pa.array([signature(i, n) for i in ids], pa.int64())
            rest, whole = (pa.array([f(len(i)) for i in ids], pa.int64()) for f in (lambda n: n % window, lambda n: n - n % window))
            yield pa.RecordBatch.from_arrays([marks, rest, whole], names=["mark", "rest", "whole"])

    return run


def _tokenise(vocabulary: str, end_id: int, dealer: Dealer):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = max(_encoding(vocabulary).n_vocab, end_id + 1)
        for batch in batches:
            places, counts, packed = [], [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = np.append(token_ids(text.as_py(), vocabulary), np.uint32(end_id)).astype("<u4", copy=False)
                data = (ids.astype("<u2") if n <= 1 << 16 else ids).tobytes()
                counts.append(len(ids))
                places.append(dealer.place(signature(ids, n), zlib.crc32(data, zlib.crc32(str(doc_id.as_py()).encode()))))
                packed.append(data)
            task = [int(p) for p in places]
            numbers = [pa.array(places, pa.float64()), pa.array(task, pa.int32()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *numbers, pa.array(packed, pa.binary())], names=["doc_id", "place", "task", "n", "ids"]
            )

    return run


def _rows(pieces: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Pieces as batches; a document is its doc_id and number of ids."""
    part: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = [
            pa.array([p[0][0] for p in part], pa.int64()),
            pa.array([p[1] for p in part], pa.int64()),
            pa.array([len(p[2]) for p in part], pa.int64()),
            pa.array([p[0][1] for p in part], pa.int64()),
            pa.array([p[3] for p in part], pa.int64()),
            pa.array([p[4] for p in part], pa.int64()),
            pa.array([p[2].astype("<u4").tobytes() for p in part], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

    for piece in pieces:
        part.append(piece)
        if len(part) == 1000:
            yield batch()
            part = []
    if part:
        yield batch()


def _run(window: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 32, window)
        for held in (_encoding, _vocabulary, _draws):  # the process may have tokenised before; its room is for the shard now
            held.cache_clear()

        def pieces() -> Iterator[tuple]:
            rests, held = [], 0
            for batch in batches:
                for doc_id, n, packed in zip(*(batch.column(c) for c in ("doc_id", "n", "ids")), strict=True):
                    data = packed.as_py()
                    ids = np.frombuffer(data, f"<u{len(data) // n.as_py()}")  # two bytes an id where the vocabulary allows
                    document, left = (doc_id.as_py(), len(ids)), len(ids) % window
                    yield from packer.whole(document, ids)
                    if left:
                        rests.append((document, len(ids) - left, ids[len(ids) - left :].copy()))
                    held += left
                    if held >= most:
                        yield from packer.rests(rests)
                        rests, held = [], 0
            yield from packer.rests(rests)

        return _rows(pieces())

    return run


def pack(
    docs: DataFrame,
    vocabulary: str | None = None,
    window: int = WINDOW,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
    sample: int = SAMPLE,
) -> DataFrame:
    """`doc_id, start, length, doc_tokens, sequence_id, offset, ids`, a row for each piece of `docs(doc_id, text)`.

    `ids` are unsigned little-endian 32-bit numbers; `vocabulary` is a file that every executor can open. About `sample`
    rows, twice as many at most, say how documents are dealt; all are packed. Where adaptive execution does not coalesce
    partitions there are at least as many tasks as shuffle partitions.
    """
    spark, file = docs.sparkSession, vocabulary or default_vocabulary()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    count = docs.count()
    some = rows.select("text") if count <= sample else rows.select("text").sample(sample / count, seed=0).limit(2 * sample)
    found = map_batches(some, _signed(file, end_id, window), "mark long, rest long, whole long").collect()
    marks, rests, wholes = (np.array([r[k] for r in found], np.int64) for k in range(3))
    tasks = max(1, math.ceil(rests.sum() / max(len(rests), 1) * count / shard_tokens))
    if spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled").lower() != "true":
        tasks = max(tasks, shuffle_partitions(spark))
    deal = _tokenise(file, end_id, Dealer(marks, rests + wholes / 2, tasks))  # whole windows only pass through
    tokens = map_batches(rows, deal, "doc_id long, place double, task int, n long, ids binary")
    dealt = tokens.repartitionById(tasks, "task").sortWithinPartitions("place", "doc_id", "ids").drop("place", "task")
    return map_batches(
        dealt,
        _run(window, max(3 * shard_tokens // 2, 1)),
        "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary",
    )
