"""Sets of word shingles as sorted 64-bit hashes, for whole texts, vectorised over bytes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

_R = 0x9E3779B97F4A7C15 | 1
_R_INVERSE = pow(_R, -1, 1 << 64)
_SEGMENT = 1 << 19

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_R))
_FOLDED = _BYTE[_FOLD]
_ODD = mix(np.arange(300, 364, dtype=np.uint64)) | np.uint64(1)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    ones = np.full(_SEGMENT + 1, _R, np.uint64)
    ones[0] = 1
    back = np.full(_SEGMENT + 1, _R_INVERSE, np.uint64)
    back[0] = 1
    return np.cumprod(ones), np.cumprod(back)


def _hash_segment(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of `data`, in order."""
    raw = np.frombuffer(data, np.uint8)
    word = np.zeros(len(raw) + 2, bool)
    np.take(_WORD, raw, out=word[1:-1])
    edges = np.flatnonzero(word[1:] != word[:-1])
    start, end = edges[::2], edges[1::2]
    if not len(start):
        return np.empty(0, np.uint64), start
    ups, downs = _powers()
    sums = np.zeros(len(raw) + 1, np.uint64)
    weighed = np.take(_FOLDED, raw)
    weighed *= ups[: len(raw)]
    np.cumsum(weighed, out=sums[1:])
    return mix((sums[end] - sums[start]) * downs[start] + (end - start).astype(np.uint64) * _ODD[63:]), start


def _long_word(data: bytes) -> np.uint64:
    digest = hashlib.blake2b(_FOLD[np.frombuffer(data, np.uint8)].tobytes(), digest_size=8).digest()
    return np.frombuffer(digest, np.uint64)[0]


def word_hashes(data: bytes) -> np.ndarray:
    """Hashes of the words of one text of any length, in order."""
    if len(data) < _SEGMENT:
        return _hash_segment(data)[0]
    parts, at = [], 0
    while at < len(data):
        piece = data[at : at + _SEGMENT]
        if len(piece) == _SEGMENT:
            last = max(piece.rfind(s) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if last < 0:  # a word longer than a segment
                stops = [p for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (p := data.find(s, at)) >= 0]
                stop = min(stops, default=len(data))
                parts.append(np.array([_long_word(data[at:stop])], np.uint64))
                at = stop
                continue
            piece = piece[: last + 1]
        parts.append(_hash_segment(piece)[0])
        at += len(piece)
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingle_set(words: np.ndarray, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of `size` consecutive words; of all words as one where there are fewer."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    width = min(size, n)
    total = np.full(n - width + 1, _BYTE[width], np.uint64)
    for k in range(width):
        total += words[k : n - width + 1 + k] * _ODD[k : k + 1]
    return np.unique(mix(total))


def sets_of(texts: Iterable[str | None], size: int = 5) -> Iterator[np.ndarray]:
    """The shingle set of every text, in order. Small texts are hashed together."""
    waiting: list[bytes] = []
    held = 0

    def flush() -> Iterator[np.ndarray]:
        hashes, starts = _hash_segment(b" ".join(waiting))
        ends = np.cumsum([len(x) + 1 for x in waiting])
        bounds = np.concatenate(([0], np.searchsorted(starts, ends)))
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield shingle_set(hashes[a:b], size)

    for text in texts:
        data = (text or "").encode()
        if len(data) > _SEGMENT // 2:
            if waiting:
                yield from flush()
                waiting, held = [], 0
            yield shingle_set(word_hashes(data), size)
            continue
        if held + len(data) > _SEGMENT // 2:
            yield from flush()
            waiting, held = [], 0
        waiting.append(data)
        held += len(data) + 1
    if waiting:
        yield from flush()


def digest(shingles: np.ndarray) -> str:
    """128 bits that stand for the whole set, as hex text."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).hexdigest()
