"""Document quality by a byte-level convolutional network, trained and run in numpy.

A filter is a table of weights for every byte value at each of `WIDTH` positions. A text's bytes are cut into
chunks of `CHUNK` bytes that overlap by a quarter and together cover all of it; in every chunk each filter keeps its
largest response (max-pooling, then a rectifier). The chunks' outputs go through a hidden layer, chunk by chunk,
and the mean, the largest and the least of each hidden unit over a document's chunks are combined into one
probability.

Training takes a bounded sample: about `rows_per_class` labelled documents of either class, by a hash of the
key, and all chunks of each, as scoring does. The sample's classes are weighted back to their shares, so that scores are
probabilities. Training runs on the executors: the sample is dealt into at most `PARTS` parts of about `PART_ROWS` documents
or more, in every round each part improves the round's network by `PASSES` passes over its documents, and the driver takes a step
towards the mean of the parts' networks, with momentum. Which document is in which part, and in which order, follows from keys alone, so reruns agree.

Of several rows with one doc_id one text teaches, and a label counts as often as it occurs. A null or empty text is scored as one blank chunk. Labels other than 0 and 1 teach nothing; with one class alone the
score is its label, with none a half. Repeated rows get equal scores; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, held_out, map_batches, ship

WIDTH, FILTERS, HIDDEN = 6, 24, 16
STEP = 64  # chunks begin at every third multiple of it and are four long
CHUNK = 4 * STEP
STRIDE = 3 * STEP
ROWS_PER_CLASS = 4_000
PARTS, PART_ROWS = 8, 500
ROUNDS, PASSES = 8, 2  # a part passes over its documents so many times in each round
BATCH, RATE = 16, 0.02
ROUND_STEP, MOMENTUM = 0.7, 0.6  # of the step that a round takes, with those before it
CUT = 0.3
_PIECE = 1 << 19
_CHUNKS = 512  # looked at together in training


def chunk_count(length: int) -> int:
    return max(1, -(-(length - STEP) // STRIDE))


def _padded(data: bytes) -> np.ndarray:
    """Bytes with blanks up to the end of the last chunk and a filter's width beyond."""
    size = chunk_count(len(data)) * STRIDE + STEP
    out = np.full(size + WIDTH - 1, 32, np.uint8)
    out[: len(data)] = np.frombuffer(data, np.uint8)
    return out


@dataclass
class Network:
    filters: np.ndarray  # WIDTH x 256 x FILTERS
    bias: np.ndarray
    hidden: np.ndarray  # FILTERS x HIDDEN
    hidden_bias: np.ndarray
    last: np.ndarray  # 3 * HIDDEN
    last_bias: np.ndarray

    @classmethod
    def fresh(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        return cls(
            rng.normal(0, 0.3, (WIDTH, 256, FILTERS)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            rng.normal(0, 0.3, (FILTERS, HIDDEN)).astype(np.float32),
            np.full(HIDDEN, 0.1, np.float32),
            rng.normal(0, 0.1, 3 * HIDDEN).astype(np.float32),
            np.zeros(1, np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.filters, self.bias, self.hidden, self.hidden_bias, self.last, self.last_bias]

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Largest response of each filter in every run of `STEP` bytes of `data` (a multiple and WIDTH - 1 more)."""
        n = len(data) - WIDTH + 1
        total = np.take(self.filters[0], data[:n], axis=0)
        for k in range(1, WIDTH):
            total += np.take(self.filters[k], data[k : n + k], axis=0)
        return total.reshape(n // STEP, STEP, FILTERS).max(axis=1)

    def chunks(self, data: np.ndarray) -> np.ndarray:
        """Pooled responses of a padded text's chunks, worked out in pieces."""
        out, whole = [], len(data) - WIDTH + 1
        for at in range(0, max(whole - STEP, 1), _PIECE // STRIDE * STRIDE):
            end = min(at + _PIECE // STRIDE * STRIDE + STEP, whole)
            runs = self.responses(data[at : end + WIDTH - 1])
            n = (len(runs) - 1) // 3
            head = runs[: 3 * n].reshape(n, 3, FILTERS).max(axis=1)
            out.append(np.maximum(head, runs[3 : 3 * n + 1 : 3]))
        return np.concatenate(out)

    def _combined(self, pooled: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        hidden = np.maximum(np.maximum(pooled + self.bias, 0) @ self.hidden + self.hidden_bias, 0)
        counts = np.diff(np.append(bounds, len(pooled)))[:, None]
        return np.concatenate(
            [
                np.add.reduceat(hidden, bounds) / counts,
                np.maximum.reduceat(hidden, bounds),
                np.minimum.reduceat(hidden, bounds),
            ],
            axis=1,
        )

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The probability of label 1 for each text."""
        scores = np.empty(len(texts))
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end]) < _PIECE // 2):
                size += len(texts[end]) + CHUNK
                end += 1
            padded = [_padded(t) for t in texts[at:end]]
            if len(padded) == 1:
                pooled, bounds = self.chunks(padded[0]), np.array([0])
            else:  # runs of all texts at once, with a blank one after each, so that none sees the next text
                sizes = [(len(p) - WIDTH + 1) // STEP for p in padded]
                blank = np.full(STEP, 32, np.uint8)
                data = np.concatenate([x for p, n in zip(padded, sizes, strict=True) for x in (p[: n * STEP], blank)])
                runs = self.responses(np.append(data, blank[: WIDTH - 1]))
                starts = np.concatenate(([0], np.cumsum(np.array(sizes) + 1)[:-1]))
                first = np.concatenate([s + 3 * np.arange((n - 1) // 3) for s, n in zip(starts, sizes, strict=True)])
                pooled = np.maximum(np.maximum(runs[first], runs[first + 1]), np.maximum(runs[first + 2], runs[first + 3]))
                bounds = np.concatenate(([0], np.cumsum([(n - 1) // 3 for n in sizes])[:-1]))
            logit = self._combined(pooled, bounds) @ self.last + self.last_bias
            scores[at:end] = 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))
            at = end
        return scores

    def _best(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter in each chunk, and where it is."""
        n = windows.shape[1] - WIDTH + 1
        total = np.take(self.filters[0], windows[:, :n], axis=0)
        for k in range(1, WIDTH):
            total += np.take(self.filters[k], windows[:, k : n + k], axis=0)
        where = total.argmax(axis=1)
        return np.take_along_axis(total, where[:, None, :], axis=1)[:, 0], where

    def gradients(self, windows: np.ndarray, bounds: np.ndarray, label: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        """Of the weighted logistic loss; `windows` are the documents' chunks, bytes with WIDTH - 1 more."""
        pooled, where = (np.concatenate(x) for x in zip(*(self._best(windows[at : at + _CHUNKS]) for at in range(0, len(windows), _CHUNKS))))
        active = np.maximum(pooled + self.bias, 0)
        hidden = np.maximum(active @ self.hidden + self.hidden_bias, 0)
        counts = np.diff(np.append(bounds, len(windows)))
        owner = np.repeat(np.arange(len(bounds)), counts)
        high, low = np.maximum.reduceat(hidden, bounds), np.minimum.reduceat(hidden, bounds)
        features = np.concatenate([np.add.reduceat(hidden, bounds) / counts[:, None], high, low], axis=1)
        logit = features @ self.last + self.last_bias
        error = (weight * (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - label) / weight.sum()).astype(np.float32)
        mean, top, least = np.split(error[:, None] * self.last, 3, axis=1)
        back = mean[owner] / counts[owner, None]
        for extreme, share in ((high, top), (low, least)):
            hit = hidden == extreme[owner]
            back += np.where(hit, share[owner] / np.maximum(np.add.reduceat(hit, bounds, dtype=np.int64), 1)[owner], 0)
        back = back * (hidden > 0)
        to_pool = (back @ self.hidden.T) * (active > 0)
        filters = np.zeros_like(self.filters)
        row, column = np.nonzero(to_pool)
        at = where[row, column]
        for k in range(WIDTH):
            np.add.at(filters[k], (windows[row, at + k], column), to_pool[row, column])
        return [filters, to_pool.sum(axis=0), active.T @ back, back.sum(axis=0), error @ features, np.array([error.sum()])]


def _windows(text: bytes) -> np.ndarray:
    """All chunks of a text, with WIDTH - 1 bytes more, as views."""
    return np.lib.stride_tricks.sliding_window_view(_padded(text), CHUNK + WIDTH - 1)[::STRIDE][: chunk_count(len(text))]


def begun(share: float, seed: int = 7) -> Network:
    """An untrained network that gives every text about the probability `share`."""
    net = Network.fresh(seed)
    net.last_bias[:] = np.log(share / (1 - share))
    return net


def improve(net: Network, texts: list[bytes], labels: np.ndarray, weights: np.ndarray, turn: int, turns: int) -> Network:
    """The network after some more passes over the texts, in the `turn`-th round of `turns`."""
    net = Network(*[p.copy() for p in net.parts()])
    every = [_windows(t) for t in texts]
    first = [np.zeros_like(p) for p in net.parts()]
    second = [np.zeros_like(p) for p in net.parts()]
    rng = np.random.default_rng(turn)
    order = np.concatenate([rng.permutation(len(texts)) for _ in range(PASSES)])
    for step, at in enumerate(range(0, len(order), BATCH), start=1):
        pick = order[at : at + BATCH]
        bounds = np.concatenate(([0], np.cumsum([len(every[i]) for i in pick])[:-1]))
        grads = net.gradients(np.concatenate([every[i] for i in pick]), bounds, labels[pick], weights[pick])
        rate = RATE * (1 - (turn + at / len(order)) / turns)
        for p, g, a, b in zip(net.parts(), grads, first, second, strict=True):
            g = g + 1e-5 * p
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


def stepped(net: Network, nets: list[Network], weights: list[int], speed: list[np.ndarray]) -> Network:
    """The round's network moved towards the mean of its parts' networks; `speed` is what is left of earlier rounds' moves."""
    share = np.array(weights) / sum(weights)
    moved = []
    for p, parts, v in zip(net.parts(), zip(*(n.parts() for n in nets), strict=True), speed, strict=True):
        move = sum(w * x for w, x in zip(share, parts, strict=True)) - p
        v *= MOMENTUM
        v += move
        moved.append((p + ROUND_STEP * (move + MOMENTUM * v)).astype(np.float32))
    return Network(*moved)


def fit(texts: list[bytes], labels: np.ndarray, weights: np.ndarray, turns: int = ROUNDS) -> Network | float:
    """A network for the labelled texts as one part, or the one label there is, or a half."""
    if not len(texts):
        return 0.5
    if labels.min() == labels.max():
        return float(labels[0])
    net = begun((weights * labels).sum() / weights.sum())
    for turn in range(turns):
        net = improve(net, texts, labels, weights, turn, turns)
    return net


def _turn(sent, turn: int):
    """One part's pass: the number of its documents and its network."""

    def run(part: pa.Table) -> pa.Table:
        rows = part.sort_by([("doc_id", "ascending"), ("quality", "ascending")])
        texts = [t.as_py() for t in rows.column("text")]
        labels, weights = (rows.column(c).to_numpy().astype(np.float64) for c in ("quality", "weight"))
        net = improve(sent.value, texts, labels, weights, turn, ROUNDS)
        columns = {"part": [rows.column("part")[0].as_py()], "n": [len(texts)], "parts": [[p.tobytes() for p in net.parts()]]}
        return pa.table(columns, pa.schema([("part", pa.int32()), ("n", pa.int64()), ("parts", pa.list_(pa.binary()))]))

    return run


def _sample(docs: DataFrame, labels: DataFrame, rows_per_class: int) -> DataFrame:
    """`doc_id, quality, weight, text` of about `rows_per_class` labelled documents of either class.

    The labels are sampled first: what is broadcast is a row for each sampled key and label, however often they occur.
    """
    known = labels.filter("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id", F.col("quality").cast("int").alias("quality"))
    known = known.agg(F.count(F.lit(1)).alias("times"))
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(3)), F.lit(1 << 30))
    rate = {k: min(1.0, rows_per_class / n) for k, n in counts.items()}
    part = F.when(F.col("quality") == 1, rate.get(1, 0.0)).otherwise(rate.get(0, 0.0))
    sample = known.filter(place < part * (1 << 30)).withColumn("weight", F.col("times") / part)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    chosen = docs.select("doc_id", text.alias("text")).join(F.broadcast(sample), "doc_id")
    one = chosen.groupBy(F.col("doc_id").cast("long").alias("doc_id"), "quality").agg(F.max("text").alias("text"), F.max("weight").alias("weight"))
    return one.select("doc_id", "quality", "weight", F.col("text").cast("binary").alias("text"))


def train(docs: DataFrame, labels: DataFrame, rows_per_class: int = ROWS_PER_CLASS) -> Network | float:
    """From `docs(doc_id, text)` and `labels(doc_id, quality)`. To the driver comes one network a part and round."""
    spark = docs.sparkSession
    rows = cut(_sample(docs, labels, rows_per_class))
    told = {r["quality"]: (r["n"], r["weight"]) for r in rows.groupBy("quality").agg(F.count(F.lit(1)).alias("n"), F.sum("weight").alias("weight")).collect()}
    if len(told) < 2:
        return float(next(iter(told), 0.5))
    n_parts = min(PARTS, max(1, sum(n for n, _ in told.values()) // PART_ROWS))
    part = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(n_parts)).cast("int")
    parts = rows.withColumn("part", part).groupBy("part")
    ship(spark)
    net = begun(told[1][1] / (told[0][1] + told[1][1]))
    speed = [np.zeros(p.shape) for p in net.parts()]
    for turn in range(ROUNDS):
        sent = spark.sparkContext.broadcast(net)
        found = parts.applyInArrow(_turn(sent, turn), "part int, n long, parts array<binary>").collect()
        found = sorted(found, key=lambda r: r["part"])
        shaped = [Network(*[np.frombuffer(x, p.dtype).reshape(p.shape) for x, p in zip(r["parts"], net.parts(), strict=True)]) for r in found]
        net = stepped(net, shaped, [r["n"] for r in found], speed)
        sent.unpersist()
    return net


def _score(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            texts = [(x.as_py() or "").encode() for x in batch.column("text")]
            scores = net.score(texts) if isinstance(net, Network) else np.full(len(texts), net)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    return run


def score(docs: DataFrame, net: Network | float, cut: float = CUT) -> DataFrame:
    """`doc_id, held_out, score, predicted` for every row of `docs(doc_id, text)`. The network's size is fixed."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(net)
    scored = map_batches(rows, _score(sent), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= cut).cast("int"))
