"""Language identification by bit-sliced Bloom filters of character n-grams.

Training counts n-grams of letters and word boundaries per language in a sample of labelled rows, at
most about `rows_per_language` of each language, taken by a hash of the key. The commonest of each
language fill its Bloom filter. The filters are stored across: for every bit position one word with a bit
per language, so that the AND of an n-gram's few positions is the mask of all languages that have it.
A text's languages get the number of its n-grams whose mask has their bit, less the number that the
fill of the filter alone would give; the largest wins, a tie goes to the language with more labelled rows,
then to the smaller name.

How much of a language's own texts the filters know tells where its level lies. A text is strange to the language it scores
best in if the part of its n-grams that any language has is far below that of spared labelled rows, by the spread that as many
n-grams have (`Level`). So a text in two known languages is none, and a language whose alphabet is too large for a filter
to cover has a low level. The rule is one for texts of any length.

A text that is null or has no letter is `und` with score 0, as is any text if there is nothing to learn
from. Whole texts are read, in pieces. Repeated rows are judged alike; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import held_out, map_batches
from millrace.llm.shingles import mix

GRAM, WIDE_GRAM = 4, 2  # letters; the second where the first letter is one of a script of syllables or words
WIDE = 0x2E80  # such scripts begin here
ROWS_PER_LANGUAGE = 4_000
GRAMS_PER_LANGUAGE = 200_000
COVERAGE = 0.98
SLICES = 1 << 20  # for up to 1 / BITS_PER_GRAM of it in grams, doubled for more
BITS_PER_GRAM = 16
PROBES = 3
UNKNOWN = "und"
SPARED = 5  # one labelled row of so many teaches a language's level, the others its n-grams
LEAST_SPARED = 20  # a language with fewer rows has the level of all rows together, if they are as many
FAR = 5.0  # times as far below the median as the worst hundredth of a language's own texts
LEAST_BETWEEN = 0.0025  # variance of angles between texts: names, numbers and codes differ even in the plainest sample
_PIECE = 1 << 18


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_hashes(texts: list[str], size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all texts and, beside each, the number of its text.

    Lower case; what is no letter is a boundary, of which one stands between words and at either end. Where a letter is
    a syllable or a word there are thousands of them, and `WIDE_GRAM` of them say as much as `GRAM` of others.
    """
    codes = np.frombuffer("\0".join(f" {t} " for t in texts).lower().encode("utf-32-le", "replace"), np.uint32)
    codes = np.where(_letters()[codes], codes, np.where(codes == 0, 0, 32).astype(np.uint32))
    again = np.concatenate(([False], (codes[1:] == 32) & (codes[:-1] == 32)))
    codes = codes[~again]
    if len(codes) < size:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    wide = codes.astype(np.uint64)
    n = len(codes) - size + 1
    # 21 bits hold any code point; three fit a word, further ones are folded in
    total, clean = np.zeros(n, np.uint64), np.ones(n, bool)
    narrow = codes[:n] < WIDE
    some_wide = not narrow.all()
    for k in range(size):
        more = (mix(total) if k == 3 else total) * np.uint64(1 << 21) + wide[k : n + k]
        unbroken = clean & (codes[k : n + k] != 0)
        if some_wide and k >= WIDE_GRAM:
            more, unbroken = np.where(narrow, more, total), np.where(narrow, unbroken, clean)
        total, clean = more, unbroken
    owner = np.cumsum(codes == 0)[:n]
    return mix(total)[clean], owner[clean]


def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts in groups of bounded length with their numbers; a long text in pieces that overlap."""
    rows, held, size = [], [], 0
    for i, text in enumerate(texts):
        text = (text or "").replace("\0", " ")
        for at in range(0, max(1, len(text)), _PIECE):
            part = text[max(0, at - GRAM + 1) : at + _PIECE]
            if size + len(part) > _PIECE and held:
                yield rows, held
                rows, held, size = [], [], 0
            rows.append(i)
            held.append(part)
            size += len(part)
    if held:
        yield rows, held


@dataclass(frozen=True)
class Level:
    """Where the known parts of a language's own texts lie, as angles (a part is the squared sine of half of one): mean and
    variance between texts, and how many spreads below the mean is strange.

    The angle of a text of n n-grams spreads by its topic and, the less the more n-grams there are, by chance. Neighbouring
    n-grams overlap, so that chance is that of n / `GRAM` draws.
    """

    mean: float
    between: float
    strange: float

    @staticmethod
    def _away(scores: np.ndarray, n: np.ndarray, mean: float, between: float) -> np.ndarray:
        return (2 * np.arcsin(np.sqrt(scores)) - mean) / np.sqrt(between + GRAM / np.maximum(n, 1))

    @classmethod
    def of(cls, scores: np.ndarray, n: np.ndarray) -> Level:
        angles = 2 * np.arcsin(np.sqrt(scores))
        mean = float(np.average(angles, weights=np.minimum(n, 1000)))
        between = max(LEAST_BETWEEN, float(np.mean((angles - mean) ** 2 - GRAM / np.maximum(n, 1))))
        middle, worst = np.quantile(cls._away(scores, n, mean, between), [0.5, 0.01])
        return cls(mean, between, float(middle - FAR * (middle - worst)))

    def holds(self, scores: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self._away(scores, n, self.mean, self.between) >= self.strange


@dataclass
class GramFilters:
    languages: list[str]
    masks: np.ndarray  # slices x words of 64 languages
    false_rate: np.ndarray
    levels: dict[str, Level] = field(default_factory=dict)

    @staticmethod
    def _places(grams: np.ndarray, slices: int) -> list[np.ndarray]:
        step = mix(grams) | np.uint64(1)
        return [((grams + np.uint64(k) * step) % np.uint64(slices)).astype(np.int64) for k in range(PROBES)]

    @classmethod
    def build(cls, grams: dict[str, np.ndarray], rows: dict[str, int] | None = None, slices: int | None = None) -> GramFilters:
        if slices is None:
            most = BITS_PER_GRAM * max((len(g) for g in grams.values()), default=0)
            slices = max(SLICES, 1 << max(0, most - 1).bit_length())
        languages = sorted(grams, key=lambda x: (-(rows or {}).get(x, 0), x))
        masks = np.zeros((slices, max(1, -(-len(languages) // 64))), np.uint64)
        fill = []
        for k, language in enumerate(languages):
            bit = np.uint64(1) << np.uint64(k % 64)
            for place in cls._places(grams[language], slices):
                masks[place, k // 64] |= bit
            fill.append(np.count_nonzero(masks[:, k // 64] & bit) / slices)
        return cls(languages, masks, np.array(fill) ** PROBES)

    def having(self, grams: np.ndarray) -> np.ndarray:
        """For every n-gram the words whose bits are the languages that contain it."""
        places = self._places(grams, len(self.masks))
        found = self.masks[places[0]]
        for place in places[1:]:
            found &= self.masks[place]
        return found

    def shares(self, texts: list[str | None]) -> np.ndarray:
        """Texts x languages: the part of a text's n-grams that the language has, false ones taken off."""
        return self.looked_up(texts)[0]

    def looked_up(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The shares; the part of each text's n-grams that any language has, false ones taken off; the number of n-grams."""
        hits = np.zeros((len(texts), len(self.languages)))
        known = np.zeros(len(texts))
        totals = np.zeros(len(texts))
        for rows, parts in _pieces(texts):
            grams, owner = gram_hashes(parts)
            if not len(grams):
                continue
            found, row = self.having(grams), np.array(rows)
            totals += np.bincount(row[owner], minlength=len(texts))
            known += np.bincount(row[owner[found.any(axis=1)]], minlength=len(texts))
            for k in range(len(self.languages)):
                bit = (found[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)
                hits[:, k] += np.bincount(row[owner[bit.astype(bool)]], minlength=len(texts))
        parts = np.maximum(totals, 1)
        shares = (hits / parts[:, None] - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9)
        any_false = 1 - np.prod(1 - self.false_rate)
        return np.clip(shares, 0, 1), np.clip((known / parts - any_false) / max(1 - any_false, 1e-9), 0, 1), totals


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        for rows, parts in _pieces(texts):
            grams, owner = gram_hashes(parts)
            names = sorted({langs[i] for i in rows})
            number = np.array([names.index(langs[i]) for i in rows])
            for k, name in enumerate(names):
                found, count = np.unique(grams[number[owner] == k], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(count.astype(np.int64))],
                    names=["lang", "gram", "count"],
                )


def train(
    labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE, grams_per_language: int = GRAMS_PER_LANGUAGE
) -> GramFilters:
    """Filters from `labelled(doc_id, text, lang)`; rows without text or language teach nothing.

    To the driver go the names of languages with their counts, and at most `grams_per_language` of each.
    """
    rows = labelled.filter("text IS NOT NULL AND lang IS NOT NULL")
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(1 << 30))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return GramFilters.build({})
    rate = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, rows_per_language / n)))])
    sample = rows.filter(place < rate[F.col("lang")] * (1 << 30)).select("lang", "text")
    counted = map_batches(sample, _count, "lang string, gram long, count long")
    total = counted.groupBy("lang", "gram").agg(F.sum("count").alias("count"))
    whole = Window.partitionBy("lang")
    order = whole.orderBy(F.desc("count"), "gram")
    before = F.sum("count").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("count")
    ranked = total.withColumns({"place": F.row_number().over(order), "before": before, "all": F.sum("count").over(whole)})
    top = ranked.filter((F.col("place") <= grams_per_language) & (F.col("before") < COVERAGE * F.col("all")))
    kept = top.groupBy("lang").agg(F.collect_list("gram").alias("grams"))
    return GramFilters.build({r["lang"]: np.array(r["grams"], np.int64).view(np.uint64) for r in kept.collect()}, counts)


def _known_parts(sent):
    """The part of each labelled text that the filters know, and its number of n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, known, n = sent.value.looked_up(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(known), pa.array(n)], names=["lang", "score", "n"])

    return run


def learn(labelled: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> GramFilters:
    """Filters as `train` has them, with levels from one row of `SPARED`, which is not among those that teach n-grams.

    To the driver go two numbers for each of at most about `rows_per_language` spared rows a language.
    """
    spare = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(11)), F.lit(SPARED)) == 0
    filters = train(labelled.filter(~spare), rows_per_language)
    rows = labelled.filter(spare & F.col("text").isNotNull() & F.col("lang").isin(filters.languages)).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return filters
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), F.lit(1 << 30))
    rate = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, rows_per_language / n)))])
    sample = rows.filter(place < rate[F.col("lang")] * (1 << 30)).select("lang", "text")
    sent = labelled.sparkSession.sparkContext.broadcast(filters)
    own = map_batches(sample, _known_parts(sent), "lang string, score double, n double").filter("n > 0").toPandas()
    if len(own) < LEAST_SPARED:
        return filters
    by_language = {k: own[own["lang"] == k] for k in filters.languages}
    told = {k: rows if len(rows) >= LEAST_SPARED else own for k, rows in by_language.items()}
    return replace(filters, levels={k: Level.of(rows["score"].to_numpy(), rows["n"].to_numpy()) for k, rows in told.items()})


def _predict(sent, with_text: bool, named: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: GramFilters = sent.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if known.languages and texts:
                shares = known.shares(texts)
                best = shares.argmax(axis=1)
                for i, text in enumerate(texts):
                    if text and any(map(str.isalpha, text)):
                        names[i], scores[i] = known.languages[best[i]], float(shares[i, best[i]])
            rest = [c for c in batch.schema.names if with_text or c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in rest), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*rest, *named],
            )

    return run


def annotate(
    docs: DataFrame, filters: GramFilters, with_text: bool = True, named: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """`docs` with a language and its score, which replace columns of that name; without `text` if so asked.

    The filters that are broadcast have a fixed number of bits a language.
    """
    rest = [c for c in docs.columns if c not in ("text", *named)]
    rows = docs.select(F.col("text").cast("string"), F.struct(F.lit(0), *[F.col(f"`{c}`") for c in rest]).alias("_row"))
    added = [T.StructField(named[0], T.StringType()), T.StructField(named[1], T.DoubleType())]
    kept = [f for f in rows.schema.fields if with_text or f.name != "text"]
    sent = docs.sparkSession.sparkContext.broadcast(filters)
    found = map_batches(rows, _predict(sent, with_text, named), T.StructType([*kept, *added]))
    back = [F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns if c in rest or (c == "text" and with_text)]
    return found.select(*back, *named)


def identify(docs: DataFrame, filters: GramFilters) -> DataFrame:
    """`doc_id, held_out, lang_pred, score` for every row of `docs(doc_id, text)`."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return annotate(rows, filters, with_text=False)


def _understood(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: GramFilters = sent.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            shares, part, n = known.looked_up(texts)
            best = shares.argmax(axis=1)
            held = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)
            for k, language in enumerate(known.languages):
                if language in known.levels:
                    mine = held & (best == k)
                    held[mine] = known.levels[language].holds(part[mine], n[mine])
            yield batch.filter(pa.array(held))

    return run


def understood(docs: DataFrame, filters: GramFilters) -> DataFrame:
    """The rows of `docs` that have a language.

    Rejected are texts that are `und`, and those that are strange to the language they score best in; a language without
    a level rejects none. Filters that know no language reject only texts without a letter.
    """
    if not filters.languages:
        return docs.filter(F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(F.col("text").cast("string"), F.struct(F.lit(0), *rest).alias("_row"))
    found = map_batches(rows, _understood(docs.sparkSession.sparkContext.broadcast(filters)), rows.schema)
    return found.select(*[F.col("text") if c == "text" else F.col(f"_row.`{c}`") for c in docs.columns])
