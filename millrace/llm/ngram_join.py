"""Exact Jaccard join of documents on word shingles by T-occurrence search (DivideSkip).

Two documents link when 100 * |A & B| >= 75 * |A | B|; groups are what links connect. No pair is
ever written out, and equal sets are one set from the first step on.

1. *Postings.* In an order of shingles that all documents share (their hashes), a linked pair has at
   least `k` shingles in common among the first `n - ceil(0.75 n) + k` of either. Only these leave the
   task that read the text, packed by shard of hash. A shard drops every shingle that one set alone has.
2. *Survivors.* A set with fewer than `k` shared shingles in that part links with nothing. Of the
   others (known by 64 bits of their 128 here), each leaves out its `k - 1` longest lists (the long lists of DivideSkip): a linked pair still
   meets in one that neither left out. Lists point to their smallest member; connected components
   of these pointers are candidate groups, and no link leaves a group.
3. *Search.* A group's texts are read together. Its inverted lists are merged where short, probed by
   binary search where long, and sets reaching the overlap that the similarity asks for are linked.
   A set that was reached leaves the index, so that a group of g near copies takes g lookups, not g * g.
4. *Groups beyond `block_words`* are dealt into blocks twice over, each searched alone, which connects nearly
   all that is linked. What is left must lie between sets that are not connected yet: of all shingles of these
   groups, those count that two such sets have, and who shares fewer of them than its similarity asks for
   has no link left. The others form groups as in step 2, by far smaller ones, since the whole overlap is asked
   for and not the prefixes'. In a group that is still large the largest connected part is not searched
   against itself: its blocks each meet the rest, and every two blocks of the rest meet.

Nulls and texts without words have an empty set and link with nothing. Rows with a null doc_id are not
searched for links: they take the component of documents with an equal set, null if there is none.
Rows that repeat a doc_id are judged row by row. An empty table gives no rows. Only `doc_id` and `text`
are read; other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut, map_batches, shuffle_partitions
from millrace.llm.components import components
from millrace.llm.shingles import digest, sets_of
from millrace.session import broadcast_if_small

SHINGLE_WORDS = 5
PERCENT = 75
BLOCK_WORDS = 1_000_000
_MU = 0.5  # weight of a probe against a merge step in DivideSkip's choice of how many lists are long
_HEAP = 256  # postings merged by a heap
_HOT = 16  # sets of a round that have a shingle, from which on it goes round the shards


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of size n shares with any set it links with, at least."""
    return -(-percent * n // 100)


def _extra(n: int, percent: int) -> int:
    return min(least_overlap(n, percent), 1 + n // 4)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - least_overlap(n, percent) + _extra(n, percent) if n else 0


def needed(n: int, percent: int = PERCENT) -> int:
    """Shared shingles within the prefixes that every partner of a set of size n has with it."""
    return _extra(least_overlap(n, percent), percent) if n else 0


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    return (x.as_py() for x in batch.column("text"))


def _describe(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, names = [], []
            for s in sets_of(_texts(batch), size):
                counts.append(len(s))
                names.append(digest(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(names, pa.string())],
                names=["doc_id", "n_shingles", "set_id"],
            )

    return run


def describe(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """`doc_id, n_shingles, set_id`; equal sets have equal ids, empty ones a null id."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_batches(texts, _describe(size), "doc_id long, n_shingles long, set_id string")


def _postings(size: int, percent: int, shards: int, whole: bool = False):
    """Packed postings: a row for each shard and round, with sets by name and (shingle, set) pairs.

    `whole` takes all shingles of the sets that rows of `set_id, number, text` name, and says the number of each.
    """
    room = 500_000

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        names: list[bytes] = []
        sizes: list[int] = []
        numbers: list[int] = []
        parts: list[np.ndarray] = []
        held = flushed = 0

        def flush() -> pa.RecordBatch:
            nonlocal flushed
            tokens = np.concatenate(parts)
            owner = np.repeat(np.arange(len(parts), dtype=np.uint32), [len(p) for p in parts])
            order = np.argsort(tokens, kind="stable")  # by shard as well, as shards are ranges
            tokens, owner = tokens[order], owner[order]
            first = np.concatenate(([True], tokens[1:] != tokens[:-1]))
            starts = np.flatnonzero(first)
            often = np.repeat(np.diff(np.append(starts, len(tokens))) >= _HOT, np.diff(np.append(starts, len(tokens))))
            often &= not whole  # only their shard knows whether sets of more than one number have them
            rows: dict[str, list] = {"shard": [], "names": [], "sizes": [], "numbers": [], "tokens": [], "owners": []}

            def put(shard: int, tokens: np.ndarray, owner: np.ndarray) -> None:
                own, local = np.unique(owner, return_inverse=True)
                rows["shard"].append(shard)
                rows["names"].append(b"".join(names[k] for k in own))
                rows["sizes"].append(np.array([sizes[k] for k in own], np.uint32).tobytes())
                rows["numbers"].append(np.array([numbers[k] for k in own], np.int64).tobytes() if whole else None)
                rows["tokens"].append(tokens.tobytes())
                rows["owners"].append(local.astype(np.uint16 if len(own) <= 1 << 16 else np.uint32).tobytes())

            if often.any():
                flushed += 1
                put(-1 - (TaskContext.get().partitionId() * 8191 + flushed) % (1 << 20), tokens[often], owner[often])
            kept = ~often | first
            tokens, owner = tokens[kept], owner[kept]
            shard = (tokens >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
            bounds = np.searchsorted(shard, np.arange(shards + 1))
            for s in np.flatnonzero(np.diff(bounds)):
                put(int(s), tokens[bounds[s] : bounds[s + 1]], owner[bounds[s] : bounds[s + 1]])
            kinds = [pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], names=list(rows))

        for batch in batches:
            told = [batch.column(x).to_pylist() if whole else [None] * batch.num_rows for x in ("set_id", "number")]
            for s, set_id, number in zip(sets_of(_texts(batch), size), *told, strict=True):
                if not len(s):
                    continue
                name = bytes.fromhex(digest(s))
                if name in seen or whole and name.hex() != set_id:  # a doc_id may be repeated with another text
                    continue
                seen.add(name)
                numbers.append(number)
                names.append(name[:8])
                sizes.append(len(s))
                parts.append(s[: len(s) if whole else prefix_length(len(s), percent)].copy())
                held += len(parts[-1])
                if held >= room:
                    yield flush()
                    names, sizes, numbers, parts, held = [], [], [], [], 0
        if parts:
            yield flush()

    return run


def _rows(token: np.ndarray, owner: np.ndarray, name: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(token), 200_000):
        own = owner[at : at + 200_000]
        columns = [pa.array(token[at : at + 200_000].view(np.int64)), pa.array(name[own]), pa.array(size[own].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["token", "set_key", "n"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of all packed postings of some shards: those of shingles that two sets or more have, of different numbers if they have any."""
    tokens, owners, names, sizes, numbers, base = [], [], [], [], [], 0
    for batch in batches:
        for row in batch.to_pylist():
            token = np.frombuffer(row["tokens"], np.uint64)
            owner = np.frombuffer(row["owners"], np.uint32 if 2 * len(row["owners"]) == len(row["tokens"]) else np.uint16)
            name, size = np.frombuffer(row["names"], ">i8").astype(np.int64), np.frombuffer(row["sizes"], np.uint32)
            if row["shard"] < 0:  # known to be shared
                yield from _rows(token, owner, name, size)
                continue
            tokens.append(token)
            owners.append(owner.astype(np.int64) + base)
            names.append(name)
            sizes.append(size)
            if row["numbers"] is not None:
                numbers.append(np.frombuffer(row["numbers"], np.int64))
            base += len(size)
    if not tokens:
        return
    token, owner = np.concatenate(tokens), np.concatenate(owners)
    size, name = np.concatenate(sizes), np.concatenate(names)
    del tokens, owners
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    same = token[1:] == token[:-1]
    twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
    token, owner = token[twice], owner[twice]
    # tasks that read equal sets have posted them each
    order = np.lexsort((name[owner], token))
    token, owner = token[order], owner[order]
    first = np.ones(len(token), bool)
    first[1:] = (token[1:] != token[:-1]) | (name[owner[1:]] != name[owner[:-1]])
    token, owner = token[first], owner[first]
    if numbers and len(token):
        number = np.concatenate(numbers)[owner]
        starts = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
        mixed = np.minimum.reduceat(number, starts) != np.maximum.reduceat(number, starts)
        between = np.repeat(mixed, np.diff(np.append(starts, len(token))))
        token, owner = token[between], owner[between]
    yield from _rows(token, owner, name, size)


def t_occurrences(lists: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of at least `least` of the sorted lists, in order, and how many lists each is in.

    The shorter lists are merged; what they hold often enough to be completed by the longest ones, `least` less
    the number of these, is looked up there by binary search. Few short postings go through a heap, many through
    a sort that merges the runs they are.
    """
    nothing = np.empty(0, np.int64), np.empty(0, np.int64)
    lists = sorted((x for x in lists if len(x)), key=len)
    if least < 1 or len(lists) < least:
        return nothing
    longest = len(lists[-1])
    n_long = min(least - 1, int(least / (_MU * math.log2(longest) + 1)))
    short, long = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
    if sum(map(len, short)) <= _HEAP:
        merged = np.fromiter(heapq.merge(*(x.tolist() for x in short)), np.int64)
    else:
        merged = np.concatenate(short)
        merged.sort(kind="stable")
    first = np.flatnonzero(np.concatenate(([True], merged[1:] != merged[:-1])))
    member, count = merged[first], np.diff(np.append(first, len(merged)))
    for left, x in zip(range(n_long, 0, -1), long, strict=True):
        able = count + left >= least
        member, count = member[able], count[able]
        if not len(member):
            return nothing
        at = np.minimum(np.searchsorted(x, member), len(x) - 1)
        count = count + (x[at] == member)
    able = count >= least
    return member[able], count[able]


class Index:
    """Inverted lists of sets that are numbered by size; those that were reached are taken out."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets])
        every = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        _, code, count = np.unique(every, return_inverse=True, return_counts=True)
        del every
        keep = count[code] > 1
        code, owner = code[keep].astype(np.int32), owner[keep]
        self.bounds = np.searchsorted(owner, np.arange(len(sets) + 1))
        self.codes = code  # by set
        order = np.argsort(code, kind="stable")
        self.code, self.owner = code[order], owner[order]  # by shingle, sets in order
        self.open = np.ones(len(sets), bool)
        self._shrink(int(self.codes.max(initial=-1)) + 1)

    def _shrink(self, n_codes: int) -> None:
        live = self.open[self.owner]
        self.code, self.owner = self.code[live], self.owner[live]
        self.starts = np.searchsorted(self.code, np.arange(n_codes + 1))
        self.left = int(self.open.sum())

    def reach(self, x: int, percent: int) -> np.ndarray:
        """Open sets that x links with; they are taken out."""
        n = int(self.sizes[x])
        least = least_overlap(n, percent)
        if 2 * int(self.open.sum()) < self.left:
            self._shrink(len(self.starts) - 1)
        mine = self.codes[self.bounds[x] : self.bounds[x + 1]]
        start, end = self.starts[mine], self.starts[mine + 1]
        full = np.flatnonzero(end > start)
        if len(full) < least:
            return full[:0]
        lists = []
        low, high = np.searchsorted(self.sizes, [least, n * 100 // percent + 1])
        for a, b in zip(start[full].tolist(), end[full].tolist(), strict=True):
            one = self.owner[a:b]
            if b - a > 8:
                one = one[self.open[one]]
                one = one[(one >= low) & (one < high)]
            else:
                one = np.array([d for d in one.tolist() if self.open[d] and low <= d < high], np.int64)
            if len(one):
                lists.append(one)
        member, both = t_occurrences(lists, least)
        found = member[100 * both >= percent * (n + self.sizes[member] - both)]
        self.open[found] = False
        return found


def linked(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect `sets` (sorted hashes, none empty) just as all their links would."""
    if len(sets) < 2:
        return []
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    index = Index([sets[i] for i in order])
    links: list[tuple[int, int]] = []
    for seed in range(len(order)):
        if not index.open[seed]:
            continue
        index.open[seed] = False
        queue = [seed]
        while queue and index.open.any():
            x = queue.pop()
            found = index.reach(x, percent).tolist()
            links += [(order[x], order[y]) for y in found]
            queue += found
    return links


def _search(size: int, percent: int):
    """Rows sorted by group in, links of every group out. A group's rows follow one another."""

    def solve(rows: list[tuple[str, np.ndarray]]) -> list[tuple[str, str]]:
        unique = dict(rows)
        names = sorted(unique)
        return [(names[i], names[j]) for i, j in linked([unique[x] for x in names], percent)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []
        for batch in batches:
            keys, wanted = batch.column("group").to_pylist(), batch.column("set_id").to_pylist()
            links = []
            for key, name, s in zip(keys, wanted, sets_of(_texts(batch), size), strict=True):
                if key != group:
                    links += solve(rows)
                    group, rows = key, []
                if len(s) and digest(s) == name:  # a doc_id may be repeated with another text
                    rows.append((name, s))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.string()) for k in (0, 1)], names=["a", "b"]
            )
        last = solve(rows)
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in last], pa.string()) for k in (0, 1)], names=["a", "b"])

    return run


def _set_key(set_id: Column) -> Column:
    """The first 64 of a set's 128 bits as a signed number."""
    high = F.conv(F.substring(set_id, 1, 8), 16, 10).cast("long")
    high = F.when(high >= 1 << 31, high - (1 << 32)).otherwise(high)
    return F.shiftleft(high, 32).bitwiseOR(F.conv(F.substring(set_id, 9, 8), 16, 10).cast("long"))


def _shared_postings(texts: DataFrame, size: int, percent: int, whole: bool = False) -> DataFrame:
    """`(token, set_key, n)` for shingles that two sets or more have in their prefixes, or as `_postings` has it for whole ones."""
    parts = shuffle_partitions(texts.sparkSession)
    packed = map_batches(
        texts,
        _postings(size, percent, 4 * parts, whole),
        "shard int, names binary, sizes binary, numbers binary, tokens binary, owners binary",
    )
    return cut(map_batches(packed.repartition(parts, "shard"), _shared, "token long, set_key long, n long"))


def _grouped(shared: DataFrame, need: Column) -> DataFrame:
    """`(node, root)`: sets in groups that none leaves who shares `need` of these shingles; all that do are in one."""
    have = shared.groupBy("set_key", "n").agg(F.count(F.lit(1)).alias("have"))
    alive = have.filter(F.col("have") >= need).select("set_key")
    kept = shared.join(broadcast_if_small(alive), "set_key", "left_semi")
    lists = kept.groupBy("token").agg(F.count(F.lit(1)).alias("length"), F.min("set_key").alias("head"))
    placed = kept.join(lists.filter("length > 1"), "token")
    # longest lists first; the first `need - 1` of a set are left out
    mine = Window.partitionBy("set_key").orderBy(F.desc("length"), F.desc("token"))
    ranked = placed.select("set_key", "head", need.alias("need"), F.row_number().over(mine).alias("place"))
    return components(ranked.filter("place >= need").select(F.col("set_key").alias("a"), F.col("head").alias("b")))


def _candidates(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """`(node, root)`: sets in groups that no link leaves; every set that has a link is in one."""
    # `needed` as an expression
    low = F.ceil(F.col("n") * percent / F.lit(100)).cast("long")
    need = F.least(F.ceil(low * percent / F.lit(100)).cast("long"), F.floor(low / F.lit(4)) + 1)
    return _grouped(_shared_postings(docs.select(F.col("text").cast("string").alias("text")), size, percent), need)


def _links(texts: DataFrame, here: DataFrame, size: int, percent: int) -> DataFrame:
    """Links within every group of `here(set_id, doc_id, group)`."""
    searched = (
        texts.join(broadcast_if_small(here), "doc_id")
        .select("group", "set_id", "text")
        .repartition(shuffle_partitions(texts.sparkSession), "group")
        .sortWithinPartitions("group")
    )
    return map_batches(searched, _search(size, percent), "a string, b string")


def _dealt(sized: DataFrame) -> DataFrame:
    """Groups of one block as they are, larger ones in blocks, twice over and each time dealt otherwise."""
    deals = F.sequence(F.lit(0), F.when(F.col("blocks") > 1, 1).otherwise(0))
    block = F.pmod(F.xxhash64("set_id", "deal"), F.col("blocks"))
    named = F.concat_ws("/", "root", "deal", block).alias("group")
    return sized.withColumn("deal", F.explode(deals)).select("set_id", "doc_id", named)


def _apart(sets: DataFrame, block_words: int) -> DataFrame:
    """Groups of `sets(set_id, doc_id, n, own, root)` such that every two sets of one root but not of one `own` meet.

    The largest `own` of a root meets the rest block by block, and every two blocks of the rest meet.
    """
    words = sets.groupBy("root", "own").agg(F.sum("n").alias("words"))
    blocks = (
        words.groupBy("root")
        .agg(F.max(F.struct("words", "own")).alias("most"), F.sum("words").alias("words"), F.count(F.lit(1)).alias("owns"))
        .filter("owns > 1")
        .select(
            "root",
            F.col("most.own").alias("most"),
            F.ceil(F.col("most.words") / F.lit(block_words)).cast("int").alias("main"),
            F.ceil((F.col("words") - F.col("most.words")) / F.lit(block_words)).cast("int").alias("rest"),
        )
    )
    mains, rests = (F.sequence(F.lit(0), F.col(x) - 1) for x in ("main", "rest"))
    inside, block = F.col("own") == F.col("most"), F.col("block")
    others = F.filter(rests, lambda x: x != block)
    groups = F.when(inside, F.transform(rests, lambda x: F.concat_ws("/", "root", F.lit("main"), x, block))).otherwise(
        F.concat(
            F.transform(mains, lambda x: F.concat_ws("/", "root", F.lit("main"), block, x)),
            F.transform(others, lambda x: F.concat_ws("/", "root", F.lit("rest"), F.least(block, x), F.greatest(block, x))),
        )
    )
    return (
        sets.join(blocks, "root")
        .withColumn("block", F.pmod(F.xxhash64("set_id"), F.when(inside, F.col("main")).otherwise(F.col("rest"))).cast("int"))
        .select("set_id", "doc_id", F.explode(groups).alias("group"))
    )


def _left_over(
    texts: DataFrame, large: DataFrame, links: DataFrame, size: int, percent: int, block_words: int
) -> DataFrame:
    """Links between sets of `large(set_id, doc_id, n)` that `links` do not connect, as far as they are wanted to."""
    owners = components(links).withColumnRenamed("node", "set_id").withColumnRenamed("root", "own")
    owned = large.join(owners, "set_id", "left").withColumn("own", F.coalesce("own", "set_id"))
    sets = cut(owned.select("set_id", "doc_id", "n", "own", _set_key(F.col("set_id")).alias("set_key")))
    numbers = cut(sets.select("own").distinct().withColumn("number", F.monotonically_increasing_id()))
    numbered = sets.join(numbers, "own").select("doc_id", "set_id", "number")
    theirs = texts.join(broadcast_if_small(numbered), "doc_id").select("set_id", "number", "text")
    foreign = _shared_postings(theirs, size, percent, whole=True)
    need = F.ceil(F.col("n") * percent / F.lit(100)).cast("long")
    groups = _grouped(foreign, need).withColumnRenamed("node", "set_key")
    again = cut(sets.join(groups, "set_key").select("set_id", "doc_id", "n", "own", "root"))
    return _links(texts, _apart(again, block_words), size, percent)


def ngram_groups(
    docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """`doc_id, n_shingles, component_id` for every row of `docs(doc_id, text)`."""
    slim = cut(describe(docs, size))
    heads = (
        slim.filter("set_id IS NOT NULL")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"))
    )
    candidates = _candidates(docs, size, percent)
    grouped = cut(
        heads.withColumn("node", _set_key(F.col("set_id")))
        .join(candidates, "node")
        .select("set_id", F.col("first_id").alias("doc_id"), "n", "root")
    )
    totals = grouped.groupBy("root").agg(F.ceil(F.sum("n") / F.lit(block_words)).cast("int").alias("blocks"))
    sized = grouped.join(totals, "root")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if totals.filter("blocks > 1").isEmpty():
        links = _links(texts, _dealt(sized), size, percent)
    else:
        texts = cut(texts.join(broadcast_if_small(grouped.select("doc_id")), "doc_id", "left_semi"))
        links = cut(_links(texts, _dealt(sized), size, percent))
        large = sized.filter("blocks > 1").select("set_id", "doc_id", "n")
        links = links.unionAll(_left_over(texts, large, links, size, percent, block_words))
    roots = components(links).withColumnRenamed("node", "set_id")
    rooted = heads.join(roots, "set_id", "left").select("set_id", "first_id", F.coalesce("root", "set_id").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(firsts, "root").select("set_id", "component_id")
    alone = slim.filter("set_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return slim.join(named, "set_id").select("doc_id", "n_shingles", "component_id").unionAll(alone)


def one_of_each_group(docs: DataFrame, size: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of their group; rows without a doc_id stay."""
    groups = ngram_groups(docs, size, percent)
    stay = groups.filter("doc_id = component_id").select(F.col("doc_id").alias("_stays")).distinct()
    kept = docs.join(broadcast_if_small(stay), docs["doc_id"].cast("long") == F.col("_stays"), "left_semi")
    return kept.unionByName(docs.filter("doc_id IS NULL"))
