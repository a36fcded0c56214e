r"""Lines that documents share stay in the first of them only: compressed keep bitmaps by range-partitioned hashes.

A text is split at \n. A line's key is the line without white space (`[\x20\x09-\x0D]`) at its ends and with A-Z in lower
case. Keys of at least `LEAST_CHARS` code points travel as 128 bits of hash with their document and position, never as
text. Rows are range-partitioned by hash and sorted within by hash, document and position, so that one pass over a
partition meets the first document of every key and sees for each later row that it is not of that document. Rows to be
dropped are gathered by document into runs: the bitmap of kept lines, run-length compressed. Texts are read for the hashes
and, where a caller wants texts, once more with the bitmaps; they never meet each other.

Frequent keys would put all their rows in one range. Sketches of every task (`approx_top_k`, merged in two steps)
name at most `MOST_FREQUENT` keys, of which those with `FREQUENT_ROWS` rows or more are decided where they are: their first
documents are one aggregation with a partial step in every task, and a table of that many rows at most is broadcast. A key
that a sketch has missed is decided with the others, so the sketches change where the work is done and never the result.

Null and empty texts are one empty line. Rows of one doc_id are one document, so their lines stay or go together; null
doc_ids are one document behind all others. Repeated rows have equal results. Lines repeated within the first document
stay. An empty table gives no rows. Only `doc_id` and `text` are looked at; `without_repeats` carries other columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import cut

LEAST_CHARS = 10
FREQUENT_ROWS = 10_000
MOST_FREQUENT = 20_000
TRACKED = 65_536  # keys a sketch holds
SKETCH_GROUPS = 256
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OWN = "_lines_"
_DOC = [OWN + "id", OWN + "t1", OWN + "t2"]
_KEY = [OWN + "h1", OWN + "h2"]
_AT = OWN + "at"


def line_key(line: Column) -> Column:
    """White space off both ends, A-Z in lower case."""
    ascii_only = F.length(line) == F.octet_length(line)  # there `lower` changes A-Z alone, and is much faster
    return F.btrim(F.when(ascii_only, F.lower(line)).otherwise(F.translate(line, UPPER, UPPER.lower())), F.lit(SPACE))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)


def _digest(value: Column, names: list[str]) -> list[Column]:
    """128 bits as two numbers."""
    return [F.xxhash64(value).alias(names[0]), F.xxhash64(F.lit(1), value).alias(names[1])]


def _document(text: Column) -> list[Column]:
    return [F.col("doc_id").alias(_DOC[0]), *_digest(F.coalesce(text.cast("string"), F.lit("")), _DOC[1:])]


def hashed_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """Document, position and key hash of every line whose key is long enough."""
    at = docs.select(*_document(F.col("text")), F.posexplode(_lines(F.col("text"))).alias(_AT, OWN + "line"))
    keyed = at.withColumn(OWN + "key", line_key(F.col(OWN + "line"))).filter(F.length(OWN + "key") >= least_chars)
    return keyed.select(*_DOC, _AT, *_digest(F.col(OWN + "key"), _KEY))


def frequent_keys(lines: DataFrame, least_rows: int = FREQUENT_ROWS, most: int = MOST_FREQUENT) -> DataFrame:
    """First halves of the hashes of keys with about `least_rows` rows or more, `most` of them at most."""
    group = OWN + "group"
    by_task = lines.select(_KEY[0], F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias(group))
    sketches = by_task.groupBy(group).agg(F.expr(f"approx_top_k_accumulate({_KEY[0]}, {TRACKED})").alias("sketch"))
    # in a group, so that no lines give no row
    merged = sketches.groupBy(F.lit("all").alias(group)).agg(F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch"))
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {most})")).alias("top"))
    return top.filter(F.col("top.count") >= least_rows).select(F.col("top.item").alias(_KEY[0])).dropna()


def repeats(
    docs: DataFrame, least_chars: int = LEAST_CHARS, frequent_rows: int = FREQUENT_ROWS, most_frequent: int = MOST_FREQUENT
) -> DataFrame:
    """Lines to drop: document and position."""
    lines = cut(hashed_lines(docs, least_chars))
    frequent = cut(frequent_keys(lines, frequent_rows, most_frequent))
    first = OWN + "first"
    # at most `most_frequent` rows, up to keys that agree in the first 64 bits of their hashes
    firsts = lines.join(F.broadcast(frequent), _KEY[0]).groupBy(*_KEY).agg(F.min(_DOC[0]).alias(first))
    firsts = cut(firsts.coalesce(1))
    own = F.col(_DOC[0]).eqNullSafe(F.col(first))
    decided = lines.join(F.broadcast(firsts), _KEY).filter(~own)

    rest = lines.join(F.broadcast(firsts), _KEY, "left_anti")
    order = [F.col(_DOC[0]).asc_nulls_last(), F.col(_AT).asc()]
    ranged = rest.repartitionByRange(*_KEY).sortWithinPartitions(*_KEY, *order)
    so_far = Window.partitionBy(*_KEY).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    streamed = ranged.withColumn(first, F.first(_DOC[0]).over(so_far)).filter(~own)
    return streamed.select(*_DOC, _AT).unionByName(decided.select(*_DOC, _AT))


def dropped_runs(dropped: DataFrame) -> DataFrame:
    """One row per document with lines to drop: its runs of them, in order."""
    by_place = Window.partitionBy(*_DOC).orderBy(_AT)  # dense, since repeated rows come with equal places
    island = dropped.withColumn(OWN + "island", F.col(_AT) - F.dense_rank().over(by_place))
    runs = island.groupBy(*_DOC, OWN + "island").agg(F.min(_AT).alias("start"), F.max(_AT).alias("last"))
    run = F.struct("start", (F.col("last") - F.col("start") + 1).alias("length"))
    return runs.groupBy(*_DOC).agg(F.sort_array(F.collect_list(run)).alias(OWN + "runs"))


def _with_runs(docs: DataFrame, runs: DataFrame) -> DataFrame:
    told = docs.select("*", *[c.alias(f"{n}_") for n, c in zip(_DOC[1:], _document(F.col("text"))[1:], strict=True)])
    same = F.col("doc_id").eqNullSafe(F.col(_DOC[0]))
    for name in _DOC[1:]:
        same &= F.col(f"{name}_") == F.col(name)
    return told.join(runs, same, "left").drop(*_DOC, *[f"{n}_" for n in _DOC[1:]])


def _kept(runs: Column, n_lines: Column) -> Column:
    """Runs of kept lines, the places between runs of dropped ones."""
    begins = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["start"] + r["length"]))
    ends = F.concat(F.transform(runs, lambda r: r["start"]), F.array(n_lines))
    between = F.zip_with(begins, ends, lambda b, e: F.struct(b.alias("start"), (e - b).alias("length")))
    return F.filter(between, lambda r: r["length"] > 0)


def _bitmaps(docs: DataFrame, runs: DataFrame, n_lines: Column) -> DataFrame:
    none = F.array().cast("array<struct<start:int,length:int>>")
    found = _with_runs(docs, runs).withColumn(OWN + "runs", F.coalesce(OWN + "runs", none))
    dropped = F.aggregate(OWN + "runs", F.lit(0).cast("long"), lambda n, r: n + r["length"])
    return found.select(
        "*", n_lines.cast("long").alias(OWN + "n"), dropped.alias(OWN + "gone"), _kept(F.col(OWN + "runs"), n_lines).alias(OWN + "keep")
    ).drop(OWN + "runs")


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """`doc_id, n_lines, n_dropped, keep`, one row per document; `keep` has the runs of lines that stay, in order."""
    runs = dropped_runs(repeats(docs, least_chars))
    found = _bitmaps(docs.select("doc_id", "text"), runs, F.size(_lines(F.col("text"))))
    return found.select("doc_id", F.col(OWN + "n").alias("n_lines"), F.col(OWN + "gone").alias("n_dropped"), F.col(OWN + "keep").alias("keep"))


def without_repeats(docs: DataFrame, least_chars: int = LEAST_CHARS, **bounds: int) -> DataFrame:
    """`docs` with `text` less its dropped lines, and `n_lines` and `n_dropped`, which replace columns of their name."""
    lines = _lines(F.col("text"))
    found = _bitmaps(docs, dropped_runs(repeats(docs, least_chars, **bounds)), F.size(lines))
    slices = F.transform(OWN + "keep", lambda r: F.slice(lines, r["start"] + 1, r["length"]))
    text = F.when(F.col(OWN + "gone") == 0, F.coalesce(F.col("text").cast("string"), F.lit(""))).otherwise(F.array_join(F.flatten(slices), "\n"))
    return found.withColumns({"text": text, "n_lines": F.col(OWN + "n"), "n_dropped": F.col(OWN + "gone")}).drop(OWN + "n", OWN + "gone", OWN + "keep")
