"""Exact deduplication by Grace hashing: complete texts compared in open-addressing tables.

Tasks that read the documents first fold equal texts in a table of bounded size (a full table is sent
on and a new one begun), so a text that a third of all rows share leaves each task once or a few times.
What is left is shuffled by SHA-256. A receiving task fills a table; one that outgrows its bound is
dealt, with all rows still to come, to spill files by the next digit of the hash, and each file is
treated alike, until every bucket fits. Tables compare complete contents; two texts with one SHA-256
would raise an error. The sizes and survivors of groups go back to the rows by their hash.

A null text counts as empty. Of equal texts the row with the largest doc_id stays (a null doc_id is
smaller than any other); of rows that repeat text and doc_id one stays. An empty table gives no rows.
Columns other than `doc_id` and `text`, whatever their names, are carried by `deduplicated` alone.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, shuffle_partitions

TABLE_BYTES = 48 << 20
FANOUT_DIGITS = 1  # hex digits of the hash a level of spill files uses: 16 files
_ROWS = "text_sha256 string, text string, keep_id long, group_size long"
Record = tuple[str, bytes, "int | None", int]


def _larger(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else max(a, b)


class ContentTable:
    """Open addressing with linear probing; slots hold entry numbers, entries hold whole contents."""

    def __init__(self) -> None:
        self.slots = np.full(1024, -1, np.int64)
        self.entries: list[list] = []
        self.bytes = 0

    def _slot(self, name: str, content: bytes) -> int:
        mask = len(self.slots) - 1
        at = int(name[-16:], 16) & mask
        while (k := int(self.slots[at])) >= 0:
            entry = self.entries[k]
            if entry[1] == content:
                return at
            if entry[0] == name:
                raise ValueError(f"two different texts have the SHA-256 {name}")
            at = (at + 1) & mask
        return at

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for k, entry in enumerate(self.entries):
            at = int(entry[0][-16:], 16) & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = k

    def add(self, record: Record) -> None:
        name, content, key, count = record
        at = self._slot(name, content)
        if (k := int(self.slots[at])) >= 0:
            entry = self.entries[k]
            entry[2], entry[3] = _larger(entry[2], key), entry[3] + count
            return
        self.slots[at] = len(self.entries)
        self.entries.append([name, content, key, count])
        self.bytes += len(content) + 200
        if 3 * len(self.entries) > 2 * len(self.slots):
            self._grow()


def grace_groups(records: Iterable[Record], limit: int, level: int = 0) -> Iterator[list]:
    """One entry for every distinct content of `records`; no table outgrows `limit` bytes unless alone."""
    table = ContentTable()
    source = iter(records)
    for record in source:
        table.add(record)
        if table.bytes > limit and len(table.entries) > 1 and level < 64:
            break
    else:
        yield from table.entries
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        files: dict[str, object] = {}

        def deal(record) -> None:
            digit = record[0][level : level + FANOUT_DIGITS]
            if digit not in files:
                files[digit] = (Path(folder) / digit).open("wb")
            pickle.dump(tuple(record), files[digit], pickle.HIGHEST_PROTOCOL)

        for entry in table.entries:
            deal(entry)
        del table
        for record in source:
            deal(record)
        for file in files.values():
            file.close()

        def read(path: Path) -> Iterator[Record]:
            with path.open("rb") as file:
                while True:
                    try:
                        yield pickle.load(file)
                    except EOFError:
                        return

        for digit in sorted(files):
            path = Path(folder) / digit
            yield from grace_groups(read(path), limit, level + FANOUT_DIGITS)
            path.unlink()


def _batches(entries: Iterable[list], with_text: bool) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def make() -> pa.RecordBatch:
        columns = [
            pa.array([e[0] for e in held], pa.string()),
            pa.array([e[1].decode() if with_text else None for e in held], pa.string()),
            pa.array([e[2] for e in held], pa.int64()),
            pa.array([e[3] for e in held], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["text_sha256", "text", "keep_id", "group_size"])

    for entry in entries:
        held.append(entry)
        size += len(entry[1]) + 100
        if size > 4 << 20:
            yield make()
            held, size = [], 0
    if held:
        yield make()


def _fold(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable()
        for batch in batches:
            for key, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                content = (text.as_py() or "").encode()
                table.add((hashlib.sha256(content).hexdigest(), content, key.as_py(), 1))
                if table.bytes > limit:
                    yield from _batches(table.entries, True)
                    table = ContentTable()
        yield from _batches(table.entries, True)

    return run


def _gather(limit: int):
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[Record]:
        for batch in batches:
            for name, text, key, count in zip(*batch.columns, strict=True):
                yield name.as_py(), text.as_py().encode(), key.as_py(), count.as_py()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(grace_groups(records(batches), limit), False)

    return run


def _sha(text: Column) -> Column:
    return F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256)


def groups(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """`text_sha256, keep_id, group_size` for every distinct text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folded = map_batches(rows, _fold(table_bytes), _ROWS)
    dealt = folded.repartition(shuffle_partitions(docs.sparkSession), "text_sha256")
    return map_batches(dealt, _gather(table_bytes), _ROWS).drop("text")


def exact_duplicates(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """`doc_id, keep_id, group_size, kept, text_sha256` for every row of `docs(doc_id, text)`."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _sha(F.col("text")).alias("text_sha256"))
    counted = rows.groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).cast("int").alias("times"))
    found = counted.join(groups(docs, table_bytes), "text_sha256")
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times"))))
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return each.select("doc_id", "keep_id", "group_size", stays.alias("kept"), "text_sha256")


def deduplicated(docs: DataFrame, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    keys = groups(docs, table_bytes).select(F.col("text_sha256").alias("_sha"), F.col("keep_id").alias("_keep"))
    rows = docs.withColumn("_sha", _sha(F.col("text")))
    same = (rows["_sha"] == keys["_sha"]) & rows["doc_id"].cast("long").eqNullSafe(keys["_keep"])
    stay = rows.join(keys, same, "left_semi")
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    order = Window.partitionBy("_sha", "doc_id").orderBy(*[F.col(f"`{c}`") for c in rest] or [F.lit(0)])
    return stay.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_sha", "_n")
