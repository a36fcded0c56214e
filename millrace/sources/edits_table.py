"""The edits table in a folder of Parquet files.

    log/writer=<name>/run=<id>/batch_id=<n>/domain=<..>/d=<day>/   what each batch wrote
    base/generation=<g>/domain=<..>/d=<day>/                       merged states, from compaction
    manifest/generation=<g>/                                       directories of the base, with their counts
    absorbed/generation=<g>/                                       batches the base already contains

A batch has its own directory. A stream's run is the id that its checkpoint keeps: started over without
that checkpoint it writes beside what it wrote before, never over it. A batch that the base contains is not
written again. A batch or generation counts once its `_SUCCESS` is there: a reader sees all of it or none.

Directories go by domain and day. A domain alone would be a handful of ever-growing partitions. Which
directories a read needs is known from names, in the manifest and in the folders of batches, so that no job
runs over data before the caller's own, and just those paths are read.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.scalars import in_range
from millrace.operators.keyed import after_delete, live_rows, merge_states, newest_first, set_title, to_states
from millrace.schemas import EDIT_LOG, KEY, KEY_STATE
from millrace.session import BROADCAST_ROWS, empty
from millrace.sources import files

BATCH_RUN = "batch"  # the run of batches that no stream numbers
SPREAD = 64
_ON_DISK_LEVELS = ("writer", "run", "batch_id")
_BASE = T.StructType([*KEY_STATE, T.StructField("generation", T.LongType()), T.StructField("d", T.DateType())])
_KEY_COLUMNS = T.StructType([*[_BASE[name] for name in KEY], _BASE["d"]])
_ABSORBED = T.StructType([EDIT_LOG[name] for name in _ON_DISK_LEVELS])
_ABSORBED_ARROW = pa.schema([("writer", pa.string()), ("run", pa.string()), ("batch_id", pa.int64())])
_DIRECTORY = ["domain", "d"]
_MANIFEST = "directory string, generation long, n_states long, n_rows long, n_files long, n_bytes long"


def _with_blooms(writer: DataFrameWriter, *columns: str) -> DataFrameWriter:
    """Bloom filters, for lookups by columns the files are not sorted by, sized to what is written."""
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for column in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


def _unescaped(name: str) -> str:
    """A directory level's value; Spark writes some characters as `%` and their code."""
    return re.sub(r"%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), name)


@dataclass(frozen=True)
class Batch:
    writer: str
    batch_id: int
    run: str = BATCH_RUN

    @property
    def path(self) -> str:
        return f"writer={self.writer}/{files.batch_name(self.run, self.batch_id)}"


@dataclass(frozen=True)
class Directory:
    """A directory of the base: its path below the generation, and what it holds. Days are text here."""

    directory: str
    generation: int
    n_states: int
    n_rows: int
    n_files: int
    n_bytes: int

    @property
    def name(self) -> tuple[str, str]:
        domain, day = re.fullmatch(r"domain=([^/]*)/d=([^/]*)", self.directory).groups()
        return _unescaped(domain), _unescaped(day)


class EditsTable:
    def __init__(self, spark: SparkSession, root: str, spread: int = SPREAD) -> None:
        """`spread`: tasks over which a directory's rows are dealt where the session does not balance by size."""
        if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z", "+00:00"):
            raise ValueError("days of the table are UTC days: the session's time zone must be UTC (see session.configure)")
        self.spark = spark
        self.root = root.rstrip("/")
        self.spread = spread

    # --- write ----------------------------------------------------------------------------

    def write_batch(
        self, log_rows: DataFrame, writer: str, batch_id: int, arrange: bool = True, run: str = BATCH_RUN
    ) -> None:
        """Write one batch of log rows. Writing the same batch again replaces it until the base contains it;
        from then on that is refused.

        A NULL in the key, an empty domain or a year outside 1 to 9999 fails the write. Rows are gathered by
        directory first, so that a batch leaves few, full files instead of one per task and directory. Without
        `arrange` they go out as they come, without a shuffle.
        """
        for name in (writer, run):
            if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
                raise ValueError(f"names of writers and runs become directories: {name!r}")
        batch = Batch(writer, batch_id, run)
        if self.holds(batch):
            raise ValueError(f"the table's base already contains {batch}")
        rows = _with_whole_keys(log_rows.drop(*_ON_DISK_LEVELS))
        if arrange:
            rows = self._by_directory(rows, F.xxhash64("seq"))
        rows = rows.sortWithinPartitions(*_DIRECTORY, *newest_first())
        out = rows.write.options(**files.MARKED).mode("overwrite").partitionBy(*_DIRECTORY)
        _with_blooms(out, "user_id", "page_title").parquet(f"{self.root}/log/{batch.path}")

    def holds(self, batch: Batch) -> bool:
        """Does the base already contain the batch?"""
        return batch in self.absorbed(self.generation())

    def _by_directory(self, rows: DataFrame, salt: Column) -> DataFrame:
        if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
            # splits a directory that is too large for one task, by size, and joins small ones
            return rows.hint("rebalance", *[F.col(c) for c in _DIRECTORY])
        return rows.repartition(*_DIRECTORY, F.pmod(salt, F.lit(self.spread)))

    # --- what is there --------------------------------------------------------------------

    def committed(self) -> set[Batch]:
        marks = files.glob(self.spark, f"{self.root}/log/writer=*/run=*/batch_id=*/_SUCCESS")
        found = (re.search(r"/writer=([^/]+)/run=([^/]+)/batch_id=(-?\d+)/_SUCCESS$", mark) for mark in marks)
        return {Batch(m[1], int(m[3]), m[2]) for m in found if m}

    def generation(self) -> int | None:
        """The newest complete generation. The manifest is written last."""
        marks = files.glob(self.spark, f"{self.root}/manifest/generation=*/_SUCCESS")
        return max((int(re.search(r"generation=(\d+)/", mark)[1]) for mark in marks), default=None)

    def absorbed(self, generation: int | None) -> set[Batch]:
        if generation is None:
            return set()
        rows = self.spark.read.schema(_ABSORBED).parquet(f"{self.root}/absorbed/generation={generation}")
        return {Batch(row.writer, row.batch_id, row.run) for row in rows.collect()}  # batch names, no data

    def manifest(self, generation: int | None = None) -> list[Directory]:
        """The directories of a generation, by default the newest: names and counts, no data."""
        generation = self.generation() if generation is None else generation
        if generation is None:
            return []
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/generation={generation}").collect()
        return [Directory(**row.asDict()) for row in rows]

    def _directories(self, batches: set[Batch]) -> set[str]:
        """Directories that the batches have written to, from the names of folders."""
        if not batches:
            return set()
        found = files.glob(self.spark, f"{self.root}/log/writer=*/run=*/batch_id=*/domain=*/d=*")
        parts = [re.search(r"/(writer=[^/]+/run=[^/]+/batch_id=-?\d+)/(domain=[^/]*/d=[^/]*)$", path) for path in found]
        paths = {batch.path for batch in batches}
        return {m[2] for m in parts if m and m[1] in paths}

    # --- read -----------------------------------------------------------------------------

    def _read_batches(self, batches: set[Batch]) -> DataFrame:
        if not batches:
            return empty(self.spark, EDIT_LOG)
        paths = [f"{self.root}/log/{b.path}" for b in batches]
        # a declared schema: from directory names alone a domain like `123` would become a number
        return self.spark.read.schema(EDIT_LOG).option("basePath", f"{self.root}/log").parquet(*sorted(paths))

    def read_log(self) -> DataFrame:
        """Every committed batch that still has its directory: after a vacuum no longer all writes."""
        return self._read_batches(self.committed())

    def _read_base(self, directories: Iterable[Directory]) -> DataFrame:
        """States in these directories; no other is listed or opened."""
        paths = [f"{self.root}/base/generation={x.generation}/{x.directory}" for x in directories]
        if not paths:
            return empty(self.spark, _BASE)
        return self.spark.read.schema(_BASE).option("basePath", f"{self.root}/base").parquet(*sorted(paths))

    def _parts(self) -> tuple[DataFrame, list[Directory], list[Directory]]:
        """Log rows the base does not contain, directories of the base they touch, the others."""
        generation = self.generation()
        fresh = self.committed() - self.absorbed(generation)
        touched = self._directories(fresh)
        busy, quiet = [], []
        for held in [] if generation is None else self.manifest(generation):
            (busy if held.directory in touched else quiet).append(held)
        return self._read_batches(fresh), busy, quiet

    def current(self, where: Column | None = None) -> DataFrame:
        """Current rows, optionally of the keys that meet `where` (see `key_predicate`). That may use
        the key columns and `d`; a condition on a cell holds only for the result, so put it there.

        Directories with no write since the last compaction are read as they are; only the others
        go through the merge and its shuffle.
        """
        recent, busy, quiet = self._parts()
        if where is not None:
            empty(self.spark, _KEY_COLUMNS).filter(where)  # raises for other columns
            recent = recent.filter(where)

        def states(directories: list[Directory]) -> DataFrame:
            base = self._read_base(directories)
            return (base if where is None else base.filter(where)).select(*KEY_STATE.names)

        merged = live_rows(merge_states(to_states(recent).unionByName(states(busy))))
        return merged.unionByName(live_rows(states(quiet))) if quiet else merged

    def count(self) -> DataFrame:
        """One row, `n_rows`. Of directories without recent writes the manifest knows it."""
        recent, busy, quiet = self._parts()
        known = sum(x.n_rows for x in quiet)
        merged = live_rows(merge_states(to_states(recent).unionByName(self._read_base(busy).select(*KEY_STATE.names))))
        return merged.agg((F.count(F.lit(1)) + F.lit(known)).alias("n_rows"))

    def layout(self) -> DataFrame:
        """What is stored in the base: for each directory its rows, states and files, and how many states are not in the
        table's order within their file."""
        stored = self._read_base(self.manifest()).select(
            *_BASE.names, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
        )
        # one window a file, whose rows are numbered as they are stored

        before = Window.partitionBy("file").orderBy("at")
        last_time, last_user = F.lag("created_at").over(before), F.lag("user_id").over(before)
        unordered = (last_time < F.col("created_at")) | ((last_time == F.col("created_at")) & (last_user > F.col("user_id")))
        placed = stored.withColumn("unordered", F.coalesce(unordered, F.lit(False))).withColumn("live", after_delete("up_seq"))
        return placed.groupBy("domain", "d").agg(
            F.count_if("live").alias("n_rows"),
            F.count(F.lit(1)).alias("n_states"),
            F.count_distinct("file").alias("n_files"),
            F.count_if("unordered").alias("n_unordered"),
        )

    def with_title(self, page_title: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
        """Rows whose current title is the given one.

        Merges only keys that ever had the title: searched for once and broadcast if they are few, with just
        their directories read, else joined on the whole key.
        """
        recent, busy, quiet = self._parts()
        base = self._read_base([*busy, *quiet])
        key = [*KEY, "d"]
        # a key that in the base has another title can have this one only by a recent write
        had_it = recent.filter(set_title(page_title)).select(*key).unionByName(
            base.filter(F.col("page_title.value") == page_title).select(*key)
        )
        had_it = had_it.distinct()
        found = had_it.limit(broadcast_rows + 1).toArrow()
        if found.num_rows <= broadcast_rows:
            names = {(domain, str(d)) for domain, d in zip(found["domain"].to_pylist(), found["d"].to_pylist(), strict=True)}
            base = self._read_base(x for x in (*busy, *quiet) if x.name in names)
            had_it = F.broadcast(self.spark.createDataFrame(found))
        states = to_states(recent.join(had_it, key, "left_semi")).unionByName(
            base.join(had_it, key, "left_semi").select(*KEY_STATE.names)
        )
        return live_rows(merge_states(states)).filter(F.col("page_title") == page_title)

    # --- upkeep ---------------------------------------------------------------------------

    def compact(self, full: bool = False) -> int:
        """Merge recent batches into the base, as a new generation; returns its number.

        Rewrites only the directories those batches touch, or all of them if `full`, after which
        older generations are no longer needed. Deletes and per-cell `seq` are kept, so a late older
        write still loses. One compaction or truncate at a time per table; writers and readers may go
        on meanwhile.
        """
        previous = self.generation()
        committed = self.committed()
        fresh = committed - self.absorbed(previous)
        if previous is not None and not fresh and not full:
            return previous
        touched = self._directories(fresh)
        old = [] if previous is None else self.manifest(previous)
        busy = [x for x in old if full or x.directory in touched]
        kept = [x for x in old if not full and x.directory not in touched]
        states = to_states(self._read_batches(fresh)).unionByName(self._read_base(busy).select(*KEY_STATE.names))
        return self._write_generation(0 if previous is None else previous + 1, states, kept, committed)

    def truncate(self) -> int:
        """Empty the table: a new generation that holds nothing and covers every batch so far."""
        previous = self.generation()
        return self._write_generation(0 if previous is None else previous + 1, empty(self.spark, KEY_STATE), [], self.committed())

    def drop(self) -> None:
        """Remove the table with all it holds; the next write makes it anew. For when nobody uses it."""
        files.delete(self.spark, self.root)

    def _write_generation(self, number: int, states: DataFrame, kept: list[Directory], covered: set[Batch]) -> int:
        at = f"generation={number}"
        merged = merge_states(states).withColumn("d", F.to_date("created_at"))
        merged = self._by_directory(merged, F.xxhash64("created_at", "user_id"))
        merged = merged.sortWithinPartitions(*_DIRECTORY, *newest_first())
        writer = merged.write.mode("overwrite").partitionBy(*_DIRECTORY)
        _with_blooms(writer, "user_id", "page_title.value").parquet(f"{self.root}/base/{at}")
        names = sorted((b.writer, b.run, b.batch_id) for b in covered)
        columns = list(zip(*names, strict=True)) or [[], [], []]
        absorbed = pa.table(dict(zip(_ON_DISK_LEVELS, map(list, columns), strict=True)), _ABSORBED_ARROW)
        self.spark.createDataFrame(absorbed).write.mode("overwrite").parquet(f"{self.root}/absorbed/{at}")
        rows = [tuple(vars(x).values()) for x in [*self._written(number), *kept]]
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)  # a row for each directory
        manifest.write.options(**files.MARKED).mode("overwrite").parquet(f"{self.root}/manifest/{at}")
        return number

    def _written(self, number: int) -> list[Directory]:
        """The directories of a generation just written, with their counts."""
        root = f"{self.root}/base/generation={number}"
        sizes: dict[str, list[int]] = defaultdict(list)
        for path, size in files.sizes(self.spark, f"{root}/domain=*/d=*/part-*"):
            sizes[re.search(r"/(domain=[^/]*/d=[^/]*)/part-[^/]*$", path)[1]].append(size)
        if not sizes:
            return []
        found = [Directory(name, number, 0, 0, len(s), sum(s)) for name, s in sizes.items()]
        stored = self._read_base(found).groupBy("domain", F.col("d").cast("string").alias("d"))
        counts = {
            (r["domain"], r["d"]): r
            for r in stored.agg(F.count(F.lit(1)).alias("n_states"), F.count_if(after_delete("up_seq")).alias("n_rows")).collect()
        }
        return [
            Directory(x.directory, number, counts[x.name]["n_states"], counts[x.name]["n_rows"], x.n_files, x.n_bytes) for x in found
        ]

    def vacuum(self) -> int:
        """Remove batches the base contains and generations it no longer needs; returns how many
        batches went. For when no reader that began before the last compaction is still running."""
        newest = self.generation()
        if newest is None:
            return 0
        gone = self.absorbed(newest) & self.committed()
        for batch in gone:
            files.delete(self.spark, f"{self.root}/log/{batch.path}")
        needed = {x.generation for x in self.manifest(newest)}
        for kind, keep in (("base", needed | {newest}), ("absorbed", {newest}), ("manifest", {newest})):
            for path in files.glob(self.spark, f"{self.root}/{kind}/generation=*"):
                number = int(path.rsplit("=", 1)[1])
                if number < newest and number not in keep:
                    files.delete(self.spark, path)
        return len(gone)


def _with_whole_keys(rows: DataFrame) -> DataFrame:
    """`rows`, failing when they are written if a key is not one: the table could not tell such rows apart."""
    whole = F.col("user_id").isNotNull() & (F.coalesce(F.col("domain"), F.lit("")) != "") & in_range(F.col("created_at"))
    wrong = F.raise_error(F.lit("a key needs a user, a domain that is not empty, and a time in the years 1 to 9999"))
    return rows.withColumn("domain", F.when(whole, F.col("domain")).otherwise(wrong.cast("string")))
