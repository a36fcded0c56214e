"""Feed files by byte ranges: a Python data source, batch and stream.

`spark.read.format("feed").load(folder)` gives `file, offset, value`: one row per frame with the byte it begins at. A frame
is what stands between runs of two or more line ends. Files are cut into ranges of `splitBytes`; a range has the frames that
begin in it and reads the last one to its end, so that each frame is read once however a file is cut, and a large file is read
by many tasks. A range is a task of its own as long as that makes few enough of them; beyond that a task reads neighbouring
ranges, and small files, in one go, 64 MB at most, so that tasks do not grow in number with the bytes alone.

As a stream (`readStream`) the files are logs that may grow. The offset of the stream is how far each file was read: the end of
its last whole frame, one that line ends follow. A file that appears later is read from its beginning; one that shrinks or goes
away is an error. What a batch reads, a text without line ends behind it too, a stream reads once these are there.

Options: `path`, `splitBytes`, `lineSep` (the files' line end). Files are found and read by pyarrow, in any file system
it knows by URI. A folder without files has no rows.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass, replace

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "file STRING, offset BIGINT, value STRING"
SPLIT_BYTES = 64 << 20
MOST_TASKS = 64  # of ranges that are smaller than SPLIT_BYTES
_CHUNK = 1 << 20
_BEYOND = 1 << 16  # read at a time behind a range, for its last frame


@dataclass
class Range(InputPartition):
    """Frames that begin in [first, last) of a file and end by `end`."""

    file: str
    first: int
    last: int
    end: int


@dataclass
class Ranges(InputPartition):
    """What one task reads."""

    parts: list[Range]


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _files(path: str) -> tuple[fs.FileSystem, list[fs.FileInfo]]:
    system, root = _system(path)
    found = system.get_file_info(fs.FileSelector(root, recursive=True))
    hidden = re.compile(r"/[._][^/]*(/|$)")
    return system, sorted((f for f in found if f.is_file and not hidden.search(f.path[len(root) :])), key=lambda f: f.path)


def _ranges(file: str, first: int, end: int, size: int) -> list[Range]:
    return [Range(file, at, min(at + size, end), end) for at in range(first, end, size)]


def _tasks(ranges: list[Range]) -> list[Ranges]:
    """Ranges dealt to tasks in their order, by bytes; what adjoins within a task is one range."""
    total = sum(r.last - r.first for r in ranges)
    most = max(MOST_TASKS, -(-total // SPLIT_BYTES))
    if len(ranges) <= most:
        return [Ranges([r]) for r in ranges]
    tasks: list[Ranges] = []
    done, number = 0, -1
    for r in ranges:
        if done * most // total > number:
            number = done * most // total
            tasks.append(Ranges([]))
        parts = tasks[-1].parts
        if parts and parts[-1].file == r.file and parts[-1].last == r.first:
            parts[-1] = replace(parts[-1], last=r.last)
        else:
            parts.append(r)
        done += r.last - r.first
    return tasks


def frames_of(system: fs.FileSystem, part: Range, newline: bytes) -> Iterator[tuple[int, str]]:
    """Place and text of the frames of a range, with no more than a frame and a chunk in memory."""
    border = re.compile(b"(?:" + re.escape(newline) + b"){2,}")
    step = len(newline)
    back = max(0, part.first - 2 * step)  # a frame begins behind a border that may lie before the range
    with system.open_input_file(part.file) as source:
        at, held, here = back, b"", 0  # where what is held begins, and how much of it is done

        def more() -> bool:
            nonlocal at, held, here
            end = at + len(held)
            size = min(_CHUNK, part.end - end, max(part.last - end, _BEYOND))
            read = source.read_at(size, end) if size > 0 else b""
            at, held, here = at + here, held[here:] + read, 0
            return bool(read)

        def next_border() -> tuple[int, int] | None:
            """The first border of what is held and not done; its whole run is held, or the file ends."""
            ahead = 0
            while True:
                found = border.search(held, here + ahead)
                if found and found.end() + step <= len(held):
                    return found.span()
                ahead = found.start() - here if found else max(0, len(held) - here - 2 * step)
                if not more():
                    found = border.search(held, here + ahead)
                    return found.span() if found else None

        if back:  # go to the first frame behind a border; the file's own beginning is one
            found = next_border()
            if found is None:
                return
            here = found[1]
        else:
            while True:
                while len(held) - here < step and more():
                    pass
                if held[here : here + step] != newline:
                    break
                here += step
        while at + here < part.last and (here < len(held) or more()):
            found = next_border()
            text = held[here : found[0] if found else len(held)]
            if not found and text.endswith(newline):
                text = text[:-step]
            if at + here >= part.first and text:
                yield at + here, text.decode("utf-8", "replace")
            if not found:
                return
            here = found[1]


def _batches(file: str, frames: Iterator[tuple[int, str]]) -> Iterator[pa.RecordBatch]:
    places, texts, size = [], [], 0

    def batch() -> pa.RecordBatch:
        columns = [pa.array([file] * len(places), pa.string()), pa.array(places, pa.int64()), pa.array(texts, pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["file", "offset", "value"])

    for at, text in frames:
        places.append(at)
        texts.append(text)
        size += len(text)
        if size >= _CHUNK or len(places) >= 10_000:
            yield batch()
            places, texts, size = [], [], 0
    if places:
        yield batch()


def _last_border(system: fs.FileSystem, file: str, first: int, size: int, newline: bytes) -> int:
    """Where the last whole frame ends, with the line ends behind it; `first` if none has ended since."""
    two, held, at = newline * 2, b"", size
    if at <= first:
        return first
    with system.open_input_file(file) as source:
        while at > first:
            begin = max(first, at - _CHUNK)
            held, at = source.read_at(at - begin, begin) + held[: len(two)], begin
            found = held.rfind(two)
            if found >= 0:
                return at + found + len(two)
    return first


class _Reading:
    def __init__(self, options: dict[str, str]) -> None:
        if "path" not in options:
            raise ValueError("the feed source needs a path")
        self.path = options["path"]
        self.split = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))
        self.newline = options.get("linesep", options.get("lineSep", "\n")).encode()
        if self.split < 1 or not self.newline:
            raise ValueError("splitBytes is a positive number and lineSep is not empty")

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        system = _system(self.path)[0]
        for part in partition.parts:
            yield from _batches(part.file, frames_of(system, part, self.newline))


class FeedReader(_Reading, DataSourceReader):
    def partitions(self) -> list[Ranges]:
        return _tasks([r for f in _files(self.path)[1] for r in _ranges(f.path, 0, f.size, self.split)]) or [Ranges([])]


class FeedStreamReader(_Reading, DataSourceStreamReader):
    """Offsets: how far each file has been read, as JSON text by file."""

    def initialOffset(self) -> dict:  # noqa: N802
        return {"files": "{}"}

    def latestOffset(self) -> dict:  # noqa: N802
        system, found = _files(self.path)
        before = getattr(self, "_before", {})
        self._before = {f.path: _last_border(system, f.path, before.get(f.path, 0), f.size, self.newline) for f in found}
        return {"files": json.dumps(self._before, sort_keys=True)}

    def partitions(self, start: dict, end: dict) -> list[Ranges]:
        first, last = json.loads(start["files"]), json.loads(end["files"])
        if any(last.get(file, 0) < at for file, at in first.items()):
            raise ValueError("a file of the feed has become shorter or is gone")
        return _tasks([r for file, at in sorted(last.items()) for r in _ranges(file, first.get(file, 0), at, self.split)])


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feed"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> FeedReader:
        return FeedReader(dict(self.options))

    def streamReader(self, schema: StructType) -> FeedStreamReader:  # noqa: N802
        return FeedStreamReader(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make `format("feed")` known to the session."""
    # the processes that plan a stream know none of the session's files, so the code goes along
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(FeedSource)
