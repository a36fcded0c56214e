import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyarrow import fs

from millrace.sources import feed_source
from millrace.sources.feed_source import Range, frames_of
from millrace.streaming import runners


def frames(data: bytes, newline: bytes) -> list[tuple[int, str]]:
    """Frames of a whole file, one by one."""
    out, at = [], 0
    while at < len(data):
        if data.startswith(newline, at):
            at += len(newline)
            continue
        end = data.find(newline * 2, at)
        text = data[at:] if end < 0 else data[at:end]
        if end < 0 and text.endswith(newline):
            text = text[: -len(newline)]
        out.append((at, text.decode("utf-8", "replace")))
        at = len(data) if end < 0 else end
    return out


pieces = st.lists(st.sampled_from(["a", "bc", "é", "data: x", "\n", "\n\n", "\n\n\n"]), max_size=25)


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pieces, st.integers(1, 9), st.sampled_from(["\n", "\r\n"]), st.integers(1, 40))
def test_every_frame_once_however_a_file_is_cut(tmp_path, monkeypatch, parts, split, newline, chunk):
    monkeypatch.setattr(feed_source, "_CHUNK", chunk)
    data = "".join(parts).replace("\n", newline).encode()
    path = tmp_path / "feed.txt"
    path.write_bytes(data)
    found = []
    for first in range(0, len(data), split):
        part = Range(str(path), first, min(first + split, len(data)), len(data))
        found += list(frames_of(fs.LocalFileSystem(), part, newline.encode()))
    assert found == frames(data, newline.encode())


def test_a_large_file_is_read_by_several_tasks(spark, tmp_path):
    feed_source.register(spark)
    text = "".join(f"id: {k}\ndata: {json.dumps({'k': k, 'x': 'y' * (k % 50)})}\n\n" for k in range(20_000))
    (tmp_path / "one.txt").write_text(text)
    (tmp_path / "_SUCCESS").write_text("no frame")
    read = spark.read.format("feed").option("splitBytes", 1 << 16).load(str(tmp_path))
    assert read.rdd.getNumPartitions() == -(-len(text) // (1 << 16)) > 10
    rows = sorted(read.select("offset", "value").collect())
    assert [tuple(r) for r in rows] == frames(text.encode(), b"\n") and len(rows) == 20_000


def test_few_tasks_for_many_ranges(tmp_path):
    """Tasks do not grow in number with ranges or files, and still read each frame once."""
    whole = {}
    for name, n in (("a", 4_000), ("b", 1), ("c", 700), *((f"d{k}", 2) for k in range(100))):
        data = "".join(f"id: {k}\ndata: {'z' * (k % 40)}\n\n" for k in range(n)).encode()
        (tmp_path / name).write_bytes(data)
        whole[str(tmp_path / name)] = frames(data, b"\n")
    reader = feed_source.FeedReader({"path": str(tmp_path), "splitbytes": "50"})
    tasks = reader.partitions()
    assert 10 < len(tasks) <= feed_source.MOST_TASKS
    found = {}
    for task in tasks:
        for batch in reader.read(task):
            for file, at, value in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                found.setdefault(file, []).append((at, value))
    assert found == whole


def test_empty_folders_and_options(spark, tmp_path):
    feed_source.register(spark)
    assert spark.read.format("feed").load(str(tmp_path)).collect() == []
    (tmp_path / "empty.txt").write_text("")
    assert spark.read.format("feed").load(str(tmp_path)).collect() == []
    for wrong in ({"splitBytes": "0"}, {"lineSep": ""}):
        with pytest.raises(ValueError):
            feed_source._Reading({"path": "x", **wrong})


def test_stream_goes_on_in_growing_files(spark, tmp_path):
    """A frame that is not whole yet waits; a restart reads nothing twice."""
    feed_source.register(spark)
    feed, out, checkpoints = tmp_path / "feed", str(tmp_path / "out"), str(tmp_path / "checkpoints")
    feed.mkdir()

    def go():
        read = spark.readStream.format("feed").option("splitBytes", 7).load(str(feed))
        stream = read.writeStream.format("parquet").option("path", out).outputMode("append")
        runners.start(stream, "feed", checkpoints, until_caught_up=True).awaitTermination()
        return sorted(r.value for r in spark.read.schema(feed_source.SCHEMA).parquet(out).collect())

    (feed / "a.txt").write_text("data: 1\n\ndata: 2\n\ndata: ")
    assert go() == ["data: 1", "data: 2"]
    (feed / "a.txt").write_text("data: 1\n\ndata: 2\n\ndata: 3\n\ndata: 4")
    (feed / "b.txt").write_text("\n\ndata: 5\n\n")
    assert go() == ["data: 1", "data: 2", "data: 3", "data: 5"]
    assert go() == ["data: 1", "data: 2", "data: 3", "data: 5"]
    (feed / "a.txt").write_text("data: 1\n\ndata: 2\n\ndata: 3\n\ndata: 4\n\n\n")
    assert go() == [f"data: {k}" for k in range(1, 6)]
