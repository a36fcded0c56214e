"""The keyed table as a stream of its changes: a row when a key's row changes, a retraction when it goes.

State per key is what `operators.keyed` merges: its last upsert and delete and the last write of each cell. It is
kept by Spark in the checkpoint and grows with the number of keys, as the table does. Keys are dealt by a hash into groups,
and a group's states are one columnar value, merged with all its writes at once: a call into Python a group, not a key.
A micro-batch writes anew the groups that it touches. Writes of a key may come in any order and more than once; one that
changes nothing of the row tells nothing. A key's changes are numbered from 1, so that a reader that takes each key's last
one has the table. A micro-batch tells at most one change of a key. All writes of a group in a micro-batch go through one
task, in Arrow batches, of which only the running greatest are held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState

from millrace.schemas import DELETE, KEY, UPSERT
from millrace.session import ship
from millrace.sources import files
from millrace.streaming.runners import run_of

ROW, GONE = "row", "gone"
CHANGE = (
    "domain STRING, created_at TIMESTAMP, user_id STRING, page_title STRING, user_is_bot BOOLEAN, change STRING, version BIGINT"
)
GROUPS = 4096
_STATE = "states BINARY"
_NONE = -(1 << 63)  # for a null in a column of numbers, and the place of a write that has not been
_TOLD = "domain STRING, created_us BIGINT, user_id STRING, page_title STRING, user_is_bot BOOLEAN, change STRING, version BIGINT"
_KEYS = ("domain", "created_us", "user_id")
_PLACE = ("micros", "partition", "offset")
_PARTS = ("up", "gone", "page_title", "user_is_bot")  # each with the place of its last write
_TEXTS = ("domain", "user_id", "page_title")

Columns = dict[str, np.ndarray]


def _schema() -> pa.Schema:
    numbers = ["created_us", *(f"{part}.{name}" for part in _PARTS for name in _PLACE), "version"]
    texts = [(name, pa.string()) for name in _TEXTS]
    return pa.schema([*texts, ("user_is_bot", pa.int8()), *((name, pa.int64()) for name in numbers)])


def _pack(held: Columns) -> bytes:
    schema, sink = _schema(), pa.BufferOutputStream()
    arrays = [pa.array(held[field.name], field.type, from_pandas=True) for field in schema]
    with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(pa.RecordBatch.from_arrays(arrays, schema=schema))
    return sink.getvalue().to_pybytes()


def _unpack(data: bytes | None) -> Columns:
    if data is None:
        return {f.name: np.empty(0, object if f.name in _TEXTS else f.type.to_pandas_dtype()) for f in _schema()}
    table = pa.ipc.open_stream(data).read_all()
    return {name: table[name].to_numpy().copy() for name in table.column_names}


def _numbered(columns: list[np.ndarray]) -> np.ndarray:
    """Rows that agree in all columns by one number, from 0 in order of appearance. Nulls agree."""
    number = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        code, values = pd.factorize(column)
        number = pd.factorize(number * (len(values) + 1) + code + 1)[0].astype(np.int64)
    return number


def _last(key: np.ndarray, place: list[np.ndarray], value: np.ndarray) -> np.ndarray:
    """The last write of each key, in order of keys; of two at one place that with the greater value."""
    order = np.lexsort((value, *place[::-1], key))
    ordered = key[order]
    return order[np.append(ordered[1:] != ordered[:-1], True)] if len(order) else order


def merged(held: Columns, writes: Columns) -> Columns:
    """States of a group's keys, in the order of those held and then of new ones, with writes in."""
    old = len(held["version"])
    key = _numbered([np.concatenate([held[name], writes[name]]) for name in _KEYS])
    n = int(key.max()) + 1 if len(key) else 0
    first = np.full(n, len(key))
    np.minimum.at(first, key, np.arange(len(key)))
    out = {name: np.concatenate([held[name], writes[name]])[first] for name in _KEYS}
    out["version"] = np.append(held["version"], np.zeros(n - old, np.int64))
    deleted = writes["deleted"]
    takes = {
        "up": ~deleted,
        "gone": deleted,
        "page_title": ~deleted & ~pd.isna(writes["page_title"]),
        "user_is_bot": ~deleted & (writes["user_is_bot"] >= 0),
    }
    for part, take in takes.items():
        whose = np.append(key[:old], key[old:][take])
        place = [np.append(held[f"{part}.{name}"], writes[name][take]) for name in _PLACE]
        value = np.append(held[part], writes[part][take]) if part in held else np.zeros(len(whose), np.int8)
        last = _last(whose, place, pd.factorize(value, sort=True)[0] if part in _TEXTS else value)
        for name, column in zip(_PLACE, place, strict=True):
            out[f"{part}.{name}"] = np.full(n, _NONE)
            out[f"{part}.{name}"][whose[last]] = column[last]
        if part in held:
            out[part] = np.full(n, None, object) if part in _TEXTS else np.full(n, -1, np.int8)
            out[part][whose[last]] = value[last]
    return out


def _rows(held: Columns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether keys have a row, and its cells."""

    def stands(part: str) -> np.ndarray:
        later = np.zeros(len(held["version"]), bool)
        for name in _PLACE[::-1]:
            own, gone = held[f"{part}.{name}"], held[f"gone.{name}"]
            later = (own > gone) | ((own == gone) & later)
        return later

    live = stands("up")
    title = np.where(live & stands("page_title"), held["page_title"], None)
    return live, title, np.where(live & stands("user_is_bot"), held["user_is_bot"], -1)


def step(group: tuple, writes: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Merge writes of a group's keys into their states, and tell the rows that are others now."""
    before = held = _unpack(bytes(state.get[0]) if state.exists else None)
    for chunk in writes:
        held = merged(held, {name: chunk[name].to_numpy() for name in chunk.columns})
    old = len(before["version"])
    live, title, bot = _rows(held)
    had, had_title, had_bot = _rows(before)
    changed = live.copy()
    changed[:old] = (live[:old] != had) | (title[:old] != had_title) | (bot[:old] != had_bot)
    held["version"] += changed
    state.update((_pack(held),))
    if changed.any():
        flag = np.where(bot < 0, None, bot > 0)
        cells = {"page_title": title, "user_is_bot": flag, "change": np.where(live, ROW, GONE).astype(object)}
        told = {name: held[name] for name in _KEYS} | cells | {"version": held["version"]}
        yield pd.DataFrame({name: column[changed] for name, column in told.items()})


def row_changes(log: DataFrame, groups: int = GROUPS) -> DataFrame:
    """A stream of log rows (`schemas.EDIT_LOG`) -> changes of the rows they amount to. For output mode `update`.

    `groups` stays what it was as long as a checkpoint is used; a group should have some thousands of keys at most.
    """
    ship(log.sparkSession)
    number = lambda column, least=_NONE: F.coalesce(column, F.lit(least))
    flat = log.filter(F.col("op").isin(UPSERT, DELETE)).select(
        F.pmod(F.xxhash64(*KEY), F.lit(groups)).alias("key_group"),
        "domain",
        number(F.unix_micros("created_at")).alias("created_us"),
        "user_id",
        (F.col("op") == DELETE).alias("deleted"),
        number(F.unix_micros("seq.timestamp"), _NONE + 1).alias("micros"),  # a write without a place comes before all others
        number(F.col("seq.partition").cast("long")).alias("partition"),
        number(F.col("seq.offset")).alias("offset"),
        "page_title",
        number(F.col("user_is_bot").cast("byte"), -1).cast("byte").alias("user_is_bot"),
    )
    told = flat.groupBy("key_group").applyInPandasWithState(step, _TOLD, _STATE, "update", "NoTimeout")
    created_at = F.when(F.col("created_us") != _NONE, F.timestamp_micros("created_us")).alias("created_at")
    names = [part.split()[0] for part in CHANGE.split(", ")]
    return told.select(*[created_at if name == "created_at" else name for name in names])


def changes_stream(log: DataFrame, path: str, groups: int = GROUPS) -> DataStreamWriter:
    """Changes into a folder, by micro-batch; one that is run again replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        at = f"{path.rstrip('/')}/{files.batch_name(run_of(batch), batch_id)}"
        batch.write.options(**files.MARKED).mode("overwrite").parquet(at)

    return row_changes(log, groups).writeStream.foreachBatch(write).outputMode("update")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """All changes that finished micro-batches have left."""
    marks = files.glob(spark, f"{path.rstrip('/')}/run=*/batch_id=*/_SUCCESS")
    if not marks:
        return spark.createDataFrame([], CHANGE)
    return spark.read.schema(CHANGE).parquet(*[mark.rsplit("/", 1)[0] for mark in marks])


def replayed(changes: DataFrame) -> DataFrame:
    """The table that changes amount to: each key's last one, unless that is a retraction."""
    cells = ("page_title", "user_is_bot", "change")
    last = changes.groupBy(*KEY).agg(F.max_by(F.struct(*cells), "version").alias("last"))
    live = last.filter(F.col("last.change") == ROW)
    return live.select("user_id", "domain", "last.page_title", "created_at", "last.user_is_bot")
