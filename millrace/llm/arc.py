"""Legacy ARC archives, versions 1 and 2, and their conversion to WARC.

`write_arc` stores pages as ARC files, `read_arc` parses them by their version's header line and the
declared lengths, `write_warc` stores what was read as WARC 1.1 with record ids, dates, types and
digests made from what an ARC record holds, `read_warc` reads those back. Archives are written by
Spark's own committed file writes, one file a task, gzip-compressed; a lost executor's files are made anew.

Record ids are derived from the archive's name and the record's place in it, so a rerun gives the same.
Of records with equal payloads of `REVISIT_BYTES` or more the one with the smallest page id (then record
id; without a page id last) is a response, the others revisit it and hold no payload of their own.

A null html is an empty payload, a null url is written as `urn:none`; a null page_id stays null. Repeated
page ids are separate records. A record cut short by the end of its file is kept with `WARC-Truncated`; a
line that is no header is passed over. No pages give archives without records. Other columns are not looked at.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import cut, folder, map_batches
from millrace.session import broadcast_if_small

REVISIT_BYTES = 100
CAPTURED = "20000101000000"
# fixed values: the field lines of the two versions' headers
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PAGE_HEADER = "X-Page-Id"
_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:millrace:arc")
_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _arc_head(version: int, url: str, kind: str, code: int, offset: int, name: str, length: int) -> bytes:
    front = [url, "0.0.0.0", CAPTURED, kind]
    middle = [str(code), "-", "-", str(offset), name] if version == 2 else []
    return " ".join([*front, *middle, str(length)]).encode() + b"\n"


def _to_arc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    version, name = 1 + part % 2, f"pages-{part:06d}.arc"
    block = f"{version} 0 millrace\n{ARC_FIELDS[version]}\n".encode()
    first = _arc_head(version, f"filedesc://{name}", "text/plain", 200, 0, name, len(block)) + block
    yield pa.RecordBatch.from_arrays([pa.array([first], pa.binary())], names=["value"])
    offset = len(first) + 1
    for batch in batches:
        records = []
        for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html")), strict=True):
            head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            head += "" if page is None else f"{PAGE_HEADER}: {page}\r\n"
            body = f"{head}\r\n".encode() + (html or "").encode()
            place = quote(url, safe="%/:?#[]@!$&'()*+,;=~-._") if url else "urn:none"
            records.append(_arc_head(version, place, "text/html", 200, offset, name, len(body)) + body)
            offset += len(records[-1]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], names=["value"])


def write_arc(pages: DataFrame, path: str) -> None:
    """`pages(page_id, url, html)` as ARC files, versions 1 and 2 by turns."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    made = map_batches(rows, _to_arc, "value binary").select(F.col("value").cast("string").alias("value"))
    made.write.options(**_GZIP).option("lineSep", "\n").text(path)


@dataclass
class ArcRecord:
    archive: str
    offset: int
    url: str
    ip: str
    date: str
    kind: str
    body: bytes
    truncated: bool


_HEAD = re.compile(rb"^(\S.*) (\S+) (\d{8,17}) (\S+)((?: \S+){5})? (\d+)$")


def parse_arc(stream: io.BufferedIOBase, name: str) -> Iterator[ArcRecord]:
    """The records of an ARC stream after its version block. `name` is used if the block names no archive."""
    version, offset = 1, 0
    while line := stream.readline():
        start, offset = offset, offset + len(line)
        text = line.rstrip(b"\r\n")
        if not text:
            continue
        count = len(ARC_FIELDS[version].split())
        parts = text.rsplit(b" ", count - 1)
        if text.startswith(b"filedesc:"):
            parts = text.split(b" ")
        elif len(parts) != count or not _HEAD.match(text):
            continue
        if not parts[-1].isdigit():
            continue
        length = int(parts[-1])
        body = stream.read(length)
        offset += len(body)
        if parts[0].startswith(b"filedesc:"):
            name = parts[0].decode("utf-8", "replace").removeprefix("filedesc://") or name
            lead = body.split(b" ", 1)[0]
            version = int(lead) if lead in (b"1", b"2") else 1
            continue
        url, ip, date, kind = (p.decode("utf-8", "replace") for p in parts[:4])
        yield ArcRecord(name, start, url, ip, date, kind, body, len(body) < length)


def split_http(body: bytes) -> tuple[bytes, bytes] | None:
    """Head with its blank line and payload of an HTTP response; None if it is none."""
    if not body.startswith(b"HTTP/"):
        return None
    ends = [(p + len(s)) for s in (b"\r\n\r\n", b"\n\n") if (p := body.find(s)) >= 0]
    end = min(ends, default=len(body))
    return body[:end], body[end:]


def _page_of(head: bytes) -> int | None:
    found = re.search(rb"(?im)^" + PAGE_HEADER.encode() + rb":[ \t]*(-?\d+)\s*$", head)
    return int(found[1]) if found else None


def _iso(date: str) -> str:
    d = (date + "00000101000000"[len(date) :])[:14] if len(date) < 14 else date[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


_RECORD = (
    "record_id string, page_id long, url string, ip string, date string, kind string, http boolean, truncated boolean, "
    "payload_bytes long, payload_digest string"
)


def _from_arc(with_body: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 4, pa.bool_(), pa.bool_(), pa.int64(), pa.string()]
        names = [x.split()[0] for x in _RECORD.split(", ")]
        if with_body:
            kinds, names = [*kinds, pa.binary(), pa.binary()], [*names, "head", "payload"]

        def make(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, size = [], 0
                file = path.as_py().rsplit("/", 1)[-1]
                with gzip.GzipFile(fileobj=io.BytesIO(content.as_py())) as stream:
                    for r in parse_arc(io.BufferedReader(stream, 1 << 16), file):
                        parts = split_http(r.body)
                        head, payload = parts or (b"", r.body)
                        key = uuid.uuid5(_NAMESPACE, f"{r.archive}/{r.offset}")
                        row = [f"<urn:uuid:{key}>", _page_of(head), r.url, r.ip, _iso(r.date), r.kind, parts is not None, r.truncated]
                        row += [len(payload), hashlib.sha256(payload).hexdigest()]
                        rows.append([*row, head, payload] if with_body else row)
                        size += len(r.body) if with_body else 200
                        if size > 8 << 20:
                            yield make(rows)
                            rows, size = [], 0
                yield make(rows)

    return run


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def read_arc(spark: SparkSession, path: str, with_body: bool = True) -> DataFrame:
    """One row for every record of the ARC files; `head` and `payload` only if `with_body`."""
    return map_batches(_files(spark, path), _from_arc(with_body), _RECORD + ", head binary, payload binary" * with_body)


def revisits(records: DataFrame, at_least: int = REVISIT_BYTES) -> DataFrame:
    """`record_id, refers_to, refers_url, refers_date` of the records that repeat another's payload."""
    keys = records.filter(F.col("payload_bytes") >= at_least).select("record_id", "page_id", "payload_digest", "url", "date")
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id", "url", "date")
    first = keys.groupBy("payload_digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = keys.select("record_id", "payload_digest").join(first, "payload_digest").filter("record_id != first.record_id")
    return found.select(
        "record_id",
        F.col("first.record_id").alias("refers_to"),
        F.col("first.url").alias("refers_url"),
        F.col("first.date").alias("refers_date"),
    )


def _warc_record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


def _digest(data: bytes) -> str:
    return f"sha256:{hashlib.sha256(data).hexdigest()}"


def _to_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    about = b"software: millrace\r\nformat: WARC File Format 1.1\r\nconverted-from: ARC\r\n"
    key = f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'warcinfo/{part}')}>"
    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", key), ("WARC-Date", _iso(CAPTURED))]
    first = _warc_record([*info, ("Content-Type", "application/warc-fields")], about)
    yield pa.RecordBatch.from_arrays([pa.array([first], pa.binary())], names=["value"])
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            again = r["refers_to"] is not None
            block = r["head"] if again else r["head"] + r["payload"]
            kind = "revisit" if again else "response" if r["http"] else "resource"
            profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
            fields = [
                ("WARC-Type", kind),
                ("WARC-Record-ID", r["record_id"]),
                ("WARC-Date", r["date"]),
                ("WARC-Target-URI", r["url"]),
                ("WARC-IP-Address", r["ip"]),
                ("WARC-Payload-Digest", f"sha256:{r['payload_digest']}"),
                ("WARC-Block-Digest", _digest(block)),
                ("WARC-Profile", profile if again else None),
                ("WARC-Refers-To", r["refers_to"]),
                ("WARC-Refers-To-Target-URI", r["refers_url"]),
                ("WARC-Refers-To-Date", r["refers_date"]),
                ("WARC-Truncated", "length" if r["truncated"] else None),
                ("Content-Type", "application/http; msgtype=response" if r["http"] else r["kind"]),
            ]
            out.append(_warc_record(fields, block))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])


def write_warc(records: DataFrame, repeated: DataFrame, path: str) -> None:
    """`read_arc`'s rows as WARC files; those in `repeated` (see `revisits`) as revisits without a payload."""
    rows = records.join(broadcast_if_small(repeated), "record_id", "left")
    made = map_batches(rows, _to_warc, "value binary").select(F.col("value").cast("string").alias("value"))
    made.write.options(**_GZIP).option("lineSep", "\r\n\r\n").text(path)


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of every record."""
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            continue
        fields: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, stream.read(int(fields.get("content-length", 0)))


def _from_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["record_id", "page_id", "url", "date", "record_type", "payload_bytes", "payload_digest", "declared_digest", "refers_id"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    for batch in batches:
        for content in batch.column("content"):
            rows = []
            with gzip.GzipFile(fileobj=io.BytesIO(content.as_py())) as stream:
                for fields, block in parse_warc(io.BufferedReader(stream, 1 << 16)):
                    kind = fields.get("warc-type")
                    if kind not in ("response", "resource", "revisit"):
                        continue
                    head, payload = split_http(block) or (b"", block)
                    own = kind != "revisit"
                    rows.append(
                        [
                            fields["warc-record-id"], _page_of(head), fields.get("warc-target-uri"), fields.get("warc-date"), kind,
                            len(payload) if own else None, hashlib.sha256(payload).hexdigest() if own else None,
                            fields.get("warc-payload-digest", "").removeprefix("sha256:"), fields.get("warc-refers-to"),
                        ]
                    )
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row for every response, resource and revisit; lengths and digests are of the payloads read.

    A revisit has them from the record it refers to. The files are read once, when this is called.
    """
    rows = cut(
        map_batches(
            _files(spark, path),
            _from_warc,
            "record_id string, page_id long, url string, date string, record_type string, payload_bytes long, "
            "payload_digest string, declared_digest string, refers_id string",
        )
    )
    own = rows.filter("refers_id IS NULL").withColumn("refers_to", F.lit(None).cast("long"))
    again = rows.filter("refers_id IS NOT NULL").drop("payload_bytes", "payload_digest")
    heads = own.select(
        F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"), "payload_bytes", "payload_digest"
    ).join(again.select("refers_id").distinct(), "refers_id", "left_semi")
    # the heads are as many as there are payloads with revisits; a payload's revisits may be very many
    found = again.join(broadcast_if_small(heads), "refers_id", "left")
    return own.unionByName(found).drop("refers_id")


def convert(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Pages to ARC files, those to WARC files, and what the WARC files hold.

    The archives are in `path`, or in a fresh folder of the shared one that goes with the session.
    """
    spark = pages.sparkSession
    path = path or folder(spark, "archives")
    write_arc(pages, f"{path}/arc")
    repeated = revisits(cut(read_arc(spark, f"{path}/arc", with_body=False)))
    write_warc(read_arc(spark, f"{path}/arc"), repeated, f"{path}/warc")
    return read_warc(spark, f"{path}/warc")
