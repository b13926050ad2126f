"""Legacy archives to WARC: an ARC parser, a converter, and a WARC writer and reader.

ARC files of version 1 and 2 differ in their header lines (5 and 10 fields); in both the last field is the length of the
block that follows, and only that length says where it ends. The converter gives each ARC record a WARC identifier (from its
URL, date and digest), a timestamp, a type and a SHA-1 payload digest. Of records with equal payloads one is a response
and the others are revisits that refer to it and carry no payload.

An archive file begins with a `warcinfo` record made from the ARC file's version block. Every record is a gzip member of its own, so a
reader can begin at any of them. A file is closed at ARCHIVE_BYTES, so it is that and one record long at most, whatever the size of
the records; tasks read files one by one, member by member. Files are written with Spark's text writer, which puts a line separator
after each row: a member's last byte is the top byte of its text's length, which is zero for texts under 16 MB and for the empty
member that is added to others, so the separator is a zero byte that stands for it.

Nulls: a null payload is empty; a null URL is `urn:missing`; a null page_id is never the response while an equal payload has
an id, and if none has, all are responses. Ties and repeated rows: all rows of the largest page_id are responses. An empty table gives
an archive without records and reads back as no rows. A very long payload is one record, held whole by the task that writes or reads it.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "code", "checksum", "location", "offset", "filename", "length"),
}
"""Fixed values: the header fields of ARC versions 1 and 2, in order."""

DATE = "20240101000000"
ARCHIVE_BYTES = 64 << 20
PER_ARC = 64


@dataclass
class ArcRecord:
    version: int
    url: str
    date: str
    type: str
    block: bytes
    extra: dict[str, str]


def write_arc(version: int, records: list[tuple[str, str, str, bytes]]) -> bytes:
    """An ARC file of (url, date, type, block) records: a version block that names the fields, then the records."""
    names = {1: "URL IP-address Archive-date Content-type Archive-length", 2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}[version]
    out = io.BytesIO()

    def put(url: str, date: str, kind: str, block: bytes) -> None:
        values = {"url": url, "ip": "0.0.0.0", "date": date, "type": kind, "code": "200", "checksum": "-", "location": "-", "offset": str(out.tell()), "filename": "pages.arc", "length": str(len(block))}
        out.write(" ".join(values[f] for f in FIELDS[version]).encode() + b"\n" + block + b"\n")

    put("filedesc://pages.arc", DATE, "text/plain", f"{version} 0 recsieve\n{names}\n".encode())
    for record in records:
        put(*record)
    return out.getvalue()


def read_arc(data: bytes) -> Iterator[ArcRecord]:
    """The records of an ARC file, without its version block. Raises ValueError where lengths and lines don't agree."""
    at, version = 0, 0
    while at < len(data):
        if data[at : at + 1] == b"\n":  # a blank line before the next record
            at += 1
            continue
        end = data.index(b"\n", at)
        parts = data[at:end].decode("ascii").split(" ")
        length = int(parts[-1])
        block = data[end + 1 : end + 1 + length]
        if len(block) < length:
            raise ValueError(f"record at byte {at}: {length} bytes declared, {len(block)} there")
        if not version:
            version = int(block[:1])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version}")
            if len(parts) not in (5, len(FIELDS[version])):
                raise ValueError(f"version block with {len(parts)} fields")
        else:
            if len(parts) != len(FIELDS[version]):
                raise ValueError(f"record at byte {at}: {len(parts)} fields in version {version}")
            named = dict(zip(FIELDS[version], parts))
            yield ArcRecord(version, named.pop("url"), named.pop("date"), named.pop("type"), block, named)
        at = end + 1 + length + 1


def arc_info(data: bytes) -> dict[str, str]:
    """What an ARC file's version block says: its version, who made it, and the fields of its records."""
    head, _, rest = data.partition(b"\n")
    lines = rest[: int(head.split(b" ")[-1])].decode("ascii").splitlines()
    version, _, origin = lines[0].split(" ", 2)
    return {"arc-file": head.split(b" ")[0].decode("ascii"), "arc-version": version, "arc-origin": origin, "arc-fields": lines[1]}


def to_warcinfo(info: dict[str, str], name: str) -> str:
    """The record that an archive of this name begins with."""
    block = "".join(f"{k}: {v}\r\n" for k, v in {"software": "recsieve", "format": "WARC File Format 1.0", **info}.items())
    lines = ["WARC/1.0", "WARC-Type: warcinfo", f"WARC-Record-ID: {record_id(name, DATE, digest_of(block.encode()), None)}", f"WARC-Date: {iso(DATE)}", f"WARC-Filename: {name}", "Content-Type: application/warc-fields", f"Content-Length: {len(block.encode())}"]
    return "\r\n".join(lines) + "\r\n\r\n" + block + "\r\n\r\n"


def iso(d: str) -> str:
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def digest_of(block: bytes) -> str:
    return base64.b32encode(hashlib.sha1(block).digest()).decode()


def record_id(url: str, date: str, digest: str, number: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(f'{url} {date} {digest} {number}'.encode()).digest()[:16], version=5)}>"


def to_warc(arc: ArcRecord, number: int | None, refers_to: tuple[int, str] | None) -> str:
    """The WARC record for an ARC record. refers_to: page and URL of the response with this payload."""
    digest = digest_of(arc.block)
    lines = [
        "WARC/1.0", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(arc.url, arc.date, digest, number)}",
        f"WARC-Date: {iso(arc.date)}", f"WARC-Target-URI: {arc.url}", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-IP-Address: {arc.extra['ip']}", f"Content-Type: {arc.type}", f"X-Payload-Length: {len(arc.block)}", f"X-ARC-Version: {arc.version}",
    ]
    if number is not None:
        lines.append(f"X-Page-ID: {number}")
    if refers_to is not None:
        page, url = refers_to
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest", f"WARC-Refers-To: {record_id(url, DATE, digest, page)}",
            f"WARC-Refers-To-Target-URI: {url}", f"WARC-Refers-To-Date: {iso(DATE)}", f"X-Refers-To-Page: {page}",
        ]
    block = "" if refers_to is not None else arc.block.decode()
    lines.append(f"Content-Length: {0 if refers_to is not None else len(arc.block)}")
    return "\r\n".join(lines) + "\r\n\r\n" + block + "\r\n\r\n"


def member(record: str) -> bytes:
    """A record as a gzip member, or that and an empty one, without the last byte, which is zero."""
    data = gzip.compress(record.encode(), 6, mtime=0)
    return (data if data[-1] == 0 else data + gzip.compress(b"", mtime=0))[:-1]


def read_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record; the block's end is where Content-Length says."""
    while line := stream.readline():
        if line.rstrip(b"\r\n") != b"WARC/1.0":
            raise ValueError(f"no WARC record here: {line[:40]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            name, _, value = line.decode().rstrip("\r\n").partition(": ")
            headers[name] = value
        size = int(headers["Content-Length"])
        block = stream.read(size)
        if len(block) != size or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record {headers.get('WARC-Record-ID')} doesn't end where its length says")
        yield headers, block


def target(url: str | None) -> str:
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "urn:missing"


def _convert(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows to ARC files of a few records, of either version by turns, and these to members of WARC files."""
        task, turn, number, size = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            for i in range(0, batch.num_rows, PER_ARC):
                numbers, urls, payloads, refers, refer_urls = (batch.column(c).slice(i, PER_ARC).to_pylist() for c in ("number", "url", "payload", "refers_to", "refers_url"))
                turn += 1
                arc = write_arc(1 + turn % 2, [(target(u), DATE, "text/html", p.encode()) for u, p in zip(urls, payloads)])
                names, members = [], []
                for record, n, to, to_url in zip(read_arc(arc), numbers, refers, refer_urls, strict=True):
                    name = f"{task:06d}-{number:06d}"
                    if not size:
                        names.append(name)
                        members.append(member(to_warcinfo(arc_info(arc), name)))
                    names.append(name)
                    members.append(member(to_warc(record, n, None if to is None else (to, target(to_url)))))
                    size += len(members[-1])
                    if size >= most:
                        number, size = number + 1, 0
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(members, pa.binary())], names=["archive", "value"])

    return run


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> None:
    """A folder of gzipped WARC files with a record per row of pages."""
    rows = pages.select(F.col(id_col).cast("long").alias("number"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.encode("payload", "UTF-8"))))
    # sums by payload first: of a payload that a third of all pages share, one row leaves each task
    last = rows.groupBy("digest").agg(F.max(F.struct("number", "url")).alias("last"), F.count("*").alias("n")).where("n > 1").select("digest", "last")
    places = rows.select("digest", "number").join(last, "digest").where("not (number <=> last.number)").select(F.col("number").alias("own"), F.col("digest").alias("same"), "last").distinct()
    # joined on page and payload, so rows of one payload don't meet in one place
    out = rows.join(places, F.col("number").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("same")), "left")
    out = out.select("number", "url", "payload", F.col("last.number").alias("refers_to"), F.col("last.url").alias("refers_url"))
    files = out.mapInArrow(_convert(archive_bytes), "archive string, value binary").select("archive", F.col("value").cast("string").alias("value"))
    files.write.partitionBy("archive").option("lineSep", "\0").text(path)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["number", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id", "date"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    whole = lambda x: None if x is None else int(x)
    for batch in batches:
        for content in batch.column("content"):
            rows: list[tuple] = []
            for h, block in read_warc(gzip.GzipFile(fileobj=pa.BufferReader(content.as_buffer()))):
                if h["WARC-Type"] == "warcinfo":
                    continue
                digest = h["WARC-Payload-Digest"].removeprefix("sha1:")
                if h["WARC-Type"] == "response" and digest_of(block) != digest:
                    raise ValueError(f"record {h['WARC-Record-ID']}: payload and digest differ")
                rows.append((whole(h.get("X-Page-ID")), int(h["X-Payload-Length"]), digest, h["WARC-Type"], whole(h.get("X-Refers-To-Page")), h["WARC-Target-URI"], h["WARC-Record-ID"], h["WARC-Date"]))
                if len(rows) == 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def read_archives(spark: SparkSession, path: str, id_col: str = "page_id") -> DataFrame:
    """Per record: id_col, payload_bytes, payload_digest, record_type, refers_to, url, record_id, date."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select("content")
    schema = "number long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, record_id string, date string"
    return files.mapInArrow(_parse, schema).withColumnRenamed("number", id_col)


