"""Web archives: legacy ARC files converted to WARC.

An ARC file opens with a ``filedesc:`` record that names its version and, one by one, the fields of the
header lines that follow; each record is such a line and as many bytes as its last field declares. The
converter reads both versions and synthesises what WARC asks for: record ids (named by the record's place, its file and number,
so that each is unique and converting the same files again gives the same), ISO timestamps from 14 digits, types (``filedesc:`` warcinfo, HTTP
responses, anything else resource), block and payload digests. Files are compressed record by record.

Records with equal payloads of at least ``MIN_REVISIT`` bytes keep one response, that with the largest id;
the others become revisits of it (of records that share that id all stay responses, and the last of them in place is referred to). Groups are counted over digests and lengths alone (pre-aggregated, so one
payload may be a third of all records); only groups of two or more meet the records again, broadcast if
few. Each task streams its files record by record.

Defined cases: null payloads are empty; null and empty urls become ``urn:page:`` and the id; blanks and controls in
urls are percent-encoded; records of one id are all written; a record with a null id takes part, as a revisit if
its group has an id, and reads back as null; HTTP heads may end in bare line feeds; a header line without its fields, or a record that
ends early, is an error; a very long page is one record in memory; an empty table gives no files and no rows. Other columns play no part, whatever their names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .common import column, fresh_path, materialise, small_side

#: Header lines by version.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length".split(),
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length".split(),
}
MIN_REVISIT = 1000
HEAD_END = re.compile(rb"\r?\n\r?\n")
LEVEL = 3
#: Compressed bytes after which a task begins another file.
FILE_BYTES = 256 << 20
ID_HEADER = "X-Page-Id"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # names that are URLs (RFC 4122)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LISTED = "path string, records long"
RECORD = "id long, place string, uri string, ip string, date string, mime string, block binary, head_bytes long"
INDEX = "id long, place string, payload_bytes long, sha256 string"


def member(data: bytes) -> bytes:
    """A gzip member without a name or time."""
    c = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


class Roll:
    """Files of one task; ``listed`` has a row for each."""

    def __init__(self, folder: str, suffix: str, first: Any) -> None:
        self.folder, self.suffix, self.first = folder, suffix, first
        self.out, self.size, self.listed = None, 0, []

    def add(self, data: bytes) -> None:
        if self.out is None or self.size >= FILE_BYTES:
            self.close()
            name = f"{uuid.uuid4().hex}{self.suffix}"
            self.out, self.size = files.open_new(self.folder, name), 0
            self.listed.append([f"{self.folder}/{name}", 0])
            self.out.write(member(self.first(name)))
        packed = member(data)
        self.out.write(packed)
        self.size += len(packed)
        self.listed[-1][1] += 1

    def close(self) -> None:
        if self.out:
            self.out.close()
            self.out = None

    def rows(self) -> pa.RecordBatch:
        self.close()
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in self.listed], pa.string()), pa.array([r[1] for r in self.listed], pa.int64())], names=["path", "records"])


# --- ARC


def arc_line(version: int, url: str, ip: str, date: str, mime: str, length: int, status: int = 200, name: str = "-") -> bytes:
    values = [url, ip, date, mime, length] if version == 1 else [url, ip, date, mime, status, "-", "-", 0, name, length]
    return (" ".join(map(str, values)) + "\n").encode()


def arc_opening(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 recolith\n{' '.join(FIELDS[version])}\n\n".encode()
    return arc_line(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", len(body), name=name) + body + b"\n"


def clean_url(url: str | None, page_id: int | None) -> str:
    return re.sub(r"[\s\x00-\x1f\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url) if url else f"urn:page:{page_id}"


def write_arc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "20240101000000") -> list:
    """Pages as HTTP responses in ARC files, tasks of even number in version 1, of odd number in version 2; returns LISTED rows."""
    folder = files.qualify(pages.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        version = 1 + TaskContext.get().partitionId() % 2
        roll = Roll(folder, ".arc.gz", lambda name: arc_opening(version, name, date))
        for b in batches:
            for page, url, html in zip(*(c for c in b.columns), strict=True):
                page, payload = page.as_py(), (html.as_py() or "").encode()
                named = f"{ID_HEADER}: {page}\r\n" if page is not None else ""
                block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{named}Content-Length: {len(payload)}\r\n\r\n".encode() + payload
                roll.add(arc_line(version, clean_url(url.as_py(), page), "0.0.0.0", date, "text/html", len(block)) + block + b"\n")
        yield roll.rows()

    rows = pages.select(column(pages, id_col).cast("long"), column(pages, url_col).cast("string"), column(pages, html_col).cast("string"))
    return sorted(rows.mapInArrow(run, LISTED).collect())  # a row a file


def arc_records(stream: Any) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields by name, and the declared bytes, of each record after the opening one."""
    data = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
    fields: list[str] | None = None
    while line := data.readline():
        line = line.rstrip(b"\r\n")
        if not line:
            continue
        text = line.decode("utf-8", "replace")
        if not text.rpartition(" ")[2].isdigit() or " " not in text:
            raise ValueError(f"no header line of a record: {text[:200]}")
        length = int(text.rpartition(" ")[2])
        block = data.read(length)
        if len(block) != length:
            raise ValueError(f"record ends early: {text[:200]}")
        if fields is None:
            if not text.startswith("filedesc:"):
                raise ValueError("an ARC file begins with filedesc:")
            said, names = block.decode("utf-8", "replace").split("\n")[:2]
            fields = names.split() or FIELDS[int(said.split()[0])]
            continue
        yield dict(zip(fields, text.rsplit(" ", len(fields) - 1), strict=True)), block


def http_head(block: bytes) -> int:
    """Bytes of the HTTP head, blank line included; 0 if the block is no HTTP response. Old servers end lines in bare line feeds."""
    found = HEAD_END.search(block) if block.startswith(b"HTTP/") else None
    return found.end() if found else 0


def named_id(head: bytes) -> int | None:
    m = re.search(rb"(?mi)^" + ID_HEADER.encode() + rb": *(-?\d+)\s*$", head)
    return int(m[1]) if m else None


def read_arc(spark: SparkSession, listed: list, index: bool = False) -> DataFrame:
    """RECORD rows of ARC files, or with ``index`` INDEX rows: ids, lengths and digests of the payloads alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows: list[tuple] = []
                held = 0
                with files.open_old(path) as stream:
                    for i, (fields, block) in enumerate(arc_records(stream)):
                        head = http_head(block)
                        page, place = named_id(block[:head]), f"{os.path.basename(path)}#{i:012d}"
                        if index:
                            rows.append((page, place, len(block) - head, hashlib.sha256(block[head:]).hexdigest()))
                        else:
                            rows.append((page, place, fields["URL"], fields["IP-address"], fields["Archive-date"], fields["Content-type"], block, head))
                            held += len(block)
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield batch(rows, INDEX if index else RECORD)
                            rows, held = [], 0
                if rows:
                    yield batch(rows, INDEX if index else RECORD)

    return files.as_table(spark, [tuple(r) for r in listed], LISTED).mapInArrow(run, INDEX if index else RECORD)


def batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    named = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(named)], names=[n for n, _ in named])


# --- WARC


def record_id(place: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, place)}>"


def digest32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def iso(date: str) -> str:
    """ARC's 14 digits, or as many as there are, as WARC's timestamp."""
    d = (date + "00000101000000"[len(date) :])[:14] if date.isdigit() else "19700101000000"
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(headers: list[tuple[str, Any]], block: bytes) -> bytes:
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))] if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def warc_opening(name: str) -> bytes:
    body = b"software: recolith\r\nformat: WARC File Format 1.1\r\n"
    return warc_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(NAMESPACE, name)}>"), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")], body)


def convert(page: int | None, place: str, uri: str, ip: str, date: str, mime: str, block: bytes, head: int, refers_to: int | None, refers_place: str | None) -> bytes:
    """An ARC record as a WARC record."""
    payload = block[head:]
    kind = ("revisit" if refers_to is not None else "response") if head else "resource"
    body = block[:head] if kind == "revisit" else block
    return warc_record(
        [
            ("WARC-Type", kind),
            ("WARC-Record-ID", record_id(place)),
            ("WARC-Date", iso(date)),
            ("WARC-Target-URI", uri),
            ("WARC-IP-Address", ip),
            ("WARC-Profile", REVISIT_PROFILE if kind == "revisit" else None),
            ("WARC-Refers-To", record_id(refers_place) if kind == "revisit" else None),
            ("X-Refers-To-Page-Id", refers_to if kind == "revisit" else None),
            (ID_HEADER, page),
            ("WARC-Payload-Digest", digest32(payload)),
            ("X-Payload-Length", len(payload)),
            ("WARC-Block-Digest", digest32(body)),
            ("Content-Type", "application/http; msgtype=response" if head else mime),
        ],
        body,
    )


def revisits(index: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """sha256, payload_bytes, target and target_place: groups of equal payloads, and the id and place of the one that stays a response."""
    groups = index.where(F.col("payload_bytes") >= least).groupBy("sha256", "payload_bytes").agg(F.max(F.struct("id", "place")).alias("top"), F.count("*").alias("n"))
    return groups.where("n > 1").select("sha256", "payload_bytes", F.col("top.id").alias("target"), F.col("top.place").alias("target_place"))


def arc_to_warc(spark: SparkSession, listed: list, folder: str, least: int = MIN_REVISIT) -> list:
    """Converts listed ARC files; returns LISTED rows of the WARC files."""
    folder = files.qualify(spark, folder)
    groups = small_side(materialise(revisits(read_arc(spark, listed, index=True), least), "revisits"))
    records = read_arc(spark, listed)
    payload = F.substring(F.col("block"), F.col("head_bytes").cast("int") + 1, F.length("block"))
    keyed = records.withColumn("payload_bytes", F.length("block") - F.col("head_bytes")).withColumn("sha256", F.sha2(payload, 256))
    other = ~F.col("id").eqNullSafe(F.col("target"))
    typed = keyed.join(groups, ["sha256", "payload_bytes"], "left").select(*records.columns, F.when(other, F.col("target")).alias("refers_to"), F.when(other, F.col("target_place")).alias("refers_place"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roll = Roll(folder, ".warc.gz", warc_opening)
        for b in batches:
            for row in zip(*b.columns, strict=True):
                roll.add(convert(*(v.as_py() for v in row)))
        yield roll.rows()

    return sorted(typed.mapInArrow(run, LISTED).collect())  # a row a file


def warc_records(stream: Any) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record."""
    data = io.BufferedReader(gzip.GzipFile(fileobj=stream), 1 << 20)
    while line := data.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a WARC record begins with its version")
        headers = {}
        while (line := data.readline().rstrip(b"\r\n")) != b"":
            k, _, v = line.decode("utf-8", "replace").partition(":")
            headers[k.lower()] = v.strip()
        length = int(headers["content-length"])
        block = data.read(length)
        if len(block) != length:
            raise ValueError("record ends early")
        if "warc-block-digest" in headers and headers["warc-block-digest"] != digest32(block):
            raise ValueError(f"block digest differs: {headers.get('warc-record-id')}")
        yield headers, block


PAGES = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, date string"


def read_warc(spark: SparkSession, listed: list) -> DataFrame:
    """PAGES rows of WARC files; digests as lower-case hex, those of revisits of the full payload."""

    def number(text: str | None) -> int | None:
        return None if text is None else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                rows: list[tuple] = []
                with files.open_old(path) as stream:
                    for h, block in warc_records(stream):
                        if h["warc-type"] == "warcinfo":
                            continue
                        if h["warc-type"] != "revisit" and digest32(block[http_head(block) :]) != h["warc-payload-digest"]:
                            raise ValueError(f"payload digest differs: {h['warc-record-id']}")
                        sha1 = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                        rows.append((number(h.get(ID_HEADER.lower())), int(h["x-payload-length"]), sha1, h["warc-type"], number(h.get("x-refers-to-page-id")), h["warc-target-uri"], h["warc-date"]))
                        if len(rows) >= 5000:
                            yield batch(rows, PAGES)
                            rows = []
                if rows:
                    yield batch(rows, PAGES)

    return files.as_table(spark, [tuple(r) for r in listed], LISTED).mapInArrow(run, PAGES)


def digest(pages: DataFrame) -> DataFrame:
    """The contract's columns: pages to ARC, ARC to WARC, and WARC read back."""
    spark = pages.sparkSession
    arcs = write_arc(pages, fresh_path(spark, "arc"))
    warcs = arc_to_warc(spark, arcs, fresh_path(spark, "warc"))
    return read_warc(spark, warcs).drop("uri", "date")


ORACLE = r"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d, coalesce(html, '') AS html FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p
)
SELECT page_id, n :: BIGINT AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM g
"""
