"""WARC records in ZIP packages, read by range.

A package is a ZIP file with stored members: ``archive/data.warc.gz`` (records, each its own gzip
member) and ``indexes/index.cdxj`` (one line per record with its offset and length). The reader
parses the central directory, ZIP64 included, finds the index members, and reads each record by its
byte range; nothing is extracted. Since a cluster's store may be reachable through Spark alone,
packages are rows (``name``, ``content``) of at most about 16 MB unless one record is larger.

Records with equal payloads are written once: the smallest ``page_id`` is the response, the others
are revisits that refer to it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import re
import struct
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlake.llm.common import stored

PACKAGE_BYTES = 16_000_000
ARCHIVE, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class Ranges:
    """Byte ranges of a package held as one buffer; another source needs ``size`` and ``read``."""

    def __init__(self, data):
        self.data = memoryview(data)
        self.size = len(self.data)

    def read(self, offset: int, length: int) -> bytes:
        if offset < 0 or length < 0 or offset + length > self.size:
            raise ValueError(f"range {offset}+{length} is outside of {self.size} bytes")
        return bytes(self.data[offset : offset + length])


@dataclass(frozen=True)
class Member:
    name: str
    method: int
    size: int
    header: int


def directory(source: Ranges) -> list[Member]:
    """The members that the central directory lists; ZIP64 fields replace those that are all ones."""
    tail = min(source.size, 22 + 65535)
    end = source.read(source.size - tail, tail)
    at = end.rfind(b"PK\x05\x06", 0, tail - 18)
    # A comment may hold the signature: the true one is followed by a comment up to the end.
    while at >= 0 and at + 22 + struct.unpack_from("<H", end, at + 20)[0] != len(end):
        at = end.rfind(b"PK\x05\x06", 0, at)
    if at < 0:
        raise ValueError("no end of central directory")
    count, length, start = struct.unpack_from("<10xHII", end, at)
    if count == 0xFFFF or 0xFFFFFFFF in (length, start):
        signature, where = struct.unpack("<4s4xQ4x", source.read(source.size - tail + at - 20, 20))
        if signature != b"PK\x06\x07":
            raise ValueError("no ZIP64 locator")
        record = source.read(where, 56)
        if record[:4] != b"PK\x06\x06":
            raise ValueError("no ZIP64 end of central directory")
        count, length, start = struct.unpack_from("<32xQQQ", record)
    entries, found, at = source.read(start, length), [], 0
    for _ in range(count):
        signature, method, packed, size, names, extras, comments, header = struct.unpack_from("<4s6xH8xIIHHH8xI", entries, at)
        if signature != b"PK\x01\x02":
            raise ValueError("broken central directory")
        name = entries[at + 46 : at + 46 + names].decode()
        more = entries[at + 46 + names : at + 46 + names + extras]
        wide = [x == 0xFFFFFFFF for x in (size, packed, header)]
        if any(wide):
            values = iter(_zip64_values(more, sum(wide)))
            size, packed, header = (next(values) if w else x for w, x in zip(wide, (size, packed, header), strict=True))
        found.append(Member(name, method, size, header))
        at += 46 + names + extras + comments
    return found


def _zip64_values(extra: bytes, n: int) -> tuple[int, ...]:
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1 and length >= 8 * n:
            return struct.unpack_from(f"<{n}Q", extra, at + 4)
        at += 4 + length
    raise ValueError("no ZIP64 field")


def data_offset(source: Ranges, member: Member) -> int:
    """Where a stored member's bytes begin. Compressed members cannot be read by range."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed")
    names, extras = struct.unpack_from("<26xHH", source.read(member.header, 30))
    return member.header + 30 + names + extras


def index_entries(source: Ranges) -> Iterator[tuple[int, int]]:
    """Offset and length, within the package, of every record that its indexes name."""
    members = {m.name: m for m in directory(source)}
    bases: dict[str, int] = {}
    for m in members.values():
        if not re.fullmatch(r"indexes/.*\.cdxj?", m.name):
            continue
        for line in source.read(data_offset(source, m), m.size).decode().split("\n"):
            entry = json.loads(line.split(" ", 2)[2])
            name = f"archive/{entry['filename']}"
            if name not in bases:
                bases[name] = data_offset(source, members[name])
            offset, length = int(entry["offset"]), int(entry["length"])
            if offset + length > members[name].size:
                raise ValueError("the index points behind its archive")
            yield bases[name] + offset, length


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers by lower-case name, and the block, of one record (a gzip member)."""
    data = gzip.decompress(raw)
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return headers, rest[: int(headers["content-length"])]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def one_line(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def make_record(page_id: int | None, url: str | None, payload: bytes, original: int | None, revisit: bool) -> bytes:
    """A response, or a revisit of page ``original``, as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{page_id}>"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {one_line(url)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{original}>"]
    lines += [
        "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return gzip.compress("\r\n".join(lines).encode("utf-8", "replace") + b"\r\n\r\n" + block + b"\r\n\r\n", 5, mtime=0)


def make_package(records: list[tuple[str, bytes]]) -> bytes:
    """A package of ``(url, record)``."""
    at, lines = 0, []
    for url, record in records:
        entry = {"url": url, "filename": ARCHIVE.partition("/")[2], "offset": str(at), "length": str(len(record))}
        lines.append(f"{one_line(url or '-')} 19700101000000 {json.dumps(entry)}")
        at += len(record)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        z.writestr(zipfile.ZipInfo(ARCHIVE), b"".join(r for _, r in records))
        z.writestr(zipfile.ZipInfo(INDEX), "\n".join(sorted(lines)))
    return out.getvalue()


def read_package(content) -> Iterator[tuple[int | None, int, str, str, int | None]]:
    """The rows of ``RECORDS`` for every record that the package's indexes name."""
    source = Ranges(content)
    for offset, length in index_entries(source):
        headers, block = parse_record(source.read(offset, length))
        http, _, payload = block.partition(b"\r\n\r\n")
        stated = int(re.search(rb"(?im)^content-length:\s*(\d+)", http)[1])
        kind, code = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and (digest(payload) != code or len(payload) != stated):
            raise ValueError(f"{headers['warc-record-id']}: the payload does not match its digest")
        page = headers.get("x-page-id")
        refers = headers["warc-refers-to"][len("<urn:page:") : -1] if kind == "revisit" else None
        yield None if page is None else int(page), stated, code, kind, None if refers is None else int(refers)


def write_packages(pages: DataFrame, min_bytes: int = 0, package_bytes: int = PACKAGE_BYTES) -> DataFrame:
    """Packages (``name``, ``content``) of the rows of ``pages`` (``page_id, url, html``; more is not read).

    Null html is an empty payload. Among equal payloads of at least ``min_bytes`` bytes, rows with
    the smallest ``page_id`` are responses, even where a page repeats; all others, null ids too, are
    revisits of it. Without any id all are responses.
    """
    raw = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", raw.alias("html")).withColumn(
        "key", F.struct(F.sha1("html").alias("sha"), F.octet_length("html").alias("bytes"))
    )
    firsts = rows.groupBy(F.col("key.bytes").alias("bytes"), F.col("key.sha").alias("sha")).agg(F.min("page_id").alias("first"))
    # Joined over another key than they are grouped by, so that large groups can be dealt out.
    firsts = firsts.select(F.struct("sha", "bytes").alias("_key"), "first")
    revisit = (F.col("key.bytes") >= min_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    marked = rows.join(firsts, F.col("key") == F.col("_key")).select("page_id", "url", "html", "first", revisit.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held, size = TaskContext.get().partitionId(), 0, [], 0

        def package() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([f"part-{part:05}-{number:05}.wacz"]), pa.array([make_package(held)], pa.binary())], ["name", "content"]
            )

        for batch in batches:
            for page, url, html, first, again in zip(*(batch.column(i) for i in range(5)), strict=True):
                link, payload = url.as_py(), html.as_py().encode("utf-8", "surrogatepass")
                record = make_record(page.as_py(), link, payload, first.as_py(), again.as_py())
                if held and size + len(record) > package_bytes:
                    yield package()
                    number, held, size = number + 1, [], 0
                held.append((link, record))
                size += len(record)
        if held:
            yield package()

    return marked.mapInArrow(run, "name string, content binary")


def read_packages(packages: DataFrame) -> DataFrame:
    """One row per record: ``page_id, payload_bytes, payload_digest, record_type, refers_to``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        names = [c.split()[0] for c in RECORDS.split(", ")]
        for batch in batches:
            for content in batch.column("content"):
                rows = list(read_package(content.as_buffer()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return packages.select("content").mapInArrow(run, RECORDS)


def write_and_read(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write packages below the shared folder and read their records back."""
    return read_packages(stored(write_packages(pages, min_bytes), "warc-packages"))
