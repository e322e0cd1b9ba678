"""WARC archives: a writer and a reader that salvages damaged files.

Writer: one record per page in gzip members of their own, in files of about ROLL_BYTES in the shared
folder. Of the pages with equal payloads the one with the largest id is written in full
(response), the others as revisits of it. Each file's name is fresh; the written manifest lists
the files of the attempts that counted, so lost and repeated tasks leave nothing in the result.

Reader: every file is read as a stream in one task (files are bounded, see above). Each member
is inflated and checked (gzip checksum, header, Content-Length, payload digest). After a failed check
the reader looks from the next byte on for a gzip member that starts with a version line, or for a
plain version line; the skipped bytes are logged as one gap row with offset, length and reason. A
header may have any length.

Defined cases: a null html is an empty payload; empty payloads equal each other; rows that repeat an
id and payload are written each; a null id never wins over another id; an empty table gives an
empty archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import qualified, small, stored
from ledgerlake.session import scratch_dir

ROLL_BYTES = 32 << 20
READ_BYTES = 1 << 20
VERSIONS = (b"WARC/1.0\r\n", b"WARC/1.1\r\n")
GZIP = b"\x1f\x8b\x08"
HEADER_BYTES = 64 << 10  # first step of reading a plain header, which may be longer
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
MANIFEST = "path string, bytes long, records long"
RECORDS = (
    "path string, offset long, length long, kind string, record_id string, page_id long, url string, "
    "record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, reason string"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record, not compressed."""
    block = HTTP if revisit else HTTP + payload
    name = "" if page_id is None else str(page_id)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Target-URI: {' '.join((url or '').split())}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    made = zlib.compressobj(1, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def with_types(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to, revisit): equal payloads refer to their largest id.

    Only digests and ids are shuffled. The revisits are joined back by id and digest; html stays
    where it was read while the list of revisits is under the broadcast bound.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.unhex(F.sha2("payload", 256)))
    ids = stored(rows.select("page_id", "digest"), "digests")
    shared = ids.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1 and refers_to is not null")
    revisits = ids.join(shared.select("digest", "refers_to"), "digest").where("not page_id <=> refers_to").distinct()
    revisits = stored(revisits.select(F.col("page_id").alias("r_id"), F.col("digest").alias("r_digest"), "refers_to"), "revisits")
    same = F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("digest") == F.col("r_digest"))
    out = rows.join(small(revisits, revisits.count(), 80), same, "left")
    return out.select("page_id", "url", "payload", "refers_to", F.col("r_digest").isNotNull().alias("revisit"))


def write(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the archives; returns the manifest (path, bytes, records)."""
    target = qualified(pages.sparkSession, folder or scratch_dir(pages.sparkSession, "warc"))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(target)
        fs.create_dir(root, recursive=True)
        out, path, size, count = None, "", 0, 0

        def done() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [count]})

        for batch in batches:
            for page_id, url, payload, refers_to, revisit in zip(*batch.columns):
                if out is None:
                    name, size, count = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    path, out = f"{target}/{name}", fs.open_output_stream(f"{root}/{name}", compression=None)
                data = member(record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), revisit.as_py()))
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= ROLL_BYTES:
                    yield done()
                    out = None
        if out is not None:
            yield done()

    return stored(with_types(pages).mapInArrow(save, MANIFEST), "manifest")


class Bytes:
    """A file read forward in steps, with the part from a position on at hand."""

    def __init__(self, stream):
        self.stream, self.start, self.data, self.ended = stream, 0, bytearray(), False

    def at(self, offset: int, size: int, skip: int = 0) -> bytes:
        """Up to size bytes from offset on, without the first skip; what lies before offset is forgotten."""
        if offset > self.start:
            del self.data[: offset - self.start]
            self.start = offset
        while len(self.data) < size and not self.ended:
            more = self.stream.read(max(READ_BYTES, size - len(self.data)))
            self.ended = not more
            self.data += more  # a bytearray grows in place
        return bytes(memoryview(self.data)[skip:size])


def inflate(source: Bytes, offset: int, limit: int | None = None) -> tuple[bytes, int] | None:
    """A whole gzip member's data and its size in the file; None if it fails its check."""
    unpack, out, size, step = zlib.decompressobj(31), [], 0, READ_BYTES
    got = 0
    try:
        while not unpack.eof:
            part = source.at(offset, size + step, size)
            if not part:
                return None
            out.append(unpack.decompress(part, limit or 0))
            got += len(out[-1])
            size += len(part)
            if limit and got >= limit:
                return b"".join(out), size
    except zlib.error:
        return None
    return b"".join(out), size - len(unpack.unused_data)


def parse(data: bytes) -> tuple[dict, int] | str:
    """The fields of the record that data starts with and its length, or why it fails."""
    if not data.startswith(VERSIONS):
        return "no version line"
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return "header has no end"
    head = dict(line.split(": ", 1) for line in data[:end].decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    try:
        size = int(head["Content-Length"])
    except (KeyError, ValueError):
        return "no length"
    block = data[end + 4 : end + 4 + size]
    if size < 0 or len(block) < size or data[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
        return "block is cut"
    kind, digest = head.get("WARC-Type", ""), head.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    payload = block.partition(b"\r\n\r\n")[2]
    if kind == "response" and sha1_base32(payload) != digest:
        return "digest differs"

    def page(name: str) -> int | None:
        value = head.get(name, "").removeprefix("<urn:page:").removesuffix(">")
        return int(value) if value.lstrip("-").isdigit() else None

    length = head.get("X-Payload-Length", "")
    fields = {
        "kind": "record", "record_id": head.get("WARC-Record-ID"), "page_id": page("WARC-Record-ID"),
        "url": head.get("WARC-Target-URI"), "record_type": kind, "refers_to": page("WARC-Refers-To"),
        "payload_bytes": int(length) if length.isdigit() else len(payload), "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }
    return fields, end + 8 + size


def plain(source: Bytes, offset: int) -> tuple[dict, int] | str:
    """A record that is not compressed; its header ends before the next version line or gzip member."""
    size = HEADER_BYTES
    while True:
        head = source.at(offset, size)
        other = [h for h in (head.find(m) for m in (GZIP, *(b"\n" + v for v in VERSIONS))) if h >= 0]
        end = head.find(b"\r\n\r\n", 0, min(other, default=len(head)))
        if end >= 0 or other or len(head) < size:
            break
        size *= 2
    if end < 0:
        return "header has no end"
    found = head[:end].lower().partition(b"content-length:")[2].split(b"\r\n")[0].strip()
    return parse(source.at(offset, end + 8 + (int(found) if found.isdigit() else 0)))


def next_start(source: Bytes, offset: int) -> int:
    """Where the next member with a version line, or the next version line, begins; else the end."""
    while data := source.at(offset, 2 * READ_BYTES):
        at = 0
        while True:
            hits = [h for h in (data.find(m, at) for m in (GZIP, *VERSIONS)) if h >= 0]
            if not hits:
                break
            at = min(hits)
            if not data.startswith(GZIP, at):
                return offset + at
            probe = zlib.decompressobj(31)
            try:
                if probe.decompress(data[at : at + 4096], 64).startswith(VERSIONS):
                    return offset + at
            except zlib.error:
                pass
            at += 1
        if source.ended and len(data) < 2 * READ_BYTES:
            return offset + len(data)
        offset += max(1, len(data) - 4096)  # keeps a start that lies across two steps
    return offset


def records(path: str, stream) -> Iterator[dict]:
    """Rows of one file: its records and the gaps between them."""
    source, at = Bytes(stream), 0
    while head := source.at(at, 10):
        size = 0
        if head.startswith(GZIP):
            got = inflate(source, at)
            read = parse(got[0]) if got else "member fails its check"
            if not isinstance(read, str):
                read, size = (read[0], got[1]) if read[1] == len(got[0]) else ("member holds more than a record", 0)
        elif head.startswith(tuple(v[:10] for v in VERSIONS)):
            read = plain(source, at)
            if not isinstance(read, str):
                read, size = read
        else:
            read = "no member and no version line"
        if isinstance(read, str):
            size = next_start(source, at + 1) - at
            read = {"kind": "gap", "reason": read}
        yield {"path": path, "offset": at, "length": size, **read}
        at += size


def read(manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """Records and gaps (column kind) of the files in the column path."""
    schema = pa.schema([(f.name, {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[f.dataType.simpleString()]) for f in _fields(manifest)])

    home = qualified(manifest.sparkSession, "/").rstrip("/")  # for paths without a file system

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, name = pafs.FileSystem.from_uri(path if "://" in path else home + path)
                held, size = [], 0
                with fs.open_input_stream(name, compression=None) as stream:
                    for row in records(path, stream):
                        if not keep_payload:
                            row.pop("payload", None)
                        held.append(row)
                        size += len(row.get("payload") or b"") + 500
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema=schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)

    files = manifest.select("path")
    n = manifest.count()
    return files.repartition(max(1, n), "path").mapInArrow(load, RECORDS) if n else manifest.sparkSession.createDataFrame([], RECORDS)


def _fields(df: DataFrame):
    return df.sparkSession.createDataFrame([], RECORDS).schema.fields


def op5_warc(spark, sf_dir: str) -> DataFrame:
    manifest = write(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    rows = read(manifest, keep_payload=False).where("kind = 'record'")
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
  FROM pages),
g AS (SELECT *, list_transform(range(8), lambda i: ('0x' || h[5 * i + 1 : 5 * i + 5])::BIGINT) AS parts FROM p)
SELECT page_id, payload_bytes,
  list_aggregate(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((parts[j // 4 + 1] >> (15 - 5 * (j % 4))) & 31)::BIGINT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> top THEN top END AS refers_to
FROM g
"""
