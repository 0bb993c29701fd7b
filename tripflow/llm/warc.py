"""Operator 5, WARC archives: writing with revisits and segments, reading with reassembly.

Writing: one record per row. Of rows with equal payloads (by SHA-1) the largest id is a
response, the others are revisits that refer to it. A response's block is an HTTP message
with chunked transfer coding; a block over ``segment`` bytes is written in segments, the
first under the record's own type, the rest as continuation records that name the first
(WARC-Segment-Origin-ID) and their number; the last names the whole length. Archives are
gzip files of concatenated records, written by Spark's text writer from raw bytes: its
line separator is the CRLF CRLF that ends a record. Segments bound a record, and a file
has at most ``PER_FILE`` records, so a file's size is bounded, whatever the payloads.

Reading: files are parsed to records. Records in one piece are decoded where they are
read. Segments are grouped by origin, ordered by number, their numbers checked for gaps and
their length against the total, then joined and decoded (chunk sizes are checked too).
What fails a check has ``complete`` false and no payload.

Null payloads are empty payloads; payloads of any length are kept whole. A null id is never
the largest; payloads with null ids alone are all responses. Rows repeated with id and payload
are responses alike (if the id is the largest): they share a record id, their segments are
read once, and one record comes back for each. Null urls leave the header out. Only the named
columns are read. An empty table gives an archive without records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.common import ship

END = b"\r\n\r\n"
SEGMENT = 32 << 10
CHUNK = 8 << 10
PER_FILE = 1024
DATE = "2000-01-01T00:00:00Z"  # a fixed date: archives of the same rows are the same
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Base32 SHA-1 in upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(row_id: int | None, payload_digest: str) -> str:
    return f"<urn:page:{'null' if row_id is None else row_id}:{payload_digest}>"


def row_id(record: str) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+):\w+>", record or "")
    return int(found[1]) if found else None


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def _header_safe(url: str | None) -> str | None:
    """A url without characters that would end or split a header line."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer framing of a payload."""
    out = []
    for k in range(0, len(payload), size):
        part = payload[k:k + size]
        out += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of chunked framing; ValueError if the framing is broken."""
    out, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            if body[at:] != b"\r\n":
                raise ValueError("bytes after the last chunk")
            return b"".join(out)
        if body[at + size:at + size + 2] != b"\r\n":
            raise ValueError("a chunk is not as long as it says")
        out.append(body[at:at + size])
        at += size + 2


HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP message; ValueError if it is broken."""
    end = block.index(END)
    headers = block[:end].lower().split(b"\r\n")[1:]
    body = block[end + len(END):]
    return dechunked(body) if b"transfer-encoding: chunked" in headers else body


def records_of(row: int | None, url: str | None, payload: bytes, owner: int | None, payload_digest: str, segment: int = SEGMENT) -> list[bytes]:
    """The records of one row; ``owner`` is the id that its payload's response has, None for itself."""
    own = record_id(row, payload_digest)
    common = [("WARC-Record-ID", own), ("WARC-Date", DATE), ("WARC-Target-URI", _header_safe(url)),
              ("WARC-Payload-Digest", f"sha1:{payload_digest}")]
    if owner is not None:
        return [_record([("WARC-Type", "revisit"), *common, ("WARC-Profile", REVISIT_PROFILE),
                         ("WARC-Refers-To", record_id(owner, payload_digest)), ("X-Payload-Length", len(payload)),
                         ("Content-Type", "application/http;msgtype=response")], HTTP_HEAD)]
    block = HTTP_HEAD + chunked(payload)
    kind = ("Content-Type", "application/http;msgtype=response")
    if len(block) <= segment:
        return [_record([("WARC-Type", "response"), *common, kind], block)]
    out = []
    for k in range(0, len(block), segment):
        number = k // segment + 1
        fields = [("WARC-Type", "response"), *common, kind] if number == 1 else [
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"{own[:-1]}:{number}>"), ("WARC-Date", DATE),
            ("WARC-Segment-Origin-ID", own)]
        fields.append(("WARC-Segment-Number", number))
        if k + segment >= len(block):
            fields.append(("WARC-Segment-Total-Length", len(block)))
        out.append(_record(fields, block[k:k + segment]))
    return out


def write_archive(spark: SparkSession, rows: DataFrame, path: str, id_col: str, url_col: str, payload_col: str,
                  revisit_least: int = 0, segment: int = SEGMENT, per_file: int = PER_FILE) -> None:
    """Write ``rows`` as archives below ``path``. Payloads under ``revisit_least`` bytes are never revisits."""
    ship(spark)
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    marked = rows.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), payload.alias("payload"), F.sha1(payload).alias("sha1"))
    owners = marked.groupBy("sha1").agg(F.max("id").alias("owner"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size = [], 0
            for row, url, sha1, owner, payload in zip(*(b.column(k).to_pylist() for k in range(4)), b.column(4)):
                body = payload.as_py()
                own = owner is None or row == owner or len(body) < revisit_least
                held += records_of(row, url, body, None if own else owner, base64.b32encode(bytes.fromhex(sha1)).decode(), segment)
                size += len(body)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(held, type=pa.binary())], names=["record"])
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(held, type=pa.binary())], names=["record"])

    records = (marked.join(owners, "sha1").select("id", "url", "sha1", "owner", "payload")
               .mapInArrow(run, "record binary"))
    # A cast keeps the bytes as they are, and the text writer copies them.
    (records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END.decode())
     .option("maxRecordsPerFile", per_file).option("compression", "gzip").text(path))


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(named fields, block) of every record of an archive; ValueError at bytes that are no record."""
    data = gzip.decompress(content) if content[:2] == b"\x1f\x8b" else content
    at = 0
    while at < len(data):
        end = data.index(END, at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + len(END)
        stop = start + int(fields["Content-Length"])
        if data[stop:stop + len(END)] != END:
            raise ValueError("a record is not as long as it says")
        yield fields, data[start:stop]
        at = stop + len(END)


_OUT = ("record_id string, record_type string, refers_to string, target_uri string, payload_digest string, "
        "payload_bytes long, complete boolean, payload binary")
_NAMES = [c.split()[0] for c in _OUT.split(", ")]
_TYPES = [pa.string()] * 5 + [pa.int64(), pa.bool_(), pa.binary()]


def _decoded(fields: dict[str, str], block: bytes | None) -> tuple:
    """A row of the reader; ``block`` is None if segments are missing."""
    kind, claimed = fields.get("WARC-Type"), fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    head = (fields.get("WARC-Record-ID"), kind, fields.get("WARC-Refers-To"), fields.get("WARC-Target-URI"))
    if kind == "revisit":
        length = fields.get("X-Payload-Length")
        return (*head, claimed, None if length is None else int(length), True, None)
    try:
        payload = http_payload(block) if block is not None else None
    except ValueError:
        payload = None
    found = None if payload is None else digest(payload)
    if found is None or claimed not in ("", found):
        return (*head, claimed, None, False, None)
    return (*head, found, len(payload), True, payload)


def _row_batches(rows: Iterator[tuple], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += 200 + len(row[-1] or b"")
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*held), _TYPES)], names=_NAMES)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*held), _TYPES)], names=_NAMES)


_SEGMENT_FIELDS = ("WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Payload-Digest")


def reassembled(segments: Iterator[tuple]) -> Iterator[tuple]:
    """Reader rows from segments (origin, number, total length, fields of the first, block) sorted by origin and number.

    Only one origin's segments are held at a time. Repeated rows share an origin: each of their
    segments is used once, and a row comes back for every copy of the first.
    """
    origin, fields, parts, copies, total, broken = None, {}, [], 0, None, False

    def finish() -> Iterator[tuple]:
        whole = not broken and total is not None and sum(map(len, parts)) == total
        row = _decoded(fields if fields else {"WARC-Record-ID": origin}, b"".join(parts) if whole else None)
        for _ in range(max(1, copies)):
            yield row

    for own, number, length, first, block in segments:
        if own != origin:
            if origin is not None:
                yield from finish()
            origin, fields, parts, copies, total, broken = own, {}, [], 0, None, False
        if number == 1:
            copies += 1
            fields = first
        if number == len(parts) and parts[-1] == block:
            continue  # a further copy
        if number != len(parts) + 1 or total is not None:
            broken = True
        parts.append(block)
        total = length if length is not None else total
    if origin is not None:
        yield from finish()


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives below ``path``, continuation records joined to their origin.

    Returns record_id, record_type, refers_to, target_uri, payload_digest (computed from the
    payload; a revisit's as recorded), payload_bytes, complete, payload (null for revisits).
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (_decoded(f, block) for b in batches for c in b.column(0) for f, block in parse(c.as_py()) if "WARC-Segment-Number" not in f)
        yield from _row_batches(rows)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for c in b.column(0):
                held = []
                for f, block in parse(c.as_py()):
                    if "WARC-Segment-Number" in f:
                        number, total = int(f["WARC-Segment-Number"]), f.get("WARC-Segment-Total-Length")
                        origin = f.get("WARC-Segment-Origin-ID", f["WARC-Record-ID"])
                        first = {k: f[k] for k in _SEGMENT_FIELDS if k in f} if number == 1 else {}
                        held.append((origin, number, None if total is None else int(total), list(first.items()), block))
                if held:
                    types = [pa.string(), pa.int64(), pa.int64(), pa.map_(pa.string(), pa.string()), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, type=t) for x, t in zip(zip(*held), types)],
                                                     names=["origin", "number", "total", "fields", "block"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((o, n, t, dict(f), block.as_py()) for b in batches
                for o, n, t, f, block in zip(*(b.column(k).to_pylist() for k in range(4)), b.column(4)))
        yield from _row_batches(reassembled(rows))

    segmented = (files.mapInArrow(pieces, "origin string, number long, total long, fields map<string,string>, block binary")
                 .repartition("origin").sortWithinPartitions("origin", "number").mapInArrow(join, _OUT))
    return files.mapInArrow(whole, _OUT).unionByName(segmented)
