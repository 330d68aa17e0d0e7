"""Operator 5, WARC: deduplicating writer and splittable reader.

The writer makes one gzip member per record; of equal payloads the smallest
id is a ``response``, the others are ``revisit`` records that refer to it.
The reader takes byte ranges: a task scans its range for the gzip magic, takes
a candidate only if it decodes to a WARC header, and owns the records that
start inside its range (the last may end beyond it).
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstan.llm.common import parked, partitions, salt
from capstan.llm.registry import query
from capstan.session import scratch_path
from capstan.sources.fsio import atomic_writer, open_read
from capstan.tables import table

SPLIT_BYTES = 4 << 20
FILE_BYTES = 256 << 20
BLOCK = 1 << 20
SALTS = 32
#: Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _clean(value: str) -> str:
    """A header value: control characters percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}", "", ""]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode("utf-8", "surrogateescape") + block + b"\r\n\r\n") + z.flush()


def record(rid, url, payload: bytes, sha1: str, refers_to=None, revisit: bool = False) -> bytes:
    """One gzip member.  ``rid`` None is written as an id without a number."""
    name = lambda i: f"<urn:record:{'' if i is None else i}>"
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", name(rid)), ("WARC-Date", DATE)]
    headers += [("WARC-Target-URI", _clean(url))] if url is not None else []
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if revisit:
        headers += [("WARC-Refers-To", name(refers_to)), ("WARC-Profile", PROFILE)]
    return _member(headers, http if revisit else http + payload)


def _writer(folder: str, file_bytes: int):
    def rows(parts):
        for b in parts:
            yield from zip(*(b.column(c).to_pylist() for c in ("id", "url", "payload", "sha1", "refers_to", "revisit")))

    def run(parts):
        source, done = rows(parts), False
        while not done:
            first = next(source, None)
            if first is None:
                return
            path = posixpath.join(folder, f"part-{uuid.uuid4().hex}.warc.gz")
            size = n = 0
            with atomic_writer(path) as out:
                head = _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE),
                                ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                out.write(head)
                size += len(head)
                row = first
                while row is not None:
                    data = record(*row[:2], row[2] or b"", *row[3:])
                    out.write(data)
                    size, n = size + len(data), n + 1
                    if size >= file_bytes:
                        break
                    row = next(source, None)
                done = row is None
            yield pa.RecordBatch.from_pylist([{"file": path, "size": size, "records": n}])
    return run


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row below ``folder``; returns the list of files
    (file, size, records) of the tasks that succeeded: a retried task leaves a
    file that no list names.

    Payload: the text in UTF-8, null as empty.  Of payloads of ``min_bytes`` or
    more that are equal (SHA-1, length and a 64-bit hash), all rows with the
    smallest id are responses and the others refer to it; a null id comes
    after all others.  An empty table writes nothing.
    """
    same = ["sha1", "bytes", "check"]
    payload = F.coalesce(F.col(html_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "bytes": F.octet_length("payload"), "check": F.xxhash64("payload"), "s": salt("id", n=SALTS)})
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id"))
    salted = rows.select("id", *same, "s").groupBy(*same, "s").agg(least.alias("least"))
    best = salted.groupBy(*same).agg(F.min("least").alias("best"))
    labels = salted.select(*same, "s").join(best, same)
    revisit = (F.col("bytes") >= min_bytes) & ~F.col("id").eqNullSafe(F.col("best.id"))
    records = rows.join(labels, [*same, "s"]).select(
        "id", "url", "payload", "sha1",
        F.when(revisit, F.col("best.id")).alias("refers_to"), revisit.alias("revisit"))
    return parked(records.mapInArrow(_writer(folder, file_bytes), "file string, size long, records long"), "warc-files")


def _find_member(f, start: int, end: int) -> int | None:
    """Offset of the first member of a WARC record that starts in [start, end)."""
    at, tail = start, b""
    while at < end + len(MAGIC) - 1:
        f.seek(at)
        block = f.read(min(BLOCK, end + len(MAGIC) - 1 - at))
        if not block:
            return None
        held, base = tail + block, at - len(tail)
        i = held.find(MAGIC)
        while i >= 0:
            if base + i < end and _is_record(f, base + i):
                return base + i
            i = held.find(MAGIC, i + 1)
        tail, at = held[-(len(MAGIC) - 1):], at + len(block)
    return None


def _is_record(f, offset: int) -> bool:
    """Whether a gzip member that begins a WARC record starts here."""
    f.seek(offset)
    z, head = zlib.decompressobj(31), b""
    while len(head) < 7 and not z.eof:
        data = f.read(4096)
        if not data:
            break
        try:
            head += z.decompress(data, 4096)
        except zlib.error:
            return False
    return head.startswith((b"WARC/1.", b"WARC/0."))


def _read_member(f, offset: int) -> tuple[bytes, int]:
    """Content of the member at ``offset`` and the offset after it; a broken
    or cut member is an error (no record is lost silently)."""
    f.seek(offset)
    z, out, read = zlib.decompressobj(31), [], 0
    while not z.eof:
        data = f.read(1 << 16)
        if not data:
            raise ValueError(f"gzip member at {offset} is cut off")
        read += len(data)
        out.append(z.decompress(data))
    return b"".join(out), offset + read - len(z.unused_data)


def members(f, start: int, end: int):
    """(offset, content) of the records that start in [start, end)."""
    at = _find_member(f, start, end)
    while at is not None and at < end:
        content, after = _read_member(f, at)
        yield at, content
        at = after if _is_record(f, after) else _find_member(f, after, end)


def parse(content: bytes) -> dict:
    """Header fields and payload of one record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
    block = rest[:int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields.get("warc-type")
    number = lambda v: int(v[12:-1]) if v and v.startswith("<urn:record:") and v[12:-1].lstrip("-").isdigit() else None
    out = {"record_type": kind, "record_id": fields.get("warc-record-id"), "id": number(fields.get("warc-record-id")),
           "url": fields.get("warc-target-uri"), "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
           "refers_to": number(fields.get("warc-refers-to")), "payload": None, "payload_bytes": None}
    if kind == "response":
        got = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if out["payload_digest"] not in (None, got):
            raise ValueError(f"payload of {out['record_id']} does not match its digest")
        out |= {"payload": payload, "payload_bytes": len(payload), "payload_digest": got}
    elif kind == "revisit":  # its block is the response's HTTP header
        size = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.strip().lower() == b"content-length"]
        out["payload_bytes"] = int(size[0]) if size else None
    return out


RECORD = "file string, offset long, record_type string, record_id string, id long, url string, payload_digest string, refers_to long, payload binary, payload_bytes long"
_RECORD_ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("id", pa.int64()),
                           ("url", pa.string()), ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("payload_bytes", pa.int64())])


def _reader(batch_bytes: int = 16 << 20):
    def run(parts):
        for b in parts:
            for path, start, end in zip(*(b.column(c).to_pylist() for c in ("file", "start", "end"))):
                rows, held = [], 0
                with open_read(path) as f:
                    for offset, content in members(f, start, end):
                        rows.append({"file": path, "offset": offset, **parse(content)})
                        held += len(content)
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, _RECORD_ARROW)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, _RECORD_ARROW)
    return run


def read_archives(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``files``: columns file, size.  One row per record, whatever its type;
    files of any size are read in ranges of ``split_bytes``.  An empty file
    has no record."""
    ranges = files.where("size > 0").select("file", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = ranges.select("file", "start", F.least(F.col("start") + split_bytes, F.col("size")).alias("end"))
    return ranges.repartition(partitions(files.sparkSession), "file", "start").mapInArrow(_reader(), RECORD)


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "warc")


@query("op5_warc", """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, min(page_id) AS least FROM p GROUP BY h),
c AS (SELECT page_id, h, least, body, unnest(range(8)) AS i FROM p JOIN g USING (h)),
d AS (SELECT *, ('0x' || substr(h, CAST(i * 5 + 1 AS INTEGER), 5))::INTEGER AS v FROM c),
e AS (SELECT page_id, any_value(least) AS least, any_value(strlen(body)) AS n,
      string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 15) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 10) & 31) + 1, 1)
                 || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((v >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v & 31) + 1, 1), '' ORDER BY i) AS digest
      FROM d GROUP BY page_id)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> least THEN least END AS refers_to FROM e
""")
def op5_warc(spark, sf_dir):
    files = write_archives(table(spark, sf_dir, "pages"), archive_folder(spark))
    got = read_archives(files).where(F.col("record_type").isin("response", "revisit"))
    return got.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")
