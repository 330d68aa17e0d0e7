"""Archive (WARC) files as a Spark data source (S3) and a writer.

Reading: ``spark.read.format("warc").load(path)`` gives one row per record
(schema ``capstan.schemas.WARC_RECORDS``).  Small files are packed into input
partitions of up to ``packBytes``; gzip files are read member by member, so
``record_offset`` and ``record_length`` locate the compressed record for random
access (J7).  Options: ``payload`` (default true; false drops the bytes at the
source, as Python sources are not column-pruned), ``maxRecordBytes`` (no
default; a longer record keeps its row, without payload, and says ``over-cap``
in ``error``), ``onError`` (``fail``, the default: a broken record or file is
an error; ``reject``: it gives a row with ``error`` and reading goes on at the
next record found), ``dechunk`` (default true: chunked HTTP bodies are joined).
A record whose length is no number is skipped alone: its row has no length and
no payload, so P3 leaves it out.  A chunked body with broken framing has no
payload either, and says why in ``error``, whatever ``onError`` is: the archive
is sound, the server's message was not.  A failed read is always an error.

Writing: ``df.write.format("warc").mode("overwrite").save(path)`` writes one
file ``{warc_file}.warc.gz`` per value of ``warc_file`` in a partition, one
gzip member per record, rows in partition order.  Use ``write_warc`` to
co-locate and order the rows first.  Files are written under a temporary
name and moved into place when complete, so a retried task replaces its
output.  Paths may be local or file-system URIs (``capstan.sources.fsio``).
"""

from __future__ import annotations

import gzip
import json
import os
import re
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

from capstan.schemas import WARC_RECORDS
from capstan.session import scratch_path
from capstan.sources import fsio

CHUNK = 1 << 20
PACK_BYTES, OPEN_BYTES, SPLIT_BYTES = 32 << 20, 256 << 10, 256 << 20


class FilesPartition(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(tuple(paths))
        self.paths = paths


class RangePartition(InputPartition):
    """Records of one file that begin from ``start`` (a record's offset) up to
    ``stop``; the first is the file's ``idx``-th."""

    def __init__(self, path: str, start: int, stop: int, idx: int):
        super().__init__((path, start, stop, idx))
        self.path, self.start, self.stop, self.idx = path, start, stop, idx


def packed_files(path: str, pack_bytes: int, slots: int = 1, without: frozenset[str] = frozenset()) -> list[list[str]]:
    """Files under ``path`` in order, small ones packed together: up to
    ``pack_bytes``, and less where there would be fewer packs than ``slots``."""
    sizes = {p: n for p, n, _ in fsio.walk_files(path)}
    pack_bytes = min(pack_bytes, max(OPEN_BYTES, sum(sizes.values()) // max(1, slots)))
    out: list[list[str]] = []
    room = 0
    for f in fsio.list_files(path):
        if f in without:
            continue
        n = sizes.get(f, pack_bytes)
        if not out or n > room:
            out.append([])
            room = pack_bytes
        out[-1].append(f)
        room -= n
    return out


def _parse_head(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").replace("\r\n", "\n").split("\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    heads: dict[str, str] = {}
    for line in lines[1:]:
        if ":" in line:
            k, v = line.split(":", 1)
            heads.setdefault(k.strip().lower(), v.strip())
    return heads


def _length(heads: dict[str, str]) -> int | None:
    raw = heads.get("content-length", "")
    return int(raw) if raw.isascii() and raw.isdigit() else None


def _stream_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict, bytes | None, int, int]]:
    """Records from a stream of byte chunks: (headers, block, start, end),
    offsets relative to the stream.  One buffer is read with a moving
    position, so a record's bytes are copied once.  A record whose length is
    no number has no block; the next one is looked for by its first line.
    Raises ValueError on a malformed or cut record."""
    it = iter(chunks)
    buf, pos, base = bytearray(), 0, 0  # base = stream offset of buf[0]

    def more() -> bool:
        nonlocal pos, base
        for c in it:
            if c:
                if pos > CHUNK:
                    del buf[:pos]
                    base, pos = base + pos, 0
                buf.extend(c)
                return True
        return False

    def find(sep: bytes) -> int:
        """Distance from the position to ``sep``, or -1 at the end."""
        seen = 0
        while True:
            i = buf.find(sep, pos + seen)
            if i >= 0:
                return i - pos
            seen = max(0, len(buf) - pos - len(sep) + 1)
            if not more():
                return -1

    while True:
        while True:  # blank lines between records
            while pos < len(buf) and buf[pos] in b"\r\n":
                pos += 1
            if pos < len(buf) or not more():
                break
        if pos >= len(buf):
            return
        start = base + pos
        end = find(b"\r\n\r\n")
        if end < 0:
            raise ValueError("unterminated record header")
        heads = _parse_head(bytes(buf[pos:pos + end]))
        pos += end + 4
        size = _length(heads)
        if size is None:
            skip = find(b"\r\nWARC/")
            pos = pos + skip if skip >= 0 else len(buf)
            yield heads, None, start, base + pos
            continue
        while len(buf) - pos < size:
            if not more():
                raise ValueError("truncated record")
        block = bytes(memoryview(buf)[pos:pos + size])
        pos += size
        yield heads, block, start, base + pos


def _members(f, offset: int) -> Iterator[tuple[int, Iterator[bytes], dict]]:
    """Gzip members from ``offset`` on: (offset, decompressed chunks, state);
    ``state["size"]`` is the compressed length once the member has been read."""
    f.seek(offset)
    buf = f.read(CHUNK)
    while buf:
        d = zlib.decompressobj(31)
        state = {"buf": buf, "used": 0, "size": None}

        def chunks(d=d, state=state):
            while True:
                data = state["buf"] or f.read(CHUNK)
                if not data:
                    raise ValueError("truncated gzip member")
                out = d.decompress(data)
                state["used"] += len(data) - len(d.unused_data)
                state["buf"] = d.unused_data
                if out:
                    yield out
                if d.eof:
                    state["size"] = state["used"]
                    return

        own = chunks()
        yield offset, own, state
        for _ in own:  # a caller may stop before the end
            pass
        offset += state["size"]
        buf = state["buf"] or f.read(CHUNK)


def _next_start(f, offset: int, sign: bytes) -> int | None:
    """Offset of the next ``sign`` at or after ``offset``."""
    f.seek(offset)
    tail = b""
    while data := f.read(CHUNK):
        i = (tail + data).find(sign)
        if i >= 0:
            return offset - len(tail) + i
        offset += len(data)
        tail = (tail + data)[-(len(sign) - 1):]
    return None


def _file_chunks(f, offset: int) -> Iterator[bytes]:
    f.seek(offset)
    while c := f.read(CHUNK):
        yield c


GZIP, PLAIN = b"\x1f\x8b\x08", b"WARC/"


def iter_file_records(path: str, on_error: str = "fail", start: int = 0, stop: int | None = None, idx: int = 0):
    """(record_idx, offset, length, headers, block, error) for every record of
    a file, gzip-compressed (offset/length of the member) or plain (of the
    record).  One record is in memory at a time.  A broken record raises
    ValueError, or with ``on_error='reject'`` gives a row with its error.
    ``start`` (a record's offset, the ``idx``-th), ``stop``: only the members or
    records that begin there."""
    with fsio.open_read(path) as f:
        zipped = f.read(2) == GZIP[:2]
        offset, at = start, start
        while offset is not None:
            try:
                if zipped:
                    for at, chunks, state in _members(f, offset):
                        if stop is not None and at >= stop:
                            return
                        held = None  # a member's length is known only at its end
                        for heads, block, _, _ in _stream_records(chunks):
                            if held:
                                yield idx, at, None, *held, None
                                idx += 1
                            held = heads, block
                        if held:
                            yield idx, at, state["size"], *held, None
                            idx += 1
                        at += state["size"] or 0
                else:
                    for heads, block, begin, end in _stream_records(_file_chunks(f, offset)):
                        at = offset + end
                        if stop is not None and offset + begin >= stop:
                            return
                        yield idx, offset + begin, end - begin, heads, block, None
                        idx += 1
                return
            except (ValueError, zlib.error) as exc:
                if on_error != "reject":
                    raise ValueError(f"{path}, record at {at}: {exc}") from exc
                yield idx, at, None, {}, None, str(exc)
                idx += 1
                offset = _next_start(f, at + 1, GZIP if zipped else b"\n" + PLAIN)
                if offset is not None and not zipped:
                    offset += 1
                if offset is not None and stop is not None and offset >= stop:
                    return


def read_member(path: str, offset: int, length: int | None):
    """Records at ``offset`` (random access, J7): all of a gzip member's, or
    one of a plain file.  Without a length, up to the member's or record's end."""
    with fsio.open_read(path) as f:
        return read_member_of(f, offset, length)


def read_member_of(f, offset: int, length: int | None):
    """``read_member`` on an open file."""
    f.seek(offset)
    if f.read(2) != GZIP[:2]:
        heads, block, _, _ = next(_stream_records(_file_chunks(f, offset)), (None, None, 0, 0))
        if heads is None:
            raise ValueError("no record at the offset")
        return [(heads, block)]
    for _, chunks, state in _members(f, offset):
        got = [(heads, block) for heads, block, _, _ in _stream_records(chunks)]
        if length is not None and state["size"] is not None and length < state["size"]:
            raise ValueError(f"the member has {state['size']} bytes, the index says {length}")
        return got
    raise ValueError("no record at the offset")


class ChunkDecoder:
    """Chunked transfer coding, piece by piece.  ``feed`` gives the body bytes
    of what it is given; ``done`` says that the last chunk was seen, ``error``
    why the framing is broken (nothing more comes then)."""

    def __init__(self):
        self.held, self.left, self.state, self.error = b"", 0, "size", None

    @property
    def done(self) -> bool:
        return self.state == "done"

    def feed(self, data: bytes) -> bytes:
        out, buf, pos = [], self.held + data, 0
        while self.error is None and self.state != "done":
            if self.state == "data":
                piece = buf[pos:pos + self.left]
                out.append(piece)
                pos += len(piece)
                self.left -= len(piece)
                if self.left:
                    break
                self.state = "end"
            elif self.state == "end":  # the line end after a chunk's data
                if len(buf) - pos < 2:
                    if buf[pos:] not in (b"", b"\r"):
                        self.error = "no line end after a chunk"
                    break
                if buf[pos:pos + 2] != b"\r\n":
                    self.error = "no line end after a chunk"
                    break
                pos, self.state = pos + 2, "size"
            else:
                eol = buf.find(b"\n", pos)
                if eol < 0:
                    if len(buf) - pos > MAX_CHUNK_LINE:
                        self.error = "chunk size line too long"
                    break
                text = buf[pos:eol].split(b";", 1)[0].strip()
                if not CHUNK_SIZE.fullmatch(text):
                    self.error = f"bad chunk size {text[:20]!r}"
                    break
                pos, self.left = eol + 1, int(text, 16)
                self.state = "data" if self.left else "done"
        self.held = buf[pos:]
        return b"".join(out)

    def close(self) -> None:
        """The message ends here."""
        if self.error is None and not self.done:
            self.error = "cut chunk" if self.state != "size" else "no last chunk"


CHUNK_SIZE = re.compile(rb"[0-9A-Fa-f]{1,16}")
MAX_CHUNK_LINE = 4096


def dechunk_http(payload: bytes) -> tuple[bytes | None, str | None]:
    """Undo chunked transfer coding in an HTTP message, keeping the header
    block; other messages are returned unchanged.  Where the framing is broken
    there is no message but an error."""
    end = payload.find(b"\r\n\r\n")
    if end < 0:
        return payload, None
    head = payload[:end].lower()
    if b"transfer-encoding:" not in head or b"chunked" not in head.split(b"transfer-encoding:", 1)[1].split(b"\r\n", 1)[0]:
        return payload, None
    decoder = ChunkDecoder()
    body = decoder.feed(payload[end + 4:])
    decoder.close()
    return (None, f"chunked: {decoder.error}") if decoder.error else (payload[:end + 4] + body, None)


# -- one large file read by many tasks ---------------------------------------

def first_record(path: str, start: int) -> int | None:
    """Offset of the first member (or plain record) at or after ``start`` that
    decodes as a whole into records; None if there is none."""
    with fsio.open_read(path) as f:
        zipped = f.read(2) == GZIP[:2]
        sign, skip = (GZIP, 0) if zipped else (b"\n" + PLAIN, 1)
        at = _next_start(f, max(0, start - skip), sign)
        while at is not None:
            try:
                if zipped:
                    _, chunks, _ = next(_members(f, at))
                    if sum(1 for _ in _stream_records(chunks)):
                        return at
                elif next(_stream_records(_file_chunks(f, at + 1)), None):
                    return at + 1
            except (ValueError, zlib.error):
                pass
            at = _next_start(f, at + 1, sign)
    return None


def walk_range(path: str, entry: int, stop: int) -> tuple[int, int]:
    """From the record at ``entry`` on: (offset of the first record at or after
    ``stop``, or the file's end; number of records before it)."""
    n = 0
    with fsio.open_read(path) as f:
        zipped, size = f.read(2) == GZIP[:2], f.size()
        if zipped:
            for at, chunks, _ in _members(f, entry):
                if at >= stop:
                    return at, n
                n += sum(1 for _ in _stream_records(chunks))
        else:
            for _, _, begin, _ in _stream_records(_file_chunks(f, entry)):
                if entry + begin >= stop:
                    return entry + begin, n
                n += 1
    return size, n


def _probe(batches):
    import pandas as pd

    for b in batches:
        out = []
        for path, k, start, stop, entry in b.itertuples(index=False):
            try:
                if entry < 0:
                    found = 0 if start == 0 else first_record(path, start)
                    entry = stop if found is None else found
                after, n = walk_range(path, entry, stop) if entry < stop else (entry, 0)
                out.append((path, k, entry, after, n, None))
            except (ValueError, zlib.error) as exc:
                out.append((path, k, entry, -1, 0, str(exc)))
        yield pd.DataFrame(out, columns=["path", "k", "entry", "after", "n", "error"])


def plan_splits(spark: SparkSession, path: str, split_bytes: int) -> dict[str, list[tuple[int, int, int]]]:
    """Ranges (first record's offset, end, number of the first record) of every
    file above ``split_bytes``.

    Tasks walk the ranges at once, each from the first sound record it finds.
    What looks like a record may lie inside another one's payload, so ranges are
    then checked against each other: the record a range's walk ends at must be
    the next one's first; where it is not, that range is walked again from
    there.  One row a range comes back.  A file that does not decode is not
    split: the reader meets the error in its place.
    """
    big = {p: n for p, n, _ in fsio.walk_files(path) if n > split_bytes} if fsio.exists(path) and not _is_file(path) else {}
    if _is_file(path):
        with fsio.open_read(path) as f:
            big = {path: f.size()} if f.size() > split_bytes else {}
    big = {p: big[p] for p in fsio.list_files(path) if p in big}
    bounds = {p: [*range(0, n, split_bytes), n] for p, n in big.items()}
    asked = [(p, k, a, b, -1) for p, cuts in bounds.items() for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    found: dict[tuple[str, int], tuple[int, int, int]] = {}
    broken: set[str] = set()
    while asked:
        rows = spark.createDataFrame(asked, "path string, k int, start bigint, stop bigint, entry bigint").repartition(len(asked), "path", "k")
        asked = []
        for r in rows.mapInPandas(_probe, "path string, k int, entry bigint, after bigint, n bigint, error string").collect():
            if r.error is None:
                found[r.path, r.k] = (r.entry, r.after, r.n)
            else:  # perhaps only a false start
                found[r.path, r.k] = (r.entry, -1, 0)
        for p, cuts in bounds.items():
            entry = 0
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if p in broken:
                    break
                if entry >= b:
                    found[p, k] = (entry, entry, 0)
                elif found[p, k][0] != entry:
                    asked.append((p, k, a, b, entry))
                    break
                elif found[p, k][1] < 0:
                    broken.add(p)
                entry = found[p, k][1]
    out = {}
    for p, cuts in bounds.items():
        if p not in broken:
            first, out[p] = 0, []
            for k, b in enumerate(cuts[1:]):
                entry, _, n = found[p, k]
                if n:
                    out[p].append((entry, b, first))
                first += n
    return out


def _is_file(path: str) -> bool:
    return fsio.list_files(path) == [path]


COLUMNS = ["warc_file", "file_name", "record_idx", "record_offset", "record_length", "warc_type",
           "target_uri", "record_date", "content_type", "content_length_raw", "content_length",
           "headers", "payload", "error"]
BATCH_ROWS = 512
BATCH_BYTES = 64 << 20


def _arrow_schema():
    import pyarrow as pa

    s, i = pa.string(), pa.int64()
    return pa.schema([("warc_file", s), ("file_name", s), ("record_idx", i), ("record_offset", i),
                      ("record_length", i), ("warc_type", s), ("target_uri", s), ("record_date", s),
                      ("content_type", s), ("content_length_raw", s), ("content_length", i),
                      ("headers", pa.map_(s, s)), ("payload", pa.binary()), ("error", s)])


class WarcReader(DataSourceReader):
    """Options: path, payload, maxRecordBytes, onError, warcTypes (comma list
    kept at the source), dechunk, packBytes."""

    def __init__(self, options: dict):
        self.path = options.get("path", "")
        self.payload = options.get("payload", "true").lower() != "false"
        self.max_record = int(options.get("maxRecordBytes", "0"))
        self.on_error = options.get("onError", "fail")
        types = options.get("warcTypes", "")
        self.types = {t.strip() for t in types.split(",") if t.strip()} or None
        self.dechunk = options.get("dechunk", "true").lower() == "true"
        self.pack_bytes = int(options.get("packBytes", str(PACK_BYTES)))
        self.slots = int(options.get("slots", "1"))
        self.splits = options.get("splits", "")
        self.equal: dict[str, set] = {}

    def partitions(self):
        splits = {}
        if self.splits:
            with fsio.open_read(self.splits) as f:
                splits = json.loads(f.read())
        whole = packed_files(self.path, self.pack_bytes, self.slots, frozenset(splits))
        return [FilesPartition(p) for p in whole] + [RangePartition(p, *r) for p, ranges in splits.items() for r in ranges]

    def _keep(self, heads: dict) -> bool:
        wt = heads.get("warc-type")
        if self.types is not None and wt not in self.types:
            return False
        if "warc_type" in self.equal and wt not in self.equal["warc_type"]:
            return False
        if "content_type" in self.equal and heads.get("content-type") not in self.equal["content_type"]:
            return False
        return True

    def read(self, partition):
        import pyarrow as pa

        schema = _arrow_schema()
        rows, size = [], 0
        ranges = [(partition.path, partition.start, partition.stop, partition.idx)] if isinstance(partition, RangePartition) else [
            (path, 0, None, 0) for path in partition.paths]
        for own in ranges:
            for row, n in self._rows(*own):
                rows.append(row)
                size += n
                if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pydict(dict(zip(COLUMNS, map(list, zip(*rows)))), schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(COLUMNS, map(list, zip(*rows)))), schema=schema)

    def _rows(self, path, start=0, stop=None, first=0):
        name = file_name = os.path.basename(path)
        for suffix in (".gz", ".warc"):
            name = name.removesuffix(suffix)
        for idx, off, length, heads, block, error in iter_file_records(path, self.on_error, start, stop, first):
            if error is None and not self._keep(heads):
                continue
            if block is not None and self.max_record and len(block) > self.max_record:
                block, error = None, "over-cap"
            if self.dechunk and block and heads.get("content-type", "").startswith("application/http"):
                block, error = dechunk_http(block)
            payload = block if self.payload else None
            yield (name, file_name, idx, off, length, heads.get("warc-type"), heads.get("warc-target-uri"),
                   heads.get("warc-date"), heads.get("content-type"), heads.get("content-length"), _length(heads),
                   list(heads.items()), payload, error), len(payload or b"")


class WarcPushdownReader(WarcReader):
    """The reader with filter pushdown (used when the session enables
    ``spark.sql.python.filterPushdown.enabled``; Spark rejects a reader that
    defines ``pushFilters`` otherwise)."""

    def pushFilters(self, filters):
        """Accept equality / IN filters on warc_type and content_type; they
        are applied before a record's payload is copied.  (Called only when
        spark.sql.python.filterPushdown.enabled is true.)"""
        from pyspark.sql.datasource import EqualTo, In

        for f in filters:
            col = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if col in ("warc_type", "content_type"):
                vals = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.equal[col] = self.equal.get(col, vals) & vals
            else:
                yield f



class WarcCommit(WriterCommitMessage):
    def __init__(self, files: list[str]):
        self.files = files


def _record_bytes(warc_type, record_id, date, uri, content_type, payload) -> bytes:
    head = [b"WARC/1.0", b"WARC-Type: " + warc_type.encode()]
    if record_id:
        head.append(b"WARC-Record-ID: " + record_id.encode())
    if date:
        head.append(b"WARC-Date: " + date.encode())
    if uri:
        head.append(b"WARC-Target-URI: " + uri.encode())
    if content_type:
        head.append(b"Content-Type: " + content_type.encode())
    head.append(b"Content-Length: " + str(len(payload)).encode())
    return b"\r\n".join(head) + b"\r\n\r\n" + payload + b"\r\n\r\n"


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path = options.get("path", "")
        self.compress = options.get("compression", "gzip") != "none"

    def write(self, batches):
        import contextlib

        written: list[str] = []
        ext = ".warc.gz" if self.compress else ".warc"
        current = None
        with contextlib.ExitStack() as stack:
            out = None
            for b in batches:
                cols = (b.column(c).to_pylist() for c in WRITE_COLUMNS)
                for wf, _, warc_type, record_id, date, uri, content_type, payload in zip(*cols):
                    if wf != current:
                        if out is not None:
                            stack.close()  # completes the previous file
                        current = wf
                        final = fsio.join(self.path, wf + ext)
                        out = stack.enter_context(fsio.atomic_writer(final))
                        written.append(final)
                    rec = _record_bytes(warc_type, record_id, date, uri, content_type, payload or b"")
                    out.write(gzip.compress(rec, mtime=0) if self.compress else rec)
        return WarcCommit(written)


class WarcDataSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return WARC_RECORDS

    def reader(self, schema):
        if self.options.get("pushdown", "false").lower() == "true":
            return WarcPushdownReader(self.options)
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True, split_bytes: int = SPLIT_BYTES, **options) -> DataFrame:
    """Records under ``path``.  A file above ``split_bytes`` (0: none) is read by
    several tasks; that costs one more pass of it, by a job of its own, which
    finds where the ranges' records begin (``plan_splits``)."""
    register(spark)
    splits = plan_splits(spark, path, split_bytes) if split_bytes else {}
    if splits:
        name = scratch_path(spark, "splits") + ".json"
        fsio.write_atomic(name, [json.dumps(splits).encode()])
        options = {**options, "splits": name}
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    opts = {"payload": str(payload).lower(), "pushdown": pushdown, "slots": str(spark.sparkContext.defaultParallelism), **{k: str(v) for k, v in options.items()}}
    return spark.read.format("warc").options(**opts).load(path)


WRITE_COLUMNS = ["warc_file", "record_idx", "warc_type", "record_id", "record_date",
                 "target_uri", "content_type", "payload"]


def write_warc(df: DataFrame, path: str, num_files: int | None = None) -> None:
    """Write records so that each ``warc_file`` is one file, in ``record_idx``
    order.  A file is written by one task, as a file is one sequential
    stream; files are spread over tasks by hash."""
    register(df.sparkSession)
    d = df.select(*WRITE_COLUMNS)
    d = (d.repartition(num_files, "warc_file") if num_files else d.repartition("warc_file"))
    d.sortWithinPartitions("warc_file", "record_idx").write.format("warc").mode("overwrite").save(path)
