"""One archive file read by many tasks, and chunked bodies with broken framing."""

import gzip
import os
import random

import pytest

from capstan.session import scratch_path
from capstan.sources import fsio, warc

HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: application/pdf\r\nTransfer-Encoding: chunked\r\n\r\n"


def record(n, payload):
    return (f"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: u{n}\r\nContent-Length: {len(payload)}\r\n\r\n").encode() + payload + b"\r\n\r\n"


def payloads(nested):
    """Records with incompressible payloads; one holds a whole archive."""
    rng = random.Random(7)
    out = [rng.randbytes(rng.randrange(10, 4000)) for _ in range(120)]
    out[40] = rng.randbytes(500) + nested + rng.randbytes(500)
    out[80] = nested
    return out


def archive(spark, kind):
    inner = [record(900 + i, random.Random(i).randbytes(900)) for i in range(30)]
    folder = scratch_path(spark, "split")
    if kind == "plain":
        data = b"".join(record(i, p) for i, p in enumerate(payloads(b"\r\n" + b"".join(inner))))
    elif kind == "one-member":
        data = gzip.compress(b"".join(record(i, p) for i, p in enumerate(payloads(b"".join(map(gzip.compress, inner))))))
    else:
        data = b"".join(gzip.compress(record(i, p), 0 if i % 3 else 6) for i, p in enumerate(payloads(b"".join(gzip.compress(r, 0) for r in inner))))
    if kind == "cut":
        data = data[:-700]
    fsio.write_atomic(os.path.join(folder, "a.warc" if kind == "plain" else "a.warc.gz"), [data])
    fsio.write_atomic(os.path.join(folder, "b.warc.gz"), [gzip.compress(record(5000, b"small"))])
    return folder


COLS = ("file_name", "record_idx", "record_offset", "record_length", "target_uri", "content_length", "payload")


@pytest.mark.parametrize("kind", ["members", "plain", "one-member"])
def test_split_equals_whole(spark, kind):
    folder = archive(spark, kind)
    whole = sorted(tuple(r) for r in warc.read_warc(spark, folder, split_bytes=0).select(*COLS).collect())
    assert len(whole) == 121
    for size in (3_000, 17_000, 100_000):
        df = warc.read_warc(spark, folder, split_bytes=size)
        assert sorted(tuple(r) for r in df.select(*COLS).collect()) == whole
        splits = warc.plan_splits(spark, folder, size)
        starts = [a for a, _, _ in next(iter(splits.values()))]
        assert set(starts) <= {r[2] for r in whole} and (kind == "one-member" or len(starts) > 1)


def test_a_cut_file_is_left_to_the_reader(spark):
    folder = archive(spark, "cut")
    assert warc.plan_splits(spark, folder, 20_000) == {}
    rows = warc.read_warc(spark, folder, split_bytes=20_000, onError="reject").collect()
    assert sum(r.error is not None for r in rows) >= 1 and sum(r.error is None for r in rows) == 120


@pytest.mark.parametrize("body,error", [
    (b"-6\r\nabcdef\r\n0\r\n\r\n", "bad chunk size b'-6'"), (b"+5\r\nabcde\r\n0\r\n\r\n", "bad chunk size b'+5'"),
    (b"0x5\r\nabcde\r\n0\r\n\r\n", "bad chunk size b'0x5'"), (b"1_0\r\n" + b"a" * 16 + b"\r\n0\r\n\r\n", "bad chunk size b'1_0'"),
    (b"\r\nabc", "bad chunk size b''"), (b"5\r\nabcde\r\n", "no last chunk"), (b"5\r\nab", "cut chunk"), (b"5\r\nabcdeX0\r\n", "no line end after a chunk"),
    (b"f" * 17 + b"\r\n", f"bad chunk size {b'f' * 17!r}"), (b"5\r\nabcde", "cut chunk"), (b"", "no last chunk"),
])
def test_broken_framing_is_an_error(body, error):
    assert warc.dechunk_http(HEAD + body) == (None, f"chunked: {error}")


def test_sound_framing_in_any_pieces():
    body = b"3;ext=1\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: x\r\n\r\n"
    assert warc.dechunk_http(HEAD + body) == (HEAD + b"abc0123456789", None)
    for step in range(1, 9):
        d = warc.ChunkDecoder()
        got = b"".join(d.feed(body[i:i + step]) for i in range(0, len(body), step))
        d.close()
        assert (got, d.error, d.done) == (b"abc0123456789", None, True)
    plain = b"HTTP/1.1 200 OK\r\n\r\n-6\r\n"
    assert warc.dechunk_http(plain) == (plain, None)
