"""Operator 12, fill-in-the-middle: content-defined chunk memoization.

A text is cut into units (a word with the white space before it; white space
at the end is a unit of its own) at two places, found without looking for its
words one by one: a rolling hash chunks the text, so texts that share a
passage share its chunks; each chunk's boundary summary (first and last
character a word character or not, words, code points) is made once and kept
with the chunk's content, which a later chunk must equal byte by byte to use
it.  Summaries add up, with a word that goes on over a boundary counted once,
so running sums give the units of the text and the chunk that holds a cut;
only that chunk is scanned.

A document is handled where it is read: no shuffle, one Arrow batch and a cache
of bounded size in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import byte_rows, col, packed, schema_of
from capstan.llm.registry import query
from capstan.tables import table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
WINDOW, CHUNK_BITS, CACHE_BYTES = 32, 9, 32 << 20
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
WORD_END = re.compile(rb"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")
#: One pseudo-random number per byte value, from a fixed rule.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), 0) for b in range(256)], np.uint32)


def is_space(b: int) -> bool:
    return b == 32 or 9 <= b <= 13


def chunk_ends(data: bytes, window: int = WINDOW, bits: int = CHUNK_BITS, block: int = 1 << 20) -> list[int]:
    """Ends of the chunks of ``data``, the last one its length.  A chunk ends
    where the rolling hash of the ``window`` (a power of two, up to 32) bytes up
    to there has ``bits`` zero bits, wherever those bytes stand.  The sum of the
    window's shifted byte numbers is doubled up from spans of one byte, for a
    block of positions at a time."""
    n, ends = len(data), []
    for start in range(0, n - window + 1, block):
        h, span = GEAR[np.frombuffer(data, np.uint8, min(block + window - 1, n - start), start)], 1
        while span < window:
            wide = h.copy()
            wide[span:] += h[:-span] << np.uint32(span)
            h, span = wide, 2 * span
        # the bits below ``window`` down to ``window - bits`` depend on the whole window
        top = h[window - 1:] >> np.uint32(window - bits) & np.uint32((1 << bits) - 1)
        ends += (np.flatnonzero(top == 0) + (start + window)).tolist()
    return ends if not n or ends and ends[-1] == n else [*ends, n]


def points(data: bytes) -> int:
    """Code points: the bytes that begin one."""
    return len(data) if data.isascii() else int(np.count_nonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80))


class Summaries:
    """Boundary summaries by chunk content, at most ``limit`` bytes of them; a
    full cache starts anew, which costs time but changes no summary."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.size, self.hits, self.known = limit, 0, 0, {}

    def get(self, chunk: bytes) -> tuple[int, int, int, int]:
        """(first is a word character, last is one, words, code points)."""
        key = xxhash.xxh3_64_intdigest(chunk)
        held = self.known.get(key)
        if held is not None and held[0] == chunk:  # equal hashes alone are no proof
            self.hits += 1
            return held[1]
        out = (int(not is_space(chunk[0])), int(not is_space(chunk[-1])), len(WORD.findall(chunk)), points(chunk))
        if len(chunk) <= self.limit:
            if self.size + len(chunk) > self.limit:
                self.known, self.size = {}, 0
            self.size += len(chunk) + 200
            self.known[key] = (chunk, out)
        return out


class Units:
    """Number of units of a text (``count``), and where the first k of them end."""

    def __init__(self, data: bytes, cache: Summaries):
        self.data = data
        self.bounds = [0, *chunk_ends(data)]
        got = [cache.get(data[a:b]) for a, b in zip(self.bounds, self.bounds[1:])]
        first, last, words, chars = np.array(got, np.int64).reshape(-1, 4).T
        # the word that reaches a chunk's start ends there if the chunk begins with white space
        self.at_start = np.concatenate(([0], last))[:len(got)] * (1 - first)
        self.ended = np.cumsum(self.at_start + words - last)
        self.chars = np.concatenate(([0], np.cumsum(chars)))
        # the text's end ends its last word, or the white space after it
        self.count = int(self.ended[-1]) + 1 if got else 0

    def cut(self, k: int) -> tuple[int, int]:
        """(byte, code point) where the first ``k`` units end."""
        if k <= 0:
            return 0, 0
        if k >= self.count:
            return len(self.data), int(self.chars[-1])
        c = int(np.searchsorted(self.ended, k))
        a, b = self.bounds[c], self.bounds[c + 1]
        left = k - (int(self.ended[c - 1]) if c else 0) - int(self.at_start[c])
        at = next(islice(WORD_END.finditer(self.data, a, b), left - 1, None)).end() if left else a
        return at, int(self.chars[c]) + points(self.data[a:at])


def _draws(key: str, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers from the seed and the row's id."""
    h = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(h[i:i + 8], 16) for i in range(0, 32, 8)]


def _transform(parts: Iterator[pa.RecordBatch], seed: int, fim_percent: int, spm_percent: int) -> Iterator[pa.RecordBatch]:
    cache = Summaries()
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    for b in parts:
        rows = []
        for key, data in zip(b.column("key").to_pylist(), byte_rows(b.column("text"))):
            units = Units(data, cache)
            h = _draws(key, seed)
            if not data or any(x in data for x in marks) or h[2] % 100 >= fim_percent:
                rows.append((units.count, "plain", None, None, data))
                continue
            ends = sorted(x % (units.count + 1) for x in h[:2])
            (i, ci), (j, cj) = map(units.cut, ends)
            prefix, middle, suffix = data[:i], data[i:j], data[j:]
            if h[3] % 100 < spm_percent:
                form, out = "spm", (s, suffix, p, prefix, m, middle)
            else:
                form, out = "psm", (p, prefix, s, suffix, m, middle)
            rows.append((units.count, form, ci, cj - ci, b"".join(out)))
        n, form, pre, mid, out = zip(*rows) if rows else ((),) * 5
        yield pa.RecordBatch.from_arrays(
            [b.column("row"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(pre, pa.int64()),
             pa.array(mid, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())],
            ["row", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, fim_percent: int = 50,
                   spm_percent: int = 80) -> DataFrame:
    """``row`` (a struct of all columns but the text), ``n`` (units), ``form``
    (plain, psm or spm), ``prefix_chars``, ``middle_chars`` and ``output``.

    Where a text is cut, and into which form, depends on the seed and the id
    alone, so a lost task's rows come out the same.  A null text is empty; an
    empty text, and one that holds a mark, stays plain.  A null id draws as an
    empty one.  Rows that repeat are treated alike and all returned; an empty
    table gives no row.
    """
    src = docs.select(packed(docs, (text_col,)), F.coalesce(col(id_col).cast("long").cast("string"), F.lit("")).alias("key"),
                      col(text_col).cast("string").alias("text"))
    schema = schema_of(src, "n long, form string, prefix_chars long, middle_chars long, output string")
    return src.mapInArrow(lambda parts: _transform(parts, seed, fim_percent, spm_percent), schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``fill_in_middle`` was made from."""
    piece = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(piece[1], piece[3], piece[2]))
            .when(form == "spm", F.concat(piece[2], piece[3], piece[1])).otherwise(output))


@query("op12_fill_middle", r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
                  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
           FROM documents),
d AS (SELECT doc_id, text, u, len(u) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(u) + 1) AS a,
             ('0x' || substr(h, 9, 8))::BIGINT % (len(u) + 1) AS b,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                       OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
                  WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
      FROM t),
c AS (SELECT *, array_to_string(list_slice(u, 1, least(a, b)), '') AS p,
             array_to_string(list_slice(u, least(a, b) + 1, greatest(a, b)), '') AS m,
             array_to_string(list_slice(u, greatest(a, b) + 1, n), '') AS s FROM d)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM c
""")
def op12_fill_middle(spark, sf_dir):
    got = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("row.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))
