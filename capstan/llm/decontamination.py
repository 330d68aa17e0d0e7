"""Operator 7, benchmark decontamination by q-gram lemma filtering.

A benchmark passage of m characters that occurs in a text with at most k edits
shares at least m - q + 1 - kq of its q-grams with it, all on diagonals within
a window of k + 1.  Shared q-grams are counted in overlapping bands of
2(k + 1) diagonals, one of which holds any such window; bands that reach the
bound are verified by an alignment confined to the band.  Passages too short
for edits are looked up verbatim between word boundaries.

The benchmark is the stated query set: it goes out in blocks of bounded size
and every block meets all documents; there is no join and no shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import col, packed, schema_of
from capstan.llm.registry import query
from capstan.tables import table

Q, ERROR, MIN_CHARS = 8, 0.10, 32
BLOCK_CHARS = 4 << 20  # benchmark characters broadcast at a time
CHUNK_CHARS = 4 << 20  # document characters a task handles at a time
ALIGN = 256  # candidate bands aligned at a time
FAR = 1 << 20
PAIRS = 1 << 31


def normal(text: str | None) -> str:
    """Lower case, white space as single spaces, no NUL (which parts texts)."""
    return " ".join((text or "").replace("\0", " ").lower().split())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q characters from each position on (by doubling)."""
    base = 0x9E3779B97F4A7C15
    out, length = None, 0  # hash of ``length`` characters
    run, size = codes.astype(np.uint64), 1  # hash of ``size`` characters, a power of two
    while True:
        if q & size:
            if out is None:
                out = run
            else:  # these characters come before the ones hashed so far
                n = len(codes) - length - size + 1
                out = run[:max(0, n)] * np.uint64(pow(base, length, 1 << 64)) + out[size:size + max(0, n)]
            length += size
        if 2 * size > q:
            break
        n = max(0, len(run) - size)
        run = run[:n] * np.uint64(pow(base, size, 1 << 64)) + run[size:size + n]
        size *= 2
    out = out ^ (out >> np.uint64(32))
    return out * np.uint64(0xD6E8FEB86659FD93)


def _whole_words(text: str, start: int, stop: int) -> bool:
    """No word goes on over either end of text[start:stop]."""
    return not (text[start - 1:start].isalnum() and text[start].isalnum() or text[stop - 1].isalnum() and text[stop:stop + 1].isalnum())


class Index:
    """q-gram postings of one block of benchmark passages."""

    def __init__(self, items: list[tuple[int | None, str]], q: int = Q, error: float = ERROR, min_chars: int = MIN_CHARS):
        best: dict[str, int | None] = {}
        for i, text in items:
            t = normal(text)
            if len(t) >= q and (t not in best or best[t] is None or (i is not None and i < best[t])):
                best[t] = i
        texts = sorted(best)
        self.q, self.ids, self.texts, self.codes = q, [best[t] for t in texts], texts, [_codes(t) for t in texts]
        self.size = np.array([len(c) for c in self.codes], np.int64)
        # the budget, lowered where short passages would leave no shared q-gram; none under min_chars
        self.budget = np.minimum((error * self.size).astype(np.int64), (self.size - q) // q)
        self.verbatim = self.size < min_chars
        self.budget[self.verbatim] = 0
        self.least = self.size - q + 1 - self.budget * q
        grams = [_grams(c, q) for c in self.codes]
        all_grams = np.concatenate(grams) if grams else np.empty(0, np.uint64)
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        pos = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        order = np.argsort(all_grams, kind="stable")
        self.grams, first = np.unique(all_grams[order], return_index=True)
        self.item, self.pos = item[order], pos[order]
        self.first, self.count = first, np.diff(np.r_[first, len(order)])
        self.shift = np.uint64(64 - min(24, max(16, len(self.grams).bit_length() + 3)))
        self.filter = np.zeros(1 << (64 - int(self.shift)), bool)
        self.filter[self.grams >> self.shift] = True

    def hits(self, text: np.ndarray):
        """(text position, item, item position) of every shared q-gram."""
        grams = _grams(text, self.q)
        at = np.flatnonzero(self.filter[grams >> self.shift])
        slot = np.searchsorted(self.grams, grams[at])
        same = self.grams[np.minimum(slot, len(self.grams) - 1)] == grams[at]
        at, slot = at[same], slot[same]
        n = self.count[slot]
        posting = np.repeat(self.first[slot] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return np.repeat(at, n), self.item[posting], self.pos[posting]

    def bands(self, text: np.ndarray, doc: np.ndarray):
        """(doc, item, first diagonal) of the bands with enough shared
        q-grams; ``doc``: number of the text at each position."""
        at, item, pos = self.hits(text)
        owner = doc[at].astype(np.int64)
        pair, back, n = np.unique(owner * len(self.ids) + item, return_inverse=True, return_counts=True)
        some = (n >= self.least[pair % len(self.ids)])[back]  # too few in the whole text: none in a band
        at, item, pos, owner = at[some], item[some], pos[some], owner[some]
        width = self.budget[item] + 1
        shift = int(self.size.max()) if len(self.size) else 0
        band = (at - pos + shift) // width
        key = (owner * len(self.ids) + item) << 32
        key, n = np.unique(np.r_[key + band, key + np.maximum(band - 1, 0)], return_counts=True)
        item = (key >> 32) % max(1, len(self.ids))
        key, item = key[n >= self.least[item]], item[n >= self.least[item]]
        return (key >> 32) // max(1, len(self.ids)), item, (key & 0xFFFFFFFF) * (self.budget[item] + 1) - shift

    def align(self, text, item, first, begin, end):
        """Banded alignment of each passage to the part of ``text`` in its
        band and within [begin, end): edits, start, end of the best match."""
        edits, left, right = (np.full(len(item), FAR, np.int64) for _ in range(3))
        order = np.argsort(self.size[item], kind="stable")
        for a in range(0, len(order), ALIGN):
            o = order[a:a + ALIGN]
            sizes, wide = self.size[item[o]], 2 * (self.budget[item[o]] + 1)
            band = np.arange(wide.max())
            passage = np.zeros((len(o), sizes.max()), np.int64)
            for r, i in enumerate(item[o]):
                passage[r, :self.size[i]] = self.codes[i]
            inside = band[None, :] < wide[:, None]
            lo, hi = begin[o][:, None], end[o][:, None]
            col = first[o][:, None] + band[None, :]  # text characters consumed
            cost = np.where(inside & (col >= lo) & (col <= hi), 0, FAR)
            start = col.copy()
            for i in range(1, sizes.max() + 1):
                col = col + 1
                char = text[np.clip(col - 1, 0, len(text) - 1)]
                swap = cost + (char != passage[:, i - 1:i])
                skip = np.hstack([cost[:, 1:], np.full((len(o), 1), FAR)]) + 1
                took = skip < swap
                now = np.where(took, skip, swap)
                came = np.where(took, np.hstack([start[:, 1:], start[:, -1:]]), start)
                now = np.where(inside & (col >= lo) & (col <= hi), now, FAR)
                flat = now - band
                low = np.minimum.accumulate(flat, axis=1)
                source = np.maximum.accumulate(np.where(flat == low, band, 0), axis=1)
                cost, start = low + band, np.take_along_axis(came, source, 1)
                cost = np.where(inside & (col >= lo) & (col <= hi), cost, FAR)
                done = np.flatnonzero(sizes == i)
                if len(done):
                    b = cost[done].argmin(axis=1)
                    edits[o[done]], left[o[done]], right[o[done]] = cost[done, b], start[done, b], col[done, b]
        return edits, left, right

    def search(self, texts: list[str]) -> list[list[dict]]:
        """Matches of each normalised text: one per passage found, with the
        best place and the number of disjoint places."""
        if not self.ids or not texts:
            return [[] for _ in texts]
        room = max(1, PAIRS // len(self.ids))  # a pair of text and passage is numbered in 31 bits
        if len(texts) > room:
            return [hits for a in range(0, len(texts), room) for hits in self.search(texts[a:a + room])]
        out: list[list[dict]] = [[] for _ in texts]
        text = _codes("\0".join(texts) + "\0")
        sizes = np.array([len(t) for t in texts], np.int64)
        begin = np.r_[0, np.cumsum(sizes + 1)[:-1]]
        owner = np.repeat(np.arange(len(texts)), sizes + 1)
        doc, item, first = self.bands(text, owner)
        edits, left, right = np.zeros(len(item), np.int64), np.full(len(item), -1), np.full(len(item), -1)
        reach = 2 * (self.budget[item] + 1) - 1 + self.size[item]
        for c, (d, i, a, n) in enumerate(zip(doc.tolist(), item.tolist(), first.tolist(), reach.tolist())):
            lo = a - int(begin[d])  # a passage without edits needs no alignment
            at = texts[d].find(self.texts[i], max(0, lo), max(0, lo + n))
            while at >= 0 and self.verbatim[i] and not _whole_words(texts[d], at, at + len(self.texts[i])):
                at = texts[d].find(self.texts[i], at + 1, max(0, lo + n))
            if at >= 0:
                left[c], right[c] = begin[d] + at, begin[d] + at + len(self.texts[i])
        edits[(left < 0) & self.verbatim[item]] = FAR
        near = np.flatnonzero((left < 0) & ~self.verbatim[item])
        edits[near], left[near], right[near] = self.align(text, item[near], first[near], begin[doc[near]], begin[doc[near]] + sizes[doc[near]])
        good = np.flatnonzero(edits <= self.budget[item])
        found: dict[tuple[int, int], list] = {}
        for g in good.tolist():
            found.setdefault((int(doc[g]), int(item[g])), []).append((int(left[g] - begin[doc[g]]), int(right[g] - begin[doc[g]]), int(edits[g])))
        for (d, i), places in sorted(found.items()):
            start, stop, e = min(places, key=lambda p: (p[2], p[0]))
            n, upto = 0, -1
            for s, t, _ in sorted(places, key=lambda p: p[1]):
                if s >= upto:
                    n, upto = n + 1, t
            out[d].append({"item_id": self.ids[i], "edits": e, "start": start, "end": stop, "places": n})
        return out


HIT = "array<struct<item_id:bigint,edits:int,start:int,end:int,places:int>>"
_HIT = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("places", pa.int32())]))


def _search(shared, chunk_chars):
    def run(parts):
        for b in parts:
            texts = [normal(t) for t in b.column("text").to_pylist()]
            hits, held, size = [], [], 0
            for t in texts:
                held.append(t)
                size += len(t)
                if size >= chunk_chars:
                    hits += shared.value.search(held)
                    held, size = [], 0
            hits += shared.value.search(held)
            hits = [(old or []) + new for old, new in zip(b.column("hits").to_pylist(), hits)]
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("text"), pa.array(hits, _HIT)], ["row", "text", "hits"])
    return run


def mark_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", item_text: str = "text", text_col: str = "text",
               q: int = Q, error: float = ERROR, min_chars: int = MIN_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: ``row`` (struct of the columns of ``docs`` but
    the text), ``text`` and ``hits``: a struct for each benchmark passage that
    occurs in the text with edits of at most ``error`` of its length (item_id,
    edits, start and end of the best place, number of disjoint places).

    Both sides are lower-cased with white space as single spaces; positions
    count code points of that form.  Passages under ``min_chars`` code points
    match verbatim only and between word boundaries; those under ``q`` (null
    and empty ones too) are too short to mean a leak and match nothing; of
    equal passages the smallest item_id stands for all.  A null or empty
    text has no hits; repeated rows are marked alike; an empty table gives no
    row, and an empty benchmark no hits.
    """
    spark = docs.sparkSession
    out = docs.select(packed(docs, (text_col,)), col(text_col).cast("string").alias("text"), F.lit(None).cast(HIT).alias("hits"))
    schema = schema_of(out, f"text string, hits {HIT}")
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(item_text).cast("string").alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_chars))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == k).distinct().collect()  # about block_chars characters
        shared = spark.sparkContext.broadcast(Index([(r["id"], r["text"]) for r in own], q, error, min_chars))
        out = out.mapInArrow(_search(shared, CHUNK_CHARS), schema)
    return out


@query("op7_decontamination")
def op7_decontamination(spark, sf_dir):
    got = mark_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return got.select("row.doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")
