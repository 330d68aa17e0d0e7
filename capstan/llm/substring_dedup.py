"""Operator 1, substring dedup with difference-cover anchors.

Word windows of length W that repeat are found in two shuffles.  First, only
anchors (W - v + 1 words) that start at positions of a difference cover modulo
v are hashed: for any two positions there is a shift below v that brings both
onto the cover, so equal windows share an aligned anchor.  Second, the windows
around anchors that two documents share are extended to their full W words and
compared by two independent hashes (96 bits).

Each task settles first what it can among its own documents, so it sends one
representative of a repeated passage, however many of its documents hold it:
a passage in a third of all documents is met once per task.  Hashes travel in
blocks (arrays by bucket), and a bucket's size falls as the session's shuffle
partitions rise.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import col, lists, packed, partitions, schema_of
from capstan.llm.registry import query
from capstan.tables import table

WINDOW = 13
CHUNK_WORDS = 1 << 18  # words a task handles at a time
LONG_WORD = 64  # bytes; longer words are hashed one by one
BUCKETS_PER_PARTITION = 4
#: Perfect difference sets, period to residues.
COVERS = {3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
LAST = (1 << 63) - 1  # a null id counts as larger than any other


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves anchors of at least half the window."""
    fits = [v for v in COVERS if window - v + 1 >= window / 2]
    return (max(fits), COVERS[max(fits)]) if fits else (1, (0,))


def _mix(x):
    """SplitMix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """Words of many texts at once: byte spans and 64-bit hashes by family."""

    is_space = np.zeros(256, bool)
    is_space[[9, 10, 11, 12, 13, 32]] = True
    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts) + b"\n"
        self.bytes = np.frombuffer(self.raw, np.uint8)
        space = self.is_space[self.bytes]
        edge = np.flatnonzero(np.diff(np.r_[True, space].astype(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(ends, self.start, "right")
        self.first = np.searchsorted(self.doc, np.arange(len(texts)))  # first word of each text
        self.count = np.diff(np.r_[self.first, len(self.start)])
        self.pos = np.arange(len(self.start)) - self.first[self.doc]

    def words(self, family: int) -> np.ndarray:
        """Each word's bytes, eight at a time, through a mixing step that is not
        linear in them; long words by XXH3 (both with the family's seed)."""
        seed = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)[family]
        size = self.end - self.start
        eight = np.ndarray((len(self.raw),), "<u8", self.raw + bytes(8), 0, (1,))  # the 8 bytes from each place on
        out = _mix(size.astype(np.uint64) + np.uint64(seed))
        at = np.arange(len(size))
        for lane in range(0, LONG_WORD, 8):
            at = at[size[at] > lane]
            if not len(at):
                break
            left = np.minimum(size[at] - lane, 8).astype(np.uint64)
            value = eight[self.start[at] + lane] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
            out[at] = _mix((out[at] ^ value) * np.uint64(0x9FB21C651E98DF25) + np.uint64(seed))
        for i in np.flatnonzero(size > LONG_WORD).tolist():
            out[i] = xxhash.xxh3_64_intdigest(self.raw[self.start[i]:self.end[i]], seed)
        return out

    def windows(self, length: int, family: int) -> np.ndarray:
        """Hash of the ``length`` words from each word on (wrong where the
        text ends before; see ``whole``)."""
        w = self.words(family)
        out = np.zeros(max(0, len(w) - length + 1), np.uint64)
        for k in range(length):
            out = out * np.uint64(0x2545F4914F6CDD1D) + w[k:k + len(out)]
        return np.r_[_mix(out), np.zeros(len(w) - len(out), np.uint64)]

    def whole(self, length: int) -> np.ndarray:
        return self.pos + length <= self.count[self.doc]


def _chunks(parts, chunk_words, extra=()):
    """Rows of Arrow batches in lists of about ``chunk_words`` words (by size)."""
    rows, size = [], 0
    for b in parts:
        cols = [b.column("ord").to_pylist(), b.column("text").to_pylist(), *(b.column(c).to_pylist() for c in extra)]
        for row in zip(*cols):
            rows.append(row)
            size += len(row[1])
            if size >= 6 * chunk_words:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def _blocks(bucket, ids, pos, columns, names):
    """One row per bucket: arrays in the order of id and position, these two
    as differences, which compress well."""
    order = np.lexsort((pos, ids, bucket))
    bucket = bucket[order]
    start = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
    offsets = np.r_[start, len(bucket)]
    arrays = [pa.array(bucket[start], pa.int32())]
    for values, dtype in ((ids[order], pa.int64()), (pos[order], pa.int32())):
        step = np.r_[values[:1], np.diff(values)]
        step[start] = values[start]
        arrays.append(lists(step, offsets, dtype))
    arrays += [lists(c[order], offsets, t) for c, t in columns]
    return pa.RecordBatch.from_arrays(arrays, ["bucket", "id", "pos", *names])


def _unblocked(parts, names):
    """All blocks of a task: bucket, id, position and the other columns, flat."""
    got = [b for b in parts if b.num_rows]
    if not got:
        return None

    def flat(name):
        return np.concatenate([b.column(name).flatten().to_numpy(zero_copy_only=False) for b in got])

    sizes = np.concatenate([np.diff(b.column("id").offsets.to_numpy()) for b in got])
    start = np.r_[0, np.cumsum(sizes)[:-1]]

    def summed(name):
        total = np.cumsum(flat(name), dtype=np.int64)
        return total - np.repeat(np.where(start > 0, total[start - 1], 0), sizes)

    bucket = np.repeat(np.concatenate([b.column("bucket").to_numpy() for b in got]), sizes).astype(np.int64)
    return bucket, summed("id"), summed("pos"), *map(flat, names)


def _groups(*keys):
    """Sort order and group number (along it) of equal key tuples."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new) - 1, np.flatnonzero(new)


def _by_doc(ids, th, pos):
    """One row per document: array of positions."""
    order = np.lexsort((pos, th, ids))
    ids, th, pos = ids[order], th[order], pos[order]
    start = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (th[1:] != th[:-1])]) if len(ids) else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(ids[start], pa.int64()), pa.array(th[start], pa.int32()),
                                       lists(pos, np.r_[start, len(ids)], pa.int32())], ["ord", "th", "pos"])


BLOCK_TYPE = "bucket int, id array<long>, pos array<int>"
FOUND_TYPE = BLOCK_TYPE + ", th array<int>"
MARK_TYPE = "ord long, th int, pos array<int>"
SINGLE, KNOWN, SHARED = 0, 1, 2


def _anchors(window, n_buckets, chunk_words):
    period, cover = cover_for(window)

    def run(parts):
        for rows in _chunks(parts, chunk_words):
            ids = np.array([r[0] for r in rows], np.int64)
            w = WordHashes([r[1] for r in rows])
            at = np.flatnonzero(np.isin(w.pos % period, cover) & w.whole(window - period + 1) & (w.count[w.doc] >= window))
            h = w.windows(window - period + 1, 0)[at]
            order, group, start = _groups(h)
            at, h, doc = at[order], h[order], w.doc[at[order]]
            end = np.r_[start[1:], len(h)] - 1
            many = (doc[start] != doc[end])[group] if len(h) else np.empty(0, bool)
            rep = np.zeros(len(h), bool)
            rep[start] = True
            send = np.flatnonzero(rep | ~many)  # to the bucket of the hash
            keep = np.flatnonzero(many)  # settled here: shared
            pick = np.r_[send, keep]
            code = np.r_[np.where(many[send], SHARED, SINGLE), np.full(len(keep), KNOWN)].astype(np.int8)
            own = ids[doc[pick]]
            bucket = np.where(code == KNOWN, _mix(own.view(np.uint64)), h[pick] >> np.uint64(32)) % np.uint64(n_buckets)
            yield _blocks(bucket.astype(np.int64), own, w.pos[at[pick]].astype(np.int32), [
                (code, pa.int8()), (h[pick].astype(np.uint32).view(np.int32), pa.int32())], ["code", "h"])
    return run


def _found(n_buckets, ids, th, pos):
    """Positions in blocks by document: few rows, whatever the number of
    tasks among which a document's hashes were spread."""
    return _blocks((_mix(ids.view(np.uint64)) % np.uint64(n_buckets)).astype(np.int64), ids, pos, [(th, pa.int32())], ["th"])


def _gathered(parts):
    """All positions of each document of a task."""
    got = _unblocked(parts, ["th"])
    if got is not None:
        _, ids, pos, th = got
        yield _by_doc(ids, th, pos)


def _shared(n_buckets, parts):
    """Anchors whose hash two documents hold."""
    got = _unblocked(parts, ["code", "h"])
    if got is None:
        return
    bucket, ids, pos, code, h = got
    ask = np.flatnonzero(code != KNOWN)
    order, group, start = _groups(bucket[ask], h[ask])
    o = ask[order]
    if len(o):
        shared = (np.minimum.reduceat(ids[o], start) != np.maximum.reduceat(ids[o], start)) | (np.maximum.reduceat(code[o], start) == SHARED)
        o = o[shared[group]]
    o = np.r_[o, np.flatnonzero(code == KNOWN)]
    yield _found(n_buckets, ids[o], np.zeros(len(o), np.int32), pos[o])


def _windows(window, n_buckets, chunk_words):
    period, _ = cover_for(window)

    def run(parts):
        for rows in _chunks(parts, chunk_words, ("marks", "th")):
            ids = np.array([r[0] for r in rows], np.int64)
            th = np.array([r[3] for r in rows], np.int32)
            w = WordHashes([r[1] for r in rows])
            flag = np.zeros(len(w.pos) + 1, np.int64)
            for d, r in enumerate(rows):
                if w.count[d]:
                    p = np.array([x for part in r[2] for x in part], np.int64)
                    flag[w.first[d] + p[p < w.count[d]]] = 1
            seen = np.r_[0, np.cumsum(flag)]
            near = np.minimum(np.arange(len(w.pos)) + period, len(w.pos))
            at = np.flatnonzero(w.whole(window) & (seen[near] > seen[:len(w.pos)]))
            k1, k2 = w.windows(window, 0)[at], w.windows(window, 1)[at] >> np.uint64(32)
            order, group, start = _groups(k1, k2)
            at, k1, k2, own = at[order], k1[order], k2[order], ids[w.doc[at[order]]]
            known = own > np.minimum.reduceat(own, start)[group] if len(own) else np.empty(0, bool)
            code = np.where(known, KNOWN, SINGLE).astype(np.int8)
            k1, k2 = np.where(known, np.uint64(0), k1), np.where(known, np.uint64(0), k2)
            # windows go where their smallest anchor hash says: neighbours mostly to the same bucket
            anchor = w.windows(window - period + 1, 0)
            least = anchor.copy()
            for k in range(1, period):
                least[:-k] = np.minimum(least[:-k], anchor[k:])
            bucket = _mix(np.where(known, own.view(np.uint64), least[at])) % np.uint64(n_buckets)
            yield _blocks(bucket.astype(np.int64), own, w.pos[at].astype(np.int32), [
                (code, pa.int8()), (k1.view(np.int64), pa.int64()), (k2.astype(np.uint32).view(np.int32), pa.int32()),
                (th[w.doc[at]], pa.int32())], ["code", "k1", "k2", "th"])
    return run


def _covered(n_buckets, parts):
    """Windows that also start in a document with a smaller id."""
    got = _unblocked(parts, ["code", "k1", "k2", "th"])
    if got is None:
        return
    _, ids, pos, code, k1, k2, th = got
    o = np.flatnonzero(code != KNOWN)
    order, group, start = _groups(k1[o], k2[o])
    o = o[order]
    if len(o):
        o = o[ids[o] > np.minimum.reduceat(ids[o], start)[group]]
    o = np.r_[o, np.flatnonzero(code == KNOWN)]
    yield _found(n_buckets, ids[o], th[o], pos[o])


def _removed(window):
    def run(parts):
        for b in parts:
            texts, n_words, n_removed, spans = [], [], [], []
            for text, th, found in zip(b.column("text").to_pylist(), b.column("th").to_pylist(), b.column("found").to_pylist()):
                words = text.split()
                edge = np.zeros(len(words) + 1, np.int64)
                for f in found or ():
                    if f["th"] == th:
                        np.add.at(edge, f["pos"], 1)
                        np.add.at(edge, np.array(f["pos"], np.int64) + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                cut = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8)))
                texts.append(b" ".join([words[i] for i in np.flatnonzero(~gone)] if gone.any() else words))
                n_words.append(len(words))
                n_removed.append(int(gone.sum()))
                spans.append([{"start": int(s), "end": int(e)} for s, e in zip(cut[::2], cut[1::2])])
            yield pa.RecordBatch.from_arrays([
                b.column("row"), pa.array(texts, pa.binary()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], ["row", "kept", "n_words", "n_removed", "spans"])
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """One row per input row: ``row`` (struct of the columns of ``docs`` but
    the text), ``kept`` (words left, joined by one space), ``n_words``,
    ``n_removed`` and ``spans`` (start, end of the word ranges removed).

    A word goes if a window of ``window`` words that covers it also starts in
    a document with a smaller id.  A null or empty text has no words.  Null ids
    count as larger than any other; rows with equal ids never remove each
    other's words.  An empty table gives no row.
    """
    spark = docs.sparkSession
    n_buckets = BUCKETS_PER_PARTITION * partitions(spark)
    base = docs.select(F.coalesce(col(id_col).cast("long"), F.lit(LAST)).alias("ord"), packed(docs, (text_col,)),
                       F.coalesce(col(text_col), F.lit("")).cast("binary").alias("text"))
    th = F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("th")

    def dealt(blocks):
        return blocks.repartition(partitions(spark), "bucket")

    def found_by(rule, blocks):
        places = dealt(blocks).mapInArrow(partial(rule, n_buckets), FOUND_TYPE)
        return dealt(places).mapInArrow(_gathered, MARK_TYPE)

    anchors = base.select("ord", "text").mapInArrow(_anchors(window, n_buckets, chunk_words), BLOCK_TYPE + ", code array<byte>, h array<int>")
    marks = found_by(_shared, anchors)
    by_doc = marks.groupBy("ord").agg(F.collect_list("pos").alias("marks"))
    # with ``row``, so that this join and the last read the same exchange of the documents
    around = base.join(by_doc, "ord").select("ord", "row", "text", "marks", th)
    found = found_by(_covered, around.mapInArrow(_windows(window, n_buckets, chunk_words),
                                                 BLOCK_TYPE + ", code array<byte>, k1 array<long>, k2 array<int>, th array<int>"))
    by_doc = found.groupBy("ord").agg(F.collect_list(F.struct("th", "pos")).alias("found"))
    joined = base.join(by_doc, "ord", "left").select("row", "text", "found", th)
    out = joined.mapInArrow(_removed(window), schema_of(base, "kept binary, n_words long, n_removed long, spans array<struct<start:int,end:int>>"))
    return out.withColumn("kept", F.col("kept").cast("string"))


@query("op1_substring_dedup", r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS a FROM documents),
g AS (SELECT doc_id, a, unnest(range(1, greatest(len(a) - 11, 1))) AS p FROM w),
h AS (SELECT doc_id, p, md5(array_to_string(a[p:p + 12], ' ')) AS k FROM g),
m AS (SELECT k, min(doc_id) AS least FROM h GROUP BY k),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS pos FROM h JOIN m USING (k) WHERE doc_id > least),
l AS (SELECT doc_id, list(pos) AS gone FROM c GROUP BY doc_id),
r AS (SELECT w.doc_id, a, coalesce(gone, []) AS gone FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
u AS (SELECT doc_id, generate_subscripts(a, 1) AS pos, unnest(a) AS word FROM w),
k AS (SELECT u.doc_id, string_agg(word, ' ' ORDER BY u.pos) AS kept FROM u LEFT JOIN c ON c.doc_id = u.doc_id AND c.pos = u.pos
      WHERE c.pos IS NULL GROUP BY u.doc_id)
SELECT r.doc_id, len(a) AS n_words, len(gone) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM r LEFT JOIN k ON r.doc_id = k.doc_id
""")
def op1_substring_dedup(spark, sf_dir):
    got = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
