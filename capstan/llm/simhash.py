"""Operator 6, SimHash near-dedup with pivot distance tables.

Fingerprints within ``max_bits`` agree wholly in 3 of ``max_bits + 3`` blocks
of bits, so they share a bucket of at least one choice of 3 blocks.  Inside a
bucket, the table of Hamming distances to the reference fingerprints (pivots)
discards a pair as soon as one coordinate differs by more than ``max_bits``
(triangle inequality); the survivors are verified bit by bit.  The buckets are
counted first: a bucket of more than ``HOT`` fingerprints is dealt again, by
choices of 3 of ``max_bits + 3`` blocks of the bits on which its members need
not agree, until few such bits are left.  So no task compares a large bucket
(with 3 bits, about 32, then 48, then 56 bits agree, which few can share),
and no link is lost, as two fingerprints within ``max_bits`` share a bucket of
every new deal, too.  A bucket sends
on a star of each of its local components, never its pairs; the stars are
joined to whole components by star contraction.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import byte_rows, parked, partitions, salt
from capstan.llm.components import components
from capstan.llm.registry import query
from capstan.tables import table

WORDS, MAX_BITS, PIVOTS, SALTS = 3, 3, 16, 64
CHUNK = 1 << 16  # words hashed at a time
BLOCK = 1 << 10  # rows of a bucket compared at a time
HOT = 1 << 13  # fingerprints of a bucket, above which it is dealt again
FREE_BITS = 10  # a bucket whose members differ in so few bits is small by itself


def fingerprint(text: bytes, n_words: int = WORDS, chunk: int = CHUNK) -> int:
    """The unsigned 64-bit fingerprint of one whole text (A-Z lower-cased)."""
    words = text.lower().split()  # bytes: A-Z, and exactly the contract's white space
    if not words:
        return 0
    if len(words) < n_words:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    ones, total, digest = np.zeros(64, np.int64), len(words) - n_words + 1, xxhash.xxh64_digest
    for a in range(0, total, chunk):
        part = words[a:a + chunk + n_words - 1]
        shifted = zip(*(part[i:] for i in range(n_words)))
        raw = b"".join([digest(b" ".join(s), 42) for s in shifted])  # big-endian
        ones += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def _fingerprints(n_words):
    def run(parts):
        for b in parts:
            fp = np.array([fingerprint(t, n_words) for t in byte_rows(b.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("th"), pa.array(fp.view(np.int64))], ["id", "th", "fp"])
    return run


def pivots(n: int = PIVOTS) -> np.ndarray:
    """Reference fingerprints: the SplitMix64 sequence from 0."""
    out, state, mask = [], 0, (1 << 64) - 1
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & mask
        z = ((state ^ (state >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        out.append(z ^ (z >> 31))
    return np.array(out, np.uint64)


@cache
def block_masks(max_bits: int, agreed: int = 0) -> list[int]:
    """``agreed`` with the masks of every choice of 3 of ``max_bits + 3``
    blocks of the other bits."""
    free = [i for i in range(64) if not agreed >> i & 1]
    cuts = [round(i * len(free) / (max_bits + 3)) for i in range(max_bits + 4)]
    blocks = [sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:])]
    return [agreed | sum(c) for c in combinations(blocks, 3)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _close(fp, table_, i, j, max_bits):
    """Which of the pairs (i, j) are within ``max_bits``: pivots, then bits."""
    alive = np.arange(len(i))
    for k in range(table_.shape[1]):
        d = table_[i[alive], k] - table_[j[alive], k]
        alive = alive[np.abs(d) <= max_bits]
    return alive[np.bitwise_count(fp[i[alive]] ^ fp[j[alive]]) <= max_bits]


class _Forest:
    def __init__(self, n):
        self.up = np.arange(n)

    def find(self, x):
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, a, b):
        for x, y in zip(a.tolist(), b.tolist()):
            x, y = self.find(x), self.find(y)
            if x != y:
                self.up[max(x, y)] = min(x, y)


def _bucket_links(fp, starts, max_bits, refs):
    """Star edges (member, smallest member) of the local components of the
    buckets that begin at ``starts`` in ``fp`` (each sorted, without repeats)."""
    sizes = np.diff(np.r_[starts, len(fp)])
    dist = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)
    forest = _Forest(len(fp))
    end = np.repeat(starts + sizes, sizes)
    small = np.repeat(sizes <= BLOCK, sizes)
    at, lag = np.arange(len(fp)), 1
    while True:
        i = at[small & (at + lag < end)]
        if not len(i):
            break
        keep = _close(fp, dist, i, i + lag, max_bits)
        forest.join(i[keep], i[keep] + lag)
        lag += 1
    for s, n in zip(starts[sizes > BLOCK], sizes[sizes > BLOCK]):
        order = s + np.argsort(dist[s:s + n, 0], kind="stable")  # only near first coordinates meet
        first = dist[order, 0].astype(int)
        for a in range(0, n, BLOCK):
            rows = order[a:a + BLOCK]
            stop = np.searchsorted(first, first[min(a + BLOCK, n) - 1] + max_bits, "right")
            for c in range(a, stop, BLOCK):
                cols = order[c:min(c + BLOCK, stop)]
                i, j = (x.ravel() for x in np.meshgrid(rows, cols, indexing="ij"))
                i, j = i[i != j], j[i != j]
                keep = _close(fp, dist, i, j, max_bits)
                forest.join(i[keep], j[keep])
    root = np.array([forest.find(x) for x in range(len(fp))], np.int64)
    linked = root != at
    return fp[linked], fp[root[linked]]


def _links(max_bits, n_pivots):
    def run(parts):
        refs = pivots(n_pivots)
        held_m, held_fp = np.empty(0, np.uint64), np.empty(0, np.uint64)

        def emit(m, fp):
            key = fp & m
            new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (m[1:] != m[:-1])])
            sizes = np.diff(np.r_[new, len(fp)])
            pick = np.repeat(sizes > 1, sizes)
            if not pick.any():
                return None
            starts = np.r_[0, np.cumsum(sizes[sizes > 1])[:-1]]
            u, v = _bucket_links(fp[pick], starts, max_bits, refs)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for b in parts:
            m, fp = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for c in ("mask", "fp"))
            m, fp = np.r_[held_m, m], np.r_[held_fp, fp]
            if not len(m):
                continue
            again = np.r_[False, (m[1:] == m[:-1]) & (fp[1:] == fp[:-1])]  # of two parents
            m, fp = m[~again], fp[~again]
            key = fp & m
            last = np.flatnonzero((m != m[-1]) | (key != key[-1]))  # the last bucket may go on
            cut = last[-1] + 1 if len(last) else 0
            if cut and (out := emit(m[:cut], fp[:cut])) is not None:
                yield out
            held_m, held_fp = m[cut:], fp[cut:]
        if len(held_m) and (out := emit(held_m, held_fp)) is not None:
            yield out
    return run


def _deal(max_bits):
    """(mask, fp) of hot buckets in their finer buckets."""
    def run(parts):
        for b in parts:
            m = b.column("mask").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            fp = b.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            for agreed in np.unique(m):
                own = fp[m == agreed]
                for mask in block_masks(max_bits, int(agreed)):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), _signed(mask))), pa.array(own & _signed(mask)), pa.array(own)],
                                                     ["mask", "key", "fp"])
    return run


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS, hot: int = HOT) -> DataFrame:
    """``fps``: distinct long column fp.  Edges u, v whose components are those
    of all pairs within ``max_bits`` bits."""
    tables = F.array(*(F.struct(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                       for m in block_masks(max_bits)))
    buckets = fps.select("fp", F.explode(tables).alias("b")).select(F.col("b.mask").alias("mask"), F.col("b.key").alias("key"), "fp")

    def compared(own):
        dealt = own.repartition(partitions(fps.sparkSession), "mask", "key").sortWithinPartitions("mask", "key", "fp")
        return dealt.select("mask", "fp").mapInArrow(_links(max_bits, n_pivots), "u long, v long")

    edges, loosest = None, 0
    while True:
        loosest = min(block_masks(max_bits, loosest), key=int.bit_count)
        large = None
        if 64 - loosest.bit_count() > max(FREE_BITS, max_bits + 2):
            large = parked(buckets.groupBy("mask", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("mask", "key"), "hot-buckets")
        last = large is None or large.isEmpty()
        own = compared(buckets if last else buckets.join(large, ["mask", "key"], "left_anti"))
        edges = own if edges is None else edges.union(own)
        if last:
            return edges
        again = buckets.join(large, ["mask", "key"], "left_semi").select("mask", "fp")
        buckets = parked(again.mapInArrow(_deal(max_bits), "mask long, key long, fp long"), "dealt-again")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS,
                   max_bits: int = MAX_BITS) -> DataFrame:
    """One row per input row: ``id``, ``th`` (xxhash64 of the text), ``fp``
    (long), ``component_id`` (smallest id reachable over links of ``max_bits``
    differing bits or fewer) and ``first``: true for the row of each component
    with the smallest id and hash (and for repeats of that very row).

    A null or empty text has fingerprint zero and links like any other.  Null
    ids come after all others; a component of null ids only has a null
    component_id.  An empty table gives no row; other columns are not read.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("th"), F.col(text_col).cast("binary").alias("text"))
    prints = parked(ids.mapInArrow(_fingerprints(n_words), "id long, th long, fp long")
                    .withColumn("s", salt("id", "th", n=SALTS)), "fingerprints")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("least")
    salted = prints.groupBy("fp", "s").agg(least)
    by_fp = parked(salted.groupBy("fp").agg(F.min("least").alias("least")), "fingerprint-sets")
    comps = parked(components(fingerprint_links(by_fp.select("fp"), max_bits)), "fingerprint-components")
    rooted = by_fp.join(comps.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = rooted.groupBy("root").agg(F.min("least").alias("best"))
    spread = best.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS // 8 - 1))))
    labels = (rooted.select("fp", "root").withColumn("s", salt("fp", n=SALTS // 8)).join(spread, ["root", "s"])
              .select("fp", "best"))
    # a fingerprint may be shared by a third of all rows: labels go to (fp, s), of which each has a share
    per_salt = salted.select("fp", "s").join(labels, "fp")
    return prints.join(per_salt, ["fp", "s"]).select(
        "id", "th", "fp", F.col("best.id").alias("component_id"),
        (F.col("best.id").eqNullSafe(F.col("id")) & (F.col("best.th") == F.col("th"))).alias("first"))


@query("op6_simhash")
def op6_simhash(spark, sf_dir):
    got = simhash_groups(table(spark, sf_dir, "documents"))
    return got.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
