"""Operator 10, best-fit packing with linear grouping.

Lengths are integers up to the capacity, so the whole problem is a histogram
of at most ``capacity`` rows, whatever the number of documents.  On it: large
lengths are grouped into groups of equal cardinality and rounded up to the
group's largest; configurations over these few sizes are optimised (linear
program with generated columns); actual documents take the configurations'
places; everything else goes, longest first, to the tightest gap that fits.
Runs of equal lengths are handled as one, so the plan is a short list of
ranges (length, rank) -> (sequence, offset), which every document looks up.
"""

from __future__ import annotations

import base64
import zlib
from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capstan.llm.common import parked, partitions, salt
from capstan.llm.registry import query
from capstan.tables import table

CAPACITY, VOCABULARY, END = 2048, "byte_bpe_50k", 0
GROUPS, ROUNDS = 96, 600  # groups; pivots of the program
SHARES = (2, 3, 4)  # lengths over capacity / share are large; the share that needs fewest sequences is taken
SPECIAL = "<|endoftext|>"  # the vocabulary's one special token

_ENCODERS: dict = {}


def encoder(vocabulary: str = VOCABULARY):
    """text -> ids (uint32 array), as the tokenizers library gives them with
    add_special_tokens=False; ordinary text goes through the same vocabulary's
    ranks, which is faster, text with the special token's name through the
    library itself."""
    if vocabulary not in _ENCODERS:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        slow = []

        def encode(text: str) -> np.ndarray:
            if SPECIAL not in text:
                return np.array(fast.encode_ordinary(text), np.uint32)
            if not slow:
                from tokenizers import Tokenizer

                slow.append(Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json")))
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, np.uint32)

        _ENCODERS[vocabulary] = encode
    return _ENCODERS[vocabulary]


def cuts(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: the first may be short."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _pieces(vocabulary, capacity):
    def run(parts):
        encode = encoder(vocabulary)
        for b in parts:
            ids, piece, start, length, crc = [], [], [], [], []
            for doc_id, text in zip(b.column("id").to_pylist(), b.column("text").to_pylist()):
                tokens = np.append(encode(text), np.uint32(END)).astype("<u4")
                for k, (s, n) in enumerate(cuts(len(tokens), capacity)):
                    ids.append(doc_id)
                    piece.append(k)
                    start.append(s)
                    length.append(n)
                    crc.append(zlib.crc32(tokens[s:s + n].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                              pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["id", "piece", "start", "length", "ids_crc32"])
    return run


def grouped(sizes: list[tuple[int, int]], groups: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Linear grouping of (length, count), longest first: groups of about equal
    cardinality, each with its rounded length and its runs (length, first
    rank, count).  A length may be split between groups."""
    total = sum(n for _, n in sizes)
    each = -(-total // groups)
    out, room = [], 0
    for length, n in sizes:
        rank = 0
        while n:
            if not room:
                out.append((length, []))
                room = each
            take = min(n, room)
            out[-1][1].append((length, rank, take))
            rank, n, room = rank + take, n - take, room - take
    return out


def configurations(sizes: list[int], demand: list[int], capacity: int, rounds: int = ROUNDS) -> list[tuple[int, np.ndarray]]:
    """How many bins of each configuration (items by size): the cutting-stock
    program with columns generated by a knapsack over its dual prices, rounded
    down.  ``rounds`` bounds the pivots; any basis on the way is a valid plan."""
    k = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    need = np.array(demand, float)
    left = np.arange(capacity + 1)[None, :] - np.array(sizes)[:, None]
    fits, left = left >= 0, np.maximum(left, 0)
    for _ in range(rounds):
        inverse = np.linalg.inv(basis)
        price = inverse.sum(axis=0)
        value, picks = np.zeros(capacity + 1), []
        for _ in range(capacity // min(sizes)):  # one more item each time
            got = np.where(fits, price[:, None] + value[left], 0.0)
            pick = got.argmax(axis=0)
            more = np.take_along_axis(got, pick[None], 0)[0]
            picks.append(np.where(more > value + 1e-12, pick, -1))
            if (picks[-1] < 0).all():
                break
            value = np.maximum(more, value)
        if value[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        for pick in reversed(picks):
            if pick[c] >= 0:
                column[pick[c]] += 1
                c -= sizes[pick[c]]
        level, direction = inverse @ need, inverse @ column
        ratio = np.where(direction > 1e-9, np.maximum(level, 0) / np.where(direction > 1e-9, direction, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    level = np.floor(np.maximum(np.linalg.solve(basis, need), 0) + 1e-6).astype(np.int64)
    return [(int(n), basis[:, j].astype(int)) for j, n in enumerate(level) if n > 0]


class Plan:
    """Ranges of a packing: documents of a length with ranks from ``first`` on
    go, ``per`` to a sequence, to sequences from ``sequence`` on at ``offset``."""

    def __init__(self, histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, share: int = 3):
        self.capacity, self.sequences = capacity, 0
        self.ranges: list[tuple[int, int, int, int, int]] = []  # length, first, sequence, per, offset
        self.gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (sequence, bins)
        sizes = sorted(((s, n) for s, n in histogram.items() if n > 0), reverse=True)
        assert not sizes or (sizes[0][0] <= capacity and sizes[-1][0] > 0)
        rest = self._large([x for x in sizes if capacity // share < x[0] < capacity], groups)
        rest += [(s, 0, n) for s, n in sizes if not capacity // share < s < capacity]
        for length, first, n in sorted(rest, key=lambda r: (-r[0], r[1])):
            self._best_fit(length, first, n)
        self.ranges.sort()

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _large(self, sizes, groups) -> list[tuple[int, int, int]]:
        """Fill configurations with actual documents; returns what is left."""
        if not sizes:
            return []
        made = grouped(sizes, groups)
        merged: dict[int, list] = {}  # groups that round to the same length
        for length, runs in made:
            merged.setdefault(length, []).extend(runs)
        lengths = sorted(merged, reverse=True)
        queues = [merged[s][::-1] for s in lengths]  # longest at the end
        for n, items in configurations(lengths, [sum(r[2] for r in merged[s]) for s in lengths], self.capacity):
            bins = [(self._open(n), n, 0)]  # sequence, bins, used
            for g, copies in enumerate(items):
                for _ in range(copies):
                    bins = self._place(bins, queues[g])
            for sequence, m, used in bins:
                self.gaps.setdefault(self.capacity - used, []).append((sequence, m))
        return [r for q in queues for r in q]

    def _place(self, bins, queue):
        """One document of the group into each bin, as long as there are any."""
        out = []
        for sequence, m, used in bins:
            while m and queue:
                length, first, n = queue.pop()
                take = min(m, n)
                self.ranges.append((length, first, sequence, 1, used))
                out.append((sequence, take, used + length))
                if n > take:
                    queue.append((length, first + take, n - take))
                sequence, m = sequence + take, m - take
            if m:
                out.append((sequence, m, used))
        return out

    def _put(self, gap, sequence, m):
        if m:
            insort(self.gaps.setdefault(gap, []), (sequence, m))

    def _best_fit(self, length, first, n):
        """``n`` documents of one length: the tightest gaps first, each filled
        with as many as fit; then new sequences."""
        for gap in range(length, self.capacity + 1):
            runs, per = self.gaps.get(gap), gap // length
            while runs and n:
                sequence, m = runs.pop()
                whole = min(m, n // per)
                if whole:
                    self.ranges.append((length, first, sequence, per, self.capacity - gap))
                    self._put(gap - per * length, sequence, whole)
                    first, n = first + whole * per, n - whole * per
                    sequence, m = sequence + whole, m - whole
                if m and n:  # fewer than ``per`` are left
                    self.ranges.append((length, first, sequence, per, self.capacity - gap))
                    self._put(gap - n * length, sequence, 1)
                    first, n, sequence, m = first + n, 0, sequence + 1, m - 1
                self._put(gap, sequence, m)
            if not n:
                return
        per = self.capacity // length
        bins = -(-n // per)
        sequence = self._open(bins)
        self.ranges.append((length, first, sequence, per, 0))
        self._put(self.capacity - per * length, sequence, n // per)
        if n % per:
            self._put(self.capacity - n % per * length, sequence + bins - 1, 1)

    def arrays(self) -> np.ndarray:
        return np.array(self.ranges, np.int64).reshape(-1, 5).T


def _assigned(shared):
    def run(parts):
        length, first, sequence, per, offset = shared.value
        for b in parts:
            n, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            lo, hi = np.searchsorted(length, n, "left"), np.searchsorted(length, n, "right")
            while (wide := hi - lo > 1).any():  # last range of the length that begins at the rank or before
                mid = (lo + hi) // 2
                right = wide & (first[np.minimum(mid, len(first) - 1)] <= rank)
                lo, hi = np.where(right, mid, lo), np.where(wide & ~right, mid, hi)
            k = rank - first[lo]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")), pa.array(sequence[lo] + k // per[lo]),
                 pa.array(offset[lo] + k % per[lo] * n)], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return run


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """The plan with the fewest sequences over ``SHARES``."""
    return min((Plan(histogram, capacity, groups, share) for share in SHARES), key=lambda p: p.sequences)


PIECES = "id long, piece int, start long, length long, ids_crc32 long"


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY,
         groups: int = GROUPS) -> DataFrame:
    """One row per piece: ``id``, ``piece``, ``start``, ``length``,
    ``ids_crc32``, ``sequence_id``, ``offset``.

    A document is its ids and one end id; only longer ones than ``capacity``
    are cut, the first piece being the short one.  A null or empty text is the
    end id alone.  Repeated rows are packed each; ids may be null.  An empty
    table gives no row; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    chunks = 4 * partitions(spark)  # a length may be a third of all pieces: it is ranked by chunk
    pieces = parked(rows.mapInArrow(_pieces(vocabulary, capacity), PIECES).withColumn("chunk", salt("id", "piece", "ids_crc32", n=chunks)), "pieces")
    counts = parked(pieces.groupBy("length", "chunk").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    ranges = spark.sparkContext.broadcast(plan(histogram, capacity, groups).arrays())
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("id", "piece", "ids_crc32", "start"))
    ranked = pieces.join(offsets, ["length", "chunk"]).withColumn("rank", F.col("before") + inside - 1)
    return ranked.select("id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(_assigned(ranges), PIECES + ", sequence_id long, offset long")


@query("op10_packing")
def op10_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
