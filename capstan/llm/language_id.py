"""Operator 9, language ID by cross-parsing entropy.

Per language, a bounded sample of labelled text becomes a suffix automaton.  A
document is parsed against each: the longest match is taken again and again,
and the language that needs the fewest phrases, each weighted by the logarithm
of its sample's size (the cost of pointing into it), wins.  Every language is
learned; their automata are built and broadcast in blocks of a few languages,
and a task holds one block at a time.
"""

from __future__ import annotations

import re
from heapq import nsmallest
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from capstan.llm.common import col, packed, schema_of
from capstan.llm.quality import held_out
from capstan.llm.registry import query
from capstan.tables import table

SAMPLE_BYTES, SAMPLE_DOCS = 40_000, 128
BLOCK_LANGUAGES = 4  # whose automata are in memory at a time
PIECE = 256  # bytes of a sampled text drawn at a time
SEGMENT = 2048  # bytes parsed in one lane
PASSES = 3  # of the segments whose start another one moved
LANES = 1 << 14
WORDY = re.compile(r"[^\W\d_]")  # letters, and signs such as U+00BD that are none
#: ASCII that is no letter parts words.
PLAIN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in WORDY.finditer(text))


def normal(text: str) -> bytes:
    """Lower-cased letters, other ASCII as single spaces."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(PLAIN).split())


def automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``data``; state 0 is the root."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in data:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return step


class Model:
    """The automata of a block of languages in one table: entry = 2 * next row offset + (phrase ends)."""

    def __init__(self, samples: dict[str, bytes]):
        self.langs = sorted(samples)
        used = sorted(set(b"".join(samples.values())))
        self.width = len(used) + 1  # class 0: bytes that no sample holds
        classes = np.zeros(256, np.uint8)
        classes[used] = np.arange(1, len(used) + 1)
        self.classes = classes.tobytes()
        self.cost = np.array([np.log2(max(2, len(samples[k]))) for k in self.langs])
        tables, self.roots, base = [], [], 0
        for k in self.langs:
            steps = automaton(samples[k])
            own = np.zeros((len(steps), self.width), np.int64)
            restart = np.zeros(self.width, np.int64)
            for c, to in steps[0].items():
                restart[classes[c]] = to
            own[:] = 2 * (base + restart) * self.width + 1
            for s, row in enumerate(steps):
                for c, to in row.items():
                    own[s, classes[c]] = 2 * (base + to) * self.width
            tables.append(own)
            self.roots.append(base * self.width)
            base += len(steps)
        self.table = np.concatenate(tables).ravel().astype(np.int32 if base * self.width < 1 << 30 else np.int64) if tables else None

    def _run(self, parts: list[bytes], state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Parses ``parts``, each from its column of ``state`` (langs, n):
        phrases ended and the states reached."""
        ended, reached = np.zeros(state.shape, np.int64), state.copy()
        order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
        for a in range(0, len(order), LANES):
            lane = order[a:a + LANES]
            size = np.array([len(parts[i]) for i in lane])
            grid = np.frombuffer(b"".join(parts[i].ljust(size[0], b"\0") for i in lane), np.uint8).reshape(len(lane), size[0]).T
            now, n = state[:, lane], np.zeros((len(self.langs), len(lane)), np.int64)
            active = np.searchsorted(-size, -np.arange(size[0]), "left")
            for t in range(size[0]):
                m = active[t]
                v = self.table[now[:, :m] + grid[t, :m]]
                n[:, :m] += v & 1
                now[:, :m] = v >> 1
            ended[:, lane], reached[:, lane] = n, now
        return ended, reached

    def _run_on(self, parts: list[bytes], state: np.ndarray) -> np.ndarray:
        """Phrases ended in each of the successive ``parts``, from ``state``."""
        out, table = np.zeros((len(self.langs), len(parts)), np.int64), memoryview(self.table)
        for k in range(len(self.langs)):
            s = int(state[k])
            for i, part in enumerate(parts):
                n = 0
                for c in part:
                    v = table[s + c]
                    n += v & 1
                    s = v >> 1
                out[k, i] = n
        return out

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each (normalised) text by language: shape (langs, n).

        The segments of a text are parsed side by side, at first from the
        root; those whose left neighbour ended in another state are parsed
        again from there, as parses soon fall into step.  What still differs
        after ``PASSES`` is parsed on to the text's end in one go."""
        owner, parts = [], []
        for i, t in enumerate(texts):
            coded = t.translate(self.classes)
            for a in range(0, len(coded), SEGMENT):
                owner.append(i)
                parts.append(coded[a:a + SEGMENT])
        owner = np.array(owner, np.int64)
        first = np.r_[True, owner[1:] != owner[:-1]][:len(owner)]
        start = np.repeat(np.array(self.roots, np.int64)[:, None], len(parts), axis=1)
        ended, reached, todo = np.zeros(start.shape, np.int64), start.copy(), np.arange(len(parts))
        for _ in range(PASSES):
            ended[:, todo], reached[:, todo] = self._run([parts[i] for i in todo], start[:, todo])
            due = np.where(first, start, np.roll(reached, 1, axis=1))
            todo = np.flatnonzero((due != start).any(axis=0))
            start[:, todo] = due[:, todo]
            if not len(todo):
                break
        for i in np.unique(owner[todo]):
            a, b = todo[np.searchsorted(owner[todo], i)], np.searchsorted(owner, i, "right")
            ended[:, a:b] = self._run_on(parts[a:b], start[:, a])
        out = np.zeros((len(self.langs), len(texts)))
        for k in range(len(self.langs)):
            out[k] = np.bincount(owner, ended[k] + first, len(texts))
        return out

    def entropy(self, texts: list[bytes]) -> np.ndarray:
        return self.phrases(texts) * self.cost[:, None]


class Languages:
    """Samples of all languages; ``models`` builds their automata by blocks."""

    def __init__(self, samples: dict[str, bytes], block: int = BLOCK_LANGUAGES):
        self.samples, self.langs, self.block = samples, sorted(samples), block

    def models(self):
        for a in range(0, len(self.langs), self.block):
            yield Model({k: self.samples[k] for k in self.langs[a:a + self.block]})

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        return predict(self.models(), texts)


def predict(models, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and confidence by the models of all blocks, names ascending:
    the runner-up's share of the two smallest entropies (0.5: a tie, which goes
    to the first name); 'und' is 0."""
    have = [i for i, t in enumerate(texts) if t and has_letter(t)]
    lang, score = ["und"] * len(texts), [0.0] * len(texts)
    if not have:
        return lang, score
    data, names = [normal(texts[i]) for i in have], []
    two, best = np.full((2, len(have)), np.inf), np.zeros(len(have), np.int64)
    for model in models:
        both = np.vstack([two, model.entropy(data)])
        order = np.argsort(both, axis=0, kind="stable")[:2]
        two, best = np.take_along_axis(both, order, 0), np.where(order[0] < 2, best, len(names) + order[0] - 2)
        names += model.langs
        del model  # before the next block comes
    if names:
        sure = two[1] / two.sum(axis=0) if len(names) > 1 else np.ones(len(have))
        for i, k, s in zip(have, best, sure):
            lang[i], score[i] = names[k], float(s)
    return lang, score


def pieces(text: bytes, limit: int) -> list[tuple[int, bytes]]:
    """Pieces (number, bytes) of a text in the order of a hash, so that the
    first of them are spread over the whole text: ``limit`` bytes or all."""
    seed, n = xxhash.xxh64_intdigest(text), -(-len(text) // PIECE)
    first = nsmallest(-(-limit // PIECE) + 1, range(n), key=lambda i: (xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed), i))
    return [(i, text[i * PIECE:(i + 1) * PIECE]) for i in first]


def _pieces(limit):
    def run(parts):
        for b in parts:
            texts = [normal(t) for t in b.column("text").to_pylist()]
            own = [[{"i": i, "part": p} for i, p in pieces(t, limit)] for t in texts]
            kind = pa.list_(pa.struct([("i", pa.int32()), ("part", pa.binary())]))
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("draw"), b.column("id"), pa.array(map(len, texts), pa.int64()), pa.array(own, kind)],
                                             ["lang", "draw", "id", "size", "pieces"])
    return run


def shared_out(texts: list[tuple[int, list[tuple[int, bytes]]]], sample_bytes: int) -> bytes:
    """One sample of (size, pieces) of each text: short ones whole, the others
    with equal shares of what is left of ``sample_bytes``."""
    left, share = sample_bytes - len(texts) + 1, 0  # a space parts texts
    for k, size in enumerate(sorted(size for size, _ in texts)):
        share = max(1, left // (len(texts) - k))
        if size > share:
            break
        left -= size
    out = []
    for size, own in texts:
        chosen, last, room = [] if size > share else own, None, share + 1
        for i, part in own if size > share else ():  # a space parts pieces too
            if room > 1:
                chosen.append((i, part[:room - 1]))
                room -= len(part) + 1
        for i, part in sorted(chosen):
            out.append(part if last == i - 1 else b" " + part)
            last = i
    return b"".join(out)[1:sample_bytes + 1].decode("utf-8", "ignore").encode()  # without cut characters


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_bytes: int = SAMPLE_BYTES,
        sample_docs: int = SAMPLE_DOCS, block_languages: int = BLOCK_LANGUAGES) -> Languages:
    """Fit on texts of every language, ``sample_docs`` of them in the order of
    a hash of their ids, or all.  They share ``sample_bytes``: short texts count
    whole, longer ones with equal shares in pieces spread over the whole text.
    Ids of ``held_out`` are never used."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    # of n rows a share is drawn by hash, so that no task gets all rows of a language
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    some = rows.join(F.broadcast(sizes), "lang").withColumn("draw", draw).where(F.col("draw") * F.col("n") <= 2 * sample_docs)
    cut = some.select("lang", "draw", "id", "text").mapInArrow(
        _pieces(sample_bytes), "lang string, draw double, id long, size long, pieces array<struct<i:int,part:binary>>")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "id", "size", "pieces"))
    drawn = cut.where("size > 0").withColumn("rank", rank).where(F.col("rank") <= sample_docs).orderBy("lang", "rank").toLocalIterator()
    samples = {}
    for lang, own in groupby(drawn, key=lambda r: r["lang"]):
        samples[lang] = shared_out([(r["size"], [(p["i"], bytes(p["part"])) for p in r["pieces"]]) for r in own], sample_bytes)
    return Languages({k: v for k, v in samples.items() if v}, block_languages)


def _predict(shared):
    def models():
        for block in shared:
            yield block.value
            if len(shared) > 1:  # the worker would keep every block
                vars(block).pop("_value", None)

    def run(parts):
        for b in parts:
            lang, score = predict(models(), b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["row", "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: Languages, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per input row: ``row`` (struct of the columns ``keep``, by
    default all), ``lang_pred`` and ``score``, from the whole text alone.  A
    text that is null or has no letter is 'und'; equal texts are predicted
    alike; an empty table gives no row, and without a model all is 'und'."""
    base = docs.select(packed(docs.select(*map(col, keep))) if keep else packed(docs), col(text_col).cast("string").alias("text"))
    shared = [docs.sparkSession.sparkContext.broadcast(m) for m in model.models()]
    return base.mapInArrow(_predict(shared), schema_of(base, "lang_pred string, score double"))


@query("op9_language")
def op9_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    got = identify(docs, fit(docs), keep=["doc_id"])
    return got.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")
