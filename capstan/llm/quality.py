"""Operator 8, quality classifier: nearest-neighbour voting.

A bounded, stratified sample of labelled documents is mapped to a latent
semantic space (hashed byte trigrams, log counts, inverse document frequency,
and terms for length, repetition, capitals and symbols; truncated SVD).  Its vectors, of a size fixed by the parameters, go to every
task; each document's exact cosine to all of them is computed in blocks, and
the nearest ones vote with their similarity as weight.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import byte_rows, col, packed, schema_of
from capstan.llm.registry import query
from capstan.tables import table

BITS, DIMS, PER_LABEL, NEIGHBOURS, CUT = 11, 64, 1024, 15, 0.7
STYLE, BINS = 5, 16
BLOCK = 512  # documents of one block of products


UPPER_BYTE = np.zeros(256, bool)
UPPER_BYTE[65:91] = True
LETTER_BYTE = np.array([c >= 128 or chr(c).isalpha() or c == 32 for c in range(256)])


def counts(text: bytes) -> np.ndarray:
    """Terms of one whole text: hashed byte-trigram counts, then ``STYLE``
    measures from 0 to 1, each spread over the two nearest of ``BINS`` terms."""
    out = np.zeros((1 << BITS) + STYLE * BINS, np.float32)
    if not text:
        return out
    raw = np.frombuffer(b" " + text + b" ", np.uint8)
    b = raw.astype(np.uint32)
    h = ((b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    tri = np.bincount(h, minlength=1 << BITS)
    out[:1 << BITS] = tri
    n, seen = len(h), np.bincount(raw, minlength=256)
    style = np.array([min(1, np.log2(n) / 20), np.count_nonzero(tri) / min(n, 1 << BITS), np.partition(tri, -16)[-16:].sum() / n,
                      seen[UPPER_BYTE].sum() / len(raw), seen[LETTER_BYTE].sum() / len(raw)])
    at = style * (BINS - 1)
    low = np.minimum(at.astype(int), BINS - 2)
    rows = (1 << BITS) + BINS * np.arange(STYLE)
    out[rows + low] = 1 - (at - low)
    out[rows + low + 1] = at - low
    return out


def _unit(x):
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _axes(x: np.ndarray, dims: int, rounds: int = 12) -> np.ndarray:
    """The leading right singular vectors of ``x``, by subspace iteration: a
    few columns at a time, so that the driver never holds a terms-by-terms
    matrix.  The start is fixed, so a fit can be repeated."""
    q = np.random.default_rng(0).standard_normal((x.shape[1], min(dims + 16, *x.shape))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, v = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray((q @ v.T)[:, :dims])


class Model:
    """Latent vectors of the labelled sample and how to map others there."""

    def __init__(self, features: np.ndarray, labels: np.ndarray, prior: float, dims: int = DIMS, neighbours: int = NEIGHBOURS):
        self.labels, self.prior, self.neighbours = labels.astype(np.float32), prior, neighbours
        if not len(labels):
            return
        df = (features > 0).sum(axis=0)
        self.idf = (np.log((1 + len(labels)) / (1 + df)) + 1).astype(np.float32)
        x = self.weighted(features)
        self.axes = _axes(x, dims)
        self.vectors = _unit(x @ self.axes)

    def weighted(self, features: np.ndarray) -> np.ndarray:
        """Unit vectors, half of their square from trigrams, half from style."""
        x = np.log1p(features) * self.idf
        return _unit(np.hstack([_unit(x[:, :1 << BITS]), _unit(x[:, 1 << BITS:])]))

    def score(self, features: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(features), self.prior)
        cosine = _unit(self.weighted(features) @ self.axes) @ self.vectors.T
        k = min(self.neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0).astype(np.float64)
        total = weight.sum(axis=1)
        vote = (weight * self.labels[near]).sum(axis=1)
        return np.clip(np.divide(vote, total, out=np.full(len(total), self.prior), where=total > 0), 0, 1)


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id as text leaves 2 by 4; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _features(parts):
    for b in parts:
        x = [counts(t) for t in byte_rows(b.column("text"))]
        yield pa.RecordBatch.from_arrays([b.column("label"), pa.array([v.tobytes() for v in x], pa.binary())], ["label", "features"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        per_label: int = PER_LABEL) -> Model:
    """Fit on at most ``per_label`` documents of each label, those with the
    smallest hashes of their ids (``held_out`` ids are never used).  Rows with
    a null id or label are left out; of repeated ids the largest label and
    one text count.  Without any labelled document the model scores 0.5."""
    known = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
             .groupBy("id").agg(F.max("label").alias("label")))
    present = docs.select(F.col(id_col).cast("long").alias("id")).where("id is not null")
    known = known.join(present, "id", "left_semi")
    totals = known.agg(F.count("*"), F.avg("label")).first()
    pick = [known.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(per_label) for v in (0, 1)]
    sample = F.broadcast(pick[0].union(pick[1]))  # 2 * per_label rows of two numbers at most
    texts = (docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(sample, "id")
             .groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")))
    rows = texts.select("label", F.col("text").cast("binary").alias("text"), "id").mapInArrow(_features, "label int, features binary").collect()
    x = np.frombuffer(b"".join(r["features"] for r in rows), np.float32).reshape(-1, (1 << BITS) + STYLE * BINS)
    y = np.array([r["label"] for r in rows], np.float32)
    del rows
    order = np.lexsort((x.sum(axis=1), y))
    return Model(x[order], y[order], float(totals[1]) if totals[0] else 0.5)


def _scores(shared):
    def run(parts):
        model = shared.value
        for b in parts:
            texts = byte_rows(b.column("text"))
            score = [model.score(np.array([counts(t) for t in texts[a:a + BLOCK]])) for a in range(0, len(texts), BLOCK)]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(np.concatenate(score) if score else [], pa.float64())], ["row", "score"])
    return run


def score_quality(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per input row: ``row`` (struct of the columns ``keep``, by
    default all) and ``score``, 0 to 1.  Only the text is scored, whole; a null
    or empty text has no neighbour and gets the share of label 1 among the
    labelled documents.  Equal texts score alike; an empty table gives no row."""
    base = docs.select(packed(docs.select(*map(col, keep))) if keep else packed(docs), col(text_col).cast("binary").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return base.mapInArrow(_scores(shared), schema_of(base, "score double"))


@query("op8_quality")
def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    got = score_quality(docs, fit(docs, table(spark, sf_dir, "labels")), keep=["doc_id"])
    return got.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
