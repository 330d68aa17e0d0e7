"""Operator 2, exact dedup: tree merge of sorted digest runs.

Every row belongs to one of ``BASE ** ROUNDS`` runs (a hash of its id).  A run
holds one entry per digest: row count and the row that stays.  In round j a
run's entries go to the run whose j-th digit is the j-th digit of the digest's
home, so after the last round every digest is merged in its home run.  Each
merge takes at most BASE entries of a digest, however many copies there are,
and the label walks back down the same tree: no join ever meets more than BASE
entries (or, at the leaves, one run's share of the copies) per key.

Entries merge only if SHA-256, byte length and an independent 64-bit hash of
the normalised text all agree.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import byte_rows, parked, salt
from capstan.llm.registry import query
from capstan.tables import table

BASE, ROUNDS = 8, 2
TEXT = ["digest", "n_bytes", "check"]


def _digests(parts):
    for b in parts:
        texts = [t.lower() for t in byte_rows(b.column("text"))]  # bytes.lower: A-Z only
        yield pa.RecordBatch.from_arrays([
            b.column("row"), b.column("id"),
            pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([xxhash.xxh3_64_intdigest(t) - (1 << 63) for t in texts], pa.int64()),
        ], ["row", "id", *TEXT])


def _merge(entries: DataFrame, run, keep: str) -> DataFrame:
    """One round: the entries of a digest that meet in a run become one."""
    best = F.max("stays") if keep == "max" else F.min("stays")
    return (entries.withColumn("run", run).groupBy("run", *TEXT)
            .agg(F.sum("n").alias("n"), best.alias("stays")).sortWithinPartitions("run", *TEXT))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min") -> DataFrame:
    """One row per input row: ``id``, ``keep_id``, ``group_size``, ``kept``,
    ``digest`` (SHA-256 of the text with A-Z lower-cased; null is empty).

    The row with the smallest (``keep='max'``: largest) id of equal texts
    stays; exactly one row of a group does, also where ids repeat.  A null id
    stays only if all ids of its group are null.  An empty table gives no row;
    other columns of ``docs``, whatever their names, are not read.
    """
    spark = docs.sparkSession
    ids = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
                      F.col(text_col).cast("binary").alias("text"))
    keys = parked(ids.mapInArrow(_digests, "row long, id long, digest binary, n_bytes long, check long")
                  .withColumn("run", salt("row", n=BASE ** ROUNDS)), "digests")
    known = F.col("id").isNotNull() if keep == "max" else F.col("id").isNull()
    leaf = keys.select("run", *TEXT, F.lit(1).cast("long").alias("n"), F.struct(known.alias("known"), "id", "row").alias("stays"))
    home = salt(F.col("digest"), n=BASE ** ROUNDS)
    levels, ups = [parked(_merge(leaf, F.col("run"), keep), "digest-run")], []
    for j in range(ROUNDS):
        unit = BASE ** j
        digit = lambda c, u=unit: F.floor(c / u).cast("int") % BASE
        up = (F.col("run") + (digit(home) - digit(F.col("run"))) * unit).cast("int")
        ups.append(up)
        levels.append(parked(_merge(levels[-1], up, keep), "digest-run"))
    labels = levels[-1].select("run", *TEXT, F.col("n").alias("size"), "stays")
    for level, up in zip(reversed(levels[:-1]), reversed(ups)):
        labels = (level.select("run", *TEXT).withColumn("up", up)
                  .join(labels.withColumnRenamed("run", "up"), ["up", *TEXT]).drop("up"))
    return keys.join(labels, ["run", *TEXT]).select(
        "id", F.col("stays.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("stays.row") == F.col("row")).alias("kept"), "digest")


@query("op2_exact_dedup", """
WITH t AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
           FROM documents),
g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, t.h AS text_sha256 FROM t JOIN g ON t.h = g.h
""")
def op2_exact_dedup(spark, sf_dir):
    got = exact_groups(table(spark, sf_dir, "documents"), keep="max")
    return got.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))
