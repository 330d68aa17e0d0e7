"""Operator 4, line dedup: levelled sorted runs of line hashes.

Documents arrive in batches.  Each batch's line keys are counted (one per
document and key), merge-anti-joined with the keys already settled as common,
and added as a new sorted run; every ``fanout`` runs of a level are compacted
into one run of the next level, and a key whose count there reaches the
threshold is settled.  DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capstan.llm.common import SPACE, ascii_lower, parked, salt
from capstan.llm.registry import query
from capstan.tables import table

MIN_DOCS, BATCHES, FANOUT, SALTS = 10, 4, 2, 16


def line_keys(text: Column, min_chars: int) -> Column:
    """128-bit key of each line of ``text``; null for keys below ``min_chars``."""
    def key(line):
        k = F.btrim(line, F.lit(SPACE))
        return F.when(F.length(k) >= min_chars, F.substring(F.unhex(F.sha2(k, 256)), 1, 16))
    return F.transform(F.split(ascii_lower(text), "\n", -1), key)


class LineRuns:
    """Counts of documents by line key, kept in levelled sorted runs."""

    def __init__(self, min_docs: int, fanout: int = FANOUT):
        self.min_docs, self.fanout = min_docs, fanout
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def _store(self, counts: DataFrame, level: int) -> None:
        run = parked(counts.sortWithinPartitions("key"), f"lines-l{level}")
        self.settled.append(run.where(F.col("n") >= self.min_docs).select("key"))
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run.where(F.col("n") < self.min_docs))
        if len(self.levels[level]) == self.fanout:
            runs, self.levels[level] = self.levels[level], []
            self._store(self._merged(runs), level + 1)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.union, runs).groupBy("key").agg(F.sum("n").alias("n"))

    def common(self) -> DataFrame | None:
        """Settled keys so far (a key may be settled in several runs)."""
        return reduce(DataFrame.union, self.settled).distinct() if self.settled else None

    def add(self, lines: DataFrame) -> None:
        """``lines``: key, id of a batch whose documents no other batch has."""
        counts = lines.groupBy("key", "id").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("*").alias("n"))
        known = self.common()
        self._store(counts if known is None else counts.join(known, "key", "left_anti"), 0)

    def finish(self) -> DataFrame:
        """All keys found in ``min_docs`` documents or more."""
        rest = [r for level in self.levels for r in level]
        found = self.settled + ([self._merged(rest).where(F.col("n") >= self.min_docs).select("key")] if rest else [])
        return reduce(DataFrame.union, found).distinct()


def drop_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                      min_chars: int = 1, batches: int = BATCHES) -> DataFrame:
    """``docs`` as column ``row`` (a struct of all its columns), with ``text``
    (lines left, joined by newline), ``n_lines`` and ``n_dropped``.

    A line's key is the line without white space at both ends, A-Z
    lower-cased; keys of ``min_chars`` code points or more that are found in
    ``min_docs`` documents (distinct ids; null is one id) lose all their
    lines.  A null or empty text is one empty line.  Repeated rows are treated
    alike and all returned; an empty table gives no row.
    """
    base = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("th", F.xxhash64("text"))
    lines = parked(base.select("id", "th", F.posexplode(line_keys(F.col("text"), min_chars)).alias("pos", "key"))
                   .where("key is not null").withColumn("batch", salt("id", n=batches)), "lines", ("batch",))
    runs = LineRuns(min_docs)
    for b in range(batches):
        runs.add(lines.where(F.col("batch") == b).select("key", "id"))
    common = parked(runs.finish(), "lines-common")
    # a common key may sit in a third of all documents: its lines are spread over SALTS keys
    spread = common.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    drops = (lines.withColumn("s", salt("id", "th", n=SALTS)).join(spread, ["key", "s"])
             .groupBy("id", "th").agg(F.collect_set("pos").alias("drops")))
    joined = base.alias("b").join(drops.alias("d"), F.col("b.id").eqNullSafe(F.col("d.id")) & (F.col("b.th") == F.col("d.th")), "left")
    split = joined.select("row", F.split("text", "\n", -1).alias("lines"), "drops")
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("drops"))
    text = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    return split.select(
        "row", F.when(F.col("drops").isNull(), F.array_join("lines", "\n")).otherwise(text).alias("text"),
        F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped"))


@query("op4_line_dedup", r"""
WITH l AS (SELECT doc_id, generate_subscripts(a, 1) AS pos, unnest(a) AS line
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, c.key IS NOT NULL AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""")
def op4_line_dedup(spark, sf_dir):
    got = drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return got.select("row.doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
