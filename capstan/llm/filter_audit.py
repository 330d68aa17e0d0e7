"""Operator 13, filter interaction audit: forward-backward path counting.

A set of filters that were already applied is a state of the subset lattice;
applying one more filter is an edge from a state to the next.  An order of all
filters is a path from the empty state to the full one.  ``forward`` counts the
paths that reach a state, ``backward`` those that leave it, so an edge lies on
``forward[state] * backward[next]`` orders.  What an edge removes is counted
once per part; the sum of an edge's removals times its number of orders is the
Shapley total of its filter, and every step of every order reads its figures
from the edge it walks.

Rows become one count per (part, set of failed filters) before anything meets
the lattice: the lattice work grows with the parts, not with the rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from capstan.llm.common import SPACE, UPPER, col, parked, partitions
from capstan.llm.registry import query
from capstan.tables import table

#: Marks counted among an edge's removals: result column, label column.
MARKS = {"good": "quality", "toxic": "toxic"}


def paths(n: int) -> tuple[list[int], list[int]]:
    """Orders that reach, and that leave, every state (bit mask) of ``n`` filters."""
    forward, backward = [0] * (1 << n), [0] * (1 << n)
    forward[0] = backward[-1] = 1
    for state in range(1, 1 << n):
        forward[state] = sum(forward[state ^ 1 << f] for f in range(n) if state >> f & 1)
    for state in range((1 << n) - 2, -1, -1):
        backward[state] = sum(backward[state | 1 << f] for f in range(n) if not state >> f & 1)
    return forward, backward


def _edges(n: int) -> list[tuple[int, int, int]]:
    """(state, bit of the filter applied next, orders through the edge)."""
    forward, backward = paths(n)
    return [(s, 1 << f, forward[s] * backward[s | 1 << f]) for s in range(1 << n) for f in range(n) if not s >> f & 1]


def _walks(names: str) -> list[tuple[str, int, int, int]]:
    """(order, step, state, bit) of every step of every order."""
    bit = {c: 1 << i for i, c in enumerate(names)}
    return [(order, k + 1, sum(bit[c] for c in order[:k]), bit[order[k]])
            for order in map("".join, permutations(names)) for k in range(len(order))]


def edge_removals(counts: DataFrame, n: int, marks: tuple[str, ...] = tuple(MARKS)) -> DataFrame:
    """Per part and edge of the lattice: ``kept``, ``removed``, ``redundant``,
    ``unique_fails``, a count of removals per mark, and ``weight``, the number of
    orders through the edge.  ``counts``: part, mask (bits of the failed
    filters), rows and a count per mark."""
    edges = F.array(*(F.struct(F.lit(s).alias("state"), F.lit(b).alias("bit"), F.lit(w).cast("long").alias("weight"))
                      for s, b, w in _edges(n)))
    met = counts.select("*", F.explode(edges).alias("e")).select("*", "e.*")
    alive, fails = F.col("mask").bitwiseAND(F.col("state")) == 0, F.col("mask").bitwiseAND(F.col("bit")) != 0

    def total(cond: Column, what: str = "rows") -> Column:
        return F.sum(F.when(cond, F.col(what)).otherwise(0))

    return met.groupBy("part", "state", "bit", "weight").agg(
        total(alive & ~fails).alias("kept"), total(alive & fails).alias("removed"), total(~alive & fails).alias("redundant"),
        total(F.col("mask") == F.col("bit")).alias("unique_fails"), *(total(alive & fails, m).alias(m) for m in marks))


def order_steps(counts: DataFrame, names: str, marks: tuple[str, ...] = tuple(MARKS)) -> DataFrame:
    """One row per part, order of ``names`` (one letter per bit) and step, with
    the figures of the edge that the step walks and its filter's ``shapley``
    total.  The walks are ``n * n!`` rows whatever the input."""
    spark = counts.sparkSession
    edges = edge_removals(counts, len(names), marks)
    totals = edges.groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("weight")).alias("shapley"))
    schema = StructType([StructField("filter_order", StringType()), StructField("step", IntegerType()),
                         StructField("state", IntegerType()), StructField("bit", IntegerType())])
    walks = spark.createDataFrame(_walks(names), schema)
    return edges.join(totals, ["part", "bit"]).join(F.broadcast(walks), ["state", "bit"]).drop("state", "bit", "weight")


def text_failures(text: Column) -> Column:
    """Bits of the filters that look at one text: 1 under 200 words, 2 under
    half of the words distinct, 4 over 2 % A-Z, 8 holds one of ``#$%&*|``."""
    trimmed = F.btrim(text, F.lit(SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return (F.when(n < 200, 1).otherwise(0) + F.when(100 * distinct < 50 * n, 2).otherwise(0)
            + F.when(100 * capitals > 2 * F.length(text), 4).otherwise(0) + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0))


def failure_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
                   marks: dict[str, str] = MARKS) -> DataFrame:
    """Rows per part and set of failed filters (``mask``: the bits of
    ``text_failures`` and 16 for a text that a row with a smaller id has too),
    with a count per mark of the rows whose label is 1.

    Null texts are empty, null parts the empty string.  Of equal texts the rows
    with the smallest id pass, all of them where that id repeats; a null id is
    neither smaller nor larger than any and has no label.  An id with several
    label rows has a mark if one of them has it.  An empty table gives no row.

    Copies are counted per (text, part, labels) before a text's smallest id is
    looked up, so a text with very many copies is a few rows by then.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    base = docs.select(col(id_col).cast("long").alias("id"), F.coalesce(col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    keyed = base.select("id", "part", text_failures(F.col("text")).alias("mask"), F.octet_length("text").alias("size"),
                        F.substring(F.unhex(F.sha2("text", 256)), 1, 16).alias("digest"))
    spread = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(partitions(docs.sparkSession)))).otherwise(0)
    marked = labels.where(col(id_col).isNotNull()).groupBy(col(id_col).cast("long").alias("id")).agg(
        *(F.max(F.when(col(c) == 1, 1).otherwise(0)).alias(m) for m, c in marks.items())).withColumn("s", F.lit(0).cast("long"))
    keyed = keyed.withColumn("s", spread.cast("long")).join(marked, ["id", "s"], "left").fillna(0, list(marks))
    text_key = ["digest", "size"]
    each = keyed.groupBy("id", "s", *text_key, "part", "mask", *marks).agg(F.count("*").alias("rows"))
    groups = parked(each.groupBy(*text_key, "part", "mask", *marks, F.col("id").isNull().alias("none")).agg(
        F.sum("rows").alias("rows"), F.min("id").alias("low"), F.min_by("rows", "id").alias("at_low")), "audit-texts")
    first = groups.groupBy(*text_key).agg(F.min("low").alias("first"))
    passed = F.when(F.col("none"), F.col("rows")).when(F.col("low") == F.col("first"), F.col("at_low")).otherwise(0)
    both = F.array(F.struct(F.col("mask").alias("mask"), F.col("passed").alias("rows")),
                   F.struct((F.col("mask") + 16).alias("mask"), (F.col("rows") - F.col("passed")).alias("rows")))
    split = groups.join(first, text_key).withColumn("passed", passed).select("part", *marks, F.explode(both).alias("c"))
    return split.where("c.rows > 0").groupBy("part", "c.mask").agg(
        F.sum("c.rows").alias("rows"), *(F.sum(F.when(F.col(m) == 1, F.col("c.rows")).otherwise(0)).alias(m) for m in marks))


@query("op13_filter_audit", r"""
WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
           FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, (len(words) < 200)::INT AS fa, (100 * len(list_distinct(words)) < 50 * len(words))::INT AS fb,
             (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT AS fc,
             regexp_matches(text, '[#$%&*|]')::INT AS fd,
             coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false)::INT AS fe,
             coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
      FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (SELECT part, fa + 2 * fb + 4 * fc + 8 * fd + 16 * fe AS mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic
      FROM f GROUP BY ALL),
c AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(f, b)),
o AS (SELECT c1.f || c2.f || c3.f || c4.f || c5.f AS filter_order
      FROM c c1, c c2, c c3, c c4, c c5 WHERE c1.b | c2.b | c3.b | c4.b | c5.b = 31),
s AS (SELECT filter_order, step::INT AS step, substr(filter_order, step::INT, 1) AS f,
             (SELECT coalesce(sum(b), 0) FROM c WHERE position(c.f IN filter_order) < step)::INT AS done
      FROM o, range(1, 6) r(step)),
e AS (SELECT part, filter_order, step, s.f,
             sum(CASE WHEN mask & (done | b) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN mask & done = 0 AND mask & b <> 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN mask & done <> 0 AND mask & b <> 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN mask = b THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN mask & done = 0 AND mask & b <> 0 THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN mask & done = 0 AND mask & b <> 0 THEN toxic ELSE 0 END) AS toxic_lost
      FROM m, s JOIN c ON s.f = c.f GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM e
""")
def op13_filter_audit(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    counts = failure_counts(docs, table(spark, sf_dir, "labels"))
    got = order_steps(counts, "ABCDE")
    return got.select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
                      F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), "shapley")
