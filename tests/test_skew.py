"""Hot keys: one hash holds a third of all rows.  Results stay whole and
correct, and no window is partitioned by the hot key."""

from pyspark.sql import functions as F

from capstan.operators import artifacts, intake, urlmap
from capstan.operators.dedupe import distinct_content


def _arrivals(spark, n=300):
    # every third arrival carries the same content
    df = spark.range(n).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("body"),
    )
    return df.select("seq", F.sha1(F.encode("body", "UTF-8")).alias("sha1hex"),
                     F.octet_length("body").cast("bigint").alias("size")).withColumn("declared", F.col("size"))


def test_intake_hot_hash(spark):
    arr = _arrivals(spark)
    empty = spark.createDataFrame([], "sha1hex string, stored_size bigint")
    out = intake.actions(arr, empty, 0, order="seq")
    counts = {r.action: r.n for r in out.groupBy("action").agg(F.count("*").alias("n")).collect()}
    assert counts == {"insert": 201, "skip": 99}
    first = out.where("action = 'insert' and seq = 0").count()
    assert first == 1
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()


def test_url_lookup_hot_sha1(spark):
    rows = spark.range(300).select(
        F.concat(F.lit("http://x/"), F.col("id").cast("string")).alias("url"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("sha1"))
    got = urlmap.lookup(rows.select("url"), rows)
    hot = got.where("sha1 = 'hot'").select("urls_per_sha1").distinct().collect()
    assert got.count() == 300 and [r[0] for r in hot] == [100]


def test_last_write_wins_hot_key(spark):
    df = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, F.lit("k")).otherwise(F.col("id").cast("string")).alias("key"),
        F.col("id").alias("ord"), (F.col("id") * 10).alias("val"))
    out = artifacts.last_write_wins(df, ["key"], "ord", ["val"])
    assert out.count() == 201
    assert out.where("key = 'k'").first().val == 2970


def test_distinct_content_hot(spark):
    df = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.encode(F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")), "UTF-8").alias("content"))
    out = distinct_content(df, order="doc_id")
    hot = out.orderBy(F.desc("copies")).first()
    assert (hot.first_doc, hot.copies) == (0, 100) and out.count() == 201
