"""Sinks and small sources: content-addressed folder, spool scan and listing,
URL map append, JSON listing, blocklist, XML slot."""

import os

from pyspark.sql import functions as F

from capstan.operators import artifacts, derive, urlmap
from capstan.operators.stats import batch_totals
from capstan.session import scratch_path
from capstan.sinks.blobdir import write_blobs
from capstan.sinks.hashdir import write_hashdir, write_hashdir_table
from capstan.sinks.listing import write_listing
from capstan.sources.spool import list_spool, read_blocklist, read_spool


def test_hashdir_dedupes(spark):
    df = spark.createDataFrame([(1, bytearray(b"a")), (2, bytearray(b"a")), (3, bytearray(b"b"))],
                               "id long, content binary")
    path = scratch_path(spark, "t-hd")
    write_hashdir(df, path, ext=".bin")
    files = sorted(os.path.relpath(os.path.join(r, f), path) for r, _, fs in os.walk(path) for f in fs)
    assert files == ["86/86f7e437faa5a7fce15d1ddcb9eaeaea377667b8.bin", "e9/e9d71f5ee7c92d6dc9e92ffdad17b8bd49418f98.bin"]
    tpath = scratch_path(spark, "t-hdt")
    write_hashdir_table(df, tpath, order="id")
    back = spark.read.parquet(tpath)
    assert sorted(r.id for r in back.collect()) == [1, 3] and "shard" in back.columns


def test_spool_scan_listing_and_totals(spark):
    root = scratch_path(spark, "t-spool")
    rows = [("34/fc/7a11cb38cf4911763696a41698c68e5ddbbe", bytearray(b"pdf")),
            ("34/fc/0000cb38cf4911763696a41698c68e5ddbbe", bytearray(b"")),
            ("ab/cd/ef01cb38cf4911763696a41698c68e5ddbbe", bytearray(b"x"))]
    write_blobs(spark.createDataFrame(rows, "path string, content binary"), root)
    assert read_spool(spark, root).count() == 2  # the empty file gives no row
    listing = list_spool(spark, root)
    assert listing.count() == 3
    t = batch_totals(listing).first()
    assert (t.files, t.ok, t.skipped) == (3, 2, 1)
    out = scratch_path(spark, "t-listing")
    write_listing(listing, out, "localhost:8000")
    names = sorted(r.name for r in spark.read.json(out).collect())
    assert names[0] == "34fc0000cb38cf4911763696a41698c68e5ddbbe"


def test_url_map_append(spark):
    arr = spark.createDataFrame([("http://a", "", "h1"), ("", "http://b", "h2"), ("", "", "h3"), ("http://a", "", "h1")],
                                "a string, b string, sha1 string")
    rows = urlmap.url_map_rows(arr, [F.col("a"), F.col("b")], F.col("sha1"))
    path = scratch_path(spark, "t-urlmap")
    urlmap.append_url_map(rows, path)
    urlmap.append_url_map(rows, path)
    assert spark.read.parquet(path).count() == 6  # duplicates allowed


def test_blocklist_reader(spark):
    path = scratch_path(spark, "t-bl")
    os.makedirs(path)
    with open(os.path.join(path, "bl.txt"), "w") as fh:
        fh.write("# known bad\nAAAA\naaaa\n\nbbbb\n")
    assert sorted(r.sha1hex for r in read_blocklist(spark, path).collect()) == ["aaaa", "bbbb"]


def test_xml_slot_and_artifacts(spark):
    rows = [(1, bytearray(b"%PDF-1.4\nsmall")), (2, bytearray(b"%PDF-1.4\n" + b"big" * 100))]
    blobs = spark.createDataFrame(rows, "doc_id long, content binary")
    g = derive.gate(blobs, None).withColumn("text", F.lit("some text"))
    res = derive.extract(g.drop("content"))

    def xml(b):
        return b"<TEI/>"

    with_xml = derive.run_xml_extractor(res, xml, blobs, "doc_id", max_size=100)
    kinds = sorted((r.doc_id, r.kind) for r in artifacts.fan_out(with_xml).collect())
    assert kinds == [(1, "text"), (1, "xml"), (2, "text")]


def test_get_prunes_store_partitions(spark):
    reqs = spark.createDataFrame(
        [(i, "", "", "blobs", "", bytearray(f"doc {i}".encode())) for i in range(40)],
        "doc_id long, sha1hex string, ext string, folder string, prefix string, content binary")
    puts = artifacts.put_requests(reqs.withColumn("bucket", F.lit("")))
    store_path = scratch_path(spark, "t-store")
    artifacts.write_store(artifacts.stored(puts, "doc_id"), store_path)
    store = spark.read.parquet(store_path)
    want = puts.where("doc_id < 3").select(F.col("bucket_resolved").alias("bucket"), "object_path")
    got = artifacts.get(store, want)
    rows = got.collect()
    assert len(rows) == 3 and all(r.content_sha1 is not None for r in rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()


def test_items_per_collection(spark):
    from capstan.sources.items import ITEM_SCHEMA, item_files, items_per_collection

    docs = [
        '{"metadata": {"identifier": "a", "collection": ["c1", "c2"]}, "files": [{"name": "x.warc.gz"}, {"name": "x.cdx.gz"}]}',
        '{"metadata": {"identifier": "b", "collection": ["c1"]}, "files": []}',
    ]
    items = spark.read.schema(ITEM_SCHEMA).json(spark.sparkContext.parallelize(docs))
    assert {r.collection: r.items for r in items_per_collection(items).collect()} == {"c1": 2, "c2": 1}
    f = item_files(items).collect()
    assert [(r.identifier, r.position, r.total, r.files) for r in f] == [("a", 1, 2, 1)]


def test_read_spool_takes_what_binary_file_takes(spark):
    """The same rows as Spark's source, without its listing on the driver."""
    root = scratch_path(spark, "t-read")
    for name in ("a/1", "a/b/2", "top", "_t/no", "a/_no", "a/k=1/3", "_k=1/4", "a/.no", "a/.d/no", "a b/ü 5", "a/empty"):
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "wb") as f:
            f.write(b"" if "empty" in name else name.encode() * 3)
    own = read_spool(spark, root)
    plan = own._jdf.queryExecution()
    assert "binaryFile" not in plan.toString()
    # nor do the contents pass for as small as their names, which would have them broadcast
    assert "Exchange" not in plan.executedPlan().toString() and int(str(plan.optimizedPlan().stats().sizeInBytes())) > 1 << 40
    key = ("path", "length", "content")
    theirs = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(*key).collect()
    assert sorted(map(tuple, own.select(*key).collect())) == sorted(map(tuple, theirs))
    assert sorted(r.path for r in read_spool(spark, root, with_content=False).collect()) == sorted(r.path for r in theirs)
