"""End-to-end flows on small literal inputs."""

import os

from capstan import jobs
from capstan.session import scratch_path
from capstan.sinks.blobdir import write_blobs
from capstan.sources import warc


def _spool(spark):
    root = scratch_path(spark, "t-jobs-spool")
    rows = [("aa/1.pdf", bytearray(b"%PDF-1.4\nhello https://a.org/x")),
            ("bb/2.pdf", bytearray(b"%PDF-1.4\nboom")),
            ("cc/3.txt", bytearray(b"just text"))]
    write_blobs(spark.createDataFrame(rows, "path string, content binary"), root)
    return root


def test_process_spool_batch_and_stream(spark):
    def extractor(blob):
        if b"boom" in blob:
            raise RuntimeError("broken")
        return {"text": blob[9:].decode(), "thumbnail": b"\xff\xd8\xff" + b"t" * 80,
                "meta_report": "Pages: 3\nPage size: 612 x 792 pts"}

    for stream in (False, True):
        out = scratch_path(spark, "t-jobs-out")
        r = jobs.process_spool(spark, _spool(spark), out, extractor, stream=stream).first()
        assert (r.processed, r.ok) == (3, 1)
        arts = sorted(os.path.relpath(os.path.join(d, f), os.path.join(out, "artifacts"))
                      for d, _, fs in os.walk(os.path.join(out, "artifacts")) for f in fs)
        assert [a.split("/")[0] for a in arts] == ["sandcrawler", "thumbnail"]
        res = spark.read.json(os.path.join(out, "results"))
        assert res.count() == 1 and res.first().pdfextra.page_count == 3


def test_extract_captures_sinks(spark):
    path = scratch_path(spark, "t-jobs-warc")
    body = b"%PDF-1.4 data"
    resp = b"HTTP/1.1 200 OK\r\nContent-Type: application/pdf\r\nContent-Length: 13\r\n\r\n" + body
    rows = [("w", 0, "response", None, None, "http://a/x.pdf", "application/http; msgtype=response", bytearray(resp)),
            ("w", 1, "response", None, None, "http://a/y.pdf", "application/http; msgtype=response", bytearray(resp))]
    df = spark.createDataFrame(rows, "warc_file string, record_idx long, warc_type string, record_id string, "
                                     "record_date string, target_uri string, content_type string, payload binary")
    warc.write_warc(df, path)
    out = scratch_path(spark, "t-jobs-fetch")
    counts = jobs.extract_captures(spark, path, out, ("hashdir", "dir", "log", "intake"))
    assert counts == {"hashdir": 2, "dir": 2, "log": 2, "intake": 2}
    files = [f for _, _, fs in os.walk(os.path.join(out, "hashdir")) for f in fs]
    assert len(files) == 1  # same content, one object


def test_intake_arrivals_two_runs(spark):
    arrivals = scratch_path(spark, "t-arr")
    spool, tables = scratch_path(spark, "t-spool2"), scratch_path(spark, "t-tables")
    first = [("a/1", bytearray(b"alpha")), ("a/2", bytearray(b"beta")), ("a/3", bytearray(b"alpha")),
             ("a/4", bytearray(b"x" * 50))]
    write_blobs(spark.createDataFrame(first, "path string, content binary"), arrivals)
    acts = jobs.intake_arrivals(spark, arrivals, spool, tables, max_size=20)
    got = {r.path.rsplit("/", 1)[-1]: r.action for r in acts.collect()}
    assert got == {"1": "insert", "2": "insert", "3": "skip", "4": "too-large"}
    # a second run sees only new files; known content is skipped
    write_blobs(spark.createDataFrame([("b/5", bytearray(b"beta")), ("b/6", bytearray(b"gamma"))],
                                      "path string, content binary"), arrivals)
    acts = jobs.intake_arrivals(spark, arrivals, spool, tables, max_size=20)
    got = {r.path.rsplit("/", 1)[-1]: r.action for r in acts.collect()}
    assert got["5"] == "skip" and got["6"] == "insert" and len(got) == 6
    files = sorted(f for _, _, fs in os.walk(spool) for f in fs)
    assert len(files) == 3  # alpha, beta, gamma stored once each


def test_cli_fetch(spark, capsys):
    import json

    path = scratch_path(spark, "t-cli-warc")
    resp = b"HTTP/1.1 200 OK\r\nContent-Type: application/pdf\r\nContent-Length: 3\r\n\r\nPDF"
    rows = [("w", 0, "response", None, None, "http://a/x.pdf", "application/http; msgtype=response", bytearray(resp))]
    df = spark.createDataFrame(rows, "warc_file string, record_idx long, warc_type string, record_id string, "
                                     "record_date string, target_uri string, content_type string, payload binary")
    warc.write_warc(df, path)
    out = scratch_path(spark, "t-cli-out")
    jobs.main(["fetch", "--warc", path, "--out", out, "--sink", "log", "--sink", "hashdir"])
    printed = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert printed == {"log": 1, "hashdir": 1}


def test_intake_slow_down_when_storage_short(spark):
    from capstan.streaming.intake import free_space_probe

    arrivals = scratch_path(spark, "t-arr2")
    spool, tables = scratch_path(spark, "t-spool3"), scratch_path(spark, "t-tables2")
    write_blobs(spark.createDataFrame([("a/1", bytearray(b"one")), ("a/2", bytearray(b"two"))],
                                      "path string, content binary"), arrivals)
    acts = jobs.intake_arrivals(spark, arrivals, spool, tables, has_space=lambda: False)
    assert {(r.action, r.code) for r in acts.collect()} == {("slow-down", 429)}
    assert not os.path.exists(spool) or not any(fs for _, _, fs in os.walk(spool))
    assert free_space_probe(arrivals, 0)() is True


def test_intake_keeps_empty_arrivals_and_urls(spark):
    arrivals, spool, tables = (scratch_path(spark, f"t-in{i}") for i in range(3))
    os.makedirs(arrivals)
    for name, data in (("a", b"one"), ("b", b""), ("c", b"one")):
        with open(os.path.join(arrivals, name), "wb") as fh:
            fh.write(data)
    urls = spark.createDataFrame([("a", "http://u/a"), ("c", "http://u/c"), ("b", "http://u/b")], "name string, url string")
    for _ in range(2):  # a second run adds nothing
        acts = jobs.intake_arrivals(spark, arrivals, spool, tables, urls=urls)
        got = sorted((r.path.rsplit("/", 1)[-1], r.action, r.code) for r in acts.collect())
        assert got == [("a", "insert", 202), ("b", "empty", 400), ("c", "skip", 202)]
    assert [r.url for r in spark.read.parquet(os.path.join(tables, "url_map")).collect()] == ["http://u/a"]


def test_run_stores_xml_reads_both_reports_and_removes(spark):
    from capstan.sources.blocklist import DEFAULT_BAD_SHA1

    def two_reports(blob):
        return {"text": "text of " + blob[9:].decode(), "thumbnail": b"t" * 60, "meta_report": "Pages:  3\nPDF version: 1.4",
                "pdfcpu_report": '{"header": {"version": "v1"}, "infos": [{"pageCount": 3, "tagged": true}]}'}

    root, out = scratch_path(spark, "t-run"), scratch_path(spark, "t-run-out")
    os.makedirs(root)
    with open(os.path.join(root, "d"), "wb") as fh:
        fh.write(b"%PDF-1.4\nbody")
    stats = jobs.process_spool(spark, root, out, two_reports, xml_extractor=lambda b: b"<tei/>", remove_processed=True).first()
    assert (stats.processed, stats.ok) == (1, 1) and os.listdir(root) == []
    kept = spark.read.parquet(os.path.join(out, "extracted", "batch=0")).first()
    assert kept.metadata.pages == 3 and kept.metadata.pdfcpu.infos[0].pageCount == 3
    stored = [f for _, _, names in os.walk(os.path.join(out, "artifacts")) for f in names]
    assert sorted(f.split(".", 1)[1] for f in stored) == ["180px.jpg", "tei.xml", "txt"]
    assert len(DEFAULT_BAD_SHA1) > 100
