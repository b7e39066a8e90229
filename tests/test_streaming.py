"""Incremental processing: micro-batches equal the batch result; restarts add nothing."""

import os

from pagesift.operators import match
from pagesift.sources.planted import relation
from pagesift.streaming.incremental import stream_records

from conftest import SF001


def test_stream_records_exactly_once(spark, tmp_path):
    wet = relation(spark, SF001, "wet_records").select(
        "crawl_date", "segment", "record_no", "rec_type", "uri", "language")
    full = relation(spark, SF001, "wet_records")
    from pyspark.sql import functions as F
    full = full.withColumn("headers", F.lit(None).cast("map<string,string>")) \
        .withColumn("content_length", F.length("text").cast("bigint")) \
        .select("crawl_date", "segment", "record_no", "rec_type", "uri", "language", "headers",
                "content_length", "text")
    land = tmp_path / "landing"
    full.where("record_no % 2 = 0").write.parquet(str(land / "part1"))
    full.where("record_no % 2 = 1").write.parquet(str(land / "part2"))
    lookup = relation(spark, SF001, "postcode_lookup")
    ck, out = str(tmp_path / "ck"), str(tmp_path / "out")
    q = stream_records(spark, str(land) + "/*", lookup, out, ck, max_files_per_trigger=1, available_now=True)
    q.awaitTermination(300)
    got = spark.read.parquet(out).select("record_no").collect()
    expected = match.postcode_pages(full, lookup).select("record_no").collect()
    assert sorted(r.record_no for r in got) == sorted(r.record_no for r in expected)
    n_batches = len([p for p in os.listdir(out) if p.startswith("batch=")])
    q2 = stream_records(spark, str(land) + "/*", lookup, out, ck, available_now=True)
    q2.awaitTermination(300)
    assert len([p for p in os.listdir(out) if p.startswith("batch=")]) == n_batches
    assert spark.read.parquet(out).count() == len(expected)


def test_stream_manifests(spark, tmp_path):
    from pagesift.sources import warc
    from pagesift.streaming.incremental import stream_manifests

    arch = tmp_path / "arch"
    arch.mkdir()
    rec = warc.encode_record({"WARC-Type": "conversion", "WARC-Target-URI": "https://a.co.uk/p",
                              "WARC-Identified-Content-Language": "eng"}, b"at BS1 4AB")
    other = warc.encode_record({"WARC-Type": "conversion", "WARC-Target-URI": "https://a.com/p",
                                "WARC-Identified-Content-Language": "eng"}, b"at BS1 4AB")
    (arch / "a.wet.gz").write_bytes(warc.gzip_members([rec, other]))
    (arch / "b.wet.gz").write_bytes(warc.gzip_members([other, rec, rec]))
    mdir = tmp_path / "manifests"
    mdir.mkdir()
    (mdir / "m1.csv").write_text(f"crawl_date,segment,path\n202104,0,{arch / 'a.wet.gz'}\n")
    lookup = spark.createDataFrame([("BS1 4AB",)], "pcds string")
    ck, out, st = str(tmp_path / "ck"), str(tmp_path / "out"), str(tmp_path / "st")
    stream_manifests(spark, str(mdir), lookup, out, st, ck, available_now=True).awaitTermination(300)
    assert spark.read.parquet(out).count() == 1
    (mdir / "m2.csv").write_text(f"crawl_date,segment,path\n202104,1,{arch / 'b.wet.gz'}\n202104,2,{arch / 'gone.wet.gz'}\n")
    stream_manifests(spark, str(mdir), lookup, out, st, ck, available_now=True).awaitTermination(300)
    got = sorted((r.segment, r.record_no) for r in spark.read.parquet(out).collect())
    assert got == [(0, 0), (1, 1), (1, 2)]
    from pagesift.sources.sinks import read_status
    assert {r.segment: r.state for r in read_status(spark, st).collect()} == {0: "done", 1: "done", 2: "failed"}
