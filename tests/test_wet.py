"""Archive source: exact framing, gzip members, truncation, UTF-8 drop, pushdown."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from pagesift.operators.match import postcode_pages
from pagesift.sources import warc, wet

INFO = warc.encode_record({"WARC-Type": "warcinfo"}, b"software: test\r\n")


def conv(uri, body, lang="eng"):
    h = {"WARC-Type": "conversion", "WARC-Target-URI": uri}
    if lang is not None:
        h["WARC-Identified-Content-Language"] = lang
    return warc.encode_record(h, body)


REC1_BODY = b"Shop in Bristol.\r\nWARC/1.0\r\nWARC-Type: fake\r\n\r\nVisit us at BS1 4AB today\xff\xfe."
RECORDS = [INFO,
           conv("https://www.a.co.uk/shop", REC1_BODY),
           conv("https://www.b.com/shop", b"Also BS1 4AB"),
           conv("https://www.c.co.uk/x", b"Near BS1 4AB", lang=None)]


@pytest.fixture()
def archive_dir(tmp_path):
    d = tmp_path / "archives"
    d.mkdir()
    data = warc.gzip_members(RECORDS)
    (d / "crawldata202104segment00000.wet.gz").write_bytes(data)
    (d / "crawldata202104segment00001.wet.gz").write_bytes(data[:-12])
    (d / "crawldata202104segment00002.wet.gz").write_bytes(warc.gzip_members([INFO, RECORDS[2]]))
    return d


def test_utf8_ignore():
    assert bytes.fromhex("6162FFFE6364E282").decode(warc.TEXT_ENCODING, warc.TEXT_ERRORS) == "abcd"


def test_iter_records_framing():
    import io
    recs = list(warc.iter_records(gzip.GzipFile(fileobj=io.BytesIO(warc.gzip_members(RECORDS)))))
    assert [r[1] for r in recs] == ["warcinfo", "conversion", "conversion", "conversion"]
    assert recs[1][6] == REC1_BODY.decode("utf-8", "ignore")   # delimiter inside the body kept


def test_truncated_is_partial():
    import io
    data = warc.gzip_members(RECORDS)[:-12]
    st = warc.ScanResult()
    recs = list(warc.iter_records(gzip.GzipFile(fileobj=io.BytesIO(data)), status=st))
    assert st.state == "partial" and len(recs) >= 1 and recs[0][1] == "warcinfo"


def test_data_source_records_and_pushdown(spark, archive_dir):
    df = wet.read_wet(spark, str(archive_dir), on_truncated="keep")
    assert df.where(F.col("segment") == 0).count() == 4
    f = wet.read_wet(spark, str(archive_dir), on_truncated="keep", pushdown=True).where((F.col("rec_type") == "conversion") & F.col("uri").contains(".co.uk/")
                 & (F.col("language") == "eng"))
    f.collect()
    scan = f._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().apply("numOutputRows").value() == f.count() < df.count()     # the reader left out the rest
    wide = df.where((F.col("rec_type") == "conversion") & F.col("uri").contains(".co.uk/") & (F.col("language") == "eng"))
    assert wide.count() == f.count() and df.where(F.col("segment") == 0).count() == 4     # nothing sticks to a plain read
    rows = f.where(F.col("segment") == 0).collect()
    assert len(rows) == 1 and rows[0].record_no == 1 and "WARC/1.0" in rows[0].text


def test_data_source_status_mode(spark, archive_dir):
    st = {r.segment: (r.n_records, r.state) for r in wet.read_wet(spark, str(archive_dir), mode="status").collect()}
    assert st[0] == (4, "read")
    assert st[1][1] == "partial" and st[1][0] >= 1
    assert st[2] == (2, "read")


def test_golden_match(spark, archive_dir):
    lookup = spark.createDataFrame([("BS1 4AB",)], "pcds string")
    recs = wet.read_wet(spark, str(archive_dir), on_truncated="keep")
    out = postcode_pages(recs, lookup).orderBy("segment").collect()
    assert [(r.segment, r.record_no, r.postcodes) for r in out] == [(0, 1, ["BS1 4AB"]), (1, 1, ["BS1 4AB"])]
    assert out[0].text == REC1_BODY.decode("utf-8", "ignore").lower()
    assert out[0].website == "www.a.co.uk"


def test_scan_manifest(spark, archive_dir):
    files = sorted(os.listdir(archive_dir))
    manifest = spark.createDataFrame(
        [("202104", i, str(archive_dir / f)) for i, f in enumerate(files)] + [("202104", 9, str(archive_dir / "missing.wet.gz"))],
        "crawl_date string, segment int, path string")
    scan = wet.scan_manifest(manifest, location="path", rec_type="conversion", uri_contains=".co.uk/", language="eng")
    recs = scan.where("NOT is_status").select("segment", "record_no").orderBy("segment").collect()
    assert [(r.segment, r.record_no) for r in recs] == [(0, 1), (1, 1)]
    st = {r.segment: (r.n_records, r.state) for r in scan.where("is_status").collect()}
    assert st[0] == (4, "read") and st[1][1] == "partial" and st[2] == (2, "read") and st[9][1] == "failed"


def test_native_text_reader(spark, archive_dir):
    from pagesift.sources.wet_text import read_wet_text
    lookup = spark.createDataFrame([("BS1 4AB",)], "pcds string")
    recs = read_wet_text(spark, str(archive_dir / "crawldata202104segment00002.wet.gz"))
    rows = recs.orderBy("record_no").collect()
    assert [(r.rec_type, r.uri, r.framing_ok) for r in rows] == [
        ("warcinfo", None, True), ("conversion", "https://www.b.com/shop", True)]
    assert rows[1].text == "Also BS1 4AB" and rows[1].segment == 2 and rows[1].crawl_date == "202104"
    # the body holding the record delimiter is cut there and flagged; fragments are dropped
    full = read_wet_text(spark, str(archive_dir / "crawldata202104segment00000.wet.gz")).orderBy("record_no").collect()
    assert [r.rec_type for r in full] == ["warcinfo", "conversion", "conversion", "conversion"]
    assert [r.framing_ok for r in full] == [True, False, True, True]
    assert full[1].text.startswith("Shop in Bristol.")
    out = postcode_pages(read_wet_text(spark, str(archive_dir / "crawldata202104segment00000.wet.gz")), lookup)
    assert out.count() == 0   # the cut record lost its postcode; filter_records calls its segment partial


def test_native_text_reader_utf8_drop(spark, tmp_path):
    from pagesift.sources.wet_text import read_wet_text
    body = b"caf\xc3\xa9 BS1 4AB\nab\xff\xfecd\xe2\x82"
    data = warc.gzip_members([conv("https://a.co.uk/x", body)])
    (tmp_path / "crawldata202110segment00004.wet.gz").write_bytes(data)
    r = read_wet_text(spark, str(tmp_path)).first()
    assert r.text == body.decode("utf-8", "ignore") and r.content_length == len(body)
    py = wet.read_wet(spark, str(tmp_path)).first()
    assert py.text == r.text


def test_native_reader_repeated_headers(spark, tmp_path):
    from pagesift.sources.wet_text import read_wet_text
    rec = (b"WARC/1.0\r\nWARC-Type: conversion\r\nWARC-Target-URI: https://a.co.uk/1\r\n"
           b"WARC-Concurrent-To: <a>\r\nWARC-Concurrent-To: <b>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    (tmp_path / "crawldata202110segment00001.wet.gz").write_bytes(gzip.compress(rec))
    r = read_wet_text(spark, str(tmp_path)).first()
    assert r.headers["warc-concurrent-to"] == "<a>" and r.text == "abc" and r.uri == "https://a.co.uk/1"


def _many_records(n=300):
    recs = [INFO]
    for i in range(n):
        uri = f"https://www.s{i}.co.uk/p" if i % 3 else f"https://www.s{i}.com/p"
        body = (f"page {i} " + "lorem ipsum " * (i % 40) + (" BS1 4AB" if i % 5 == 0 else "")).encode()
        recs.append(conv(uri, body))
    return warc.gzip_members(recs)


def test_any_member_layout_gives_the_same_rows_and_keys(spark, tmp_path):
    data = gzip.decompress(_many_records())
    records = [b"WARC/1.0" + r for r in data.split(b"WARC/1.0")[1:]]
    layouts = {"single": [data], "ten": [b"".join(records[i:i + 10]) for i in range(0, len(records), 10)],
               "blocks": [data[i:i + 5000] for i in range(0, len(data), 5000)]}
    got = {}
    for name, members in layouts.items():
        p = tmp_path / f"{name}.wet.gz"
        p.write_bytes(warc.gzip_members(members))
        manifest = spark.createDataFrame([("202104", 0, str(p))], "crawl_date string, segment int, path string")
        scan = wet.scan_manifest(manifest, location="path", num_partitions=2).collect()
        got[name] = sorted((r.record_no, r.uri or "", r.text) for r in scan if not r.is_status)
        assert [(r.n_records, r.state) for r in scan if r.is_status] == [(301, "read")]
    assert got["single"] == got["ten"] == got["blocks"] and [r[0] for r in got["single"]] == list(range(301))


def test_truncated_archive_fails_the_data_source(spark, archive_dir):
    path = str(archive_dir / "crawldata202104segment00001.wet.gz")
    with pytest.raises(Exception, match="partial after"):
        wet.read_wet(spark, path).collect()
    assert wet.read_wet(spark, path, on_truncated="keep").count() >= 1


def test_connection_errors_are_raised():
    import io

    class Flaky(io.BytesIO):
        reads = 0

        def read(self, n=-1):
            self.reads += 1
            if self.reads > 3:
                raise ConnectionResetError("gone")
            return super().read(n)

    raw = b"".join(RECORDS)
    with pytest.raises(ConnectionResetError):
        list(warc.iter_records(Flaky(raw)))


def test_cut_transfer_is_not_a_truncated_archive():
    import io
    from types import SimpleNamespace
    whole = b"".join(RECORDS)

    def served(sent):
        body = io.BytesIO(sent)
        return io.BufferedReader(wet._Transfer(SimpleNamespace(
            headers={"Content-Length": str(len(whole))}, read=body.read, close=body.close)))
    assert len(list(warc.iter_records(served(whole)))) == 4
    with pytest.raises(ConnectionError):
        list(warc.iter_records(served(whole[:-30])))


def test_flaky_archive_is_read_again(spark, tmp_path, monkeypatch):
    """A read that breaks once fails its task; the next attempt has every record."""
    p = tmp_path / "a.wet.gz"
    p.write_bytes(warc.gzip_members(RECORDS))
    opened = []

    def once(location):
        opened.append(location)
        if len(opened) == 1:
            raise ConnectionResetError("gone")
        return warc.open_archive(location)
    monkeypatch.setattr(wet, "open_any", once)
    reader = wet.WetReader({"path": str(p)}, status_mode=True)
    part = reader.partitions()[0]
    with pytest.raises(ConnectionResetError):
        next(reader.read(part))
    assert next(reader.read(part))[2:4] == (4, "read")


def test_batches_are_bounded_by_text(monkeypatch):
    monkeypatch.setattr(wet, "BATCH_CHARS", 100)
    part = wet.WetPartition("x", "202104", 0)
    recs = [(i, "conversion", None, None, {}, 60, "a" * 60) for i in range(10)]
    assert [b.num_rows for b in wet._record_batches(part, recs)] == [2] * 5


def test_filesystem_uris(spark, tmp_path):
    big = tmp_path / "big.wet.gz"
    big.write_bytes(_many_records())
    uri = big.as_uri()                               # file:///..., opened through pyarrow.fs
    manifest = spark.createDataFrame([("202104", 0, uri), ("202104", 1, str(big))],
                                     "crawl_date string, segment int, path string")
    scan = wet.scan_manifest(manifest, location="path")
    st = {r.segment: (r.n_records, r.state) for r in scan.where("is_status").collect()}
    assert st == {0: (301, "read"), 1: (301, "read")}
    assert scan.where("NOT is_status AND segment = 0").count() == 301


def test_text_reader_agrees_or_says_so(spark, archive_dir, tmp_path):
    """The golden archive holds the delimiter inside a body: the text reader's job calls the segment
    partial, and the exact reader then completes it in the same folders."""
    from pagesift.operators.runs import remaining_segments
    from pagesift.plans.crawl_job import filter_crawl, filter_records
    from pagesift.sources.wet_text import read_wet_text
    lookup = spark.createDataFrame([("BS1 4AB",)], "pcds string")
    names = [f"crawldata202104segment0000{i}.wet.gz" for i in (0, 2)]
    manifest = spark.createDataFrame([("202104", i, str(archive_dir / n)) for i, n in zip((0, 2), names)],
                                     "crawl_date string, segment int, path string")
    out, st = str(tmp_path / "out"), str(tmp_path / "st")
    records = read_wet_text(spark, [str(archive_dir / n) for n in names])
    res = filter_records(spark, records, manifest, lookup, out, st)
    got = {r.segment: r.state for r in res.status.collect()}
    assert got == {0: "partial", 2: "empty"}
    res = filter_crawl(spark, remaining_segments(manifest, res.status), lookup, out, st)
    exact = filter_crawl(spark, manifest, lookup, str(tmp_path / "out2"), str(tmp_path / "st2"))
    assert {r.segment: r.state for r in res.status.collect()} == {0: "done", 2: "empty"}
    assert [r.uri for r in res.matches.collect()] == [r.uri for r in exact.matches.collect()] != []


def test_data_source_lists_filesystem_uris(spark, tmp_path):
    (tmp_path / "crawldata202104segment00003.wet.gz").write_bytes(warc.gzip_members(RECORDS))
    df = wet.read_wet(spark, tmp_path.as_uri())
    assert df.count() == 4 and {r.segment for r in df.collect()} == {3}


def test_planted_archives_to_filesystem_uri(spark, tmp_path):
    from conftest import SF001
    from pagesift.sources.planted import relation
    from pagesift.sources.planted_archives import record_no_from_id, write_archives
    out = (tmp_path / "arch").as_uri()
    (tmp_path / "arch").mkdir()
    files = write_archives(relation(spark, SF001, "wet_records"), out)
    assert files.agg(F.sum("n_records")).first()[0] == 200
    back = wet.read_wet(spark, out).withColumn("record_no", record_no_from_id())
    assert sorted(r.record_no for r in back.select("record_no").collect()) == list(range(200))


def test_planted_archives_with_partitions_that_hold_no_rows(spark, tmp_path):
    from pagesift.sources.planted_archives import record_no_from_id, write_archives
    rows = [("202104", n % 2, n, "conversion", f"https://a.co.uk/{n}", "eng", f"page {n}") for n in range(30)]
    records = spark.createDataFrame(rows, "crawl_date string, segment int, record_no long, rec_type string, uri string, "
                                          "language string, text string")
    files = write_archives(records, str(tmp_path), rows_per_task=1)       # 30 partitions, two of them with rows
    assert sorted((r.segment, r.n_records) for r in files.collect()) == [(0, 15), (1, 15)]
    back = wet.read_wet(spark, str(tmp_path)).withColumn("record_no", record_no_from_id())
    assert sorted(r.record_no for r in back.select("record_no").collect()) == list(range(30))
