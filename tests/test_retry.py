"""Archives that fail: resumed reads, growing waits, states and retries per archive, quarantine, framing, even dealing."""

import contextlib
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from pagesift.operators.dealing import deal_by_size
from pagesift.operators.runs import quarantined, remaining_segments
from pagesift.plans.crawl_job import filter_crawl
from pagesift.sources import warc, wet
from pagesift.sources.planted_archives import FaultyStore
from pagesift.sources.retry import ArchiveUnavailable, Resumed, Retry
from pagesift.sources.sinks import read_status

QUICK = Retry(first_wait=0.001)


def conv(i, body=b"At BS1 4AB"):
    return warc.encode_record({"WARC-Type": "conversion", "WARC-Target-URI": f"https://a.co.uk/{i}",
                               "WARC-Identified-Content-Language": "eng"}, body)


class Breaking:
    """Opens at any offset; each stream gives ``step`` bytes, then breaks; counts bytes handed out."""

    def __init__(self, data, step, error=ConnectionResetError):
        self.data, self.step, self.error, self.given, self.offsets = data, step, error, 0, []

    def __call__(self, location, offset):
        self.offsets.append(offset)
        end, me = offset + self.step, self

        class Stream(io.RawIOBase):
            at = offset

            def read(self, n=-1):
                if self.at >= end and end < len(me.data):
                    raise me.error("broken")
                got = me.data[self.at:min(end, self.at + n)]
                self.at += len(got)
                me.given += len(got)
                return got
        return Stream()


def test_reads_resume_where_they_broke_and_nothing_is_read_twice():
    data = os.urandom(10_000)
    opener, waits = Breaking(data, 3000), []
    stream = Resumed("x", opener, Retry(attempts=5), waits.append)
    assert io.BufferedReader(stream).read() == data
    assert opener.offsets == [0, 3000, 6000, 9000] and opener.given == len(data)
    assert waits == [1, 2, 4] and stream.retries == 3


def test_waits_double_up_to_a_longest_and_attempts_are_bounded():
    assert list(Retry(attempts=9, longest_wait=10).waits()) == [1, 2, 4, 8, 10, 10, 10, 10]
    waits = []
    stream = Resumed("x", Breaking(b"a" * 100, 0, TimeoutError), Retry(), waits.append)
    with pytest.raises(ArchiveUnavailable, match="failed 5 times, at byte 0"):
        stream.read(10)
    assert waits == [1, 2, 4, 8] and stream.retries == 4


def test_lasting_errors_are_not_waited_for(tmp_path):
    waits = []
    for location in (str(tmp_path / "gone"), str(tmp_path)):
        with pytest.raises((FileNotFoundError, IsADirectoryError)):
            Resumed(location, wet.ArchiveStore().open, Retry(), waits.append).read(1)
    assert waits == []


def _crawl(spark, d, tmp_path, faults, **kw):
    d.mkdir(exist_ok=True)
    rows = []
    for i, fault in enumerate(faults):
        p = d / f"s{i}.wet.gz"
        p.write_bytes(warc.gzip_members([conv(j, b"At BS1 4AB " + os.urandom(300).hex().encode()) for j in range(20)]))
        rows.append(("202104", i, str(tmp_path) if fault == "folder" else str(p) + fault))
    manifest = spark.createDataFrame(rows, "crawl_date string, segment int, path string")
    lookup = spark.createDataFrame([("BS1 4AB",)], "pcds string")
    return manifest, filter_crawl(spark, manifest, lookup, str(tmp_path / "out"), str(tmp_path / "st"), retry=QUICK, store=FaultyStore(), **kw)


@pytest.mark.parametrize("kw", [{}, {"even": False}, {"files_per_task": 1}])
def test_a_bad_archive_stops_no_other(spark, tmp_path, kw):
    faults = ["", "#fails=99@0", "#fails=2@100", "folder", "#fails=99@4000", ".gone", "#cut=80", ""]
    _, res = _crawl(spark, tmp_path / "arch", tmp_path, faults, **kw)
    got = {r.segment: (r.state, r.n_matches, r.n_retries) for r in res.status.collect()}
    assert [got[i] for i in (0, 1, 2, 3, 5, 6, 7)] == [
        ("done", 20, 0), ("failed", 0, 4), ("done", 20, 2), ("failed", 0, 0), ("failed", 0, 0), ("partial", 19, 0), ("done", 20, 0)]
    # 4000 more bytes at each attempt: five attempts reach the end or leave a part, never a repeated record
    assert got[4][0] in ("done", "partial") and res.matches.groupBy("segment", "record_no").count().where("count > 1").count() == 0
    errors = {r.segment: r.error for r in res.status.collect()}
    assert "ArchiveUnavailable" in errors[1] and "failed 5 times" in errors[1] and errors[0] is None


def test_breaking_for_good_after_some_records_is_partial(spark, tmp_path):
    store = FaultyStore()
    p = tmp_path / "a.wet.gz"
    p.write_bytes(warc.gzip_members([conv(j, os.urandom(3000)) for j in range(200)]))
    m = spark.createDataFrame([("c", 0, f"{p}#fails=99@60000")], "crawl_date string, segment int, path string")
    row = wet.scan_manifest(m, location="path", retry=QUICK, store=store).where("is_status").first()
    assert row.state == "partial" and 20 <= row.n_records < 200 and row.n_retries == 4


def test_segments_that_fail_in_every_run_are_quarantined(spark, tmp_path):
    for _ in range(3):
        manifest, res = _crawl(spark, tmp_path / "arch", tmp_path, ["", "#fails=99@0", "#cut=80"])
    every = read_status(spark, res.status_path, every_run=True)
    bad = quarantined(every, 3)
    assert [(r.segment, r.n_failures) for r in bad.collect()] == [(1, 3)]
    assert "failed 5 times" in bad.first().error and quarantined(every, 4).count() == 0
    assert sorted(r.segment for r in remaining_segments(manifest, res.status).collect()) == [1, 2]
    assert [r.segment for r in remaining_segments(manifest, res.status, bad).collect()] == [2]
    _, res = _crawl(spark, tmp_path / "arch", tmp_path, ["", "", ""])      # mended: no longer one of them
    assert quarantined(read_status(spark, res.status_path, every_run=True), 3).count() == 0


@pytest.mark.parametrize("length", [b"-5", b"9" * 30, b"+3", b"1_0", b"x", b"9" * 5000])
@pytest.mark.parametrize("keep", [None, lambda h: False, lambda h: h.get("warc-target-uri", "").endswith("/2")])
def test_bad_lengths_give_partial_under_any_filter(length, keep):
    bad = conv(2).replace(b"Content-Length: 10", b"Content-Length: " + length)
    status = warc.ScanResult()
    got = list(warc.iter_records(io.BytesIO(conv(0) + conv(1) + bad + conv(3)), keep=keep, status=status))
    assert status.state == "partial" and status.n_records == 2 and status.error
    assert len(got) == (2 if keep is None else 0)


def _bytes_by_task(dealt, n):
    per = {r.task: r.b for r in dealt.groupBy("task").agg(F.sum("size").alias("b")).collect()}
    assert set(per) <= set(range(n))
    return per


def test_no_task_gets_twice_the_mean(spark):
    rng = random.Random(5)
    for sizes in ([rng.randint(1, 10 ** 9) for _ in range(2000)], [int(1e9 / (i + 1) ** 0.5) for i in range(3000)], [7] * 500):
        df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "id long, size long").repartition(9)
        n = 16
        per = _bytes_by_task(dealt := deal_by_size(df, "size", ("id",), n), n)
        assert dealt.count() == len(sizes) and max(per.values()) < 2 * sum(sizes) / n


def test_one_archive_larger_than_the_mean_is_alone(spark):
    df = spark.createDataFrame([(0, 10 ** 9), *[(i, 10) for i in range(1, 1000)]], "id long, size long")
    out = deal_by_size(df, "size", ("id",), 8).collect()
    mine = [r.task for r in out if r.id == 0]
    assert [r.id for r in out if r.task == mine[0]] == [0]


def test_unknown_and_zero_sizes_are_dealt_evenly(spark):
    for size in (None, 0):
        df = spark.createDataFrame([(i, size) for i in range(320)], "id long, size long")
        counts = [r["count"] for r in deal_by_size(df, "size", ("id",), 8).groupBy("task").count().collect()]
        assert counts == [40] * 8
    assert deal_by_size(df.limit(0), "size", ("id",), 8).count() == 0


def test_the_reader_gets_the_dealt_partitions(spark, tmp_path):
    """Sizes are measured in tasks, and what a reading task holds is what was dealt to it."""
    sizes = [200_000, 150_000, 100_000] + [4_000] * 60
    for i, s in enumerate(sizes):
        (tmp_path / f"{i}.wet").write_bytes(conv(i, b"x" * s))
    m = spark.createDataFrame([("c", i, str(tmp_path / f"{i}.wet")) for i in range(len(sizes))], "crawl_date string, segment int, path string")
    sized = wet.with_sizes(m)
    assert {r.segment: r.bytes for r in sized.collect()} == {i: os.path.getsize(tmp_path / f"{i}.wet") for i in range(len(sizes))}
    dealt = deal_by_size(sized, "bytes", ("crawl_date", "segment"), 6)
    want = {r.segment: r.task for r in dealt.collect()}
    scan = wet.scan_manifest(dealt, location="path", num_partitions=6).where("is_status")
    got = {r.segment: r.p for r in scan.select("segment", F.spark_partition_id().alias("p")).collect()}
    assert got == want
    total = sum(sizes)
    per = [sum(s for i, s in enumerate(sizes) if got[i] == p) for p in range(6)]
    assert max(per) <= max(2 * total / 6, sizes[0] + 1000)


class Served:
    """What a server would answer, without one."""

    def __init__(self, data, ranges=True):
        self.data, self.ranges, self.asked = data, ranges, []

    def __call__(self, request, timeout=None):
        import urllib.error
        from types import SimpleNamespace
        start = request.get_header("Range", "")
        self.asked.append((request.get_method(), start))
        if request.full_url.endswith("gone"):
            raise urllib.error.HTTPError(request.full_url, 404, "gone", {}, None)
        offset = int(start[6:-1]) if start and self.ranges else 0
        if offset and offset >= len(self.data):
            raise urllib.error.HTTPError(request.full_url, 416, "range", {}, None)
        body = io.BytesIO(self.data[offset:])
        answer = SimpleNamespace(status=206 if offset else 200, headers={"Content-Length": str(len(self.data) - offset)},
                                 read=body.read, close=body.close)
        return contextlib.closing(answer) if request.get_method() == "HEAD" else answer


@pytest.mark.parametrize("ranges", [True, False])
def test_http_resumes_by_range_or_by_skipping(monkeypatch, ranges):
    data = os.urandom(50_000)
    served = Served(data, ranges)
    monkeypatch.setattr(wet.urllib.request, "urlopen", served)
    store = wet.ArchiveStore()
    assert store.open("https://h/a", 0).read() == data and store.open("https://h/a", 20_001).read() == data[20_001:]
    assert store.open("https://h/a", 50_000).read() == b""              # broken after the last byte
    assert served.asked[0] == ("GET", "") and served.asked[1] == ("GET", "bytes=20001-")
    assert store.size("https://h/a") == 50_000 and served.asked[-1][0] == "HEAD"
    assert store.size("https://h/gone") is None
    with pytest.raises(FileNotFoundError):
        store.open("https://h/gone")
