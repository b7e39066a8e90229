"""Runs in one folder: repeated ids, streams beside batch runs, compaction that readers follow."""

import os

import pytest

from pagesift.plans.crawl_job import filter_crawl
from pagesift.sources import sinks, warc
from pagesift.sources.sinks import compact_matches, read_matches, read_status, remove_compacted
from pagesift.streaming.incremental import stream_manifests


def conv(uri, body):
    return warc.encode_record({"WARC-Type": "conversion", "WARC-Target-URI": uri, "WARC-Identified-Content-Language": "eng"}, body)


@pytest.fixture()
def crawl(spark, tmp_path):
    d = tmp_path / "arch"
    d.mkdir()
    rows = []
    for i in range(4):
        (d / f"s{i}.wet").write_bytes(b"".join(conv(f"https://a.co.uk/{i}/{j}", f"At BS{j + 1} 4AB".encode()) for j in range(3)))
        rows.append(("202104" if i < 2 else "202110", i, str(d / f"s{i}.wet")))
    manifest = spark.createDataFrame(rows, "crawl_date string, segment int, path string")
    lookup = spark.createDataFrame([(f"BS{j + 1} 4AB",) for j in range(3)], "pcds string")
    return manifest, lookup, str(tmp_path / "out"), str(tmp_path / "st")


def _rows(spark, out, st):
    return sorted((r.segment, r.record_no, r.uri, tuple(r.postcodes), r.text) for r in read_matches(spark, out, st).collect())


def _run_folders(out):
    return sorted(f"{c}/{r}" for c in os.listdir(out) if c.startswith("crawl_date=") for r in os.listdir(f"{out}/{c}"))


def test_a_repeated_run_without_matches_leaves_no_old_row(spark, crawl):
    manifest, lookup, out, st = crawl
    filter_crawl(spark, manifest, lookup, out, st, run_id=5)
    assert len(_rows(spark, out, st)) == 12
    nothing = spark.createDataFrame([("BS9 9ZZ",)], "pcds string")
    res = filter_crawl(spark, manifest, nothing, out, st, run_id=5)
    assert _rows(spark, out, st) == [] and {r.state for r in res.status.collect()} == {"empty"}
    assert _run_folders(out) == []


def test_a_repeat_that_breaks_counts_for_nothing(spark, crawl, monkeypatch):
    """The status goes first, so half of a replaced run is never taken for the whole."""
    manifest, lookup, out, st = crawl
    filter_crawl(spark, manifest, lookup, out, st, run_id=5)
    from pagesift.plans import crawl_job

    def broken(*a):
        raise OSError("lost")
    monkeypatch.setattr(crawl_job, "write_status", broken)
    with pytest.raises(OSError):
        filter_crawl(spark, manifest, lookup, out, st, run_id=5)
    assert _rows(spark, out, st) == [] and read_status(spark, st).count() == 0


def test_streams_and_batch_runs_share_the_folders(spark, crawl, tmp_path):
    manifest, lookup, out, st = crawl
    listed = {r.segment: r for r in manifest.collect()}

    def stream(name, segments):
        land = tmp_path / name
        land.mkdir(exist_ok=True)
        (land / f"m{len(os.listdir(land))}.csv").write_text("crawl_date,segment,path\n" + "".join(
            f"{listed[s].crawl_date},{s},{listed[s].path}\n" for s in segments))
        stream_manifests(spark, str(land), lookup, out, st, str(tmp_path / f"ck-{name}"), available_now=True).awaitTermination(300)

    def segments():
        return sorted({r[0] for r in _rows(spark, out, st)})

    stream("one", [0])
    stream("two", [1])                                  # its own checkpoint, the same folders
    assert segments() == [0, 1] and len(_rows(spark, out, st)) == 6
    filter_crawl(spark, manifest, lookup, out, st, segment=2)
    stream("one", [3])
    assert segments() == [0, 1, 2, 3] and len(_rows(spark, out, st)) == 12
    with open(listed[2].path, "wb") as f:               # a stream's later reading wins over a batch run's
        f.write(conv("https://a.co.uk/new", b"At BS1 4AB"))
    stream("two", [2])
    assert [r[2] for r in _rows(spark, out, st) if r[0] == 2] == ["https://a.co.uk/new"]


def test_compaction_changes_nothing_that_is_read(spark, crawl):
    manifest, lookup, out, st = crawl
    filter_crawl(spark, manifest, lookup, out, st)
    filter_crawl(spark, manifest, lookup, out, st, segment=1)          # supersedes one segment
    before = _rows(spark, out, st)
    compact_matches(spark, out, st)
    assert _rows(spark, out, st) == before and len(_run_folders(out)) == 3
    assert remove_compacted(spark, out, st) == 3
    assert _run_folders(out) == [] and _rows(spark, out, st) == before
    filter_crawl(spark, manifest, lookup, out, st, segment=3)          # a run after it counts instead
    assert _rows(spark, out, st) == before and len(_run_folders(out)) == 1
    assert remove_compacted(spark, out, st) == 0 and _rows(spark, out, st) == before
    first, second = sinks.published_generations(spark, out), compact_matches(spark, out, st)
    assert _rows(spark, out, st) == before and second > first[-1]
    assert remove_compacted(spark, out, st) == 3 and _rows(spark, out, st) == before
    assert sinks.published_generations(spark, out) == [second]


def test_a_compaction_that_breaks_leaves_the_old_state(spark, crawl, monkeypatch):
    manifest, lookup, out, st = crawl
    filter_crawl(spark, manifest, lookup, out, st)
    before = _rows(spark, out, st)
    from pyspark.sql import DataFrameWriter
    real = DataFrameWriter.parquet

    def broken(self, path, *a, **kw):
        if "/covers/" in path:
            raise OSError("lost before the list was written")
        return real(self, path, *a, **kw)
    monkeypatch.setattr(DataFrameWriter, "parquet", broken)
    with pytest.raises(OSError):
        compact_matches(spark, out, st)
    monkeypatch.undo()
    assert sinks.published_generations(spark, out) == [] and _rows(spark, out, st) == before
    assert remove_compacted(spark, out, st) == 0 and _rows(spark, out, st) == before
    compact_matches(spark, out, st)
    remove_compacted(spark, out, st)
    assert _rows(spark, out, st) == before and len(os.listdir(f"{out}/_compacted/rows")) == 1


def test_compacted_rows_are_clustered_by_postcode(spark, crawl):
    manifest, lookup, out, st = crawl
    filter_crawl(spark, manifest, lookup, out, st)
    g = compact_matches(spark, out, st)
    rows = spark.read.parquet(f"{out}/_compacted/rows/generation={g}")
    per_file = rows.selectExpr("_metadata.file_path f", "crawl_date c", "first_postcode p").groupBy("f").agg(
        {"c": "count"}).count()
    assert rows.count() == 12 and per_file <= 2 * spark.sparkContext.defaultParallelism
    assert [f.name for f in rows.schema][-2:] == ["first_postcode", "crawl_date"]
