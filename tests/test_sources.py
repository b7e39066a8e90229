"""Text and Parquet readers: line numbering, manifests, logs, crawl list, lookup, output files."""

import pytest
from pyspark.sql import functions as F

from pagesift.operators import logs, outputs, runs
from pagesift.sources import files


def test_read_manifest_numbers_lines(spark, tmp_path):
    p = tmp_path / "202104_wet.paths"
    p.write_text("crawl-data/a/part-0.warc.wet.gz\n crawl-data/a/part-1.warc.wet.gz \n\ncrawl-data/a/part-3.warc.wet.gz\n")
    m = files.read_manifest(spark, str(p)).orderBy("segment").collect()
    assert [(r.crawl_date, r.segment, r.path) for r in m] == [
        ("202104", 0, "crawl-data/a/part-0.warc.wet.gz"), ("202104", 1, "crawl-data/a/part-1.warc.wet.gz"),
        ("202104", 2, ""), ("202104", 3, "crawl-data/a/part-3.warc.wet.gz")]
    seg = runs.manifest_segments(files.read_manifest(spark, str(p)), "https://data.example.org/")
    assert seg.orderBy("segment").first().file_url == "https://data.example.org/crawl-data/a/part-0.warc.wet.gz"


def test_read_crawl_list_file(spark, tmp_path):
    p = tmp_path / "crawls.txt"
    p.write_text("# Crawl dates and file counts\n# Format: date number_of_files\n202104 79840\n202110 64000\n"
                 "202117 64000\n202121 64000\n202125 64000\n202131 72000\n202139 72000\n202143 72000\n202149 64000\n")
    c = files.read_crawl_list(spark, str(p))
    total = runs.workload_total(c).first()
    assert (total.n_crawl_lines, total.n_crawl_dates, total.total_files) == (9, 9, 615_840)


def test_read_logs_and_mining(spark, tmp_path):
    (tmp_path / "job_1.log").write_text(
        "2025-01-01 00:00:00,000 - INFO - Downloading https://h/x.gz to output/crawldata202104segment00007.wet.gz\n"
        "2025-01-01 00:05:00,000 - INFO - Completed processing segment 7: 12 records\n"
        "2025-01-01 00:05:01,000 - ERROR - Failed to download https://h/y.gz after 5 attempts: timeout\n")
    (tmp_path / "job_1.err").write_text("WARNING: Low disk space! following\nTraceback: Exception raised\n")
    (tmp_path / "job_1.out").write_text("Completed processing segment 8: 3 records\n")
    lines = files.read_logs(spark, str(tmp_path))
    assert lines.count() == 6
    err = {r.file: (r.n_errors, r.n_warnings) for r in logs.log_error_counts(lines).collect()}
    assert err == {"job_1.log": (1, 0), "job_1.err": (1, 1)}
    succ = {r.file: (r.n_success, r.n_records) for r in logs.log_success_totals(lines).collect()}
    assert succ == {"job_1.log": (1, 12), "job_1.out": (1, 3)}
    rt = logs.segment_runtime(lines).collect()
    assert [(r.crawl_date, r.segment, r.runtime_s) for r in rt] == [("202104", 7, 300)]
    first = logs.first_failures(lines).collect()
    assert [(r.line_no, r.line) for r in first if r.file == "job_1.log"] == [
        (2, "2025-01-01 00:05:01,000 - ERROR - Failed to download https://h/y.gz after 5 attempts: timeout")]
    last = logs.recent_activity(lines, 1).collect()
    assert {r.file: r.line for r in last}["job_1.err"] == "Traceback: Exception raised"


def test_runtimes_pair_lines_of_shared_logs(spark):
    def at(h, m, text):
        return f"2025-01-01 {h:02d}:{m:02d}:00,000 - INFO - {text}"
    log = [at(0, 0, "Downloading https://h/a.gz to output/crawldata202104segment00005.wet.gz"),
           at(0, 1, "Completed processing segment 5: 1 records"),
           at(9, 0, "Downloading https://h/b.gz to /data/out/crawldata202110segment00005.wet.gz"),
           at(9, 2, "Downloading https://h/b.gz to /data/out/crawldata202110segment00005.wet.gz"),     # retried
           at(9, 3, "Completed processing segment 5: 2 records"), at(9, 4, "Completed processing segment 5: 2 records"),
           at(9, 5, "Completed processing segment 6: 2 records"),
           at(9, 6, "Downloading https://h/c.gz to crawldata202110segment00007.wet.gz")]
    lines = spark.createDataFrame([("job.log", k, i, t) for k in ("log", "err") for i, t in enumerate(log)],
                                  "file string, source_kind string, line_no long, line string")
    got = sorted((r.crawl_date, r.segment, r.runtime_s) for r in logs.segment_runtime(lines).collect())
    assert got == [("202104", 5, 60), ("202110", 5, 60)]


def test_failure_classes_are_whole_words(spark):
    lines = spark.createDataFrame([("a", "log", 0, "following slow allowed"), ("a", "log", 1, "LOW disk")],
                                  "file string, source_kind string, line_no long, line string")
    assert {r.failure_class: r.n_lines for r in logs.failures_by_class(lines).collect()} == {"low": 1}
    assert logs.failures_by_class(lines, whole_words=False).first().n_lines == 2


def test_absolute_manifest_urls(spark):
    m = spark.createDataFrame([("202104", 0, "https://h/a.gz"), ("202104", 1, "/a/b.gz")], "crawl_date string, segment int, path string")
    got = [r.file_url for r in runs.manifest_segments(m, "https://x.org/").orderBy("segment").collect()]
    assert got == ["https://h/a.gz", "https://x.org/a/b.gz"]


def test_log_order_across_splits(spark, tmp_path):
    n = 60000
    (tmp_path / "big.log").write_text("".join(f"2025-01-01 00:00:00,000 - INFO - line {i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        lines = files.read_logs(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 4
        got = [(r.line_no, r.line) for r in lines.orderBy("line_no").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(i, f"2025-01-01 00:00:00,000 - INFO - line {i}") for i in range(n)]


def test_lookup_fails_fast(spark, tmp_path):
    with pytest.raises(Exception):
        files.read_lookup(spark, str(tmp_path / "missing.parquet"))
    spark.createDataFrame([("x",)], "other string").write.parquet(str(tmp_path / "bad.parquet"))
    with pytest.raises(ValueError):
        files.read_lookup(spark, str(tmp_path / "bad.parquet"))


def test_output_files_sizes_and_latest(spark, tmp_path):
    df = spark.createDataFrame([("202104", 1, ["BS1 4AB"]), ("202104", 2, None), ("202110", 3, ["BS2 0HQ"])],
                               "crawl_date string, segment int, postcodes array<string>")
    df.repartition(3).write.partitionBy("crawl_date").parquet(str(tmp_path / "out"))
    assert files.read_output(spark, str(tmp_path / "out")).schema["crawl_date"].dataType.simpleString() == "string"
    fl = files.output_files(spark, str(tmp_path / "out"))
    sizes = outputs.file_sizes(fl).first()
    assert sizes.n_files == fl.count() and sizes.total_mb == sizes.n_files   # each file rounds up to 1 MB
    assert files.latest_files(fl, 2).count() == 2
    cov = outputs.postcode_coverage(files.read_output(spark, str(tmp_path / "out")),
                                    F.col("file_path")).first()
    assert cov.n_files == fl.count()


def test_read_lines_exact_numbers_across_splits(spark, tmp_path):
    lines = [f"crawl-data/x/part-{i}.warc.wet.gz" if i % 97 else "" for i in range(40000)]
    (tmp_path / "202110_wet.paths").write_text("\n".join(lines) + "\n")
    (tmp_path / "202104_wet.paths").write_text("a\nb\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 * 1024))
    try:
        m = files.read_manifest(spark, str(tmp_path))
        assert m.rdd.getNumPartitions() > 4
        got = {(r.crawl_date, r.segment): r.path for r in m.collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(got) == 40002
    assert all(got[("202110", i)] == lines[i] for i in range(40000))
    assert got[("202104", 0)] == "a" and got[("202104", 1)] == "b"


def test_latest_log_files(spark, tmp_path):
    import os
    for i in range(7):
        f = tmp_path / f"task_{i}.log"
        f.write_text(f"line {i}\nmore\n")
        os.utime(f, (1_700_000_000 + i * 60, 1_700_000_000 + i * 60))
    latest = files.latest_files(files.log_files(spark, str(tmp_path)), 5).collect()
    assert [r.file for r in latest] == [f"task_{i}.log" for i in (6, 5, 4, 3, 2)]
    assert all(r.n_lines == 2 and r.source_kind == "log" for r in latest)
