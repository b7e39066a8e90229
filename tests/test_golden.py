"""Literal golden cases (FIXTURES.md section 3): expected values follow the cited semantics."""

import pytest
from pyspark.sql import functions as F

from pagesift.functions import durations, text
from pagesift.operators import outputs, report, runs

EXTRACTION = [
    ("BS1 4AB", ["BS1 4AB"]),
    ("BS16 1QY BS1 4AB BS16 1QY", ["BS1 4AB", "BS16 1QY"]),
    ("BS1A 4AB-BS2 0HQ", ["BS1A 4AB", "BS2 0HQ"]),
    ("SW1A 1AA", ["SW1A 1AA"]),
    ("bs1 4ab", []), ("BS1  4AB", []), ("BS1 4AB", []), ("BS14AB", []),
    ("BS1 4AC", []),
    ("XBS1 4AB", []), ("_BS1 4AB", []), ("1BS1 4AB", []), ("éBS1 4AB", []),
    ("BS16 1QYBS1 4AB", []),
    ("", []),
]


def test_postcode_extraction(spark):
    df = spark.createDataFrame([(t,) for t, _ in EXTRACTION], "t string")
    got = [r.p for r in df.select(text.postcodes("t").alias("p")).collect()]
    assert got == [e for _, e in EXTRACTION]


def test_narrow_pattern_drops_other_areas(spark):
    df = spark.createDataFrame([(t,) for t, _ in EXTRACTION], "t string")
    got = [r.p for r in df.select(text.postcodes("t", text.postcode_pattern("BS")).alias("p")).collect()]
    assert got == [[p for p in e if p.startswith("BS")] for _, e in EXTRACTION]


def test_prefix_validation():
    assert text.postcode_pattern(None) == text.UK_POSTCODE
    with pytest.raises(ValueError):
        text.postcode_pattern("B1")


WEBSITES = [
    ("https://www.a.co.uk/x/y", True, "www.a.co.uk"),
    ("http://a.co.uk/", True, "a.co.uk"),
    ("https://b.com/?u=a.co.uk/z", True, "b.com/?u=a.co.uk"),
    ("https://www.gov.uk/x?y=.co.uk/", True, "www.gov.uk"),
    ("https://a.co.uk/r?u=http://c.co.uk/q", True, "a.co.uk"),
    ("https://a.co.uk/x\rtail", True, "a.co.uk"),
    ("https://a.co.uk", False, "a.co.uk"),
    ("http://a.co.uk:80/x", False, "a.co.uk:80/x"),
    ("HTTPS://A.CO.UK/", False, "HTTPS://A.CO.UK/"),
]


def test_website_and_uri_filter(spark):
    df = spark.createDataFrame([(u,) for u, _, _ in WEBSITES], "uri string")
    rows = df.select(F.col("uri").contains(text.UK_HOST_MARK).alias("keep"),
                     text.website("uri").alias("w")).collect()
    assert [(r.keep, r.w) for r in rows] == [(k, w) for _, k, w in WEBSITES]


DURATIONS = [("", 0), ("UNLIMITED", 0), ("7-00:00:00", 604800), ("1-02:03:04", 93784),
             ("23:05:07", 83107), ("59:09", 3549), ("42", 42), ("168:00:00", None)]


def test_duration_seconds(spark):
    df = spark.createDataFrame([(s,) for s, _ in DURATIONS], "s string")
    got = [r.v for r in df.select(durations.duration_seconds("s").alias("v")).collect()]
    assert got == [v for _, v in DURATIONS]


def test_segment_label_never_truncates(spark):
    df = spark.createDataFrame([(7,), (12345,), (1234567,)], "s int")
    assert [r.l for r in df.select(text.segment_label("s").alias("l")).collect()] == \
        ["00007", "12345", "1234567"]
    name = df.select(text.output_file_name(F.lit("202104"), "s").alias("n")).first().n
    assert name == "crawldata202104segment00007.parquet"


def test_progress_percent(spark):
    df = spark.createDataFrame([(0, 0), (1, 3), (3, 3)], "done long, total long")
    got = [r.p for r in df.select(durations.percent_floor(F.col("done"), F.col("total")).alias("p")).collect()]
    assert got == [0, 33, 100]


def test_coverage_macro_average_with_empty_file(spark):
    rows = spark.createDataFrame(
        [("a", ["BS1 4AB"]), ("a", None), ("a", ["BS1 4AB"]), ("a", None), ("b", ["BS2 0HQ"])],
        "file string, postcodes array<string>")
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "file string")
    c = outputs.postcode_coverage(rows, F.col("file"), files=files).first()
    assert c.n_files == 3 and c.pct_with_postcodes == pytest.approx(50.0)


@pytest.mark.parametrize("succ,err,rate,verdict", [(0, 0, 0, "no_activity"), (19, 1, 95, "rerun_failed_segments"),
                                                   (100, 0, 100, "healthy"), (19, 0, 100, "healthy")])
def test_success_rate_and_verdict(spark, succ, err, rate, verdict):
    figs = spark.createDataFrame([(err, succ)], "n_errors long, n_success long")
    r = report.run_report(figs).first()
    assert r.success_rate == rate and r.verdict == verdict
    assert r.high_errors == (err > 5)


def test_eta(spark):
    prog = spark.createDataFrame([("d", 600, 1200)], "crawl_date string, n_finished long, n_remaining long")
    r = runs.eta(prog, 3600).first()
    assert (r.rate_per_min, r.eta_minutes, r.eta_text) == (10, 120, "2h 0m")
    r0 = runs.eta(prog, 3600 * 1000).first()
    assert r0.eta_text == "calculating"


def test_crawl_list_shell_and_strict(spark):
    lines = spark.createDataFrame(
        [(0, "# Crawl dates"), (1, "202104 79840"), (2, "   "), (3, "202110  64000 extra"),
         (4, "  202117\t64000  "), (5, "202121")], "line_no long, line string")
    shell = runs.parse_crawl_list(lines).orderBy("line_no").collect()
    assert [(r.crawl_date, r.n_files) for r in shell] == [("202104", 79840), ("202117", 64000)]
    strict = runs.parse_crawl_list(lines, strict=True).orderBy("line_no").collect()
    assert [(r.crawl_date, r.n_files) for r in strict] == [
        ("202104", 79840), ("202110", 64000), ("202117", 64000)]
    bad = spark.createDataFrame([(0, "202104 abc")], "line_no long, line string")
    with pytest.raises(Exception):
        runs.parse_crawl_list(bad, strict=True).collect()


def test_coverage_gap_of_reference_counts(spark):
    # The nine crawls and file counts the submitter defaults to.
    crawls = spark.createDataFrame(
        [("202104", 79840), ("202110", 64000), ("202131", 72000)], "crawl_date string, n_files long")
    got = {r.crawl_date: (r.n_tasks, r.uncovered) for r in runs.coverage_gap(crawls, 25).collect()}
    assert got == {"202104": (3193, 15), "202110": (2560, 0), "202131": (2880, 0)}
    got50 = {r.crawl_date: r.uncovered for r in runs.coverage_gap(crawls, 50).collect()}
    assert got50 == {"202104": 40, "202110": 0, "202131": 0}


def test_default_crawl_list_and_elapsed_breakdown(spark):
    total = runs.workload_total(runs.default_crawl_list(spark)).first()
    assert (total.n_crawl_lines, total.total_files) == (9, 615_840)
    df = spark.createDataFrame([(59,), (3600 * 5 + 60 * 7,), (86400 * 2 + 3600 + 60,), (None,)], "elapsed_s long")
    got = [r.elapsed_text for r in runs.elapsed_breakdown(df).collect()]
    assert got == ["0m", "5h 7m", "2d 1h 1m", None]


def test_report_sink_round_trip(spark, tmp_path):
    from pagesift.sources.sinks import write_report
    figs = spark.createDataFrame([(0, 40, 12)], "n_errors long, n_success long, total_rows long")
    write_report(report.run_report(figs), str(tmp_path / "report"))
    back = spark.read.json(str(tmp_path / "report")).first()
    assert back.verdict == "healthy" and back.success_rate == 100


def test_log_time_is_timezone_free(spark):
    from pagesift.operators.logs import log_time
    import datetime as dt
    df = spark.createDataFrame([("2024-03-10 02:30:05,250 - INFO - x",), ("2024-13-45 00:00:00,000 - x",), ("no ts",)],
                               "line string")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")   # 02:30 does not exist there that day
    try:
        got = [r.t for r in df.select(log_time(F.col("line")).alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == [dt.datetime(2024, 3, 10, 2, 30, 5, 250000), None, None]


def test_monitor_eta_defaults_to_300s(spark):
    prog = spark.createDataFrame([("a", 12), ("b", 100)], "crawl_date string, n_remaining long")
    rt = spark.createDataFrame([("a", 599.9)], "crawl_date string, avg_s double")
    got = {r.crawl_date: (r.sec_per_segment, r.eta_hours) for r in runs.monitor_eta(prog, rt).collect()}
    assert got == {"a": (599, 1), "b": (300, 8)}


def test_warning_patterns_strict_and_reference(spark):
    from pagesift.operators import logs
    lines = spark.createDataFrame(
        [("a.err", "err", 1, "slow network, retries allowed"), ("a.err", "err", 2, "Low disk space"),
         ("a.err", "err", 3, "WARNING: insufficient quota")], "file string, source_kind string, line_no long, line string")
    strict = logs.log_error_counts(lines).first()
    loose = logs.log_error_counts(lines, strict_warnings=False).first()
    assert (strict.n_warnings, loose.n_warnings) == (2, 3)
