"""Live logs: runtimes over micro-batches equal the batch operator, restarts included; stalled segments; sessions."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pagesift.operators import logs, runs
from pagesift.sources.planted import relation
from pagesift.streaming import live_logs

LINE = "file string, source_kind string, line_no long, line string"


def _land(spark, rows, folder, name):
    spark.createDataFrame(rows, LINE).coalesce(1).write.parquet(f"{folder}/{name}")


def _run(spark, land, out, ck, per_trigger=1, **kw):
    lines = spark.readStream.schema(LINE).option("maxFilesPerTrigger", per_trigger).parquet(f"{land}/*")
    live_logs.stream_runtimes(spark, lines, out, ck, available_now=True, **kw).awaitTermination(300)


def _key(r):
    return (r.file, r.crawl_date, r.segment, r.runtime_s)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_gives_the_batch_runtimes(spark, tmp_path, seed):
    """Lines dealt to files at random, read one file a batch, the stream stopped and started again in between."""
    rows = [tuple(r) for r in relation(spark, SF001, "segment_log").where("line_no < 1200").collect()]
    random.Random(seed).shuffle(rows)
    land, out, ck = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ck")
    cuts = [0, len(rows) // 5, len(rows) // 2, len(rows)]
    for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
        _land(spark, rows[a:b], land, f"p{i}")
        if i != 1:                  # the second run starts anew from the checkpoint, with two files to read
            _run(spark, land, out, ck, late="40 days", stalled_after="1000 days")
    want = logs.segment_runtime(spark.createDataFrame(rows, LINE))
    assert sorted(map(_key, live_logs.live_runtimes(spark, out).collect())) == sorted(map(_key, want.collect()))


def _dl(line_no, at, seg=1):
    return ("t.log", "log", line_no, f"2024-01-01 {at},000 - INFO - Downloading https://h/x.gz to out/crawldata202104segment{seg:05d}.wet.gz")


def _done(line_no, at, seg=1):
    return ("t.log", "log", line_no, f"2024-01-01 {at},000 - INFO - Completed processing segment {seg}: 5 records")


def test_stalled_segments_are_listed_until_they_complete(spark, tmp_path):
    land, out, ck = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ck")

    def stalled():
        return sorted((r.segment, r.crawl_date, r.line_no) for r in live_logs.live_stalled(spark, out).collect())

    def step(name, rows):
        _land(spark, rows, land, name)
        _run(spark, land, out, ck, stalled_after="2 hours", late="1 day")

    step("a", [_dl(0, "01:00:00", 1), _dl(1, "01:00:00", 2), _done(2, "01:10:00", 2)])
    assert stalled() == []
    step("b", [_dl(3, "02:30:00", 3)])
    assert stalled() == []                                  # an hour and a half later
    step("c", [_done(4, "03:05:00", 3)])
    assert stalled() == [(1, "202104", 0)]                  # two hours and five minutes later
    step("d", [_done(5, "05:00:00", 1)])
    assert stalled() == []
    assert sorted(map(_key, live_logs.live_runtimes(spark, out).collect())) == [
        ("t.log", "202104", 1, 14400), ("t.log", "202104", 2, 600), ("t.log", "202104", 3, 2100)]


def test_a_line_read_late_corrects_a_pair(spark, tmp_path):
    land, out, ck = str(tmp_path / "land"), str(tmp_path / "out"), str(tmp_path / "ck")
    for name, rows, want in (("a", [_dl(0, "01:00:00"), _done(5, "01:30:00")], 1800), ("b", [_dl(3, "01:20:00")], 600)):
        _land(spark, rows, land, name)
        _run(spark, land, out, ck)
        assert [r.runtime_s for r in live_logs.live_runtimes(spark, out).collect()] == [want]
    _land(spark, [_done(4, "01:25:00")], land, "c")         # now line 5 follows a completed line
    _run(spark, land, out, ck)
    assert [r.runtime_s for r in live_logs.live_runtimes(spark, out).collect()] == [300]


def test_state_behind_the_watermark_is_forgotten():
    """The processor on a plain dictionary: closed events go, the download of an open segment stays."""
    from types import SimpleNamespace

    class Map(dict):
        updateValue, getValue, containsKey, removeKey = dict.__setitem__, dict.__getitem__, dict.__contains__, dict.__delitem__

        def iterator(self):
            return list(self.items())

    p = live_logs.PairLines(7200, 3600)
    maps = {}
    p.init(SimpleNamespace(getMapState=lambda name, *_: maps.setdefault(name, Map()), registerTimer=lambda ms: None))
    maps["events"].update({(0,): (True, 1000, "c"), (1,): (False, 2000, None), (2,): (True, 3000, "c")})
    out = list(p.handleExpiredTimer(("f", 1), SimpleNamespace(getCurrentWatermarkInMs=lambda: 10_000), None))
    assert [(r.line_no, r.state, r.runtime_s) for r in out] == [(1, "done", 1), (2, "open", None)]
    assert list(maps["events"]) == [(2,)]


BEAT = "2024-01-01 {},000 - INFO - [HEARTBEAT] Still running..."


def test_sessions_batch_and_stream(spark, tmp_path):
    times = {"a.log": ["00:00:00", "00:05:00", "00:20:00", "01:00:00"], "b.log": ["00:00:00", "00:15:01"]}
    rows = [(f, "log", i, BEAT.format(t)) for f, ts in times.items() for i, t in enumerate(ts)]
    sessions = logs.heartbeat_sessions(spark.createDataFrame(rows, LINE))
    got = logs.stalled_tasks(sessions, F.lit("2024-01-01 01:15:00"), logs.HEARTBEAT_GAP).orderBy("file", "first_beat").collect()
    assert [(r.file, r.n_beats, r.silent_s, r.state) for r in got] == [       # exactly 15 minutes apart is one session
        ("a.log", 3, 2400, "resumed"), ("a.log", 1, 900, "alive"), ("b.log", 1, 901, "resumed"), ("b.log", 1, 3599, "stalled")]
    land = str(tmp_path / "land")
    _land(spark, rows[:2] + rows[4:], land, "p0")
    _land(spark, rows[2:4] + [("z.log", "log", 9, BEAT.format("23:00:00"))], land, "p1")
    stream = spark.readStream.schema(LINE).option("maxFilesPerTrigger", 1).parquet(f"{land}/*")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")

    def run():
        live_logs.stream_sessions(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", ck) \
            .trigger(availableNow=True).start().awaitTermination(300)
    run()
    run()
    live = spark.read.parquet(out).select("file", "n_beats").collect()
    assert sorted((r.file, r.n_beats) for r in live) == [("a.log", 1), ("a.log", 3), ("b.log", 1), ("b.log", 1)]


def test_totals_by_file_kind_and_all(spark):
    rows = [("a.log", "log", 0, "x - ERROR - boom"), ("a.log", "log", 1, "Completed processing segment 1: 7 records"),
            ("a.err", "err", 0, "timeout"), ("b.out", "out", 0, "Completed processing segment 2: 5 records"), ("c.txt", "txt", 0, "error")]
    got = {(r.level, r.file, r.source_kind): (r.n_files, r.n_lines, r.n_errors, r.n_success, r.n_records)
           for r in logs.log_totals(spark.createDataFrame(rows, LINE)).collect()}
    assert got[("all", None, None)] == (3, 4, 2, 2, 12) and got[("kind", None, "log")] == (1, 2, 1, 1, 7)
    assert got[("file", "a.err", "err")] == (1, 1, 1, 0, 0) and len(got) == 7
    assert {tuple(r) for r in logs.log_totals(spark.createDataFrame([], LINE)).select("level", "n_files", "n_errors").collect()} <= {("all", 0, 0)}


def test_totals_scan_once(spark):
    plan = logs.log_totals(relation(spark, SF001, "log_lines"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan


def test_failure_classes_in_one_pass(spark):
    df = logs.failures_by_class(relation(spark, SF001, "log_lines"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "RLIKE" not in plan.upper().replace("REGEXP_EXTRACT_ALL", "")


def test_ranges_of_a_million_segments(spark):
    """Exact over many spans: whole spans, edges on both sides, single segments, a crawl without any."""
    gone = [0, 4095, 4096, 8192, 500_000, 500_001, 999_999]
    df = spark.range(1_000_000).where(~F.col("id").isin(gone)).select(F.lit("a").alias("crawl_date"), F.col("id").alias("segment")) \
        .unionByName(spark.createDataFrame([("b", 7), ("b", 7), ("b", 9)], "crawl_date string, segment long"))
    got = sorted((r.crawl_date, r.first_segment, r.last_segment, r.n_segments) for r in runs.segment_ranges(df.repartition(7)).collect())
    assert got == [("a", 1, 4094, 4094), ("a", 4097, 8191, 4095), ("a", 8193, 499_999, 491_807), ("a", 500_002, 999_998, 499_997),
                   ("b", 7, 7, 1), ("b", 9, 9, 1)]
    assert runs.segment_ranges(df.limit(0)).count() == 0


def test_no_window_holds_a_crawl(spark):
    """Segments meet in windows by span; only the islands at span edges meet by crawl."""
    df = spark.range(100).select((F.col("id") % 3).cast("string").alias("crawl_date"), F.col("id").alias("segment"))
    plan = runs.segment_ranges(df)._jdf.queryExecution().optimizedPlan().toString()
    spec = plan.split("row_number() windowspecdefinition(")[1].split("specifiedwindowframe")[0]
    assert spec.startswith("crawl_date") and "_span" in spec


def test_report_figures_read_the_lines_once(spark):
    from pagesift.operators.report import run_figures
    lines = relation(spark, SF001, "log_lines")
    none = spark.createDataFrame([], "crawl_date string, segment int, postcodes array<string>")
    plan = run_figures(lines, none, runtimes=spark.createDataFrame([], "runtime_s long"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
