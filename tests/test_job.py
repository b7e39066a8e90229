"""End-to-end job over archives on disk: matches written, status per segment."""

from pagesift.plans.crawl_job import filter_crawl
from pagesift.sources import warc

INFO = warc.encode_record({"WARC-Type": "warcinfo"}, b"x")


def conv(uri, body, lang="eng"):
    return warc.encode_record({"WARC-Type": "conversion", "WARC-Target-URI": uri,
                               "WARC-Identified-Content-Language": lang}, body)


def test_filter_crawl(spark, tmp_path):
    d = tmp_path / "arch"
    d.mkdir()
    full = warc.gzip_members([INFO, conv("https://a.co.uk/1", b"At BS1 4AB and BS2 0HQ"),
                              conv("https://b.co.uk/2", b"nothing here"),
                              conv("https://c.co.uk/3", b"BS9 9ZZ not listed")])
    (d / "s0.wet.gz").write_bytes(full)
    (d / "s1.wet.gz").write_bytes(full[:-10])
    (d / "s2.wet.gz").write_bytes(warc.gzip_members([INFO, conv("https://b.co.uk/2", b"nothing")]))
    manifest = spark.createDataFrame(
        [("202104", 0, str(d / "s0.wet.gz")), ("202104", 1, str(d / "s1.wet.gz")),
         ("202104", 2, str(d / "s2.wet.gz")), ("202104", 3, str(d / "missing.wet.gz"))],
        "crawl_date string, segment int, path string")
    lookup = spark.createDataFrame([("BS1 4AB",), ("BS2 0HQ",), (None,)], "pcds string")
    res = filter_crawl(spark, manifest, lookup, str(tmp_path / "out"), str(tmp_path / "status"), num_partitions=2)
    out = res.matches.orderBy("segment").collect()
    assert [(r.segment, r.postcodes, r.website) for r in out] == [
        (0, ["BS1 4AB", "BS2 0HQ"], "a.co.uk"), (1, ["BS1 4AB", "BS2 0HQ"], "a.co.uk")]
    st = {r.segment: (r.state, r.n_records, r.n_matches) for r in res.status.collect()}
    assert st[0] == ("done", 4, 1)
    assert st[1][0] == "partial" and st[1][2] == 1
    assert st[2] == ("empty", 2, 0)
    assert st[3][0] == "failed"
    # the slice entry point: task 1 of 3 segments per task covers segment 3; 4 and 5 are beyond
    res2 = filter_crawl(spark, manifest, lookup, str(tmp_path / "out2"), str(tmp_path / "status2"),
                        task_id=1, segments_per_task=3)
    got = {r.segment: (r.state, r.error) for r in res2.status.collect()}
    assert sorted(got) == [3, 4, 5] and got[5][0] == "failed" and "exceeds available paths (4)" in got[5][1]
    assert res2.status.schema["crawl_date"].dataType.simpleString() == "string"
    assert res2.matches.count() == 0
    res3 = filter_crawl(spark, manifest, lookup, str(tmp_path / "out2"), str(tmp_path / "status2"), segment=99)
    assert {r.segment: r.state for r in res3.status.collect()}[99] == "failed"


def test_slices_and_reruns_add_up(spark, tmp_path):
    from pagesift.operators.runs import remaining_segments
    from pagesift.sources.sinks import read_matches, read_status
    d = tmp_path / "arch"
    d.mkdir()
    for i in range(4):
        (d / f"s{i}.wet.gz").write_bytes(warc.gzip_members([INFO, conv(f"https://a.co.uk/{i}", b"At BS1 4AB")]))
    whole = (d / "s3.wet.gz").read_bytes()
    (d / "s3.wet.gz").write_bytes(whole[:-12])
    manifest = spark.createDataFrame([("202104", i, str(d / f"s{i}.wet.gz")) for i in range(4)],
                                     "crawl_date string, segment int, path string")
    lookup = spark.createDataFrame([("BS1 4AB",)], "pcds string")
    out, st = str(tmp_path / "out"), str(tmp_path / "st")
    for task in (0, 1):
        filter_crawl(spark, manifest, lookup, out, st, task_id=task, segments_per_task=2)
    status = read_status(spark, st)
    assert {r.segment: r.state for r in status.collect()} == {0: "done", 1: "done", 2: "done", 3: "partial"}
    assert sorted(r.segment for r in read_matches(spark, out, st).collect()) == [0, 1, 2]
    # what remains is fed back, now that the archive is whole
    left = spark.createDataFrame(remaining_segments(manifest, status).collect(), manifest.schema)
    assert [r.segment for r in left.collect()] == [3]
    (d / "s3.wet.gz").write_bytes(whole)
    res = filter_crawl(spark, left, lookup, out, st)
    assert sorted(r.segment for r in res.matches.collect()) == [0, 1, 2, 3]
    # a re-run that matches nothing replaces what counted; a failed re-run of segment 0 does not
    nothing = spark.createDataFrame([("BS9 9ZZ",)], "pcds string")
    res = filter_crawl(spark, manifest, nothing, out, st, task_id=1, segments_per_task=2)
    assert {r.segment: (r.state, r.n_matches) for r in res.status.collect()} == {
        0: ("done", 1), 1: ("done", 1), 2: ("empty", 0), 3: ("empty", 0)}
    assert sorted(r.segment for r in res.matches.collect()) == [0, 1]
    (d / "s0.wet.gz").unlink()
    res = filter_crawl(spark, manifest, lookup, out, st, segment=0)
    assert {r.segment: r.state for r in res.status.collect()}[0] == "done"
    assert sorted(r.segment for r in res.matches.collect()) == [0, 1]


def test_cli_filter_analyse_status(spark, tmp_path, capsys):
    from pagesift.plans.cli import main
    d = tmp_path / "arch"
    d.mkdir()
    (d / "p0.wet.gz").write_bytes(warc.gzip_members([INFO, conv("https://a.co.uk/1", b"At BS1 4AB")]))
    (d / "p1.wet.gz").write_bytes(warc.gzip_members([INFO, conv("https://b.co.uk/2", b"none")]))
    paths = tmp_path / "202104_wet.paths"
    paths.write_text("p0.wet.gz\np1.wet.gz\np2.wet.gz\n")
    spark.createDataFrame([("BS1 4AB", "x")], "pcds string, ward string").write.parquet(str(tmp_path / "lookup"))
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "job.log").write_text("2025-01-01 00:00:00,000 - INFO - Completed processing segment 0: 1 records\n")
    out, status = str(tmp_path / "out"), str(tmp_path / "status")
    common = ["--wet-paths", str(paths), "--status-dir", status]
    assert main(["filter", *common, "--postcode-lookup", str(tmp_path / "lookup"), "--output-dir", out,
                 "--server-url", str(d) + "/", "--task-id", "0", "--segments-per-task", "2"], spark) == 0
    st = {r.segment: r.state for r in spark.read.parquet(status).collect()}
    assert st == {0: "done", 1: "empty"}
    assert main(["analyse", "--logs", str(logs), "--output-dir", out, "--status-dir", status, "--report", str(tmp_path / "rep")], spark) == 0
    rep = spark.read.json(str(tmp_path / "rep")).first()
    assert rep.total_rows == 1 and rep.n_success == 1 and rep.verdict == "healthy"
    assert rep.n_output_files == 1 and rep.output_mb == 1
    jobs = tmp_path / "jobs.csv"
    jobs.write_text("job_id,submit_time,state,elapsed,time_limit\n1,2024-01-01 00:00:00,RUNNING,09:00:00,10:00:00\n")
    many = tmp_path / "crawls.txt"
    many.write_text("".join(f"{202200 + i} 10\n" for i in range(30)))
    assert main(["status", *common, "--elapsed-seconds", "600", "--crawl-list", str(many), "--logs", str(logs),
                 "--output-dir", out, "--accounting", str(jobs), "--deadline", "2024-01-03 00:00:00"], spark) == 0
    said = capsys.readouterr().out
    assert "202104" in said and "2 of 2 segments successful" in said and "RUNNING" in said
    assert all(str(202200 + i) in said for i in range(30))         # every crawl, not the first 20 rows


def _archives(d):
    d.mkdir()
    (d / "crawldata202104segment00000.wet.gz").write_bytes(warc.gzip_members(
        [INFO, conv("https://a.co.uk/1", b"At BS1 4AB and BS2 0HQ"), conv("https://b.co.uk/2", b"none")]))
    (d / "crawldata202104segment00001.wet.gz").write_bytes(warc.gzip_members([INFO, conv("https://b.co.uk/2", b"x")]))


def test_rerun_does_not_duplicate(spark, tmp_path):
    d = tmp_path / "arch"
    _archives(d)
    manifest = spark.createDataFrame([("202104", i, str(d / f"crawldata202104segment0000{i}.wet.gz")) for i in (0, 1)],
                                     "crawl_date string, segment int, path string")
    lookup = spark.createDataFrame([("BS1 4AB",)], "pcds string")
    out, st = str(tmp_path / "out"), str(tmp_path / "st")
    for _ in range(2):          # a run repeated under its id replaces its rows
        filter_crawl(spark, manifest, lookup, out, st, run_id=7)
    assert spark.read.parquet(out).count() == 1
    assert spark.read.parquet(st).count() == 2
    res = filter_crawl(spark, manifest, lookup, out, st)        # a new run counts instead of it
    assert spark.read.parquet(out).count() == 2
    assert res.matches.count() == 1 and res.status.count() == 2


def test_filter_records_with_jvm_reader(spark, tmp_path):
    from pagesift.plans.crawl_job import filter_records
    from pagesift.sources.wet_text import read_wet_text
    d = tmp_path / "arch"
    _archives(d)
    manifest = spark.createDataFrame([("202104", 0, "a"), ("202104", 1, "b"), ("202104", 2, "c")],
                                     "crawl_date string, segment int, path string")
    lookup = spark.createDataFrame([("BS1 4AB",), ("BS2 0HQ",)], "pcds string")
    res = filter_records(spark, read_wet_text(spark, str(d)), manifest, lookup,
                         str(tmp_path / "out"), str(tmp_path / "st"))
    out = res.matches.collect()
    assert [(r.segment, r.postcodes) for r in out] == [(0, ["BS1 4AB", "BS2 0HQ"])]
    st = {r.segment: (r.state, r.n_records, r.n_matches) for r in res.status.collect()}
    assert st == {0: ("done", 3, 1), 1: ("empty", 2, 0), 2: ("pending", 0, 0)}


def test_cli_text_reader(spark, tmp_path):
    from pagesift.plans.cli import main
    d = tmp_path / "arch"
    _archives(d)
    paths = tmp_path / "202104_wet.paths"
    paths.write_text("a\nb\n")
    spark.createDataFrame([("BS1 4AB",)], "pcds string").write.parquet(str(tmp_path / "lookup"))
    out, status = str(tmp_path / "out"), str(tmp_path / "status")
    assert main(["filter", "--wet-paths", str(paths), "--postcode-lookup", str(tmp_path / "lookup"),
                 "--output-dir", out, "--status-dir", status, "--reader", "text",
                 "--archives", str(d)], spark) == 0
    st = {r.segment: r.state for r in spark.read.parquet(status).collect()}
    assert st == {0: "done", 1: "empty"} and spark.read.parquet(out).count() == 1
