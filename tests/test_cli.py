"""Command line: remaining segments, quarantine and ranges in the status, stalled tasks, stragglers, compaction."""

from pagesift.plans.cli import main
from pagesift.sources import sinks, warc


def _conv(i):
    return warc.encode_record({"WARC-Type": "conversion", "WARC-Target-URI": f"https://a.co.uk/{i}",
                               "WARC-Identified-Content-Language": "eng"}, b"At BS1 4AB")


def test_rerun_of_what_remains_then_compact(spark, tmp_path, capsys):
    d = tmp_path / "arch"
    d.mkdir()
    for i in range(5):
        (d / f"p{i}.wet").write_bytes(_conv(i) + _conv(i + 100))
    (d / "p3.wet").unlink()                            # missing: failed in every run
    whole = (d / "p1.wet").read_bytes()
    (d / "p1.wet").write_bytes(whole[:-20])            # damaged: partial until it is whole
    paths = tmp_path / "202104_wet.paths"
    paths.write_text("".join(f"p{i}.wet\n" for i in range(5)))
    spark.createDataFrame([("BS1 4AB",)], "pcds string").write.parquet(str(tmp_path / "lookup"))
    out, status = str(tmp_path / "out"), str(tmp_path / "status")
    run = ["filter", "--wet-paths", str(paths), "--status-dir", status, "--postcode-lookup", str(tmp_path / "lookup"),
           "--output-dir", out, "--server-url", str(d) + "/", "--attempts", "1", "--sketch-dir", str(tmp_path / "sketches")]
    assert main(run, spark) == 0
    assert main([*run, "--remaining", "--wide-lookup"], spark) == 0
    rows = sinks.read_status(spark, status, every_run=True).collect()
    assert sorted(r.segment for r in rows) == [0, 1, 1, 2, 3, 3, 4]          # the second run had what remained
    (d / "p1.wet").write_bytes(whole)
    assert main([*run, "--remaining"], spark) == 0
    assert main([*run, "--remaining"], spark) == 0                          # segment 3 is quarantined now: nothing to do
    state = {r.segment: (r.state, r.n_matches) for r in sinks.read_status(spark, status).collect()}
    assert state == {0: ("done", 2), 1: ("done", 2), 2: ("done", 2), 3: ("failed", 0), 4: ("done", 2)}
    assert sinks.read_status(spark, status, every_run=True).count() == 9
    before = sorted((r.segment, r.record_no) for r in sinks.read_matches(spark, out, status).collect())
    capsys.readouterr()
    assert main(["compact", "--output-dir", out, "--status-dir", status], spark) == 0
    assert sorted((r.segment, r.record_no) for r in sinks.read_matches(spark, out, status).collect()) == before and len(before) == 8
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "job.log").write_text("2025-01-01 00:00:00,000 - INFO - [HEARTBEAT] Still running...\n"
                                  "2025-01-01 00:00:01,000 - INFO - Completed processing segment 0: 1 records\n")
    assert main(["status", "--wet-paths", str(paths), "--status-dir", status, "--logs", str(logs), "--now", "2025-01-01 01:00:00"], spark) == 0
    said = capsys.readouterr().out
    assert "FileNotFoundError" in said and "stalled" in said and "n_failures" in said
    assert main(["analyse", "--logs", str(logs), "--output-dir", out, "--status-dir", status], spark) == 0
    said = capsys.readouterr().out
    assert "median_s" in said and "|all " in said and "n_output_files" in said
