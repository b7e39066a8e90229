"""Command line for spark-submit: ``python -m pagesift.plans.cli <command> ...``.

* ``filter``  -- run the crawl filter over a manifest (all segments, one ``--segment``, or one
  array-style slice ``--task-id`` x ``--segments-per-task``); writes matches and status.
* ``analyse`` -- log mining + output statistics -> one-row run report (printed, optionally
  written as JSON).
* ``status``  -- progress, remaining segments and ETA, per crawl and overall, from the status table;
  with the logs, the output folder or an accounting listing also what they tell.
* ``compact`` -- rewrite the matches that count as one clustered generation, then remove what it replaced.

The session comes from ``SparkSession.builder.getOrCreate()``, i.e. from spark-submit's
configuration (master, executors, ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import jobs, logs, outputs, report, runs
from ..session import staged
from ..sources import files
from ..sources.retry import Retry
from ..sources.sinks import compact_matches, current_files, read_matches, read_status, remove_compacted, write_report
from ..sources.wet_text import read_wet_text
from .crawl_job import filter_crawl, filter_records

ACCOUNTING = "job_id bigint, submit_time timestamp_ntz, state string, elapsed string, time_limit string"


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pagesift")
    sub = p.add_subparsers(dest="command", required=True)

    f = sub.add_parser("filter", help="filter archives listed in a manifest")
    f.add_argument("--wet-paths", required=True, help="manifest file(s): one archive path per line")
    f.add_argument("--crawl-date", help="crawl date (default: from {date}_wet.paths file names)")
    f.add_argument("--server-url", help="base URL joined to relative manifest paths")
    f.add_argument("--postcode-lookup", required=True, help="Parquet reference list with column pcds")
    f.add_argument("--lookup-column", default="pcds")
    f.add_argument("--output-dir", required=True)
    f.add_argument("--status-dir", required=True)
    f.add_argument("--segment", type=int, help="process only this segment")
    f.add_argument("--task-id", type=int, help="process segments [task*k, (task+1)*k)")
    f.add_argument("--segments-per-task", type=int, default=1)
    f.add_argument("--files-per-task", type=int, default=4, help="archives per Spark task")
    f.add_argument("--remaining", action="store_true", help="only segments that no run finished and that aren't quarantined")
    f.add_argument("--attempts", type=int, default=5, help="attempts an archive gets")
    f.add_argument("--wide-lookup", action="store_true", help="match by key: for lookups that can't be broadcast")
    f.add_argument("--sketch-dir", help="store postcode sketches per segment here")
    f.add_argument("--reader", choices=("python", "text"), default="python",
                   help="python: exact framing + per-archive status; text: JVM-only reader")
    f.add_argument("--archives", help="with --reader text: archive folder or glob (any Hadoop "
                   "filesystem), files named crawldata{date}segment{NNNNN}...")

    a = sub.add_parser("analyse", help="run report from logs and outputs")
    a.add_argument("--logs", required=True, help="folder with *.err, *.log, *.out")
    a.add_argument("--output-dir", required=True, help="match output (Parquet)")
    a.add_argument("--status-dir", help="status table: counts current runs only, and coverage")
    a.add_argument("--report", help="write the report row here as JSON")

    s = sub.add_parser("status", help="progress, remaining segments, ETA")
    s.add_argument("--crawl-list", help="date n_files text file (default: built-in list)")
    s.add_argument("--wet-paths", required=True)
    s.add_argument("--status-dir", required=True)
    s.add_argument("--elapsed-seconds", type=int, default=0)
    s.add_argument("--logs", help="folder with the logs: ETA from measured segment runtimes")
    s.add_argument("--output-dir", help="match output: file count and size")
    s.add_argument("--accounting", help="CSV job_id,submit_time,state,elapsed,time_limit: jobs by state, "
                   "jobs near their time limit")
    s.add_argument("--now", help="with --logs: time (yyyy-MM-dd HH:mm:ss) at which silent tasks count as stalled")
    s.add_argument("--deadline", help="with --accounting: jobs near this time (yyyy-MM-dd HH:mm:ss)")

    c = sub.add_parser("compact", help="rewrite the matches that count, clustered, and remove what that replaces")
    c.add_argument("--output-dir", required=True)
    c.add_argument("--status-dir", required=True)
    c.add_argument("--keep-old", action="store_true", help="leave the replaced folders to a later compact")
    return p


def _print(df) -> None:
    """All rows of a report, a row per crawl or file."""
    df.show(max(1, df.count()), truncate=False)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"pagesift-{args.command}").getOrCreate()
    if args.command == "filter":
        manifest = files.read_manifest(spark, args.wet_paths, crawl_date=args.crawl_date)
        lookup = files.read_lookup(spark, args.postcode_lookup, args.lookup_column)
        if args.remaining:
            every = read_status(spark, args.status_dir, every_run=True)
            manifest = staged(runs.remaining_segments(manifest, read_status(spark, args.status_dir), runs.quarantined(every)), "remaining")
        part = {"task_id": args.task_id, "segments_per_task": args.segments_per_task, "segment": args.segment}
        if args.reader == "text":
            if not args.archives:
                raise SystemExit("--reader text needs --archives")
            records = read_wet_text(spark, args.archives, crawl_date=args.crawl_date)
            res = filter_records(spark, records, manifest, lookup, args.output_dir,
                                 args.status_dir, key=args.lookup_column, **part)
        else:
            res = filter_crawl(spark, manifest, lookup, args.output_dir, args.status_dir,
                               base_url=args.server_url, key=args.lookup_column,
                               files_per_task=args.files_per_task, retry=Retry(attempts=args.attempts),
                               wide_lookup=args.wide_lookup, sketch_dir=args.sketch_dir, **part)
        _print(runs.run_summary(res.status).orderBy("crawl_date"))
    elif args.command == "analyse":
        lines = files.read_logs(spark, args.logs)
        status = read_status(spark, args.status_dir) if args.status_dir else None
        matches = read_matches(spark, args.output_dir, args.status_dir) if args.status_dir \
            else files.read_output(spark, args.output_dir)
        figures = report.run_figures(lines, matches, status, sizes=outputs.file_sizes(
            current_files(spark, args.output_dir, args.status_dir) if args.status_dir
            else files.output_files(spark, args.output_dir)))
        rep = report.run_report(figures)
        rep.show(vertical=True, truncate=False)
        _print(logs.first_failures(lines).orderBy("file", "rank"))
        _print(logs.log_totals(lines).where("level <> 'file'").orderBy("level", "source_kind"))
        timed = logs.segment_runtime(lines)
        _print(logs.runtime_summary(timed).orderBy("crawl_date"))
        quartiles = logs.runtime_quartiles(logs.runtime_sketches(timed))
        _print(quartiles.orderBy("crawl_date"))
        _print(logs.straggler_segments(timed, quartiles).orderBy(F.desc("runtime_s"), "file", "segment"))
        if args.report:
            write_report(rep, args.report)
    elif args.command == "compact":
        compact_matches(spark, args.output_dir, args.status_dir)
        if not args.keep_old:
            remove_compacted(spark, args.output_dir, args.status_dir)
        _print(outputs.file_sizes(current_files(spark, args.output_dir, args.status_dir)))
    else:
        crawls = files.read_crawl_list(spark, args.crawl_list) if args.crawl_list \
            else runs.default_crawl_list(spark)
        manifest = files.read_manifest(spark, args.wet_paths)
        status = read_status(spark, args.status_dir)
        progress = runs.progress_by_crawl(crawls, manifest, status)
        _print(progress.orderBy("crawl_date"))
        _print(runs.progress_overall(progress))
        _print(runs.run_summary(status).orderBy("crawl_date"))
        _print(runs.eta(progress, args.elapsed_seconds).orderBy("crawl_date"))
        _print(runs.eta_overall(progress, args.elapsed_seconds))
        if args.logs:
            timed = logs.runtime_summary(logs.segment_runtime(files.read_logs(spark, args.logs)))
            _print(runs.monitor_eta(progress, timed).orderBy("crawl_date"))
            if args.now:
                sessions = logs.heartbeat_sessions(files.read_logs(spark, args.logs))
                _print(logs.stalled_tasks(sessions, F.lit(args.now).cast("timestamp_ntz")).where("state = 'stalled'").orderBy("file"))
        if args.output_dir:
            _print(outputs.file_sizes(files.output_files(spark, args.output_dir)))
        if args.accounting:
            listed = spark.read.schema(ACCOUNTING).option("header", "true").csv(args.accounting)
            _print(jobs.jobs_by_state(listed).orderBy("state"))
            _print(jobs.time_limit_use(listed).where("near_limit").orderBy("job_id"))
            if args.deadline:
                _print(jobs.deadline_days(listed, args.deadline).where("deadline_alert").orderBy("job_id"))
        _print(runs.remaining_segments(manifest, status).groupBy("crawl_date")
               .agg(F.count(F.lit(1)).alias("n_remaining")).orderBy("crawl_date"))
        bad = runs.quarantined(read_status(spark, args.status_dir, every_run=True))
        _print(runs.remaining_ranges(manifest, status, bad).orderBy("crawl_date", "first_segment"))
        _print(bad.orderBy("crawl_date", "segment"))
    return 0


if __name__ == "__main__":
    sys.exit(main())
