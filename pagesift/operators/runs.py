"""Run reconciliation: crawl list, manifest, per-segment status, progress, remaining work, ETA.

All inputs are small per-crawl or per-segment relations (one row per archive at most), so
each aggregate here is a hash aggregate with map-side combine and every join is on
(crawl_date[, segment]).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.durations import (
    dhm_text,
    idiv,
    minutes_breakdown,
    percent_floor,
    seconds_breakdown,
)
from ..functions.text import join_url, output_file_name, segment_label

SEGMENT_KEY = ("crawl_date", "segment")
# Segment states.
DONE, EMPTY, PARTIAL, FAILED, PENDING = "done", "empty", "partial", "failed", "pending"
FINISHED_STATES = (DONE, EMPTY)
RANGE_SPAN = 4096           # segments a window of ``segment_ranges`` holds at most

_CRAWL_LINE = r"^\s*(\S+)\s+(.*?)\s*$"
_FIRST_TOKEN = r"^\s*(\S+)"


def parse_crawl_list(lines: DataFrame, line: str = "line", strict: bool = False) -> DataFrame:
    """``date n_files`` lines -> (crawl_date, n_files).

    Blank lines and lines whose first token starts with ``#`` are skipped. Default (status
    script semantics): the count is the rest of the line after the date and must be all
    digits, otherwise the line is skipped. ``strict=True`` (submitter semantics): needs a
    second token, uses it as the count, and fails the query on a non-integer count.
    """
    first = F.regexp_extract(F.col(line), _FIRST_TOKEN, 1)
    keep = (first != "") & ~first.startswith("#")
    base = lines.where(F.col(line).isNotNull())
    if strict:
        tokens = F.split(F.regexp_replace(F.col(line), r"^\s+|\s+$", ""), r"\s+")
        count_text = tokens.getItem(1)
        parsed = base.where(keep & (F.size(tokens) >= 2)).select(
            *[c for c in lines.columns if c != line],
            tokens.getItem(0).alias("crawl_date"),
            F.when(count_text.rlike(r"^[+-]?[0-9]+$"), count_text.cast("bigint"))
            .otherwise(F.raise_error(F.concat(F.lit("invalid file count: "), count_text)))
            .cast("bigint").alias("n_files"))
        return parsed
    rest = F.regexp_extract(F.col(line), _CRAWL_LINE, 2)
    return base.where(keep & rest.rlike(r"^[0-9]+$")).select(
        *[c for c in lines.columns if c != line],
        first.alias("crawl_date"), rest.try_cast("bigint").alias("n_files"))


# The crawl list the submitter falls back to when no file is given
# (date, number of archive files).
DEFAULT_CRAWLS = (
    ("202104", 79840), ("202110", 64000), ("202117", 64000), ("202121", 64000),
    ("202125", 64000), ("202131", 72000), ("202139", 72000), ("202143", 72000),
    ("202149", 64000),
)


def default_crawl_list(spark) -> DataFrame:
    """The built-in crawl list as (line_no, crawl_date, n_files)."""
    return spark.createDataFrame([(i, d, n) for i, (d, n) in enumerate(DEFAULT_CRAWLS)],
                                 "line_no long, crawl_date string, n_files long")


def workload_total(crawls: DataFrame) -> DataFrame:
    """One row: listed crawl lines, distinct crawl dates, total files (``SS`` workload)."""
    return crawls.agg(F.count(F.lit(1)).alias("n_crawl_lines"),
                      F.countDistinct("crawl_date").alias("n_crawl_dates"),
                      F.coalesce(F.sum("n_files"), F.lit(0)).cast("bigint").alias("total_files"))


def coverage_gap(crawls: DataFrame, segments_per_task: int) -> DataFrame:
    """Per crawl: array tasks ``n_files div k`` and the tail ``n_files % k`` those tasks miss;
    ``has_array`` false when at most one task would be submitted."""
    k = F.lit(segments_per_task).cast("bigint")
    return crawls.select("crawl_date", "n_files",
                         idiv(F.col("n_files"), k).alias("n_tasks"),
                         (F.col("n_files") % k).alias("uncovered"),
                         (idiv(F.col("n_files"), k) > 1).alias("has_array"))


def manifest_segments(manifest: DataFrame, base_url: str) -> DataFrame:
    """Manifest rows with the archive URL, segment label and output file name."""
    return manifest.select(
        "crawl_date", "segment", "path",
        join_url(base_url, F.trim(F.col("path"))).alias("file_url"),
        segment_label("segment").alias("segment_label"),
        output_file_name("crawl_date", "segment").alias("output_file"))


def segment_slice(manifest: DataFrame, task_id: int, segments_per_task: int = 1) -> DataFrame:
    """Segments ``[task_id*k, (task_id+1)*k)`` of every crawl (array-task selection)."""
    lo = task_id * segments_per_task
    return manifest.where(F.col("segment").between(lo, lo + segments_per_task - 1))


def segment_out_of_range(requested: DataFrame, manifest: DataFrame) -> DataFrame:
    """Requested (crawl_date, segment) pairs beyond the manifest -> state ``failed``."""
    sizes = manifest.groupBy("crawl_date").agg(F.count(F.lit(1)).alias("n_paths"))
    missing = requested.select(*SEGMENT_KEY).distinct() \
        .join(manifest.select(*SEGMENT_KEY), list(SEGMENT_KEY), "left_anti")
    return missing.join(sizes, "crawl_date", "left").select(
        "crawl_date", "segment",
        F.coalesce("n_paths", F.lit(0)).cast("bigint").alias("n_paths"),
        F.lit(FAILED).alias("state"),
        F.format_string("Segment number %d exceeds available paths (%d)", F.col("segment"),
                        F.coalesce("n_paths", F.lit(0))).alias("error"))


def segment_status(manifest: DataFrame, scanned: DataFrame, matches: DataFrame) -> DataFrame:
    """One row per manifest segment: records read, matches written and a state.

    ``scanned``: (crawl_date, segment, n_records[, state, error]) per archive read, e.g. the
    ``wet`` source's status rows or a count of records. ``matches``: match rows.
    State: ``failed``/``partial`` from the scan when given; else ``done`` (>= 1 match),
    ``empty`` (read, no match), ``pending`` (never read).
    """
    scan_cols = scanned.columns
    # an archive read in several byte ranges has several scan rows: records add up, and the
    # worst range decides (failed > partial > read); a failure after some records is partial
    worst = F.max(F.when(F.col("state") == FAILED, 2).when(F.col("state") == PARTIAL, 1)) \
        if "state" in scan_cols else F.lit(None).cast("int")
    scan = scanned.groupBy(*SEGMENT_KEY).agg(
        F.sum("n_records").cast("bigint").alias("n_records"), worst.alias("worst"),
        # collect_set keeps this hash-based (a string max would sort); ranges' errors joined
        (F.array_join(F.array_sort(F.collect_set("error")), "; ") if "error" in scan_cols
         else F.lit(None).cast("string")).alias("error"),
        (F.sum("n_retries") if "n_retries" in scan_cols else F.lit(0)).cast("bigint").alias("n_retries"))
    scan = scan.withColumn("scan_state", F.when((F.col("worst") == 2) & (F.col("n_records") == 0), F.lit(FAILED))
                           .when(F.col("worst") >= 1, F.lit(PARTIAL))) \
        .withColumn("error", F.when(F.col("error") != "", F.col("error")))
    found = matches.groupBy(*SEGMENT_KEY).agg(F.count(F.lit(1)).alias("n_matches"))
    joined = manifest.select(*SEGMENT_KEY).join(scan, list(SEGMENT_KEY), "left") \
        .join(found, list(SEGMENT_KEY), "left")
    n_matches = F.coalesce("n_matches", F.lit(0)).cast("bigint")
    state = (F.when(F.col("scan_state").isin(FAILED, PARTIAL), F.col("scan_state"))
             .when(n_matches > 0, F.lit(DONE))
             .when(F.col("n_records").isNotNull(), F.lit(EMPTY))
             .otherwise(F.lit(PENDING)))
    return joined.select(*SEGMENT_KEY, F.coalesce("n_records", F.lit(0)).cast("bigint").alias("n_records"),
                         n_matches.alias("n_matches"), state.alias("state"), "error",
                         F.coalesce("n_retries", F.lit(0)).cast("bigint").alias("n_retries"))


def current_runs(status: DataFrame) -> DataFrame:
    """(crawl_date, segment, run_id) of the run that counts: the latest that finished the segment,
    else the latest. ``status`` holds every run's rows, with ``run_id``."""
    finished = F.max(F.when(F.col("state").isin(*FINISHED_STATES), F.col("run_id")))
    return status.groupBy(*SEGMENT_KEY).agg(F.coalesce(finished, F.max("run_id")).alias("run_id"))


def run_summary(status: DataFrame) -> DataFrame:
    """Per crawl date: segments, segments by state, and "n of m segments successful"."""
    def n(state: str) -> F.Column:
        return F.count_if(F.col("state") == state).alias(f"n_{state}")
    ok = F.count_if(F.col("state").isin(*FINISHED_STATES))
    per = status.groupBy("crawl_date").agg(
        F.count(F.lit(1)).alias("n_segments"), ok.alias("n_successful"),
        *[n(x) for x in (DONE, EMPTY, PARTIAL, FAILED, PENDING)],
        F.sum("n_records").cast("bigint").alias("n_records"), F.sum("n_matches").cast("bigint").alias("n_matches"))
    return per.withColumn("summary", F.format_string("%d of %d segments successful", "n_successful", "n_segments"))


def quarantined(every_run: DataFrame, max_failures: int = 3) -> DataFrame:
    """Segments that ``max_failures`` runs or more tried, all in vain: (crawl_date, segment, n_failures, last_run,
    error of the last). ``every_run``: the status rows of all runs (``read_status(every_run=True)``). A segment
    that any run finished, or read in part, is none of them."""
    failed = F.col("state") == FAILED
    return every_run.groupBy(*SEGMENT_KEY).agg(
        F.count_if(failed).alias("n_failures"), F.count_if(~failed).alias("_other"), F.max("run_id").alias("last_run"),
        F.max_by("error", F.when(failed, F.col("run_id"))).alias("error")) \
        .where((F.col("n_failures") >= max_failures) & (F.col("_other") == 0)).drop("_other")


def remaining_segments(manifest: DataFrame, status: DataFrame, quarantine: DataFrame | None = None) -> DataFrame:
    """Manifest segments not yet finished (anti join with done/empty status); without those in ``quarantine``
    (:func:`quarantined`), which another run would only wait for again."""
    finished = status.where(F.col("state").isin(*FINISHED_STATES)).select(*SEGMENT_KEY)
    left = manifest.join(finished, list(SEGMENT_KEY), "left_anti")
    return left if quarantine is None else left.join(quarantine.select(*SEGMENT_KEY), list(SEGMENT_KEY), "left_anti")


def segment_ranges(segments: DataFrame, span: int = RANGE_SPAN) -> DataFrame:
    """(crawl_date, segment) -> maximal ranges of consecutive segments: (crawl_date, first_segment, last_segment, n_segments).

    Islands are found inside spans of ``span`` segments, so a window holds a span at most, whatever the crawl's
    size. Only islands that touch an edge of their span, two a span at most, are then joined with their
    neighbours in a window over the crawl."""
    span_of = F.col("segment") - F.pmod("segment", F.lit(span))
    rows = segments.select("crawl_date", F.col("segment").cast("bigint").alias("segment")).distinct().withColumn("_span", span_of)
    inside = Window.partitionBy("crawl_date", "_span").orderBy("segment")
    islands = rows.withColumn("_island", F.col("segment") - F.row_number().over(inside)) \
        .groupBy("crawl_date", "_span", "_island").agg(F.min("segment").alias("first_segment"), F.max("segment").alias("last_segment"))
    at_edge = (F.col("first_segment") == F.col("_span")) | (F.col("last_segment") == F.col("_span") + span - 1)
    along = Window.partitionBy("crawl_date").orderBy("first_segment")
    goes_on = F.col("first_segment") == F.lag("last_segment").over(along) + 1
    edges = islands.where(at_edge).withColumn("_new", F.when(goes_on, 0).otherwise(1)) \
        .withColumn("_range", F.sum("_new").over(along)) \
        .groupBy("crawl_date", "_range").agg(F.min("first_segment").alias("first_segment"), F.max("last_segment").alias("last_segment"))
    cols = ["crawl_date", "first_segment", "last_segment"]
    return islands.where(~at_edge).select(*cols).unionByName(edges.select(*cols)) \
        .withColumn("n_segments", F.col("last_segment") - F.col("first_segment") + 1)


def remaining_ranges(manifest: DataFrame, status: DataFrame, quarantine: DataFrame | None = None,
                     span: int = RANGE_SPAN) -> DataFrame:
    """The segments still to run as ranges a run can be started with."""
    return segment_ranges(remaining_segments(manifest, status, quarantine), span)


def progress_by_crawl(crawls: DataFrame, manifest: DataFrame, status: DataFrame) -> DataFrame:
    """Per crawl date: files listed, manifest segments (the total), finished, remaining, %.

    The manifest is the total; the crawl list is shown beside it as a cross-check. A date with
    no manifest has total 0, 0 % and state ``no_manifest``.
    """
    listed = crawls.groupBy("crawl_date").agg(F.sum("n_files").cast("bigint").alias("n_listed"))
    totals = manifest.groupBy("crawl_date").agg(F.count(F.lit(1)).alias("n_segments"))
    done = status.where(F.col("state").isin(*FINISHED_STATES)) \
        .groupBy("crawl_date").agg(F.count(F.lit(1)).alias("n_finished"))
    j = listed.join(totals, "crawl_date", "full").join(done, "crawl_date", "left")
    total = F.coalesce("n_segments", F.lit(0)).cast("bigint")
    fin = F.coalesce("n_finished", F.lit(0)).cast("bigint")
    return j.select(
        "crawl_date", F.col("n_listed"), total.alias("n_segments"), fin.alias("n_finished"),
        (total - fin).alias("n_remaining"), percent_floor(fin, total).alias("pct_complete"),
        F.when(total <= 0, F.lit("no_manifest")).when(fin >= total, F.lit("complete"))
        .otherwise(F.lit("in_progress")).alias("state"))


def progress_overall(progress: DataFrame) -> DataFrame:
    """One row over all crawls of :func:`progress_by_crawl`: files listed, segments, finished, remaining,
    percent, crawls, crawls complete."""
    per = progress.agg(
        F.count(F.lit(1)).alias("n_crawls"), F.count_if(F.col("state") == "complete").alias("n_complete"),
        F.coalesce(F.sum("n_listed"), F.lit(0)).cast("bigint").alias("n_listed"),
        F.coalesce(F.sum("n_segments"), F.lit(0)).cast("bigint").alias("n_segments"),
        F.coalesce(F.sum("n_finished"), F.lit(0)).cast("bigint").alias("n_finished"))
    return per.withColumn("n_remaining", F.col("n_segments") - F.col("n_finished")) \
        .withColumn("pct_complete", percent_floor(F.col("n_finished"), F.col("n_segments")))


def eta_overall(progress: DataFrame, elapsed_seconds: int) -> DataFrame:
    """Rate and ETA over all crawls together, as :func:`eta` computes them for each."""
    every = progress_overall(progress).select(F.lit("all").alias("crawl_date"), "n_finished", "n_remaining")
    return eta(every, elapsed_seconds).drop("crawl_date")


def elapsed_breakdown(df: DataFrame, seconds: str = "elapsed_s") -> DataFrame:
    """Days / hours / minutes of a duration column and its ``Xd Yh Zm`` text (status script)."""
    parts = seconds_breakdown(F.col(seconds))
    return df.select("*", parts["days"].alias("elapsed_days"), parts["hours"].alias("elapsed_hours"),
                     parts["minutes"].alias("elapsed_minutes"),
                     F.when(F.col(seconds).isNotNull(),
                            dhm_text(parts["days"], parts["hours"], parts["minutes"]))
                     .alias("elapsed_text"))


def eta(progress: DataFrame, elapsed_seconds: int) -> DataFrame:
    """Rate (files/min, integer) and ETA per crawl, as the status script computes them.

    ``elapsed_seconds`` is a parameter (the wall time the run has taken so far).
    """
    el = F.lit(elapsed_seconds).cast("bigint")
    done, rem = F.col("n_finished"), F.col("n_remaining")
    active = (done > 0) & (rem > 0) & (el > 0)
    rate = F.when(active, idiv(done * 60, el))
    mins = F.when(rate > 0, idiv(rem, rate))
    parts = minutes_breakdown(mins)
    text = (F.when(~active, F.lit("waiting"))
            .when(rate <= 0, F.lit("calculating"))
            .otherwise(dhm_text(parts["days"], parts["hours"], parts["minutes"])))
    return progress.select("crawl_date", "n_finished", "n_remaining",
                           rate.alias("rate_per_min"), mins.alias("eta_minutes"),
                           parts["days"].alias("eta_days"), parts["hours"].alias("eta_hours"),
                           parts["minutes"].alias("eta_mins"), text.alias("eta_text"))


# Fixed value: seconds per segment the monitor assumes until runtimes are known.
DEFAULT_SEGMENT_SECONDS = 300


def monitor_eta(progress: DataFrame, runtimes: DataFrame,
                default_seconds: int = DEFAULT_SEGMENT_SECONDS) -> DataFrame:
    """Hours left per crawl = remaining segments x seconds per segment div 3600.

    Seconds per segment is the crawl's mean measured runtime (``runtime_summary``: crawl_date,
    avg_s), whole seconds, or ``default_seconds`` when the crawl has none yet. Both sides
    hold one row per crawl."""
    est = runtimes.select("crawl_date", F.floor("avg_s").cast("bigint").alias("est_s"))
    j = progress.select("crawl_date", "n_remaining").join(est, "crawl_date", "left")
    sec = F.coalesce("est_s", F.lit(default_seconds).cast("bigint"))
    return j.select("crawl_date", "n_remaining", sec.alias("sec_per_segment"),
                    idiv(F.col("n_remaining") * sec, F.lit(3600)).alias("eta_hours"))
