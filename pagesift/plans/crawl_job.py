"""End-to-end crawl filtering job: manifest -> archives -> matches + per-segment status.

One Spark job replaces the reference's per-date loop of cluster array tasks::

    manifest (slice) --hash(crawl_date, segment)--> archive reader (mapInArrow, header filter)
        -> staged table (candidate pages + one status row per archive)  one pass over the archives
        -> postcode_pages (regex once, semi join, one shuffle of matched pages)
        -> Parquet partitioned by crawl_date and run_id
        -> segment_status(manifest, scan status, the run's matches)   done / empty / partial / ...

The staged scan holds only records that passed the cheap header tests (``.co.uk/``
and ``eng``) plus a row per archive, so both outputs come from a single read of the
archives. It is a Parquet table in the cluster's shared ``spark.checkpoint.dir``, so a lost
executor costs no re-read of archives.

Runs add up: each writes under its own ``run_id``, and ``sinks.read_matches`` / ``read_status`` keep the
latest run that finished a segment. Slices of one crawl, re-runs and ``remaining_segments`` fed
back all go into the same two folders.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import CONVERSION, LANGUAGE, POSTCODE_PREFIX, UK_HOST_MARK, page_predicate
from ..operators.match import postcode_pages, postcode_pages_by_key
from ..operators.dealing import deal_by_size
from ..operators.outputs import postcode_sketches
from ..operators.runs import PARTIAL, SEGMENT_KEY, manifest_segments, segment_out_of_range, segment_status
from ..session import staged as stage
from ..sources.sinks import clear_run, new_run_id, read_matches, read_status, write_matches, write_sketches, write_status
from ..sources.retry import Retry
from ..sources.wet import ArchiveStore, scan_manifest, with_sizes

FILES_PER_TASK = 4          # archives of 100-150 MB each: minutes per task, cheap to retry


@dataclass
class JobResult:
    """Where a run wrote, and its id; ``status`` and ``matches`` are what counts over all runs."""
    matches_path: str
    status_path: str
    run_id: int
    status: DataFrame
    matches: DataFrame


def requested_segments(manifest: DataFrame, first: int, last: int) -> DataFrame:
    """(crawl_date, segment) for segments ``first`` to ``last`` of every crawl in the manifest."""
    return manifest.select("crawl_date").distinct().select(
        "crawl_date", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("segment"))


def _finish(spark, manifest, beyond, scanned, matches, output_dir, status_dir, run_id, sketch_dir=None) -> JobResult:
    """Write the run's matches, then its status rows, counted from its own matches. What an earlier attempt under
    the same id left is taken away before, its status first."""
    for where in (status_dir, output_dir, *([sketch_dir] if sketch_dir else [])):
        clear_run(spark, where, run_id)
    write_matches(matches, output_dir, run_id)
    written = spark.read.schema(matches.schema.add("run_id", "long")).parquet(output_dir) \
        .where(F.col("run_id") == run_id)
    if sketch_dir:
        write_sketches(postcode_sketches(written), sketch_dir, run_id)
    status = segment_status(manifest.select("crawl_date", "segment"), scanned, written.select("crawl_date", "segment"))
    if beyond is not None:
        status = status.unionByName(beyond.select(
            "crawl_date", "segment", F.lit(0).cast("bigint").alias("n_records"),
            F.lit(0).cast("bigint").alias("n_matches"), "state", "error", F.lit(0).cast("bigint").alias("n_retries")))
    write_status(status, status_dir, run_id)
    return JobResult(output_dir, status_dir, run_id, read_status(spark, status_dir),
                     read_matches(spark, output_dir, status_dir))


def _slice(manifest: DataFrame, task_id: int | None, segments_per_task: int, segment: int | None):
    """The manifest's part of a slice, and the requested segments beyond it as failed rows."""
    if task_id is None and segment is None:
        return manifest, None
    first = segment if segment is not None else task_id * segments_per_task
    last = first if segment is not None else first + segments_per_task - 1
    beyond = segment_out_of_range(requested_segments(manifest, first, last), manifest)
    return manifest.where(F.col("segment").between(first, last)), beyond


def filter_crawl(spark: SparkSession, manifest: DataFrame, lookup: DataFrame, output_dir: str,
                 status_dir: str, *, base_url: str | None = None, url_contains: str = UK_HOST_MARK,
                 language: str = LANGUAGE, prefix: str = POSTCODE_PREFIX, key: str = "pcds",
                 task_id: int | None = None, segments_per_task: int = 1, segment: int | None = None,
                 files_per_task: int = FILES_PER_TASK, num_partitions: int | None = None,
                 run_id: int | None = None, even: bool = True, retry: Retry = Retry(),
                 store: ArchiveStore | None = None, wide_lookup: bool = False, sketch_dir: str | None = None) -> JobResult:
    """Run the filter over every archive in ``manifest``, one task's slice of it, or one ``segment``.

    ``manifest``: crawl_date, segment, path. Paths are read as given, or joined to
    ``base_url`` when it is set (http(s) archives are streamed, never staged on local disk).
    Requested segments that a crawl's manifest doesn't have become ``failed`` status rows.
    Archives are dealt to tasks by their sizes (``even``; else by hash); one that can't be read after the attempts
    of ``retry`` becomes a ``failed`` row and stops no other. ``store`` opens and measures archives.
    ``wide_lookup`` matches by key (``postcode_pages_by_key``), for lookups that can't be broadcast; ``sketch_dir`` gets the
    run's postcode sketches.
    """
    run_id = run_id or new_run_id()
    manifest, beyond = _slice(manifest, task_id, segments_per_task, segment)
    located, location = (manifest_segments(manifest, base_url), "file_url") if base_url else (manifest, "path")
    if even:
        located = stage(with_sizes(located, location, store), "sizes")
    n = num_partitions or max(1, -(-located.count() // files_per_task))
    if even:
        located = deal_by_size(located, "bytes", SEGMENT_KEY, n)
    scan = stage(scan_manifest(located, location=location, rec_type=CONVERSION, uri_contains=url_contains,
                               language=language, num_partitions=n, retry=retry, store=store), "scan")
    match = postcode_pages_by_key if wide_lookup else postcode_pages
    matches = match(scan.where(~F.col("is_status")), lookup, url_contains=url_contains,
                    language=language, prefix=prefix, key=key)
    scanned = scan.where(F.col("is_status")).select(
        "crawl_date", "segment", "n_records",
        F.when(F.col("state").isin("partial", "failed"), F.col("state")).alias("state"), "error", "n_retries")
    return _finish(spark, manifest, beyond, scanned, matches, output_dir, status_dir, run_id, sketch_dir)


def filter_records(spark: SparkSession, records: DataFrame, manifest: DataFrame, lookup: DataFrame,
                   output_dir: str, status_dir: str, *, url_contains: str = UK_HOST_MARK,
                   language: str = LANGUAGE, prefix: str = POSTCODE_PREFIX, key: str = "pcds",
                   task_id: int | None = None, segments_per_task: int = 1, segment: int | None = None,
                   run_id: int | None = None) -> JobResult:
    """The same job over records from any reader, e.g. the JVM-only ``read_wet_text`` on a glob
    in HDFS or an object store.

    One scan feeds both outputs: a narrow projection -- key and framing of every record, and type, URI,
    language and text only where the cheap header tests pass -- is staged as Parquet, where what
    is null costs next to nothing. A segment with a record that the reader could not frame
    (``framing_ok`` false) is ``partial``: it stays in ``remaining_segments``, to be read by
    ``filter_crawl``, whose reader frames by length.
    """
    run_id = run_id or new_run_id()
    manifest, beyond = _slice(manifest, task_id, segments_per_task, segment)
    if beyond is not None:
        records = records.join(manifest.select("crawl_date", "segment"), ["crawl_date", "segment"], "left_semi")
    cand = F.coalesce(page_predicate(url_contains=url_contains, lang=language), F.lit(False))
    framed = F.coalesce(F.col("framing_ok"), F.lit(True)) if "framing_ok" in records.columns else F.lit(True)
    staged = stage(records.select(
        "crawl_date", "segment", "record_no", cand.alias("is_candidate"), framed.alias("framed"),
        *[F.when(cand, F.col(c)).alias(c) for c in ("rec_type", "uri", "language", "text")]), "records")
    matches = postcode_pages(staged.where(F.col("is_candidate")), lookup, url_contains=url_contains,
                             language=language, prefix=prefix, key=key)
    cut = F.count_if(~F.col("framed"))
    scanned = staged.groupBy("crawl_date", "segment").agg(
        F.count(F.lit(1)).alias("n_records"), F.when(cut > 0, F.lit(PARTIAL)).alias("state"),
        F.when(cut > 0, F.format_string("%d records cut at an inner delimiter", cut)).alias("error"))
    return _finish(spark, manifest, beyond, scanned, matches, output_dir, status_dir, run_id)
