"""Registry of named queries over the planted relations, each with an independent SQL oracle.

Every query takes ``(spark, sf_dir)``, builds its inputs from the tables in ``sf_dir`` (see
``sources.planted``) and returns a DataFrame whose columns are aliased exactly like the
oracle's. Arrays are emitted joined with ``,`` and page text as is, so results compare by
value. The oracle SQL is written separately from the Spark code (general pattern plus prefix
filter instead of the narrowed pattern, ``IN`` subqueries instead of semi joins, ...), so
agreement checks the semantics, not a transcription.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import website
from ..operators import dealing, jobs, logs, match, outputs, report, runs
from ..session import ensure_checkpoint_dir
from ..sources import files, sinks, wet
from ..sources.planted import relation, table, with_relations
from ..sources.planted_archives import FaultyStore, planted_archives, record_no_from_id
from ..sources.retry import Retry
from .crawl_job import filter_crawl

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

# Parameters of the registered queries.
BASE_URL = "https://data.example.org/"
SEGMENTS_PER_TASK = 25
SLICE_TASK, SLICE_K = 1, 5
ELAPSED_S = 120
DEADLINE = "2024-01-20 00:00:00"


def register(name: str, oracle: str | None = None, relations: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = with_relations(oracle, *relations) if relations else oracle
        return fn
    return deco


# ---------------------------------------------------------------- shared inputs
def _wet(spark, d):
    return relation(spark, d, "wet_records")


def _pages(spark, d):
    return match.postcode_pages(_wet(spark, d), relation(spark, d, "postcode_lookup"))


def _crawls(spark, d):
    return runs.parse_crawl_list(relation(spark, d, "crawl_list_lines"))


def _scanned(spark, d):
    """Records read per archive (what the archive source reports in its status rows)."""
    return _wet(spark, d).groupBy("crawl_date", "segment").agg(F.count(F.lit(1)).alias("n_records"))


def _status(spark, d):
    return runs.segment_status(relation(spark, d, "archive_manifest"), _scanned(spark, d), _pages(spark, d))


def _joined(col: str) -> F.Column:
    return F.array_join(F.col(col), ",").alias(col)


def _job_folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/job-{uuid.uuid4().hex}"


def _job(spark, d, listed, where=None, **kw):
    where = where or _job_folder(spark)
    return filter_crawl(spark, listed, relation(spark, d, "postcode_lookup"), f"{where}/matches", f"{where}/status", **kw)


def _with_record_no(matches, spark, d):
    """Matches of planted archives under the planted record numbers, which each URI ends with."""
    return matches.select("crawl_date", "segment", F.regexp_extract("uri", "([0-9]+)$", 1).cast("bigint").alias("record_no"),
                          "uri", "website", _joined("postcodes"), "text")


# ---------------------------------------------------------------- oracle fragments (DuckDB)
O_UK = r"\b[A-Z]{1,2}[0-9][A-Z0-9]? [0-9][ABD-HJLNP-UW-Z]{2}\b"     # fixed value, spelled apart from the library's
O_WEBSITE = "replace(replace(regexp_replace(uri, '\\.uk/.*', '.uk'), 'https://', ''), 'http://', '')"
O_PP = f"""
pages AS (
  SELECT * FROM wet_records
  WHERE rec_type = 'conversion' AND contains(uri, '.co.uk/') AND language = 'eng'),
found AS (
  SELECT DISTINCT crawl_date, segment, record_no, pc FROM (
    SELECT crawl_date, segment, record_no, unnest(regexp_extract_all(text, '{O_UK}', 0)) AS pc FROM pages)),
matched AS (
  SELECT crawl_date, segment, record_no, string_agg(pc, ',' ORDER BY pc) AS postcodes
  FROM found
  WHERE starts_with(pc, 'BS') AND pc IN (SELECT pcds FROM postcode_lookup WHERE pcds IS NOT NULL)
  GROUP BY crawl_date, segment, record_no),
pp AS (
  SELECT p.crawl_date, p.segment, p.record_no, p.uri, {O_WEBSITE} AS website,
         m.postcodes, lower(p.text) AS text
  FROM pages p JOIN matched m
    ON p.crawl_date = m.crawl_date AND p.segment = m.segment AND p.record_no = m.record_no)"""
O_STATUS = """
scanned AS (SELECT crawl_date, segment, count(*) AS n_records FROM wet_records GROUP BY ALL),
hits AS (SELECT crawl_date, segment, count(*) AS n_matches FROM pp GROUP BY ALL),
status AS (
  SELECT m.crawl_date, m.segment, coalesce(s.n_records, 0)::BIGINT AS n_records,
         coalesce(h.n_matches, 0)::BIGINT AS n_matches,
         CASE WHEN coalesce(h.n_matches, 0) > 0 THEN 'done'
              WHEN s.n_records IS NOT NULL THEN 'empty' ELSE 'pending' END AS state
  FROM archive_manifest m
  LEFT JOIN scanned s ON m.crawl_date = s.crawl_date AND m.segment = s.segment
  LEFT JOIN hits h ON m.crawl_date = h.crawl_date AND m.segment = h.segment)"""
O_CRAWLS = r"""
crawls AS (
  SELECT line_no, regexp_extract(line, '^\s*(\S+)', 1) AS crawl_date,
         CAST(regexp_extract(line, '^\s*(\S+)\s+(.*?)\s*$', 2) AS BIGINT) AS n_files
  FROM crawl_list_lines
  WHERE line IS NOT NULL AND regexp_extract(line, '^\s*(\S+)', 1) <> ''
    AND NOT starts_with(regexp_extract(line, '^\s*(\S+)', 1), '#')
    AND regexp_matches(regexp_extract(line, '^\s*(\S+)\s+(.*?)\s*$', 2), '^[0-9]+$'))"""
O_PROGRESS = """
listed AS (SELECT crawl_date, sum(n_files)::BIGINT AS n_listed FROM crawls GROUP BY ALL),
totals AS (SELECT crawl_date, count(*) AS n_segments FROM archive_manifest GROUP BY ALL),
fin AS (SELECT crawl_date, count(*) AS n_finished FROM status WHERE state IN ('done', 'empty') GROUP BY ALL),
progress AS (
  SELECT coalesce(l.crawl_date, t.crawl_date) AS crawl_date, l.n_listed,
         coalesce(t.n_segments, 0)::BIGINT AS n_segments, coalesce(f.n_finished, 0)::BIGINT AS n_finished
  FROM listed l FULL OUTER JOIN totals t ON l.crawl_date = t.crawl_date
  LEFT JOIN fin f ON f.crawl_date = coalesce(l.crawl_date, t.crawl_date))"""


def _o_duration(c: str) -> str:
    d = r"^([0-9]+)-([0-9]{1,2}):([0-9]{2}):([0-9]{2})$"
    h = r"^([0-9]{1,2}):([0-9]{2}):([0-9]{2})$"
    m = r"^([0-9]{1,2}):([0-9]{2})$"

    def g(p, i):
        return f"CAST(regexp_extract({c}, '{p}', {i}) AS BIGINT)"
    return (f"(CASE WHEN {c} IS NULL OR {c} = '' OR {c} = 'UNLIMITED' THEN 0::BIGINT "
            f"WHEN regexp_matches({c}, '{d}') THEN ({g(d, 1)} * 24 + {g(d, 2)}) * 3600 + {g(d, 3)} * 60 + {g(d, 4)} "
            f"WHEN regexp_matches({c}, '{h}') THEN {g(h, 1)} * 3600 + {g(h, 2)} * 60 + {g(h, 3)} "
            f"WHEN regexp_matches({c}, '{m}') THEN {g(m, 1)} * 60 + {g(m, 2)} "
            f"ELSE TRY_CAST({c} AS BIGINT) END)")


O_ERR_FLAGS = r"""
SELECT file, source_kind, line_no, line,
  CASE WHEN source_kind = 'err' THEN regexp_matches(line, '(?i)error|failed|exception|timeout')
       WHEN source_kind = 'log' THEN regexp_matches(line, '(?i)error|failed to download|error processing|logging.error')
       ELSE false END AS is_error,
  CASE WHEN source_kind = 'err' THEN regexp_matches(line, '(?i)\b(warning|low|insufficient)\b')
       WHEN source_kind = 'log' THEN regexp_matches(line, '(?i)warning|no records|low disk')
       ELSE false END AS is_warning
FROM log_lines"""
O_SUCCESS = r"""
SELECT file, source_kind,
  len(regexp_extract_all(line, 'Completed processing segment', 0)) AS n_marks,
  CASE WHEN regexp_matches(line, 'Completed processing segment (\d+): (\d+) records')
       THEN TRY_CAST(regexp_extract(line, 'Completed processing segment (\d+): (\d+) records', 2) AS BIGINT) END AS n_records
FROM log_lines WHERE source_kind IN ('log', 'out')"""
O_COVERAGE = """
rows_pc AS (
  SELECT w.crawl_date || '/' || CAST(w.segment AS VARCHAR) AS file,
         CASE WHEN pp.postcodes IS NOT NULL THEN 1 ELSE 0 END AS has_pc
  FROM wet_records w LEFT JOIN pp
    ON w.crawl_date = pp.crawl_date AND w.segment = pp.segment AND w.record_no = pp.record_no),
per_file AS (SELECT file, avg(has_pc) * 100 AS pct FROM rows_pc GROUP BY file)"""


O_RUNTIME = r"""
logged AS (
  SELECT file, line_no, strptime(line[1:19], '%Y-%m-%d %H:%M:%S') AS ts,
    split_part(line, ' ', 6) AS word, string_split(line, ' ') AS words FROM segment_log WHERE source_kind = 'log'),
started AS (
  SELECT file, line_no, ts, regexp_extract(list_last(words), '([0-9]+)segment', 1) AS crawl_date,
    CAST(regexp_extract(list_last(words), 'segment([0-9]+)', 1) AS BIGINT) AS segment FROM logged WHERE word = 'Downloading'),
finished AS (
  SELECT file, line_no, ts, CAST(rtrim(words[9], ':') AS BIGINT) AS segment FROM logged WHERE word = 'Completed'),
rt AS (
  SELECT f.file, s.crawl_date, f.segment, date_diff('second', s.ts, f.ts) AS runtime_s
  FROM finished f ASOF JOIN started s ON f.file = s.file AND f.segment = s.segment AND f.line_no > s.line_no)"""


# ================================================================ matching (flagship)
@register("postcode_pages", f"WITH {O_PP}\nSELECT * FROM pp",
          ("wet_records", "postcode_lookup"))
def q_postcode_pages(spark, d):
    """Filter -> extract -> BS prefix -> lookup -> output rows."""
    pp = _pages(spark, d)
    return pp.select("crawl_date", "segment", "record_no", "uri", "website", _joined("postcodes"), "text")


@register("archive_roundtrip", f"WITH {O_PP}\nSELECT * FROM pp", ("wet_records", "postcode_lookup"))
def q_archive_roundtrip(spark, d):
    """S5-S8 at scale: planted records written as WET archives by Spark, read back by the
    ``wet`` source, matched by the flagship operator -- must equal ``postcode_pages``."""
    out, _ = planted_archives(spark, _wet(spark, d), d)
    recs = wet.read_wet(spark, out, pushdown=True).withColumn("record_no", record_no_from_id())
    pp = match.postcode_pages(recs, relation(spark, d, "postcode_lookup"))
    return pp.select("crawl_date", "segment", "record_no", "uri", "website", _joined("postcodes"), "text")


@register("archive_status", f"WITH {O_PP},{O_STATUS}\nSELECT * FROM status",
          ("wet_records", "postcode_lookup", "archive_manifest"))
def q_archive_status(spark, d):
    """A1, A2, D4 from real archives: the job over the archives' manifest, one scan, then its status
    against every listed segment."""
    _, listed = planted_archives(spark, _wet(spark, d), d)
    res = _job(spark, d, listed)
    read = res.status.select("crawl_date", "segment", "n_records", "n_matches", "state")
    pending = runs.remaining_segments(relation(spark, d, "archive_manifest"), read).select(
        "crawl_date", "segment", F.lit(0).cast("bigint").alias("n_records"), F.lit(0).cast("bigint").alias("n_matches"),
        F.lit("pending").alias("state"))
    return read.unionByName(pending)


@register("compacted_run", f"WITH {O_PP}\nSELECT * FROM pp", ("wet_records", "postcode_lookup"))
def q_compacted_run(spark, d):
    """A slice, the rest, then a re-run of the slice; compacted in between and at the end, old runs removed: read
    back, the rows must equal ``postcode_pages``."""
    _, listed = planted_archives(spark, _wet(spark, d), d)
    where = _job_folder(spark)
    for task in (0, 1, 0):
        res = _job(spark, d, listed, where, task_id=task, segments_per_task=10)
        sinks.compact_matches(spark, res.matches_path, res.status_path)
    sinks.remove_compacted(spark, res.matches_path, res.status_path)
    return _with_record_no(sinks.read_matches(spark, res.matches_path, res.status_path), spark, d)


FAULTS = "CASE segment % 10 WHEN 2 THEN '#fails=2@300' WHEN 3 THEN '#fails=99@0' WHEN 6 THEN '.gone' WHEN 7 THEN '#cut=80' ELSE '' END"


@register("faulty_archives", f"""WITH {O_PP},{O_STATUS}
SELECT crawl_date, segment,
       CASE segment % 10 WHEN 3 THEN 0 WHEN 4 THEN 0 WHEN 6 THEN 0 WHEN 7 THEN n_records - 1 ELSE n_records END::BIGINT AS n_records,
       CASE segment % 10 WHEN 3 THEN 0 WHEN 4 THEN 0 WHEN 6 THEN 0 WHEN 7 THEN NULL ELSE n_matches END::BIGINT AS n_matches,
       CASE segment % 10 WHEN 3 THEN 'failed' WHEN 4 THEN 'failed' WHEN 6 THEN 'failed' WHEN 7 THEN 'partial' ELSE state END AS state,
       CASE segment % 10 WHEN 2 THEN 2 WHEN 3 THEN 4 ELSE 0 END::BIGINT AS n_retries
FROM status WHERE state <> 'pending'""", ("wet_records", "postcode_lookup", "archive_manifest"))
def q_faulty_archives(spark, d):
    """A job over planted archives of which some break for a while, some for good, some are missing, folders or cut
    short: every other archive is read whole, each has its state and its retries."""
    where, listed = planted_archives(spark, _wet(spark, d), d)
    path = F.when(F.col("segment") % 10 == 4, F.lit(where)).otherwise(F.concat("path", F.expr(FAULTS)))
    res = _job(spark, d, listed.withColumn("path", path), retry=Retry(first_wait=0.01), store=FaultyStore())
    return res.status.select("crawl_date", "segment", "n_records", "state", "n_retries",
                             F.when(F.col("segment") % 10 != 7, F.col("n_matches")).alias("n_matches"))


DEALT_TASKS = 16


@register("even_dealing", f"""
SELECT file_path, file_size, (start::HUGEINT * {DEALT_TASKS} // total)::INT AS task
FROM (SELECT *, sum(file_size) OVER () AS total, coalesce(sum(file_size) OVER (ORDER BY file_size DESC, file_path
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
      FROM (SELECT file_path, greatest(file_size, 1) AS file_size FROM output_listing))""", ("output_listing",))
def q_even_dealing(spark, d):
    """S5, array sizing: files dealt to tasks by size, the running sum taken over ranges of one sort."""
    listed = relation(spark, d, "output_listing").select("file_path", F.greatest("file_size", F.lit(1)).alias("file_size"))
    return dealing.deal_by_size(listed, "file_size", ("file_path",), DEALT_TASKS)


@register("sliced_run", f"WITH {O_PP}\nSELECT * FROM pp", ("wet_records", "postcode_lookup"))
def q_sliced_run(spark, d):
    """Two slices of every crawl and a re-run of the first into the same folders;
    read back they must equal ``postcode_pages``."""
    _, listed = planted_archives(spark, _wet(spark, d), d)
    where = _job_folder(spark)
    for task in (0, 1, 0):
        res = _job(spark, d, listed, where, task_id=task, segments_per_task=10)
    return _with_record_no(res.matches, spark, d)


@register("text_inputs", """
SELECT crawl_date, segment, path, NULL::BIGINT AS n_lines, NULL::VARCHAR AS file FROM archive_manifest
UNION ALL SELECT NULL, NULL, NULL, count(*), file FROM log_lines GROUP BY file""", ("archive_manifest", "log_lines"))
def q_text_inputs(spark, d):
    """Manifests and logs written as text files by Spark, read back with line numbers."""
    where = _job_folder(spark)
    relation(spark, d, "archive_manifest").select(
        "path", F.concat(F.col("crawl_date"), F.lit("_wet.paths")).alias("name"), F.col("segment").alias("no")) \
        .repartition("name").sortWithinPartitions("name", "no").select("name", F.col("path").alias("value")) \
        .write.partitionBy("name").text(f"{where}/manifests")
    relation(spark, d, "log_lines").select("file", "line_no", "line").repartition("file") \
        .sortWithinPartitions("file", "line_no").select("file", F.col("line").alias("value")) \
        .write.partitionBy("file").text(f"{where}/logs")
    by_folder = F.regexp_extract("file_path", "name=([0-9]+)", 1)
    manifest = files.read_lines(spark, f"{where}/manifests", recursive=True)
    lines = files.read_lines(spark, f"{where}/logs", recursive=True)
    return manifest.select(by_folder.alias("crawl_date"), F.col("line_no").cast("int").alias("segment"), F.col("line").alias("path"),
                           F.lit(None).cast("bigint").alias("n_lines"), F.lit(None).cast("string").alias("file")) \
        .unionByName(lines.groupBy(F.regexp_extract("file_path", "file=([^/]+)/", 1).alias("file")).agg(
            (F.max("line_no") + 1).alias("n_lines")).select(
            F.lit(None).cast("string").alias("crawl_date"), F.lit(None).cast("int").alias("segment"),
            F.lit(None).cast("string").alias("path"), "n_lines", "file"))


@register("pages_by_key", f"WITH {O_PP}\nSELECT * FROM pp", ("wet_records", "postcode_lookup"))
def q_pages_by_key(spark, d):
    """J1 beyond broadcast: a Bloom filter of the lookup in the scan, a semi join of keys, text attached after it."""
    pp = match.postcode_pages_by_key(_wet(spark, d), relation(spark, d, "postcode_lookup"))
    return pp.select("crawl_date", "segment", "record_no", "uri", "website", _joined("postcodes"), "text")


@register("page_filter", f"""
SELECT crawl_date, segment, record_no, uri, {O_WEBSITE} AS website, language,
       length(text) AS n_chars, text
FROM wet_records WHERE rec_type = 'conversion' AND contains(uri, '.co.uk/') AND language = 'eng'""",
          ("wet_records",))
def q_page_filter(spark, d):
    """Conversion records under .co.uk/ tagged eng."""
    return match.page_filter(_wet(spark, d)).select(
        "crawl_date", "segment", "record_no", "uri", website("uri").alias("website"), "language",
        F.length("text").alias("n_chars"), "text")


@register("uk_postcodes", f"""
SELECT crawl_date, segment, record_no,
       array_to_string(list_sort(list_distinct(regexp_extract_all(text, '{O_UK}', 0))), ',') AS postcodes,
       len(list_distinct(regexp_extract_all(text, '{O_UK}', 0))) AS n_postcodes
FROM wet_records WHERE len(regexp_extract_all(text, '{O_UK}', 0)) > 0""", ("wet_records",))
def q_uk_postcodes(spark, d):
    """Every UK-form postcode per record, distinct and sorted."""
    r = match.record_postcodes(_wet(spark, d))
    return r.select("crawl_date", "segment", "record_no", _joined("postcodes"),
                    F.size("postcodes").alias("n_postcodes"))


@register("bs_postcodes", f"""
SELECT DISTINCT crawl_date, segment, record_no, pc AS postcode FROM (
  SELECT crawl_date, segment, record_no, unnest(regexp_extract_all(text, '{O_UK}', 0)) AS pc FROM wet_records)
WHERE starts_with(pc, 'BS')""", ("wet_records",))
def q_bs_postcodes(spark, d):
    """postcodes of the BS area, one row per (record, postcode)."""
    return match.prefixed_postcodes(_wet(spark, d))


@register("lookup_match", f"""
SELECT DISTINCT crawl_date, segment, record_no, pc AS postcode FROM (
  SELECT crawl_date, segment, record_no, unnest(regexp_extract_all(text, '{O_UK}', 0)) AS pc FROM wet_records)
WHERE starts_with(pc, 'BS') AND pc IN (SELECT pcds FROM postcode_lookup WHERE pcds IS NOT NULL)""",
          ("wet_records", "postcode_lookup"))
def q_lookup_match(spark, d):
    """(record, postcode) pairs present in the reference list."""
    return match.lookup_match(_wet(spark, d), relation(spark, d, "postcode_lookup"))


@register("extract_website", f"""
SELECT crawl_date, segment, record_no, uri, {O_WEBSITE} AS website FROM wet_records WHERE uri IS NOT NULL""",
          ("wet_records",))
def q_extract_website(spark, d):
    """Website of every record URI."""
    return _wet(spark, d).where(F.col("uri").isNotNull()).select(
        "crawl_date", "segment", "record_no", "uri", website("uri").alias("website"))


@register("lower_text", """
SELECT crawl_date, segment, record_no, lower(text) AS text FROM wet_records WHERE rec_type = 'conversion'""",
          ("wet_records",))
def q_lower_text(spark, d):
    """C4: lower-cased text of conversion records."""
    return match.lower_text(_wet(spark, d))


# ================================================================ crawl list and manifest
@register("crawl_list", f"WITH {O_CRAWLS}\nSELECT line_no, crawl_date, n_files FROM crawls",
          ("crawl_list_lines",))
def q_crawl_list(spark, d):
    """Crawl-list lines -> (crawl_date, n_files)."""
    return _crawls(spark, d).select("line_no", "crawl_date", "n_files")


@register("workload_total", f"""WITH {O_CRAWLS}
SELECT count(*) AS n_crawl_lines, count(DISTINCT crawl_date) AS n_crawl_dates,
       coalesce(sum(n_files), 0)::BIGINT AS total_files FROM crawls""", ("crawl_list_lines",))
def q_workload_total(spark, d):
    """Total files and crawl dates in the list."""
    return runs.workload_total(_crawls(spark, d))


@register("coverage_gap", f"""WITH {O_CRAWLS}
SELECT crawl_date, n_files, n_files // {SEGMENTS_PER_TASK} AS n_tasks,
       n_files % {SEGMENTS_PER_TASK} AS uncovered, n_files // {SEGMENTS_PER_TASK} > 1 AS has_array
FROM crawls""", ("crawl_list_lines",))
def q_coverage_gap(spark, d):
    """Array tasks per crawl and the tail of files they never cover."""
    return runs.coverage_gap(_crawls(spark, d), SEGMENTS_PER_TASK)


@register("manifest_segments", f"""
SELECT crawl_date, segment, path,
       '{BASE_URL}' || regexp_replace(trim(path), '^/+', '') AS file_url
FROM archive_manifest""", ("archive_manifest",))
def q_manifest_segments(spark, d):
    """Manifest segments with their archive URL."""
    m = runs.manifest_segments(relation(spark, d, "archive_manifest"), BASE_URL)
    return m.select("crawl_date", "segment", "path", "file_url")


@register("segment_label", """
SELECT crawl_date, segment, printf('%05d', segment) AS segment_label,
       'crawldata' || crawl_date || 'segment' || printf('%05d', segment) || '.parquet' AS output_file
FROM archive_manifest""", ("archive_manifest",))
def q_segment_label(spark, d):
    """Zero-padded segment label and output file name."""
    m = runs.manifest_segments(relation(spark, d, "archive_manifest"), BASE_URL)
    return m.select("crawl_date", "segment", "segment_label", "output_file")


@register("segment_slice", f"""
SELECT crawl_date, segment, path FROM archive_manifest
WHERE segment BETWEEN {SLICE_TASK * SLICE_K} AND {SLICE_TASK * SLICE_K + SLICE_K - 1}""", ("archive_manifest",))
def q_segment_slice(spark, d):
    """the segments one array task processes."""
    return runs.segment_slice(relation(spark, d, "archive_manifest"), SLICE_TASK, SLICE_K) \
        .select("crawl_date", "segment", "path")


@register("segment_out_of_range", """
WITH requested AS (
  SELECT DISTINCT CASE WHEN event_id % 2 = 0 THEN '202104' ELSE '202110' END AS crawl_date,
         CAST(floor(event_id / 2) AS INTEGER) AS segment FROM events),
sizes AS (SELECT crawl_date, count(*) AS n_paths FROM archive_manifest GROUP BY ALL)
SELECT r.crawl_date, r.segment, coalesce(s.n_paths, 0)::BIGINT AS n_paths, 'failed' AS state,
       printf('Segment number %d exceeds available paths (%d)', r.segment, coalesce(s.n_paths, 0)) AS error
FROM requested r LEFT JOIN sizes s ON r.crawl_date = s.crawl_date
WHERE NOT EXISTS (SELECT 1 FROM archive_manifest m WHERE m.crawl_date = r.crawl_date AND m.segment = r.segment)""",
          ("archive_manifest",))
def q_segment_out_of_range(spark, d):
    """requested segments beyond the manifest are failed, with the reference's message."""
    ev = table(spark, d, "events")
    requested = ev.select(
        F.when(F.col("event_id") % 2 == 0, F.lit("202104")).otherwise(F.lit("202110")).alias("crawl_date"),
        F.floor(F.col("event_id") / 2).cast("int").alias("segment"))
    return runs.segment_out_of_range(requested, relation(spark, d, "archive_manifest"))


# ================================================================ run reconciliation
@register("segment_status", f"WITH {O_PP},{O_STATUS}\nSELECT * FROM status",
          ("wet_records", "postcode_lookup", "archive_manifest"))
def q_segment_status(spark, d):
    """Per manifest segment records read, matches and state (empty counts as done)."""
    return _status(spark, d).select("crawl_date", "segment", "n_records", "n_matches", "state")


@register("remaining_segments", f"""WITH {O_PP},{O_STATUS}
SELECT m.crawl_date, m.segment, m.path FROM archive_manifest m
WHERE NOT EXISTS (SELECT 1 FROM status s WHERE s.state IN ('done', 'empty')
                  AND s.crawl_date = m.crawl_date AND s.segment = m.segment)""",
          ("wet_records", "postcode_lookup", "archive_manifest"))
def q_remaining_segments(spark, d):
    """The manifest segments still to run."""
    return runs.remaining_segments(relation(spark, d, "archive_manifest"), _status(spark, d)) \
        .select("crawl_date", "segment", "path")


@register("remaining_ranges", f"""WITH {O_PP},{O_STATUS},
todo AS (SELECT crawl_date, segment FROM status WHERE state NOT IN ('done', 'empty')),
firsts AS (SELECT crawl_date, segment, row_number() OVER (PARTITION BY crawl_date ORDER BY segment) AS k FROM todo t
  WHERE NOT EXISTS (SELECT 1 FROM todo p WHERE p.crawl_date = t.crawl_date AND p.segment = t.segment - 1)),
lasts AS (SELECT crawl_date, segment, row_number() OVER (PARTITION BY crawl_date ORDER BY segment) AS k FROM todo t
  WHERE NOT EXISTS (SELECT 1 FROM todo p WHERE p.crawl_date = t.crawl_date AND p.segment = t.segment + 1))
SELECT f.crawl_date, f.segment::BIGINT AS first_segment, l.segment::BIGINT AS last_segment, (l.segment - f.segment + 1)::BIGINT AS n_segments
FROM firsts f JOIN lasts l USING (crawl_date, k)""", ("wet_records", "postcode_lookup", "archive_manifest"))
def q_remaining_ranges(spark, d):
    """The segments still to run as ranges."""
    return runs.remaining_ranges(relation(spark, d, "archive_manifest"), _status(spark, d), span=64)


@register("progress_by_crawl", f"""WITH {O_PP},{O_STATUS},{O_CRAWLS},{O_PROGRESS}
SELECT crawl_date, n_listed, n_segments, n_finished, n_segments - n_finished AS n_remaining,
       CASE WHEN n_segments <= 0 THEN 0 ELSE n_finished * 100 // n_segments END AS pct_complete,
       CASE WHEN n_segments <= 0 THEN 'no_manifest' WHEN n_finished >= n_segments THEN 'complete'
            ELSE 'in_progress' END AS state
FROM progress""", ("wet_records", "postcode_lookup", "archive_manifest", "crawl_list_lines"))
def q_progress_by_crawl(spark, d):
    """Per crawl date, listed files vs. manifest segments finished."""
    return runs.progress_by_crawl(_crawls(spark, d), relation(spark, d, "archive_manifest"), _status(spark, d))


@register("eta_breakdown", f"""WITH {O_PP},{O_STATUS},{O_CRAWLS},{O_PROGRESS},
p2 AS (
  SELECT crawl_date, n_finished, n_segments - n_finished AS n_remaining,
         n_finished > 0 AND n_segments - n_finished > 0 AND {ELAPSED_S} > 0 AS active FROM progress),
p3 AS (SELECT *, CASE WHEN active THEN n_finished * 60 // {ELAPSED_S} END AS rate_per_min FROM p2),
p4 AS (SELECT *, CASE WHEN rate_per_min > 0 THEN n_remaining // rate_per_min END AS eta_minutes FROM p3),
p5 AS (SELECT *, eta_minutes // 60 // 24 AS eta_days, (eta_minutes // 60) % 24 AS eta_hours,
              eta_minutes % 60 AS eta_mins FROM p4)
SELECT crawl_date, n_finished, n_remaining, rate_per_min, eta_minutes, eta_days, eta_hours, eta_mins,
  CASE WHEN NOT active THEN 'waiting' WHEN rate_per_min <= 0 THEN 'calculating'
       WHEN eta_days > 0 THEN printf('%dd %dh %dm', eta_days, eta_hours, eta_mins)
       WHEN eta_hours > 0 THEN printf('%dh %dm', eta_hours, eta_mins)
       ELSE printf('%dm', eta_mins) END AS eta_text
FROM p5""", ("wet_records", "postcode_lookup", "archive_manifest", "crawl_list_lines"))
def q_eta_breakdown(spark, d):
    """files/min, minutes left and its d/h/m split per crawl."""
    progress = runs.progress_by_crawl(_crawls(spark, d), relation(spark, d, "archive_manifest"), _status(spark, d))
    return runs.eta(progress, ELAPSED_S)


@register("monitor_eta", f"""WITH {O_PP},{O_STATUS},{O_CRAWLS},{O_PROGRESS},{O_RUNTIME},
est AS (SELECT crawl_date, floor(avg(runtime_s))::BIGINT AS est_s FROM rt GROUP BY crawl_date)
SELECT p.crawl_date, p.n_segments - p.n_finished AS n_remaining,
       coalesce(e.est_s, 300) AS sec_per_segment,
       (p.n_segments - p.n_finished) * coalesce(e.est_s, 300) // 3600 AS eta_hours
FROM progress p LEFT JOIN est e ON p.crawl_date = e.crawl_date""",
          ("wet_records", "postcode_lookup", "archive_manifest", "crawl_list_lines", "segment_log"))
def q_monitor_eta(spark, d):
    """A14 (monitor form): remaining segments x measured seconds per segment, in hours."""
    progress = runs.progress_by_crawl(_crawls(spark, d), relation(spark, d, "archive_manifest"),
                                      _status(spark, d))
    summary = logs.runtime_summary(logs.segment_runtime(relation(spark, d, "segment_log")))
    return runs.monitor_eta(progress, summary)


@register("progress_overall", f"""WITH {O_PP},{O_STATUS},{O_CRAWLS},{O_PROGRESS}
SELECT count(*) AS n_crawls, count(*) FILTER (WHERE n_segments > 0 AND n_finished >= n_segments) AS n_complete,
       coalesce(sum(n_listed), 0)::BIGINT AS n_listed, sum(n_segments)::BIGINT AS n_segments,
       sum(n_finished)::BIGINT AS n_finished, (sum(n_segments) - sum(n_finished))::BIGINT AS n_remaining,
       CASE WHEN sum(n_segments) <= 0 THEN 0 ELSE (sum(n_finished) * 100 // sum(n_segments))::BIGINT END AS pct_complete
FROM progress""", ("wet_records", "postcode_lookup", "archive_manifest", "crawl_list_lines"))
def q_progress_overall(spark, d):
    """Progress over all crawls."""
    return runs.progress_overall(runs.progress_by_crawl(
        _crawls(spark, d), relation(spark, d, "archive_manifest"), _status(spark, d)))


@register("eta_overall", f"""WITH {O_PP},{O_STATUS},{O_CRAWLS},{O_PROGRESS},
p2 AS (SELECT sum(n_finished)::BIGINT AS n_finished, (sum(n_segments) - sum(n_finished))::BIGINT AS n_remaining FROM progress),
p3 AS (SELECT *, CASE WHEN n_finished > 0 AND n_remaining > 0 THEN n_finished * 60 // {ELAPSED_S} END AS rate_per_min FROM p2),
p4 AS (SELECT *, CASE WHEN rate_per_min > 0 THEN n_remaining // rate_per_min END AS eta_minutes FROM p3),
p5 AS (SELECT *, eta_minutes // 60 // 24 AS eta_days, (eta_minutes // 60) % 24 AS eta_hours,
              eta_minutes % 60 AS eta_mins FROM p4)
SELECT n_finished, n_remaining, rate_per_min, eta_minutes, eta_days, eta_hours, eta_mins,
  CASE WHEN n_finished = 0 OR n_remaining = 0 THEN 'waiting' WHEN rate_per_min <= 0 THEN 'calculating'
       WHEN eta_days > 0 THEN printf('%dd %dh %dm', eta_days, eta_hours, eta_mins)
       WHEN eta_hours > 0 THEN printf('%dh %dm', eta_hours, eta_mins)
       ELSE printf('%dm', eta_mins) END AS eta_text
FROM p5""", ("wet_records", "postcode_lookup", "archive_manifest", "crawl_list_lines"))
def q_eta_overall(spark, d):
    """Rate and ETA over all crawls."""
    progress = runs.progress_by_crawl(_crawls(spark, d), relation(spark, d, "archive_manifest"), _status(spark, d))
    return runs.eta_overall(progress, ELAPSED_S)


@register("run_summary", f"""WITH {O_PP},{O_STATUS}
SELECT crawl_date, count(*) AS n_segments, count(*) FILTER (WHERE state IN ('done', 'empty')) AS n_successful,
       count(*) FILTER (WHERE state = 'done') AS n_done, count(*) FILTER (WHERE state = 'empty') AS n_empty,
       0::BIGINT AS n_partial, 0::BIGINT AS n_failed, count(*) FILTER (WHERE state = 'pending') AS n_pending,
       sum(n_records)::BIGINT AS n_records, sum(n_matches)::BIGINT AS n_matches,
       printf('%d of %d segments successful', count(*) FILTER (WHERE state IN ('done', 'empty')), count(*)) AS summary
FROM status GROUP BY crawl_date""", ("wet_records", "postcode_lookup", "archive_manifest"))
def q_run_summary(spark, d):
    """A2: n of m segments successful, per crawl."""
    return runs.run_summary(_status(spark, d))


@register("default_crawls", """
SELECT c.crawl_date, c.n_files AS n_listed, coalesce(m.n, 0)::BIGINT AS n_segments
FROM (VALUES ('202104', 79840), ('202110', 64000), ('202117', 64000), ('202121', 64000), ('202125', 64000),
  ('202131', 72000), ('202139', 72000), ('202143', 72000), ('202149', 64000)) AS c(crawl_date, n_files)
LEFT JOIN (SELECT crawl_date, count(*) AS n FROM archive_manifest GROUP BY 1) m USING (crawl_date)""", ("archive_manifest",))
def q_default_crawls(spark, d):
    """The built-in crawl list against the manifest's segments."""
    manifest = relation(spark, d, "archive_manifest")
    return runs.progress_by_crawl(runs.default_crawl_list(spark), manifest, runs.segment_status(
        manifest, _scanned(spark, d), _wet(spark, d).limit(0))).where(F.col("n_listed").isNotNull()) \
        .select("crawl_date", "n_listed", "n_segments")


# ================================================================ output statistics
@register("output_stats", f"""WITH {O_PP},
flat AS (SELECT crawl_date || '/' || CAST(segment AS VARCHAR) AS file, unnest(string_split(postcodes, ',')) AS pc FROM pp)
SELECT (SELECT count(*) FROM pp) AS total_rows, count(DISTINCT file) AS n_files,
       count(DISTINCT pc) AS unique_postcodes FROM flat""", ("wet_records", "postcode_lookup"))
def q_output_stats(spark, d):
    """Rows, files and distinct postcodes of the match output."""
    return outputs.output_stats(_pages(spark, d))


@register("distinct_postcodes", f"""WITH {O_PP}
SELECT DISTINCT unnest(string_split(postcodes, ',')) AS postcode FROM pp""",
          ("wet_records", "postcode_lookup"))
def q_distinct_postcodes(spark, d):
    """Set union of matched postcodes."""
    return outputs.distinct_postcodes(_pages(spark, d))


@register("postcode_estimates", f"""WITH {O_PP},
flat AS (SELECT crawl_date, unnest(string_split(postcodes, ',')) AS pc FROM pp)
SELECT crawl_date, (SELECT count(*) FROM pp p WHERE p.crawl_date = flat.crawl_date) AS n_matches, count(DISTINCT pc) AS n_exact, true AS within
FROM flat GROUP BY crawl_date UNION ALL SELECT NULL, (SELECT count(*) FROM pp), count(DISTINCT pc), true FROM flat""",
          ("wet_records", "postcode_lookup"))
def q_postcode_estimates(spark, d):
    """A4, U1 over runs: distinct postcodes from per-segment sketches, held against the exact count."""
    pages = _pages(spark, d).select("crawl_date", "segment", "postcodes")
    said = outputs.estimated_postcodes(outputs.postcode_sketches(pages))
    flat = pages.select("crawl_date", F.explode("postcodes").alias("pc")).distinct()
    exact = flat.groupBy("crawl_date").agg(F.count(F.lit(1)).alias("n_exact")).unionByName(
        flat.select("pc").distinct().agg(F.count(F.lit(1)).alias("n_exact")).withColumn("crawl_date", F.lit(None).cast("string")))
    off = F.abs(F.col("n_postcodes") - F.col("n_exact"))
    return said.withColumnRenamed("crawl_date", "c").join(exact, F.col("c").eqNullSafe(F.col("crawl_date"))).select(
        "crawl_date", "n_matches", "n_exact", (off <= F.lit(outputs.SKETCH_BOUND) * F.col("n_exact")).alias("within"))


@register("postcode_coverage", f"""WITH {O_PP},{O_COVERAGE}
SELECT count(*) AS n_files, round(avg(pct), 4) AS pct_with_postcodes FROM per_file""",
          ("wet_records", "postcode_lookup"))
def q_postcode_coverage(spark, d):
    """A5: macro average over files of the percent of records with postcodes."""
    cov = outputs.coverage_from_counts(_scanned(spark, d), _pages(spark, d))
    return cov.select("n_files", F.round("pct_with_postcodes", 4).alias("pct_with_postcodes"))


@register("output_sizes", """
SELECT count(*) AS n_files, sum(ceil(file_size / 1048576))::BIGINT AS total_mb,
       ceil(sum(file_size) / 1073741824)::BIGINT AS total_gb, ceil(sum(file_size) / 1073741824) > 500 AS over_limit
FROM output_listing""", ("output_listing",))
def q_output_sizes(spark, d):
    """File count and size of the output."""
    return outputs.file_sizes(relation(spark, d, "output_listing"))


@register("latest_outputs", """
SELECT file_path, file_size, file_mtime FROM output_listing ORDER BY file_mtime DESC, file_path LIMIT 5""", ("output_listing",))
def q_latest_outputs(spark, d):
    """The five files written last."""
    return files.latest_files(relation(spark, d, "output_listing"), 5)


# ================================================================ logs
@register("log_error_counts", f"""WITH flags AS ({O_ERR_FLAGS})
SELECT file, source_kind, count(*) FILTER (WHERE is_error) AS n_errors,
       count(*) FILTER (WHERE is_warning) AS n_warnings
FROM flags WHERE source_kind IN ('err', 'log') GROUP BY file, source_kind""", ("log_lines",))
def q_log_error_counts(spark, d):
    """Error and warning lines per .err/.log file."""
    return logs.log_error_counts(relation(spark, d, "log_lines"))


@register("log_error_totals", f"""WITH flags AS ({O_ERR_FLAGS}), succ AS ({O_SUCCESS}),
per AS (SELECT file, source_kind, count(*) AS n_lines, count(*) FILTER (WHERE is_error) AS n_errors,
    count(*) FILTER (WHERE is_warning) AS n_warnings FROM flags GROUP BY 1, 2),
good AS (SELECT file, source_kind, sum(n_marks) AS n_success, sum(n_records) AS n_records FROM succ GROUP BY 1, 2),
both_ AS (SELECT per.*, coalesce(n_success, 0) AS n_success, coalesce(n_records, 0) AS n_records FROM per LEFT JOIN good USING (file, source_kind))
SELECT 'file' AS level, file, source_kind, 1::BIGINT AS n_files, n_lines, n_errors, n_warnings, n_success::BIGINT AS n_success, n_records::BIGINT AS n_records FROM both_
UNION ALL SELECT 'kind', NULL, source_kind, count(*), sum(n_lines), sum(n_errors), sum(n_warnings), sum(n_success), sum(n_records) FROM both_ GROUP BY source_kind
UNION ALL SELECT 'all', NULL, NULL, count(*), sum(n_lines), sum(n_errors), sum(n_warnings), sum(n_success), sum(n_records) FROM both_""",
          ("log_lines",))
def q_log_error_totals(spark, d):
    """A7, A8 totals: errors, warnings, successes and records by file, by kind and over all, in one scan."""
    return logs.log_totals(relation(spark, d, "log_lines"))


BEAT_GAP, BEAT_NOW = "24 hours", "2024-01-31 00:00:00"


@register("stalled_tasks", f"""
WITH beats AS (SELECT file, strptime(line[1:19], '%Y-%m-%d %H:%M:%S') AS ts FROM log_lines WHERE contains(line, '[HEARTBEAT]')),
clock AS (SELECT TIMESTAMP '{BEAT_NOW}' AS now),
marked AS (SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY file ORDER BY ts) + INTERVAL 24 HOUR THEN 0 ELSE 1 END AS fresh FROM beats),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY file ORDER BY ts, fresh DESC ROWS UNBOUNDED PRECEDING) AS s FROM marked),
sess AS (SELECT file, s, count(*) AS n_beats, min(ts) AS first_beat, max(ts) AS last_beat FROM numbered GROUP BY 1, 2),
nexts AS (SELECT *, lead(first_beat) OVER (PARTITION BY file ORDER BY first_beat) AS nxt FROM sess)
SELECT file, n_beats, first_beat, last_beat, date_diff('second', last_beat, coalesce(nxt, now)) AS silent_s,
  CASE WHEN nxt IS NOT NULL THEN 'resumed' WHEN now > last_beat + INTERVAL 24 HOUR THEN 'stalled' ELSE 'alive' END AS state
FROM nexts, clock""", ("log_lines",))
def q_stalled_tasks(spark, d):
    """Stretches of heartbeats per task log, the silence after each, and the tasks silent now."""
    sessions = logs.heartbeat_sessions(relation(spark, d, "log_lines"), BEAT_GAP)
    return logs.stalled_tasks(sessions, F.lit(BEAT_NOW).cast("timestamp_ntz"), BEAT_GAP)


@register("log_success_totals", f"""WITH s AS ({O_SUCCESS})
SELECT file, source_kind, sum(n_marks)::BIGINT AS n_success, coalesce(sum(n_records), 0)::BIGINT AS n_records
FROM s GROUP BY file, source_kind""", ("log_lines",))
def q_log_success_totals(spark, d):
    """Finished segments and reported records per .log/.out file."""
    return logs.log_success_totals(relation(spark, d, "log_lines"))


@register("segment_runtime", f"WITH {O_RUNTIME}\nSELECT * FROM rt", ("segment_log",))
def q_segment_runtime(spark, d):
    """Seconds from download to completion per segment (from log timestamps)."""
    return logs.segment_runtime(relation(spark, d, "segment_log"))


@register("runtime_summary", f"""WITH {O_RUNTIME}
SELECT crawl_date, count(*) AS n_segments, min(runtime_s) AS min_s, max(runtime_s) AS max_s,
       avg(runtime_s) AS avg_s, sum(runtime_s)::BIGINT AS total_s FROM rt GROUP BY crawl_date""",
          ("segment_log",))
def q_runtime_summary(spark, d):
    """Min / max / mean / total segment runtime per crawl date."""
    return logs.runtime_summary(logs.segment_runtime(relation(spark, d, "segment_log")))


@register("runtime_by_task", f"""WITH {O_RUNTIME}
SELECT file, count(*) AS n_segments, min(runtime_s) AS min_s, max(runtime_s) AS max_s,
       avg(runtime_s) AS avg_s, sum(runtime_s)::BIGINT AS total_s FROM rt GROUP BY file""",
          ("segment_log",))
def q_runtime_by_task(spark, d):
    """Min / max / mean / total segment runtime per task (one log file per task)."""
    return logs.runtime_summary(logs.segment_runtime(relation(spark, d, "segment_log")), by=("file",))


@register("runtime_quartiles", f"""WITH {O_RUNTIME}
SELECT crawl_date, count(*) AS n_segments, true AS q1_ok, true AS median_ok, true AS q3_ok FROM rt GROUP BY crawl_date""",
          ("segment_log",))
def q_runtime_quartiles(spark, d):
    """A9 spread: quartiles per crawl from sketches per task log; each one's exact rank lies within 2 % of its own."""
    times = logs.segment_runtime(relation(spark, d, "segment_log"))
    quartiles = logs.runtime_quartiles(logs.runtime_sketches(times))
    ranked = times.join(quartiles, "crawl_date").groupBy("crawl_date", "n_segments")

    def share(c, strict):
        return F.avg(((F.col("runtime_s") < F.col(c)) if strict else (F.col("runtime_s") <= F.col(c))).cast("int"))
    return ranked.agg(*[((share(f"{c}_s", True) <= q + 0.02) & (share(f"{c}_s", False) >= q - 0.02)).alias(f"{c}_ok")
                        for c, q in zip(("q1", "median", "q3"), logs.QUARTILES)])


@register("failures_by_class", """
SELECT l.source_kind, c.failure_class, count(*) AS n_lines
FROM log_lines l JOIN (VALUES ('error'), ('failed'), ('exception'), ('timeout'), ('warning'), ('low'), ('insufficient'),
  ('no records')) AS c(failure_class) ON regexp_matches(lower(l.line), '\\b' || c.failure_class || '\\b')
WHERE l.source_kind IN ('err', 'log') GROUP BY l.source_kind, c.failure_class""", ("log_lines",))
def q_failures_by_class(spark, d):
    """Failing lines per failure class."""
    return logs.failures_by_class(relation(spark, d, "log_lines"))


@register("first_failures", """
SELECT file, line_no, line, row_number() OVER (PARTITION BY file ORDER BY line_no) AS rank
FROM log_lines WHERE source_kind IN ('err', 'log') AND regexp_matches(line, '(?i)error|failed')
QUALIFY rank <= 3""", ("log_lines",))
def q_first_failures(spark, d):
    """First three failure lines per file."""
    return logs.first_failures(relation(spark, d, "log_lines"), 3)


@register("recent_activity", """
SELECT file, line_no, line, row_number() OVER (PARTITION BY file ORDER BY line_no DESC) AS rank
FROM log_lines QUALIFY rank <= 3""", ("log_lines",))
def q_recent_activity(spark, d):
    """Last three lines of every log file."""
    return logs.recent_activity(relation(spark, d, "log_lines"), 3)


# ================================================================ job accounting
@register("elapsed_seconds", f"""
SELECT job_id, state, elapsed, {_o_duration('elapsed')} AS elapsed_s, {_o_duration('time_limit')} AS limit_s
FROM accounting""", ("accounting",))
def q_elapsed_seconds(spark, d):
    """Scheduler duration strings to seconds."""
    return jobs.elapsed_seconds(relation(spark, d, "accounting"))


@register("time_limit_use", f"""
WITH e AS (SELECT job_id, state, {_o_duration('elapsed')} AS elapsed_s, {_o_duration('time_limit')} AS limit_s
           FROM accounting),
p AS (SELECT *, CASE WHEN elapsed_s IS NOT NULL AND limit_s IS NOT NULL THEN
                  CASE WHEN limit_s <= 0 THEN 0 ELSE elapsed_s * 100 // limit_s END END AS pct_used FROM e)
SELECT job_id, state, elapsed_s, limit_s, elapsed_s // 3600 AS elapsed_h, limit_s // 3600 AS limit_h,
       pct_used, pct_used > 80 AS near_limit FROM p""", ("accounting",))
def q_time_limit_use(spark, d):
    """Percent of the time limit used and the 80 % warning."""
    return jobs.time_limit_use(relation(spark, d, "accounting"))


@register("elapsed_breakdown", f"""
WITH e AS (SELECT job_id, {_o_duration('elapsed')} AS elapsed_s FROM accounting),
p AS (SELECT job_id, elapsed_s, elapsed_s // 3600 // 24 AS elapsed_days, (elapsed_s // 3600) % 24 AS elapsed_hours,
             (elapsed_s % 3600) // 60 AS elapsed_minutes FROM e)
SELECT job_id, elapsed_s, elapsed_days, elapsed_hours, elapsed_minutes,
  CASE WHEN elapsed_s IS NULL THEN NULL
       WHEN elapsed_days > 0 THEN printf('%dd %dh %dm', elapsed_days, elapsed_hours, elapsed_minutes)
       WHEN elapsed_hours > 0 THEN printf('%dh %dm', elapsed_hours, elapsed_minutes)
       ELSE printf('%dm', elapsed_minutes) END AS elapsed_text
FROM p""", ("accounting",))
def q_elapsed_breakdown(spark, d):
    """Elapsed seconds split into days / hours / minutes, formatted as the status report."""
    e = jobs.elapsed_seconds(relation(spark, d, "accounting")).select("job_id", "elapsed_s")
    return runs.elapsed_breakdown(e)


@register("deadline_days", f"""
SELECT job_id, (epoch_us(TIMESTAMP '{DEADLINE}') - epoch_us(submit_time)) // 1000000 // 86400 AS days_left,
       (epoch_us(TIMESTAMP '{DEADLINE}') - epoch_us(submit_time)) // 1000000 // 86400 < 7 AS deadline_alert
FROM accounting""", ("accounting",))
def q_deadline_days(spark, d):
    """Whole days from each submission to the project deadline; alert under 7."""
    return jobs.deadline_days(relation(spark, d, "accounting"), DEADLINE).select(
        "job_id", "days_left", "deadline_alert")


@register("jobs_by_state", "SELECT state, count(*) AS n_jobs FROM accounting GROUP BY state",
          ("accounting",))
def q_jobs_by_state(spark, d):
    """Jobs per scheduler state."""
    return jobs.jobs_by_state(relation(spark, d, "accounting"))


@register("failures_by_exit", """
WITH e AS (SELECT state, TRY_CAST(split_part(exit_code, ':', 1) AS INT) AS code, TRY_CAST(split_part(exit_code, ':', 2) AS INT) AS signal
  FROM job_usage WHERE state NOT IN ('RUNNING', 'PENDING'))
SELECT state, code, signal, count(*) AS n_jobs, (count(*) * 100 // (SELECT count(*) FROM e))::BIGINT AS pct_of_ended
FROM e GROUP BY ALL HAVING NOT (state = 'COMPLETED' AND code = 0 AND signal = 0)""", ("job_usage",))
def q_failures_by_exit(spark, d):
    """Ended jobs by exit code and signal."""
    return jobs.failures_by_exit(relation(spark, d, "job_usage"))


@register("resource_use", f"""
WITH u AS (SELECT *, CASE right(max_rss, 1) WHEN 'K' THEN rtrim(max_rss, 'K')::DOUBLE / 1024 WHEN 'M' THEN rtrim(max_rss, 'M')::DOUBLE
    WHEN 'G' THEN rtrim(max_rss, 'G')::DOUBLE * 1024 WHEN '' THEN NULL ELSE max_rss::DOUBLE / 1048576 END AS mb_,
  {_o_duration('cpu_time')} AS used_, {_o_duration('elapsed')} * n_cpus AS held_ FROM job_usage),
f AS (SELECT state, floor(mb_)::BIGINT AS mb, CASE WHEN held_ > 0 THEN used_ END AS used, CASE WHEN held_ > 0 THEN held_ END AS held FROM u)
SELECT state, count(*) AS n_jobs, count(mb) AS n_measured, floor(avg(mb))::BIGINT AS mean_mb, max(mb) AS max_mb,
  count(*) FILTER (WHERE mb * 100 > 2048 * 90) AS n_near_limit, (sum(used) * 100 // sum(held))::BIGINT AS cpu_pct FROM f GROUP BY state""",
          ("job_usage",))
def q_resource_use(spark, d):
    """Job analysis: memory and CPU used, per state."""
    return jobs.resource_use(relation(spark, d, "job_usage"))


@register("latest_job", """
SELECT state, job_id AS latest_job_id FROM accounting
QUALIFY row_number() OVER (PARTITION BY state ORDER BY submit_time DESC, job_id DESC) = 1""",
          ("accounting",))
def q_latest_job(spark, d):
    """Most recent job per state."""
    return jobs.latest_job(relation(spark, d, "accounting")).select("state", "latest_job_id")


@register("first_jobs", """
SELECT state, job_id, row_number() OVER (PARTITION BY state ORDER BY job_id) AS rank
FROM accounting WHERE state IN ('RUNNING', 'PENDING') QUALIFY rank <= 5""", ("accounting",))
def q_first_jobs(spark, d):
    """Head of the queue -- first five running and pending jobs."""
    return jobs.first_jobs(relation(spark, d, "accounting"), 5)


# ================================================================ report
@register("run_report", f"""WITH {O_PP},{O_COVERAGE},{O_RUNTIME},
flags AS ({O_ERR_FLAGS}),
succ AS ({O_SUCCESS}),
fig AS (
  SELECT (SELECT count(*) FILTER (WHERE is_error) FROM flags WHERE source_kind = 'log') AS n_errors,
         (SELECT count(*) FILTER (WHERE is_warning) FROM flags WHERE source_kind = 'log') AS n_warnings,
         (SELECT coalesce(sum(n_marks), 0) FROM succ)::BIGINT AS n_success,
         (SELECT coalesce(sum(n_records), 0) FROM succ)::BIGINT AS n_records,
         (SELECT count(*) FROM pp) AS total_rows,
         (SELECT count(DISTINCT crawl_date || '/' || CAST(segment AS VARCHAR)) FROM pp) AS n_files,
         (SELECT count(DISTINCT pc) FROM (SELECT unnest(string_split(postcodes, ',')) AS pc FROM pp)) AS unique_postcodes,
         (SELECT round(avg(pct), 4) FROM per_file) AS pct_with_postcodes,
         (SELECT count(DISTINCT file) FROM flags WHERE is_error AND source_kind = 'log') AS n_failing_files,
         (SELECT floor(avg(runtime_s))::BIGINT FROM rt) AS avg_segment_s,
         (SELECT count(*) FROM output_listing) AS n_output_files,
         (SELECT sum(ceil(file_size / 1048576))::BIGINT FROM output_listing) AS output_mb),
r AS (SELECT *, CASE WHEN n_success + n_errors > 0 THEN n_success * 100 // (n_success + n_errors) ELSE 0 END
               AS success_rate FROM fig)
SELECT n_errors, n_warnings, n_success, n_records, total_rows, n_files, unique_postcodes, pct_with_postcodes,
       n_failing_files, avg_segment_s, n_output_files, output_mb, success_rate, n_errors > 5 AS high_errors, success_rate < 90 AS low_success,
       pct_with_postcodes < 10 AS low_coverage, n_files > 0 AND total_rows > 0 AS quality_good,
       CASE WHEN n_success + n_errors = 0 THEN 'no_activity'
            WHEN n_errors = 0 AND success_rate > 95 THEN 'healthy'
            WHEN n_errors > 0 THEN 'rerun_failed_segments' ELSE 'below_target' END AS verdict
FROM r""", ("wet_records", "postcode_lookup", "log_lines", "segment_log", "output_listing"))
def q_run_report(spark, d):
    """The one-row run report with verdict flags."""
    figs = report.run_figures(relation(spark, d, "log_lines"), _pages(spark, d), _scanned(spark, d),
                              runtimes=logs.segment_runtime(relation(spark, d, "segment_log")),
                              sizes=outputs.file_sizes(relation(spark, d, "output_listing")))
    figs = figs.withColumn("pct_with_postcodes", F.round("pct_with_postcodes", 4))
    return report.run_report(figs)


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["queries", "oracle_sql"]
