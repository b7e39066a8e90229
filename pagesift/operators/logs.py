"""Log mining over (file, source_kind, line_no, line) rows: errors, successes, runtimes.

One scan with conditional aggregates replaces the reference's several serial passes. Per-file
groups combine map-side, so a file holding a third of all lines costs no more than others;
top-k per file uses ``row_number() <= k``, which Spark plans with a map-side group limit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Line patterns of the reference's analyser, matched case-insensitively.
ERR_ERRORS = "error|failed|exception|timeout"            # *.err, errors
ERR_WARNINGS = "warning|low|insufficient"                # *.err, warnings ("low" matches inside words)
LOG_ERRORS = "error|failed to download|error processing|logging.error"   # *.log, errors
LOG_WARNINGS = "warning|no records|low disk"             # *.log, warnings
FAILURE_LINES = "error|failed"                           # lines quoted as failure details
SUCCESS_MARK = "Completed processing segment"            # one per finished segment
COMPLETED = r"Completed processing segment (\d+): (\d+) records"
DOWNLOADING = r"Downloading \S+ to (?:\S*/)?crawldata(\d+)segment(\d+)\.wet\.gz"   # with or without a folder
HEARTBEAT = "[HEARTBEAT] Still running..."                # written every 300 seconds
LOG_TS = r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2},\d{3})"  # "%(asctime)s - LEVEL - message"
# ---------------------------------------------------------------------------
# Word-bounded alternative for warnings (avoids "following", "slow", "allowed").
ERR_WARNINGS_STRICT = r"\b(warning|low|insufficient)\b"

HEARTBEAT_GAP = "15 minutes"       # three beats missed

# Failure classes reported by ``failures_by_class`` (each is a literal, case-insensitive).
FAILURE_CLASSES = ("error", "failed", "exception", "timeout", "warning", "low",
                   "insufficient", "no records")


def _ci(pattern: str):
    return f"(?i){pattern}"


def classify(lines: DataFrame, strict_warnings: bool = True) -> DataFrame:
    """Add boolean ``is_error`` / ``is_warning`` with the pattern set of the line's file kind
    (``err`` and ``log`` files only; other kinds are neither). ``strict_warnings`` (default)
    matches the ``.err`` warning words as whole words; ``False`` keeps the reference's loose
    form, where ``low`` also hits "following", "slow", "allowed"."""
    kind, line = F.col("source_kind"), F.col("line")
    err_warn = ERR_WARNINGS_STRICT if strict_warnings else ERR_WARNINGS
    is_error = (F.when(kind == "err", line.rlike(_ci(ERR_ERRORS)))
                .when(kind == "log", line.rlike(_ci(LOG_ERRORS))).otherwise(F.lit(False)))
    is_warn = (F.when(kind == "err", line.rlike(_ci(err_warn)))
               .when(kind == "log", line.rlike(_ci(LOG_WARNINGS))).otherwise(F.lit(False)))
    return lines.withColumn("is_error", F.coalesce(is_error, F.lit(False))) \
        .withColumn("is_warning", F.coalesce(is_warn, F.lit(False)))


def log_error_counts(lines: DataFrame, strict_warnings: bool = True) -> DataFrame:
    """Per ``.err``/``.log`` file: error and warning line counts."""
    c = classify(lines.where(F.col("source_kind").isin("err", "log")), strict_warnings)
    return c.groupBy("file", "source_kind").agg(
        F.count_if("is_error").alias("n_errors"), F.count_if("is_warning").alias("n_warnings"))


def success_lines(lines: DataFrame) -> DataFrame:
    """``.log``/``.out`` lines with the success-mark count and the record count they carry."""
    line = F.col("line")
    return lines.where(F.col("source_kind").isin("log", "out")).select(
        "file", "source_kind",
        F.regexp_count(line, F.lit(SUCCESS_MARK)).alias("n_marks"),
        F.when(line.rlike(COMPLETED), F.regexp_extract(line, COMPLETED, 2).try_cast("bigint"))
        .alias("n_records"))


def log_success_totals(lines: DataFrame) -> DataFrame:
    """Per ``.log``/``.out`` file: finished segments and the records they report.

    The record number is parsed out of ``...: N records`` (the reference summed the last
    field, the word ``records``, and always got 0)."""
    return success_lines(lines).groupBy("file", "source_kind").agg(
        F.sum("n_marks").cast("bigint").alias("n_success"),
        F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("n_records"))


def file_totals(lines: DataFrame, strict_warnings: bool = True) -> DataFrame:
    """Lines, errors, warnings, finished segments and reported records of every ``.err``/``.log``/``.out`` file, in one
    pass over the lines."""
    found = classify(lines.where(F.col("source_kind").isin("err", "log", "out")), strict_warnings)
    success = F.col("source_kind").isin("log", "out")
    return found.groupBy("file", "source_kind").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_if("is_error").alias("n_errors"), F.count_if("is_warning").alias("n_warnings"),
        F.sum(F.when(success, F.regexp_count("line", F.lit(SUCCESS_MARK))).otherwise(0)).alias("n_success"),
        F.sum(F.when(success & F.col("line").rlike(COMPLETED), F.regexp_extract("line", COMPLETED, 2).try_cast("bigint"))).alias("n_records"))


def log_totals(lines: DataFrame, strict_warnings: bool = True) -> DataFrame:
    """:func:`file_totals` by file, of each kind and of all: ``level`` is ``file``, ``kind`` or ``all``. The grouping
    sets are taken over the files' counts, a row a file, not over the lines."""
    per = file_totals(lines, strict_warnings)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("n_lines", "n_errors", "n_warnings", "n_success", "n_records")]
    every = per.groupingSets([["file", "source_kind"], ["source_kind"], []], "file", "source_kind").agg(
        F.grouping_id("file", "source_kind").alias("_g"), F.count(F.lit(1)).alias("n_files"), *sums)
    level = F.when(F.col("_g") == 0, F.lit("file")).when(F.col("_g") == 2, F.lit("kind")).otherwise(F.lit("all"))
    return every.select(level.alias("level"), *[c for c in every.columns if c != "_g"])


def heartbeat_sessions(lines: DataFrame, gap: str = HEARTBEAT_GAP) -> DataFrame:
    """Per file, the stretches of time in which its task was alive: heartbeats no further apart than ``gap``
    (event-time session windows). Works on a stream with a watermark on ``ts`` as on a table; ``lines`` may bring
    its own ``ts``."""
    beats = lines.where(F.contains(F.col("line"), F.lit(HEARTBEAT)))
    if "ts" not in lines.columns:
        beats = beats.withColumn("ts", log_time(F.col("line")))
    return beats.where(F.col("ts").isNotNull()).groupBy("file", F.session_window("ts", gap).alias("_w")).agg(
        F.count(F.lit(1)).alias("n_beats"), F.min("ts").alias("first_beat"), F.max("ts").alias("last_beat")).drop("_w")


def stalled_tasks(sessions: DataFrame, now: F.Column, gap: str = HEARTBEAT_GAP) -> DataFrame:
    """Every session with the silence after it, in seconds: up to the file's next session, or up to ``now`` after the
    last. ``state`` is ``resumed``, ``stalled`` (silent for longer than ``gap`` at ``now``) or ``alive``."""
    after = F.lead("first_beat").over(Window.partitionBy("file").orderBy("first_beat"))
    s = sessions.withColumn("_next", after).withColumn("silent_s", F.timestamp_diff(
        "SECOND", F.col("last_beat"), F.coalesce("_next", now.cast("timestamp_ntz"))))
    late = F.coalesce("_next", now.cast("timestamp_ntz")) > F.col("last_beat") + F.expr(f"interval {gap}")
    return s.withColumn("state", F.when(F.col("_next").isNotNull(), F.lit("resumed")).when(late, F.lit("stalled"))
                        .otherwise(F.lit("alive"))).drop("_next")


def log_time(line) -> F.Column:
    """Timestamp of a log line (``asctime`` prefix), timezone-free; null when absent or invalid.

    Built from the parsed fields, so no session time zone (or DST gap) is involved."""
    ts = F.regexp_extract(line, LOG_TS, 1)     # fixed layout: yyyy-MM-dd HH:mm:ss,SSS

    def num(pos: int, n: int) -> F.Column:
        return F.substring(ts, pos, n).cast("int")
    millis = num(18, 2) * 1000 + num(21, 3)
    secs = (millis.cast("decimal(12,0)") / 1000).cast("decimal(16,6)")
    return F.when(ts != "", F.try_make_timestamp_ntz(num(1, 4), num(6, 2), num(9, 2),
                                                     num(12, 2), num(15, 2), secs))


def segment_events(lines: DataFrame, source_kind: str = "log") -> DataFrame:
    """``Downloading`` and ``Completed`` lines: (file, line_no, segment, is_dl, dl_date, ts), of one ``source_kind``
    (the console repeats every message) where ``lines`` has that column."""
    if "source_kind" in lines.columns:
        lines = lines.where(F.col("source_kind") == source_kind)
    line = F.col("line")
    # each pattern is matched once per line; '' means no match
    parts = lines.select(
        "file", "line_no", F.regexp_extract(line, DOWNLOADING, 1).alias("dl_date"),
        F.regexp_extract(line, DOWNLOADING, 2).alias("dl_seg"),
        F.regexp_extract(line, COMPLETED, 1).alias("done_seg"), log_time(line).alias("ts"))
    is_dl, is_done = F.col("dl_seg") != "", F.col("done_seg") != ""
    return parts.where(is_dl | is_done).select(
        "file", "line_no", F.when(is_dl, F.col("dl_seg")).otherwise(F.col("done_seg")).cast("bigint").alias("segment"),
        is_dl.alias("is_dl"), "dl_date", "ts")


def segment_runtime(lines: DataFrame, source_kind: str = "log") -> DataFrame:
    """Per finished segment: seconds from the ``Downloading`` line that last precedes its ``Completed``
    line in the same file to that line; a retried segment thus counts from its last attempt, and
    crawls that share a log are told apart by order.

    The crawl date comes from the download target name. Completed lines that no download
    precedes are dropped. The window runs inside one (file, segment), a few lines.
    """
    events = segment_events(lines, source_kind)
    before = Window.partitionBy("file", "segment").orderBy("line_no")
    paired = events.select(
        "file", "segment", "is_dl", "ts", F.lag("is_dl").over(before).alias("after_dl"),
        F.lag("dl_date").over(before).alias("crawl_date"), F.lag("ts").over(before).alias("start_ts"))
    return paired.where(~F.col("is_dl") & F.col("after_dl") & F.col("start_ts").isNotNull()
                        & F.col("ts").isNotNull()).select(
        "file", "crawl_date", "segment", F.timestamp_diff("SECOND", F.col("start_ts"), F.col("ts")).alias("runtime_s"))


def runtime_summary(runtimes: DataFrame, by: tuple[str, ...] = ("crawl_date",)) -> DataFrame:
    """Per crawl date (or ``by=("file",)``: per task log): segments timed and min / max /
    mean / total runtime in seconds."""
    return runtimes.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_segments"), F.min("runtime_s").alias("min_s"),
        F.max("runtime_s").alias("max_s"), F.avg("runtime_s").alias("avg_s"),
        F.sum("runtime_s").cast("bigint").alias("total_s"))


QUARTILES = (0.25, 0.5, 0.75)
SKETCH_K = 400                  # quantile sketches: a rank error below 1 % (99 times in 100)


def runtime_sketches(runtimes: DataFrame, by: tuple[str, ...] = ("crawl_date", "file"), k: int = SKETCH_K) -> DataFrame:
    """Mergeable quantile sketches of the segments' runtimes, a few KB each: (by..., n_segments, sketch)."""
    return runtimes.groupBy(*by).agg(F.count(F.lit(1)).alias("n_segments"), F.kll_sketch_agg_bigint("runtime_s", k).alias("sketch"))


def runtime_quartiles(sketches: DataFrame, by: tuple[str, ...] = ("crawl_date",), k: int = SKETCH_K) -> DataFrame:
    """Sketches merged per crawl -> n_segments, q1_s, median_s, q3_s; no runtime is read again."""
    merged = sketches.groupBy(*by).agg(F.sum("n_segments").cast("bigint").alias("n_segments"),
                                       F.kll_merge_agg_bigint("sketch", k).alias("s"))
    q = F.kll_sketch_get_quantile_bigint("s", F.array(*[F.lit(x) for x in QUARTILES]))
    return merged.select(*by, "n_segments", q.alias("q")).select(
        *by, "n_segments", *[F.get("q", F.lit(i)).alias(c) for i, c in enumerate(("q1_s", "median_s", "q3_s"))])


def straggler_segments(runtimes: DataFrame, quartiles: DataFrame, fences: float = 1.5) -> DataFrame:
    """Segments beyond the third quartile of their crawl by more than ``fences`` quartile ranges, with that limit."""
    limit = F.col("q3_s") + F.lit(fences) * (F.col("q3_s") - F.col("q1_s"))
    return runtimes.join(quartiles, "crawl_date").where(F.col("runtime_s") > limit) \
        .select("file", "crawl_date", "segment", "runtime_s", limit.alias("limit_s"))


def failures_by_class(lines: DataFrame, whole_words: bool = True) -> DataFrame:
    """Per (source_kind, class): lines of ``err``/``log`` files containing the class word, as a
    whole word, or with ``whole_words=False`` anywhere ("low" then also counts "following")."""
    lowered = F.lower(F.col("line"))
    if whole_words:     # no class word can begin inside another, so one pass over the line finds them all
        found = F.array_distinct(F.regexp_extract_all(lowered, F.lit(rf"\b({'|'.join(FAILURE_CLASSES)})\b"), F.lit(1)))
    else:
        found = F.array_compact(F.array(*[F.when(F.contains(lowered, F.lit(c)), F.lit(c)) for c in FAILURE_CLASSES]))
    return lines.where(F.col("source_kind").isin("err", "log")) \
        .select("source_kind", F.explode(found).alias("failure_class")) \
        .groupBy("source_kind", "failure_class").agg(F.count(F.lit(1)).alias("n_lines"))


def first_failures(lines: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` lines mentioning error/failed in each ``.err``/``.log`` file."""
    w = Window.partitionBy("file").orderBy("line_no")
    fails = lines.where(F.col("source_kind").isin("err", "log")
                        & F.col("line").rlike(_ci(FAILURE_LINES)))
    return fails.select("file", "line_no", "line", F.row_number().over(w).alias("rank")) \
        .where(F.col("rank") <= n)


def recent_activity(lines: DataFrame, n: int = 3) -> DataFrame:
    """Last ``n`` lines of each file (``tail -n``)."""
    w = Window.partitionBy("file").orderBy(F.col("line_no").desc())
    return lines.select("file", "line_no", "line", F.row_number().over(w).alias("rank")) \
        .where(F.col("rank") <= n)
