"""The run report: one row of log, output and coverage figures with the verdict rules.

Each figure is a one-row aggregate; they are stacked with ``unionByName`` and folded with
``max`` into a single row, so no join is needed to put scalars side by side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durations import (
    ERROR_THRESHOLD,
    HEALTHY_PCT,
    LOW_COVERAGE_PCT,
    SUCCESS_NOTE_PCT,
    idiv,
)
from .logs import file_totals, segment_runtime
from .outputs import segment_figures


def _stack(parts: list[DataFrame]) -> DataFrame:
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    cols = []
    for p in parts:
        cols += [c for c in p.columns if c not in cols]
    return stacked.agg(*[F.max(c).alias(c) for c in cols])


def run_figures(lines: DataFrame, matches: DataFrame, scanned: DataFrame | None = None,
                error_kinds: tuple[str, ...] = ("log",), runtimes: DataFrame | None = None,
                sizes: DataFrame | None = None) -> DataFrame:
    """One row: errors, warnings, successes, records, failing files, output rows/segments/postcodes,
    coverage, average seconds per segment, output files and MB.

    ``scanned``: (crawl_date, segment, n_records) of every archive read, for the coverage.
    ``runtimes``: ``segment_runtime`` rows; default those of ``lines``. ``sizes``: ``file_sizes``' row.
    ``error_kinds``: file kinds whose errors and warnings are
    counted. Default ``.log`` only: the console handler repeats every message on stderr, so
    adding ``.err`` counts each error twice; pass ``("err", "log")`` for the reference's totals.
    """
    counted = F.col("source_kind").isin(*error_kinds)
    said = file_totals(lines).agg(          # one pass over the lines, a row a file after it
        F.sum(F.when(counted, F.col("n_errors"))).alias("n_errors"), F.sum(F.when(counted, F.col("n_warnings"))).alias("n_warnings"),
        F.count_if(counted & (F.col("n_errors") > 0)).alias("n_failing_files"),
        F.sum("n_success").cast("bigint").alias("n_success"), F.sum("n_records").cast("bigint").alias("n_records"))
    timed = (segment_runtime(lines) if runtimes is None else runtimes).agg(
        F.floor(F.avg("runtime_s")).cast("bigint").alias("avg_segment_s"))
    parts = [said, timed, segment_figures(matches, scanned)]
    if sizes is not None:
        parts.append(sizes.select(F.col("n_files").alias("n_output_files"), F.col("total_mb").alias("output_mb")))
    return _stack(parts)


def run_report(figures: DataFrame) -> DataFrame:
    """Add success rate and the verdict flags to :func:`run_figures`' row (missing figures
    count as 0)."""
    def num(c: str) -> F.Column:
        v = F.col(c) if c in figures.columns else F.lit(None)
        return F.coalesce(v.cast("bigint"), F.lit(0).cast("bigint"))
    err, succ, rows, files = num("n_errors"), num("n_success"), num("total_rows"), num("n_files")
    rate = F.when(succ + err > 0, idiv(succ * 100, succ + err)).otherwise(F.lit(0).cast("bigint"))
    cov = F.col("pct_with_postcodes") if "pct_with_postcodes" in figures.columns \
        else F.lit(None).cast("double")
    verdict = (F.when(succ + err == 0, F.lit("no_activity"))
               .when((err == 0) & (rate > HEALTHY_PCT), F.lit("healthy"))
               .when(err > 0, F.lit("rerun_failed_segments"))
               .otherwise(F.lit("below_target")))
    return figures.select(
        err.alias("n_errors"), num("n_warnings").alias("n_warnings"),
        succ.alias("n_success"), num("n_records").alias("n_records"),
        rows.alias("total_rows"), files.alias("n_files"),
        num("unique_postcodes").alias("unique_postcodes"),
        cov.alias("pct_with_postcodes"),
        num("n_failing_files").alias("n_failing_files"), num("avg_segment_s").alias("avg_segment_s"),
        num("n_output_files").alias("n_output_files"), num("output_mb").alias("output_mb"),
        rate.alias("success_rate"),
        (err > ERROR_THRESHOLD).alias("high_errors"),
        (rate < SUCCESS_NOTE_PCT).alias("low_success"),
        (cov < LOW_COVERAGE_PCT).alias("low_coverage"),
        ((files > 0) & (rows > 0)).alias("quality_good"),
        verdict.alias("verdict"))
