"""Statistics over the match output: rows, distinct postcodes, files, coverage, sizes.

Only the ``postcodes`` column (and file identity) is read: column pruning keeps the page text
out of every statistic, where the reference loaded each output file whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.durations import OUTPUT_SIZE_LIMIT_GB
from ..schemas import RECORD_KEY


def output_file(crawl_date: str = "crawl_date", segment: str = "segment") -> F.Column:
    """File identity of a match row: one output file per (crawl, segment)."""
    return F.concat(F.col(crawl_date), F.lit("/"), F.col(segment).cast("string"))


def output_stats(matches: DataFrame, file_col: F.Column | None = None) -> DataFrame:
    """One row: total rows, files with at least one row, distinct postcodes (one scan)."""
    f = file_col if file_col is not None else output_file()
    flat = matches.select(f.alias("file"), F.posexplode_outer("postcodes").alias("pos", "postcode"))
    return flat.agg(
        F.count_if(F.col("pos").isNull() | (F.col("pos") == 0)).alias("total_rows"),
        F.countDistinct("file").alias("n_files"),
        F.countDistinct("postcode").alias("unique_postcodes"))


def segment_figures(matches: DataFrame, scanned: DataFrame | None = None) -> DataFrame:
    """The figures of :func:`output_stats` and, with ``scanned``, :func:`coverage_from_counts` from one
    pass over the matches: they are aggregated once to a row per segment (rows, set of postcodes), all
    else is computed from those rows."""
    flat = matches.select("crawl_date", "segment", F.posexplode_outer("postcodes").alias("pos", "postcode"))
    per = flat.groupBy("crawl_date", "segment").agg(
        F.count_if(F.col("pos").isNull() | (F.col("pos") == 0)).alias("n_matches"),
        F.collect_set("postcode").alias("postcodes"))
    if scanned is None:
        per = per.withColumn("n_records", F.lit(None).cast("bigint"))
    else:
        read = scanned.groupBy("crawl_date", "segment").agg(F.sum("n_records").alias("n_records"))
        per = per.join(read, ["crawl_date", "segment"], "full")
    n = F.coalesce("n_matches", F.lit(0))
    rows = per.select(n.alias("n"), "n_records", F.posexplode_outer("postcodes").alias("pos", "postcode"))
    once = F.col("pos").isNull() | (F.col("pos") == 0)          # one exploded row stands for its segment
    return rows.agg(
        F.coalesce(F.sum(F.when(once, F.col("n"))), F.lit(0)).cast("bigint").alias("total_rows"),
        F.count_if(once & (F.col("n") > 0)).alias("n_files"),
        F.countDistinct("postcode").alias("unique_postcodes"),
        F.avg(F.when(once & (F.col("n_records") > 0), F.col("n") / F.col("n_records") * 100)).alias("pct_with_postcodes"))


SKETCH_LG_K = 12                # 4,096 registers: a standard error of 1.6 %
SKETCH_BOUND = 0.05             # three standard errors


def postcode_sketches(matches: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """Per segment a mergeable sketch of its distinct postcodes, and its rows: (crawl_date, segment, n_matches, sketch).
    Written beside a run (``sinks.write_sketches``), it answers for any set of segments without reading matches again."""
    flat = matches.select("crawl_date", "segment", F.posexplode_outer("postcodes").alias("pos", "postcode"))
    return flat.groupBy("crawl_date", "segment").agg(
        F.count_if(F.col("pos").isNull() | (F.col("pos") == 0)).alias("n_matches"), F.hll_sketch_agg("postcode", lg_k).alias("sketch"))


def estimated_postcodes(sketches: DataFrame) -> DataFrame:
    """Distinct postcodes per crawl and over all (``crawl_date`` null), estimated from sketches; the exact way is
    :func:`output_stats`."""
    return sketches.groupingSets([["crawl_date"], []], "crawl_date").agg(
        F.sum("n_matches").cast("bigint").alias("n_matches"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_postcodes"))


def distinct_postcodes(matches: DataFrame) -> DataFrame:
    """Set union of all postcodes across outputs (nulls skipped)."""
    return matches.select(F.explode("postcodes").alias("postcode")) \
        .where(F.col("postcode").isNotNull()).distinct()


def coverage_by_file(rows: DataFrame, file_col: F.Column | None = None) -> DataFrame:
    """Per file: rows and percent of rows whose ``postcodes`` is not null."""
    f = file_col if file_col is not None else output_file()
    return rows.select(f.alias("file"), F.col("postcodes").isNotNull().cast("int").alias("has_pc")) \
        .groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"),
                             (F.avg("has_pc") * 100).alias("pct_with_postcodes"))


def postcode_coverage(rows: DataFrame, file_col: F.Column | None = None,
                      files: DataFrame | None = None) -> DataFrame:
    """Macro average over files of the per-file percent of rows with postcodes.

    ``files`` (column ``file``) lists files that may have zero rows; they count as 0 %.
    """
    per = coverage_by_file(rows, file_col)
    if files is not None:
        per = files.select("file").distinct().join(per, "file", "left") \
            .select("file", F.coalesce("pct_with_postcodes", F.lit(0.0)).alias("pct_with_postcodes"))
    return per.agg(F.count(F.lit(1)).alias("n_files"),
                   F.coalesce(F.avg("pct_with_postcodes"), F.lit(0.0)).alias("pct_with_postcodes"))


def coverage_from_counts(scanned: DataFrame, matches: DataFrame,
                         key: tuple[str, ...] = ("crawl_date", "segment")) -> DataFrame:
    """The same macro average from per-file counts, without touching record-level rows.

    ``scanned``: one row per file (``key``) with ``n_records`` read; ``matches``: match rows.
    Both sides are aggregated map-side to one row per file before they meet, so the join is
    over files (hundreds of thousands), not records (billions).
    """
    found = matches.groupBy(*key).agg(F.count(F.lit(1)).alias("n_matches"))
    per = scanned.groupBy(*key).agg(F.sum("n_records").alias("n_records")) \
        .where(F.col("n_records") > 0).join(found, list(key), "left")
    pct = (F.coalesce("n_matches", F.lit(0)) / F.col("n_records")) * 100
    return per.agg(F.count(F.lit(1)).alias("n_files"),
                   F.coalesce(F.avg(pct), F.lit(0.0)).alias("pct_with_postcodes"))


def records_with_matches(records: DataFrame, matches: DataFrame) -> DataFrame:
    """Every record with its match postcodes, null where nothing matched (left join on key)."""
    return records.select(*RECORD_KEY).join(
        matches.select(*RECORD_KEY, "postcodes"), list(RECORD_KEY), "left")


def file_sizes(files: DataFrame, limit_gb: int = OUTPUT_SIZE_LIMIT_GB) -> DataFrame:
    """One row from per-file metadata (``file_path``, ``file_size``): file count, size in MB
    rounded up per file (``du -m``), total in GB rounded up, and the over-limit warning."""
    per = files.select("file_path", "file_size").distinct()
    return per.agg(
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum(F.ceil(F.col("file_size") / F.lit(1048576))), F.lit(0)).cast("bigint")
        .alias("total_mb"),
        F.coalesce(F.ceil(F.sum("file_size") / F.lit(1 << 30)), F.lit(0)).cast("bigint")
        .alias("total_gb")).withColumn("over_limit", F.col("total_gb") > limit_gb)
