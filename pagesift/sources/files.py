"""Readers for the run's text and Parquet inputs: crawl list, manifests, logs, lookup, output.

Manifests (segment = 0-based line index), crawl lists and logs get exact line numbers from
``read_lines`` without ever putting a whole file in one task (see there).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.runs import parse_crawl_list
from ..schemas import MATCH, RECORD_KEY, RUN_ID

MANIFEST_DATE = r"(\d+)_wet\.paths$"      # {date}_wet.paths, one manifest per crawl
LOG_KIND = r"\.([A-Za-z]+)$"               # err / log / out from the extension


def read_lines(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    """(file_path, file_name, line_no, line): every line of every file, dense 0-based numbers.

    Files are read line by line, split like any text input, so no file has to fit in one
    task. Numbering is exact: lines are counted per file split (a tiny table, one row per
    split), running totals over the splits of each file give each split's first line number,
    and a line's number is that plus its position within the split. A trailing newline does
    not produce an extra empty line (as ``readlines``).
    """
    raw = spark.read.text(path, recursiveFileLookup=recursive or None).select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"), F.col("value").alias("line"))
    splits = raw.groupBy("file_path", "block").agg(F.min("pos").alias("first"),
                                                   F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file_path").orderBy("block") \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file_path", "block", "first",
                            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return raw.join(offsets, ["file_path", "block"]).select(
        "file_path", "file_name",
        (F.col("before") + F.col("pos") - F.col("first")).cast("bigint").alias("line_no"), "line")


def read_crawl_list(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """(line_no, crawl_date, n_files) from a ``date n_files`` text file."""
    lines = read_lines(spark, path).select("line_no", "line")
    return parse_crawl_list(lines, strict=strict)


def read_manifest(spark: SparkSession, path: str | list[str], crawl_date: str | None = None,
                  date_pattern: str = MANIFEST_DATE) -> DataFrame:
    """(crawl_date, segment, path): segment is the 0-based line index, path stripped.

    The crawl date is ``crawl_date`` if given, else taken from the file name
    (``{date}_wet.paths``). Blank lines keep their index, as the reference's indexing does.
    """
    lines = read_lines(spark, path)
    date = F.lit(crawl_date) if crawl_date is not None else \
        F.regexp_extract("file_name", date_pattern, 1)
    return lines.select(date.alias("crawl_date"), F.col("line_no").cast("int").alias("segment"),
                        F.regexp_replace("line", r"^\s+|\s+$", "").alias("path"))


def read_logs(spark: SparkSession, directory: str, kinds=("err", "log", "out")) -> DataFrame:
    """(file, source_kind, line_no, line) for the job's ``*.err``, ``*.log``, ``*.out`` files,
    with exact 0-based line numbers (splittable: see ``read_lines``)."""
    lines = read_lines(spark, f"{directory.rstrip('/')}/*.{{{','.join(kinds)}}}")
    return lines.select(F.col("file_name").alias("file"),
                        F.regexp_extract("file_name", LOG_KIND, 1).alias("source_kind"),
                        "line_no", "line")


def log_files(spark: SparkSession, directory: str, kinds=("err", "log", "out")) -> DataFrame:
    """One row per log file: file_path, file name, kind, modification time, lines."""
    lines = spark.read.text(f"{directory.rstrip('/')}/*.{{{','.join(kinds)}}}")
    return lines.select(F.col("_metadata.file_path").alias("file_path"),
                        F.col("_metadata.file_name").alias("file"),
                        F.col("_metadata.file_modification_time").alias("file_mtime")) \
        .groupBy("file_path", "file", "file_mtime").agg(F.count(F.lit(1)).alias("n_lines")) \
        .withColumn("source_kind", F.regexp_extract("file", LOG_KIND, 1))


def read_lookup(spark: SparkSession, path: str, key: str = "pcds") -> DataFrame:
    """The reference list. Fails before any archive is read when the file or column is missing."""
    df = spark.read.parquet(path)
    if key not in df.columns:
        raise ValueError(f"lookup {path} has no column {key!r} (columns: {df.columns})")
    return df.select(key)


def read_output(spark: SparkSession, path: str) -> DataFrame:
    """Match rows written by the job, every run's, under the declared schema (so a crawl date stays
    text), with the file each row came from and its size."""
    df = spark.read.schema(T.StructType([*MATCH.fields, RUN_ID])).parquet(path)
    return df.select("*", F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_size").alias("file_size"),
                     F.col("_metadata.file_modification_time").alias("file_mtime"))


def output_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per non-empty output file: path, size, modification time, rows."""
    return read_output(spark, path).groupBy("file_path", "file_size", "file_mtime") \
        .agg(F.count(F.lit(1)).alias("n_rows"))


def latest_files(files: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most recently modified files (``ls -t | head -n``)."""
    return files.orderBy(F.col("file_mtime").desc(), F.col("file_path")).limit(n)


__all__ = ["read_lines", "read_crawl_list", "read_manifest", "read_logs", "log_files", "read_lookup",
           "read_output", "output_files", "latest_files", "RECORD_KEY"]
