"""Writers and readers of the job's outputs: matches, segment status, run report.

Every run writes its own ``crawl_date=.../run_id=...`` folders, so slices of one crawl and re-runs
lie side by side in one output folder. A run with the same id replaces what it wrote (``clear_run``
takes away what an earlier attempt left, its status first, so nothing counts that is half replaced). What
counts is decided when reading: for each (crawl_date, segment) the latest run that finished it, else
the latest that tried. File size is bounded with ``maxRecordsPerFile``; writes go through Spark's
commit protocol, so a lost executor or a retried task never leaves partial files.

``compact_matches`` rewrites the rows that count, clustered by postcode, as a generation beside the runs, and
publishes it by writing the list of what it covers; readers take covered segments from the last published
generation and the others from their runs. ``remove_compacted`` then drops the runs' folders that no reader needs.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.runs import SEGMENT_KEY, current_runs
from ..schemas import MATCH, RUN_ID, SEGMENT_STATUS
from ..session import staged

DEFAULT_MAX_RECORDS_PER_FILE = 200_000
COVERS = T.StructType([*[f for f in SEGMENT_STATUS.fields if f.name in SEGMENT_KEY], RUN_ID])


def new_run_id() -> int:
    return time.time_ns() // 1000


def _write(df: DataFrame, path: str, run_id: int) -> None:
    df.withColumn("run_id", F.lit(run_id).cast("bigint")).write.mode("overwrite") \
        .partitionBy("crawl_date", "run_id").option("partitionOverwriteMode", "dynamic") \
        .option("maxRecordsPerFile", DEFAULT_MAX_RECORDS_PER_FILE).option("compression", "snappy").parquet(path)


def write_matches(matches: DataFrame, path: str, run_id: int) -> None:
    """Parquet, one folder per crawl date and run."""
    _write(matches, path, run_id)


def write_status(status: DataFrame, path: str, run_id: int) -> None:
    """The run's rows of the per-segment status table."""
    _write(status, path, run_id)


def write_sketches(sketches: DataFrame, path: str, run_id: int) -> None:
    """The run's postcode sketches, a row per segment with matches."""
    _write(sketches, path, run_id)


def read_sketches(spark: SparkSession, path: str, status_path: str) -> DataFrame:
    """The sketches that count: those of each segment's current run."""
    schema = T.StructType([*COVERS.fields, T.StructField("n_matches", T.LongType()), T.StructField("sketch", T.BinaryType())])
    keep = current_runs(read_status(spark, status_path, every_run=True))
    return spark.read.schema(schema).parquet(path).join(keep, [*SEGMENT_KEY, "run_id"], "left_semi").drop("run_id")


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def _folders(spark: SparkSession, pattern: str) -> list:
    path, fs = _hadoop_path(spark, pattern)
    return [f.getPath() for f in fs.globStatus(path) or [] if f.isDirectory()]


def _delete(spark: SparkSession, folders: list) -> None:
    for f in folders:
        f.getFileSystem(spark._jsc.hadoopConfiguration()).delete(f, True)


def clear_run(spark: SparkSession, path: str, run_id: int) -> None:
    """Remove the folders that an earlier attempt under this id wrote, also for crawls that now get no row."""
    _delete(spark, _folders(spark, f"{path.rstrip('/')}/crawl_date=*/run_id={run_id}"))


def _generations(path: str) -> str:
    return f"{path.rstrip('/')}/_compacted"


def published_generations(spark: SparkSession, path: str) -> list[int]:
    """Generations that were published, the latest last."""
    done = _folders(spark, f"{_generations(path)}/covers/generation=*")
    ok = [f for f in done if f.getFileSystem(spark._jsc.hadoopConfiguration()).exists(
        spark._jvm.org.apache.hadoop.fs.Path(f, "_SUCCESS"))]
    return sorted(int(f.getName().split("=")[1]) for f in ok)


def _covered(spark: SparkSession, path: str, generation: int) -> DataFrame:
    return spark.read.schema(COVERS).parquet(f"{_generations(path)}/covers/generation={generation}")


def _every_match(spark: SparkSession, path: str, *more: Column) -> DataFrame:
    """Match rows with run_id (and ``more`` columns of their files): those of the last generation, and those of runs that
    it doesn't cover."""
    schema = T.StructType([*MATCH.fields, RUN_ID])
    rows = spark.read.schema(schema).parquet(path).select("*", *more)
    found = published_generations(spark, path)
    if not found:
        return rows
    loose = rows.join(_covered(spark, path, found[-1]), [*SEGMENT_KEY, "run_id"], "left_anti")
    return loose.unionByName(spark.read.schema(schema).parquet(f"{_generations(path)}/rows/generation={found[-1]}").select("*", *more))


def compact_matches(spark: SparkSession, path: str, status_path: str) -> int:
    """Write the rows that count now as a new generation: per crawl, clustered by each row's first postcode, in files of bounded
    size. It counts once its list of covered (crawl_date, segment, run_id) is written, in one commit at the
    end; until then readers see the old state, and a generation that failed half way is never read. Returns its number."""
    current = staged(current_runs(read_status(spark, status_path, every_run=True)), "current")
    generation = new_run_id()
    first = F.element_at("postcodes", 1)
    rows = _every_match(spark, path).join(current, [*SEGMENT_KEY, "run_id"], "left_semi") \
        .withColumn("first_postcode", first)
    by = ["crawl_date", "first_postcode", *SEGMENT_KEY[1:], "record_no"]
    rows.repartitionByRange(*by).sortWithinPartitions(*by).write.partitionBy("crawl_date") \
        .option("maxRecordsPerFile", DEFAULT_MAX_RECORDS_PER_FILE).option("compression", "snappy") \
        .parquet(f"{_generations(path)}/rows/generation={generation}")
    current.select(*SEGMENT_KEY, "run_id").coalesce(1).write.parquet(f"{_generations(path)}/covers/generation={generation}")
    return generation


def remove_compacted(spark: SparkSession, path: str, status_path: str) -> int:
    """Remove what the last published generation replaced: folders of runs without a row that still counts beside it,
    and older or unpublished generations. To be run when no reader from before it is left; returns the number of folders."""
    found = published_generations(spark, path)
    if not found:
        return 0
    last = found[-1]
    current = current_runs(read_status(spark, status_path, every_run=True))
    loose = current.join(_covered(spark, path, last), [*SEGMENT_KEY, "run_id"], "left_anti")
    needed = {(r.crawl_date, r.run_id) for r in loose.select("crawl_date", "run_id").distinct().collect()}   # a row a run and crawl
    old = []
    for f in _folders(spark, f"{path.rstrip('/')}/crawl_date=*/run_id=*"):
        run_id = int(f.getName().split("=")[1])
        if run_id < last and (f.getParent().getName().split("=", 1)[1], run_id) not in needed:
            old.append(f)
    for part in ("covers", "rows"):
        old += [f for f in _folders(spark, f"{_generations(path)}/{part}/generation=*") if int(f.getName().split("=")[1]) < last]
    _delete(spark, old)
    return len(old)


def read_status(spark: SparkSession, path: str, every_run: bool = False) -> DataFrame:
    """One row per (crawl_date, segment): that of the run that counts; with ``every_run`` all rows,
    with their run_id."""
    rows = spark.read.schema(T.StructType([*SEGMENT_STATUS.fields, RUN_ID])).parquet(path)
    return rows if every_run else rows.join(current_runs(rows), [*SEGMENT_KEY, "run_id"], "left_semi").drop("run_id")


def read_matches(spark: SparkSession, path: str, status_path: str) -> DataFrame:
    """The match rows that count: those of each segment's current run."""
    rows = _every_match(spark, path)
    keep = current_runs(read_status(spark, status_path, every_run=True))
    return rows.join(keep, [*SEGMENT_KEY, "run_id"], "left_semi").drop("run_id")


def current_files(spark: SparkSession, path: str, status_path: str) -> DataFrame:
    """One row per file that holds rows that count, as ``files.output_files`` lists every run's: path, size, modification
    time, rows that count."""
    cols = {"file_path": "file_path", "file_size": "file_size", "file_mtime": "file_modification_time"}
    rows = _every_match(spark, path, *[F.col(f"_metadata.{c}").alias(n) for n, c in cols.items()])
    keep = current_runs(read_status(spark, status_path, every_run=True))
    return rows.join(keep, [*SEGMENT_KEY, "run_id"], "left_semi").groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows"))


def write_report(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The one-row run report as JSON (one small file)."""
    report.coalesce(1).write.mode(mode).json(path)
