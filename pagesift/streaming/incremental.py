"""Incremental runs with Structured Streaming.

Newly landed inputs are picked up by a file stream; each micro-batch runs the same batch
operator (``postcode_pages``) and writes its matches to a folder named after the batch id.
The checkpoint records which files were consumed, so a restart neither skips nor repeats
input, and a re-run of a batch overwrites its own folder instead of appending duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.match import postcode_pages
from ..plans.crawl_job import filter_crawl
from ..schemas import MANIFEST, WET_RECORD


def _batch_writer(lookup: DataFrame, output_dir: str, **match_kwargs):
    def write(batch: DataFrame, batch_id: int) -> None:
        out = postcode_pages(batch, lookup, **match_kwargs)
        out.write.mode("overwrite").partitionBy("crawl_date") \
            .parquet(f"{output_dir.rstrip('/')}/batch={batch_id}")
    return write


def stream_records(spark: SparkSession, records_dir: str, lookup: DataFrame, output_dir: str,
                   checkpoint_dir: str, max_files_per_trigger: int = 64,
                   available_now: bool = False, **match_kwargs) -> StreamingQuery:
    """Match decoded records (Parquet, ``WET_RECORD`` columns) as they land in ``records_dir``."""
    stream = spark.readStream.schema(WET_RECORD).option("maxFilesPerTrigger", max_files_per_trigger) \
        .parquet(records_dir)
    w = stream.writeStream.foreachBatch(_batch_writer(lookup, output_dir, **match_kwargs)) \
        .option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")
    return w.start()


def stream_manifests(spark: SparkSession, manifest_dir: str, lookup: DataFrame, output_dir: str,
                     status_dir: str, checkpoint_dir: str, available_now: bool = False,
                     base_url: str | None = None, **match_kwargs) -> StreamingQuery:
    """Process the archives listed in manifest rows (CSV: crawl_date, segment, path) as new
    manifest files land in ``manifest_dir``.

    Each micro-batch is a run of the batch job of its own, with the time as run id like any other run: streams and batch runs
    may share the two folders. A batch that is run again is a later run of the same segments, which counts instead of
    the first (and of what a broken first attempt left, which has no status). Every archive leaves a status row, a
    missing or damaged one too, so ``remaining_segments`` finds what has to be listed again."""
    stream = spark.readStream.schema(MANIFEST).option("header", "true").csv(manifest_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        filter_crawl(batch.sparkSession, batch, lookup, output_dir, status_dir, base_url=base_url, **match_kwargs)

    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")
    return w.start()
