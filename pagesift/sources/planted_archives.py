"""Planted archives: the planted ``wet_records`` written as real WET archives by Spark.

Lets the archive readers be checked at the scale of the driver's tables: records are
dealt by (crawl_date, segment) and each task writes, per segment it holds, one gzip'ed WARC file
with one gzip member per record (as crawl archives are stored: a segment is one archive). File names carry crawl date and
segment; the record number travels in ``WARC-Record-ID``. Names depend only on the task's
partition, so a retried task rewrites the same files.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import uuid

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package
from .warc import encode_record
from .wet import ArchiveStore

RECORD_ID = "<urn:pagesift:record:{}>"
RECORD_ID_PATTERN = r"record:(\d+)>"
MANIFEST_SCHEMA = "crawl_date string, segment int, path string, n_records long"


def write_archives(records: DataFrame, out_dir: str, rows_per_task: int = 2000) -> DataFrame:
    """Write ``records`` (WET_RECORD columns) as archives under ``out_dir``.

    Returns the manifest of what was written -- (crawl_date, segment, path, n_records), one
    row per file -- itself written by the same job to ``out_dir/_manifest`` and read back, so
    the file list never passes through the driver."""
    ship_package(records.sparkSession)
    cols = records.select("crawl_date", "segment", "record_no", "rec_type", "uri", "language", "text")
    n_parts = max(1, -(-cols.count() // rows_per_task))
    parts = cols.repartition(n_parts, "crawl_date", "segment") \
        .sortWithinPartitions("crawl_date", "segment", "record_no")

    def write(batches):
        pid = TaskContext.get().partitionId()
        handles: dict[tuple, object] = {}
        paths: dict[tuple, str] = {}
        counts: dict[tuple, int] = {}
        try:
            for pdf in batches:
                for row in pdf.itertuples(index=False):
                    key = (row.crawl_date, int(row.segment))
                    if key not in handles:
                        name = f"crawldata{key[0]}segment{key[1]:05d}-p{pid:05d}.wet.gz"
                        paths[key] = f"{out_dir.rstrip('/')}/{name}"
                        handles[key] = _open_output(paths[key])
                        counts[key] = 0
                    headers = {"WARC-Type": row.rec_type,
                               "WARC-Record-ID": RECORD_ID.format(int(row.record_no))}
                    if isinstance(row.uri, str):
                        headers["WARC-Target-URI"] = row.uri
                    if isinstance(row.language, str):
                        headers["WARC-Identified-Content-Language"] = row.language
                    body = (row.text or "").encode("utf-8")
                    handles[key].write(gzip.compress(encode_record(headers, body), 1))
                    counts[key] += 1
        finally:
            for h in handles.values():
                h.close()
        if counts:      # a partition without rows yields nothing: an empty frame has no types
            yield pd.DataFrame({
                "crawl_date": [k[0] for k in counts], "segment": [k[1] for k in counts],
                "path": [paths[k] for k in counts], "n_records": list(counts.values())})

    manifest_dir = f"{out_dir.rstrip('/')}/_manifest"
    parts.mapInPandas(write, MANIFEST_SCHEMA).write.mode("overwrite").parquet(manifest_dir)
    return records.sparkSession.read.parquet(manifest_dir)


def _open_output(location: str):
    """Writable binary stream for a local path or a filesystem URI (``pyarrow.fs``)."""
    if "://" not in location:
        return open(location, "wb")  # noqa: SIM115
    from pyarrow import fs as pafs

    filesystem, path = pafs.FileSystem.from_uri(location)
    return filesystem.open_output_stream(path, compression=None)   # bytes are gzip already


def planted_archive_dir(spark: SparkSession, key: str | None = None) -> str:
    """A folder for planted archives under the session's (shared) checkpoint folder, which is
    specific to the application: named after ``key`` when given (so the archives of one input
    are written once per application), else fresh. A local path for ``file:`` checkpoints,
    else a filesystem URI."""
    base = ensure_checkpoint_dir(spark)
    tag = hashlib.sha1(key.encode()).hexdigest()[:12] if key else uuid.uuid4().hex[:12]
    name = f"planted-archives-{tag}"
    if base.startswith("file:"):
        base = "/" + base[len("file:"):].lstrip("/")
    if "://" in base:
        from pyarrow import fs as pafs

        uri = f"{base.rstrip('/')}/{name}"
        filesystem, path = pafs.FileSystem.from_uri(uri)
        filesystem.create_dir(path, recursive=True)
        return uri
    path = os.path.join(base, name)
    os.makedirs(path, exist_ok=True)
    return path


def _exists(location: str) -> bool:
    if "://" not in location:
        return os.path.exists(location)
    from pyarrow import fs as pafs

    filesystem, path = pafs.FileSystem.from_uri(location)
    return filesystem.get_file_info(path).type != pafs.FileType.NotFound


def planted_archives(spark: SparkSession, records: DataFrame, key: str) -> tuple[str, DataFrame]:
    """(folder, manifest) of ``records`` written as archives, reusing a complete earlier write
    of the same ``key`` in this application."""
    out = planted_archive_dir(spark, key)
    manifest_dir = f"{out.rstrip('/')}/_manifest"
    if _exists(f"{manifest_dir}/_SUCCESS"):
        ship_package(spark)
        return out, spark.read.parquet(manifest_dir)
    return out, write_archives(records, out)


class FaultyStore(ArchiveStore):
    """Planted archives that fail as the end of their location says: ``#fails=N@B`` breaks the connection after ``B`` more
    bytes, ``N`` times in a row; ``#cut=B`` lacks the last ``B`` bytes. Others are read as they are."""

    def __init__(self):
        self.opened: dict[str, int] = {}

    def open(self, location: str, offset: int = 0):
        path, _, fault = location.partition("#")
        if fault.startswith("cut="):
            size = self.size(path)
            return io.BytesIO(super().open(path, 0).read(size - int(fault[4:]))[offset:])
        if fault.startswith("fails="):
            times, _, after = fault[6:].partition("@")
            n = self.opened[location] = self.opened.get(location, 0) + 1
            if n <= int(times):
                return _Breaking(super().open(path, offset), int(after))
        return super().open(path, offset)

    def size(self, location: str) -> int | None:
        return super().size(location.partition("#")[0])


class _Breaking:
    """A stream whose connection is reset after ``left`` bytes."""

    def __init__(self, raw, left: int):
        self.raw, self.left = raw, left

    def read(self, n: int) -> bytes:
        if self.left <= 0:
            raise ConnectionResetError("connection reset")
        data = self.raw.read(min(n, self.left))
        self.left -= len(data)
        return data

    def close(self) -> None:
        self.raw.close()


def record_no_from_id(headers: str = "headers") -> F.Column:
    """The planted record number carried in ``WARC-Record-ID``."""
    return F.regexp_extract(F.col(headers)["warc-record-id"], RECORD_ID_PATTERN, 1).cast("bigint")
