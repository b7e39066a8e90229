"""WET archives as a Spark source.

Two entry points share the framing helper in :mod:`.warc`:

* ``spark.read.format("wet").load(path)`` -- a Python Data Source with one input partition
  per archive. A truncated or corrupt archive fails the query, or with
  ``option("onTruncated", "keep")`` gives its leading records. Equality / contains / prefix filters on ``rec_type``, ``uri`` and ``language``
  are pushed into the reader on request, when the session enables
  ``spark.sql.python.filterPushdown``, so bodies of records that cannot pass are skipped
  undecoded; Spark still re-checks every filter. Without it the plain reader is used.
  ``option("mode", "status")`` yields one row per archive instead (records read, state).
* :func:`scan_manifest` -- the same reader driven by a manifest DataFrame via
  ``mapInArrow``: the file list never passes through the driver, and every archive yields
  its candidate records plus one status row in the same pass. Reads that break are resumed inside
  the task (:mod:`.retry`), and an archive that can't be read ends alone.
"""

from __future__ import annotations

import glob
import gzip
import io
import os
import re
import urllib.error
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    InputPartition,
    IsNotNull,
    StringContains,
    StringStartsWith,
)

from ..schemas import SCAN_STATUS, WET_RECORD
from ..session import ship_package
from .retry import LASTING, ArchiveUnavailable, Resumed, Retry
from .warc import ScanResult, header_filter, iter_records, open_archive

# Archive names written by the reference's jobs: crawldata{date}segment{NNNNN}.wet.gz
DEFAULT_NAME_PATTERN = r"crawldata(\d+)segment(\d+)"
BATCH_ROWS = 1024            # an Arrow batch out of the reader ends at so many rows ...
BATCH_CHARS = 16 << 20       # ... or so many characters of text
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"
ARCHIVE_GLOBS = ("*.wet.gz", "*.warc.wet.gz", "*.wet", "*.gz")

SCAN_ROW = T.StructType(WET_RECORD.fields + [
    T.StructField("is_status", T.BooleanType()),
    T.StructField("n_records", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("n_retries", T.LongType()),
])
_ARROW_SCAN = pa.schema([
    ("crawl_date", pa.string()), ("segment", pa.int32()), ("record_no", pa.int64()),
    ("rec_type", pa.string()), ("uri", pa.string()), ("language", pa.string()),
    ("headers", pa.map_(pa.string(), pa.string())), ("content_length", pa.int64()),
    ("text", pa.string()), ("is_status", pa.bool_()), ("n_records", pa.int64()),
    ("state", pa.string()), ("error", pa.string()), ("n_retries", pa.int64()),
])


def _has_scheme(location: str) -> bool:
    return "://" in location


class _Transfer(io.RawIOBase):
    """An HTTP body that raises when it ends before its Content-Length: a cut connection must fail
    the task, which Spark retries, not pass for a truncated archive."""

    def __init__(self, response):
        self.response = response
        length = response.headers.get("Content-Length")
        self.left = int(length) if length and length.isdigit() else None

    def readable(self):
        return True

    def readinto(self, buffer):
        data = self.response.read(len(buffer))
        if self.left is not None:
            self.left -= len(data)
            if not data and self.left > 0 and len(buffer):
                raise ConnectionError(f"transfer ended {self.left} bytes early")
        buffer[:len(data)] = data
        return len(data)

    def close(self):
        self.response.close()
        super().close()


def open_raw(location: str):
    """Binary stream of the stored bytes: local/shared path, http(s) URL or any filesystem URI
    (``file://``, ``s3://``, ``gs://``, ``hdfs://``, ... through ``pyarrow.fs``), read inside the task."""
    if location.startswith(("http://", "https://")):
        try:
            response = urllib.request.urlopen(location, timeout=300)  # noqa: S310 - archive URLs
        except urllib.error.HTTPError as e:
            if e.code in (404, 410):
                raise FileNotFoundError(f"HTTP {e.code}: {location}") from e
            raise
        return io.BufferedReader(_Transfer(response), 1 << 20)
    if not _has_scheme(location):
        return open(location, "rb")  # noqa: SIM115
    from pyarrow import fs as pafs

    filesystem, path = pafs.FileSystem.from_uri(location)
    return filesystem.open_input_file(path)


class ArchiveStore:
    """Where archives lie: local or shared paths, http(s) URLs, filesystem URIs."""

    def open(self, location: str, offset: int = 0):
        """Binary stream of the stored bytes from ``offset`` on."""
        if location.startswith(("http://", "https://")):
            return self._request(location, offset)
        raw = open_raw(location)
        raw.seek(offset)
        return raw

    def _request(self, location: str, offset: int):
        request = urllib.request.Request(location, headers={"Range": f"bytes={offset}-"} if offset else {})
        try:
            response = urllib.request.urlopen(request, timeout=300)  # noqa: S310 - archive URLs
        except urllib.error.HTTPError as e:
            if e.code in (404, 410):
                raise FileNotFoundError(f"HTTP {e.code}: {location}") from e
            if e.code == 416:           # nothing after offset: the last byte had come before the connection broke
                return io.BytesIO()
            raise
        raw = io.BufferedReader(_Transfer(response), 1 << 20)
        left = offset if response.status == 200 else 0       # a server that sends all again
        while left > 0 and (skipped := len(raw.read(min(left, 1 << 20)))):
            left -= skipped
        return raw

    def size(self, location: str) -> int | None:
        """Stored bytes; None where that can't be told."""
        try:
            if location.startswith(("http://", "https://")):
                with urllib.request.urlopen(urllib.request.Request(location, method="HEAD"), timeout=60) as r:  # noqa: S310
                    length = r.headers.get("Content-Length", "")
                return int(length) if length.isdigit() else None
            if not _has_scheme(location):
                return os.stat(location).st_size if os.path.isfile(location) else None
            from pyarrow import fs as pafs

            filesystem, path = pafs.FileSystem.from_uri(location)
            return filesystem.get_file_info(path).size
        except (OSError, ValueError):
            return None


def with_sizes(manifest: DataFrame, location: str = "path", store: ArchiveStore | None = None) -> DataFrame:
    """``manifest`` with ``bytes``, the size of each archive, asked for inside tasks; null where unknown."""
    ship_package(manifest.sparkSession)
    store = store or ArchiveStore()

    def measure(batches):
        for batch in batches:
            sizes = [None if at is None else store.size(at) for at in batch.column(location).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sizes, pa.int64())], names=[*batch.schema.names, "bytes"])

    schema = T.StructType([*manifest.schema.fields, T.StructField("bytes", T.LongType())])
    return manifest.repartition("crawl_date", "segment").mapInArrow(measure, schema)


def open_any(location: str):
    """An archive as a binary stream, decompressed when gzip'ed."""
    if not _has_scheme(location):
        return open_archive(location)
    raw = io.BufferedReader(open_raw(location), 1 << 20) if not location.startswith("http") else open_raw(location)
    return gzip.GzipFile(fileobj=raw, mode="rb") if raw.peek(2)[:2] == b"\x1f\x8b" else raw


def _unpacked(raw: Resumed):
    """The bytes of an archive, decompressed when gzip'ed."""
    buffered = io.BufferedReader(raw, 1 << 20)
    return gzip.GzipFile(fileobj=buffered, mode="rb") if buffered.peek(2)[:2] == b"\x1f\x8b" else buffered


ARCHIVE_SUFFIXES = (".wet.gz", ".wet", ".gz")


def _list_uri(uri: str) -> list[str]:
    """Archives under a filesystem URI (a file or a folder, recursively), as URIs."""
    from pyarrow import fs as pafs

    filesystem, path = pafs.FileSystem.from_uri(uri)
    prefix = uri[: len(uri) - len(path)] if uri.endswith(path) else ""
    info = filesystem.get_file_info(path)
    if info.type == pafs.FileType.File:
        return [uri]
    found = filesystem.get_file_info(pafs.FileSelector(path, recursive=True))
    return sorted(prefix + f.path for f in found
                  if f.type == pafs.FileType.File and f.path.endswith(ARCHIVE_SUFFIXES))


def list_archives(path: str) -> list[str]:
    """Expand a comma-separated list of files, directories and globs (or filesystem URIs),
    sorted."""
    out: list[str] = []
    for p in [x.strip() for x in path.split(",") if x.strip()]:
        if _has_scheme(p) and not p.startswith(("http://", "https://")):
            out.extend(_list_uri(p))
        elif os.path.isdir(p):
            found = set()
            for g in ARCHIVE_GLOBS:
                found.update(glob.glob(os.path.join(p, "**", g), recursive=True))
            out.extend(sorted(found))
        elif any(ch in p for ch in "*?["):
            out.extend(sorted(glob.glob(p)))
        else:
            out.append(p)
    return out


class WetPartition(InputPartition):
    """One archive."""

    def __init__(self, path: str, crawl_date: str | None, segment: int | None):
        super().__init__(path)
        self.path, self.crawl_date, self.segment = path, crawl_date, segment


class WetReader(DataSourceReader):
    def __init__(self, options, status_mode: bool):
        self.options = dict(options)
        self.status_mode = status_mode
        self.pushed: dict[str, str] = {}

    def partitions(self):
        files = list_archives(self.options["path"])
        pattern = re.compile(self.options.get("namepattern", DEFAULT_NAME_PATTERN))
        fallback_date = self.options.get("crawldate")
        parts = []
        for i, p in enumerate(files):
            m = pattern.search(os.path.basename(p))
            date, seg = (m.group(1), int(m.group(2))) if m and m.lastindex and m.lastindex >= 2 \
                else (fallback_date, i)
            parts.append(WetPartition(p, date, seg))
        return parts

    def _keep(self):
        p = self.pushed
        rec_type = p.get("rec_type_eq")
        uri_contains = p.get("uri_contains")
        language = p.get("language_eq")
        inner = header_filter(rec_type=rec_type, uri_contains=uri_contains, language=language,
                              uri_startswith=p.get("uri_startswith"))
        need_uri = "uri_notnull" in p or p.get("uri_eq") is not None
        need_lang = "language_notnull" in p
        uri_eq = p.get("uri_eq")

        def keep(h):
            if not inner(h):
                return False
            if need_uri and h.get("warc-target-uri") is None:
                return False
            if uri_eq is not None and h.get("warc-target-uri") != uri_eq:
                return False
            if need_lang and h.get("warc-identified-content-language") is None:
                return False
            return True
        return keep if p else None

    def read(self, partition: WetPartition):
        if self.status_mode:
            yield self._status_row(partition)
            return
        status = ScanResult()
        with open_any(partition.path) as stream:
            yield from _record_batches(partition, iter_records(stream, keep=self._keep(), status=status))
        if status.state != "read" and self.options.get("ontruncated", "fail").lower() != "keep":
            raise ValueError(f"{partition.path} is {status.state} after {status.n_records} records: {status.error}")

    @staticmethod
    def _status_row(partition: WetPartition) -> tuple:
        """Records read and state of one archive; headers only, no body decode."""
        status = ScanResult()
        try:
            with open_any(partition.path) as stream:
                for _ in iter_records(stream, keep=lambda h: False, status=status):
                    pass
        except FileNotFoundError as e:
            status.state, status.error = "failed", f"{type(e).__name__}: {e}"
        return (partition.crawl_date, partition.segment, status.n_records, status.state, status.error)


_ARROW_RECORD = pa.schema([
    ("crawl_date", pa.string()), ("segment", pa.int32()), ("record_no", pa.int64()),
    ("rec_type", pa.string()), ("uri", pa.string()), ("language", pa.string()),
    ("headers", pa.map_(pa.string(), pa.string())), ("content_length", pa.int64()),
    ("text", pa.string()),
])


def _record_batches(partition: WetPartition, records) -> Iterator[pa.RecordBatch]:
    """Arrow batches of bounded rows and text (columnar hand-off to the JVM)."""
    cols: dict[str, list] = {k: [] for k in _ARROW_RECORD.names}
    chars = 0

    def flush():
        batch = pa.RecordBatch.from_pydict(cols, schema=_ARROW_RECORD)
        for v in cols.values():
            v.clear()
        return batch

    for record_no, rec_type, uri, language, headers, length, text in records:
        cols["crawl_date"].append(partition.crawl_date)
        cols["segment"].append(partition.segment)
        cols["record_no"].append(record_no)
        cols["rec_type"].append(rec_type)
        cols["uri"].append(uri)
        cols["language"].append(language)
        cols["headers"].append(list(headers.items()))
        cols["content_length"].append(length)
        cols["text"].append(text)
        chars += len(text)
        if len(cols["record_no"]) >= BATCH_ROWS or chars >= BATCH_CHARS:
            yield flush()
            chars = 0
    if cols["record_no"]:
        yield flush()


class WetPushdownReader(WetReader):
    """``WetReader`` that takes pushed filters (needs
    ``spark.sql.python.filterPushdown.enabled=true``, else Spark refuses the reader)."""

    def pushFilters(self, filters):
        col = {"rec_type": "rec_type", "uri": "uri", "language": "language"}
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in col and isinstance(f, EqualTo) and isinstance(f.value, str):
                self.pushed[f"{name}_eq"] = f.value
            elif name == "uri" and isinstance(f, StringContains):
                self.pushed["uri_contains"] = f.value
            elif name == "uri" and isinstance(f, StringStartsWith):
                self.pushed["uri_startswith"] = f.value
            elif name in col and isinstance(f, IsNotNull):
                self.pushed[f"{name}_notnull"] = "1"
            # Spark re-evaluates every filter after the scan: the reader only skips early.
            yield f


class WetDataSource(DataSource):
    """``spark.read.format("wet").option("path", ...)``: records of WET archives."""

    @classmethod
    def name(cls):
        return "wet"

    def _status_mode(self) -> bool:
        return self.options.get("mode", "records").lower() == "status"

    def schema(self):
        return SCAN_STATUS if self._status_mode() else WET_RECORD

    def reader(self, schema):
        pushdown = self.options.get("pushdown", "false").lower() == "true"
        cls = WetPushdownReader if pushdown and not self._status_mode() else WetReader
        return cls(self.options, self._status_mode())


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(WetDataSource)


def read_wet(spark: SparkSession, path: str, *, mode: str = "records",
             name_pattern: str = DEFAULT_NAME_PATTERN, crawl_date: str | None = None,
             on_truncated: str = "fail", pushdown: bool = False) -> DataFrame:
    """Records (or per-archive status rows with ``mode='status'``) of the archives at ``path``.

    ``on_truncated``: ``fail`` raises on a truncated or corrupt archive, ``keep`` gives the records
    before the damage. ``path`` is listed on the driver: for a crawl's hundreds of thousands of
    archives use :func:`scan_manifest`, which never lists.

    ``pushdown`` lets the reader skip records by the query's filters, where the session allows it. Spark
    keeps pushed filters with the loaded source, so such a DataFrame serves one query only: a
    second one over it would be read under the first one's filters."""
    register(spark)
    pushdown = pushdown and spark.conf.get(PUSHDOWN_CONF, "false").lower() == "true"
    r = spark.read.format("wet").option("path", path).option("mode", mode) \
        .option("pushdown", str(pushdown).lower()) \
        .option("namePattern", name_pattern).option("onTruncated", on_truncated)
    if crawl_date is not None:
        r = r.option("crawlDate", crawl_date)
    return r.load()


def scan_manifest(manifest: DataFrame, *, location: str = "file_url", rec_type: str | None = None,
                  uri_contains: str | None = None, language: str | None = None,
                  num_partitions: int | None = None, retry: Retry = Retry(),
                  store: ArchiveStore | None = None) -> DataFrame:
    """Read the archives a manifest names, in parallel, inside tasks.

    ``manifest`` has ``crawl_date``, ``segment`` and a ``location`` column (path or URL). Each
    archive yields its records that pass the header filter and one status row
    (``is_status``, ``n_records``, ``state`` = read/partial/failed, ``error``, ``n_retries``). A read that breaks is
    tried again as ``retry`` says, from where it broke. A missing archive and one that can't be read at all are
    ``failed``, one that is damaged or breaks for good after some records is ``partial``: the others are read all the same.

    With a column ``task`` (see ``dealing.deal_by_size``) rows go to the task it names, else by hash of
    (crawl_date, segment), to ``num_partitions`` tasks (default: the session's shuffle partitions, at least its
    parallelism); the caller who knows the number of archives sets it so that a task holds a few.
    """
    spark = manifest.sparkSession
    ship_package(spark)
    keep = header_filter(rec_type=rec_type, uri_contains=uri_contains, language=language)
    filtered = any(v is not None for v in (rec_type, uri_contains, language))
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                              spark.sparkContext.defaultParallelism)
    rows = manifest.select("crawl_date", F.col("segment").cast("int").alias("segment"),
                           F.col(location).alias("location"), *(["task"] if "task" in manifest.columns else []))
    rows = rows.repartitionById(n, "task").drop("task") if "task" in manifest.columns else rows.repartition(n, "crawl_date", "segment")
    store = store or ArchiveStore()

    def read_batches(batches):
        out = {k: [] for k in _ARROW_SCAN.names}

        def add(**kv):
            for k in out:
                out[k].append(kv.get(k))

        def flush():
            batch = pa.RecordBatch.from_pydict(out, schema=_ARROW_SCAN)
            for v in out.values():
                v.clear()
            return batch

        for batch in batches:
            for item in batch.to_pylist():
                status, chars = ScanResult(), 0
                raw = Resumed(item["location"], store.open, retry)
                try:
                    with _unpacked(raw) as stream:
                        for rec in iter_records(stream, keep=keep if filtered else None, status=status):
                            record_no, rt, uri, lang, headers, length, text = rec
                            add(crawl_date=item["crawl_date"], segment=item["segment"],
                                record_no=record_no, rec_type=rt, uri=uri, language=lang,
                                headers=list(headers.items()), content_length=length, text=text,
                                is_status=False)
                            chars += len(text)
                            if len(out["record_no"]) >= BATCH_ROWS or chars >= BATCH_CHARS:
                                yield flush()
                                chars = 0
                except (*LASTING, ArchiveUnavailable) as e:
                    status.state, status.error = "partial" if status.n_records else "failed", f"{type(e).__name__}: {e}"
                add(crawl_date=item["crawl_date"], segment=item["segment"], is_status=True, n_records=status.n_records,
                    state=status.state, error=status.error, n_retries=raw.retries)
        if out["record_no"]:
            yield flush()

    return rows.mapInArrow(read_batches, SCAN_ROW)
