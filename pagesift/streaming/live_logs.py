"""Segment runtimes and task silences from logs that are still being written.

``stream_runtimes`` pairs ``Downloading`` and ``Completed`` lines over micro-batches with arbitrary state per (file, segment)
and a timer for segments that never complete; ``live_runtimes`` / ``live_stalled`` read what holds. The lines may be split over
files and batches in any way: a pair that a later-read line changes is corrected, so once all is read the
runtimes equal ``logs.segment_runtime`` over the whole logs. ``stream_sessions`` is ``logs.heartbeat_sessions`` on a stream.

A segment's state is its few events. The watermark (``late`` behind the newest line) drops lines older than it; events
behind it are forgotten, but for the download of a segment still open.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..operators.logs import HEARTBEAT_GAP, heartbeat_sessions, log_time, segment_events
from ..session import ship_package

STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STALLED_AFTER = "2 hours"
LATE = "7 days"                 # the longest a job may run: older lines don't arrive
DONE, OPEN, STALLED, VOID = "done", "open", "stalled", "void"
OUT = "file string, segment long, line_no long, crawl_date string, runtime_s long, state string"
_EPOCH = dt.datetime(1970, 1, 1)


def _ms(ts: dt.datetime) -> int:
    return (ts.replace(tzinfo=None) - _EPOCH) // dt.timedelta(milliseconds=1)


def _seconds(text: str) -> int:
    n, unit = text.split()
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def paired(events: list[tuple]) -> dict[int, tuple]:
    """(line_no, is_dl, ts in ms, crawl_date) in line order -> line_no: (state, crawl_date, runtime_s). A completed line counts from
    the line before it if that is a download; a download that is the last line is open."""
    out, before = {}, None
    for e in events:
        line_no, is_dl, ts, _ = e
        if is_dl:
            out[line_no] = (VOID, None, None)
        elif before is not None and before[1] and before[2] is not None and ts is not None:
            out[line_no] = (DONE, before[3], int((ts - before[2]) / 1000))
        else:
            out[line_no] = (VOID, None, None)
        before = e
    if before is not None and before[1]:
        out[before[0]] = (OPEN, before[3], None)
    return out


class PairLines(StatefulProcessor):
    """State of one (file, segment): its events by line number, and what was last said of each line."""

    def __init__(self, stalled_after_s: int, late_s: int):
        self.stalled_after_ms, self.late_ms = stalled_after_s * 1000, late_s * 1000

    def init(self, handle) -> None:
        self.handle = handle
        self.events = handle.getMapState("events", "line_no long", "is_dl boolean, ts long, crawl_date string")
        self.said = handle.getMapState("said", "line_no long", "state string, crawl_date string, runtime_s long")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        newest = None
        for r in rows:
            ts = None if r.ts is None else _ms(r.ts)
            self.events.updateValue((r.line_no,), (r.is_dl, ts, r.dl_date))
            if ts is not None:
                newest = ts if newest is None else max(newest, ts)
                if r.is_dl:         # the watermark lags by ``late``, the clock of stalling doesn't
                    self.handle.registerTimer(max(1, ts + self.stalled_after_ms - self.late_ms))
        if newest is not None:
            self.handle.registerTimer(max(1, newest))
        yield from self._say(key, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        yield from self._say(key, watermark)
        events = self._events()
        if events and all(e[2] is None or e[2] <= watermark for e in events):
            for e in events[:-1] if events[-1][1] else events:
                self.events.removeKey((e[0],))
                if self.said.containsKey((e[0],)):
                    self.said.removeKey((e[0],))

    def _events(self) -> list[tuple]:
        return sorted((k[0], v[0], v[1], v[2]) for k, v in self.events.iterator())

    def _say(self, key, watermark: int) -> Iterator[Row]:
        events = self._events()
        times = {e[0]: e[2] for e in events}
        for line_no, what in paired(events).items():
            if what[0] == OPEN and times[line_no] is not None and watermark >= times[line_no] + self.stalled_after_ms - self.late_ms:
                what = (STALLED, *what[1:])
            was = self.said.getValue((line_no,)) if self.said.containsKey((line_no,)) else None
            if (tuple(was) if was is not None else (VOID, None, None)) != what:
                self.said.updateValue((line_no,), what)
                yield Row(file=key[0], segment=key[1], line_no=line_no, crawl_date=what[1], runtime_s=what[2], state=what[0])


def runtime_changes(lines: DataFrame, stalled_after: str = STALLED_AFTER, late: str = LATE) -> DataFrame:
    """A stream of log lines -> a stream of what is now known of each line (the schema ``OUT``)."""
    events = segment_events(lines).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return events.groupBy("file", "segment").transformWithState(
        PairLines(_seconds(stalled_after), _seconds(late)), OUT, "Update", "EventTime")


def _append_batches(path: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")
    return write


def stream_runtimes(spark: SparkSession, lines: DataFrame, path: str, checkpoint_dir: str, available_now: bool = False,
                    stalled_after: str = STALLED_AFTER, late: str = LATE) -> StreamingQuery:
    """Keep ``path`` up to date with the runtimes of ``lines`` (a streaming DataFrame: file, source_kind, line_no, line).
    A batch that is run again replaces its own folder. State is kept in RocksDB."""
    ship_package(spark)
    spark.conf.set(STORE_CONF, ROCKSDB)
    w = runtime_changes(lines, stalled_after, late).writeStream.outputMode("update").foreachBatch(_append_batches(path)) \
        .option("checkpointLocation", checkpoint_dir)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")).start()


def _latest(spark: SparkSession, path: str) -> DataFrame:
    """What the last batch that spoke of a line said."""
    rows = spark.read.schema(OUT + ", batch long").parquet(path)
    return rows.groupBy("file", "segment", "line_no").agg(F.max_by(F.struct("crawl_date", "runtime_s", "state"), "batch").alias("x")) \
        .select("file", "segment", "line_no", "x.*")


def live_runtimes(spark: SparkSession, path: str) -> DataFrame:
    """The runtimes known so far, as ``logs.segment_runtime`` gives them."""
    return _latest(spark, path).where(F.col("state") == DONE).select("file", "crawl_date", "segment", "runtime_s")


def live_stalled(spark: SparkSession, path: str) -> DataFrame:
    """Segments whose download was followed by nothing for the time allowed: (file, segment, crawl_date, line_no)."""
    return _latest(spark, path).where(F.col("state") == STALLED).select("file", "segment", "crawl_date", "line_no")


def stream_sessions(lines: DataFrame, gap: str = HEARTBEAT_GAP, late: str = "1 hour") -> DataFrame:
    """Heartbeat sessions of a stream of log lines; a session is given out once the watermark has passed its end."""
    timed = lines.withColumn("ts", log_time(F.col("line")).cast("timestamp")).withWatermark("ts", late)
    return heartbeat_sessions(timed, gap)
