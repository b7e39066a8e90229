"""Schemas of the relations the library reads and writes."""

from pyspark.sql import types as T

# Surrogate key of one archive record: (crawl, segment = 0-based manifest line, record position).
RECORD_KEY = ("crawl_date", "segment", "record_no")

WET_RECORD = T.StructType([
    T.StructField("crawl_date", T.StringType()),
    T.StructField("segment", T.IntegerType()),
    T.StructField("record_no", T.LongType()),
    T.StructField("rec_type", T.StringType()),
    T.StructField("uri", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
    T.StructField("content_length", T.LongType()),
    T.StructField("text", T.StringType()),
])

MATCH = T.StructType([
    T.StructField("crawl_date", T.StringType()),
    T.StructField("segment", T.IntegerType()),
    T.StructField("record_no", T.LongType()),
    T.StructField("uri", T.StringType()),
    T.StructField("website", T.StringType()),
    T.StructField("postcodes", T.ArrayType(T.StringType())),
    T.StructField("text", T.StringType()),
])

SEGMENT_STATUS = T.StructType([
    T.StructField("crawl_date", T.StringType()),
    T.StructField("segment", T.IntegerType()),
    T.StructField("n_records", T.LongType()),
    T.StructField("n_matches", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("n_retries", T.LongType()),
])

# Written beside matches and status: microseconds since 1970 at the start of the run.
RUN_ID = T.StructField("run_id", T.LongType())

# One row per archive file read by the ``wet`` source (status side of the scan).
SCAN_STATUS = T.StructType([
    T.StructField("crawl_date", T.StringType()),
    T.StructField("segment", T.IntegerType()),
    T.StructField("n_records", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("error", T.StringType()),
])

LOG_LINE = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("source_kind", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("line", T.StringType()),
])

CRAWL = T.StructType([
    T.StructField("crawl_date", T.StringType()),
    T.StructField("n_files", T.LongType()),
])

MANIFEST = T.StructType([
    T.StructField("crawl_date", T.StringType()),
    T.StructField("segment", T.IntegerType()),
    T.StructField("path", T.StringType()),
])
