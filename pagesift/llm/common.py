"""Shared helpers of the training-data operators: staging, the contract's fixed text rules."""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift.session import ensure_checkpoint_dir
from pagesift.session import ship_package as _ship

BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20           # rows that a Python task holds at once, however long their texts


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in Python workers, and bound the Arrow batches they get by bytes
    (the session's own smaller bound stays)."""
    _ship(spark)
    if int(spark.conf.get(BATCH_CONF).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


def release() -> None:
    """Give memory that a task has freed back to the system: Python workers are used again, and two
    on an executor would else keep their peaks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back: the
    lineage is cut there, and a lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(mod)


def normalised(text: Column) -> Column:
    """Null as empty; every run of white space as one space. Only runs that differ from one
    space are matched, so ordinary texts are scanned but not rebuilt."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]{2,}|[\\x09-\\x0D]", " ")
