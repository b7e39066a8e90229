"""Session helpers.

Library code never creates its own session; it takes the caller's. ``local_session`` is the
convenience used by tests and ``bench.py``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pagesift",
                  driver_memory: str = "8g") -> SparkSession:
    """A local session configured the way the library expects to run on a cluster."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.python.filterPushdown.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Where the setting is absent a scratch folder is created and set on a ``local`` master (tests);
    on a cluster this raises, as executors don't share the driver's disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="pagesift-ckpt-")
    sc.setCheckpointDir(path)
    return path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back: the lineage is cut
    there, and a lost executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``pagesift`` importable in the Python workers (``addPyFile`` of a zip of the
    package), once per application. Operators that run Python in tasks call this; with
    ``spark-submit --py-files pagesift.zip`` it only adds a second copy of the same code."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = "/" + base[len("file:"):].lstrip("/")
    target = base if "://" not in base else tempfile.mkdtemp(prefix="pagesift-code-")
    os.makedirs(target, exist_ok=True)
    zip_path = os.path.join(target, f"pagesift-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(zip_path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, names in os.walk(pkg_dir):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zip_path)
    _SHIPPED.add(sc.applicationId)
