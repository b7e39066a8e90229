"""Job accounting: (job_id, submit_time, state, elapsed, time_limit) rows from the scheduler.

The reference shells out to live scheduler commands; here the accounting listing is an
ordinary input table, so every report is a plain aggregate over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.durations import (
    DEADLINE_ALERT_DAYS,
    TIME_WARN_PCT,
    duration_seconds,
    idiv,
    percent_floor,
)


def elapsed_seconds(accounting: DataFrame) -> DataFrame:
    """Elapsed and limit strings parsed to seconds (null when unparsable)."""
    return accounting.select("job_id", "state", "elapsed",
                             duration_seconds("elapsed").alias("elapsed_s"),
                             duration_seconds("time_limit").alias("limit_s"))


def time_limit_use(accounting: DataFrame, warn_pct: int = TIME_WARN_PCT) -> DataFrame:
    """Per job: whole hours elapsed / allowed, percent of the limit used, warning flag."""
    e = elapsed_seconds(accounting)
    pct = F.when(F.col("elapsed_s").isNotNull() & F.col("limit_s").isNotNull(),
                 percent_floor(F.col("elapsed_s"), F.col("limit_s")))
    return e.select("job_id", "state", "elapsed_s", "limit_s",
                    idiv(F.col("elapsed_s"), F.lit(3600)).alias("elapsed_h"),
                    idiv(F.col("limit_s"), F.lit(3600)).alias("limit_h"),
                    pct.alias("pct_used"), (pct > warn_pct).alias("near_limit"))


def jobs_by_state(accounting: DataFrame) -> DataFrame:
    """Job count per state (running / pending / completed / ...)."""
    return accounting.groupBy("state").agg(F.count(F.lit(1)).alias("n_jobs"))


def latest_job(accounting: DataFrame) -> DataFrame:
    """Per state, the most recently submitted job (ties broken by the larger id).

    ``row_number() == 1`` is planned with a map-side group limit: each task forwards one row
    per state, whatever the number of jobs."""
    w = Window.partitionBy("state").orderBy(F.col("submit_time").desc(), F.col("job_id").desc())
    return accounting.select("state", "job_id", "submit_time", F.row_number().over(w).alias("rn")) \
        .where(F.col("rn") == 1) \
        .select("state", F.col("job_id").alias("latest_job_id"),
                F.col("submit_time").alias("latest_submit_time"))


def first_jobs(accounting: DataFrame, n: int = 5,
               states: tuple[str, ...] = ("RUNNING", "PENDING")) -> DataFrame:
    """The first ``n`` jobs (lowest ids) of each active state, as the status listing shows the
    head of the queue; ``n=1`` with ``("RUNNING",)`` is the first running job."""
    w = Window.partitionBy("state").orderBy("job_id")
    return accounting.where(F.col("state").isin(*states)) \
        .select("state", "job_id", F.row_number().over(w).alias("rank")) \
        .where(F.col("rank") <= n)


# What the accounting listing writes. Sizes carry a binary unit, none means bytes; an exit code is
# ``code:signal``; these states are of jobs that have ended.
SIZE = r"^([0-9]+(?:\.[0-9]+)?)([KMGTkmgt]?)$"
EXIT = r"^([0-9]+):([0-9]+)$"
UNIT_MB = {"": 2.0 ** -20, "K": 2.0 ** -10, "M": 1.0, "G": 2.0 ** 10, "T": 2.0 ** 20}
ENDED = ("COMPLETED", "FAILED", "TIMEOUT", "OUT_OF_MEMORY", "CANCELLED", "NODE_FAIL", "PREEMPTED")
MEMORY_WARN_PCT = 90


def size_mb(text: str) -> F.Column:
    """Whole megabytes of a size text; null when it is empty or none."""
    unit = F.upper(F.regexp_extract(text, SIZE, 2))
    factor = F.lit(None).cast("double")
    for u, f in UNIT_MB.items():
        factor = F.when(unit == u, F.lit(f)).otherwise(factor)
    return F.when(F.col(text).rlike(SIZE), F.floor(F.regexp_extract(text, SIZE, 1).cast("double") * factor).cast("bigint"))


def failures_by_exit(accounting: DataFrame) -> DataFrame:
    """Ended jobs by state, exit code and signal (null where the listing has none): jobs, and their share of all
    ended jobs in whole percent. A job that completed with code and signal 0 is no failure."""
    ended = accounting.where(F.col("state").isin(*ENDED)).select(
        "state", *[F.when(F.col("exit_code").rlike(EXIT), F.regexp_extract("exit_code", EXIT, i)).cast("int").alias(c)
                   for i, c in ((1, "code"), (2, "signal"))])
    per = ended.groupBy("state", "code", "signal").agg(F.count(F.lit(1)).alias("n_jobs"))
    per = per.withColumn("pct_of_ended", percent_floor(F.col("n_jobs"), F.sum("n_jobs").over(Window.partitionBy())))
    good = (F.col("state") == "COMPLETED") & F.coalesce((F.col("code") == 0) & (F.col("signal") == 0), F.lit(False))
    return per.where(~good)


def resource_use(accounting: DataFrame, warn_pct: int = MEMORY_WARN_PCT) -> DataFrame:
    """Per state: jobs, those with a memory figure, mean and largest memory in MB, jobs above ``warn_pct`` of what they
    asked for, and CPU time used in whole percent of the CPU time held (null where nothing was held)."""
    held = duration_seconds("elapsed") * F.col("n_cpus")
    used = duration_seconds("cpu_time")
    known = used.isNotNull() & (held > 0)
    rows = accounting.select("state", size_mb("max_rss").alias("mb"), size_mb("req_mem").alias("asked"),
                             F.when(known, used).alias("used"), F.when(known, held).alias("held"))
    return rows.groupBy("state").agg(
        F.count(F.lit(1)).alias("n_jobs"), F.count("mb").alias("n_measured"), F.floor(F.avg("mb")).cast("bigint").alias("mean_mb"),
        F.max("mb").alias("max_mb"), F.count_if(F.col("mb") * 100 > F.col("asked") * warn_pct).alias("n_near_limit"),
        idiv(F.sum("used") * 100, F.sum("held")).alias("cpu_pct"))


def deadline_days(accounting: DataFrame, deadline: str,
                  alert_days: int = DEADLINE_ALERT_DAYS) -> DataFrame:
    """Per job: whole days from submission to ``deadline`` (truncated) and an alert flag."""
    secs = F.timestamp_diff("SECOND", F.col("submit_time"),
                            F.to_timestamp_ntz(F.lit(deadline)))
    days = idiv(secs, F.lit(86400))
    return accounting.select("job_id", "submit_time", days.alias("days_left"),
                             (days < alert_days).alias("deadline_alert"))
