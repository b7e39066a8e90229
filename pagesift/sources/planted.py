"""Planted relations: deterministic SQL over the driver's tables (see FIXTURES.md).

The driver's tables hold no crawl archives, postcodes, logs or job accounting, so the test
inputs are derived from them with SQL that is valid unchanged in Spark SQL and DuckDB. Each
text below is run by ``spark.sql`` over the driver tables and inlined as a CTE in the oracle SQL.
Every relation reads a driver table, so its size follows the scale factor -- except the
25-row ``crawl_lines`` and ``manifest`` fixtures over ``nation``, kept for the expected numbers
of FIXTURES.md; the registered queries use ``crawl_list_lines`` (one line per event) and
``archive_manifest`` (one archive per document) instead.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

# Driver tables each relation reads.
DEPENDS = {
    "wet_records": ("documents",),
    "postcode_lookup": ("documents",),
    "manifest": ("nation",),
    "archive_manifest": ("documents",),
    "crawl_lines": ("nation",),
    "crawl_list_lines": ("events",),
    "log_lines": ("events",),
    "segment_log": ("events",),
    "accounting": ("events",),
    "output_listing": ("documents",),
    "job_usage": ("events",),
}

SQL: dict[str, str] = {}

SQL["wet_records"] = """
select case when doc_id % 2 = 0 then '202104' else '202110' end as crawl_date,
  cast(doc_id % 20 as int) as segment,
  doc_id as record_no,
  case when doc_id % 50 = 49 then 'warcinfo' else 'conversion' end as rec_type,
  case when doc_id % 37 = 0 then cast(null as string) else
    concat(case when doc_id % 5 = 0 then 'http://' else 'https://' end, 'www.site', cast(doc_id % 17 as string),
      case when doc_id % 3 = 0 then '.com/p/' else '.co.uk/p/' end, cast(doc_id as string)) end as uri,
  case when doc_id % 23 = 0 then cast(null as string) when doc_id % 29 = 0 then 'eng,fra'
    when lang = 'en' then 'eng' when lang = 'fr' then 'fra' when lang = 'de' then 'deu' else 'spa' end as language,
  concat(text, case when doc_id % 4 = 0 then '' else
    concat(' BS', cast(doc_id % 12 + 1 as string), ' ', cast(doc_id % 10 as string), 'AB SW1A 1AA BS',
      cast(doc_id % 7 + 1 as string), ' ', cast(doc_id % 10 as string), 'DC BS',
      cast(doc_id % 12 + 1 as string), ' ', cast(doc_id % 10 as string), 'AB BS',
      cast(doc_id % 5 + 1 as string), ' ', cast(doc_id % 10 as string), 'AB.') end) as text
from documents
"""

SQL["postcode_lookup"] = """
select concat('BS', cast(doc_id % 9 + 1 as string), ' ', cast(doc_id % 10 as string),
    case when doc_id % 10 < 7 then 'AB' else 'AA' end) as pcds, source as ward
from documents
union all select cast(null as string) as pcds, 'none' as ward
"""

SQL["manifest"] = """
select '202104' as crawl_date, n_nationkey as segment,
  concat('crawl-data/202104/wet/part-', cast(n_nationkey as string), '.warc.wet.gz') as path
from nation
union all
select '202110' as crawl_date, n_nationkey as segment,
  concat('crawl-data/202110/wet/part-', cast(n_nationkey as string), '.warc.wet.gz') as path
from nation
"""

SQL["crawl_lines"] = """
select n_nationkey as line_no,
  case when n_nationkey % 7 = 0 then '# comment 1' when n_nationkey % 11 = 0 then '   '
    when n_nationkey % 5 = 4 then cast(202100 + n_nationkey as string)
    when n_nationkey % 13 = 0 then concat(cast(202100 + n_nationkey as string), ' abc')
    else concat(cast(202100 + n_nationkey as string), '  ', cast(64000 + n_nationkey * 160 as string)) end as line
from nation
"""

SQL["log_lines"] = """
select concat('task_', cast(user_id % 40 as string),
    case when event_id % 3 = 0 then '.err' when event_id % 3 = 1 then '.log' else '.out' end) as file,
  case when event_id % 3 = 0 then 'err' when event_id % 3 = 1 then 'log' else 'out' end as source_kind,
  event_id as line_no,
  concat(substr(cast(ts as string), 1, 19), ',000',
    case event_type
      when 'error' then concat(' - ERROR - Failed to download seg ', cast(event_id % 500 as string), ' after 5 attempts: timeout')
      when 'signup' then ' - WARNING - No records extracted from x.wet.gz'
      when 'purchase' then concat(' - INFO - Completed processing segment ', cast(event_id % 500 as string), ': ', cast(event_id % 17 as string), ' records')
      when 'view' then ' - INFO - [HEARTBEAT] Still running...'
      else ' - WARNING - Low disk space! following' end) as line
from events
"""

# One log per task, shared by both crawls (segments come twice, crawl after crawl, as when no job id is
# given); targets lie in an output folder; every tenth download is tried twice; the console (.err) repeats
# every line of the log.
_LOGGED = """
select concat('task_', cast(cast(floor(event_id / 2) as int) % 40 as string), '.{kind}') as file, '{kind}' as source_kind,
  event_id * 4 + {step} as line_no,
  concat(substr(cast(ts + interval '1' second * cast({seconds} as int) as string), 1, 19), ',000 - INFO - ', {message}) as line
from events{where}
"""
_TARGET = """concat('Downloading https://h/s', cast(event_id as string), '.gz to ',
    case when event_id % 3 = 0 then '' when event_id % 3 = 1 then 'output/' else '/data/run/output/' end, 'crawldata',
    case when event_id % 2 = 0 then '202104' else '202110' end, 'segment',
    lpad(cast(cast(floor(event_id / 2) as int) as string), 5, '0'), '.wet.gz')"""
_FINISHED = """concat('Completed processing segment ', cast(cast(floor(event_id / 2) as int) as string), ': ',
    cast(event_id % 17 as string), ' records')"""
SQL["segment_log"] = "union all".join(
    _LOGGED.format(kind=kind, step=step, seconds=seconds, message=message, where=where)
    for kind in ("log", "err") for step, seconds, message, where in (
        (0, "-30", _TARGET, " where event_id % 10 = 0"), (1, "0", _TARGET, ""), (2, "event_id % 600", _FINISHED, "")))

SQL["accounting"] = """
select event_id as job_id, ts as submit_time,
  case event_type when 'error' then 'FAILED' when 'click' then 'RUNNING' when 'view' then 'PENDING' else 'COMPLETED' end as state,
  case when event_id % 6 = 0 then concat(cast(event_id % 14 as string), '-0', cast(event_id % 10 as string), ':15:30')
    when event_id % 6 = 1 then concat(cast(event_id % 24 as string), ':05:07')
    when event_id % 6 = 2 then concat(cast(event_id % 60 as string), ':09')
    when event_id % 6 = 3 then 'UNLIMITED'
    when event_id % 6 = 4 then '168:00:00'
    else cast(event_id as string) end as elapsed,
  '7-00:00:00' as time_limit
from events
"""

# The same jobs with what they used: exit codes with signals, memory in several units, CPU time on two CPUs.
SQL["job_usage"] = """
select event_id as job_id,
  case event_type when 'error' then case event_id % 4 when 2 then 'OUT_OF_MEMORY' when 3 then 'TIMEOUT' else 'FAILED' end
    when 'click' then 'RUNNING' when 'view' then 'PENDING' else 'COMPLETED' end as state,
  case when event_type = 'error' then case event_id % 4 when 0 then '1:0' when 1 then '2:0' when 2 then '0:9' else '0:15' end
    when event_type = 'view' then '' when event_id % 41 = 0 then '3:0' else '0:0' end as exit_code,
  case event_id % 5 when 0 then concat(cast(event_id * 211 % 2097152 as string), 'K') when 1 then concat(cast(event_id % 2048 as string), '.50M')
    when 2 then '1.25G' when 3 then '' else cast(event_id * 1048577 as string) end as max_rss,
  '2G' as req_mem, 2 as n_cpus,
  concat(cast(event_id % 24 as string), ':05:07') as cpu_time,
  case when event_id % 9 = 0 then 'UNLIMITED' else concat(cast(event_id % 24 as string), ':30:00') end as elapsed
from events
"""

# Manifest at scale: one archive per document, alternating between the two crawls, so each
# crawl lists n/2 segments; records exist only for segments 0-19 (wet_records), the rest are
# still to run.
SQL["archive_manifest"] = """
select case when doc_id % 2 = 0 then '202104' else '202110' end as crawl_date,
  cast(floor(doc_id / 2) as int) as segment,
  concat('crawl-data/', case when doc_id % 2 = 0 then '202104' else '202110' end, '/wet/part-',
    cast(cast(floor(doc_id / 2) as int) as string), '.warc.wet.gz') as path
from documents
"""

# Crawl list at scale: the same five kinds of line as ``crawl_lines`` (comment, blank, date
# without a count, non-numeric count, good row), one line per event, dates over 52 weeks.
SQL["crawl_list_lines"] = """
select event_id as line_no,
  case when event_id % 7 = 0 then '# comment 1' when event_id % 11 = 0 then '   '
    when event_id % 5 = 4 then cast(202100 + event_id % 52 + 1 as string)
    when event_id % 13 = 0 then concat(cast(202100 + event_id % 52 + 1 as string), ' abc')
    else concat(cast(202100 + event_id % 52 + 1 as string), '  ', cast(64000 + (event_id % 100) * 160 as string)) end as line
from events
"""

# What a listing of the output folder gives: one file per document.
SQL["output_listing"] = """
select concat('out/crawl_date=', case when doc_id % 2 = 0 then '202104' else '202110' end, '/part-',
    cast(doc_id as string), '.parquet') as file_path,
  n_chars * 1000 + doc_id % 7 as file_size,
  timestamp '2024-01-01 00:00:00' + interval '1' minute * cast(doc_id * 37 % 1009 as int) as file_mtime
from documents
"""


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The planted relation ``name`` over the tables in ``sf_dir``.

    The tables are bound as DataFrame arguments of ``spark.sql`` (no session-wide temporary
    views), so calls for different scale folders never interfere."""
    text = SQL[name]
    for t in DEPENDS[name]:
        text = re.sub(rf"\b(from|join)\s+{t}\b", rf"\1 {{{t}}}", text, flags=re.IGNORECASE)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in DEPENDS[name]})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_relations(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs defining the planted relations ``names`` (for DuckDB).

    ``sql`` may itself start with ``WITH``; its CTEs are appended after the planted ones.
    """
    ctes = ",\n".join(f"{n} AS (\n{SQL[n].strip()}\n)" for n in names)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
