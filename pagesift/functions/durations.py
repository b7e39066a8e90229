"""Scheduler duration strings, percentages, integer-division helpers (JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col_

# Accepted duration forms and thresholds of the reference's reports.
DAYS_HMS = r"^([0-9]+)-([0-9]{1,2}):([0-9]{2}):([0-9]{2})$"   # D-HH:MM:SS
HMS = r"^([0-9]{1,2}):([0-9]{2}):([0-9]{2})$"                  # HH:MM:SS
MS = r"^([0-9]{1,2}):([0-9]{2})$"                              # MM:SS
UNLIMITED = "UNLIMITED"
TIME_WARN_PCT = 80          # warn when elapsed exceeds this share of the limit
DEADLINE_ALERT_DAYS = 7     # alert when fewer days than this remain
ERROR_THRESHOLD = 5         # "high error count" above this
SUCCESS_NOTE_PCT = 90       # note when the success rate is below this
HEALTHY_PCT = 95            # healthy when no errors and the success rate is above this
LOW_COVERAGE_PCT = 10       # low postcode coverage below this
OUTPUT_SIZE_LIMIT_GB = 500  # warn when the output grows beyond this


def _group(s: Column, pattern: str, i: int) -> Column:
    return F.regexp_extract(s, pattern, i).cast("bigint")


def duration_seconds(s: Column | str) -> Column:
    """``''``/``UNLIMITED`` -> 0; ``D-HH:MM:SS``; ``HH:MM:SS``; ``MM:SS``; else the text as an
    integer; null when that fails (three-digit hours such as ``168:00:00`` included)."""
    s = col_(s)
    return (F.when(s.isNull() | (s == "") | (s == UNLIMITED), F.lit(0).cast("bigint"))
            .when(s.rlike(DAYS_HMS),
                  (_group(s, DAYS_HMS, 1) * 24 + _group(s, DAYS_HMS, 2)) * 3600
                  + _group(s, DAYS_HMS, 3) * 60 + _group(s, DAYS_HMS, 4))
            .when(s.rlike(HMS), _group(s, HMS, 1) * 3600 + _group(s, HMS, 2) * 60 + _group(s, HMS, 3))
            .when(s.rlike(MS), _group(s, MS, 1) * 60 + _group(s, MS, 2))
            .otherwise(s.try_cast("bigint")))


def idiv(a: Column, b: Column) -> Column:
    """Integer division truncating toward zero, as shell ``$(( a / b ))`` and SQL ``div``."""
    return F.call_function("div", a.cast("bigint"), b.cast("bigint"))


def percent_floor(part: Column, whole: Column) -> Column:
    """``part*100 div whole``; 0 when whole <= 0."""
    return F.when(whole <= 0, F.lit(0).cast("bigint")).otherwise(idiv(part * 100, whole))


def dhm_text(days: Column, hours: Column, minutes: Column) -> Column:
    """``Xd Yh Zm`` / ``Yh Zm`` / ``Zm`` as the status report prints it."""
    return (F.when(days > 0, F.format_string("%dd %dh %dm", days, hours, minutes))
            .when(hours > 0, F.format_string("%dh %dm", hours, minutes))
            .otherwise(F.format_string("%dm", minutes)))


def seconds_breakdown(seconds: Column) -> dict[str, Column]:
    """Days, hours, minutes of a duration in seconds (integer division cascade)."""
    total_h = idiv(seconds, F.lit(3600))
    return {
        "days": idiv(total_h, F.lit(24)),
        "hours": total_h % 24,
        "minutes": idiv(seconds % 3600, F.lit(60)),
    }


def minutes_breakdown(minutes: Column) -> dict[str, Column]:
    """Days, hours, minutes of a duration in minutes."""
    total_h = idiv(minutes, F.lit(60))
    return {"days": idiv(total_h, F.lit(24)), "hours": total_h % 24, "minutes": minutes % 60}
