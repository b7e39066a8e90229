"""Column expressions over page text and URIs (all JVM-side, no Python UDF)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the reference's for identical results.
# UK postcode: area of 1-2 capitals, district digit, optional capital/digit, ONE ASCII space,
# sector digit, two unit letters excluding C I K M O V.
UK_POSTCODE = r"\b[A-Z]{1,2}[0-9][A-Z0-9]? [0-9][ABD-HJLNP-UW-Z]{2}\b"
POSTCODE_PREFIX = "BS"          # area kept for the lookup
UK_HOST_MARK = ".co.uk/"        # literal, case-sensitive substring of the URI
LANGUAGE = "eng"                # exact value of WARC-Identified-Content-Language
CONVERSION = "conversion"       # WARC record type that carries extracted text
# ---------------------------------------------------------------------------

_AREA_PREFIX = re.compile(r"^[A-Z]{1,2}$")


def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def postcode_pattern(prefix: str | None = None) -> str:
    """Regex for postcodes, narrowed to one area prefix when that is exact.

    For an all-capital prefix of one or two letters the narrowed pattern finds exactly the
    general pattern's matches that start with ``prefix``: a match can only start with the
    prefix through the area branch, and no other match can overlap it (an inward code is a
    digit and two letters, an outward code starts with a letter).
    """
    if not prefix:
        return UK_POSTCODE
    if not _AREA_PREFIX.match(prefix):
        raise ValueError(f"prefix must be 1-2 capital letters, got {prefix!r}")
    area = re.escape(prefix) + ("" if len(prefix) == 2 else "[A-Z]?")
    return r"\b" + area + r"[0-9][A-Z0-9]? [0-9][ABD-HJLNP-UW-Z]{2}\b"


def extract_all(text: Column | str, pattern: str = UK_POSTCODE) -> Column:
    """All non-overlapping matches of ``pattern`` (whole match, group 0), in order."""
    return F.regexp_extract_all(col_(text), F.lit(unicode_words(pattern)), F.lit(0))


def unicode_words(pattern: str) -> str:
    """``pattern`` with word boundaries by Unicode on every Java (from 19 on ``\\b`` is ASCII by default)."""
    return "(?U)" + pattern


def postcodes(text: Column | str, pattern: str = UK_POSTCODE) -> Column:
    """Distinct matches, sorted so results are comparable across runs and engines."""
    return F.array_sort(F.array_distinct(extract_all(text, pattern)))


def website(uri: Column | str) -> Column:
    """Cut from the first ``.uk/`` to the end of the line (keeping ``.uk``), then drop every
    ``https://`` and every ``http://``. ``(?d)``: only ``\\n`` ends a line, as in Python."""
    cut = F.regexp_replace(col_(uri), r"(?d)\.uk/.*", ".uk")
    return F.replace(F.replace(cut, F.lit("https://"), F.lit("")), F.lit("http://"), F.lit(""))


def page_predicate(rec_type: Column | str = "rec_type", uri: Column | str = "uri",
                   language: Column | str = "language", url_contains: str = UK_HOST_MARK,
                   lang: str = LANGUAGE) -> Column:
    """Record type, URI substring and exact language tag; nulls drop the row."""
    return ((col_(rec_type) == F.lit(CONVERSION))
            & col_(uri).contains(url_contains)
            & (col_(language) == F.lit(lang)))


def segment_label(segment: Column | str) -> Column:
    """Zero-padded to at least five digits; never truncated."""
    return F.format_string("%05d", col_(segment))


def output_file_name(crawl_date: Column | str, segment: Column | str) -> Column:
    return F.concat(F.lit("crawldata"), col_(crawl_date), F.lit("segment"),
                    segment_label(segment), F.lit(".parquet"))


def join_url(base: str, path: Column | str) -> Column:
    """``base`` + relative ``path`` with exactly one slash between them; a path that is itself a URL
    (``scheme://``) stays as it is."""
    p = col_(path)
    return F.when(p.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), p).otherwise(
        F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(p, r"^/+", "")))
