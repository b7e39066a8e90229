"""Page filter, postcode extraction and reference-list matching (the flagship job).

Plan shape of :func:`postcode_pages`::

    scan -> Filter(rec_type, uri contains, language)            (pushed to the source)
         -> Generate explode(array_distinct(regexp_extract_all)) (regex evaluated once)
         -> LeftSemi join with the lookup: broadcast while Spark's statistics put it below the
            broadcast threshold, else shuffled, where AQE splits a postcode that many pages hold
         -> partial ObjectHashAggregate per record
         -> Exchange hashpartitioning(record key)                (matched pages only)
         -> final aggregate -> Project(website, lower(text))

The only shuffle carries pages that matched, one row per page after map-side combine.
Keys are unique per record, so no group can be skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    CONVERSION,
    LANGUAGE,
    POSTCODE_PREFIX,
    UK_HOST_MARK,
    UK_POSTCODE,
    extract_all,
    page_predicate,
    postcode_pattern,
    postcodes,
    unicode_words,
    website,
)
from ..schemas import RECORD_KEY


def page_filter(records: DataFrame, url_contains: str = UK_HOST_MARK,
                language: str = LANGUAGE) -> DataFrame:
    """Conversion records whose URI contains ``url_contains`` and whose language is ``language``."""
    return records.where(page_predicate(url_contains=url_contains, lang=language))


def lookup_keys(lookup: DataFrame, prefix: str | None = POSTCODE_PREFIX,
                key: str = "pcds") -> DataFrame:
    """The reference column only; nulls and keys that cannot match the prefix removed.

    No ``distinct``: a semi join ignores duplicates, and a distinct would add an exchange.
    """
    if key not in lookup.columns:
        raise ValueError(f"lookup has no column {key!r}; columns: {lookup.columns}")
    ref = lookup.select(F.col(key).alias("pcds")).where(F.col("pcds").isNotNull())
    if prefix:
        ref = ref.where(F.col("pcds").startswith(prefix))
    return ref


def record_postcodes(records: DataFrame, pattern: str = UK_POSTCODE) -> DataFrame:
    """Every record with at least one match: key + sorted distinct postcodes (general form).

    Guarded by ``rlike`` (stops at the first hit) instead of ``size(extracted) > 0``, which
    Catalyst would answer by inlining the extraction into the filter: the full extraction
    then runs once, on matching records only."""
    return records.where(F.col("text").rlike(unicode_words(pattern))) \
        .select(*RECORD_KEY, postcodes("text", pattern).alias("postcodes"))


def prefixed_postcodes(records: DataFrame, prefix: str = POSTCODE_PREFIX) -> DataFrame:
    """One row per (record, distinct postcode starting with ``prefix``)."""
    narrow = postcode_pattern(prefix)
    return records.select(*RECORD_KEY,
                          F.explode(F.array_distinct(extract_all("text", narrow))).alias("postcode"))


def lookup_match(records: DataFrame, lookup: DataFrame, prefix: str = POSTCODE_PREFIX,
                 key: str = "pcds") -> DataFrame:
    """(record, postcode) pairs whose postcode is in the reference list (equi semi join)."""
    ref = lookup_keys(lookup, prefix, key)
    hits = prefixed_postcodes(records, prefix)
    return hits.join(ref.withColumnRenamed("pcds", "postcode"), "postcode", "left_semi") \
        .select(*RECORD_KEY, "postcode")


def postcode_pages(records: DataFrame, lookup: DataFrame, *, url_contains: str = UK_HOST_MARK,
                   language: str = LANGUAGE, prefix: str = POSTCODE_PREFIX, key: str = "pcds") -> DataFrame:
    """Pages under ``url_contains`` tagged ``language`` that mention a listed postcode.

    Output: crawl_date, segment, record_no, uri, website, postcodes (sorted, distinct,
    never empty), text (lower-cased after extraction). One row per matching record; the
    same URI in two records stays two rows.
    """
    narrow = postcode_pattern(prefix)
    pages = page_filter(records.select(*RECORD_KEY, "rec_type", "uri", "language", "text"),
                        url_contains, language)
    hits = pages.select(*RECORD_KEY, "uri", "text",
                        F.explode(F.array_distinct(extract_all("text", narrow))).alias("pcds"))
    matched = hits.join(lookup_keys(lookup, prefix, key), "pcds", "left_semi")
    grouped = matched.groupBy(*RECORD_KEY).agg(
        F.any_value("uri").alias("uri"),
        F.array_sort(F.collect_set("pcds")).alias("postcodes"),
        F.any_value("text").alias("text"),
    )
    return grouped.select(*RECORD_KEY, "uri", website("uri").alias("website"), "postcodes",
                          F.lower("text").alias("text"))


FILTER_BITS = 1 << 22        # 512 KB; at two bits a key some 0.2 % of other keys pass beside 100,000 listed ones


def _bit_places(key: F.Column, bits: int) -> list[F.Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(2)]


def lookup_filter(ref: DataFrame, bits: int = FILTER_BITS, key: str = "pcds") -> F.Column:
    """A Bloom filter of ``ref``'s ``key`` as one array of 64-bit words, a scalar subquery of a size fixed by ``bits``."""
    places = ref.select(F.explode(F.array(*_bit_places(F.col(key), bits))).alias("_p"))
    words = places.select(F.expr("_p div 64").alias("_w"), F.expr("shiftleft(1L, cast(_p % 64 AS int))").alias("_b")) \
        .groupBy("_w").agg(F.bit_or("_b").alias("_b"))
    every = ref.sparkSession.range(bits // 64).select(F.col("id").alias("_w"), F.lit(0).cast("bigint").alias("_b"))
    return words.unionByName(every).groupBy("_w").agg(F.bit_or("_b").alias("_b")) \
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_w", "_b"))), lambda x: x["_b"]).alias("filter")).scalar()


def may_be_listed(key: F.Column, bloom: F.Column, bits: int = FILTER_BITS) -> F.Column:
    """False only for keys that the filter's table doesn't hold."""
    tests = [F.getbit(F.get(bloom, F.floor(p / 64).cast("int")), (p % 64).cast("int")) == 1 for p in _bit_places(key, bits)]
    return tests[0] & tests[1]


def postcode_pages_by_key(records: DataFrame, lookup: DataFrame, *, url_contains: str = UK_HOST_MARK, language: str = LANGUAGE,
                          prefix: str = POSTCODE_PREFIX, key: str = "pcds", bits: int = FILTER_BITS) -> DataFrame:
    """:func:`postcode_pages` for lookups too large to broadcast, over records that are cheap to read twice (the job's
    staged scan). A Bloom filter of the lookup drops postcodes in the stage that extracts them; the semi join's
    shuffles carry record keys and postcodes only. Text is attached after it by key and crosses one shuffle, once a page
    (a runtime filter of the matched keys, where the session allows one, leaves only theirs)."""
    narrow, ref = postcode_pattern(prefix), lookup_keys(lookup, prefix, key)
    bloom = lookup_filter(ref, bits)
    pages = page_filter(records.select(*RECORD_KEY, "rec_type", "uri", "language", "text"), url_contains, language)
    hits = pages.select(*RECORD_KEY, F.explode(F.array_distinct(extract_all("text", narrow))).alias("pcds")) \
        .where(may_be_listed(F.col("pcds"), bloom, bits))
    matched = hits.join(ref, "pcds", "left_semi").groupBy(*RECORD_KEY).agg(F.array_sort(F.collect_set("pcds")).alias("postcodes"))
    texts = pages.where(F.col("text").rlike(unicode_words(narrow))).select(*RECORD_KEY, "uri", "text")
    return texts.join(matched, list(RECORD_KEY)).select(
        *RECORD_KEY, "uri", website("uri").alias("website"), "postcodes", F.lower("text").alias("text"))


def lower_text(records: DataFrame) -> DataFrame:
    """Conversion records with their text lower-cased (the output text form)."""
    return records.where(F.col("rec_type") == CONVERSION) \
        .select(*RECORD_KEY, F.lower("text").alias("text"))
