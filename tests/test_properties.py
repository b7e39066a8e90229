"""Property tests: narrowed regex equals general regex + prefix, output invariants."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from pagesift.functions import text
from pagesift.operators import match
from pagesift.sources.planted import relation

TOKENS = ["BS1", "BS16", "BS1A", "BS", "SW1A", "B1", "E1", "4AB", "0HQ", "1QY", "4AC", "9ZZ",
          " ", " ", "-", ".", "X", "_", "1", "\n", "BS2 0HQ", "W1 4AB"]
texts = st.lists(st.lists(st.sampled_from(TOKENS), max_size=12).map("".join), min_size=50, max_size=200)


def py_general(t):
    return sorted(set(re.findall(text.UK_POSTCODE, t)))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts)
def test_narrow_equals_general_plus_prefix(spark, batch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, t string")
    rows = df.select("i", text.postcodes("t").alias("g"),
                     text.postcodes("t", text.postcode_pattern("BS")).alias("n")).orderBy("i").collect()
    for r in rows:
        t = batch[r.i]
        assert r.g == py_general(t)                       # Java regex == Python regex here
        assert r.n == [p for p in r.g if p.startswith("BS")]
        assert all(re.fullmatch(text.UK_POSTCODE.replace(r"\b", ""), p) for p in r.g)


def _sorted(df):
    return sorted(tuple(r) for r in df.select("crawl_date", "segment", "record_no", "postcodes").collect())


def test_lookup_duplicates_and_partitioning_do_not_change_output(spark):
    wet = relation(spark, SF001, "wet_records")
    lookup = relation(spark, SF001, "postcode_lookup")
    base = _sorted(match.postcode_pages(wet, lookup))
    doubled = _sorted(match.postcode_pages(wet, lookup.unionByName(lookup)))
    spread = _sorted(match.postcode_pages(wet.repartition(13), lookup.repartition(3)))
    assert base == doubled == spread
    keys = {r.pcds for r in lookup.collect() if r.pcds}
    assert all(set(r[3]) <= keys for r in base)


def test_same_uri_in_two_records_stays_two_rows(spark):
    wet = relation(spark, SF001, "wet_records").where("record_no in (1, 2)") \
        .withColumn("uri", F.lit("https://www.x.co.uk/p")).withColumn("language", F.lit("eng")) \
        .withColumn("rec_type", F.lit("conversion")).withColumn("text", F.lit("at BS1 1AB"))
    lookup = spark.createDataFrame([("BS1 1AB",)], "pcds string")
    assert match.postcode_pages(wet, lookup).count() == 2


URI_TOKENS = ["https://", "http://", "www.", "a", "b.", ".co.uk", ".uk", "/", "?u=", ".co.uk/", ".uk/",
              ":80", "x", "\r", "HTTPS://", ".com", "é", "-"]
uris = st.lists(st.lists(st.sampled_from(URI_TOKENS), max_size=10).map("".join), min_size=40, max_size=120)


def py_website(url):
    """By position: up to and with the first ".uk" that a slash follows, then from the line's end on;
    without scheme marks."""
    out, at = "", 0
    while (i := url.find(".uk/", at)) >= 0:
        out += url[at:i] + ".uk"
        end = url.find("\n", i)
        at = len(url) if end < 0 else end
    out += url[at:]
    for mark in ("https://", "http://"):
        out = "".join(out.split(mark))
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(uris)
def test_website_matches_documented_semantics(spark, batch):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(batch)], "i int, u string")
    rows = df.select("i", text.website("u").alias("w"), F.col("u").contains(text.UK_HOST_MARK).alias("k")) \
        .orderBy("i").collect()
    for r in rows:
        assert r.w == py_website(batch[r.i])
        assert r.k == (".co.uk/" in batch[r.i])


DUR = st.one_of(
    st.tuples(st.integers(0, 30), st.integers(0, 99), st.integers(0, 59), st.integers(0, 59)).map(
        lambda t: f"{t[0]}-{t[1]:02d}:{t[2]:02d}:{t[3]:02d}"),
    st.tuples(st.integers(0, 99), st.integers(0, 59), st.integers(0, 59)).map(lambda t: f"{t[0]}:{t[1]:02d}:{t[2]:02d}"),
    st.tuples(st.integers(0, 99), st.integers(0, 59)).map(lambda t: f"{t[0]}:{t[1]:02d}"),
    st.integers(0, 10**6).map(str), st.sampled_from(["", "UNLIMITED", "168:00:00", "1-2:3:4", "abc"]))


def py_seconds(t):
    if t in ("", "UNLIMITED"):
        return 0
    for pat, f in ((r"([0-9]+)-([0-9]{1,2}):([0-9]{2}):([0-9]{2})", lambda d, h, m, s: (d * 24 + h) * 3600 + m * 60 + s),
                   (r"([0-9]{1,2}):([0-9]{2}):([0-9]{2})", lambda h, m, s: h * 3600 + m * 60 + s),
                   (r"([0-9]{1,2}):([0-9]{2})", lambda m, s: m * 60 + s)):
        mt = re.fullmatch(pat, t)
        if mt:
            return f(*map(int, mt.groups()))
    return int(t) if t.isdigit() else None


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(DUR, min_size=30, max_size=80))
def test_duration_seconds_matches_python(spark, batch):
    from pagesift.functions.durations import duration_seconds
    df = spark.createDataFrame([(i, t) for i, t in enumerate(batch)], "i int, t string")
    for r in df.select("i", duration_seconds("t").alias("s")).orderBy("i").collect():
        assert r.s == py_seconds(batch[r.i]), batch[r.i]
