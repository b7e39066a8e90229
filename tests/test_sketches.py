"""Lookup filter and matching by key, postcode sketches stored per run, runtime quantile sketches and stragglers, listed files."""

import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pagesift.operators import logs, match, outputs
from pagesift.plans.crawl_job import filter_crawl
from pagesift.sources import sinks, warc
from pagesift.sources.planted import relation


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_text_crosses_the_semi_join(spark, no_broadcast):
    """With broadcasting off the hits' exchange holds record keys and postcodes, already filtered; text crosses one exchange."""
    records = relation(spark, SF001, "wet_records").withColumn("text", F.concat("text", F.lit("")))
    df = match.postcode_pages_by_key(records, relation(spark, SF001, "postcode_lookup"))
    plan = df._jdf.queryExecution().executedPlan()
    assert df.count() == 40
    tree = plan.toString()
    assert "BroadcastHashJoin" not in tree and "LeftSemi" in tree

    def exchanges(node):
        found = [node] if node.nodeName() == "Exchange" else []
        children = node.children()
        return found + [e for i in range(children.size()) for e in exchanges(children.apply(i))]
    found = [(e, re.findall(r"(\w+)#", e.output().mkString(","))) for e in exchanges(plan)]
    hits = [(e, n) for e, n in found if "pcds" in n and "record_no" in n]
    assert len(hits) == 1 and not {"text", "uri"} & set(hits[0][1])
    assert sum("text" in n for _, n in found) == 1
    below, node = [], hits[0][0]                       # the filter stands between the exchange and the explode
    while node.nodeName() != "Generate":
        node = node.children().apply(0)
        below.append((node.nodeName(), node.simpleString(100)))
    assert "Exchange" not in [n for n, _ in below] and any(n == "Filter" and "getbit" in text for n, text in below)


def test_by_key_equals_the_flagship(spark):
    records, lookup = relation(spark, SF001, "wet_records"), relation(spark, SF001, "postcode_lookup")
    key = ("segment", "record_no", "postcodes", "website", "text")
    for bits in (64, match.FILTER_BITS):                # a filter that lets almost all pass changes nothing
        got = match.postcode_pages_by_key(records, lookup, bits=bits).select(*key)
        assert sorted(map(str, got.collect())) == sorted(map(str, match.postcode_pages(records, lookup).select(*key).collect()))
    assert match.postcode_pages_by_key(records, lookup.limit(0)).count() == 0


def test_the_filter_has_no_false_negatives_and_few_false_positives(spark):
    ref = spark.range(20_000).select(F.concat(F.lit("BS"), "id").alias("pcds"))
    tested = spark.range(40_000).select(F.concat(F.lit("BS"), "id").alias("p"), (F.col("id") < 20_000).alias("listed"))
    said = tested.withColumn("may", match.may_be_listed(F.col("p"), match.lookup_filter(ref, 1 << 19), 1 << 19))
    got = {(r.listed, r.may): r["count"] for r in said.groupBy("listed", "may").count().collect()}
    assert got[(True, True)] == 20_000 and got.get((False, True), 0) < 400


def _crawl(spark, tmp_path, n=4, codes=60):
    rng, rows, listed = random.Random(3), [], [f"BS{i % 9 + 1} {i % 10}{a}B" for i in range(90) for a in "ABD"]
    d = tmp_path / "arch"
    d.mkdir(exist_ok=True)
    for i in range(n):
        body = [" ".join(rng.sample(listed, 5)).encode() for _ in range(codes)]
        (d / f"s{i}.wet").write_bytes(b"".join(warc.encode_record({
            "WARC-Type": "conversion", "WARC-Target-URI": f"https://a.co.uk/{i}/{j}", "WARC-Identified-Content-Language": "eng"}, b)
            for j, b in enumerate(body)))
        rows.append(("202104" if i < n // 2 else "202110", i, str(d / f"s{i}.wet")))
    return (spark.createDataFrame(rows, "crawl_date string, segment int, path string"),
            spark.createDataFrame([(p,) for p in listed], "pcds string"), *[str(tmp_path / x) for x in ("out", "st", "sk")])


@pytest.mark.parametrize("wide", [False, True])
def test_sketches_follow_the_runs_that_count(spark, tmp_path, wide):
    manifest, lookup, out, st, sk = _crawl(spark, tmp_path)
    for part in ({"task_id": 0}, {"task_id": 1}, {"segment": 0}):
        filter_crawl(spark, manifest, lookup, out, st, segments_per_task=2, sketch_dir=sk, wide_lookup=wide, **part)
    sketches = sinks.read_sketches(spark, sk, st)
    assert sorted((r.segment, r.n_matches) for r in sketches.collect()) == [(i, 60) for i in range(4)]
    matches = sinks.read_matches(spark, out, st)
    flat = matches.select("crawl_date", F.explode("postcodes").alias("p"))
    exact = {r.crawl_date: r.n for r in flat.groupBy("crawl_date").agg(F.countDistinct("p").alias("n")).collect()}
    exact[None] = flat.select("p").distinct().count()
    said = {r.crawl_date: r.n_postcodes for r in outputs.estimated_postcodes(sketches).collect()}
    assert set(said) == {"202104", "202110", None}
    assert all(abs(said[c] - exact[c]) <= outputs.SKETCH_BOUND * exact[c] for c in exact)
    plan = outputs.estimated_postcodes(sketches)._jdf.queryExecution().executedPlan().toString()
    assert "postcodes" not in re.sub("n_postcodes", "", plan)           # matches aren't read again


def test_large_sketches_stay_within_the_stated_error(spark):
    rows = spark.range(300_000).select(F.lit("c").alias("crawl_date"), (F.col("id") % 50).cast("int").alias("segment"),
                                       F.array(F.concat(F.lit("p"), F.col("id") % 120_000)).alias("postcodes"))
    got = {r.crawl_date: (r.n_matches, r.n_postcodes) for r in outputs.estimated_postcodes(outputs.postcode_sketches(rows)).collect()}
    assert got["c"] == got[None] and got["c"][0] == 300_000 and abs(got["c"][1] - 120_000) <= 0.05 * 120_000


def test_only_files_that_count_are_listed(spark, tmp_path):
    from pagesift.sources import files
    manifest, lookup, out, st, _ = _crawl(spark, tmp_path)
    for _ in range(2):
        filter_crawl(spark, manifest, lookup, out, st)
    every, counted = files.output_files(spark, out), sinks.current_files(spark, out, st)
    assert every.agg(F.sum("n_rows")).first()[0] == 480 and counted.agg(F.sum("n_rows")).first()[0] == 240
    assert counted.count() * 2 == every.count()
    sinks.compact_matches(spark, out, st)
    listed = sinks.current_files(spark, out, st).collect()
    assert all("_compacted" in r.file_path for r in listed) and sum(r.n_rows for r in listed) == 240


def test_quartiles_from_sketches_and_stragglers(spark):
    rng = random.Random(1)
    rows = [(f"t{i % 7}.log", c, i, rng.randint(100, 900) if c == "a" else 50) for c in ("a", "b") for i in range(5000)]
    rows += [("t0.log", "a", 9001, 5000), ("t1.log", "a", 9002, 3000), ("t1.log", "b", 9003, 51)]
    df = spark.createDataFrame(rows, "file string, crawl_date string, segment long, runtime_s long").repartition(5)
    sketches = logs.runtime_sketches(df)
    assert sketches.count() == 14                      # a sketch per crawl and log, merged below
    q = {r.crawl_date: r for r in logs.runtime_quartiles(sketches).collect()}
    times = sorted(r[3] for r in rows if r[1] == "a")
    for got, share in ((q["a"].q1_s, 0.25), (q["a"].median_s, 0.5), (q["a"].q3_s, 0.75)):
        assert abs(sum(t <= got for t in times) / len(times) - share) < 0.02
    assert q["a"].n_segments == 5002 and (q["b"].q1_s, q["b"].median_s, q["b"].q3_s) == (50, 50, 50)
    late = {(r.crawl_date, r.segment) for r in logs.straggler_segments(df, logs.runtime_quartiles(sketches)).collect()}
    assert late == {("a", 9001), ("a", 9002), ("b", 9003)}
