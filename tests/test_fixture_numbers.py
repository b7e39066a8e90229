"""The expected results on the planted relations listed in FIXTURES.md section 4."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF01
from pagesift.operators import jobs, logs, match, outputs, runs
from pagesift.sources.planted import relation

EXPECTED = {
    SF001: dict(page_rows=75, page_chars=199_849, pages=40, distinct=17, cov=(20, 20.0),
                log=(136, 267, 123, 950), runtime=(1000, 0, 599, 259_500),
                acct=(401, 338, 40_967_097)),
    SF01: dict(page_rows=370, page_chars=857_760, pages=192, distinct=18, cov=(20, 19.2),
               log=(1349, 2704, 1321, 10_311), runtime=(10_000, 0, 599, 2_955_000),
               acct=(3998, 3342, 384_133_134)),
}


@pytest.fixture(params=[SF001, SF01])
def sf(request):
    return request.param


def _pages(spark, d):
    return match.postcode_pages(relation(spark, d, "wet_records"), relation(spark, d, "postcode_lookup"))


def test_page_filter_and_matches(spark, sf):
    e = EXPECTED[sf]
    pf = match.page_filter(relation(spark, sf, "wet_records"))
    row = pf.agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
    assert (row[0], row[1]) == (e["page_rows"], e["page_chars"])
    pp = _pages(spark, sf)
    assert pp.count() == e["pages"]
    assert outputs.distinct_postcodes(pp).count() == e["distinct"]
    # postcodes are never empty, sorted, distinct, all BS, all in the lookup
    lookup = {r.pcds for r in relation(spark, sf, "postcode_lookup").collect() if r.pcds}
    for r in pp.select("postcodes").collect():
        assert r.postcodes and r.postcodes == sorted(set(r.postcodes))
        assert all(p.startswith("BS") and p in lookup for p in r.postcodes)


def test_coverage(spark, sf):
    e = EXPECTED[sf]
    wet = relation(spark, sf, "wet_records")
    rows = outputs.records_with_matches(wet, _pages(spark, sf))
    c = outputs.postcode_coverage(rows).first()
    assert c.n_files == e["cov"][0]
    assert round(c.pct_with_postcodes, 1) == e["cov"][1]
    scanned = wet.groupBy("crawl_date", "segment").agg(F.count(F.lit(1)).alias("n_records"))
    c2 = outputs.coverage_from_counts(scanned, _pages(spark, sf)).first()
    assert c2.n_files == c.n_files and abs(c2.pct_with_postcodes - c.pct_with_postcodes) < 1e-9


def test_segment_states_and_progress(spark, sf):
    wet = relation(spark, sf, "wet_records")
    manifest = relation(spark, sf, "manifest")
    scanned = wet.groupBy("crawl_date", "segment").agg(F.count(F.lit(1)).alias("n_records"))
    status = runs.segment_status(manifest, scanned, _pages(spark, sf))
    counts = {r.state: r["count"] for r in status.groupBy("state").count().collect()}
    assert counts == {"done": 10, "empty": 10, "pending": 30}
    rem = runs.remaining_segments(manifest, status).groupBy("crawl_date").count().collect()
    assert sorted((r.crawl_date, r["count"]) for r in rem) == [("202104", 15), ("202110", 15)]
    crawls = runs.parse_crawl_list(relation(spark, sf, "crawl_lines"))
    prog = runs.progress_by_crawl(crawls, manifest, status).where(F.col("n_segments") > 0).collect()
    assert sorted((r.crawl_date, r.n_finished, r.n_segments, r.pct_complete) for r in prog) == [
        ("202104", 10, 25, 40), ("202110", 10, 25, 40)]


def test_log_totals(spark, sf):
    e = EXPECTED[sf]
    lines = relation(spark, sf, "log_lines")
    err = logs.log_error_counts(lines).agg(F.sum("n_errors"), F.sum("n_warnings")).first()
    succ = logs.log_success_totals(lines).agg(F.sum("n_success"), F.sum("n_records")).first()
    assert (err[0], err[1], succ[0], succ[1]) == e["log"]


def test_runtimes(spark, sf):
    rt = logs.segment_runtime(relation(spark, sf, "segment_log"))
    r = rt.agg(F.count(F.lit(1)), F.min("runtime_s"), F.max("runtime_s"), F.sum("runtime_s")).first()
    assert tuple(r) == EXPECTED[sf]["runtime"]


def test_accounting_completed(spark, sf):
    e = jobs.elapsed_seconds(relation(spark, sf, "accounting")).where("state = 'COMPLETED'")
    r = e.agg(F.count(F.lit(1)), F.count("elapsed_s"), F.sum("elapsed_s")).first()
    assert tuple(r) == EXPECTED[sf]["acct"]


def test_crawl_list_fixture(spark):
    kept = runs.parse_crawl_list(relation(spark, SF001, "crawl_lines"))
    assert kept.count() == 14
