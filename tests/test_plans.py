"""Plan-shape checks: the physical plans we want at scale, asserted on the executed plan."""

from pyspark.sql.datasource import EqualTo, IsNotNull, StringContains

from conftest import SF001
from pagesift.operators import logs, match, outputs
from pagesift.sources.planted import relation
from pagesift.sources.wet import WetPushdownReader


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_postcode_pages_plan(spark):
    pp = match.postcode_pages(relation(spark, SF001, "wet_records"), relation(spark, SF001, "postcode_lookup"))
    plan = _plan(pp)
    assert plan.count("BroadcastHashJoin") == 1 and "LeftSemi" in plan
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert _optimized(pp).count("regexp_extract_all") == 1
    # map-side combine before the only shuffle
    assert plan.count("ObjectHashAggregate") == 2


def test_general_extraction_evaluated_once(spark):
    df = match.record_postcodes(relation(spark, SF001, "wet_records"))
    assert _optimized(df).count("regexp_extract_all") == 1
    assert _plan(df).count("regexp_extract_all") == 1


def test_lookup_beyond_the_threshold_is_not_broadcast(spark):
    pp = match.postcode_pages(relation(spark, SF001, "wet_records"), relation(spark, SF001, "postcode_lookup"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(pp)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "BroadcastHashJoin" not in plan and "LeftSemi" in plan
    assert pp.count() == 40


def test_first_failures_limits_before_shuffle(spark):
    ff = logs.first_failures(relation(spark, SF001, "log_lines"), 3)
    plan = _plan(ff)
    assert "WindowGroupLimit" in plan


def test_output_stats_reads_only_postcodes(spark, tmp_path):
    pp = match.postcode_pages(relation(spark, SF001, "wet_records"), relation(spark, SF001, "postcode_lookup"))
    pp.write.partitionBy("crawl_date").parquet(str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    stats = outputs.output_stats(back)
    plan = _plan(stats)
    assert "ReadSchema: struct<segment:int,postcodes:array<string>>" in plan
    assert stats.first().total_rows == 40


def test_reader_takes_pushed_filters():
    r = WetPushdownReader({"path": "/nonexistent"}, status_mode=False)
    fs = [EqualTo(("rec_type",), "conversion"), StringContains(("uri",), ".co.uk/"),
          EqualTo(("language",), "eng"), IsNotNull(("uri",))]
    back = list(r.pushFilters(fs))
    assert back == fs                       # Spark still re-checks every filter
    keep = r._keep()
    base = {"warc-type": "conversion", "warc-target-uri": "https://a.co.uk/x",
            "warc-identified-content-language": "eng"}
    assert keep(base)
    assert not keep({**base, "warc-type": "warcinfo"})
    assert not keep({**base, "warc-target-uri": "https://a.com/x"})
    assert not keep({k: v for k, v in base.items() if k != "warc-identified-content-language"})


def test_no_cross_join_sort_aggregate_or_python_in_any_query(spark):
    from pagesift.plans import catalog
    for name, fn in catalog.queries().items():
        plan = _plan(fn(spark, SF001))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "SortAggregate" not in plan, name          # hash aggregates only
        assert "EvalPython" not in plan, name             # no Python UDF in any query


# These write archives, text files or job outputs first, and read them back.
WRITES_FIRST = {"archive_roundtrip", "archive_status", "sliced_run", "text_inputs", "faulty_archives", "even_dealing", "compacted_run"}


def test_building_a_query_starts_no_job(spark):
    from pagesift.plans import catalog
    tracker = spark.sparkContext.statusTracker()
    for name, fn in catalog.queries().items():
        if name not in WRITES_FIRST:
            fn(spark, SF001)                            # the session infers Parquet schemas once
            spark.sparkContext.setJobGroup(f"build {name}", "")
            relation_reads = len(tracker.getJobIdsForGroup(f"build {name}"))
            fn(spark, SF001)
            jobs = tracker.getJobIdsForGroup(f"build {name}")
            stages = {tracker.getStageInfo(s).name for j in jobs for s in tracker.getJobInfo(j).stageIds if tracker.getStageInfo(s)}
            assert relation_reads == 0 and all("parquet" in s for s in stages), (name, stages)   # footers only
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_run_report_extracts_once(spark):
    from pagesift.plans import catalog
    df = catalog.queries()["run_report"](spark, SF001)
    df.collect()
    assert _optimized(df).count("explode(array_distinct(regexp_extract_all(") == 1


def test_archives_are_scanned_once(spark, tmp_path):
    """The job stages its scan: the archives' reader runs in one stage, before anything else."""
    from pagesift.plans import crawl_job
    from pagesift.sources import warc
    p = tmp_path / "a.wet.gz"
    p.write_bytes(warc.gzip_members([warc.encode_record({"WARC-Type": "warcinfo"}, b"x")]))
    manifest = spark.createDataFrame([("202104", 0, str(p))], "crawl_date string, segment int, path string")
    lookup = spark.createDataFrame([("BS1 4AB",)], "pcds string")
    res = crawl_job.filter_crawl(spark, manifest, lookup, str(tmp_path / "o"), str(tmp_path / "s"))
    assert "MapInArrow" not in _plan(res.status) and "MapInArrow" not in _plan(res.matches)


def test_checkpoint_folder_must_be_set_on_a_cluster():
    from types import SimpleNamespace

    import pytest
    from pagesift.session import ensure_checkpoint_dir
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: {}, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc))


def test_output_reads_prune_crawl_partitions(spark, tmp_path):
    from pyspark.sql import functions as F
    pp = match.postcode_pages(relation(spark, SF001, "wet_records"), relation(spark, SF001, "postcode_lookup"))
    pp.write.partitionBy("crawl_date").parquet(str(tmp_path / "out"))
    one = spark.read.parquet(str(tmp_path / "out")).where(F.col("crawl_date") == "202104")
    stats = outputs.output_stats(one)
    plan = _plan(stats)
    assert "PartitionFilters: [isnotnull(crawl_date" in plan and "(crawl_date#" in plan
    assert stats.first().total_rows == pp.where(F.col("crawl_date") == "202104").count()


def test_segment_status_with_errors_is_hash_aggregated(spark):
    from pagesift.operators.runs import segment_status
    m = spark.createDataFrame([("a", 0), ("a", 1)], "crawl_date string, segment int")
    sc = spark.createDataFrame([("a", 0, 5, "read", None), ("a", 1, 3, "partial", "EOFError: x")],
                               "crawl_date string, segment int, n_records long, state string, error string")
    st = segment_status(m, sc, m.limit(0))
    assert "SortAggregate" not in _plan(st)
    assert {r.segment: r.error for r in st.collect()} == {0: None, 1: "EOFError: x"}
