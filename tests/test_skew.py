"""Hot keys: one log file with a third of all lines, one postcode in a third of all pages.

Results must be exact, and the plans must combine map-side before the shuffle so the hot key
reaches its reducer as a handful of partial rows."""

from pyspark.sql import functions as F

from pagesift.operators import logs, match


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def _lines(spark, n=30000):
    # file hot.log holds one line in three; the rest spread over 50 files
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot.log"))
        .otherwise(F.concat(F.lit("f"), (F.col("id") % 50).cast("string"), F.lit(".log"))).alias("file"),
        F.lit("log").alias("source_kind"), F.col("id").alias("line_no"),
        F.when(F.col("id") % 7 == 0, F.lit("ERROR - Failed to download x"))
        .otherwise(F.lit("INFO - fine")).alias("line")).repartition(8)


def test_hot_log_file(spark):
    lines = _lines(spark)
    counts = logs.log_error_counts(lines)
    got = {r.file: r.n_errors for r in counts.collect()}
    assert got["hot.log"] == sum(1 for i in range(30000) if i % 3 == 0 and i % 7 == 0)
    plan = _plan(counts)
    assert "partial_count" in plan                     # map-side combine before the exchange
    first = logs.first_failures(lines, 3)
    hot = [r.line_no for r in first.where("file = 'hot.log'").orderBy("line_no").collect()]
    assert hot == [0, 21, 42]
    assert "WindowGroupLimit" in _plan(first)          # each task forwards <= 3 rows per file


def test_hot_postcode(spark):
    n = 3000
    recs = spark.range(n).select(
        F.lit("202104").alias("crawl_date"), (F.col("id") % 20).cast("int").alias("segment"),
        F.col("id").alias("record_no"), F.lit("conversion").alias("rec_type"),
        F.concat(F.lit("https://s"), F.col("id").cast("string"), F.lit(".co.uk/p")).alias("uri"),
        F.lit("eng").alias("language"),
        F.when(F.col("id") % 3 == 0, F.lit("visit BS1 4AB today"))
        .otherwise(F.concat(F.lit("at BS2 "), (F.col("id") % 10).cast("string"), F.lit("AB"))).alias("text"))
    lookup = spark.range(10).select(F.concat(F.lit("BS2 "), F.col("id").cast("string"), F.lit("AB")).alias("pcds")) \
        .unionByName(spark.createDataFrame([("BS1 4AB",)], "pcds string"))
    pages = match.postcode_pages(recs, lookup).select("record_no", "postcodes")
    a = sorted(tuple(r) for r in pages.collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")          # a shuffled join
    try:
        b = sorted(tuple(r) for r in match.postcode_pages(recs, lookup).select("record_no", "postcodes").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert a == b and len(a) == n
    assert sum(1 for _, pcs in a if pcs == ["BS1 4AB"]) == n // 3
