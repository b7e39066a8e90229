"""Queries over planted archives whose segments are fewer than the tasks that write them: some tasks hold no rows."""

import duckdb
import pytest

from oracle import compare
from pagesift.plans import catalog
from pagesift.sources.planted_archives import write_archives


@pytest.fixture
def documents(spark, tmp_path, monkeypatch):
    rows = [(n, f"page {n}", "fr" if n % 11 == 0 else "en", f"s{n % 3}", 8) for n in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int") \
        .coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(write_archives, "__defaults__", (2,))     # 60 tasks for 20 segments
    return str(tmp_path)


@pytest.mark.parametrize("name", ["archive_roundtrip", "archive_status", "compacted_run", "faulty_archives", "sliced_run"])
def test_archives_of_fewer_segments_than_tasks(spark, documents, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{documents}/documents.parquet/*.parquet')")
    n, problems = compare(catalog.QUERIES[name](spark, documents), con, catalog.oracle_sql()[name])
    assert n and not problems, problems
