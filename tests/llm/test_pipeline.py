import corpus_pipeline as cp
from pagesift.llm import mixing

from . import test_dedup as td
from . import test_tokens as tt


def test_stages_and_run(spark, odd, none):
    assert [n for n, _ in cp.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "source_mixing", "bpe"]
    for docs in (odd, none):
        for _, stage in cp.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns
            assert out.count() <= docs.count()
        assert cp.STAGES[-1][1](spark, docs, "").count() == docs.count()


def test_run_against_brute_force(spark):
    """What each stage keeps, by plain code; language ID keeps every text that has a letter."""
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rows = [r for r in rows if r[1] and any(map(str.isalpha, r[1]))]
    keep = {r[0] for r in td.expected_exact(rows) if r[3]}
    rows = [r for r in rows if r[0] in keep]
    keep = {r[2] for r in td.simhash_expected(rows)}
    rows = [r for r in rows if r[0] in keep]
    kept = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    taken = {r.doc_id for r in mixing.mix_documents(kept, max_epochs=1).filter("epochs > 0").collect()}
    got = cp.run(spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted((tuple(r) for r in got), key=str) == tt.bpe_expected([r for r in rows if r[0] in taken])
    assert len(got) > len(rows) / 2
