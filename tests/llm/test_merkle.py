import hashlib
import zlib

import pytest
from pagesift.llm import merkle
from pagesift.llm.common import crc_mod
from pyspark.sql import functions as F

LOWER = str.maketrans(merkle.UPPER, merkle.LOWER)


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Levels from the nodes up to the root."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def steps(levels, i):
    for level in levels[:-1]:
        run = i // 16 * 16
        yield "".join(level[run:i]), "".join(level[i + 1:run + 16])
        i //= 16


def expected(rows):
    """rows: (doc_id, text, lang, source, n_chars)"""
    by = {}
    for d, text, lang, source, n in rows:
        hit = zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 0
        low = text.translate(LOWER) if text is not None and hit else text
        by.setdefault(source, []).append((d, leaf_of((d, source, lang, n, text)), leaf_of((d, source, lang, n, low))))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = tree([r[1] for r in by[s]])
    top = tree([trees[s][-1][0] for s in order]) if order else None
    out = []
    for k, s in enumerate(order):
        over = list(steps(top, k))
        for i, (d, leaf, other) in enumerate(by[s]):
            path = [*steps(trees[s], i), *over]
            node = other
            for left, right in path:
                node = sha(left, node, right)
            out.append((d, leaf, trees[s][-1][0], top[-1][0], sha(*(x for p in path for x in p)), node, node == top[-1][0]))
    return sorted(out, key=str)


def altered():
    return {"text": F.when(crc_mod(F.col("doc_id"), 5) == 0, F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(F.col("text"))}


def got(df):
    return sorted((tuple(r) for r in merkle.proofs(merkle.leaves(df, altered=altered())).select(
        "id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_odd_rows(spark, odd, none):
    from brute import ROWS
    assert got(odd) == expected(ROWS)
    assert got(none) == []


def test_documents(spark, rows01):
    df, rows = rows01
    want = expected([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows])
    assert got(df) == want
    assert {w[6] for w in want} == {True, False}


def test_rows_of_one_id_and_no_source_at_all(spark):
    rows = [(3, t, None, None, None) for t in ("B", "a", "a", None, "")] + [(None, "Z", None, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert got(df) == expected(rows)


@pytest.mark.parametrize("sizes", [(1,), (2,), (16, 1), (17,), (256, 257), (4097, 300), (65_600, 1, 15)])
def test_runs_blocks_and_rounds(spark, sizes):
    rows = [(i, f"T{i}", "en", f"s{k}", i) for k, n in enumerate(sizes) for i in range(n)]
    df = spark.range(max(sizes)).select(F.explode(F.array(*[F.lit(k) for k in range(len(sizes))])).alias("k"), "id") \
        .filter(F.col("id") < F.array(*[F.lit(n) for n in sizes])[F.col("k")]) \
        .select(F.col("id").alias("doc_id"), F.concat(F.lit("T"), "id").alias("text"), F.lit("en").alias("lang"),
                F.concat(F.lit("s"), "k").alias("source"), F.col("id").alias("n_chars"))
    assert got(df.repartition(7)) == expected(rows)


def test_many_sources_make_rounds_of_their_own(spark):
    rows = [(i, "x", "en", f"source {i}", 1) for i in range(300)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")) == expected(rows)


def test_the_proof_text_folds_to_the_root(spark, rows01):
    """The text of a proof is the siblings' digests themselves, 64 characters each."""
    out = merkle.proofs(merkle.leaves(rows01[0])).collect()
    assert all(r.verified and len(r.proof) % 64 == 0 and sha(r.proof) == r.proof_sha256 for r in out)
