import random

import brute
import numpy as np
from oracle import compare, duck
from pagesift.llm import components, exact_dedup, mixing, simhash
from pyspark.sql import functions as F


def expected_exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault(brute.sha(brute.WS.sub(" ", r[1] or "")), []).append(r[0])
    out = set()
    for h, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out |= {(i, keep, len(ids), i == keep, h) for i in ids}
    return out


def exact(df):
    got = exact_dedup.exact_dedup(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_exact_dedup_odd_rows(odd, none):
    from brute import ROWS
    assert exact(odd) == expected_exact(ROWS)
    assert exact(none) == set()
    kept = sorted((r.doc_id is None, r.doc_id) for r in exact_dedup.keep_one(odd).collect())
    assert kept == sorted({(r[0] is None, r[0]) for r in expected_exact(ROWS) if r[3]})
    assert exact_dedup.keep_one(odd).columns == odd.columns


def test_exact_dedup_short_prefix_collisions(spark):
    rows = [(i, "same prefix " * 30 + str(i % 7), None, None, None) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert exact(df) == expected_exact(rows)


def simhash_expected(rows):
    fps = [brute.fingerprint(r[1]) for r in rows]
    low = {}
    for r, f in zip(rows, fps):
        if r[0] is not None:
            low[f] = min(low.get(f, r[0]), r[0])
    u = list(low)
    pairs = [(low[a], low[b]) for i, a in enumerate(u) for b in u[:i] if (a ^ b).bit_count() <= 4]
    comp = brute.components(pairs, list(low.values()))
    return sorted(((r[0], f"{f:016x}", comp.get(low.get(f))) for r, f in zip(rows, fps)), key=str)


def test_simhash_against_brute_force(spark, odd, none, rows01):
    from brute import ROWS
    for df, rows in ((odd, ROWS), (none, []), rows01):
        got = simhash.near_duplicates(df).select("doc_id", "fingerprint", "component_id").collect()
        assert sorted((tuple(r) for r in got), key=str) == simhash_expected([tuple(r) for r in rows])
    got = simhash.keep_one(rows01[0])
    want = {r[2] for r in simhash_expected([tuple(r) for r in rows01[1]])}
    assert sorted(r.doc_id for r in got.collect()) == sorted(want)


def test_keep_one_without_ids(spark):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (None, "a b c d e f g"), (None, "x y z w"), (None, "x y z w"),
            (None, None), (3, "q r s t u"), (3, "q r s t u")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit(1))
    got = sorted(((r.doc_id, r.text) for r in simhash.keep_one(df).collect()), key=str)
    assert got == sorted([(1, "a b c d e f g"), (None, "x y z w"), (None, None), (3, "q r s t u"), (3, "q r s t u")], key=str)
    got = sorted(((r.doc_id, r.text) for r in exact_dedup.keep_one(df).collect()), key=str)
    assert got == sorted([(1, "a b c d e f g"), (None, "x y z w"), (None, None), (3, "q r s t u")], key=str)


def test_simhash_links_dense_cells_and_bands(spark):
    rng = random.Random(5)
    fps = set()
    for _ in range(12):                                 # clusters around twelve centres, some dense
        c = rng.getrandbits(64)
        for _ in range(rng.choice([3, 20, 120])):
            x = c
            for _ in range(rng.randint(0, 7)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    fps |= {0, (1 << 64) - 1, 1 << 63}
    fps = sorted(fps)
    rows = [(int(np.uint64(f).view(np.int64)), i) for i, f in enumerate(fps)]
    df = spark.createDataFrame(rows, "fp long, rep long")
    pairs = [(i, j) for i, a in enumerate(fps) for j, b in enumerate(fps[:i]) if (a ^ b).bit_count() <= 4]
    want = brute.components(pairs, range(len(fps)))
    for kw in ({"bands": 6}, {"bands": 5}, {"bands": 7}, {"bands": 8, "max_cell": 10}, {"max_cell": 30}):
        got = components.components(simhash.links(df, **kw))
        have = {i: i for i in range(len(fps))} | {r.node: r.component for r in got.collect()}
        assert have == want, kw


def test_manhattan_bound(spark):
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-2**63, 2**63 - 1, 500) for _ in range(2))
    l1 = np.bitwise_count(simhash.unary(a) ^ simhash.unary(b))
    counts = [np.stack([(x.view(np.uint64) >> np.uint64(2 * i)) & np.uint64(1)
                        for i in range(32)]).astype(int) + np.stack([(x.view(np.uint64) >> np.uint64(2 * i + 1))
                                                                     & np.uint64(1) for i in range(32)]).astype(int)
              for x in (a, b)]
    assert (l1 == np.abs(counts[0] - counts[1]).sum(axis=0)).all()
    assert (l1 <= np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))).all()
    df = spark.createDataFrame([(int(x),) for x in a], "fp long").select("fp", simhash.unary(F.col("fp")).alias("u"))
    assert [r.u for r in df.collect()] == [int(x) for x in simhash.unary(np.array([r.fp for r in df.collect()])).view(np.int64)]


def test_components_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 4000), (4000, 5000), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(61)) and all(got[1000 + i] == 1000 for i in range(300))
    assert got[5000] == got[4000] == 4000
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mixing_oracle(spark):
    con = duck("/root/testdata/sf0.001")
    df = mixing.op8_mixing(spark, "/root/testdata/sf0.001")
    n, problems = compare(df, con, mixing.ORACLES["op8_mixing"])
    assert n and not problems, problems


def test_mixing_odd_rows_and_redistribution(spark, odd, none):
    from brute import ROWS
    got = mixing.mix_documents(odd).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in ROWS)
    assert mixing.mix_documents(none).count() == 0
    leaves = spark.createDataFrame([("a", "x", "s1", 10), ("a", "x", "s2", 1000), ("a", "y", "s3", 50),
                                    ("b", "x", "s4", 5)], "domain string, lang string, source string, supply long")
    w = {"domain": {"a": 1, "b": 1}, "lang": {}, "source": {"s1": 3, "s2": 1}}
    got = {r.source: r.alloc for r in mixing.leaf_budgets(leaves, w, 10, 1).collect()}
    # budget 106: b can use 5, so a gets 101; y takes its 50 and leaves 51 for x; s1 is full at 10
    assert got == {"s4": 5, "s3": 50, "s1": 10, "s2": 41}
    got = {r.source: r.alloc for r in mixing.leaf_budgets(leaves, w, 100, 1).collect()}
    assert got == {"s4": 5, "s3": 50, "s1": 10, "s2": 1000}
    zero = mixing.leaf_budgets(leaves, {"domain": {"b": 0}, "lang": {}, "source": {}}, 100, 3)
    assert {r.source: r.alloc for r in zero.collect()}["s4"] == 0
