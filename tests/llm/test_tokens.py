import hashlib
import math
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
from pagesift.llm import bpe, lm
from pagesift.llm.common import crc_mod
from pagesift.llm.wordblocks import split_words, unpack, unpack_words, word_blocks, words_of
from pyspark.sql import functions as F


def bpe_expected(rows):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))
    out = []
    for r in rows:
        ids = t.encode(r[1] or "", add_special_tokens=False).ids
        text = t.decode(ids, skip_special_tokens=False)
        out.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), brute.sha(text)))
    return sorted(out, key=str)


def test_bpe_matches_the_library(spark, odd, none, rows01):
    from brute import ROWS
    for df, rows, kw in ((odd, ROWS, {}), (none, [], {}), (*rows01, {}), (*rows01, {"buckets": 3, "block_bytes": 20000})):
        got = bpe.with_digests(bpe.encode(df, **kw)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
        assert sorted((tuple(r) for r in got), key=str) == bpe_expected([tuple(r) for r in rows])


def test_decode_joins_pieces(spark):
    df = spark.createDataFrame([(1, [320, 1929, 49407]), (2, []), (3, None)], "k int, ids array<int>")
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(bpe.tokenizer_json())
    got = {r.k: r.decoded for r in bpe.decode(df, "k", "ids").collect()}
    assert got == {1: t.decode([320, 1929, 49407], skip_special_tokens=False), 2: "", 3: ""}


def lm_base(rows):
    train = [brute.words(r[1]) for r in rows if brute.crc_mod(r[0], 7) != 2]
    counts = {}
    for ws in train:
        for w in [*ws, None]:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for r in rows:
        ws = [*brute.words(r[1]), None]
        out.append((r[0], brute.crc_mod(r[0], 7) == 2, len(ws), sum(w in counts for w in ws), n,
                    round(sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in ws), 5)))
    return sorted(out, key=str)


def test_lm_base_and_score(spark, odd, none, rows01):
    from brute import ROWS
    for df, rows in ((odd, ROWS), (none, []), rows01):
        held = crc_mod(F.col("doc_id"), 7) == 2
        got = lm.score(df, ~held).withColumn("held_out", held).collect()
        assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5))
                       for r in got), key=str) == lm_base([tuple(r) for r in rows])
        assert all(math.isfinite(r.score) and r.score < 0 and r.bits_per_byte > 0 for r in got)


def test_lm_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = crc_mod(F.col("doc_id"), 7) == 2
    got = lm.score(docs, ~held).withColumn("held_out", held).filter("held_out").agg(
        F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert got.s > got.b, got


def test_lm_is_a_distribution():
    """The spelling model's probabilities of all short words and their continuations sum to 1."""
    words = [b"the", b"then", b"a", b"of", b"on"] * 3
    n = np.zeros(2 * lm.SLOTS, np.int64)
    for _, raw, _, pos in lm.streams(words):
        for _, bit, slots in lm.bits(raw, pos):
            for s in slots:
                np.add.at(n, 2 * s + bit, 1)
    q = lm.quantise(n.reshape(-1, 2))
    m = lm.Mixer(q[:, 0] << 8 | q[:, 1])
    counts = np.zeros(2 * lm.N_GATE * lm.N_MAP, np.int64)
    m.learn(words, counts)
    assert counts.sum() == 8 * sum(len(w) + 1 for w in words)
    m.refine = np.full(lm.N_GATE * lm.N_MAP, 0.5)
    raw, pos = np.arange(256, dtype=np.uint8), np.zeros(256, np.int64)
    total = np.zeros(256)
    for j, bit, slots in lm.bits(raw, pos):
        z, _, _ = m.mix(j * 4 + pos, slots)
        p = 0.5 / (1 + np.exp(-z)) + 0.25
        total += np.log10(np.where(bit == 1, p, 1 - p))
    assert abs((10 ** total).sum() - 1) < 1e-9
    assert m.spell([b"the"])[0] > m.spell([b"qzx"])[0]


def token_model(seed=0):
    """A mixer along texts with random counts and weights, and a block's words."""
    rng = np.random.default_rng(seed)
    m = lm.TokenMixer(rng.integers(0, 1 << 16, lm.TOKEN_SLOTS).astype(np.uint16))
    m.w = rng.uniform(-0.2, 0.4, m.w.shape)
    m.refine = rng.uniform(0.05, 0.95, lm.NODES * lm.N_MAP)
    counts = rng.integers(1, 30, (lm.GROUPS, 12))
    counts[:, [3, 7]] = 0                                                  # words that training has never seen
    cls = np.where(counts.sum(axis=0) > 0, 1 + rng.integers(0, 16, 12), 0)
    found = pa.table({"rank": np.arange(11), "cls": cls[:-1], "hash": rng.integers(0, 1 << 32, 11), "spelled": rng.uniform(-9, -4, 11),
                      "size": np.full(11, 3), **{c: n[:-1] for c, n in zip(lm.COUNTS, counts)}})
    end = {"cls": cls[-1], "hash": 0, "spelled": -2.0, "size": 0, **{c: n[-1] for c, n in zip(lm.COUNTS, counts)}}
    totals = np.zeros((lm.GROUPS, 17), np.int64)
    np.add.at(totals.T, cls, counts.T)
    return m, lm.Words(found, end), totals


def plain_log10(m, w, totals, text):
    """One text token by token, each decision on its own."""
    out = []
    for t, word in enumerate(text):
        syms = [int(w.cls[x]) for x in text[:t]]
        groups = [lm.GROUPS if s == 0 else (s - 1) // 4 for s in syms]
        one, two = ([17, 17, *syms])[-1], ([17, 17, *syms])[-2]
        recent = groups[-lm.WINDOW:]
        often = [recent.count(g) for g in range(lm.GROUPS + 1)]
        top = often[:-1].index(max(often[:-1]))
        lot = max(len(recent), 1)
        ctx = [one, one * 18 + (two if t > 1 else 17), sum(([5] * 4 + groups)[-k] * 6 ** (k - 1) for k in range(1, 5)),
               (int(w.hash[text[t - 1]]) * 0x9E3779B1 % 2 ** 32) >> 19 if t else 0,
               (top * 8 + min(8 * often[top] // lot, 7)) * 4 + min(8 * often[-1] // lot, 3),
               min(int(math.log2(t + 1)), 15) * 8 + min(32 * groups.count(lm.GROUPS) // max(t, 1), 7)]

        def chance(node):
            v = [int(m.tables[lm.TOKEN_OFFSETS[i] + c * lm.NODES + node]) for i, c in enumerate(ctx)]
            gate = node * 4 + min((int(lm.CONF[v[3]]) & 7) // 2, 3)
            z = max(-14, min(14, sum(float(m.w[gate, i]) * float(lm.STRETCH[x]) for i, x in enumerate(v))))
            return 0.5 / (1 + math.exp(-z)) + 0.5 * m.refine[node * lm.N_MAP + round((z + 14) * (lm.N_MAP - 1) / 28)]

        s = int(w.cls[word])
        known = 0.0
        if s:
            known, node = chance(0), 1
            for j in range(4):
                bit = (s - 1) >> 3 - j & 1
                known *= chance(node) if bit else 1 - chance(node)
                node = 2 * node + bit
            whole = w.n[word] / totals[:, s].sum()
            own = getattr(w, lm.COUNTS[top])[word] / max(totals[top, s], 1)
            known *= (1 - lm.BACKOFF) * own + lm.BACKOFF * whole if t and totals[top, s] else whole
        cache = lm.CACHE if t else 0
        p = (1 - cache) * (known + (1 - chance(0)) * 10 ** float(w.spelled[word])) + cache * text[:t].count(word) / max(t, 1)
        out.append(math.log10(p))
    return out


def test_lm_along_texts_against_a_plain_version():
    m, w, totals = token_model()
    rng = np.random.default_rng(1)
    texts = [[*rng.integers(0, 11, n), 11] for n in (0, 1, 2, 60, 200)]
    pos = np.concatenate([np.arange(len(t)) for t in texts])
    got = lm.token_log10(m, w, totals, pos, np.concatenate(texts).astype(np.int64))
    want = np.concatenate([plain_log10(m, w, totals, [int(x) for x in t]) for t in texts])
    assert np.abs(got - want).max() < 1e-9


def test_lm_next_tokens_share_one():
    """Whatever came before, the probabilities of all words that may follow add up to at most 1."""
    m, w, totals = token_model(2)
    w.spelled[:] = -np.inf
    for before in ([], [0], [3, 3, 1], list(range(11)) * 6):
        last = [lm.token_log10(m, w, totals, np.arange(len(before) + 1), np.array([*before, x]))[-1] for x in range(12)]
        assert 0 < (10 ** np.array(last)).sum() <= 1 + 1e-9


def test_lm_scores_do_not_follow_partitions_and_come_from_the_mixer(spark, monkeypatch, rows01):
    docs, _ = rows01
    held = crc_mod(F.col("doc_id"), 7) == 2
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for parts in ("4", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got.append({r.doc_id: (r.score, r.bits_per_byte, r.n_known == r.n_tokens) for r in lm.score(docs, ~held).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == got[1]
    monkeypatch.setattr(lm, "fit_tokens", lambda *_: lm.TokenMixer(np.zeros(lm.TOKEN_SLOTS, np.uint16)))     # even odds
    even = {r.doc_id: r.score for r in lm.score(docs, ~held).collect()}
    known = [i for i, r in got[0].items() if r[2]]
    assert known and sum(even[i] for i in known) < 1.05 * sum(got[0][i][0] for i in known)


def test_lm_learns_from_all_words_and_documents(spark):
    """More documents than a former sample of 2,000, more words than a former one of 300,000."""
    docs = spark.range(2600).select(F.concat_ws(" ", F.lit("aa"), F.when(F.col("id") % 2 == 0, "bb bb").otherwise("cc cc")).alias("text"))
    group = lm.grouping(docs)
    assert group([b"bb"] * 3) != group([b"cc"] * 3)
    words = spark.range(310_000).select(F.lpad(F.conv("id", 10, 36), 4, "0").cast("binary").alias("word"))
    assert lm.learned(words, np.zeros(lm.SLOTS, np.uint16))[1].sum() == 8 * 5 * 310_000


def test_lm_counts_every_decision_of_every_training_text(spark, monkeypatch):
    seen = {}
    plain = lm.train_pass

    def spy(blocks, found, end, each, width, model=None):
        seen[each.__name__] = plain(blocks, found, end, each, width, model)
        return seen[each.__name__]
    monkeypatch.setattr(lm, "train_pass", spy)
    docs = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, "aa bb once").otherwise("cc dd").alias("text"))
    lm.score(docs, F.col("id") % 3 != 2, "id").collect()
    # 600 training texts: 300 of three words, 300 of two, each with an end; five decisions a token
    assert seen["_bits_by_bucket"].sum() == 5 * (300 * 4 + 300 * 3) == seen["_counts"].sum() // lm.INPUTS


def test_decisions_come_in_pieces_and_are_counted_once():
    rng = np.random.default_rng(3)
    sym, hashes = rng.integers(0, 17, 50_000), rng.integers(0, 1 << 32, 50_000).astype(np.uint32)
    ctx = lm.token_contexts(sym, hashes, np.arange(50_000) % 700)
    want, taken = Counter(), Counter()
    for took, node, bit, slots in lm.decisions(sym, ctx):
        assert 0 < len(took) == len(node) == len(bit) <= lm.DECISIONS and len(set(node.tolist())) <= 8
        taken.update(took.tolist())
        for s in slots:
            want.update((2 * s + bit).tolist())
    assert all(taken[t] == (5 if s else 1) for t, s in enumerate(sym))
    got = lm._counts(sym, ctx, None)
    assert {i: int(got[i]) for i in np.flatnonzero(got)} == want


def test_earlier_occurrences_are_counted_for_numbers_of_any_size():
    for top in (1 << 20, 1 << 60):
        at = np.array([5, 7, 5, 5, 7, 9]) + top
        assert lm._before(at).tolist() == [0, 0, 1, 2, 1, 0]
    assert lm._before(np.zeros(0, np.int64)).tolist() == []


def test_lm_pieces_of_training_texts_are_kept_whole():
    rng = np.random.default_rng(5)
    sym, hashes, pos = rng.integers(0, 17, 5000), rng.integers(0, 1 << 32, 5000).astype(np.uint32), np.arange(5000) % 90
    ctx = lm.token_contexts(sym, hashes, pos)
    n, kept = lm.lesson(sym, ctx)
    back = [c.astype(np.int64) for c in lm.unpack_columns(lm.KEPT, kept).values()]
    got = [np.repeat(np.arange(17), unpack(n)), back[0] // 18, *back]
    assert sorted(zip(*got)) == sorted(zip(sym, *ctx))
    m, _, _ = token_model(4)
    for each in (lm._counts, lm._bits_by_bucket):
        assert each(got[0], got[1:], m).tolist() == each(sym, ctx, m).tolist()


def test_lm_reads_training_texts_once_for_all_passes(spark, monkeypatch, rows01):
    """Every pass reads staged pieces of texts, one row for a piece, not a row for every word of a block."""
    plans = []
    plain = lm.train_pass

    def spy(rows, *rest):
        plans.append((rows._jdf.queryExecution().executedPlan().toString(), rows.count()))
        return plain(rows, *rest)
    monkeypatch.setattr(lm, "train_pass", spy)
    docs, _ = rows01
    lm.score(docs, F.lit(True)).count()
    assert len(plans) == 2 + lm.STEPS and all("Exchange" not in p and "Join" not in p and 0 < n < 100 for p, n in plans)


def test_lm_vocabulary_and_groups_from_blocks(spark):
    texts = [(n, " ".join(f"w{(n * k) % 40}" for k in range(n % 9))) for n in range(200)] + [(200, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    blocks = word_blocks(docs, "doc_id", "text", F.col("doc_id") % 3 != 0, buckets=5, block_bytes=300)
    vocab = lm.vocabulary(blocks)
    got = {}
    for r in vocab.filter("block = -1").collect():
        got |= dict(zip(unpack_words(r.data), lm.numbers(r.counts).tolist()))
    want = Counter({w.encode(): 0 for _, t in texts if t for w in t.split()})
    want.update(w.encode() for i, t in texts if t and i % 3 for w in t.split())
    assert got == dict(want)
    group = lm.grouping_of(blocks, vocab)
    assert list(group.index) == [w for w, _ in sorted(want.items(), key=lambda x: (-x[1], x[0])) if want[w]][:lm.VOCABULARY]
    totals = np.zeros((lm.GROUPS, 1), np.int64)
    shared = spark.sparkContext.broadcast(group)
    for r in blocks.groupBy("block").applyInArrow(lm._tallies(shared), "block long, bucket int, counts binary").collect():
        totals[:, 0] += unpack(r.counts).astype(np.int64).reshape(lm.GROUPS, -1).sum(axis=1)
    by_text = Counter()
    for i, t in texts:
        if i % 3 and t:
            by_text[group([w.encode() for w in t.split()])] += len(t.split())
    assert totals[:, 0].tolist() == [by_text[g] for g in range(lm.GROUPS)]


def test_split_words_as_word_by_word():
    texts = [b"", b" \t\x0b a B\xff \xc3\x84X a\x00b\x1c\n", b"  ", b"a  b\x85c", "ÉtÉ  x".encode()]
    for special, some in ((None, texts), (b"<S>", [*texts, b"Q <S>X Zz"])):
        sizes, words = split_words(some, special)
        want = [words_of(t, special) for t in some]
        assert sizes.tolist() == [len(w) for w in want] and words.to_pylist() == [w for ws in want for w in ws]
    assert split_words([], None)[0].tolist() == []
