import re
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pagesift.llm import spelling

WORD = re.compile("[A-Za-zÀ-ÿ]+")


def counts(rows, noise=31):
    total = Counter()
    for doc_id, text in rows:
        for run in WORD.findall(text or ""):
            run = "".join(c.lower() if c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    """One code point inserted, deleted or replaced, by trying all places."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def neighbours(words):
    """Near words through the forms of each word without one code point, then checked."""
    by = defaultdict(set)
    for w in words:
        by[w].add(w)
        for i in range(len(w)):
            by[w[:i] + w[i + 1:]].add(w)
    out = defaultdict(set)
    for some in by.values():
        for a in some:
            out[a].update(b for b in some if b not in out[a] and near(a, b))
    return out


def expected(words):
    by, form = neighbours(words), {}
    for w, n in words.items():
        best = min(by[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 10 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(by[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def test_against_brute_force(spark, odd, none, rows01):
    from brute import ROWS
    for df, rows in ((odd, ROWS), (none, []), rows01):
        assert got(spelling.variants(df)) == expected(counts([(r[0], r[1]) for r in rows]))


def test_chains_of_forms_lead_to_the_root(spark):
    """Counts of 2, 20, 200, 2000 and 20000 along a chain of edits, and a tie."""
    words = {"abcdefg": 20000, "abcdefgh": 2000, "abcdefghi": 200, "abcdefghij": 20, "abcdefghijk": 2,
             "zzzzzzzz": 2, "zzzzzzza": 40, "zzzzzzzb": 40, "lonelyword": 5}
    formed = spelling.forms(df := spark.createDataFrame(list(words.items()), "word string, n long"), spelling.near_words(df))
    out = got(spelling.roots(formed))
    assert out == expected(words)
    assert {r[0]: r[2] for r in out}["abcdefghijk"] == "abcdefg" and {r[0]: r[1] for r in out}["zzzzzzzz"] == "zzzzzzza"


def test_groups_that_span_blocks_and_batches(spark):
    """Thousands of words that share all but their last or first letters, and code points beyond Latin-1."""
    letters = "abcdefghijklmnopqrstuvwxyzé"
    words = [f"prefix{a}{b}{c}" for a in letters for b in letters for c in letters[:4]] + [f"{a}{b}suffix" for a in letters for b in letters]
    words += ["слово" * 3, "слово" * 3 + "к", "слова" + "слово" * 2, "语" * 9, "语" * 8]
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long").coalesce(1)
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "100")
    try:
        pairs = [(r.word, r.near) for r in spelling.near_words(df).collect()]
    finally:
        spark.conf.set(conf, before)
    want = {(a, b) for a, some in neighbours(words).items() if a in set(words) for b in some}
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_very_long_words(spark):
    """Runs of many thousand letters go to no more groups than others."""
    long = "abcdefghij" * 3000
    words = [long, long + "x", long[:15_000] + long[15_001:], "q" + long, long[:-1] + "z", "x" + long[1:-1] + "z"]
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    pairs = {(r.word, r.near) for r in spelling.near_words(df).collect()}
    assert pairs == {(a, b) for a in words for b in words if a != b and near(a, b)}
    assert spelling._groups(df).groupBy("word").count().agg({"count": "max"}).first()[0] <= 10


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", min_size=3, max_size=9), unique=True, max_size=80))
def test_every_near_pair_shares_exactly_one_group(words):
    """The dealing rule in plain Python: common groups of the right place are found once."""
    def dealt(w):
        for m in (len(w) - 1, len(w)):
            g = spelling.step(m)
            for t in range(0, m + 1, g):
                s = max(0, m - t - g + 1)
                yield m + 1, t, w[:t], w[len(w) - s:]
    for i, a in enumerate(words):
        for b in words[:i]:
            c = max(len(a), len(b))
            p = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            g = spelling.step(c - 1)
            right = [x for x in set(dealt(a)) & set(dealt(b)) if x[0] == c and x[1] == p // g * g]
            assert not near(a, b) or len(right) == 1


def test_noise_counts_bytes_and_deletes_code_points():
    for doc_id in range(200):
        for run in ("word", "élève", "àààà", "ÿ"):
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            want = run if h % 3 else run[:h % len(run)] + run[h % len(run) + 1:]
            assert spelling.noisy(zlib.crc32(f"{doc_id}:".encode()), run.encode("latin-1"), 3).decode("latin-1") == want
