"""Grouping of spelling variants: words one edit apart, found by dense tiles of code-point matrices.

Two words differ by one inserted, deleted or replaced code point exactly if their common prefix and common suffix
together reach the longer length minus one. Words are dealt by what such a pair must share: for a longer length ``c``
with ``m = c - 1`` and a step ``g``, a pair with a common prefix of ``p`` code points agrees in the first ``t``, the
multiple of ``g`` at or below ``p``, and in the last ``m - t - g + 1``. Every word therefore goes to at most ten groups
(two values of ``c``, at most five of ``t``), and in a group all but ``g`` places of a word are fixed, which bounds its
size by the alphabet, not by the corpus. A task lays the words of its sorted groups out as padded code-point matrices, cuts
them into blocks of rows and compares block pairs that hold the same group, from the front and from the back. A pair
counts only in the group of its own ``t``, so it is found once.

A word's form is its near word of largest count, if that is at least ten times its own; roots follow forms by pointer
doubling, in as many rounds as a chain of tenfold counts can have hops.

Defined results: null and empty texts have no words; a null id counts as the empty text in the noise rule; repeated rows count
each time; a word without near words has ``n_near`` 0 and is its own root; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, ship_package, staged, table
from .merkle import CRC_TABLE, LOWER, UPPER, crc_sql

MIN_CHARS = 7
MIN_COUNT = 2
TIMES = 10              # a form occurs so many times as often
NOISE = 31
STEP = 3                # least ``g``
QUARTERS = 4            # ``g`` grows to a quarter of long words
ROWS = 32               # rows of a block
CELLS = 4 << 20         # matrix cells compared at once
FLUSH = 200_000         # distinct words a task counts before it hands them on

LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


# --- words and counts ---

def runs(text: str) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF with A-Z in lower case, in Latin-1."""
    return text.encode("latin-1", "replace").translate(LETTERS).split()


def noisy(start: int, run: bytes, noise: int) -> bytes:
    """The run, without one code point if ``noise`` divides the CRC-32 of id, colon and run; ``start`` is that of id and colon."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(min_chars: int, noise: int):
    def emit(total):
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total]), pa.array(list(total.values()), pa.int64())],
                                          names=["word", "n"])

    def run(batches):
        total: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                start = zlib.crc32(f"{doc_id}:".encode())
                for r, n in Counter(runs(text)).items():
                    if len(r) >= min_chars:
                        total[noisy(start, r, noise)] += n
            if len(total) >= FLUSH:
                yield emit(total)
                total.clear()
        if total:
            yield emit(total)
        release()
    return run


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT, noise: int = NOISE) -> DataFrame:
    """(word, n): the distinct words of all texts that are long and frequent enough."""
    ship_package(docs.sparkSession)
    src = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col)).filter(F.col(text_col).isNotNull())
    return src.mapInArrow(_count(min_chars, noise), "word string, n long").filter(F.char_length("word") >= min_chars) \
        .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# --- near words ---

def step(m: int) -> int:
    return max(STEP, -(-m // QUARTERS))


def _groups(words: DataFrame) -> DataFrame:
    """Each word once for every group it is dealt to: c, t, key, word, n."""
    g = f"greatest({STEP}, cast(ceil(m / {QUARTERS}) AS int))"
    places = f"transform(sequence(0, m div {g}), k -> named_struct('c', m + 1, 't', k * {g}, 's', greatest(0, m - k * {g} - {g} + 1)))"
    sized = words.withColumn("_l", F.char_length("word"))
    dealt = sized.select("word", "n", F.expr(f"explode(flatten(transform(array(_l - 1, _l), m -> {places})))").alias("p"))
    key = F.xxhash64(F.expr("substring(word, 1, p.t)"), F.expr("right(word, p.s)"))
    return dealt.select(F.col("p.c").alias("c"), F.col("p.t").alias("t"), key.alias("key"), "word", "n")


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of code points, padded with 0 behind: from the front, and from the back."""
    try:
        raw, kind = [w.encode("latin-1") for w in words], np.uint8
    except UnicodeEncodeError:
        raw, kind = [w.encode("utf-32-le") for w in words], np.dtype("<u4")
    size = width * np.dtype(kind).itemsize
    front = np.frombuffer(b"".join(w.ljust(size, b"\0") for w in raw), kind).reshape(len(words), width)
    back = np.frombuffer(b"".join(w.rjust(size, b"\0") for w in raw), kind).reshape(len(words), width)[:, ::-1]
    return front, back


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of each block of ``a`` with each of ``b``."""
    return (a[:, :, None, :] != b[:, None, :, :]).argmax(axis=3)


def near_pairs(words: list[str], c: int, t: np.ndarray, group: np.ndarray):
    """Positions (i, j) of near words of longer length ``c`` in the same group; ``group`` ascends."""
    n = len(words)
    if n < 2:
        return
    size = -(-n // ROWS) * ROWS
    lone = size - n

    def rows(a, fill):
        full = np.concatenate([a, np.full((lone, *a.shape[1:]), fill, a.dtype)]) if lone else a
        return full.reshape(size // ROWS, ROWS, *a.shape[1:])

    front, back = (rows(m, 0) for m in matrices(words, c))
    group, t = rows(group, -1), rows(t, 0)
    full = rows(np.fromiter(map(len, words), np.int32, n) == c, False)
    last = np.array([g[g >= 0].max(initial=-1) for g in group])
    upper = np.triu(np.ones((ROWS, ROWS), bool), 1)
    slab = max(1, CELLS // (ROWS * ROWS * c))
    g = step(c - 1)
    for apart in range(len(group)):
        first = np.flatnonzero(last[:len(group) - apart] == group[apart:, 0]) if apart else np.arange(len(group))
        if not len(first):
            return
        for lo in range(0, len(first), slab):
            a = first[lo:lo + slab]
            b = a + apart
            ok = (group[a][:, :, None] == group[b][:, None, :]) & (full[a][:, :, None] | full[b][:, None, :])
            ok &= (group[a] >= 0)[:, :, None]
            if not apart:
                ok &= upper
            if not ok.any():
                continue
            p = _same(front[a], front[b])
            ok &= (p + _same(back[a], back[b]) >= c - 1) & (p // g * g == t[a][:, :, None])
            k, x, y = np.nonzero(ok)
            yield from zip((a[k] * ROWS + x).tolist(), (b[k] * ROWS + y).tolist())


def _links(batches):
    """Rows sorted by (c, t, key) -> (word, near, near_n), in both directions."""
    def found(rows: pa.Table):
        c_all = rows.column("c").to_numpy()
        keys = np.stack([rows.column(k).to_numpy().astype(np.int64) for k in ("c", "t", "key")])
        group = np.concatenate([[0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))])
        words, n, t = rows.column("word").to_pylist(), rows.column("n").to_pylist(), rows.column("t").to_numpy()
        out = ([], [], [])
        for lo, hi in _stretches(c_all):
            for i, j in near_pairs(words[lo:hi], int(c_all[lo]), t[lo:hi], group[lo:hi]):
                for x, y in ((lo + i, lo + j), (lo + j, lo + i)):
                    for col, v in zip(out, (words[x], words[y], n[y])):
                        col.append(v)
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())],
                                          names=["word", "near", "near_n"])

    held = None         # the group that may go on in the next batch
    for b in batches:
        rows = pa.Table.from_batches([b])
        if held is not None:
            rows = pa.concat_tables([held, rows]).combine_chunks()
        k = len(rows)
        mark = [rows.column(name).to_numpy() for name in ("c", "t", "key")]
        open_ = np.logical_and.reduce([m == m[k - 1] for m in mark]) if k else np.zeros(0, bool)
        cut = int(np.flatnonzero(~open_)[-1]) + 1 if k and not open_.all() else 0
        if cut:
            yield found(rows.slice(0, cut))
        held = rows.slice(cut)
    if held is not None and len(held):
        yield found(held)
    release()


def _stretches(values: np.ndarray):
    cuts = np.flatnonzero(np.diff(values)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n) -> (word, near, near_n): every ordered pair of words one edit apart, once."""
    ship_package(words.sparkSession)
    dealt = _groups(words).repartition("c", "t", "key").sortWithinPartitions("c", "t", "key")
    return dealt.mapInArrow(_links, "word string, near string, near_n long")


# --- forms and roots ---

def forms(words: DataFrame, links: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word."""
    best = links.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("o"), "near")).alias("b"))
    got = words.join(best, "word", "left")
    taken = -F.col("b.o") >= times * F.col("n")
    return got.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      F.when(taken, F.col("b.near")).alias("form"), F.when(taken, -F.col("b.o")).alias("form_n"))


def roots(formed: DataFrame, times: int = TIMES) -> DataFrame:
    """``forms`` with ``root``: what the forms lead to, the word itself if it has none."""
    most = formed.agg(F.max("n"), F.min("n")).first()
    hops = int(math.log(most[0] / most[1], times) + 1e-9) if most[0] else 0
    up = staged(formed.filter("form IS NOT NULL").select(F.col("word").alias("w"), F.col("form").alias("root")), "spell-up")
    for _ in range(math.ceil(math.log2(hops)) if hops > 1 else 0):
        on = up.select(F.col("w").alias("_w"), F.col("root").alias("_r"))
        up = staged(up.join(on, up["root"] == on["_w"], "left").select("w", F.coalesce("_r", "root").alias("root")), "spell-up")
    return formed.join(up, formed["word"] == up["w"], "left").withColumn("root", F.coalesce("root", "word")).drop("w")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = TIMES, **kw) -> DataFrame:
    """Every word with its count, its near words' number, its form and its root."""
    words = staged(word_counts(docs, id_col, text_col, **kw), "spell-words")
    return roots(staged(forms(words, near_words(words), times), "spell-forms"), times)


def op12_spelling(spark, sf_dir):
    return variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {"op12_spelling": op12_spelling}
_BYTES = "list_transform(range(0, strlen(x) * 2, 2), lambda i: ('0x' || hex(encode(x))[i + 1:i + 2])::BIGINT)"
ORACLES = {"op12_spelling": f"""
WITH RECURSIVE {CRC_TABLE},
found AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
    '{UPPER}', '{LOWER}') AS run FROM documents) GROUP BY 1, 2),
marked AS (SELECT run, n, {crc_sql(_BYTES)} AS h FROM (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || run AS x FROM found), tab),
cut AS (SELECT n, CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM marked),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= 7 GROUP BY 1 HAVING sum(n) >= 2),
dels AS MATERIALIZED (SELECT word, n, i, word[:i - 1] || word[i + 1:] AS d FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM dels a JOIN dels b ON a.d = b.d AND a.i = b.i AND a.word <> b.word
  UNION SELECT w.word, a.word, a.n FROM dels a JOIN words w ON a.d = w.word
  UNION SELECT a.word, w.word, w.n FROM dels a JOIN words w ON a.d = w.word),
best AS (SELECT word, count(*) AS n_near, max(near_n) AS top_n, list(near ORDER BY near_n DESC, near)[1] AS top FROM near GROUP BY 1),
formed AS MATERIALIZED (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN top_n >= 10 * w.n THEN top END AS form,
    CASE WHEN top_n >= 10 * w.n THEN top_n END AS form_n FROM words w LEFT JOIN best USING (word)),
climb AS (SELECT word, word AS at FROM formed UNION ALL SELECT c.word, f.form FROM climb c JOIN formed f ON c.at = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.at AS root FROM climb c JOIN formed f ON c.at = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""}
