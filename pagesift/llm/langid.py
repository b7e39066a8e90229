"""Hierarchical language identification.

Texts become relative frequencies of hashed byte 1- to 3-grams. One-versus-rest linear SVMs pick
the language family; inside it a one-versus-one SVM for each pair of languages votes. Training
rows are a bounded sample (``per_lang`` rows of a language, ``max_rows`` in all, by a hash of the
id) of the documents that have a language and aren't held out; scoring covers every whole text,
in pieces of bounded size.

Defined results: text that is null or has no letter is ``und`` with score 0; so is every text when
there is nothing to learn from; with one language only, that language; a null id is scored as
any other row; repeated rows are returned as often as they occur; other columns are ignored.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, release, ship_package, table

# Languages of one family; a language not listed is a family of its own.
FAMILIES = {"germanic": ["en", "de", "nl", "sv", "da", "no", "is"],
            "romance": ["fr", "es", "it", "pt", "ro", "ca"],
            "slavic": ["ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"]}
FOLD = 5
DIM_BITS = 12
PER_LANG = 600
MAX_ROWS = 6000
PIECE = 1 << 20
GROUP = 256          # texts whose profiles are held at once


def profile(text: str) -> np.ndarray:
    """Relative frequencies of hashed byte n-grams of the whole text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    out = np.zeros(1 << DIM_BITS, np.int64)
    mul, shift = np.uint32(2654435761), np.uint32(32 - DIM_BITS)
    for lo in range(0, len(raw), PIECE):
        b = raw[lo:lo + PIECE + 2].astype(np.uint32)
        own = min(PIECE, len(raw) - lo)
        grams = [b[:own] + np.uint32(1 << 24)]
        if len(b) > 1:
            two = b[:-1] | (b[1:] << np.uint32(8))
            grams.append(two[:own] + np.uint32(1 << 25))
            if len(b) > 2:
                grams.append((two[:-1] | (b[2:] << np.uint32(16)))[:own])
        h = (np.concatenate(grams) * mul) >> shift
        out += np.bincount(h, minlength=1 << DIM_BITS)
    return (out / max(1, out.sum())).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def svm(x: np.ndarray, y: np.ndarray, l2: float = 1e-4, steps: int = 150) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by accelerated gradient descent; y is -1 or 1, and both
    classes weigh the same."""
    n, d = x.shape
    cls = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    v = np.ones(d, np.float32)
    for _ in range(12):                      # largest curvature, for the step length
        v = x.T @ (cls * (x @ v))
        top = float(np.linalg.norm(v))
        v /= max(top, 1e-12)
    rate = 1.0 / (2 * (top + 1) + l2)
    w, b = np.zeros(d, np.float32), 0.0
    pw, pb = w, b
    for t in range(1, steps + 1):
        m = (t - 1) / (t + 2)
        zw, zb = w + m * (w - pw), b + m * (b - pb)
        g = -2 * cls * y * np.maximum(0, 1 - y * (x @ zw + zb))
        pw, pb = w, b
        w, b = zw - rate * (x.T @ g + l2 * zw), zb - rate * float(g.sum())
    return w, b


def family_of(families: dict) -> dict:
    return {lang: f for f, langs in families.items() for lang in langs}


class Model:
    """Weights of the family classifiers and of the pairs inside each family."""

    def __init__(self, x: np.ndarray, langs: np.ndarray, families: dict):
        known = family_of(families)
        self.langs = sorted(set(langs))
        fam = np.array([known.get(a, a) for a in langs])
        self.families = sorted(set(fam))
        self.members = {f: [a for a in self.langs if known.get(a, a) == f] for f in self.families}
        self.pairs = [p for f in self.families for p in itertools.combinations(self.members[f], 2)]
        scale = (1 / np.sqrt(x.mean(axis=0) + 1e-6)).astype(np.float32)
        z = x * scale
        cols = [svm(z, np.where(fam == f, 1, -1).astype(np.float32)) for f in self.families] \
            if len(self.families) > 1 else [(np.zeros(x.shape[1], np.float32), 0.0)]
        for a, b in self.pairs:
            rows = (langs == a) | (langs == b)
            cols.append(svm(z[rows], np.where(langs[rows] == a, 1, -1).astype(np.float32)))
        self.w = np.stack([w * scale for w, _ in cols], axis=1)
        self.b = np.array([b for _, b in cols], np.float32)

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        s = x @ self.w + self.b
        nf = len(self.families)
        e = np.exp(3 * (s[:, :nf] - s[:, :nf].max(axis=1, keepdims=True)))
        p = e / e.sum(axis=1, keepdims=True)
        lang_p = np.zeros((len(x), len(self.langs)))
        at = {a: i for i, a in enumerate(self.langs)}
        for i, f in enumerate(self.families):
            m = self.members[f]
            if len(m) == 1:
                lang_p[:, at[m[0]]] = p[:, i]
                continue
            votes = np.zeros((len(x), len(self.langs)))
            for j, (a, b) in enumerate(self.pairs):
                if a in m:
                    q = 1 / (1 + np.exp(-np.clip(3 * s[:, nf + j], -30, 30)))
                    votes[:, at[a]] += q
                    votes[:, at[b]] += 1 - q
            cols = [at[a] for a in m]
            lang_p[:, cols] = p[:, i:i + 1] * votes[:, cols] / (len(m) * (len(m) - 1) / 2)
        fam_best = p.argmax(axis=1)
        best = np.empty(len(x), int)
        for i, f in enumerate(self.families):
            rows = fam_best == i
            cols = np.array([at[a] for a in self.members[f]])
            best[rows] = cols[lang_p[rows][:, cols].argmax(axis=1)]
        return [self.langs[i] for i in best], np.clip(lang_p[np.arange(len(x)), best], 0, 1)


def _profiles(batches):
    for b in batches:
        vecs = [profile(t).tobytes() for t in b.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(vecs, pa.binary()), b.column(1)], names=["x", "lang"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        families: dict | None = None, per_lang: int = PER_LANG, max_rows: int = MAX_ROWS,
        fold: int = FOLD) -> Model | None:
    """Model of a bounded sample of the rows whose crc32(id) mod ``fold`` isn't 0."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), F.col(lang_col).alias("_l")) \
        .filter("_l IS NOT NULL AND _t IS NOT NULL").filter(crc_mod(F.col("_id"), fold) != 0)
    counts = {r[0]: r[1] for r in rows.groupBy("_l").count().collect()}   # one row per language
    if not counts:
        return None
    cap = max(1, min(per_lang, max_rows // len(counts)))
    rate = F.create_map(*[F.lit(v) for a, n in counts.items() for v in (a, min(1.0, 1.3 * cap / n + 10 / n))])
    u = F.pmod(F.xxhash64("_id", F.lit("language sample")), F.lit(1_000_000)) / 1e6
    some = rows.filter(u < rate[F.col("_l")])
    order = Window.partitionBy("_l").orderBy(F.xxhash64("_id"), "_id")
    ids = some.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= cap).select("_t", "_l")
    got = ids.mapInArrow(_profiles, "x binary, lang string").toPandas()
    if not len(got):
        return None
    x = np.stack([np.frombuffer(v, np.float32) for v in got["x"]])
    order = np.lexsort((x.argmax(axis=1), x[:, 0], got["lang"].to_numpy().astype(str)))
    return Model(x[order], got["lang"].to_numpy().astype(str)[order], families or FAMILIES)


def languages(model: Model | None, texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text."""
    lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
    rows = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
    if rows:
        lang[rows], score[rows] = model.predict(np.stack([profile(texts[i]) for i in rows]))
    return lang, score


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, GROUP):
                part = b.slice(lo, GROUP)
                lang, score = languages(m, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(list(lang), pa.string()), pa.array(score)],
                                                 names=["id", "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """(id, held_out, lang_pred, score): fitted on the training fold, predicted for every row."""
    out = predict(docs, fit(docs, id_col, text_col, **kw), id_col, text_col)
    return out.select(id_col, (crc_mod(F.col(id_col), kw.get("fold", FOLD)) == 0).alias("held_out"),
                      "lang_pred", "score")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **kw) -> DataFrame:
    """The rows of ``docs`` whose text has a letter, with all their columns; the language of each becomes the predicted one.
    A given language that no training row has can't be predicted and stays; all stay if there is nothing to learn from.
    Each row is judged where it lies; nothing is joined or shuffled."""
    model = fit(docs, id_col, text_col, lang_col, **kw)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)

    def run(batches):
        m = shared.value
        for b in batches:
            b = b.filter(pa.array([has_letter(t) for t in b.column(at).to_pylist()], pa.bool_()))
            if m is not None:
                lang = b.column(lang_at).to_pylist()
                for lo in range(0, b.num_rows, GROUP):
                    found = languages(m, b.column(at).slice(lo, GROUP).to_pylist())[0]
                    lang[lo:lo + GROUP] = [v if was is None or was in m.langs else was
                                           for was, v in zip(lang[lo:lo + GROUP], found)]
                b = b.set_column(lang_at, b.schema.field(lang_at), pa.array(lang, b.schema.field(lang_at).type))
            yield b
        release()

    return docs.mapInArrow(run, docs.schema)


def op7_langid(spark, sf_dir):
    return identify(table(spark, sf_dir, "documents"))


QUERIES = {"op7_langid": op7_langid}
ORACLES: dict[str, str] = {}
