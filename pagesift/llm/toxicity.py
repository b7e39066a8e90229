"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic examples and text without labels train the model; the class prior is the toxic
share of the labelled training rows. Features are the presence of words and of word beginnings of
4 to 6 letters. Every feature of every positive row is counted over the positive and over all training
rows, and the ``max_features`` with the largest gain are kept. A logistic model is
then fitted in numpy on a bounded sample (``max_pos`` positive rows, ``max_unl`` unlabelled rows,
both by a hash of the id) by the risk

    prior * R_pos(+1) + max(0, R_unl(-1) - prior * R_pos(-1)),

ascending its second term where it turns negative. Every whole text is scored.

Defined results: null and empty texts have no feature and get the score of such a text; without a
positive example every score is 0; null labels are unlabelled, repeated labels count once, a null id
is never labelled; repeated rows are returned as often as they occur; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagesift.operators.match import lookup_filter, may_be_listed

from .common import crc_mod, ship_package, table

FOLD = 5
MAX_POS = 4000
MAX_UNL = 12000
MAX_FEATURES = 600
WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)


def words_of(text: str | None) -> set[str]:
    """The distinct words, runs of letters in lower case, of a whole text."""
    out = set()
    for t in set((text or "").lower().split()):
        if t.isalpha():
            out.add(t)
        else:
            out.update(WORD.findall(t))
    return out


def features(text: str | None) -> set[str]:
    """Words of a whole text, and their beginnings marked with an asterisk."""
    words = words_of(text)
    return words | {w[:k] + "*" for w in words for k in STEMS if len(w) > k}


class Known:
    """Numbers of chosen features; a text's other words are told apart by their first letters."""

    def __init__(self, names: list[str]):
        self.index = {f: i for i, f in enumerate(names)}
        self.heads = {f[:STEMS[0]] for f in names}

    def hits(self, text: str | None) -> list[int]:
        """Numbers of the features that the text has, ascending."""
        out, get = set(), self.index.get
        for w in words_of(text):
            if w[:STEMS[0]] in self.heads:
                out.update(i for i in (get(w), *(get(w[:k] + "*") for k in STEMS if len(w) > k)) if i is not None)
        return sorted(out)


def nn_pu(pos: np.ndarray, unl: np.ndarray, prior: float, pos_share=None, unl_share=None, l2: float = 2e-4,
          steps: int = 600, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Weights and bias of the non-negative PU risk under logistic loss, by Adam. ``pos_share`` and
    ``unl_share`` say how large a share of its sample each row stands for."""
    d = pos.shape[1]
    ep = np.full(len(pos), 1 / max(len(pos), 1), np.float32) if pos_share is None else pos_share
    eu = np.full(len(unl), 1 / max(len(unl), 1), np.float32) if unl_share is None else unl_share
    w = np.zeros(d + 1, np.float32)
    w[d] = np.log(prior / (1 - prior))
    m, v = np.zeros(d + 1, np.float32), np.zeros(d + 1, np.float32)

    def sig(z):
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for t in range(1, steps + 1):
        zp, zu = pos @ w[:d] + w[d], unl @ w[:d] + w[d]
        sp, su = sig(zp), sig(zu)
        neg = eu @ np.logaddexp(0, zu) - prior * (ep @ np.logaddexp(0, zp))
        gp, gu = -(1 - sp) * ep * prior, su * eu                # d R_pos(+1), d R_unl(-1)
        gn = sp * ep * prior                                    # d prior * R_pos(-1)
        if neg < 0:                                             # only the corrected term, reversed
            rp, ru = gn, -gu
        else:
            rp, ru = gp - gn, gu
        g = np.append(pos.T @ rp + unl.T @ ru, rp.sum() + ru.sum()).astype(np.float32)
        g[:d] += l2 * w[:d]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= (rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return w[:d].astype(float), float(w[d])


def _patterns(rows: list[bytes], d: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct feature sets of a sample, and each one's share of it."""
    seen = sorted(Counter(bytes(r) for r in rows).items())
    x = np.zeros((len(seen), d), np.float32)
    for i, (r, _) in enumerate(seen):
        x[i, np.frombuffer(r, np.int32)] = 1
    return x, np.array([n for _, n in seen], np.float32) / max(len(rows), 1)


def _documents_with(texts: DataFrame) -> DataFrame:
    """(f, n): how many rows of ``texts`` hold each feature."""
    def each(batches):
        for b in batches:
            got = Counter()
            for t in b.column(0).to_pylist():
                got.update(features(t))
            yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), pa.array(list(got.values()), pa.int64())],
                                             names=["f", "n"])

    return texts.mapInArrow(each, "f string, n long").groupBy("f").agg(F.sum("n").alias("n"))


def best_features(positive: DataFrame, train: DataFrame, n_pos: int, most: int) -> list[str]:
    """The ``most`` features of ``positive(text)`` that tell most of the positive class, 0 unless clearly more
    frequent there than in all of ``train(text)``."""
    p = F.least(F.col("n_p") / max(n_pos, 1), F.lit(1.0))
    q = (F.col("n") + 1) / (train.count() + 1)
    counts = _documents_with(positive).withColumnRenamed("n", "n_p").join(_documents_with(train), "f")
    gain = F.when(p > 1.5 * q, p * F.log(p / q)).otherwise(0.0)
    return [r.f for r in counts.select("f", gain.alias("gain")).filter("gain > 0").orderBy(F.desc("gain"), "f").limit(most).collect()]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fold: int = FOLD,
        max_pos: int = MAX_POS, max_unl: int = MAX_UNL, max_features: int = MAX_FEATURES):
    """(features, weights, bias), or None without a positive example."""
    spark = docs.sparkSession
    ship_package(spark)
    known = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_y")).filter(
        "_id IS NOT NULL AND _y IS NOT NULL").filter(crc_mod(F.col("_id"), fold) != 0) \
        .groupBy("_id").agg(F.max("_y").alias("_y"))
    n, n_pos = known.agg(F.count("*"), F.sum(F.when(F.col("_y") == 1, 1).otherwise(0))).first()
    if not n_pos:
        return None
    prior = min(0.95, max(0.002, n_pos / n))
    train = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")) \
        .filter(crc_mod(F.col("_id"), fold) != 0)
    mark = F.xxhash64("_id", F.lit("toxicity sample"))
    ids = known.filter("_y = 1").orderBy(mark, "_id").limit(max_pos).select("_id")     # a bounded broadcast
    positive = train.join(F.broadcast(ids), "_id", "left_semi").select("_t")

    toxic_ids = known.filter("_y = 1").select("_id")    # any number: a filter of fixed size lets few other texts into the join
    toxic = train.filter(may_be_listed(F.col("_id"), lookup_filter(toxic_ids, key="_id"))) \
        .join(toxic_ids, "_id", "left_semi").select("_t")
    names = best_features(toxic, train.select("_t"), n_pos, max_features)
    if not names:
        return [], np.zeros(0), float(np.log(prior / (1 - prior)))
    rate = min(1.0, max_unl / max(train.count(), 1))
    unl = train.filter(F.pmod(mark, F.lit(1_000_000)) < rate * 1e6).select("_t")
    chosen = spark.sparkContext.broadcast(Known(names))

    def vectors(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.array(chosen.value.hits(t), np.int32).tobytes() for t in b.column(0).to_pylist()],
                          pa.binary())], names=["x"])

    xp, ep = _patterns([r.x for r in positive.mapInArrow(vectors, "x binary").collect()], len(names))
    xu, eu = _patterns([r.x for r in unl.mapInArrow(vectors, "x binary").collect()], len(names))
    if not len(xp) or not len(xu):
        return names, np.zeros(len(names)), float(np.log(prior / (1 - prior)))
    w, b = nn_pu(xp, xu, prior, ep, eu)
    return names, w, b


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) for every row."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        known = Known(m[0] if m else [])
        for b in batches:
            if m:
                z = np.array([m[2] + m[1][known.hits(t)].sum() for t in b.column(1).to_pylist()], float)
                p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            else:
                p = np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p)], names=["id", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, score double")
    return out.withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """(id, held_out, score, predicted): fitted on the training fold, scored for every row."""
    out = score(docs, fit(docs, labels, id_col, text_col, **kw), id_col, text_col)
    return out.select(id_col, (crc_mod(F.col(id_col), kw.get("fold", FOLD)) == 0).alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op2_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op2_toxicity": op2_toxicity}
ORACLES: dict[str, str] = {}
