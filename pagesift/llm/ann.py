"""Approximate nearest neighbours by multi-index hashing, for the largest inner product.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, which turns the inner
product into an angle. Their codes are the signs after learned rotations (PCA, then iterative
quantisation), fitted on a bounded sample. A code is split into 8-bit substrings, each with an index
from value to rows; a query probes, in every substring, all values within floor(radius / m) bits:
by the pigeonhole principle this retrieves every code within the radius. Retrieved codes are
verified, and the floats of those within the radius reranked, exactly, in double precision. The
radius is learned: that within which the sample's true neighbours lie (``hit``). Where a block has
fewer than ``k`` rows within it, the radius grows until it has.

Queries are a stated set against all rows, in blocks: blocks of ``block_rows`` rows are indexed in the
task that gets them with a chunk of ``chunk_queries`` queries, and hand on ``k`` rows a query.

Defined results: vectors that are null, empty, zero, of another length than most, or hold null or
non-finite components, and null ids, take no part; of rows with the same id the smallest vector
counts; equal scores go by the smaller id; fewer than ``k`` candidates give fewer rows; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship_package, staged, table

K = 20
BITS = 128
SAMPLE = 4096
BLOCK_ROWS = 8192
CHUNK_QUERIES = 2048
HIT = 0.98
# Fixed tables of an 8-bit substring: values by distance from 0.
_COUNT = np.bitwise_count(np.arange(256, dtype=np.uint8))
BALLS = [np.flatnonzero(_COUNT <= r).astype(np.uint8) for r in range(9)]


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): one row per id, only vectors that take part."""
    v = F.col(vec_col).cast("array<float>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(
        "id IS NOT NULL AND v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) "
        "AND abs(x) < float('inf')) AND exists(v, x -> x <> 0)")
    rows = staged(rows.groupBy("id").agg(F.min("v").alias("v")), "vectors")
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.filter(F.size("v") == (common[0].d if common else 0))


def augmented(x: np.ndarray, norm: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _rotation(x: np.ndarray, columns: int, rng) -> np.ndarray:
    """Projection to ``columns`` directions: the strongest principal ones, rotated so that their
    signs lose least."""
    _, _, vt = np.linalg.svd(x, full_matrices=False)
    p = vt[:columns].T
    z = x @ p
    r = np.linalg.qr(rng.standard_normal((p.shape[1], p.shape[1])))[0]
    for _ in range(25):
        u, _, w = np.linalg.svd(np.where(z @ r > 0, 1.0, -1.0).T @ z)
        r = (u @ w).T
    return p @ r


class Coder:
    """Learned codes: rotations of the augmented vectors, and the radius."""

    def __init__(self, sample: np.ndarray, norm: float, k: int, bits: int, hit: float):
        self.norm, self.bits = norm, bits
        x = augmented(sample, norm)
        self.mean = x.mean(axis=0)
        rng = np.random.default_rng(11)
        parts, have = [], 0
        while have < bits:
            parts.append(_rotation(x - self.mean, min(64, x.shape[1], len(x), bits - have), rng))
            have += parts[-1].shape[1]
        self.rot = np.concatenate(parts, axis=1)
        q = np.arange(0, len(x), max(1, len(x) // 256))
        s = sample[q] @ sample.T
        s[np.arange(len(q)), q] = -np.inf
        near = np.argsort(-s, axis=1)[:, :min(k, max(1, len(x) - 1))]
        codes, asked = self.code(sample), self.code(sample[q], query=True)
        dist = np.bitwise_count(codes[near] ^ asked[:, None, :]).sum(axis=2, dtype=np.int64)
        self.radius = int(np.quantile(dist, hit, method="higher"))

    def code(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Rows of ``bits / 8`` substrings. A query's added component is 0; it is taken at the
        length M, as only its direction counts."""
        x = x.astype(np.float64)
        if query:
            x = x * (self.norm / np.linalg.norm(x, axis=1, keepdims=True))
        return np.packbits((augmented(x, self.norm) - self.mean) @ self.rot > 0, axis=1)


class Index:
    """Substring indexes over the codes of one block of rows."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.order = [np.argsort(c, kind="stable").astype(np.int32) for c in codes.T]
        self.starts = [np.searchsorted(c[o], np.arange(257)) for c, o in zip(codes.T, self.order)]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code is within ``radius`` bits: probe, then verify."""
        ball = BALLS[min(8, radius // len(code))]
        mark = np.zeros(len(self.codes), bool)
        for c, order, starts in zip(code, self.order, self.starts):
            values = (ball ^ c).astype(np.intp)
            lo, n = starts[values], starts[values + 1] - starts[values]
            at = np.arange(n.sum()) + np.repeat(lo - np.cumsum(n) + n, n)
            mark[order[at]] = True
        rows = np.flatnonzero(mark)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(axis=1, dtype=np.int64) <= radius]


def _search(coder, k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = ([], [], [])
        if rows.num_rows and queries.num_rows:
            c = coder.value
            ids, x = _matrix(rows)
            qids, q = _matrix(queries)
            order = np.argsort(ids)
            ids, x = ids[order], x[order]
            index, codes, x64 = Index(c.code(x)), c.code(q, query=True), x.astype(np.float64)
            for qid, qx, code in zip(qids, q, codes):
                radius = c.radius
                need = min(k, len(ids) - int((ids == qid).any()))
                while True:
                    near = index.within(code, radius)
                    near = near[ids[near] != qid]
                    if len(near) >= need or radius >= c.bits:
                        break
                    radius = min(c.bits, radius + 4)
                rough = x[near] @ qx
                if len(near) > k:       # what single precision can't rule out is scored exactly
                    slack = 1e-4 * max(1e-30, float(np.linalg.norm(qx)) * c.norm)
                    near = near[rough >= np.partition(rough, -k)[-k] - slack]
                exact = (x64[near] * qx.astype(np.float64)).sum(axis=1)
                best = np.lexsort((ids[near], -exact))[:k]
                out[0].extend([qid] * len(best))
                out[1].extend(ids[near[best]])
                out[2].extend(exact[best])
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()),
                         "score": pa.array(out[2], pa.float64())})
    return run


def _matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    v = t.column("v").combine_chunks()
    return t.column("id").to_numpy(), v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)


def nearest(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding",
            bits: int = BITS, sample: int = SAMPLE, hit: float = HIT, block_rows: int = BLOCK_ROWS,
            chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): ``is_query`` is a condition on the column ``id``."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = usable(vectors, id_col, vec_col)
    queries = rows.filter(is_query)
    n, norm = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))).first()
    n_q = queries.count()
    mark = F.xxhash64("id", F.lit("index sample"))
    some = rows.filter(F.pmod(mark, F.lit(1_000_000)) < 1.2e6 * sample / max(n, 1) + 1).orderBy(mark, "id").limit(sample).collect()
    coder = Coder(np.array([r.v for r in some], np.float64), math.sqrt(norm), k, bits, hit) if some else None
    shared = spark.sparkContext.broadcast(coder)
    blocks, chunks = max(1, math.ceil(n / block_rows)), max(1, math.ceil(n_q / chunk_queries))
    cell = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    chunk = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(chunks)).cast("int")
    left = rows.select("id", "v", cell.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    right = queries.select("id", "v", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), chunk.alias("chunk"))
    found = left.groupBy("block", "chunk").cogroup(right.groupBy("block", "chunk")).applyInArrow(
        _search(shared, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op6_ann(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


QUERIES = {"op6_ann": op6_ann}
ORACLES: dict[str, str] = {}
