"""SimHash near-duplicates: fingerprints, segment-popcount grid join, components.

A fingerprint is cut into 32 segments of two bits; each segment's bit count (0, 1, 2) makes an
embedding whose Manhattan distance never exceeds the Hamming distance. Written in unary
(00, 01, 11) the embedding is one 64-bit number, and its Manhattan distance the bit count of an
XOR. The grid: segments form ``bands`` bands; if the distance is at most ``radius``, at least
``bands - radius`` bands agree, so each choice of that many bands with their values is a cell
that both fingerprints share. The number of bands grows with the logarithm of the number of
distinct fingerprints, which keeps cells small at every size; the links are the same for any
number. Inside a cell candidates pass the Manhattan bound and then the exact distance.

A cell yields a spanning forest of its links, not all pairs: components are the same. Cells of
more than ``max_cell`` fingerprints are cut into chunks and every pair of chunks is compared, so
no group is unbounded and no link is lost.

Defined results: null or empty text has fingerprint zero and links like any other; rows with
equal fingerprints are linked; rows without id are fingerprinted and take the component of
their fingerprint; repeated rows are returned as often as they occur; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, staged, table
from .components import components

SHINGLE = 4          # words
RADIUS = 4           # bits
MAX_CELL = 4096
SEED = 42
CHUNK = 1 << 16      # shingles whose bits are counted at once


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of one whole text, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # ASCII case and white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1:] if len(words) >= shingle else [len(joined) + 1]
    digest, seed = xxhash.xxh64_intdigest, SEED
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        hs = np.array([digest(joined[s:e - 1], seed) for s, e in zip(starts[lo:lo + CHUNK], last[lo:lo + CHUNK])],
                      dtype="<u8")
        ones += np.unpackbits(hs.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, fp) with the fingerprint's 64 bits as a long."""
    ship_package(docs.sparkSession)

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, fp long")


def unary(fp):
    """The embedding in unary, as a Column expression or on numpy int64."""
    mask = 0x5555555555555555
    hi, lo = "(shiftrightunsigned(fp, 1) & {m}L)".format(m=mask), "(fp & {m}L)".format(m=mask)
    if isinstance(fp, np.ndarray):
        x = fp.view(np.uint64)
        m = np.uint64(mask)
        a, b = (x >> np.uint64(1)) & m, x & m
        return ((a | b) | ((a & b) << np.uint64(1)))
    return F.expr(f"({hi} | {lo}) | shiftleft({hi} & {lo}, 1)")


def band_masks(bands: int, radius: int) -> list[int]:
    """One 64-bit mask for each choice of ``bands - radius`` bands of whole segments."""
    cuts = [2 * round(32 * i / bands) for i in range(bands + 1)]
    single = [((1 << (e - s)) - 1) << s for s, e in zip(cuts, cuts[1:])]
    return [sum(c) for c in itertools.combinations(single, bands - radius)]


def bands_for(n: int, radius: int) -> int:
    """So many bands that a cell holds a few unrelated fingerprints at most: a segment's count
    carries 1.5 bits, and log2(n) - 2 bits are asked of a cell's key."""
    for bands in range(radius + 1, 33):
        if 1.5 * 32 * (bands - radius) / bands >= math.log2(max(n, 2)) - 2:
            return bands
    return 32


def _forest(fp: np.ndarray, un: np.ndarray, radius: int) -> tuple[list, list]:
    """Spanning forest of the links inside one cell, by breadth-first search."""
    left = np.arange(len(fp))
    out_a, out_b = [], []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(un[left] ^ un[x]) <= radius
            near[near] = np.bitwise_count(fp[left[near]] ^ fp[x]) <= radius
            hit = left[near]
            if len(hit):
                out_a.append(np.full(len(hit), x))
                out_b.append(hit)
                queue.extend(hit)
                left = left[~near]
    return out_a, out_b


def _cell_links(radius: int):
    def edges(fp, rep, starts, sizes):
        un, fpu = unary(fp), fp.view(np.uint64)
        pa_, pb_ = [], []
        small = sizes <= 8
        s, z = starts[small], sizes[small]
        for i, j in itertools.combinations(range(8), 2):
            ok = z > j
            x, y = s[ok] + i, s[ok] + j
            ok = np.bitwise_count(un[x] ^ un[y]) <= radius
            x, y = x[ok], y[ok]
            ok = np.bitwise_count(fpu[x] ^ fpu[y]) <= radius
            pa_.append(x[ok])
            pb_.append(y[ok])
        for st, n in zip(starts[~small], sizes[~small]):
            a, b = _forest(fpu[st:st + n], un[st:st + n], radius)
            pa_ += [x + st for x in a]
            pb_ += [x + st for x in b]
        a = rep[np.concatenate(pa_)]
        b = rep[np.concatenate(pb_)]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            change = np.flatnonzero((cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])) + 1
            cut = change[-1] if len(change) else 0
            held = [c[cut:] for c in cols]
            if cut:
                starts = np.concatenate([[0], change[:-1]])
                sizes = np.diff(np.append(starts, cut))
                many = sizes > 1
                yield edges(cols[2][:cut], cols[3][:cut], starts[many], sizes[many])
        if held is not None and len(held[0]) > 1:
            yield edges(held[2], held[3], np.array([0]), np.array([len(held[0])]))

    return run


def links(fps: DataFrame, radius: int = RADIUS, max_cell: int = MAX_CELL, bands: int | None = None) -> DataFrame:
    """Distinct ``(fp, rep)`` rows -> edges ``(a, b)`` between reps that span every group of
    fingerprints linked at ``radius`` bits or fewer."""
    ship_package(fps.sparkSession)
    masks = band_masks(bands or bands_for(fps.count(), radius), radius)
    cells = fps.withColumn("un", unary(F.col("fp"))).select(
        "fp", "rep", F.posexplode(F.array(*[F.col("un").bitwiseAND(F.lit(m if m < 1 << 63 else m - (1 << 64)))
                                            for m in masks])).alias("k", "cell"))
    cells = cells.select("fp", "rep", F.xxhash64("k", "cell").alias("key"))
    big = cells.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > max_cell)
    parts = F.ceil(F.col("n") / max_cell).cast("int")
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("parts"))
    sub = F.transform(F.sequence(F.lit(0), F.col("parts") - 1),
                      lambda x: F.least(x, F.col("mine")) * F.lit(1 << 20) + F.greatest(x, F.col("mine")))
    cells = (cells.join(big, "key", "left")
             .withColumn("parts", F.coalesce(parts, F.lit(1)))
             .withColumn("mine", mine.cast("int"))
             .select("key", F.explode(sub.cast("array<long>")).alias("sub"), "fp", "rep"))
    dealt = cells.repartition("key", "sub").sortWithinPartitions("key", "sub")
    return dealt.mapInArrow(_cell_links(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, max_cell: int = MAX_CELL) -> DataFrame:
    """Every row with its fingerprint (hex) and component (smallest id reachable)."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle), "fps")
    reps = staged(fps.groupBy("fp").agg(F.min("id").alias("rep")), "reps")
    comp = components(links(reps.filter("rep IS NOT NULL"), radius, max_cell))
    labels = reps.join(comp, reps["rep"] == comp["node"], "left") \
        .select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(labels, "fp").select(F.col("id").alias(id_col),
                                         F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             **kw) -> DataFrame:
    """The rows of ``docs`` that stay, one per component: that with the smallest id. Texts stay where they
    are; only the staged ids of those that go are held against them. An id that several rows share goes
    when all its rows do. Of rows without id one stays for each fingerprint that no row with id has."""
    every = near_duplicates(docs, id_col, text_col, shingle, **kw)
    drop = staged(every.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_d"))
                  .agg(F.min((F.col(id_col) != F.col("component_id")).cast("int")).alias("_g")).filter("_g = 1").select("_d"),
                  "near-gone")
    named = docs.filter(F.col(id_col).isNotNull())
    named = named.join(drop, named[id_col] == drop["_d"], "left_anti")
    bare = docs.filter(F.col(id_col).isNull())
    mark = F.pandas_udf(lambda texts: texts.map(lambda t: f"{fingerprint(t, shingle):016x}"), "string")
    seen = every.filter(F.col(id_col).isNotNull()).select(F.col("fingerprint").alias("_seen")).distinct()
    bare = bare.withColumn("_fp", mark(F.col(text_col)))
    bare = bare.join(seen, bare["_fp"] == seen["_seen"], "left_anti").dropDuplicates(["_fp"]).drop("_fp")
    return named.unionByName(bare)


def op4_simhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op4_simhash": op4_simhash}
ORACLES: dict[str, str] = {}
