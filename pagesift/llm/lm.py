"""Language-model scoring by logistic context mixing, bit by bit.

A text is its words in lower case and one end. Every token is coded in binary decisions, and every decision's
probability comes from the same kind of mixer: hashed contexts predict the bit from counts, their log odds are
added under weights that a gate picks, and an adaptive probability map refines the sum.

* Along the text, first whether training knows the word, then the four bits of its class (the group of documents
  it is most frequent in, and its frequency in tens). Contexts reach across words: the last class, the last two
  classes, the groups of the last four words, the previous word, the groups of the last ``WINDOW`` words, the share of
  unknown words so far. The gate is the decision and the confidence of the previous word's counts.
* Inside a word, its bytes and a closing space, eight decisions a byte, from the position and the last
  1, 2, 3, 4 and 6 bytes, gated by bit number, position and confidence of the counts.

With p the first decision's probability, a word has

    P = (1 - CACHE) * (p * P_class * P_word + (1 - p) * P_spelled) + CACHE * P_cache

where P_word is its share of the training tokens of its class in the group of most of the last ``WINDOW`` words (a share
``BACKOFF`` of it in all groups; 0 if unknown), and P_cache its share of the text so far. All of it depends on earlier words only, so the P of all texts add up to at most 1, and the logarithm also gives the total
bits per byte.

What is gathered grows with the corpus: the table of all distinct words with their counts, made by one grouping over
block word lists; class totals, counts of contexts, weights and maps are sums over every training word of every training
text. Words are counted in ``BUCKETS`` buckets of the vocabulary or more (one for 128 MB of text), blocks' word lists go to them and
come back compressed; training texts are staged once as contexts by symbol, which every pass reads.
Words that occur once stand for unknown ones there. Only the tables of the contexts' counts are of fixed
size (``SLOTS``, 22 MB, and ``TOKEN_SLOTS``), summed in Spark and broadcast. Weights along texts take ``STEPS`` Newton steps,
one pass each; those inside words are learned online in ``SHARDS`` shards of the words by hash and averaged in shard order.
Sums are whole numbers, so scores don't depend on the number of shuffle partitions. The ``GROUPS`` groups of documents are
found by clustering the ``VOCABULARY`` most frequent words by the documents they share, counted in one pass over all.

Defined results: null text is empty and scores its end alone; repeated rows and null ids are scored
as often as they occur; without training rows every word is spelled with even odds; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import crc_mod, release, ship_package, staged, table
from .wordblocks import DOCS, by_block, documents_of, pack, pack_words, unpack, unpack_words, word_blocks

LN10 = math.log(10)

FOLD, HELD = 7, 2
SLOT_BITS = (12, 16, 19, 21, 22, 22)         # one table for each context
OFFSETS = np.cumsum([0] + [1 << b for b in SLOT_BITS])
SLOTS = int(OFFSETS[-1])
ONE = np.uint32(1)                           # of the counts' own type: far faster to add in place
PART = 1 << 16                               # slots of a row of the summed tables
N_CONF, N_GATE, N_MAP = 16, 32, 33
WEIGHTS = len(SLOT_BITS) * N_CONF * N_GATE
STREAM = 1 << 14                             # bytes spelled at once
GROUPS, WINDOW, CACHE = 4, 48, 0.03
VOCABULARY, RESTARTS, ROUNDS = 500, 8, 20
EFFECTIVE = 100.0                            # words' worth of evidence in a word's shared documents
BUCKETS = 32                                 # of the vocabulary at least
SHARDS, LESSON = 64, 4096                    # shards of the distinct words, words learned at once
FIXED = 1 << 20                              # sums of a pass are whole numbers of 1 / FIXED, the same in any order
TOKEN_CONTEXTS = (18, 18 * 18, 6 ** 4, 1 << 13, 128, 128)
NODES = 16                                   # known or not, and the inner nodes of the class's four bits
TOKEN_OFFSETS = np.cumsum([0] + [NODES * c for c in TOKEN_CONTEXTS])
TOKEN_SLOTS = int(TOKEN_OFFSETS[-1])
INPUTS, TOKEN_GATES, STEPS, START, RIDGE = len(TOKEN_CONTEXTS), 4 * NODES, 2, 0.2, 4.0
BACKOFF = 0.05                               # share of all groups in a class's words
TOKENS, DECISIONS = 1 << 17, 1 << 14         # tokens of a piece, decisions mixed at once: they stay in a core's cache
RATE, CURVATURE = 1.0, 0.25


# -- counts ---------------------------------------------------------------------------------
def quantise(n: np.ndarray) -> np.ndarray:
    """Counts as 8 bits: exact to 15, then four steps for each doubling."""
    big = 16 + np.floor(4 * np.log2(np.maximum(n, 16) / 16))
    return np.where(n < 16, n, np.minimum(big, 255)).astype(np.uint16)


def _lookup():
    q = np.arange(256)
    value = np.where(q < 16, q, 16 * 2.0 ** ((q - 16) / 4))
    n0, n1 = np.repeat(value, 256), np.tile(value, 256)
    stretch = np.clip(np.log((n1 + 0.4) / (n0 + 0.4)), -8, 8).astype(np.float32)
    conf = np.minimum(np.log2(n0 + n1 + 1).astype(int), 7) + np.where((n0 == 0) | (n1 == 0), 8, 0)
    v = np.arange(65536)
    less0 = np.where((v >> 8 > 0) & (v >> 8 < 16), v - 256, v).astype(np.uint16)
    less1 = np.where((v & 255 > 0) & (v & 255 < 16), v - 1, v).astype(np.uint16)
    return stretch, conf.astype(np.int32), np.stack([less0, less1])


STRETCH, CONF, LESS = _lookup()
WEIGHT_OF = CONF.astype(np.int64) * N_GATE   # of the first gate
STRETCH_LESS, WEIGHT_LESS = STRETCH[LESS].ravel(), WEIGHT_OF[LESS].ravel()      # by bit and value
EIGHTHS = np.minimum(8 * np.arange(WINDOW + 1) // np.maximum(np.arange(WINDOW + 1), 1)[:, None], 7).ravel()    # by window and count


# -- contexts -------------------------------------------------------------------------------
def streams(words: list[bytes]):
    """The words in pieces of about STREAM bytes: (first word, bytes, position in the word)."""
    lo, size = 0, 0
    for i, w in enumerate(words):
        size += len(w) + 1
        if size >= STREAM or i == len(words) - 1:
            raw = np.frombuffer(b" ".join(words[lo:i + 1]) + b" ", np.uint8)
            ends = np.flatnonzero(raw == 32)
            starts = np.concatenate([[0], ends[:-1] + 1])
            yield lo, raw, starts, np.arange(len(raw)) - np.repeat(starts, ends + 1 - starts)
            lo, size = i + 1, 0


def contexts(raw: np.ndarray, pos: np.ndarray) -> list[np.ndarray]:
    """A 32-bit hash of each context at each byte."""
    last = [np.where(pos >= k, np.concatenate([np.zeros(min(k, len(raw)), np.uint8), raw[:-k]]), 0).astype(np.uint32)
            for k in range(1, 7)]
    two = last[0] | last[1] << np.uint32(8)
    three = two | last[2] << np.uint32(16)
    four = three | last[3] << np.uint32(24)
    six = (four * np.uint32(0x9E3779B1) + (last[4] | last[5] << np.uint32(8))) * np.uint32(0x85EBCA6B) \
        + np.minimum(pos, 7).astype(np.uint32)
    out = [np.minimum(pos, 15).astype(np.uint32), last[0] + np.uint32(256), two, three, four, six]
    return [(c + np.uint32(i * 0x1F123BB5)) * np.uint32(0x9E3779B1) for i, c in enumerate(out)]


def bits(raw: np.ndarray, pos: np.ndarray):
    """For each of a byte's eight bits: its number, its value, its slot in each context's table."""
    ctx = contexts(raw, pos)
    wide = raw.astype(np.uint32)
    for j in range(8):
        node = (np.uint32(1 << j) | wide >> np.uint32(8 - j)) * np.uint32(0xC2B2AE35)
        slots = []
        for c, b, o in zip(ctx, SLOT_BITS, OFFSETS):
            h = (c ^ node) * np.uint32(0x27D4EB2F)
            slots.append(((h ^ h >> np.uint32(15)) * np.uint32(0x165667B1) >> np.uint32(32 - b)).astype(np.int64) + int(o))
        yield j, (raw >> np.uint8(7 - j)) & np.uint8(1), slots


class Mixer:
    """Weights, refinement map and count tables; predicts and learns."""

    def __init__(self, tables: np.ndarray, weights=None, refine=None):
        self.tables = tables
        self.w = np.full(WEIGHTS, 0.35) if weights is None else weights
        self.refine = refine                                   # probabilities by gate and bucket

    def mix(self, gate, slots, bit=None):
        """(log odds, inputs, indices of each context's weights); with ``bit`` on leave-one-out counts."""
        stretch, weight = (STRETCH, WEIGHT_OF) if bit is None else (STRETCH_LESS, WEIGHT_LESS)
        z, after = np.zeros(len(gate)), 0 if bit is None else bit.astype(np.int64) << 16
        xs, at = [], []
        for w, s in zip(self.w.reshape(len(SLOT_BITS), -1), slots):
            v = self.tables.take(s).astype(np.int64) + after
            x, k = stretch.take(v), weight.take(v) + gate
            z += w.take(k) * x
            xs.append(x)
            at.append(k)
        return np.clip(z, -14, 14), xs, at

    @staticmethod
    def bucket(z, gate):
        return gate * N_MAP + np.round((z + 14) * (N_MAP - 1) / 28).astype(np.int64)

    def learn(self, words: list[bytes], counts: np.ndarray) -> None:
        """One online pass; ``counts`` collects bits by bucket of the map as they are predicted."""
        for _, raw, _, pos in streams(words):
            p4 = np.minimum(pos, 3).astype(np.int64)
            for j, bit, slots in bits(raw, pos):
                gate = j * 4 + p4
                z, xs, at = self.mix(gate, slots, bit)
                p = 1 / (1 + np.exp(-z))
                counts += np.bincount(self.bucket(z, gate) * 2 + bit, minlength=len(counts))
                err = bit - p
                own = N_CONF * N_GATE
                up = np.concatenate([np.bincount(k, err * x, own) for x, k in zip(xs, at)])
                down = 50.0 + np.concatenate([np.bincount(k, CURVATURE * x * x, own) for x, k in zip(xs, at)])
                self.w = np.clip(self.w + RATE * up / down, -1, 4)         # the bound of the curvature keeps steps short

    def spell(self, words: list[bytes]) -> np.ndarray:
        """log10 of the probability of each word's spelling."""
        out = np.empty(len(words))
        for lo, raw, starts, pos in streams(words):
            p4 = np.minimum(pos, 3).astype(np.int64)
            total = np.zeros(len(raw))
            for j, bit, slots in bits(raw, pos):
                gate = j * 4 + p4
                z, _, _ = self.mix(gate, slots)
                p = 1 / (1 + np.exp(-z))
                p = 0.5 * p + 0.5 * self.refine.take(self.bucket(z, gate))
                total += np.log10(np.where(bit == 1, p, 1 - p))
            out[lo:lo + len(starts)] = np.add.reduceat(total, starts)
        return out


# -- groups of documents ----------------------------------------------------------------------
class Grouping:
    """Groups of some frequent words; assigns texts to the group that predicts those they hold best."""

    def __init__(self, vocabulary: list[bytes], log_p: np.ndarray):
        self.index = {w: i for i, w in enumerate(vocabulary)}
        self.log_p = log_p

    def __call__(self, words: list[bytes]) -> int:
        at = np.array([i for i in map(self.index.get, words) if i is not None], np.int64)
        return int(self.assign(np.zeros(len(at), np.int64), at, 1)[0])

    def assign(self, doc: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        """The group of each of ``n`` texts from which text holds which word, repeats included."""
        return np.stack([np.bincount(doc, p.take(at), n) for p in self.log_p]).argmax(axis=0)


def add_up(rows: DataFrame, width: int) -> np.ndarray:
    """The sum of all of ``rows(data)``, compressed arrays of ``width`` 64-bit numbers."""
    def add(batches):
        total = None
        for b in batches:
            for d in b.column(0).to_pylist():
                n = numbers(d)
                total = n.copy() if total is None else total + n
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([squeeze(total)])], names=["data"])

    out = np.zeros(width, np.int64)
    for r in rows.repartition(8).mapInArrow(add, "data binary").collect():       # 8 rows at most
        out += numbers(r.data)
    return out


def squeeze(n: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(n, np.int64).tobytes())


def clusters(shared: np.ndarray) -> np.ndarray:
    """log P(word | group) of a mixture over each word's row of shared documents; the best of RESTARTS."""
    rows = shared.astype(float)
    rows = rows / np.maximum(rows.sum(axis=1, keepdims=True), 1)
    best, best_fit, mean = None, -np.inf, rows.mean(axis=0)
    for restart in range(RESTARTS):
        start = np.random.default_rng(restart).choice(len(rows), GROUPS, replace=len(rows) < GROUPS)
        p, log_w = 0.5 * rows[start] + 0.5 * mean, np.zeros(GROUPS)
        for _ in range(ROUNDS):
            p = p + 0.01 * mean * p.sum(axis=1, keepdims=True) + 1e-9
            log_p = np.log(p / p.sum(axis=1, keepdims=True))
            z = EFFECTIVE * rows @ log_p.T + log_w
            norm = np.logaddexp.reduce(z, axis=1)
            r = np.exp(z - norm[:, None])
            p, log_w = r.T @ rows, np.log(r.mean(axis=0) + 1e-6)
        if norm.sum() > best_fit:
            best, best_fit = log_p, norm.sum()
    return best


def _vocabulary(rows: pa.Table) -> pa.Table:
    """Rows (bucket, block, data, counts) of one bucket -> its distinct words with their training counts (block -1), and the
    position of each block's words among them."""
    index, n, out = defaultdict(itertools.count().__next__), np.zeros(1 << 12, np.int64), []
    bucket = rows.column("bucket")[0].as_py()
    for block, data, counts in zip(*(rows.column(c) for c in ("block", "data", "counts"))):
        at = np.fromiter(map(index.__getitem__, unpack_words(data.as_py())), np.int64)
        if len(index) > len(n):
            n = np.concatenate([n, np.zeros(len(index), np.int64)])
        n[at] += unpack(counts.as_py())                         # a block lists a word once
        out.append((bucket, block.as_py(), pack(at), None))
    out.append((bucket, DOCS, pack_words(list(index)), squeeze(n[:len(index)])))
    return pa.table([pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    names=["bucket", "block", "data", "counts"])


def vocabulary(blocks: DataFrame) -> DataFrame:
    return by_block(blocks.filter("bucket >= 0").select("bucket", "block", "data", "counts").groupBy("bucket")
                    .applyInArrow(_vocabulary, "bucket int, block long, data binary, counts binary"), "bucket")


def _most(batches):
    """Distinct words with counts -> those that may be among the VOCABULARY most frequent."""
    for b in batches:
        for data, counts in zip(*(c.to_pylist() for c in b.columns)):
            words, n = unpack_words(data), numbers(counts)
            least = max(np.sort(n)[-VOCABULARY:][0], 1)
            top = sorted((-int(n[i]), words[i]) for i in np.flatnonzero(n >= least))[:VOCABULARY]
            yield pa.RecordBatch.from_arrays([pa.array([w for _, w in top], pa.binary()), pa.array([-k for k, _ in top], pa.int64())],
                                             names=["word", "n"])


class _Listed:
    """A block's training documents, and where its words of ``index`` stand in them."""

    def __init__(self, block: pa.Table, index: dict):
        rows = {r["bucket"]: r for r in block.to_pylist()}
        row = rows.pop(DOCS)
        marks, sizes = unpack(row["counts"]), unpack(row["sizes"])
        self.train, bucket = np.flatnonzero(marks[:len(sizes)]), marks[len(sizes):]
        number = np.full(len(bucket), -1)
        self.places = words_by_bucket(bucket)
        for q, r in rows.items():
            got = [(i, index[w]) for i, w in enumerate(unpack_words(r["data"])) if w in index]
            if got:
                i, k = np.array(got).T
                number[self.places(q)[i]] = k
        self.flat = unpack(row["data"])
        doc = np.full(len(sizes), -1)
        doc[self.train] = np.arange(len(self.train))
        self.doc = np.repeat(doc, sizes)                        # of each word, -1 for texts that don't train
        self.buckets, self.n_words = list(rows), len(bucket)
        number = number.take(self.flat)
        hit = (number >= 0) & (self.doc >= 0)
        self.hit_doc, self.hit = self.doc[hit], number[hit]


def words_by_bucket(bucket: np.ndarray):
    """The places of the words of a bucket in a block's list, by bucket."""
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(bucket.max() + 2 if len(bucket) else 1))
    return lambda q: order[cuts[q]:cuts[q + 1]]


def grouping(train: DataFrame) -> Grouping:
    """The grouping by all of ``train(text)``."""
    blocks = word_blocks(train.select("text", F.lit(0).alias("id")), "id", "text", F.lit(True))
    return grouping_of(blocks, vocabulary(blocks))


def grouping_of(blocks: DataFrame, vocab: DataFrame) -> Grouping:
    """The grouping by all training documents of the blocks."""
    top = vocab.filter(F.col("block") == DOCS).select("data", "counts").mapInArrow(_most, "word binary, n long") \
        .orderBy(F.desc("n"), "word").limit(VOCABULARY).collect()
    listed = [bytes(r.word) for r in top]
    if not listed:
        return Grouping([], np.zeros((GROUPS, 0)))

    def together(block: pa.Table) -> pa.Table:
        b, total = _Listed(block, {w: i for i, w in enumerate(listed)}), np.zeros((len(listed),) * 2, np.int64)
        cuts = np.searchsorted(b.hit_doc, np.arange(0, len(b.train) + 512, 512))
        for first, lo, hi in zip(range(0, len(b.train), 512), cuts, cuts[1:]):
            x = np.zeros((512, len(listed)), np.float32)
            x[b.hit_doc[lo:hi] - first, b.hit[lo:hi]] = 1
            total += np.rint(x.T @ x).astype(np.int64)
        return pa.table({"data": pa.array([squeeze(total)], pa.binary())})

    shared = add_up(blocks.groupBy("block").applyInArrow(together, "data binary"), len(listed) ** 2)
    return Grouping(listed, clusters(shared.reshape(len(listed), -1)))


def _tallies(group):
    """One block -> (block, bucket, training counts of its words by group)."""
    def run(block: pa.Table) -> pa.Table:
        b = _Listed(block, group.value.index)
        of = np.append(group.value.assign(b.hit_doc, b.hit, len(b.train)), -1)
        mine, out = of.take(b.doc), []                          # the last stands for texts that don't train
        n = np.stack([np.bincount(b.flat[mine == g], minlength=b.n_words) for g in range(GROUPS)])
        number = block.column("block")[0].as_py()
        for q in b.buckets:
            out.append((number, q, pack(n[:, b.places(q)].ravel())))
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out) if out else ([], [], []), (pa.int64(), pa.int32(), pa.binary()))],
                        names=["block", "bucket", "counts"])
    return run


def _word_counts(vocab: pa.Table, tallies: pa.Table) -> pa.Table:
    """One bucket's words, and the blocks' counts of them by group -> (bucket, words, counts by group)."""
    places, words = {}, None
    for block, data in zip(vocab.column("block").to_pylist(), vocab.column("data")):
        places[block] = data.as_py()
    words = places.pop(DOCS)
    n = None
    for block, counts in zip(tallies.column("block").to_pylist(), tallies.column("counts")):
        at, counts = unpack(places[block]), unpack(counts.as_py()).reshape(GROUPS, -1)
        if n is None:
            n = np.zeros((GROUPS, words_in(words)), np.int64)
        n[:, at] += counts
    return pa.table({"bucket": pa.array([vocab.column("bucket")[0].as_py()], pa.int32()), "data": pa.array([words], pa.binary()),
                     "counts": pa.array([squeeze(n)], pa.binary())})


def words_in(data: bytes) -> int:
    return zstandard.ZstdDecompressor().decompress(data).count(b" ") + 1


def numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.int64)


# -- tokens of texts ----------------------------------------------------------------------------
COUNTS = [f"c{g}" for g in range(GROUPS)]
ATTRIBUTES = {"spelled": "<f8", "hash": "<u4", "size": "<u4", "cls": "u1", **dict.fromkeys(COUNTS, "<u8")}
KEPT = {"two": "<u2", "four": "<u2", "word": "<u2", "window": "u1", "so_far": "u1"}


def pack_columns(kinds: dict, columns) -> bytes:
    """Columns of equal length, byte planes apart, compressed."""
    planes = [np.ascontiguousarray(c, k).view(np.uint8).reshape(len(c), np.dtype(k).itemsize).T.tobytes()
              for c, k in zip(columns, kinds.values())]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack_columns(kinds: dict, data: bytes) -> dict:
    raw, lo, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8), 0, {}
    n = len(raw) // sum(np.dtype(k).itemsize for k in kinds.values())
    for name, k in kinds.items():
        wide = np.dtype(k).itemsize
        out[name] = np.ascontiguousarray(raw[lo:lo + n * wide].reshape(wide, n).T).view(k).reshape(-1)
        lo += n * wide
    return out


class Words:
    """The word list of one block, by position, and the end as its last row."""

    def __init__(self, found: pa.Table, end: dict):
        rank = found.column("rank").to_numpy()
        for name, kind in (("cls", np.int64), ("hash", np.uint32), ("spelled", float), ("size", np.int64), *((c, np.int64) for c in COUNTS)):
            v = np.zeros(len(rank) + 1, kind)
            v[rank] = found.column(name).to_numpy().astype(kind)
            v[-1] = end[name]
            setattr(self, name, v)
        self.n = sum(getattr(self, c) for c in COUNTS)


def pieces(row: dict, end_at: int, training: bool):
    """A block's texts in pieces of about TOKENS: (ids, first tokens of texts, position in the text, word positions)."""
    ids, texts, size = [], [], 0
    marks = unpack(row["counts"])
    for (doc_id, at), mark in itertools.chain(zip(documents_of(row["ids"], row["sizes"], row["data"]), marks), [((None, None), None)]):
        if texts and (mark is None or size >= TOKENS):
            lens = np.array([len(t) for t in texts])
            starts = np.cumsum(lens) - lens
            yield ids, starts, np.arange(size) - np.repeat(starts, lens), np.concatenate(texts)
            ids, texts, size = [], [], 0
        if mark is not None and (mark or not training):
            ids.append(doc_id)
            texts.append(np.append(at, end_at).astype(np.int64))
            size += len(texts[-1])


def token_contexts(sym: np.ndarray, hashes: np.ndarray, pos: np.ndarray) -> list[np.ndarray]:
    """Each context's number at each token, from the tokens before it in its text."""
    start = [np.flatnonzero(pos < k) for k in range(5)]

    def back(x, k, none):
        out = np.concatenate([np.zeros(min(k, len(x)), x.dtype), x[:-k]])
        out[start[k]] = none
        return out

    t = np.arange(len(sym))
    group = np.where(sym > 0, (sym - 1) >> 2, GROUPS)
    one = back(sym, 1, 17)
    four = sum(back(group, k, 5) * 6 ** (k - 1) for k in range(1, 5))
    before = np.zeros((GROUPS + 1, len(sym) + 1), np.int64)
    for g in range(GROUPS + 1):
        np.cumsum(group == g, out=before[g, 1:])
    width = np.minimum(pos, WINDOW)
    recent = [b[:-1] - b.take(t - width) for b in before]
    top, most = np.zeros(len(sym), np.int64), recent[0]
    for g in range(1, GROUPS):
        top[recent[g] > most] = g
        most = np.maximum(most, recent[g])
    of_width = width * (WINDOW + 1)
    window = (top * 8 + EIGHTHS.take(of_width + most)) * 4 + np.minimum(EIGHTHS.take(of_width + recent[GROUPS]), 3)
    unknown = before[GROUPS, :-1] - before[GROUPS].take(t - pos)
    doubled = np.minimum(np.log2(np.arange(1, pos.max(initial=0) + 2)).astype(np.int64), 15) * 8
    so_far = doubled.take(pos) + np.minimum(32 * unknown // np.maximum(pos, 1), 7)
    word = (hashes * np.uint32(0x9E3779B1)) >> np.uint32(19)
    return [one, one * 18 + back(sym, 2, 17), four, back(word, 1, 0).astype(np.int64), window, so_far]


def decisions(sym: np.ndarray, ctx: list[np.ndarray]):
    """The binary decisions of the tokens, DECISIONS at once, each time of one node and bit: which tokens take them, node,
    bit, slots."""
    order = np.arange(len(sym))
    if (sym[1:] < sym[:-1]).any():
        order = np.argsort(sym.astype(np.uint8), kind="stable")
        ctx = [c.take(order) for c in ctx]
    slots = [int(o) + c * NODES for o, c in zip(TOKEN_OFFSETS, ctx)]
    ends = np.append(0, np.cumsum(np.bincount(sym, minlength=17)))       # symbols in order: those of a node lie together
    turns = [(0, 0, 0, 1), (0, 1, 1, 17)]
    for j in range(1, 5):
        wide = 1 << 4 - j
        turns += [(1 << j - 1 | h >> 1, h & 1, 1 + h * wide, 1 + (h + 1) * wide) for h in range(1 << j)]
    for node, bit, first, last in turns:
        for lo in range(ends[first], ends[last], DECISIONS):
            some = slice(lo, min(lo + DECISIONS, ends[last]))
            took = order[some]
            yield took, np.full(len(took), node), np.full(len(took), bit), [s[some] + node for s in slots]


class TokenMixer:
    """Count tables, weights and refinement map of the decisions along texts."""

    def __init__(self, tables: np.ndarray):
        self.tables = tables
        self.w = np.full((TOKEN_GATES, INPUTS), START)
        self.refine = None
        self.made = {}

    def mix(self, node: int, slots, bit=None):
        """Of decisions of one node (with ``bit`` of one bit, on leave-one-out counts): their order by gate, each gate's
        number and slice, inputs and log odds in that order."""
        inputs, level = self.by_slot(node, bit)
        of = level.take(slots[3] >> 4)
        order = np.argsort(of, kind="stable")
        x = np.empty((INPUTS, len(order)))
        for row, s in zip(x, slots):
            np.take(inputs, s.take(order) >> 4, out=row, mode="clip")
        z, gates, lo = np.empty(len(order)), [], 0
        for g, n in enumerate(np.bincount(of, minlength=4).tolist()):
            if n:
                gates.append((node * 4 + g, slice(lo, lo + n)))
                np.matmul(self.w[node * 4 + g], x[:, lo:lo + n], out=z[lo:lo + n])
                lo += n
        return order, gates, x, np.clip(z, -14, 14, out=z)

    def by_slot(self, node: int, bit):
        """Input and level of confidence of the node's slots (with ``bit`` on leave-one-out counts), made once."""
        if (node, bit) not in self.made:
            v = self.tables[node::NODES].astype(np.int64)
            if bit is not None:
                v = LESS[bit].take(v).astype(np.int64)
            self.made[node, bit] = STRETCH.take(v).astype(float), np.minimum((CONF.take(v) & 7) >> 1, 3).astype(np.uint8)
        return self.made[node, bit]

    @staticmethod
    def bucket(z, node):
        return node * N_MAP + np.round((z + 14) * ((N_MAP - 1) / 28)).astype(np.int64)

    def probability(self, z, node):
        p = 1 / (1 + np.exp(-z))
        return p if self.refine is None else 0.5 * p + 0.5 * self.refine.take(self.bucket(z, node))


SLOPES = TOKEN_GATES * INPUTS * (INPUTS + 1)


def _counts(sym, ctx, _):
    n = np.zeros((TOKEN_SLOTS // NODES, NODES, 2), np.int64)
    for c, size, o in zip(ctx, TOKEN_CONTEXTS, TOKEN_OFFSETS // NODES):
        seen = np.bincount(c * (NODES + 1) + sym, minlength=size * (NODES + 1)).reshape(size, -1)
        own, known = n[o:o + size], seen[:, 1:]
        own[:, 0, 0], own[:, 0, 1] = seen[:, 0], known.sum(axis=1)
        for j in range(1, 5):
            own[:, 1 << j - 1:1 << j] = known.reshape(size, 1 << j - 1, 2, -1).sum(axis=3)
    return n.ravel()


def _slopes(sym, ctx, m):
    """Gradient and curvature of each gate's weights."""
    out = np.zeros((TOKEN_GATES, INPUTS + 1, INPUTS))
    for _, node, bit, slots in decisions(sym, ctx):
        _, gates, x, z = m.mix(int(node[0]), slots, int(bit[0]))
        p = m.probability(z, int(node[0]))
        curved = x * (p * (1 - p))
        err = bit[0] - p
        for g, some in gates:
            out[g, 0] += x[:, some] @ err[some]
            out[g, 1:] += curved[:, some] @ x[:, some].T
    return np.rint(out.ravel() * FIXED).astype(np.int64)


def _bits_by_bucket(sym, ctx, m):
    out = np.zeros(2 * NODES * N_MAP, np.int64)
    for _, node, bit, slots in decisions(sym, ctx):
        z = m.mix(int(node[0]), slots, int(bit[0]))[-1]
        out[int(bit[0])::2] += np.bincount(m.bucket(z, int(node[0])), minlength=len(out) // 2)
    return out


def train_pass(rows: DataFrame, sym: str, ctx: str, each, width: int, model=None) -> np.ndarray:
    """The sum of ``each(symbols, contexts, model)`` over all ``rows(sym, ctx)``, pieces of training texts."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        total = np.zeros(width, np.int64)
        for b in batches:
            for s, c in zip(b.column(0), b.column(1)):
                c = [v.astype(np.int64) for v in unpack_columns(KEPT, c.as_py()).values()]
                total += each(np.repeat(np.arange(17), unpack(s.as_py())), [c[0] // 18, *c], shared.value)
        yield pa.RecordBatch.from_arrays([pa.array([squeeze(total)], pa.binary())], names=["data"])
        del total
        release()

    return add_up(rows.select(sym, ctx).mapInArrow(run, "data binary"), width)


def lesson(sym: np.ndarray, ctx: list[np.ndarray]):
    """A piece of training texts for ``train_pass``: how many tokens each symbol has, and the tokens' contexts by symbol."""
    order = np.sort((sym << 13 | ctx[3]) << 32 | np.arange(len(sym))) & (1 << 32) - 1
    return pack(np.bincount(sym, minlength=17)), pack_columns(KEPT, [c.take(order) for c in ctx[1:]])


def fit_tokens(lessons: DataFrame) -> TokenMixer:
    """Counts, then weights, then the map, each over every training text."""
    n = train_pass(lessons, "sym", "ctx", _counts, 2 * TOKEN_SLOTS)
    q = quantise(n.reshape(-1, 2))
    m = TokenMixer(q[:, 0] << 8 | q[:, 1])
    for _ in range(STEPS):
        s = train_pass(lessons, "sym", "ctx", _slopes, SLOPES, m).reshape(TOKEN_GATES, INPUTS + 1, INPUTS) / FIXED
        pull, curve = s[:, 0] - RIDGE * (m.w - START), s[:, 1:]
        m.w = np.clip(m.w + np.linalg.solve(curve + RIDGE * np.eye(INPUTS), pull[..., None])[..., 0], -1.5, 2.5)
    seen = train_pass(lessons, "sym", "ctx", _bits_by_bucket, 2 * NODES * N_MAP, m).reshape(-1, 2)
    m.refine = refined(seen, NODES)
    return m


def refined(seen: np.ndarray, gates: int) -> np.ndarray:
    """Probability of a one in each bucket of the map."""
    centre = 1 / (1 + np.exp(-(np.arange(N_MAP) * 28 / (N_MAP - 1) - 14)))
    return (seen[:, 1] + 8 * np.tile(centre, gates)) / (seen.sum(axis=1) + 8)


def _before(at: np.ndarray) -> np.ndarray:
    """How often the same value stands earlier in the list."""
    wide = len(at).bit_length()
    if len(at) and int(at.max()) < 1 << 62 - wide:               # one sort of whole numbers is far faster
        order = np.sort(at << wide | np.arange(len(at))) & (1 << wide) - 1
    else:
        order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    out = np.empty(len(at), np.int64)
    out[order] = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    return out


def shares_of(w: Words, totals: np.ndarray):
    """Each word's share of the training tokens of its class, in all groups and in each."""
    listed = np.stack([getattr(w, c) for c in COUNTS])
    whole = w.n / np.maximum(totals.sum(axis=0), 1)[w.cls]
    return whole, np.where(totals[:, w.cls] > 0, (1 - BACKOFF) * listed / np.maximum(totals, 1)[:, w.cls] + BACKOFF * whole, whole)


def log_sum(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """log(exp(a) + exp(b)); numpy's own is several times slower."""
    top = np.maximum(np.maximum(a, b), -1e300)
    return top + np.log(np.exp(a - top) + np.exp(b - top))


def token_log10(m: TokenMixer, w: Words, totals: np.ndarray, pos: np.ndarray, at: np.ndarray, shares=None) -> np.ndarray:
    """log10 P of each token; ``totals`` are the training tokens by group and class, ``shares`` their ``shares_of``."""
    sym = w.cls[at]
    ctx = token_contexts(sym, w.hash[at], pos)
    whole, shares = shares or shares_of(w, totals)
    share = np.where(pos > 0, shares[ctx[4] >> 5, at], whole[at])
    known = np.log(np.maximum(share, 1e-300))
    known[sym == 0] = -np.inf
    spelled = w.spelled[at] * LN10
    for took, node, bit, slots in decisions(sym, ctx):
        order, _, _, z = m.mix(int(node[0]), slots)
        took, p = took.take(order), m.probability(z, int(node[0]))
        if node[0] == 0:
            known[took] += np.log(p)
            spelled[took] += np.log1p(-p)
        else:
            known[took] += np.log(p if bit[0] else 1 - p)
    text = np.cumsum(pos == 0)
    cache = np.where(pos > 0, CACHE, 0)
    share = cache * _before(text * len(w.n) + at) / np.maximum(pos, 1)
    with np.errstate(divide="ignore"):
        return log_sum(np.log1p(-cache) + log_sum(known, spelled), np.log(share)) / LN10


# -- Spark ------------------------------------------------------------------------------------
def _count(batches):
    """Words -> partial count tables, in parts that hold anything."""
    n, any_rows = np.zeros(2 * SLOTS, np.uint32), False          # of one task's distinct words
    for b in batches:
        any_rows = any_rows or b.num_rows > 0
        for _, raw, _, pos in streams(b.column(0).to_pylist()):
            for _, bit, slots in bits(raw, pos):
                for s in slots:
                    np.add.at(n, 2 * s + bit, ONE)
    if any_rows:
        pack = zstandard.ZstdCompressor(level=1)
        for part in range(0, -(-SLOTS // PART)):
            got = n[2 * PART * part:2 * PART * (part + 1)]
            if got.any():
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pack.compress(got.tobytes())])],
                                                 names=["part", "data"])
    del n
    release()


def _sum_counts(batches):
    """Partial tables -> quantised parts; all rows of a part come to one task."""
    total = {}
    for b in batches:
        for part, data in zip(*(c.to_pylist() for c in b.columns)):
            n = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint32).astype(np.int64)
            total[part] = total[part] + n if part in total else n
    for part, n in total.items():
        q = quantise(n.reshape(-1, 2))
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([(q[:, 0] << 8 | q[:, 1]).tobytes()])],
                                         names=["part", "data"])


def fit(types: DataFrame) -> Mixer:
    """Count tables, weights and map from the distinct training words ``types(word)``."""
    got = types.mapInArrow(_count, "part int, data binary").repartition("part") \
        .mapInArrow(_sum_counts, "part int, data binary").collect()      # 2 bytes a slot, SLOTS in all
    tables = np.zeros(SLOTS, np.uint16)
    for r in got:
        v = np.frombuffer(r.data, np.uint16)
        tables[r.part * PART:r.part * PART + len(v)] = v
    weights, seen = learned(types, tables)
    return Mixer(tables, weights, refined(seen, N_GATE))


def learned(types: DataFrame, tables: np.ndarray):
    """Weights (None without words), and bits by bucket of the map, of one pass over all of ``types(word)``:
    each shard's words are learned in the order of another hash, LESSON at once, whatever partition they lie in."""
    shared = types.sparkSession.sparkContext.broadcast(tables)
    empty = np.zeros(2 * N_GATE * N_MAP, np.int64)

    def learn(batches):
        shard, m, counts, n, waiting = None, None, None, 0, []

        def done():
            m.learn(waiting, counts)
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([n], pa.int64()), pa.array([m.w.tobytes()]),
                                               pa.array([counts.tobytes()])], names=["shard", "n", "w", "counts"])
        for b in batches:
            for s, word in zip(*(c.to_pylist() for c in b.columns)):
                if s != shard:
                    if shard is not None:
                        yield done()
                    shard, m, counts, n, waiting = s, Mixer(shared.value), empty.copy(), 0, []
                waiting.append(word)
                n += 1
                if len(waiting) == LESSON:
                    m.learn(waiting, counts)
                    waiting = []
        if shard is not None:
            yield done()

    dealt = types.select(F.pmod(F.xxhash64("word"), F.lit(SHARDS)).cast("int").alias("shard"), "word") \
        .repartition("shard").sortWithinPartitions("shard", F.xxhash64("word", F.lit(SHARDS)), "word")
    weights, seen, n = np.zeros(WEIGHTS), empty.copy(), 0
    for r in sorted(dealt.mapInArrow(learn, "shard int, n long, w binary, counts binary").collect(), key=lambda r: r.shard):
        weights += np.frombuffer(r.w) * r.n                          # SHARDS rows at most
        seen += np.frombuffer(r.counts, np.int64)
        n += r.n
    return weights / n if n else None, seen.reshape(-1, 2)


def _texts(kind, model, totals: np.ndarray, n_types: int, end: dict):
    """Blocks: documents as word positions, and the words' counts, classes, spelling and length -> scores."""
    def run(batches):
        m = model.value
        for row in (r for b in batches for i in range(b.num_rows) for r in b.slice(i, 1).to_pylist()):
            w = Words(pa.table(unpack_columns(ATTRIBUTES | {"rank": "<u4"}, row["words"])), end)
            base, shares = np.log10((w.n + 1) / (int(totals.sum()) + n_types + 1)), shares_of(w, totals)
            out = [[] for _ in range(6)]
            for ids, starts, pos, at in pieces(row, len(w.n) - 1, False):
                total = np.add.reduceat(token_log10(m, w, totals, pos, at, shares), starts)
                n = np.diff(np.append(starts, len(at)))
                size = np.add.reduceat(w.size[at], starts) + n
                for o, v in zip(out, (ids, n, np.add.reduceat((w.n[at] > 0).astype(np.int64), starts),
                                      np.add.reduceat(base[at], starts), total, -total * math.log2(10) / size)):
                    o.extend(v)
            kinds = (kind, pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
            names = ("id", "n_tokens", "n_known", "base_score", "score", "bits_per_byte")
            yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], names=names)
        release()
    return run


def _with_words(kind, end: dict):
    """One block's documents, and its words' attributes by bucket -> the documents with all attributes (``words``), and their
    training texts in pieces (``sym``, ``ctx``)."""
    def run(docs: pa.Table, given: pa.Table) -> pa.Table:
        row = docs.to_pylist()[0]
        places = words_by_bucket(unpack(row["counts"])[len(row["ids"]):])
        rank, parts = [np.zeros(0, np.int64)], []
        for q, data in zip(given.column("bucket").to_pylist(), given.column("data")):
            rank.append(places(q))
            parts.append(unpack_columns(ATTRIBUTES, data.as_py()))
        words = {n: np.concatenate([np.zeros(0, k), *(p[n] for p in parts)]) for n, k in ATTRIBUTES.items()}
        words["rank"] = np.concatenate(rank)
        w, out = Words(pa.table(words), end), [(row["ids"], row["sizes"], row["data"], row["counts"],
                                                pack_columns(ATTRIBUTES | {"rank": "<u4"}, words.values()), None, None)]
        seen = np.where(w.n > 1, w.cls, 0)
        for _, _, pos, at in pieces(row, len(w.n) - 1, True):
            sym = seen.take(at)
            out.append((None,) * 5 + lesson(sym, token_contexts(sym, w.hash.take(at), pos)))
        release()
        return pa.table([pa.array(c, pa.list_(kind) if i == 0 else pa.binary()) for i, c in enumerate(zip(*out))],
                        names=["ids", "sizes", "data", "counts", "words", "sym", "ctx"])
    return run


def class_of(n: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """1 to 16 for words of counts ``n`` by group: the group that a word is most frequent in, and its frequency in tens; 0
    without training counts."""
    every = n.sum(axis=0)
    level = np.clip(np.floor(np.log10(max(sums.sum(), 1) / np.maximum(every, 1))) - 2, 0, 3).astype(np.int64)
    return np.where(every > 0, (n / np.maximum(sums, 1)[:, None]).argmax(axis=0) * 4 + 1 + level, 0)


def summed(stats: DataFrame, each, width: int) -> np.ndarray:
    """The sum of ``each(counts by group)`` over the buckets of ``stats(counts)``."""
    def run(batches):
        for b in batches:
            for counts in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([squeeze(each(numbers(counts).reshape(GROUPS, -1)))], pa.binary())], names=["data"])
    return add_up(stats.select("counts").mapInArrow(run, "data binary"), width)


def _types(batches):
    """Words of training, one a row."""
    for b in batches:
        for data, counts in zip(*(c.to_pylist() for c in b.columns)):
            words = unpack_words(data)
            at = np.flatnonzero(numbers(counts).reshape(GROUPS, -1).any(axis=0)).tolist()
            for lo in range(0, len(at), 1 << 14):
                yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in at[lo:lo + (1 << 14)]], pa.binary())], names=["word"])


def _given(speller, sums: np.ndarray):
    """One bucket's vocabulary and its words' counts -> (block, bucket, attributes of the block's words)."""
    def run(vocab: pa.Table, stats: pa.Table) -> pa.Table:
        words, n = unpack_words(stats.column("data")[0].as_py()), numbers(stats.column("counts")[0].as_py()).reshape(GROUPS, -1)
        of = {"spelled": speller.value.spell(words), "hash": np.fromiter(map(zlib.crc32, words), np.uint32, len(words)),
              "size": np.fromiter(map(len, words), np.uint32, len(words)), "cls": class_of(n, sums).astype(np.uint8), **dict(zip(COUNTS, n))}
        del words
        blocks, out = [], []
        for block, data in zip(vocab.column("block").to_pylist(), vocab.column("data")):
            if block != DOCS:
                at = unpack(data.as_py())
                blocks.append(block)
                out.append(pack_columns(ATTRIBUTES, [of[c].take(at) for c in ATTRIBUTES]))
        release()
        return pa.table({"block": pa.array(blocks, pa.int64()), "bucket": pa.array([stats.column("bucket")[0].as_py()] * len(out), pa.int32()),
                         "data": pa.array(out, pa.binary())})
    return run


def score(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte); ``train`` says which rows
    teach the model."""
    spark = docs.sparkSession
    ship_package(spark)
    size = docs.agg(F.count(F.when(train, 1)).alias("train"), F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0)).alias("bytes")).first()
    n_end = size.train
    blocks = word_blocks(docs, id_col, text_col, train, buckets=max(BUCKETS, size.bytes >> 27))
    vocab = vocabulary(blocks)
    group = spark.sparkContext.broadcast(grouping_of(blocks, vocab))
    tallies = blocks.groupBy("block").applyInArrow(_tallies(group), "block long, bucket int, counts binary")
    stats = by_block(vocab.groupBy("bucket").cogroup(tallies.groupBy("bucket"))
                     .applyInArrow(_word_counts, "bucket int, data binary, counts binary"), "bucket")
    total = summed(stats, lambda n: np.append(n.sum(axis=1), n.any(axis=0).sum()), GROUPS + 1)
    sums, n_types = total[:-1], int(total[-1])

    def by_class(n):
        out = np.zeros((17, GROUPS), np.int64)
        np.add.at(out, class_of(n, sums), n.T)
        return out

    totals = summed(stats, by_class, 17 * GROUPS).reshape(17, GROUPS).T.copy()
    speller = fit(stats.select("data", "counts").mapInArrow(_types, "word binary"))
    shared = spark.sparkContext.broadcast(speller)
    end = {"cls": 1 if n_end else 0, "hash": 0, "spelled": float(speller.spell([b""])[0]), "size": 0}
    every = int(sums.sum())
    ends = [n_end * int(s) // max(every, 1) for s in sums]         # they follow the groups' sizes in words
    ends[0] += n_end - sum(ends)
    end |= zip(COUNTS, ends)
    totals[:, end["cls"]] += ends
    given = vocab.groupBy("bucket").cogroup(stats.groupBy("bucket")) \
        .applyInArrow(_given(shared, sums), "block long, bucket int, data binary")
    kind = docs.schema[id_col].dataType
    texts = blocks.filter(F.col("bucket") == DOCS).select("block", "ids", "sizes", "data", "counts")
    made = staged(texts.groupBy("block").cogroup(given.groupBy("block")).applyInArrow(
        _with_words(to_arrow_type(kind), end), f"ids array<{kind.simpleString()}>, sizes binary, data binary, counts binary, "
                                               "words binary, sym binary, ctx binary"), "tokens")
    model = spark.sparkContext.broadcast(fit_tokens(made.filter("sym IS NOT NULL")))
    out = made.filter("ids IS NOT NULL").select("ids", "sizes", "data", "counts", "words").mapInArrow(
        _texts(to_arrow_type(kind), model, totals, n_types + (n_end > 0), end),
        f"id {kind.simpleString()}, n_tokens long, n_known long, base_score double, score double, bits_per_byte double")
    return out.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(int(totals.sum())).cast("long").alias("train_tokens"),
                      "base_score", "score", "bits_per_byte")


def op3_lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held = crc_mod(F.col("doc_id"), FOLD) == HELD
    return score(docs, ~held).withColumn("held_out", held)


QUERIES = {"op3_lm": op3_lm}
ORACLES: dict[str, str] = {}
