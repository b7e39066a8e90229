"""Texts as blocks of documents over a block-local word list.

A block is about ``block_bytes`` of consecutive text of one scan task. It holds a word list (each
word once, the most frequent first) and, for each document, the positions of its words in
the list. A corpus-wide join on words then moves a row per block and distinct word, not one per
word of every text. Blocks are staged as a table, so their numbers never change on a retry.

The table is bucketed by block, so what comes back to a block is shuffled to where the block already
lies and the texts' positions never cross a shuffle. Rows: one for the block's documents (``bucket`` -1,
``ids``, ``sizes`` in words, ``data`` = word positions of all, ``counts`` = vocabulary bucket of each word, after a mark
for each document that says whether its words are counted, if ``train`` was given), and
for each bucket of the vocabulary one of the block's words in it (``data`` = compressed words, ``counts`` =
training counts, if ``train`` was given).
"""

from __future__ import annotations

import itertools
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import ensure_checkpoint_dir, release, ship_package

BLOCK_BYTES = 8 << 20
DOCS = -1


def pack(a: np.ndarray) -> bytes:
    """Whole numbers below 2**32, byte planes apart, compressed."""
    planes = np.ascontiguousarray(a, "<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(4, -1).T).view("<u4").reshape(-1)


def pack_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b" ".join(words))


def unpack_words(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b" ")


def words_of(text: bytes, special: bytes | None = None) -> list[bytes]:
    """Words between ASCII white space with A-Z in lower case; a word that holds ``special`` keeps
    its case."""
    if special and special in text:
        return [w if special in w else w.lower() for w in text.split()]
    return text.lower().split()


def split_words(texts: list[bytes], special: bytes | None = None) -> tuple[np.ndarray, pa.Array]:
    """How many words each text has, and the words of all, as ``words_of`` gives them."""
    if special and any(special in t for t in texts):
        lists = [words_of(t, special) for t in texts]
        return np.array([len(w) for w in lists]), pa.array(itertools.chain.from_iterable(lists), pa.binary())
    raw = pa.array(texts, pa.binary())
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.Array.from_buffers(pa.string(), len(raw), raw.buffers())))
    words = lists.flatten()
    full = pc.binary_length(words).to_numpy() > 0               # white space at a text's ends leaves empty ones
    before = np.append(0, np.cumsum(full))
    return np.diff(before[lists.offsets.to_numpy()]), words.filter(pa.array(full)).cast(pa.binary())


class _Block:
    def __init__(self, number: int, counted: bool, special: bytes | None):
        self.number, self.counted, self.special, self.size = number, counted, special, 0
        self.docs: list[tuple] = []

    def add(self, doc_id, text: bytes, train: bool) -> None:
        """``train`` says whether the document's words are counted."""
        self.docs.append((doc_id, text, train))
        self.size += len(text)

    def rows(self, buckets: int):
        """(block, bucket, ids, sizes, data, counts)"""
        sizes, words = split_words([t for _, t, _ in self.docs], self.special)
        words = words.dictionary_encode()                       # numbered as they come
        flat, listed = words.indices.to_numpy(), words.dictionary.to_pylist()
        n, train = len(listed), np.array([bool(t) for _, _, t in self.docs])
        del words
        order = np.argsort(-np.bincount(flat, minlength=n), kind="stable")
        rank = np.empty(n, np.uint32)
        rank[order] = np.arange(n, dtype=np.uint32)
        counts = np.bincount(flat[np.repeat(train, sizes)], minlength=n)[order]
        listed = list(map(listed.__getitem__, order.tolist()))
        bucket = np.fromiter(map(zlib.crc32, listed), np.uint32, n) % np.uint32(buckets)
        marks = train.astype(np.uint32) if self.counted else bucket[:0]
        yield self.number, DOCS, [d for d, _, _ in self.docs], pack(sizes), pack(rank[flat]), pack(np.concatenate([marks, bucket]))
        by = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[by])) + 1
        for part in np.split(by, cuts) if n else []:
            yield (self.number, int(bucket[part[0]]), None, None, pack_words(list(map(listed.__getitem__, part.tolist()))),
                   pack(counts[part]) if self.counted else None)


def documents_of(ids: list, sizes: bytes, data: bytes):
    """(id, word positions) of each document of a block's row."""
    ends = np.cumsum(unpack(sizes), dtype=np.int64)
    yield from zip(ids, np.split(unpack(data), ends[:-1]))


def word_blocks(docs: DataFrame, id_col: str, text_col: str, train: Column | None = None, buckets: int = 1,
                special: bytes | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The staged block table of every whole text (null as empty). ``train`` marks the rows whose words
    are counted."""
    spark = docs.sparkSession
    ship_package(spark)
    counted = train is not None

    def emit(block):
        rows = list(zip(*block.rows(buckets)))
        kinds = (pa.int64(), pa.int32(), pa.list_(id_type), pa.binary(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)],
                                          names=["block", "bucket", "ids", "sizes", "data", "counts"])

    def run(batches):
        base = TaskContext.get().partitionId() << 32
        block = None
        for b in batches:
            for doc_id, text, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                block = block or _Block(base, counted, special)
                block.add(doc_id, text, t)
                if block.size >= block_bytes:
                    yield emit(block)
                    base += 1
                    block = None
        if block:
            yield emit(block)
        del block
        release()

    kind = docs.schema[id_col].dataType
    id_type = to_arrow_type(kind)
    src = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary"),
                      F.lit(False) if train is None else train)
    rows = src.mapInArrow(run, f"block long, bucket int, ids array<{kind.simpleString()}>, sizes binary, data binary, "
                               "counts binary")
    return by_block(rows)


def by_block(rows: DataFrame, key: str = "block") -> DataFrame:
    """``rows(block, ...)`` as a staged table bucketed by block (or another key)."""
    spark = rows.sparkSession
    name = f"llm_blocks_{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").option("path", f"{ensure_checkpoint_dir(spark)}/{name}") \
        .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).format("parquet").saveAsTable(name)
    return spark.table(name)
