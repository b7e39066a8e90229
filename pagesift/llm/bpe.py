"""BPE encoding and decoding through a table of distinct words.

Texts are split at ASCII white space, where the tokenizer's own splitting always cuts. Each distinct
word is encoded once, in the task that owns its bucket of the vocabulary; its ids go back to the
blocks that hold it and are put in the place of every occurrence. Decoding joins ids to the
piece table (as many rows as the vocabulary file has ids, whatever the corpus), which is broadcast.

Only tokenizers whose tokens never cross ASCII white space and that decode to space-joined pieces
qualify (``check_tokenizer`` raises otherwise). Each text's ids and decoded text are real columns.

Defined results: null text is empty, with no ids and empty decoded text; repeated rows and null ids
are returned as often as they occur; special tokens written in a text are encoded as the
tokenizers library does; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import release, ship_package, table
from .wordblocks import DOCS, documents_of, pack, unpack, unpack_words, word_blocks

TOKENIZER = "word_bpe_49k.json"
SPECIAL = b"<|"
BATCH = 4096         # words handed to the tokenizer at once


def tokenizer_json(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        return f.read()


def check_tokenizer(spec: dict) -> None:
    norm = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    if spec.get("decoder") or spec.get("post_processor") or norm != ["NFC", "Replace", "Lowercase"]:
        raise ValueError("only lower-casing word tokenizers that drop white space and have no decoder")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or SPECIAL.decode() not in t["content"]
           for t in spec["added_tokens"]):
        raise ValueError("added tokens must be plain and start with " + SPECIAL.decode())


def _encoder(blob: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(blob)
    t.no_truncation()
    t.no_padding()
    return t


def _encode_words(shared):
    """Rows of (bucket, block, words) -> (block, bucket, lens, ids); a word met again in the task
    is looked up, and all rows of a bucket come to one task."""
    def run(batches):
        tok, known = _encoder(shared.value), {}
        for b in batches:
            for block, bucket, data in zip(*(c.to_pylist() for c in b.columns)):
                words = unpack_words(data)
                new = [w for w in words if w not in known]
                for lo in range(0, len(new), BATCH):
                    part = new[lo:lo + BATCH]
                    got = tok.encode_batch([w.decode("utf-8", "replace") for w in part], add_special_tokens=False)
                    for w, e in zip(part, got):
                        known[w] = np.array(e.ids, "<u4").tobytes()
                ids = [known[w] for w in words]
                out = pack(np.concatenate([np.fromiter(map(len, ids), "<u4", len(ids)), np.frombuffer(b"".join(ids), "<u4")]))
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([bucket], pa.int32()),
                                                  pa.array([out], pa.binary())], names=["block", "bucket", "ids"])
        known.clear()
        release()
    return run


def piece_table(spec: dict) -> list[bytes]:
    """Piece of each id, by id; ids that have none are empty."""
    pieces = dict(spec["model"]["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
    out = [b""] * (max(pieces.values()) + 1)
    for p, i in pieces.items():
        out[i] = p.encode()
    return out


def _put_back(pieces, kind: pa.DataType):
    """One block: its documents and its words' ids -> ids and decoded text of every document."""
    def run(docs: pa.Table, ids: pa.Table) -> pa.Table:
        piece = pieces.value
        row = docs.to_pylist()[0]
        bucket = unpack(row["counts"])
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(bucket.max() + 2 if len(bucket) else 1))
        word_ids = [b""] * len(bucket)
        for q, data in zip(ids.column("bucket").to_pylist(), ids.column("ids").to_pylist()):
            words = order[cuts[q]:cuts[q + 1]].tolist()
            got = unpack(data)
            raw = got[len(words):].tobytes()
            ends = np.cumsum(got[:len(words)], dtype=np.int64).tolist()
            for i, s, e in zip(words, [0, *ends[:-1]], ends):
                word_ids[i] = raw[s:e]
        text = [b" ".join([piece[i] for i in np.frombuffer(w, "<u4").tolist()]) for w in word_ids]
        empty = any(not w for w in word_ids)
        out_id, out_ids, out_text = [], [], []
        for d, at in documents_of(row["ids"], row["sizes"], row["data"]):
            at = at.tolist()
            if empty:
                at = [p for p in at if word_ids[p]]
            out_id.append(d)
            out_ids.append(b"".join(map(word_ids.__getitem__, at)))
            out_text.append(b" ".join(map(text.__getitem__, at)))
        out = pa.table({"id": pa.array(out_id, kind), "ids": pa.array(out_ids, pa.binary()),
                        "decoded": pa.array(out_text, pa.binary())})
        del out_ids, out_text, text, word_ids
        release()
        return out
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
           buckets: int | None = None, block_bytes: int | None = None) -> DataFrame:
    """(id, ids, decoded): ids as little-endian unsigned 32-bit numbers, decoded as text. The
    vocabulary has as many buckets as there are shuffle partitions by default."""
    spark = docs.sparkSession
    ship_package(spark)
    blob = tokenizer_json(tokenizer)
    spec = json.loads(blob)
    check_tokenizer(spec)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kw = {"block_bytes": block_bytes} if block_bytes else {}
    blocks = word_blocks(docs, id_col, text_col, buckets=buckets or parts, special=SPECIAL, **kw)
    vocab, pieces = spark.sparkContext.broadcast(blob), spark.sparkContext.broadcast(piece_table(spec))
    words = blocks.filter(F.col("bucket") >= 0).select("block", "bucket", "data").repartition("bucket") \
        .mapInArrow(_encode_words(vocab), "block long, bucket int, ids binary")
    kind = docs.schema[id_col].dataType
    own = blocks.filter(F.col("bucket") == DOCS).select("block", "ids", "sizes", "data", "counts")
    out = own.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(
        _put_back(pieces, to_arrow_type(kind)), f"id {kind.simpleString()}, ids binary, decoded binary")
    return out.select(F.col("id").alias(id_col), "ids", F.col("decoded").cast("string").alias("decoded"))


def decode(seqs: DataFrame, id_col: str, ids_col: str, tokenizer: str | None = None) -> DataFrame:
    """Any table of id arrays -> (id, decoded), by a join with the piece table."""
    spark = seqs.sparkSession
    spec = json.loads(tokenizer_json(tokenizer))
    pieces = spark.createDataFrame([(i, p.decode()) for i, p in enumerate(piece_table(spec))], "token int, piece string")
    flat = seqs.select(F.col(id_col).alias("_d"), F.posexplode_outer(ids_col).alias("_p", "token"))
    return (flat.join(F.broadcast(pieces), "token", "left").groupBy("_d")
            .agg(F.array_sort(F.collect_list(F.when(F.col("_p").isNotNull(), F.struct("_p", "piece")))).alias("_a"))
            .select(F.col("_d").alias(id_col), F.concat_ws(" ", F.col("_a.piece")).alias("decoded")))


def op9_bpe(spark, sf_dir):
    return with_digests(encode(table(spark, sf_dir, "documents")))


def with_digests(encoded: DataFrame) -> DataFrame:
    keep = [c for c in encoded.columns if c not in ("ids", "decoded")]
    return encoded.select(*keep, F.expr("cast(octet_length(ids) div 4 AS long)").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op9_bpe": op9_bpe}
ORACLES: dict[str, str] = {}
