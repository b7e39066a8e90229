"""The training-corpus pipeline: language ID, exact dedup, SimHash near-dedup, mixing, BPE.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; every result is
written as Parquet in the shared checkpoint folder and read back as the next stage's ``docs``. All
but the last return the columns of ``documents``; the last returns doc_id, n_tokens, ids (the
little-endian 32-bit token ids) and the digests of ids and decoded text. Nulls, empty texts, repeated
rows and empty tables are handled as the operators' docstrings define.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from pagesift.llm import bpe, exact_dedup, langid, mixing, simhash
from pagesift.llm.common import staged, table


def identify_language(spark, docs, sf_dir):
    """Every document gets its predicted language; those without one (null text or no letter) go."""
    return langid.keep_identified(docs)


def drop_exact_copies(spark, docs, sf_dir):
    """Of equal texts the row with the smallest doc_id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Of each group of linked fingerprints the row with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def mix_sources(spark, docs, sf_dir):
    """80 per cent of the tokens, shared by the production weights, at most one epoch."""
    return mixing.take(docs, max_epochs=1)


def encode_tokens(spark, docs, sf_dir):
    """Token ids of every document that is left, and the digests of ids and decoded text."""
    out = bpe.encode(docs)
    return out.select("doc_id", F.expr("cast(octet_length(ids) div 4 AS long)").alias("n_tokens"), "ids",
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("language_id", identify_language), ("exact_dedup", drop_exact_copies),
          ("simhash_near_dedup", drop_near_copies), ("source_mixing", mix_sources), ("bpe", encode_tokens)]

ORACLE_SQL = None       # fitted language weights and BPE merges have no SQL form


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
