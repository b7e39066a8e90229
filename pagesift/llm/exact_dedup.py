"""Exact dedup by progressive refinement (built-in functions only).

Texts are equal when identical after white-space runs are replaced by one space (null counts
as empty). Rows are grouped by the normalised length, the survivors by a hash of a prefix, and
only what still has company is grouped by SHA-256 of the whole text. The first two rounds work
on three narrow numbers per row; the last joins texts to the survivors' ids, and where those are too many to
broadcast every text crosses that join's shuffle once. All groupings are
hash aggregates with map-side combine, staged before they are joined back: each join has one row
per key on one side and a shuffle of its own on the other, which adaptive execution splits (or
makes a broadcast of the small side), so a group that holds a third of all rows isn't gathered.

Defined results: null text equals empty text; rows repeated with the same id and text are one
document (``group_size`` counts each row); a null id never wins against an id, and alone is
kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import normalised, staged, table

PREFIX_CHARS = 128


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per group of two or more equal rows: text_sha256, keep_id, group_size."""
    src = docs.select(F.col(id_col).alias("_id"), normalised(F.col(text_col)).alias("_t"))
    keys = staged(src.select("_id", F.octet_length("_t").alias("_n"),
                             F.xxhash64(F.substring("_t", 1, prefix_chars)).alias("_p")), "dedup-keys")
    lengths = staged(keys.groupBy("_n").agg(F.count("*").alias("_c")).filter("_c > 1").select("_n"), "dedup-lengths")
    same_length = keys.join(lengths, "_n", "left_semi")
    prefixes = staged(same_length.groupBy("_n", "_p").agg(F.count("*").alias("_c")).filter("_c > 1").select("_n", "_p"),
                      "dedup-prefixes")
    ids = same_length.join(prefixes, ["_n", "_p"], "left_semi").select(F.col("_id").alias("_s"))
    full = (src.join(ids, src["_id"].eqNullSafe(ids["_s"]), "left_semi")
            .select("_id", F.sha2("_t", 256).alias("text_sha256")))
    return staged(full.groupBy("text_sha256").agg(F.min("_id").alias("keep_id"), F.count("*").alias("group_size"))
                  .filter("group_size > 1"), "dedup-groups")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Every document with its group: id, keep_id, group_size, kept, text_sha256."""
    groups = duplicate_groups(docs, id_col, text_col, prefix_chars)
    digests = docs.select(F.col(id_col), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256")) \
        .groupBy(id_col, "text_sha256").agg(F.lit(1).alias("_one")).drop("_one")
    return (digests.join(groups, "text_sha256", "left")
            .select(id_col,
                    F.when(F.col("group_size").isNull(), F.col(id_col)).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    "text_sha256")
            .withColumn("kept", F.col(id_col).eqNullSafe(F.col("keep_id"))))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Texts are only moved for ids that occur
    more than once; the other rows are held against the staged ids of those that go."""
    gone = staged(exact_dedup(docs, id_col, text_col).filter("NOT kept")
                  .select(F.col(id_col).alias("_d"), F.col("text_sha256").alias("_h")), "dedup-gone")
    repeated = staged(docs.groupBy(F.col(id_col).alias("_r")).agg(F.count("*").alias("_c")).filter("_c > 1").select("_r"),
                      "dedup-repeated")
    ids = staged(gone.select(F.col("_d").alias("_i")).union(repeated).distinct(), "dedup-ids")
    once = docs.join(ids, docs[id_col].eqNullSafe(ids["_i"]), "left_anti")
    sha = F.sha2(normalised(F.col(text_col)), 256)
    again = docs.join(repeated, docs[id_col].eqNullSafe(repeated["_r"]), "left_semi").withColumn("_sha", sha)
    again = again.join(gone, again[id_col].eqNullSafe(gone["_d"]) & (again["_sha"] == gone["_h"]), "left_anti")
    return once.unionByName(again.dropDuplicates([id_col, "_sha"]).drop("_sha"))


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


QUERIES = {"op1_exact_dedup": op1_exact_dedup}
ORACLES = {"op1_exact_dedup": r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT DISTINCT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)"""}
