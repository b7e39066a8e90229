"""Merkle manifest of a dataset: a digest tree for each source, a tree over their roots, a proof per row.

A row's leaf is the SHA-256 of its columns with their lengths. The leaves of a source, in the order of their ids, are cut
into aligned blocks of 256. A block keeps each of its levels as one hex string (64 characters a node): parents are the
digests of fixed-width substrings (16 nodes), and a node's siblings are the substrings left and right of it in its
run. The roots of a source's blocks are the nodes of the next round, until one is left; the sources' roots, in the
order of their names, go through the same rounds. Proofs come back down: each block gets the
sibling segments above it once, its rows add their own.

Positions come from one sort: leaves are staged sorted by (source, id), each row with its partition and row number there,
and a source's rows before a partition are a running sum over partitions, so a source with a third of all rows is spread
like the rest. A task holds blocks of 256 nodes, whatever the sizes of sources and texts.

Defined results: null columns are written as ``-``; rows without a source are a source of their own, before the others;
null ids come first in their source; rows of the same id are ordered by their leaf, repeated rows are leaves of
their own; empty texts are ordinary values; an empty table gives an empty result; columns that aren't named are no part of a leaf.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, staged, table

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
WIDTH = 16
ROUND = 2                       # levels of a block
SPAN = WIDTH ** ROUND
HEX = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf(columns: list[Column]) -> Column:
    """SHA-256 of the columns as text, each with its length in bytes before it; null as ``-``."""
    texts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]), 256)


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _parents(level: Column) -> Column:
    """Digests of the runs of a level, as one string."""
    runs = F.sequence(F.lit(0), F.ceil(F.octet_length(level) / (WIDTH * HEX)).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda j: F.sha2(
        F.substring(level, j * (WIDTH * HEX) + 1, F.lit(WIDTH * HEX)), 256)), "").cast("binary")


def _levels(lowest: Column, above: int = ROUND) -> Column:
    """The block's levels as an array of strings, the lowest first."""
    def up(found):
        if len(found) > above:
            return F.array(*found)
        return _let(_parents(found[-1]), lambda level: up([*found, level]))
    return _let(lowest, lambda level: up([level]))


def _siblings(levels: Column, i: Column) -> list[Column]:
    """(l, r) of each level of a block for its node ``i``: the nodes of the run before and after."""
    out = []
    for k in range(ROUND):
        at = F.floor(i / WIDTH ** k).cast("int")
        inside = at % WIDTH
        out.append(F.struct(F.substring(levels[k], (at - inside) * HEX + 1, inside * HEX).alias("l"),
                            F.substring(levels[k], at * HEX + HEX + 1, (WIDTH - 1 - inside) * HEX).alias("r")))
    return out


def _depth(n: Column) -> Column:
    """Levels that a block of a tree of ``n`` nodes adds: all, but where the tree ends in it."""
    d = F.lit(0)
    for k in range(ROUND):
        d = F.when(n > WIDTH ** k, k + 1).otherwise(d)
    return d


def numbered(rows: DataFrame, tree: str, order: list[Column]) -> DataFrame:
    """``rows`` with ``pos``, the row's place among those of its tree, and ``n``, their number. Equal rows are told
    apart by where they lie, so that many of them don't meet in one range."""
    by = [F.asc_nulls_first(tree), *order]
    laid = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by, "_tie").sortWithinPartitions(*by) \
        .drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    laid = staged(laid, "merkle-sorted").withColumn("_part", F.shiftright("_at", 33))
    parts = laid.groupBy(F.col(tree).alias("_tree"), F.col("_part").alias("_p")).agg(F.min("_at").alias("_first"), F.count("*").alias("_c"))
    one = Window.partitionBy("_tree")
    parts = staged(parts.withColumn("_before", F.sum("_c").over(one.orderBy("_p")) - F.col("_c"))
                   .withColumn("n", F.sum("_c").over(one)), "merkle-parts")
    return laid.join(parts, laid[tree].eqNullSafe(parts["_tree"]) & (laid["_part"] == parts["_p"])) \
        .withColumn("pos", F.col("_at") - F.col("_first") + F.col("_before")).drop("_at", "_part", "_tree", "_p", "_first", "_before", "_c")


def _blocks(nodes: DataFrame, tree: str) -> DataFrame:
    """(tree, pos, n, hash, item) -> (tree, block, n, levels, top, items)."""
    got = nodes.groupBy(tree, F.expr(f"pos div {SPAN}").alias("block"), "n") \
        .agg(F.array_sort(F.collect_list(F.struct("pos", "hash", "item"))).alias("_nodes"))
    text = F.array_join(F.transform("_nodes", lambda x: x["hash"]), "").cast("binary")
    got = got.select(tree, "block", "n", _levels(text).alias("levels"), F.transform("_nodes", lambda x: x["item"]).alias("items"))
    return staged(got, "merkle-blocks").withColumn("top", F.element_at("levels", _depth(F.col("n")) + 1).cast("string"))


def rounds(nodes: DataFrame, tree: str) -> list[DataFrame]:
    """The blocks of every round, the leaves' first; each round has a 256th of the nodes before."""
    out = [_blocks(nodes, tree)]
    most = out[0].agg(F.max("n")).first()[0] or 0
    while most > SPAN:
        most = -(-most // SPAN)
        up = out[-1].filter(F.col("n") > SPAN).select(tree, F.col("block").alias("pos"), F.expr(f"cast(ceil(n / {SPAN}) AS long)").alias("n"),
                                                      F.col("top").alias("hash"), F.lit(0).alias("item"))
        out.append(_blocks(up, tree))
    return out


def tops(found: list[DataFrame], tree: str) -> DataFrame:
    """(tree, root) of every tree."""
    out = None
    for blocks in found:
        got = blocks.filter(F.col("n") <= SPAN).select(tree, F.col("top").alias("root"))
        out = got if out is None else out.union(got)
    return out


def descend(found: list[DataFrame], tree: str, above: DataFrame) -> DataFrame:
    """``above`` (tree, path, more columns): what lies over each tree's root -> the leaves' blocks with
    ``path``, the segments of siblings over the block, and those columns."""
    more = [c for c in above.columns if c not in (tree, "path")]
    over, below = above.withColumnRenamed(tree, "_tree"), None
    for blocks in reversed(found):
        ended = blocks.filter(F.col("n") <= SPAN)
        got = ended.join(over, ended[tree].eqNullSafe(over["_tree"])).drop("_tree")
        if below is not None:
            rest = blocks.filter(F.col("n") > SPAN)
            got = got.unionByName(rest.join(below, rest[tree].eqNullSafe(below["_tree"]) & (rest["block"] == below["_pos"])).drop("_tree", "_pos"))
        last = got
        if blocks is not found[0]:
            each = F.transform(F.col("items"), lambda _, i: F.concat(
                F.slice(F.array(*_siblings(F.col("levels"), i)), F.lit(1), _depth(F.col("n"))), F.col("path")))
            below = staged(got.select(F.col(tree).alias("_tree"), "block", *more, F.posexplode(each).alias("_i", "path"))
                           .select("_tree", (F.col("block") * SPAN + F.col("_i")).alias("_pos"), "path", *more), "merkle-paths")
    return last


def _fold(start: Column, path: Column) -> Column:
    return F.aggregate(path, start, lambda node, s: F.sha2(F.concat(s["l"], node.cast("binary"), s["r"]), 256))


def _text(path: Column) -> Column:
    return F.aggregate(path, F.lit("").cast("binary"), lambda got, s: F.concat(got, s["l"], s["r"]))


def leaves(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", columns=COLUMNS,
           altered: dict[str, Column] | None = None) -> DataFrame:
    """(id, source, hash, other): each row's leaf, and the leaf it has with the ``altered`` columns where that differs."""
    plain = leaf([F.col(c) for c in columns])
    other = leaf([(altered or {}).get(c, F.col(c)) for c in columns])
    got = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), plain.alias("hash"),
                      (other if altered else plain).alias("other"))
    return got.withColumn("other", F.when(F.col("other") != F.col("hash"), F.col("other")))


def manifest(leaf_rows: DataFrame) -> tuple[list[DataFrame], list[DataFrame], str | None]:
    """The rounds of the sources' trees, those of the tree over their roots, and the root (None for an empty table)."""
    nodes = numbered(staged(leaf_rows, "merkle-leaves"), "source", [F.asc_nulls_first("id"), F.asc("hash")])
    own = rounds(nodes.select("source", "pos", "n", "hash", F.struct("id", "other").alias("item")), "source")
    subroots = tops(own, "source").select(F.lit(0).alias("all"), "source", F.col("root").alias("hash"))
    upper = rounds(numbered(subroots, "all", [F.asc_nulls_first("source")])
                   .select("all", "pos", "n", "hash", F.struct("source", F.col("hash").alias("subroot")).alias("item")), "all")
    root = tops(upper, "all").first()
    return own, upper, root["root"] if root else None


def proofs(leaf_rows: DataFrame) -> DataFrame:
    """Every leaf with its subroot, the root, its proof (the siblings' digests from the leaf to the root, as one text, and
    their SHA-256) and ``folded_root``, the root that the row's other leaf (or its own) gives with that proof."""
    own, upper, root = manifest(leaf_rows)
    all_ = descend(upper, "all", upper[0].sparkSession.createDataFrame([(0, [])], "all int, path array<struct<l:binary,r:binary>>"))
    each = F.transform(F.col("items"), lambda x, i: F.struct(
        x["source"].alias("source"), x["subroot"].alias("subroot"),
        F.concat(F.slice(F.array(*_siblings(F.col("levels"), i)), F.lit(1), _depth(F.col("n"))), F.col("path")).alias("path")))
    over = staged(all_.select(F.explode(each).alias("x")).select("x.source", "x.subroot", "x.path"), "merkle-over")
    blocks = descend(own, "source", over)

    def row(x, i, levels, above):
        inside = F.slice(F.array(*_siblings(levels, i)), F.lit(1), _depth(F.col("n")))
        hash_ = F.substring(levels[0], i * HEX + 1, F.lit(HEX)).cast("string")
        return F.struct(x["id"].alias("id"), hash_.alias("leaf"), F.concat(_text(inside), above).alias("proof"),
                        _fold(F.coalesce(x["other"], hash_), F.concat(inside, F.col("path"))).alias("folded_root"))

    rows = _let(_text(F.col("path")), lambda above: F.transform(
        F.col("items"), lambda x, i: row(x, i, F.col("levels"), above)))
    return blocks.select("source", "subroot", F.explode(rows).alias("x")).select(
        F.col("x.id").alias("id"), "source", "x.leaf", "subroot", F.lit(root).alias("root"), F.col("x.proof").cast("string").alias("proof"),
        F.sha2("x.proof", 256).alias("proof_sha256"), "x.folded_root", (F.col("x.folded_root") == F.lit(root)).alias("verified"))


def op13_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = F.when(crc_mod(F.col("doc_id"), 5) == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return proofs(leaves(docs, altered={"text": text})).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {"op13_merkle": op13_merkle}

CRC_TABLE = """tab AS (SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(n)))"""


def crc_sql(codes: str) -> str:
    """DuckDB: CRC-32 of a list of byte values, with ``tab`` of CRC_TABLE in scope as ``t``."""
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), "
            "lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295::BIGINT)")


def _climb(name: str, tree: str, start: str) -> str:
    return f"""
{name} AS (SELECT {tree}, 0 AS lvl, pos, hash, n FROM {start}
  UNION ALL SELECT {tree}, lvl + 1, pos // 16, sha256(string_agg(hash, '' ORDER BY pos)), (n + 15) // 16
  FROM {name} WHERE n > 1 GROUP BY {tree}, lvl, pos // 16, n),
{name}_s AS (SELECT {tree}, lvl, pos, n,
    coalesce(string_agg(hash, '') OVER (PARTITION BY {tree}, lvl, pos // 16 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(hash, '') OVER (PARTITION BY {tree}, lvl, pos // 16 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name})"""


_FIELDS = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in COLUMNS)
_BYTES = "list_transform(range(1, 1 + length(coalesce(doc_id::VARCHAR, ''))), lambda i: ascii(coalesce(doc_id::VARCHAR, '')[i])::BIGINT)"
ORACLES = {"op13_merkle": f"""
WITH RECURSIVE {CRC_TABLE},
f AS (SELECT doc_id, source, sha256({_FIELDS}) AS hash, sha256({_FIELDS.replace("text::VARCHAR", "low")}) AS low_hash,
        {crc_sql(_BYTES)} % 5 = 0 AS hit
      FROM (SELECT *, translate(text, '{UPPER}', '{LOWER}') AS low FROM documents), tab),
leaf AS (SELECT *, CASE WHEN hit THEN low_hash ELSE hash END AS other, count(*) OVER (PARTITION BY source) AS n,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, hash) - 1 AS pos FROM f),{_climb("own", "source", "leaf")},
sub AS (SELECT 0 AS one, source, hash, count(*) OVER () AS n, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM own WHERE n = 1),
{_climb("top", "one", "sub")},
steps AS (SELECT leaf.source, leaf.pos, s.lvl, s.l, s.r FROM leaf JOIN own_s s ON leaf.source IS NOT DISTINCT FROM s.source
        AND s.n > 1 AND s.pos = leaf.pos // (16 ** s.lvl)::BIGINT
  UNION ALL SELECT leaf.source, leaf.pos, 100 + s.lvl, s.l, s.r FROM leaf JOIN sub ON leaf.source IS NOT DISTINCT FROM sub.source
        JOIN top_s s ON s.n > 1 AND s.pos = sub.pos // (16 ** s.lvl)::BIGINT),
path AS (SELECT source, pos, string_agg(l || r, '' ORDER BY lvl) AS proof, list(l || '|' || r ORDER BY lvl) AS seg FROM steps GROUP BY 1, 2),
res AS (SELECT doc_id, leaf.hash AS leaf, sub.hash AS subroot, (SELECT hash FROM top WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend(other, coalesce(seg, []::VARCHAR[])), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
  FROM leaf JOIN sub ON leaf.source IS NOT DISTINCT FROM sub.source
  LEFT JOIN path ON path.source IS NOT DISTINCT FROM leaf.source AND path.pos = leaf.pos)
SELECT *, folded_root = root AS verified FROM res"""}
