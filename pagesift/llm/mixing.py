"""Mixing sources to target weights by hierarchical budgeting (built-in functions only).

Documents hang in a tree of domain, language and source. The root's token budget goes down level
by level: children share their parent's budget by weight, a child that can't use its share
(its supply times ``max_epochs``) is filled, and what it leaves goes to its siblings by weight;
only what no sibling can take goes up, as a smaller claim of the parent. Each leaf then takes
whole epochs and, of the next epoch, the longest prefix of documents, in an order seeded by
(seed, epoch, id), whose tokens fit.

Prefix sums are taken in two steps, over 4096 hash buckets of a leaf and then inside the one
bucket where the budget ends, so no leaf is sorted in one task. All tokens and budgets are whole
numbers, computed exactly.

Defined results: null text has no tokens; a null level is the node ``(none)``; a weight not listed is
1, weight 0 gets nothing; repeated rows count as documents of their own; a document without tokens
is taken while the prefix hasn't ended; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, table

NONE = "(none)"
LEVELS = ("domain", "lang", "source")
BUCKET_DIGITS = 3
# Production parameters of the registered query: weights by level, share of all tokens, epochs, seed.
WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 5, "de": 3, "fr": 2, "es": 1}, "source": {}}
PERCENT = 80
MAX_EPOCHS = 2
SEED = 17


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def domain_of(source: Column) -> Column:
    """The sources' domain: the source's last number modulo 4; ``(none)`` without a number."""
    digits = F.regexp_extract(F.coalesce(source, F.lit("")), "([0-9]{1,9})$", 1)
    return F.when(digits == "", F.lit(NONE)).otherwise(
        F.concat(F.lit("d"), (digits.cast("long") % 4).cast("string")))


def _exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def share(nodes: DataFrame, parent: list[str], key: str) -> DataFrame:
    """Nodes with their parent's ``budget``, own ``weight`` and ``cap`` -> ``alloc``. Children are
    taken by rising cap per weight: each is filled while its cap is within its share of what the
    filled ones leave; the others share the rest by weight, rounded down."""
    by = [F.col(c) for c in parent] or [F.lit(0)]
    order = Window.partitionBy(*by).orderBy("_ratio", key)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*by)
    n = (nodes.withColumn("_ratio", F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight"))
                          .otherwise(F.lit(1e308)))
         .withColumn("_sc", F.coalesce(F.sum("cap").over(before), F.lit(0)))
         .withColumn("_sw", F.sum("weight").over(rest))
         .withColumn("_full", (F.col("weight") > 0) & (_exact("cap") * _exact("_sw")
                                                       <= _exact("weight") * _exact(F.col("budget") - F.col("_sc")))))
    n = (n.withColumn("_fc", F.sum(F.when(F.col("_full"), F.col("cap")).otherwise(0)).over(whole))
         .withColumn("_fw", F.sum(F.when(F.col("_full"), 0).otherwise(F.col("weight"))).over(whole)))
    part = F.expr("(cast(weight AS decimal(38,0)) * cast(budget - _fc AS decimal(38,0))) div nullif(_fw, 0)")
    return n.withColumn("alloc", F.when(F.col("_full"), F.col("cap")).otherwise(F.coalesce(part, F.lit(0)))) \
        .drop("_ratio", "_sc", "_sw", "_full", "_fc", "_fw")


def _weight(level: str, weights: dict) -> Column:
    w = F.lit(1).cast("long")
    for name, value in weights.items():
        w = F.when(F.col(level) == name, F.lit(int(value)).cast("long")).otherwise(w)
    return w


def leaf_budgets(leaves: DataFrame, weights: dict, percent: int, max_epochs: int,
                 levels: tuple[str, ...] = LEVELS) -> DataFrame:
    """(levels..., supply) -> with ``alloc``: the tokens each leaf is to give."""
    caps = leaves.withColumn("cap", F.col("supply") * max_epochs)
    up = caps.agg(F.sum("supply").alias("all")).select(
        F.expr(f"(cast(all AS decimal(38,0)) * {int(percent)}) div 100").alias("budget"))
    out = None
    for depth, level in enumerate(levels, 1):
        path, parent = list(levels[:depth]), list(levels[:depth - 1])
        nodes = caps.groupBy(*path).agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(level, weights.get(level, {})))
        nodes = nodes.join(out, parent) if parent else nodes.crossJoin(F.broadcast(up))   # up: one row
        out = share(nodes, parent, level).select(*path, F.col("alloc").alias("budget"))
    return leaves.join(out.withColumnRenamed("budget", "alloc"), list(levels))


def mix(docs: DataFrame, domain: Column, lang: Column, source: Column, tokens: Column, id_col: str = "doc_id",
        weights: dict = WEIGHTS, percent: int = PERCENT, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Every document with its leaf, n_tokens and ``epochs``, the times it is taken."""
    rows = staged(docs.select(F.col(id_col).alias("_id"), *[F.coalesce(c.cast("string"), F.lit(NONE)).alias(n)
                                                           for n, c in zip(LEVELS, (domain, lang, source))],
                              tokens.alias("n_tokens")), "mix-rows")
    leaf = list(LEVELS)
    plan = leaf_budgets(rows.groupBy(*leaf).agg(F.sum("n_tokens").alias("supply")), weights, percent, max_epochs)
    plan = staged(plan.select(*leaf, F.expr("coalesce(alloc div nullif(supply, 0), 0)").alias("whole"),
                              F.expr("alloc - supply * coalesce(alloc div nullif(supply, 0), 0)").alias("rest")), "mix-plan")
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole").cast("string"),
                            F.coalesce(F.col("_id").cast("string"), F.lit(""))))
    keyed = rows.join(plan, leaf).withColumn("_key", key).withColumn("_b", F.substring("_key", 1, BUCKET_DIGITS))
    sums = keyed.groupBy(*leaf, "_b").agg(F.sum("n_tokens").alias("_sum"))
    sums = sums.withColumn("_end", F.sum("_sum").over(Window.partitionBy(*leaf).orderBy("_b")))
    keyed = keyed.join(sums.select(*leaf, "_b", (F.col("_end") - F.col("_sum")).alias("_start"), "_end"), [*leaf, "_b"])
    edge = (F.col("_start") <= F.col("rest")) & (F.col("rest") < F.col("_end"))
    inside = Window.partitionBy(*leaf, "_b").orderBy("_key", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    cols = [F.col("_id").alias(id_col), *leaf, "n_tokens"]
    clear = keyed.filter(~edge).select(*cols, (F.col("whole") + F.when(F.col("_end") <= F.col("rest"), 1)
                                               .otherwise(0)).alias("epochs"))
    cut = keyed.filter(edge).withColumn("_cum", F.col("_start") + F.sum("n_tokens").over(inside)) \
        .select(*cols, (F.col("whole") + F.when(F.col("_cum") <= F.col("rest"), 1).otherwise(0)).alias("epochs"))
    return clear.unionByName(cut)


def mix_documents(docs: DataFrame, **kw) -> DataFrame:
    """``mix`` over the columns of ``documents``: domain by source number, tokens as words."""
    return mix(docs, domain_of(F.col("source")), F.col("lang"), F.col("source"), n_words(F.col("text")), **kw)


def take(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The rows of ``docs`` that are taken at least once, with all their columns."""
    left_out = staged(mix_documents(docs, id_col=id_col, **kw).groupBy(F.col(id_col).alias("_m"))
                      .agg(F.max("epochs").alias("_e")).filter("_e = 0").select("_m"), "mix-left-out")
    return docs.join(left_out, docs[id_col].eqNullSafe(left_out["_m"]), "left_anti")


def op8_mixing(spark, sf_dir):
    return mix_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op8_mixing": op8_mixing}


def _level_sql(k: int, path: str, parent: str, level: str, cases: str) -> str:
    join = f"JOIN a{k - 1} USING ({parent})" if parent else "CROSS JOIN (SELECT sum(supply)::HUGEINT * 80 // 100 AS budget FROM leaves) r"
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""
n{k} AS (SELECT {path}, budget, cap, weight, CASE WHEN weight > 0 THEN cap::DOUBLE / weight ELSE 1e308 END AS ratio
  FROM (SELECT {path}, sum(supply) * 2 AS cap, {cases} AS weight FROM leaves GROUP BY {path}) {join}),
f{k} AS (SELECT *, weight > 0 AND cap::HUGEINT * sum(weight) OVER ({by} ORDER BY ratio, {level} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    <= weight::HUGEINT * (budget - coalesce(sum(cap) OVER ({by} ORDER BY ratio, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled FROM n{k}),
a{k} AS (SELECT {path}, CASE WHEN filled THEN cap ELSE coalesce(weight::HUGEINT * (budget - sum(CASE WHEN filled THEN cap ELSE 0 END) OVER ({by}))
    // nullif(sum(CASE WHEN filled THEN 0 ELSE weight END) OVER ({by}), 0), 0) END AS budget FROM f{k})"""


ORACLES = {"op8_mixing": r"""
WITH d AS (SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
    CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1) = '' THEN '(none)'
         ELSE 'd' || (regexp_extract(source, '([0-9]{1,9})$', 1)::BIGINT % 4) END AS domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS supply FROM d GROUP BY 1, 2, 3),""" + ",".join([
    _level_sql(1, "domain", "", "domain", "CASE domain WHEN 'd0' THEN 4 WHEN 'd1' THEN 3 WHEN 'd2' THEN 2 ELSE 1 END"),
    _level_sql(2, "domain, lang", "domain", "lang", "CASE lang WHEN 'en' THEN 5 WHEN 'de' THEN 3 WHEN 'fr' THEN 2 ELSE 1 END"),
    _level_sql(3, "domain, lang, source", "domain, lang", "source", "1")]) + r""",
p AS (SELECT domain, lang, source, coalesce(budget // nullif(supply, 0), 0) AS whole,
      budget - supply * coalesce(budget // nullif(supply, 0), 0) AS rest FROM leaves JOIN a3 USING (domain, lang, source)),
o AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
        ORDER BY md5('17:' || whole || ':' || coalesce(doc_id::VARCHAR, '')), n_tokens
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM d JOIN p USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens::BIGINT AS n_tokens,
       (whole + CASE WHEN cum <= rest THEN 1 ELSE 0 END)::BIGINT AS epochs FROM o"""}
