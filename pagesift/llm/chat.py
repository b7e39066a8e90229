"""Chat formatting by quotation linking (built-in functions only).

A message's lines carry a quote level, the number of ``>`` before them. Runs of lines of one level
are passages; a passage is hashed after white space and case are normalised. Level-0 passages
are the originals; a quoted passage is linked to the latest original of its scope and hash that
stands before it (of several of one order, the smallest id). A quoted passage that no whole original
equals is an excerpt: it is linked to the latest message before it whose own lines hold all of its lines,
by a join on line hashes and a count for each (passage, message). The latest original that a message
quotes at its shallowest linked level is its parent. Parents make reply trees; a
conversation is a tree, its messages in reply order (depth, then order), quotes removed.

Originals and quotes are dealt out together by ranges of (scope, hash, order), so a passage that a
third of all messages hold is split by order; a window finds the latest original inside a range, and the
last originals of a passage's earlier ranges, at most one row a range, are carried over. Roots and depths
come from pointer doubling, a logarithmic number of joins on unique keys, each staged in the shared folder.

Defined results: null text is empty; a message without quotes, or whose quotes match no earlier
message of its scope, is a root; rows repeated with the same scope, order, role and text count
once, and rows that share only scope and order are told apart by a digest; a null scope or order
is a scope or order of its own, ordered first; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged, table

QUOTE = "^([ \\t]*>)+"
MAX_LEVEL_DERIVED = 3


def _lines(messages: DataFrame) -> DataFrame:
    """(id, scope, ord, pos, level, body, run) of every line that isn't blank; blank lines don't split a run."""
    lines = messages.select("id", "scope", "ord", F.posexplode(F.split("text", "\r?\n")).alias("pos", "line"))
    mark = F.regexp_extract("line", QUOTE, 0)
    body = F.lower(F.trim(F.regexp_replace(F.substring(F.col("line"), F.length(mark) + 1, F.length("line")),
                                           "[\\x20\\x09-\\x0D]+", " ")))
    lines = lines.select("id", "scope", "ord", "pos", F.length(F.regexp_replace(mark, "[^>]", "")).alias("level"),
                         body.alias("body")).filter("body <> ''")
    at = F.row_number().over(Window.partitionBy("id").orderBy("pos"))
    own = F.row_number().over(Window.partitionBy("id", "level").orderBy("pos"))
    return lines.withColumn("run", at - own)


def _passages(messages: DataFrame) -> DataFrame:
    """(id, scope, ord, level, run, hash) of every passage."""
    runs = _lines(messages)
    text = F.concat_ws(" ", F.transform(F.array_sort(F.collect_list(F.struct("pos", "body"))), lambda x: x["body"]))
    return runs.groupBy("id", "scope", "ord", "level", "run").agg(F.md5(text).alias("hash"))


def _latest(originals: DataFrame, quotes: DataFrame) -> DataFrame:
    """``quotes(id, scope, ord, level, run, hash)`` with (o_ord, o_id), the latest of ``originals(id, scope, ord, hash)``
    before each, null if there is none."""
    key = ["scope", "hash", "ord", "kind"]                       # of one order, quotes stand before originals
    firsts = originals.groupBy("scope", "hash", "ord").agg(F.min("id").alias("o_id"))
    events = quotes.select(*key[:3], F.lit(0).alias("kind"), "id", "level", "run").unionByName(
        firsts.select(*key[:3], F.lit(1).alias("kind"), F.col("o_id").alias("id")), allowMissingColumns=True)
    events = staged(events.repartitionByRange(*key).withColumn("part", F.spark_partition_id()), "events")
    original = F.when(F.col("kind") == 1, F.struct("ord", "id"))
    near = F.last(original, ignorenulls=True).over(
        Window.partitionBy("scope", "hash", "part").orderBy("ord", "kind").rowsBetween(Window.unboundedPreceding, 0))
    far = F.last("o", ignorenulls=True).over(
        Window.partitionBy("scope", "hash").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = events.groupBy("scope", "hash", "part").agg(F.max(original).alias("o")).select(
        F.col("scope").alias("s"), F.col("hash").alias("h"), F.col("part").alias("p"), far.alias("far")).filter("far IS NOT NULL")
    at = events.withColumn("near", near).filter("kind = 0")
    o = F.coalesce("near", "far")
    return at.join(carried, at["scope"].eqNullSafe(carried["s"]) & (at["hash"] == carried["h"]) & (at["part"] == carried["p"]), "left") \
        .select("id", "scope", "ord", "level", "run", o["ord"].alias("o_ord"), o["id"].alias("o_id"))


def _excerpts(messages: DataFrame, quotes: DataFrame) -> DataFrame:
    """``quotes(id, scope, ord, level, run)`` with (o_ord, o_id), the latest message before each that has all of its
    lines at level 0, null if there is none."""
    def lines(some):
        return staged(_lines(some).withColumn("hash", F.md5("body")).select("id", "scope", "ord", "level", "run", "hash").distinct(), "lines")

    passage = ["id", "level", "run"]
    held = lines(messages.join(quotes.select("id").distinct(), "id", "left_semi")).join(quotes.select(*passage), passage, "left_semi")
    scopes = quotes.select(F.col("scope").alias("s")).distinct()
    own = lines(messages.join(scopes, messages["scope"].eqNullSafe(scopes["s"]), "left_semi")).filter("level = 0").select(
        F.col("id").alias("o_id"), F.col("scope").alias("s"), F.col("ord").alias("o_ord"), F.col("hash").alias("h")).distinct()
    size = held.groupBy(*passage).agg(F.count("*").alias("size"))
    before = (own["o_ord"] < held["ord"]) | (own["o_ord"].isNull() & held["ord"].isNotNull())
    met = held.join(own, held["scope"].eqNullSafe(own["s"]) & (held["hash"] == own["h"]) & before) \
        .groupBy(*passage, "o_ord", "o_id").agg(F.count("*").alias("n")).join(size, passage).filter("n = size") \
        .groupBy(*passage, "o_ord").agg(F.min("o_id").alias("o_id")) \
        .groupBy(*passage).agg(F.max(F.struct("o_ord", "o_id")).alias("o"))
    return quotes.select(*passage, "scope", "ord").join(met, passage, "left").select(
        "id", "scope", "ord", "level", "run", F.col("o.o_ord").alias("o_ord"), F.col("o.o_id").alias("o_id"))


def format_chats(messages: DataFrame, scope_col: str = "conv_id", order_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(scope, order, message_id, conversation_id, parent_id, depth, role, text, n_quotes, n_linked,
    max_level): conversation_id is the root's message_id, text has no quotes."""
    src = messages.select(F.col(scope_col).alias("scope"), F.col(order_col).alias("ord"), F.col(role_col).alias("role"),
                          F.coalesce(F.col(text_col), F.lit("")).alias("text")).distinct()
    ident = F.concat_ws(":", F.coalesce(F.col("scope").cast("string"), F.lit("-")),
                        F.coalesce(F.col("ord").cast("string"), F.lit("-")),
                        F.substring(F.md5(F.concat_ws("|", F.coalesce("role", F.lit("")), "text")), 1, 12))
    msgs = staged(src.withColumn("id", ident), "messages")
    passages = staged(_passages(msgs), "passages")
    linked = staged(_latest(passages.filter("level = 0"), passages.filter("level > 0")), "linked")
    rest = linked.filter("o_id IS NULL")
    if rest.limit(1).count():
        linked = linked.filter("o_id IS NOT NULL").unionByName(_excerpts(msgs, rest))
    per = linked.groupBy("id").agg(
        F.count("*").alias("n_quotes"), F.count("o_id").alias("n_linked"), F.max("level").alias("max_level"),
        F.max(F.when(F.col("o_id").isNotNull(), F.struct((-F.col("level")).alias("up"), F.col("o_ord").alias("o"),
                                                         F.col("o_id").alias("p")))).alias("best"))
    kept = ["id", "parent_id", "n_quotes", "n_linked", "max_level"]
    up = staged(msgs.select("id").join(per, "id", "left")
                .select("id", F.col("best.p").alias("parent_id"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in kept[2:]])
                .select(*kept, F.coalesce("parent_id", "id").alias("anc"), F.col("parent_id").isNull().alias("settled"),
                        F.when(F.col("parent_id").isNull(), 0).otherwise(1).cast("long").alias("depth")), "up")
    done, left = up.filter("settled"), up.filter("NOT settled")
    while left.limit(1).count():        # each round doubles the pointers' length of what hasn't reached its root
        far = done.unionByName(left).select(F.col("id").alias("k"), F.col("anc").alias("anc2"),
                                            F.col("settled").alias("at_root"), F.col("depth").alias("depth2"))
        moved = staged(left.join(far, left["anc"] == far["k"]).select(
            *kept, F.col("anc2").alias("anc"), F.col("at_root").alias("settled"),
            (F.col("depth") + F.col("depth2")).alias("depth")), "up")
        done, left = done.unionByName(moved.filter("settled")), moved.filter("NOT settled")
    up = done
    clean = F.regexp_replace(F.concat_ws("\n", F.filter(F.split("text", "\r?\n"), lambda x: ~x.rlike("^[ \\t]*>"))),
                             "^\\s+|\\s+$", "")
    return (msgs.select("scope", "ord", "id", "role", clean.alias("text")).join(up, "id")
            .select(F.col("scope").alias(scope_col), F.col("ord").alias(order_col), F.col("id").alias("message_id"),
                    F.col("anc").alias("conversation_id"), "parent_id", "depth", "role", "text",
                    *kept[2:]))


def quoted_threads(conversations: DataFrame, levels: int = MAX_LEVEL_DERIVED) -> DataFrame:
    """The turns of ``conversations`` as mail-like messages: each turn quotes the ``levels`` turns before
    it, nested. The tables hold no quotes, so the registered query reads these, made by Spark from
    every turn."""
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"),
                                F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("k")) \
        .filter("k = 0 OR turn IS NOT NULL")
    line = F.concat(F.repeat(F.lit(">"), F.col("k")), F.lit(" "))
    quoted = F.concat_ws("\n", F.transform(F.split("text", "\r?\n"), lambda x: F.concat(line, x)))
    # a turn meets the turns that quote it in one grouping; of a turn's several texts the smallest is quoted
    met = rows.groupBy("conv_id", (F.col("turn") + F.col("k")).alias("turn")).agg(
        F.collect_set(F.when(F.col("k") == 0, F.struct("role", "text"))).alias("own"),
        *[F.min(F.when(F.col("k") == k, quoted)).alias(f"q{k}") for k in range(1, levels + 1)])
    quotes = [F.col(f"q{k}") for k in range(levels, 0, -1)]
    return met.select("conv_id", "turn", F.explode("own").alias("o"), *quotes).select(
        "conv_id", "turn", F.col("o.role").alias("role"), F.concat_ws("\n", *quotes, "o.text").alias("text"))


def op5_chat(spark, sf_dir):
    return format_chats(quoted_threads(table(spark, sf_dir, "conversations")))


QUERIES = {"op5_chat": op5_chat}
ORACLES = {"op5_chat": r"""
WITH RECURSIVE src AS (SELECT DISTINCT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
made AS (SELECT s.conv_id, s.turn, s.role, concat_ws(chr(10), q3.q, q2.q, q1.q, s.text) AS text FROM src s
  LEFT JOIN (SELECT conv_id, turn + 1 AS turn, min('> ' || replace(text, chr(10), chr(10) || '> ')) AS q FROM src GROUP BY 1, 2) q1
    ON s.conv_id = q1.conv_id AND s.turn = q1.turn
  LEFT JOIN (SELECT conv_id, turn + 2 AS turn, min('>> ' || replace(text, chr(10), chr(10) || '>> ')) AS q FROM src GROUP BY 1, 2) q2
    ON s.conv_id = q2.conv_id AND s.turn = q2.turn
  LEFT JOIN (SELECT conv_id, turn + 3 AS turn, min('>>> ' || replace(text, chr(10), chr(10) || '>>> ')) AS q FROM src GROUP BY 1, 2) q3
    ON s.conv_id = q3.conv_id AND s.turn = q3.turn),
msg AS (SELECT *, conv_id || ':' || turn || ':' || md5(coalesce(role, '') || '|' || text)[1:12] AS id FROM made),
line AS (SELECT id, conv_id, turn, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM msg),
body AS (SELECT id, conv_id, turn, pos, length(regexp_replace(regexp_extract(line, '^([ \t]*>)+'), '[^>]', '', 'g')) AS level,
  lower(trim(regexp_replace(line[length(regexp_extract(line, '^([ \t]*>)+')) + 1:], '[\x20\x09-\x0D]+', ' ', 'g'))) AS body FROM line),
runs AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY pos) - row_number() OVER (PARTITION BY id, level ORDER BY pos) AS run
  FROM body WHERE body <> ''),
pass AS (SELECT id, conv_id, turn, level, run, md5(string_agg(body, ' ' ORDER BY pos)) AS hash FROM runs GROUP BY ALL),
firsts AS (SELECT conv_id, hash, turn AS o_turn, min(id) AS o_id FROM pass WHERE level = 0 GROUP BY 1, 2, 3),
whole AS (SELECT p.id, p.conv_id, p.turn, p.level, p.run, f.o_turn, f.o_id FROM (SELECT * FROM pass WHERE level > 0) p
  ASOF LEFT JOIN firsts f ON p.conv_id = f.conv_id AND p.hash = f.hash AND p.turn > f.o_turn),
asked AS (SELECT DISTINCT w.id, w.conv_id, w.turn, w.level, w.run, r.body FROM whole w
  JOIN runs r ON w.id = r.id AND w.level = r.level AND w.run = r.run WHERE w.o_id IS NULL),
own AS (SELECT DISTINCT id AS o_id, conv_id, turn AS o_turn, body FROM runs WHERE level = 0),
met AS (SELECT a.id, a.level, a.run, o.o_turn, o.o_id, count(*) AS n FROM asked a
  JOIN own o ON a.conv_id = o.conv_id AND a.body = o.body AND o.o_turn < a.turn GROUP BY ALL),
holder AS (SELECT m.id, m.level, m.run, max(m.o_turn) AS o_turn, list(m.o_id ORDER BY m.o_turn DESC, m.o_id)[1] AS o_id FROM met m
  JOIN (SELECT id, level, run, count(*) AS n FROM asked GROUP BY ALL) s ON m.id = s.id AND m.level = s.level AND m.run = s.run AND m.n = s.n
  GROUP BY ALL),
linked AS (SELECT w.id, w.level, coalesce(w.o_turn, h.o_turn) AS o_turn, coalesce(w.o_id, h.o_id) AS o_id FROM whole w
  LEFT JOIN holder h ON w.id = h.id AND w.level = h.level AND w.run = h.run),
per AS (SELECT id, count(*) AS n_quotes, count(o_id) AS n_linked, max(level) AS max_level,
  max((-level, o_turn, o_id)) FILTER (o_id IS NOT NULL) AS best FROM linked GROUP BY 1),
tree AS (SELECT m.conv_id, m.turn, m.id, m.role, m.text, per.best[3] AS parent_id, coalesce(n_quotes, 0) AS n_quotes,
  coalesce(n_linked, 0) AS n_linked, coalesce(max_level, 0) AS max_level FROM msg m LEFT JOIN per USING (id)),
up AS (SELECT id, id AS root, 0 AS depth FROM tree WHERE parent_id IS NULL
  UNION ALL SELECT t.id, up.root, up.depth + 1 FROM tree t JOIN up ON t.parent_id = up.id)
SELECT conv_id, turn, t.id AS message_id, up.root AS conversation_id, parent_id, depth::BIGINT AS depth, role,
  regexp_replace(coalesce(array_to_string(list_filter(string_split(text, chr(10)), lambda x: NOT regexp_matches(x, '^[ \t]*>')), chr(10)), ''),
    '^\s+|\s+$', '', 'g') AS text,
  n_quotes::BIGINT AS n_quotes, n_linked::BIGINT AS n_linked, max_level::BIGINT AS max_level
FROM tree t JOIN up ON t.id = up.id"""}
