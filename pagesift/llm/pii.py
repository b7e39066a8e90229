"""Personal data: fixed base patterns and a skip-chain conditional random field.

Base spans are the leftmost non-overlapping matches of each kind's pattern that pass its check. The
field's nodes are a text's tokens that hold a digit or an at sign; neighbours in the text share
chain potentials, and tokens that repeat (same local part of an address, or same digits, the last seven of
longer ones) are linked by skip potentials, each to the next one like it and to the nearest observed one like
it, however far away. Tokens inside base spans are observed. Loopy belief propagation spreads their labels until
the messages settle, and a token whose marginal for a kind
reaches one half is added as a span of that kind where some token it is skip-linked with, directly
or through others, is observed; so spans are added for consistency inside a document only.

Node weights are a multinomial logistic model and edge potentials smoothed label agreements,
both counted over all documents, with base spans as labels. Every whole text is searched, in time linear in its length.

Defined results: null text is empty and has no spans; spans are in code points, end exclusive; repeated
rows and null ids are returned as often as they occur; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_package, table

# Fixed values of the contract: kinds in order, patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

NUMERIC = re.compile(r"[0-9][\x20.0-9-]*")      # every ip and card match lies in one such run
MARK = re.compile(r"[0-9@]")
EDGE_PUNCT = ".,;:!?\"'()[]{}<>|*&$%#"
N_LABELS = len(KINDS) + 1                       # label 0 is none
N_FEATURES = 18
SETTLED, ROUNDS = 1e-4, 1000                    # largest change of a settled message; rounds if they circle for ever


def luhn(digits: str) -> bool:
    s = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return s % 10 == 0


def emails(text: str):
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+ by one look at each at sign: a
    match that holds it starts where its run of local characters or the last match allows."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, by start, then kind."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for run in NUMERIC.finditer(text):
        s, e = run.span()
        if e - s < 7:
            continue
        for m in IP.finditer(text, s, e):
            if all(len(p) < 4 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text, s, e):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def tokens(text: str) -> list[tuple[int, int, int]]:
    """(start, end, chain) of tokens that hold a digit or an at sign, without outer punctuation; ``chain``
    is 1 if only white space or punctuation parts it from the token before."""
    out, end = [], 0
    for m in MARK.finditer(text):
        at = m.start()
        if at < end:
            continue
        s = at
        while s > end and text[s - 1] not in " \t\n\v\f\r":
            s -= 1
        e = at + 1
        while e < len(text) and text[e] not in " \t\n\v\f\r":
            e += 1
        last, end = end, e
        while s < e and text[s] in EDGE_PUNCT:
            s += 1
        while e > s and text[e - 1] in EDGE_PUNCT:
            e -= 1
        if s < e:
            out.append((s, e, int(bool(out) and s - last < 8 and not text[last:s].strip(EDGE_PUNCT + "+ \t\n\v\f\r"))))
    return out


def token_key(core: str) -> str | None:
    """What repeated or similar tokens share."""
    if "@" in core:
        start = at = core.index("@")
        while start and core[start - 1] in LOCAL:
            start -= 1
        return (core[start:at + 1] if start < at else core).lower()
    digits = "".join(c for c in core if "0" <= c <= "9")
    return digits[-7:] if len(digits) >= 4 else None        # no kind has spans of fewer than four digits


def token_features(core: str) -> list[int]:
    """Indices of the features that hold."""
    digits = "".join(c for c in core if "0" <= c <= "9")
    n = len(digits)
    parts = core.split(".")
    f = [0, 1 + (n >= 1) + (n >= 4) + (n >= 7) + (n >= 10) + (n >= 14) + (n >= 20)]
    quad = len(parts) == 4 and all(p.isdigit() and p.isascii() for p in parts)
    f += [8] if "@" in core else []
    f += [9] if DOMAIN.search(core) else []
    f += [10] if quad else []
    f += [11] if quad and all(len(p) < 4 and int(p) <= 255 for p in parts) else []
    f += [12] if 14 <= n <= 19 and luhn(digits) else []
    f += [13] if core.startswith("+") else []
    f += [14] if "-" in core else []
    f += [15] if any(c.isalpha() for c in core) else []
    f += [16] if n == len(core) else []
    f += [17] if "." in core else []
    return f


def observed(toks, spans) -> np.ndarray:
    """Label of each token that overlaps a base span, 0 for none."""
    out = np.zeros(len(toks), int)
    j = 0
    for i, (s, e, _) in enumerate(toks):
        while j < len(spans) and spans[j][2] <= s:
            j += 1
        k = j
        while k < len(spans) and spans[k][0] < e:
            if spans[k][2] > s:
                out[i] = spans[k][1] + 1
                break
            k += 1
    return out


def skip_edges(keys: list) -> list[tuple[int, int]]:
    """Each token with the next one of the same key."""
    last, out = {}, []
    for i, k in enumerate(keys):
        if k is not None:
            if k in last:
                out.append((last[k], i))
            last[k] = i
    return out


def observed_edges(keys: list, seen) -> list[tuple[int, int]]:
    """Each token that isn't observed with the last observed one of its key before it, or else the first
    after it, unless ``skip_edges`` has the pair."""
    first, last, out = {}, {}, []
    for i, (k, y) in enumerate(zip(keys, seen)):
        if k is not None and y:
            first.setdefault(k, i)
    for i, (k, y) in enumerate(zip(keys, seen)):
        if y:
            last[k] = i
        elif k in first:
            j = last.get(k, first[k])
            out.append((min(i, j), max(i, j)))
    known = set(skip_edges(keys))
    return [e for e in out if e not in known]


class Field:
    """Weights of the field and its inference."""

    def __init__(self, rows: list[tuple[list[int], int, int]], chain: np.ndarray, skip: np.ndarray):
        """rows: (features, label, how many); chain, skip: counts of label pairs."""
        x = np.zeros((len(rows), N_FEATURES))
        for i, (f, _, _) in enumerate(rows):
            x[i, f] = 1
        y = np.array([r[1] for r in rows], int)
        n = np.array([r[2] for r in rows], float)
        self.w = np.zeros((N_FEATURES, N_LABELS))
        for _ in range(400 if len(rows) else 0):
            z = x @ self.w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            self.w -= 0.5 * (x.T @ (p * n[:, None]) / n.sum() + 1e-4 * self.w)
        self.chain, self.skip = (self._agreement(c) for c in (chain, skip))

    @staticmethod
    def _agreement(pairs: np.ndarray) -> np.ndarray:
        """Log potentials: how much oftener labels meet than apart, smoothed towards agreement."""
        c = pairs + pairs.T + 0.5 + 10 * np.eye(N_LABELS)
        row = c.sum(axis=1)
        return np.clip(np.log(c * c.sum() / row[:, None] / row[None, :]), -4, 4)

    def marginals(self, feats: list[list[int]], seen: np.ndarray, edges: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Loopy sum-product; edges (a, b) with kind 0 chain, 1 skip; ``seen`` clamps tokens."""
        node = np.stack([self.w[f].sum(axis=0) for f in feats])
        node -= node.max(axis=1, keepdims=True)
        node[seen > 0] = -30
        node[np.flatnonzero(seen > 0), seen[seen > 0]] = 0
        pot = np.exp(np.stack([self.chain, self.skip])[kinds])
        src = np.concatenate([edges[:, 0], edges[:, 1]])
        dst = np.concatenate([edges[:, 1], edges[:, 0]])
        pot = np.concatenate([pot, pot.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        msg = np.zeros((len(src), N_LABELS))
        for _ in range(ROUNDS):
            belief = node.copy()
            np.add.at(belief, dst, msg)
            out = belief[src] - msg[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.einsum("el,elm->em", out, pot)
            new = np.log(np.maximum(new / new.sum(axis=1, keepdims=True), 1e-12))
            change = np.abs(new - msg).max()
            msg = 0.5 * msg + 0.5 * new
            if change < SETTLED:
                break
        belief = node.copy()
        np.add.at(belief, dst, msg)
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def added(self, text: str, spans: list) -> list[tuple[int, int, int]]:
        """Spans that the field adds to the base spans of one text."""
        if not spans:
            return []
        toks = tokens(text)
        seen = observed(toks, spans)
        keys = [token_key(text[s:e]) for s, e, _ in toks]
        with_base = {k for k, y in zip(keys, seen) if y and k}
        if not any(not y and k in with_base for k, y in zip(keys, seen)):
            return []
        skip = skip_edges(keys) + observed_edges(keys, seen)
        chain = [(i - 1, i) for i, t in enumerate(toks) if t[2]]
        p = self.marginals([token_features(text[s:e]) for s, e, _ in toks], seen, np.array(chain + skip, int),
                           np.array([0] * len(chain) + [1] * len(skip), int))
        return [(s, int(q.argmax()) - 1, e) for (s, e, _), y, k, q in zip(toks, seen, keys, p)
                if not y and k in with_base and q[1:].max() >= 0.5]


def _evidence(batches):
    """Counts of (features, label) and of label pairs along chain and skip edges."""
    rows, pairs = {}, np.zeros((2, N_LABELS, N_LABELS), np.int64)
    for b in batches:
        for t in b.column(0).to_pylist():
            text = t or ""
            toks = tokens(text)
            y = observed(toks, base_spans(text))
            for (s, e, _), label in zip(toks, y):
                k = (tuple(token_features(text[s:e])), int(label))
                rows[k] = rows.get(k, 0) + 1
            for i, tok in enumerate(toks):
                if tok[2]:
                    pairs[0, y[i - 1], y[i]] += 1
            for i, j in skip_edges([token_key(text[s:e]) for s, e, _ in toks]):
                pairs[1, y[i], y[j]] += 1
    out = [(0, list(f), label, n) for (f, label), n in rows.items()]
    out += [(k + 1, [int(i)], int(j), int(pairs[k, i, j])) for k in range(2) for i, j in np.argwhere(pairs[k])]
    cols = list(zip(*out)) or [[], [], [], []]
    kinds = (pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["what", "f", "y", "n"])


def fit(docs: DataFrame, text_col: str = "text") -> Field:
    """The field of all documents; patterns of features are counted in Spark, and there are at
    most a few thousand of them."""
    ship_package(docs.sparkSession)
    got = docs.select(F.col(text_col)).mapInArrow(_evidence, "what int, f array<int>, y int, n long") \
        .groupBy("what", "f", "y").agg(F.sum("n").alias("n")).collect()
    pairs = np.zeros((2, N_LABELS, N_LABELS))
    for r in got:
        if r.what:
            pairs[r.what - 1, r.f[0], r.y] += r.n
    return Field(sorted((list(r.f), r.y, r.n) for r in got if not r.what), pairs[0], pairs[1])


def joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans): the base spans and all spans of every row, as kind:start:end lists."""
    spark = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(field)

    def run(batches):
        for b in batches:
            base, every = [], []
            for t in b.column(1).to_pylist():
                spans = base_spans(t or "")
                base.append(joined(spans))
                more = shared.value.added(t, spans) if spans else []
                every.append(joined(spans + more) if more else base[-1])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, pa.string()), pa.array(every, pa.string())],
                                             names=["id", "base", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, base string, spans string")
    return out.withColumnRenamed("id", id_col)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added); the numbers by kind count
    base spans."""
    found = find(docs, fit(docs, text_col), id_col, text_col)
    count = [F.regexp_count("base", F.lit(k + ":")).cast("long").alias("n_" + k) for k in KINDS]
    n = F.regexp_count("spans", F.lit(":")) - F.regexp_count("base", F.lit(":"))
    return found.select(id_col, *count, F.sha2("base", 256).alias("base_sha256"), "spans",
                        (n / 2).cast("long").alias("n_added"))


def op10_pii(spark, sf_dir):
    return personal_data(table(spark, sf_dir, "documents"))


QUERIES = {"op10_pii": op10_pii}
ORACLES: dict[str, str] = {}
