"""Plain single-machine versions of the operators' definitions, for small inputs."""

import hashlib
import re
import zlib

import xxhash

# A small table of odd rows.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Word and other, " * 20000
ROWS = [  # nulls, empty and long texts, ties, repeated rows
    (5, "Hello  world\tagain", "en", "src1", 18), (3, "Hello world again", "en", "src2", 17),
    (9, "hello world again", "de", None, 17), (1, None, None, None, None), (2, "", "fr", "src3", 0),
    (4, " \n ", "es", "src3", 3), (6, LONG, "en", "src0", len(LONG)), (8, LONG + "x", "en", "src0", 1),
    (7, "12345 ###", "en", "src0", 9), (7, "12345 ###", "en", "src0", 9), (11, "été naïve ça Σας İ ﬁ", "fr", "srcx", 20),
    (12, "a<|endoftext|>b <|ENDOFTEXT|> c'mon it's 3.14 x", "en", "src9", 44), (None, "no id here", "en", "src1", 10),
    (13, "    ", "en", "src1", 4), (14, "é ́x 한국어 😀!!!", "de", "src2", 14),
]

WS = re.compile("[\x20\x09-\x0d]+")


def crc_mod(doc_id, mod):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % mod


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in WS.split(low) if w]


def fingerprint(text, k=4):
    w = words(text)
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def components(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
