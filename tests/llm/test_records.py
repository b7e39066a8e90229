import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pagesift.llm import records
from pagesift.session import ensure_checkpoint_dir


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_str(records.tokenizer_json())


@pytest.fixture(scope="module")
def known():
    return records._Known(records.tokenizer_json(), "H")


def folder(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/records-{name}-{os.urandom(4).hex()}"


def expected(rows, tokenizer):
    """(doc_id, n_tokens, ids, start) in the order of the files."""
    out = []
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 0]
        out.append((r[0], len(ids), np.array(ids, "<u4").tobytes(), np.array(ids, "<u2").tobytes()))
    out.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[3]))
    starts = np.cumsum([0] + [x[1] for x in out]).tolist()
    return [(d, s, n, ids) for (d, n, ids, _), s in zip(out, starts)]


def got(df):
    return [tuple(r[:3]) + (bytes(r.ids),) for r in df.select("doc_id", "start", "n_tokens", "ids").collect()]


def test_round_trip_equals_the_library(spark, odd, none, rows01, tokenizer):
    from brute import ROWS
    for df, rows, files in ((odd, ROWS, 3), (odd, ROWS, 1), (none, [], 4), (*rows01, None)):
        path = records.write_records(df, folder(spark, "a"), **({"files": files} if files else {}))
        want = expected([tuple(r) for r in rows], tokenizer)
        assert sorted(got(records.read_records(spark, path, split_bytes=30_000)), key=lambda x: x[1]) == want


def test_query_digests(spark, rows01, tokenizer):
    out = records.op11_records(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, out)) == [(d, s, n, zlib.crc32(i)) for d, s, n, i in expected([tuple(r) for r in rows01[1]], tokenizer)]


def test_an_id_of_a_third_of_all_rows_is_spread(spark, tokenizer):
    rows = [(7, "the same words") for _ in range(400)] + [(7, f"words {i}") for i in range(200)] + [(i, "x") for i in range(1200)]
    path = records.write_records(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), folder(spark, "hot"), files=12)
    _, files = records._manifest(path)
    assert len(files) == 12 and max(f[2] for f in files) < 300
    out = sorted(got(records.read_records(spark, path)), key=lambda x: x[1])
    assert [r[0] for r in out] == sorted(r[0] for r in rows)
    assert [r[1] for r in out] == np.cumsum([0] + [r[2] for r in out])[:-1].tolist()
    assert sorted(r[3] for r in out) == sorted(x[3] for x in expected(rows, tokenizer))


def test_shuffled_reads_fetch_by_offset(spark, rows01):
    path = records.write_records(rows01[0], folder(spark, "s"), files=5)
    plain, one, two = (got(records.read_records(spark, path)), got(records.read_shuffled(spark, path, 1)),
                       got(records.read_shuffled(spark, path, 2)))
    assert sorted(one, key=lambda x: x[1]) == sorted(two, key=lambda x: x[1]) == sorted(plain, key=lambda x: x[1])
    assert one != two != plain
    assert got(records.read_shuffled(spark, path, 1)) == one
    index = records.read_index(spark, path).orderBy("start").collect()
    assert [r.start for r in index] == sorted(p[1] for p in plain)


def test_damage_is_found(spark, rows01):
    for at in (3, 40):          # in the first length, in the first record
        path = records.write_records(rows01[0], folder(spark, "d"), files=2)
        _, files = records._manifest(path)
        name = f"{path.removeprefix('file:')}/{files[0][1]}.rec"
        with open(name, "r+b") as f:
            f.seek(at)
            byte = f.read(1)
            f.seek(at)
            f.write(bytes([byte[0] ^ 1]))
        with pytest.raises(Exception, match="damaged"):
            records.read_records(spark, path).collect()


def test_files_outside_the_manifest_are_never_read(spark, rows01):
    path = records.write_records(rows01[0], folder(spark, "o"), files=2)
    with open(f"{path.removeprefix('file:')}/part-000000-left-over.rec", "wb") as f:
        f.write(b"of a task that failed")
    assert len(got(records.read_records(spark, path))) == len(rows01[1])


def test_four_byte_ids(spark, monkeypatch, rows01, tokenizer):
    monkeypatch.setattr(records, "vocabulary_size", lambda spec: 1 << 17)
    path = records.write_records(rows01[0], folder(spark, "w"), files=2)
    assert records._manifest(path)[0] == "<u4"
    assert sorted(r[3] for r in got(records.read_records(spark, path))) == \
        sorted(x[3] for x in expected([tuple(r) for r in rows01[1]], tokenizer))


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        records.check_tokenizer({"pre_tokenizer": {"type": "ByteLevel", "use_regex": True, "add_prefix_space": True}, "added_tokens": []})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "it's", " ", "  ", "\n", "\t", "\xa0", "\u2003", "\u1680", "\x1c", "12", "é", "ß", "ÿ", "!?", "_", "'", "한",
                                          "<|endoftext|>", "X", "\u0301", "\xad"])).map("".join), min_size=1, max_size=5))
def test_cutting_and_lookup_never_change_the_ids(known, tokenizer, texts):
    got = known.encode(pa.array(texts), np.array([0], "<u2").tobytes())
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert [np.frombuffer(g, "<u2").tolist() for g in got.to_pylist()] == want
