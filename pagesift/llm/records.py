"""Token ids as length-delimited binary record files with an offset index, read back by Spark.

``write_records`` encodes whole texts, orders them by id and writes one record file and one index file a
partition through the data source ``token_records``; ``read_records`` reads them in that order,
``read_shuffled`` in a seeded random order, by the offsets of the index.

Record file: for each document ``length`` (8 bytes), masked checksum of those 8 bytes (4), the record, masked
checksum of the record (4); all numbers are little-endian. The record is one byte (1 if there is an id, else
0), the id (8) and the token ids, of 2 bytes each where the vocabulary fits into them, else 4. A masked
checksum is the CRC-32 turned right by 15 bits plus a constant, so that a checksum of data that hold
checksums stays meaningful. Index file: per record its offset, its length and the number of token ids
before it in the file (8 bytes each). A folder is what its manifest ``_records.json`` lists: it is written last, by
the commit, so files of failed or repeated tasks are never read.

Rows are dealt to files by quantiles of the id, taken from the id column alone; the rows of one id that spans
several files are spread over them, so nothing depends on ids being unique. A text is cut before spaces that
follow no white space, where the tokenizer's own pattern always cuts, and a word met before is
looked up, as are letters met before with other punctuation; ``check_tokenizer`` raises on tokenizers for which that isn't so.

Defined results: null text is empty (the end id alone); a null id comes first and stays null; rows of the same id
follow each other by their token ids, those of an id that spans files by file; repeated rows are records
of their own; an empty table gives a manifest without files and an empty result; other columns are
ignored; damaged records raise ``ValueError`` when read.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .common import ensure_checkpoint_dir, release, ship_package, table

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
MANIFEST = "_records.json"
SPLIT_BYTES = 64 << 20      # a reading task takes about so much of a file
BATCH_BYTES = 4 << 20
KNOWN_WORDS = 1 << 20       # words a worker remembers before it starts anew
LONG_WORD = 64              # longer ones aren't remembered
SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))
RUN = f"[{SPACES}] "
PLAIN = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([!-/:-@\[-`{-~]*)")     # one run of letters, one of punctuation
LINES = re.compile(r"\S+(\n\S+)+")
# Byte-level vocabularies write a byte as the character of its number where that is printable, the others from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_SIGNS = {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(PRINTABLE)))}
SPACE_SIGN = BYTE_SIGNS[0x20]
LEAST_ID = -(1 << 63)       # where null ids are ordered
ROW = "file int, id long, ids binary"
HEAD, SUM, INDEX = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<QQQ")
FRAME = HEAD.size + 2 * SUM.size


# --- encoding ---

def tokenizer_json(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        return f.read()


def check_tokenizer(spec: dict) -> None:
    pre = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or spec.get("post_processor") or pre.get("type") != "ByteLevel" \
            or not pre.get("use_regex") or pre.get("add_prefix_space"):
        raise ValueError("only byte-level tokenizers that split by their pattern and add nothing")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or " " in t["content"]
           for t in spec["added_tokens"]):
        raise ValueError("added tokens must be plain and without spaces")


def vocabulary_size(spec: dict) -> int:
    return max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1


def units(text: str) -> list[str]:
    """The text cut before every space that follows no white space, those spaces left out."""
    parts = text.split(" ")
    out = [parts[0]]
    for p in parts[1:]:
        if out[-1] == "" or out[-1][-1] in SPACES:
            out[-1] += " " + p
        else:
            out.append(p)
    return out


class _Known(dict):
    """Words with the space before them -> packed ids. A word of letters and punctuation is two pieces of the tokenizer's
    pattern: its letters go to the merges alone and are shared by all punctuation; other words go through the whole tokenizer."""

    def __init__(self, blob: str, code: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.code = Tokenizer.from_str(blob), code
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.tails, self.starts = self.tokenizer.model, {}, {}
        self.newline = self.ids("\n")

    def ids(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids).tobytes()

    def letters(self, mark: str, word: str) -> bytes:
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(BYTE_SIGNS)
        return array(self.code, [t.id for t in self.model.tokenize(mark + word)]).tobytes()

    def tail(self, signs: str) -> bytes:
        if signs not in self.tails:
            if len(self.tails) > KNOWN_WORDS >> 4:
                self.tails.clear()
            self.tails[signs] = self.ids(signs)
        return self.tails[signs]

    def line(self, word: str) -> bytes:
        """A word after one line end."""
        got = self.starts.get(word)
        if got is None:
            m = PLAIN.fullmatch(word)
            got = self.newline + (self.letters("", m[1]) + self.tail(m[2]) if m else self.ids(word))
            if len(word) <= LONG_WORD:
                if len(self.starts) > KNOWN_WORDS >> 3:
                    self.starts.clear()
                self.starts[word] = got
        return got

    def __missing__(self, word: str) -> bytes:
        m = PLAIN.fullmatch(word)
        if m:
            got = self[m[1]] + self.tail(m[2]) if m[2] else self.letters(SPACE_SIGN, word)
        elif LINES.fullmatch(word):
            first, *rest = word.split("\n")
            return self[first] + b"".join(map(self.line, rest))
        else:
            got = self.ids(" " + word)
        if len(word) <= LONG_WORD:
            self[word] = got
        return got

    def encode(self, texts: pa.Array, end: bytes) -> pa.Array:
        """Packed ids of each text with ``end`` behind. Distinct words are looked up once an array, their ids are then
        laid out by position."""
        if len(self) > KNOWN_WORDS:
            self.clear()
        odd = pc.match_substring_regex(texts, RUN)
        parts = pc.split_pattern(pc.if_else(odd, "", texts), " ")
        begin = parts.offsets.to_numpy()[:-1] - parts.offsets[0].as_py()
        words = parts.flatten().dictionary_encode()
        first = [self.ids(t) for t in parts.flatten().take(pa.array(begin)).to_pylist()]
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
            head, *rest = units(texts[i].as_py())
            first[i] = self.ids(head) + b"".join(map(self.__getitem__, rest))
        known = [self[w] for w in words.dictionary.to_pylist()]
        code = words.indices.to_numpy().astype(np.int64)
        code[begin] = len(known) + np.arange(len(first))
        code = np.insert(code, np.append(begin[1:], len(code)), len(known) + len(first))
        pool = [*known, *first, end]
        width = len(end)
        size = np.fromiter(map(len, pool), np.int64, len(pool)) // width
        place = np.cumsum(size) - size
        many = size[code]
        after = np.cumsum(many)
        ids = np.frombuffer(b"".join(pool), self.code)[np.repeat(place[code] - after + many, many) + np.arange(after[-1])]
        ends = np.concatenate([[0], after[np.append(begin[1:], len(code) - len(first)) + np.arange(len(first))]]) * width
        return pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(ids.tobytes())])


_KNOWN: dict[tuple, _Known] = {}       # of this worker, kept from task to task


def _encode_rows(shared, bounds: np.ndarray, end: bytes, code: str):
    def run(batches):
        blob = shared.value
        key = (zlib.crc32(blob.encode()), code)
        known = _KNOWN.get(key) or _KNOWN.setdefault(key, _Known(blob, code))
        for b in batches:
            order, spread = b.column(0).to_numpy(), b.column(1).to_numpy()
            low, high = np.searchsorted(bounds, order, "left"), np.searchsorted(bounds, order, "right")
            file = (low + spread % (high - low + 1)).astype(np.int32)
            if len(b):
                yield pa.RecordBatch.from_arrays([pa.array(file), b.column(2), known.encode(b.column(3), end)],
                                                 names=["file", "id", "ids"])
        release()
    return run


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str | None = None,
           end_id: int = END_ID, files: int | None = None) -> tuple[DataFrame, str, int]:
    """Rows of (file, id, ids) with the end id appended, the ids' numpy type, the number of files."""
    spark = docs.sparkSession
    ship_package(spark)
    blob = tokenizer_json(tokenizer)
    spec = json.loads(blob)
    check_tokenizer(spec)
    dtype, code = ("<u2", "H") if max(vocabulary_size(spec), end_id + 1) <= 1 << 16 else ("<u4", "I")
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_ID))
    cuts = docs.select(order.alias("o")).agg(F.percentile_approx("o", [i / n for i in range(1, n)] or [0.5], 100 * n)).first()[0]
    bounds = np.array(cuts if n > 1 and cuts else [], np.int64)
    spread = F.abs(F.xxhash64(F.col(text_col), F.monotonically_increasing_id()) % 1_000_003)
    src = docs.select(order, spread, F.col(id_col).cast("long"), F.coalesce(F.col(text_col), F.lit("")))
    run = _encode_rows(spark.sparkContext.broadcast(blob), bounds, np.array([end_id], dtype).tobytes(), code)
    return src.mapInArrow(run, ROW), dtype, n


# --- files ---

def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(record: bytes) -> bytes:
    head = HEAD.pack(len(record))
    return b"".join((head, SUM.pack(masked(head)), record, SUM.pack(masked(record))))


def unframe(data: bytes, offset: int = 0) -> bytes:
    """The record whose frame starts at ``offset`` of ``data``."""
    head = data[offset:offset + HEAD.size]
    at = offset + HEAD.size + SUM.size
    if len(head) < HEAD.size or SUM.pack(masked(head)) != data[at - SUM.size:at]:
        raise ValueError("record length is damaged")
    end = at + HEAD.unpack(head)[0]
    record = data[at:end]
    if SUM.pack(masked(record)) != data[end:end + SUM.size]:
        raise ValueError("record is damaged")
    return record


def _record(doc_id, ids: bytes) -> bytes:
    return struct.pack("<Bq", doc_id is not None, doc_id or 0) + ids


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: (order, name, records, token ids, bytes)."""

    files: list


class Writer(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.dtype = options["path"], options["dtype"]

    def write(self, iterator):
        fs, root = _opened(self.path)
        width, done, now = np.dtype(self.dtype).itemsize, [], None
        for b in iterator:
            for number, doc_id, ids in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or now["number"] != number:
                    done += _close(now)
                    name = f"part-{number:06d}-{uuid.uuid4().hex}"
                    now = {"number": number, "name": name, "records": 0, "ids": 0, "bytes": 0,
                           "data": fs.open_output_stream(f"{root}/{name}.rec"), "index": fs.open_output_stream(f"{root}/{name}.idx")}
                record = frame(_record(doc_id, ids))
                now["data"].write(record)
                now["index"].write(INDEX.pack(now["bytes"], len(record) - FRAME, now["ids"]))
                now["records"] += 1
                now["ids"] += len(ids) // width
                now["bytes"] += len(record)
        return Written(done + _close(now))

    def commit(self, messages):
        files = sorted(f for m in messages if m for f in m.files)
        fs, root = _opened(self.path)
        with fs.open_output_stream(f"{root}/{MANIFEST}") as out:
            out.write(json.dumps({"dtype": self.dtype, "files": files}).encode())

    def abort(self, messages):
        fs, root = _opened(self.path)
        for name in [f[1] for m in messages if m for f in m.files]:
            for end in (".rec", ".idx"):
                fs.delete_file(f"{root}/{name}{end}")


def _close(now: dict | None) -> list:
    if now is None:
        return []
    now["data"].close()
    now["index"].close()
    return [(now["number"], now["name"], now["records"], now["ids"], now["bytes"])]


class Part(InputPartition):
    """Some records of one file; ``start`` token ids come before the file."""

    def __init__(self, name: str, first: int, count: int, start: int):
        super().__init__(name)
        self.name, self.first, self.count, self.start = name, first, count, start


def _index(fs, root: str, name: str, first: int, count: int) -> np.ndarray:
    with fs.open_input_file(f"{root}/{name}.idx") as f:
        got = np.frombuffer(f.read_at(count * INDEX.size, first * INDEX.size), "<u8").reshape(-1, 3)
    if len(got) != count:
        raise ValueError(f"index of {name} is cut short")
    return got


def _rows(rows: list[tuple], dtype: str) -> pa.RecordBatch:
    """(start, record) -> a batch of doc_id, start, n_tokens, ids (4 bytes each)."""
    heads = [struct.unpack_from("<Bq", r) for _, r in rows]
    ids = [np.frombuffer(r, dtype, offset=9).astype("<u4") for _, r in rows]
    return pa.RecordBatch.from_arrays([
        pa.array([i if known else None for known, i in heads], pa.int64()), pa.array([s for s, _ in rows], pa.int64()),
        pa.array([len(i) for i in ids], pa.int64()), pa.array([i.tobytes() for i in ids], pa.binary())],
        names=["doc_id", "start", "n_tokens", "ids"])


class Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.index_only = options.get("mode", "records") == "index"
        self.dtype, self.files = _manifest(self.path)

    def partitions(self):
        parts, start = [], 0
        for _, name, records, ids, size in self.files:
            step = -(-records // max(1, -(-size // self.split)))
            parts += [Part(name, i, min(step, records - i), start) for i in range(0, records, step)]
            start += ids
        return parts or [Part("", 0, 0, 0)]

    def read(self, partition: Part):
        if not partition.count:
            return
        fs, root = _opened(self.path)
        index = _index(fs, root, partition.name, partition.first, partition.count)
        if self.index_only:
            n = partition.count
            yield pa.RecordBatch.from_arrays(
                [pa.array([partition.name] * n), pa.array(range(partition.first, partition.first + n), pa.int64()),
                 *(pa.array(index[:, i].astype(np.int64)) for i in (0, 1)),
                 pa.array(index[:, 2].astype(np.int64) + partition.start)], names=["file", "record", "offset", "length", "start"])
            return
        rows, size = [], 0
        with fs.open_input_file(f"{root}/{partition.name}.rec") as f:
            f.seek(int(index[0, 0]))
            for _, length, before in index.tolist():
                rows.append((partition.start + before, unframe(f.read(length + FRAME))))
                size += length
                if size >= BATCH_BYTES:
                    yield _rows(rows, self.dtype)
                    rows, size = [], 0
        if rows:
            yield _rows(rows, self.dtype)


def _manifest(path: str) -> tuple[str, list]:
    fs, root = _opened(path)
    with fs.open_input_file(f"{root}/{MANIFEST}") as f:
        found = json.loads(f.read())
    return found["dtype"], found["files"]


class TokenRecords(DataSource):
    """``format("token_records")``: record files of token ids; option ``mode`` = ``index`` reads the index."""

    @classmethod
    def name(cls):
        return "token_records"

    def schema(self):
        if self.options.get("mode", "records") == "index":
            return "file string, record long, offset long, length long, start long"
        return "doc_id long, start long, n_tokens long, ids binary"

    def reader(self, schema):
        return Reader(self.options)

    def writer(self, schema, overwrite):
        return Writer(self.options)


def write_records(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", **kw) -> str:
    """Encode and write ``docs`` to the new folder ``path`` that driver and executors share."""
    spark = docs.sparkSession
    rows, dtype, n = encode(docs, id_col, text_col, **kw)
    spark.dataSource.register(TokenRecords)
    fs, root = _opened(path)
    fs.create_dir(root, recursive=True)
    rows.repartitionById(n, "file").sortWithinPartitions("file", F.asc_nulls_first("id"), "ids") \
        .write.format("token_records").option("path", path).option("dtype", dtype).mode("append").save()
    return path


def read_records(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids as little-endian unsigned 32-bit numbers, ``start`` the number of
    token ids before the document."""
    ship_package(spark)
    spark.dataSource.register(TokenRecords)
    return spark.read.format("token_records").option("path", path).option("splitBytes", split_bytes).load()


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, offset, length, start) of every record."""
    ship_package(spark)
    spark.dataSource.register(TokenRecords)
    return spark.read.format("token_records").option("path", path).option("mode", "index").load()


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """The records in an order drawn by ``seed``: only index rows are shuffled, the records are
    then fetched by their offsets. Partitions are consecutive pieces of that order."""
    dtype, _ = _manifest(path)

    def fetch(batches):
        fs, root = _opened(path)
        files = {}
        for b in batches:
            rows, size = [], 0
            for name, offset, length, start in zip(*(c.to_pylist() for c in b.columns)):
                if name not in files:
                    if len(files) >= 64:
                        files.pop(next(iter(files))).close()
                    files[name] = fs.open_input_file(f"{root}/{name}.rec")
                rows.append((start, unframe(files[name].read_at(length + FRAME, offset))))
                size += length
                if size >= BATCH_BYTES:
                    yield _rows(rows, dtype)
                    rows, size = [], 0
            if rows:
                yield _rows(rows, dtype)
        for f in files.values():
            f.close()

    index = read_index(spark, path).withColumn("key", F.xxhash64(F.lit(seed), "file", "record"))
    order = index.repartitionByRange("key", "file", "record").sortWithinPartitions("key", "file", "record")
    return order.select("file", "offset", "length", "start") \
        .mapInArrow(fetch, "doc_id long, start long, n_tokens long, ids binary")


def op11_records(spark, sf_dir):
    path = f"{ensure_checkpoint_dir(spark)}/llm-records-{uuid.uuid4().hex}"
    got = read_records(spark, write_records(table(spark, sf_dir, "documents"), path))
    return got.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op11_records": op11_records}
ORACLES: dict[str, str] = {}
