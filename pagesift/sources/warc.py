"""Record framing for WET archives (gzip'ed WARC/1.0): the per-task helper behind the sources.

A record is a version line, header lines up to an empty line, then exactly Content-Length
bytes of body. Gzip members may be concatenated (the standard library reads them as one
stream). Only records passing the cheap header tests have their body decoded.
"""

from __future__ import annotations

import gzip
import io
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

# Fixed values of the WARC format and the reference's decoding.
VERSION_PREFIX = b"WARC/"
H_TYPE = "warc-type"
H_URI = "warc-target-uri"
H_LANGUAGE = "warc-identified-content-language"
H_LENGTH = "content-length"
TEXT_ENCODING = "utf-8"
TEXT_ERRORS = "ignore"          # invalid bytes are dropped, not replaced
PIECE = 1 << 20                 # bytes of a body read at once


@dataclass
class ScanResult:
    """Outcome of reading one archive."""
    n_records: int = 0
    n_retries: int = 0
    state: str = "read"         # read | partial | failed
    error: str | None = None
    rows: list = field(default_factory=list)


def open_archive(path: str):
    """Binary stream of an archive, decompressed when it is gzip'ed."""
    raw = open(path, "rb")  # noqa: SIM115 - caller closes via the gzip wrapper or itself
    head = raw.read(2)
    raw.seek(0)
    if head == b"\x1f\x8b":
        return gzip.GzipFile(fileobj=raw, mode="rb")
    return raw


def _read_headers(stream) -> tuple[str | None, dict[str, str]] | None:
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(VERSION_PREFIX):
        raise ValueError(f"expected WARC version line, got {line[:40]!r}")
    headers: dict[str, str] = {}
    while True:
        h = stream.readline()
        if not h:
            raise EOFError("archive ended inside a header block")
        if h in (b"\r\n", b"\n"):
            break
        name, _, value = h.decode(TEXT_ENCODING, TEXT_ERRORS).partition(":")
        headers[name.strip().lower()] = value.strip()
    return line.decode("ascii", TEXT_ERRORS).strip(), headers


def iter_records(stream, keep: Callable[[dict[str, str]], bool] | None = None,
                 status: ScanResult | None = None) -> Iterator[tuple]:
    """Yield ``(record_no, rec_type, uri, language, headers, content_length, text)``.

    ``keep(headers)`` decides from headers alone whether a body is decoded and the record
    yielded; skipped bodies are read past without decoding. ``status`` (if given) receives the
    record count and ``partial`` when the archive is truncated or corrupt after some records.
    Only errors of the format end an archive so -- a length that isn't a number of digits is one, whatever
    ``keep`` says of its record; connection and filesystem errors are raised to the caller.
    """
    status = status if status is not None else ScanResult()
    n = 0
    try:
        while True:
            got = _read_headers(stream)
            if got is None:
                break
            _, headers = got
            length = _length(headers.get(H_LENGTH, "0"))
            wanted = keep is None or keep(headers)
            if wanted:
                body = _body(stream, length)
            else:
                _skip(stream, length)
            record_no = n
            n += 1
            status.n_records = n
            if wanted:
                yield (record_no, headers.get(H_TYPE), headers.get(H_URI), headers.get(H_LANGUAGE),
                       headers, length, body.decode(TEXT_ENCODING, TEXT_ERRORS))
    except (EOFError, ValueError, zlib.error, gzip.BadGzipFile) as e:
        status.state = "partial" if n > 0 else "failed"
        status.error = f"{type(e).__name__}: {e}"
    status.n_records = n


def _length(value: str) -> int:
    """Content-Length: digits only, so that a sign never turns into "all that is left"."""
    if not (value.isascii() and value.isdigit()):
        raise ValueError(f"bad Content-Length {value[:40]!r}")
    return int(value)


def _body(stream, length: int) -> bytes:
    """``length`` bytes, read in pieces: a length beyond the archive costs no more memory than the archive has bytes."""
    pieces, left = [], length
    while left > 0:
        piece = stream.read(min(left, PIECE))
        if not piece:
            raise EOFError("archive ended inside a record body")
        pieces.append(piece)
        left -= len(piece)
    return b"".join(pieces)


def _skip(stream, length: int) -> None:
    left = length
    while left > 0:
        chunk = stream.read(min(left, PIECE))
        if not chunk:
            raise EOFError("archive ended inside a record body")
        left -= len(chunk)


def header_filter(rec_type: str | None = None, uri_contains: str | None = None,
                  language: str | None = None, uri_startswith: str | None = None):
    """A ``keep`` predicate over record headers (all given conditions must hold)."""
    def keep(h: dict[str, str]) -> bool:
        if rec_type is not None and h.get(H_TYPE) != rec_type:
            return False
        uri = h.get(H_URI)
        if uri_contains is not None and (uri is None or uri_contains not in uri):
            return False
        if uri_startswith is not None and (uri is None or not uri.startswith(uri_startswith)):
            return False
        if language is not None and h.get(H_LANGUAGE) != language:
            return False
        return True
    return keep


def encode_record(headers: dict[str, str], body: bytes, version: str = "WARC/1.0") -> bytes:
    """One WARC record as bytes (Content-Length set from ``body``); used to build archives."""
    hs = dict(headers)
    hs["Content-Length"] = str(len(body))
    head = "".join(f"{k}: {v}\r\n" for k, v in hs.items())
    return f"{version}\r\n{head}\r\n".encode() + body + b"\r\n\r\n"


def gzip_members(records: list[bytes]) -> bytes:
    """Concatenate one gzip member per record, as crawl archives are stored."""
    out = io.BytesIO()
    for r in records:
        out.write(gzip.compress(r))
    return out.getvalue()
