"""Byte-level decoders as plain functions, wrapped into Arrow UDFs where Spark has no native form."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import re
import struct
import zlib
from collections import Counter

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes that cp1252 leaves out; they stand for the control characters of the same number.
_HOLES = {0x81, 0x8D, 0x8F, 0x90, 0x9D}


def decode_text(b: bytes | None) -> str | None:
    """UTF-8 when valid; else cp1252, its undefined bytes as control characters."""
    if b is None:
        return None
    try:
        return b.decode("utf-8")
    except UnicodeDecodeError:
        return "".join(chr(x) if x in _HOLES else bytes([x]).decode("cp1252") for x in b)


def digest_of(b: bytes) -> str:
    return base64.b32encode(hashlib.sha1(b).digest()).decode()


def dechunk(body: bytes) -> bytes:
    """Chunked transfer coding removed; a malformed body is returned unchanged."""
    out, at = [], 0
    while True:
        eol = body.find(b"\r\n", at)
        if eol < 0:
            return body
        try:
            size = int(body[at:eol].split(b";")[0].strip(), 16)
        except ValueError:
            return body
        start = eol + 2
        if size == 0:
            return b"".join(out)
        if start + size > len(body):
            return body
        out.append(body[start : start + size])
        at = start + size + 2


def record_block(record: bytes) -> bytes:
    """The message of an archive record, as long as the record declares it, so that separators behind it stay out; other bytes are a message."""
    if record.startswith(b"WARC/"):
        head, _, rest = record.partition(b"\r\n\r\n")
        declared = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", head)
        return rest[: int(declared.group(1))] if declared else rest
    line, gap, rest = record.partition(b"\n")
    fields = line.split()
    # the older format: address, host, date, type and length on one line
    if gap and len(fields) == 5 and fields[4].isdigit() and b"://" in fields[0]:
        return rest[: int(fields[4])]
    return record


def http_body(record: bytes) -> tuple[int | None, str | None, bytes]:
    """(status, mime, body) of an HTTP response, bare or inside an archive record; without a header all is body."""
    message = record_block(record)
    ends = [(message.find(gap), gap) for gap in (b"\r\n\r\n", b"\n\n")]
    at, gap = min(((i, g) for i, g in ends if i >= 0), default=(-1, b""))
    if at < 0 or not message.startswith(b"HTTP/"):
        return None, None, message
    lines = message[:at].decode("latin-1").splitlines()
    body = message[at + len(gap) :]
    m = re.match(r"HTTP/\d(?:\.\d)?\s+(\d{3})", lines[0])
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if "chunked" in fields.get("transfer-encoding", "").lower():
        body = dechunk(body)
    mime = fields.get("content-type", "").split(";")[0].strip().lower() or None
    return (int(m.group(1)) if m else None), mime, body


def payload(body: bytes, want: str | None, packed: bool = False) -> tuple[bytes, bool]:
    """(payload, verified): the readable body, verified when it or its packed form has the wanted digest.

    A gzipped body is unpacked unless the resource itself is a packed file (``packed``).
    """
    verified = want is not None and digest_of(body) == want
    if body[:2] == b"\x1f\x8b" and not packed:
        try:
            plain = gzip.decompress(body)
        except (OSError, EOFError, zlib.error):
            return body, verified
        return plain, verified or (want is not None and digest_of(plain) == want)
    return body, verified


def without_trailing_error(b: bytes) -> bytes:
    """A JPEG without what follows its end marker, where that is the output of a script error."""
    at = b.rfind(b"\xff\xd9")
    tail = b[at + 2 :] if b[:2] == b"\xff\xd8" and at > 0 else b""
    return b[: at + 2] if re.search(rb"(?i)<b>\s*(?:warning|fatal error|notice|parse error)\s*</b>", tail) else b


def entropy(b: bytes) -> float:
    """Shannon entropy in bits per byte; 0 for no bytes."""
    n = len(b)
    return -sum(k / n * math.log2(k / n) for k in Counter(b).values()) if n else 0.0


def image_size(b: bytes) -> tuple[int, int] | None:
    """(width, height) from a GIF, PNG or JPEG header."""
    if b[:6] in (b"GIF87a", b"GIF89a") and len(b) >= 10:
        return struct.unpack("<HH", b[6:10])
    if b[:8] == b"\x89PNG\r\n\x1a\n" and len(b) >= 24:
        return struct.unpack(">II", b[16:24])
    if b[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(b):
            if b[at] != 0xFF:
                at += 1
                continue
            marker = b[at + 1]
            if marker in (0xFF, 0x01) or 0xD0 <= marker <= 0xD8:
                at += 1 if marker == 0xFF else 2
                continue
            size = struct.unpack(">H", b[at + 2 : at + 4])[0]
            if 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
                h, w = struct.unpack(">HH", b[at + 5 : at + 9])
                return w, h
            at += 2 + size
    return None


def png(width: int, height: int, rgb: bytes) -> bytes:
    """An 8-bit RGB image file."""

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = b"".join(b"\0" + rgb[y * width * 3 : (y + 1) * width * 3] for y in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 9)) + chunk(b"IEND", b"")


_ESCAPES = {"0": "\0", "b": "\b", "n": "\n", "r": "\r", "t": "\t", "Z": "\x1a"}


def sql_unescape(b: bytes) -> bytes:
    """Backslash escapes of a SQL string; an unknown one keeps its character."""
    return re.sub(rb"\\(.)", lambda m: _ESCAPES.get(m.group(1).decode("latin-1"), m.group(1).decode("latin-1")).encode("latin-1"), b, flags=re.S)


def _decode(b: pd.Series) -> pd.Series:
    return b.map(lambda x: decode_text(None if x is None else bytes(x)))


def _entropy(b: pd.Series) -> pd.Series:
    return b.map(lambda x: None if x is None else entropy(bytes(x)))


def _image_size(b: pd.Series) -> pd.DataFrame:
    got = [image_size(bytes(x)) if x is not None else None for x in b]
    return pd.DataFrame({"width": [g[0] if g else None for g in got], "height": [g[1] if g else None for g in got]}).astype("Int32")


def decode_text_col(c: Column) -> Column:
    return F.pandas_udf(_decode, "string")(c)


def entropy_col(c: Column) -> Column:
    return F.pandas_udf(_entropy, "double")(c)


def image_size_col(c: Column) -> Column:
    return F.pandas_udf(_image_size, "struct<width:int,height:int>")(c)
