"""Compound files (a file system inside a file) and the thumbnail databases stored in them."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the format.
MAGIC = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
LAST_SECTOR = 0xFFFFFFFA  # larger numbers are marks, not sectors
EPOCH_GAP = 11_644_473_600_000_000  # microseconds between 1601 and 1970


class Compound:
    """The streams of a compound file by name; sectors are read through their allocation chains."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC or len(data) < 512:
            raise ValueError("no compound file")
        self.data = data
        self.size, self.small = (1 << n for n in struct.unpack_from("<HH", data, 30))
        (self.n_fat, first_dir, self.cutoff, first_small, _, first_more, _) = struct.unpack_from("<I I 4x I I I I I", data, 44)
        listed = [n for n in struct.unpack_from("<109I", data, 76) if n < LAST_SECTOR]
        seen: set[int] = set()
        while first_more < LAST_SECTOR and first_more not in seen:
            seen.add(first_more)
            *more, first_more = struct.unpack(f"<{self.size // 4}I", self.sector(first_more))
            listed += [n for n in more if n < LAST_SECTOR]
        self.fat = [n for s in listed[: self.n_fat] for n in struct.unpack(f"<{self.size // 4}I", self.sector(s))]
        small_table = b"".join(map(self.sector, self.chain(first_small, self.fat)))
        self.small_fat = list(struct.unpack(f"<{len(small_table) // 4}I", small_table))
        self.entries = list(self.directory(b"".join(map(self.sector, self.chain(first_dir, self.fat)))))
        root = next((e for e in self.entries if e[1] == 5), None)
        self.small_data = b"".join(map(self.sector, self.chain(root[2], self.fat))) if root else b""

    def sector(self, n: int) -> bytes:
        at = (n + 1) * self.size
        return self.data[at : at + self.size].ljust(self.size, b"\0")

    @staticmethod
    def chain(start: int, table: list[int]) -> Iterator[int]:
        """The sectors of a chain; one that comes back to itself or leaves the table ends."""
        seen: set[int] = set()
        while start < LAST_SECTOR and start < len(table) and start not in seen:
            seen.add(start)
            yield start
            start = table[start]

    @staticmethod
    def directory(raw: bytes) -> Iterator[tuple[str, int, int, int]]:
        """(name, kind, first sector, size): kind 2 is a stream, 5 the root."""
        for at in range(0, len(raw) - 127, 128):
            length, kind = struct.unpack_from("<HB", raw, at + 64)
            if kind in (2, 5) and 2 <= length <= 64:
                first, size = struct.unpack_from("<II", raw, at + 116)
                yield raw[at : at + length - 2].decode("utf-16-le", "replace"), kind, first, size

    def streams(self) -> Iterator[tuple[str, bytes]]:
        for name, kind, first, size in self.entries:
            if kind != 2:
                continue
            if size >= self.cutoff:
                yield name, b"".join(map(self.sector, self.chain(first, self.fat)))[:size]
            else:
                yield name, b"".join(self.small_data[n * self.small : (n + 1) * self.small] for n in self.chain(first, self.small_fat))[:size]


def thumbnails(data: bytes) -> list[tuple[int, str, int, bytes | None]]:
    """(id, name, modified in microseconds since 1970, picture) of a thumbnail database; a picture that is missing is None.

    The catalog lists ids, times and names; the picture of an id is the stream named by its digits in reverse.
    """
    streams = dict(Compound(data).streams())
    catalog = streams.get("Catalog", b"")
    if len(catalog) < 16:
        return []
    head, _, count = struct.unpack_from("<HHI", catalog)
    out, at = [], head
    for _ in range(count):
        if at + 16 > len(catalog):
            break
        size, number, when = struct.unpack_from("<IIQ", catalog, at)
        name = catalog[at + 16 : at + size].decode("utf-16-le", "replace").split("\0")[0]
        picture = streams.get(str(number)[::-1])
        if picture is not None:
            start = picture.find(b"\xff\xd8")
            picture = picture[start:] if start >= 0 else None
        out.append((number, name, when // 10 - EPOCH_GAP, picture))
        if size < 16:
            break
        at += size
    return out


def read_thumbnails(files: DataFrame) -> DataFrame:
    """(path, id, name, modified, jpeg) of thumbnail databases (path, content); files of another kind give no rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple] = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                data = bytes(content) if content is not None else b""
                if data[:8] == MAGIC:
                    rows += [(path, *t) for t in thumbnails(data)]
            yield pd.DataFrame(rows, columns=["path", "id", "name", "us", "jpeg"])

    got = files.select("path", "content").mapInPandas(run, "path string, id bigint, name string, us bigint, jpeg binary")
    return got.select("path", "id", "name", F.timestamp_micros("us").alias("modified"), "jpeg")
