"""Thumbnail databases written here, read back."""

from __future__ import annotations

import datetime
import struct

import pytest

from restitch.sources import compound


def build(streams: dict[str, bytes]) -> bytes:
    """A compound file of 512-byte sectors; streams under 4,096 bytes go to 64-byte sectors of the root's stream."""
    free, end, table = 0xFFFFFFFF, 0xFFFFFFFE, 0xFFFFFFFD
    fat: list[int] = []
    sectors: list[bytes] = []

    def put(data: bytes) -> int:
        first = len(sectors)
        parts = [data[i : i + 512].ljust(512, b"\0") for i in range(0, len(data), 512)] or [b"\0" * 512]
        for k, p in enumerate(parts):
            sectors.append(p)
            fat.append(len(sectors) if k + 1 < len(parts) else end)
        return first

    small, small_fat, where = b"", [], {}
    for name, data in streams.items():
        if len(data) >= 4096:
            where[name] = put(data)
            continue
        n = max(1, -(-len(data) // 64))
        where[name] = len(small_fat)
        small_fat += [len(small_fat) + k + 1 for k in range(n - 1)] + [end]
        small += data.ljust(n * 64, b"\0")
    root = put(small) if small else end
    mini = put(struct.pack(f"<{len(small_fat)}I", *small_fat).ljust(512, b"\xff")) if small_fat else end

    def entry(name: str, kind: int, first: int, size: int) -> bytes:
        raw = name.encode("utf-16-le") + b"\0\0"
        return raw.ljust(64, b"\0") + struct.pack("<HBB", len(raw), kind, 1) + b"\xff" * 12 + b"\0" * 36 + struct.pack("<III", first, size, 0)

    directory = put(b"".join([entry("Root Entry", 5, root, len(small)), *[entry(n, 2, where[n], len(d)) for n, d in streams.items()]]))
    fat_at = len(sectors)
    fat.append(table)
    sectors.append(struct.pack(f"<{len(fat)}I", *fat).ljust(512, b"\xff"))
    head = compound.MAGIC + b"\0" * 16 + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + b"\0" * 10
    head += struct.pack("<I I I I I I I I", 1, directory, 0, 4096, mini, 1 if small_fat else 0, end, 0)
    head += struct.pack("<109I", fat_at, *[free] * 108)
    return head.ljust(512, b"\0") + b"".join(sectors)


def catalog(entries: list[tuple[int, str, datetime.datetime]]) -> bytes:
    out = struct.pack("<HHI", 16, 5, len(entries)) + b"\0" * 8
    for number, name, when in entries:
        ticks = int((when - datetime.datetime(1601, 1, 1)).total_seconds() * 10**7)
        raw = name.encode("utf-16-le") + b"\0\0\0\0"
        out += struct.pack("<IIQ", 16 + len(raw), number, ticks) + raw
    return out


WHEN = datetime.datetime(2004, 5, 6, 7, 8, 9)


def test_thumbnails_are_read_from_both_kinds_of_sectors(spark):
    large, little = b"\x0c\0\0\0xxxxxxxx\xff\xd8" + bytes(range(256)) * 40, b"\x0c\0\0\0\xff\xd8tiny\xff\xd9"
    data = build({"Catalog": catalog([(1, "a.jpg", WHEN), (12, "bild ü.gif", WHEN), (3, "lost.png", WHEN)]), "1": little, "21": large})
    got = compound.thumbnails(data)
    assert [(i, n, p) for i, n, _, p in got] == [(1, "a.jpg", little[4:]), (12, "bild ü.gif", large[12:]), (3, "lost.png", None)]
    files = spark.createDataFrame([("t/Thumbs.db", data), ("x.txt", b"plain"), ("n", None)], "path string, content binary")
    rows = compound.read_thumbnails(files).collect()
    assert len(rows) == 3 and {r.path for r in rows} == {"t/Thumbs.db"} and rows[0].modified.replace(tzinfo=None) == WHEN


def test_broken_compound_files():
    with pytest.raises(ValueError, match="no compound"):
        compound.Compound(b"nothing")
    assert compound.thumbnails(build({"Other": b"x" * 5000})) == [] and list(compound.Compound.chain(0, [1, 2, 0])) == [0, 1, 2]
