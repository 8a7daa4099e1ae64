"""PNG pixels: decoding and differences, for visual checks."""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Difference of a channel from which on a pixel counts as changed.
PIXEL_DIFFERENCE = 24


def decode_png(data: bytes) -> np.ndarray:
    """(height, width, channels) of an 8-bit grey, RGB or RGBA image without interlacing."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("no PNG")
    at, packed = 8, b""
    width = height = channels = 0
    while at < len(data):
        (n,) = struct.unpack(">I", data[at : at + 4])
        kind, body = data[at + 4 : at + 8], data[at + 8 : at + 8 + n]
        at += 12 + n
        if kind == b"IHDR":
            width, height, depth, colour, _, _, lace = struct.unpack(">IIBBBBB", body)
            if depth != 8 or lace or colour not in (0, 2, 4, 6):
                raise ValueError("unsupported PNG")
            channels = {0: 1, 2: 3, 4: 2, 6: 4}[colour]
        elif kind == b"IDAT":
            packed += body
    raw = np.frombuffer(zlib.decompress(packed), dtype=np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width * channels), dtype=np.uint8)
    above = np.zeros(width * channels, dtype=np.int32)
    for y in range(height):
        kind, line = raw[y, 0], raw[y, 1:].astype(np.int32)
        if kind == 0:
            now = line
        elif kind == 2:
            now = (line + above) & 255
        else:
            now = np.zeros_like(line)
            for x in range(len(line)):
                a = now[x - channels] if x >= channels else 0
                b = above[x]
                c = above[x - channels] if x >= channels else 0
                if kind == 1:
                    guess = a
                elif kind == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - c
                    guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                now[x] = (line[x] + guess) & 255
        out[y] = now
        above = now
    return out.reshape(height, width, channels)


def difference(a: np.ndarray, b: np.ndarray, threshold: int = PIXEL_DIFFERENCE) -> float:
    """Share of pixels that differ; what only one of the images covers counts as different."""
    h, w = max(a.shape[0], b.shape[0]), max(a.shape[1], b.shape[1])
    if not h or not w:
        return 0.0
    ch, cw = min(a.shape[0], b.shape[0]), min(a.shape[1], b.shape[1])
    n = min(a.shape[2], b.shape[2], 3)
    d = np.abs(a[:ch, :cw, :n].astype(int) - b[:ch, :cw, :n].astype(int)).max(axis=2) > threshold
    return float((d.sum() + h * w - ch * cw) / (h * w))
