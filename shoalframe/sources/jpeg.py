"""Baseline JPEG, as cameras and archives write it: Huffman-coded, 8 bits, grey or YCbCr."""

from __future__ import annotations

import struct

import numpy as np


class Unsupported(ValueError):
    """A well-formed file of a kind that isn't read."""


def _zigzag() -> np.ndarray:
    """Places of the coefficients in a row-wise 8 x 8 block: along the anti-diagonals, in turns up and down."""
    cells = sorted(((y, x) for y in range(8) for x in range(8)), key=lambda c: (c[0] + c[1], c[0] if (c[0] + c[1]) % 2 else c[1]))
    return np.array([8 * y + x for y, x in cells])


_ORDER = _zigzag().tolist()
_COS = np.array([[np.sqrt((1 if u == 0 else 2) / 8) * np.cos((2 * x + 1) * u * np.pi / 16) for x in range(8)] for u in range(8)])


def _codes(body: bytes) -> tuple[dict[tuple[int, int], int], int]:
    """(length, code) to symbol of one table, and the bytes it takes."""
    sizes = body[:16]
    out, code, at = {}, 0, 16
    for length, n in enumerate(sizes, 1):
        for _ in range(n):
            out[length, code] = body[at]
            code, at = code + 1, at + 1
        code <<= 1
    return out, at


class _Bits:
    def __init__(self, data: bytes):
        self.data, self.at, self.value, self.left = data, 0, 0, 0

    def take(self, n: int) -> int:
        while self.left < n:
            self.value = self.value << 8 | (self.data[self.at] if self.at < len(self.data) else 0xFF)
            self.at, self.left = self.at + 1, self.left + 8
            if self.at > len(self.data) + 64:
                raise ValueError("the picture ends early")
        self.left -= n
        out = self.value >> self.left
        self.value &= (1 << self.left) - 1
        return out

    def symbol(self, codes: dict[tuple[int, int], int]) -> int:
        code = 0
        for length in range(1, 17):
            code = code << 1 | self.take(1)
            if (found := codes.get((length, code))) is not None:
                return found
        raise ValueError("no such code")

    def number(self, size: int) -> int:
        v = self.take(size) if size else 0
        return v if not size or v >> size - 1 else v - (1 << size) + 1


def _block(bits: _Bits, dc: dict, ac: dict, before: int) -> list[int]:
    out = [0] * 64
    out[0] = before + bits.number(bits.symbol(dc))
    k = 1
    while k < 64:
        s = bits.symbol(ac)
        if s & 15:
            k += s >> 4
            if k > 63:
                raise ValueError("a block of over 64 numbers")
            out[_ORDER[k]] = bits.number(s & 15)
            k += 1
        elif s == 0xF0:
            k += 16
        else:
            break
    return out


def decode(data: bytes) -> np.ndarray:
    """(height, width, 1 or 3): grey, or red, green, blue."""
    at, tables, codes, parts, restart = 2, {}, {}, [], 0
    while True:
        while data[at] != 0xFF or data[at + 1] == 0xFF:
            at += 1
        kind, n = data[at + 1], struct.unpack(">H", data[at + 2 : at + 4])[0]
        body, at = data[at + 4 : at + 2 + n], at + 2 + n
        if kind == 0xDB:
            while body:
                wide = body[0] >> 4
                tables[body[0] & 15] = np.frombuffer(body, ">u2" if wide else "u1", 64, 1).astype(int)
                body = body[1 + 64 * (1 + wide) :]
        elif kind == 0xC4:
            while body:
                table, used = _codes(body[1:])
                codes[body[0]] = table
                body = body[1 + used :]
        elif kind == 0xDD:
            restart = struct.unpack(">H", body[:2])[0]
        elif kind in (0xC0, 0xC1):
            depth, h, w, count = struct.unpack(">BHHB", body[:6])
            parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(count)]
            if depth != 8 or count not in (1, 3):
                raise Unsupported(f"JPEG of {count} channels of {depth} bits")
        elif 0xC2 <= kind <= 0xCF and kind != 0xC8:
            raise Unsupported("JPEG that isn't baseline")
        elif kind == 0xDA:
            chosen = {body[1 + 2 * i]: (body[2 + 2 * i] >> 4, body[2 + 2 * i] & 15) for i in range(body[0])}
            break
    if len(chosen) != len(parts):
        raise Unsupported("JPEG of several scans")
    # the scan, cut at its restart marks, without the zero after each 0xFF
    raw, spans, start = data[at:], [], 0
    i = raw.find(b"\xff")
    while i >= 0 and i + 1 < len(raw) and (raw[i + 1] == 0 or 0xD0 <= raw[i + 1] <= 0xD7):
        if raw[i + 1]:
            spans.append(raw[start:i])
            start = i + 2
        i = raw.find(b"\xff", i + 2)
    spans.append(raw[start : i if i >= 0 else len(raw)])
    spans = [s.replace(b"\xff\x00", b"\xff") for s in spans]
    if len(parts) == 1:  # blocks of a single channel aren't grouped
        parts = [(parts[0][0], 1, 1, parts[0][3])]
    wide, tall = max(p[1] for p in parts), max(p[2] for p in parts)
    across, down = -(-w // (8 * wide)), -(-h // (8 * tall))
    found: list[list[list[int]]] = [[] for _ in parts]
    for mcu in range(across * down):
        if mcu == 0 or restart and mcu % restart == 0:
            bits, before = _Bits(spans[mcu // restart if restart else 0]), [0] * len(parts)
        for c, (name, x, y, _) in enumerate(parts):
            dc, ac = chosen[name]
            for _ in range(x * y):
                block = _block(bits, codes[dc], codes[16 + ac], before[c])
                before[c] = block[0]
                found[c].append(block)
    planes = []
    for (_, x, y, q), blocks in zip(parts, found, strict=True):
        scale = np.zeros(64, int)
        scale[_ORDER] = tables[q]
        cells = _COS.T @ (np.array(blocks) * scale).reshape(-1, 8, 8) @ _COS
        # a group's blocks stand in rows of x
        plane = cells.reshape(down, across, y, x, 8, 8).transpose(0, 2, 4, 1, 3, 5).reshape(down * y * 8, across * x * 8)
        plane = np.repeat(np.repeat(plane, tall // y, 0), wide // x, 1)[:h, :w]
        planes.append(np.clip(np.rint(plane + 128), 0, 255))
    if len(planes) == 1:
        return planes[0][..., None].astype(np.uint8)
    y, b, r = planes[0], planes[1] - 128, planes[2] - 128
    rgb = np.stack([y + 1.402 * r, y - 0.344136 * b - 0.714136 * r, y + 1.772 * b], 2)
    return np.clip(np.rint(rgb), 0, 255).astype(np.uint8)
