"""A reader of baseline JPEG pictures: 8 bits, Huffman coded, grey or YCbCr.

The entropy-coded bits are walked in plain Python, a table look-up a symbol; all
that follows, from dequantisation to colours, is numpy over whole planes.
"""

from __future__ import annotations

import struct

import numpy as np

#: Where the n-th coefficient of a block stands: along anti-diagonals, turning at the edges.
ZIGZAG = [8 * r + c for s in range(15) for r, c in sorted(((i, s - i) for i in range(8) if 0 <= s - i < 8), reverse=s % 2 == 0)]
#: Rows are cosines: a block is COSINES.T @ coefficients @ COSINES.
COSINES = np.array([[(0.125**0.5 if k == 0 else 0.5) * np.cos((2 * x + 1) * k * np.pi / 16) for x in range(8)] for k in range(8)])


class Unsupported(ValueError):
    """A picture of another kind."""


def _table(counts: bytes, symbols: bytes) -> list[tuple[int, int]]:
    """(length, symbol) of the code that each 16 bits begin with; length 0 for none."""
    out, at, code = [(0, 0)] * (1 << 16), 0, 0
    for length, n in enumerate(counts, 1):
        for symbol in symbols[at : at + n]:
            first = code << (16 - length)
            out[first : first + (1 << (16 - length))] = [(length, symbol)] * (1 << (16 - length))
            code += 1
        at, code = at + n, code << 1
    return out


def _scan(body: bytes, blocks: list[tuple[int, list, list]], units: int) -> list[list[int]]:
    """Coefficients of each block, in order, of one interval without restarts.

    blocks: (component, DC table, AC table) of one unit's blocks.
    """
    data = body.replace(b"\xff\x00", b"\xff") + b"\xff" * 8
    words = np.frombuffer(data, np.uint8).astype(np.int64)
    words = ((words[:-3] << 24) | (words[1:-2] << 16) | (words[2:-1] << 8) | words[3:]).tolist()
    at, limit = 0, 8 * (len(data) - 8) + 32
    before: dict[int, int] = {}
    out = []
    for _ in range(units):
        for component, dc, ac in blocks:
            own = [0] * 64
            k, table = 0, dc
            while k < 64:
                length, symbol = table[(words[at >> 3] >> (16 - (at & 7))) & 0xFFFF]
                if not length or at > limit:
                    raise ValueError("broken picture")
                at += length
                run, size = (symbol >> 4, symbol & 15) if k else (0, symbol)
                if k and not size:
                    if run < 15:
                        break
                    k += 16
                    continue
                k += run
                value = 0
                if size:
                    value = (words[at >> 3] >> (32 - size - (at & 7))) & ((1 << size) - 1) if size + (at & 7) <= 32 else 0
                    at += size
                    if not value >> (size - 1):
                        value -= (1 << size) - 1
                if not k:
                    value += before.get(component, 0)
                    before[component] = value
                    table = ac
                if k > 63:
                    raise ValueError("broken picture")
                own[ZIGZAG[k]] = value
                k += 1
            out.append(own)
    return out


def decode(data: bytes) -> np.ndarray:
    """Rows x columns x RGB."""
    quant: dict[int, np.ndarray] = {}
    huffman: dict[int, list] = {}
    frame, restart, at = None, 0, 2
    while True:
        while data[at] == 0xFF and data[at + 1] == 0xFF:
            at += 1
        mark, n = struct.unpack(">xBH", data[at : at + 4])
        body, at = data[at + 4 : at + 2 + n], at + 2 + n
        if mark == 0xDB:
            while body:
                wide = body[0] >> 4
                values = np.frombuffer(body[1 : 65 + 64 * wide], ">u2" if wide else "u1")
                quant[body[0] & 15] = np.zeros(64)
                quant[body[0] & 15][ZIGZAG] = values
                body = body[65 + 64 * wide :]
        elif mark == 0xC4:
            while body:
                total = sum(body[1:17])
                huffman[body[0]] = _table(body[1:17], body[17 : 17 + total])
                body = body[17 + total :]
        elif mark == 0xDD:
            restart = struct.unpack(">H", body)[0]
        elif mark in (0xC0, 0xC1):
            depth, height, width, parts = struct.unpack(">BHHB", body[:6])
            frame = {body[6 + 3 * i]: (body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(parts)}
            if depth != 8 or parts not in (1, 3) or not width or not height:
                raise Unsupported("not a grey or colour picture of 8 bits")
        elif 0xC0 < mark < 0xD0 and mark != 0xC8 and mark != 0xCC:
            raise Unsupported("not a baseline picture")
        elif mark == 0xDA:
            break
    if frame is None or body[0] != len(frame):
        raise Unsupported("not all components in one scan")
    tables = {body[1 + 2 * i]: (huffman[body[2 + 2 * i] >> 4], huffman[16 + (body[2 + 2 * i] & 15)]) for i in range(body[0])}
    if len(frame) == 1:
        frame = {c: (1, 1, q) for c, (_, _, q) in frame.items()}
    most_h, most_v = max(f[0] for f in frame.values()), max(f[1] for f in frame.values())
    across, down = -(-width // (8 * most_h)), -(-height // (8 * most_v))
    blocks = [(c, *tables[c]) for c, (h, v, _) in frame.items() for _ in range(h * v)]
    coded = bytearray()
    parts, i = [], at
    while i < len(data) - 1:  # up to the next marker that is no restart
        j = data.find(b"\xff", i)
        if j < 0 or j == len(data) - 1:
            coded += data[i:]
            break
        coded += data[i:j]
        if data[j + 1] == 0:
            coded += b"\xff\x00"
        elif 0xD0 <= data[j + 1] <= 0xD7:
            parts.append(bytes(coded))
            coded = bytearray()
        else:
            break
        i = j + 2
    parts.append(bytes(coded))
    left, rows = across * down, []
    for part in parts:
        n = min(left, restart or left)
        rows += _scan(part, blocks, n)
        left -= n
    every = np.array(rows, np.float64).reshape(across * down, len(blocks), 8, 8)
    if left or len(every) != across * down:
        raise ValueError("broken picture")
    planes, first = [], 0
    for h, v, q in frame.values():
        own = every[:, first : first + h * v] * quant[q].reshape(8, 8)
        pixels = np.clip(np.rint(COSINES.T @ own @ COSINES) + 128, 0, 255)
        plane = pixels.reshape(down, across, v, h, 8, 8).transpose(0, 2, 4, 1, 3, 5).reshape(down * v * 8, across * h * 8)
        planes.append(plane.repeat(most_v // v, axis=0).repeat(most_h // h, axis=1)[:height, :width])
        first += h * v
    if len(planes) == 1:
        return np.repeat(planes[0][:, :, None], 3, axis=2).astype(np.uint8)
    y, cb, cr = planes[0], planes[1] - 128, planes[2] - 128
    return np.clip(np.rint(np.stack([y + 1.402 * cr, y - 0.344136 * cb - 0.714136 * cr, y + 1.772 * cb], axis=2)), 0, 255).astype(np.uint8)
