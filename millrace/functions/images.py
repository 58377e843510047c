"""Image functions.  Geometry, formats and hashes are built-ins; pixels need Arrow UDFs.

Pictures are decoded by the imaging library where it is installed, else by own
readers of PNG (8 bits, not interlaced), BMP (24 or 32 bits) and baseline JPEG.  What
can't be read has hash "", sharpness 0.0 and no size, as the filters expect.
"""

from __future__ import annotations

import io
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import jpeg

FORMATS = ("jpeg", "png", "webp", "bmp")


def file_sha1(content: Column) -> Column:
    return F.sha1(content)


def sniff(content: Column) -> Column:
    """jpeg, png, webp, bmp or gif by the first bytes, else null."""
    first = F.hex(F.substring(content, 1, 12))
    return (
        F.when(first.startswith("FFD8FF"), "jpeg")
        .when(first.startswith("89504E470D0A1A0A"), "png")
        .when(first.startswith("52494646") & (F.substring(first, 17, 8) == "57454250"), "webp")
        .when(first.startswith("424D"), "bmp")
        .when(first.startswith("474946383761") | first.startswith("474946383961"), "gif")
    )


def is_allowed_format(name: Column) -> Column:
    return F.coalesce(name.isin(*FORMATS), F.lit(False))


def letterbox(width: Column, height: Column, to_width: int = 1024, to_height: int = 768) -> Column:
    """A struct of the scaled size and the offsets that centre it."""
    scale = F.least(F.lit(float(to_width)) / width, F.lit(float(to_height)) / height)
    w, h = F.floor(width * scale).cast("int"), F.floor(height * scale).cast("int")
    return F.struct(w.alias("new_w"), h.alias("new_h"), F.floor((F.lit(to_width) - w) / 2).cast("int").alias("dx"), F.floor((F.lit(to_height) - h) / 2).cast("int").alias("dy"))


def gradient_bits(grey: Column, side: int = 8) -> Column:
    """The 0/1 string of a flat array of ``side`` rows of ``side`` + 1 grey values: left < right."""
    places = F.sequence(F.lit(0), F.lit(side * side - 1))
    at = lambda i: F.floor(i / side).cast("int") * (side + 1) + i % side
    return F.array_join(F.transform(places, lambda i: F.when(F.get(grey, at(i)) < F.get(grey, at(i) + 1), "1").otherwise("0")), "")


def hash_of_bits(bits: Column) -> Column:
    """The exact-match form of a gradient hash: MD5 of the bits, 16 digits."""
    return F.substring(F.md5(bits.cast("binary")), 1, 16)


def bits_to_long(bits: Column) -> Column:
    """64 bits as a long, for true Hamming distances."""
    return F.aggregate(
        F.split(bits, ""), F.lit(0).cast("long"), lambda a, b: F.when(b == "", a).otherwise(F.shiftleft(a, 1).bitwiseOR(F.when(b == "1", F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))))
    )


def hex_distance(a: Column, b: Column) -> Column:
    """Places where two hexadecimal hashes differ; 999 if one is empty or lengths differ."""
    differ = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x != y).cast("int")), F.lit(0), lambda n, x: n + x)
    return F.when((F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "") | (F.length(a) != F.length(b)), 999).otherwise(differ)


def hamming(a: Column, b: Column) -> Column:
    """Bits that differ in two longs."""
    return F.bit_count(a.bitwiseXOR(b))


def _png(data: bytes) -> np.ndarray:
    at, parts, palette, head = 8, [], None, None
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + n]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            parts.append(body)
        at += 12 + n
    w, h, depth, colour, _, _, laced = head
    if depth != 8 or laced:
        raise ValueError("unsupported PNG")
    n = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    flat = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(h, 1 + w * n)
    out = np.zeros((h, w * n), np.uint8)
    for y in range(h):
        kind, line = flat[y, 0], flat[y, 1:].astype(np.int32)
        up = out[y - 1].astype(np.int32) if y else np.zeros(w * n, np.int32)
        if kind == 0:
            out[y] = line
        elif kind == 2:
            out[y] = (line + up) & 255
        elif kind == 1:
            out[y] = np.cumsum(line.reshape(w, n), axis=0).reshape(-1) & 255
        else:  # average and Paeth look at what they have just made
            row = [0] * (w * n)
            for x in range(w * n):
                left, above, corner = row[x - n] if x >= n else 0, int(up[x]), int(up[x - n]) if x >= n else 0
                if kind == 3:
                    guess = (left + above) // 2
                else:
                    p = left + above - corner
                    guess = min((left, above, corner), key=lambda v: abs(p - v))
                row[x] = (int(line[x]) + guess) & 255
            out[y] = row
    pixels = out.reshape(h, w, n)
    if colour == 3:
        return palette[pixels[:, :, 0]]
    return np.repeat(pixels[:, :, :1], 3, axis=2) if n < 3 else pixels[:, :, :3]


def _bmp(data: bytes) -> np.ndarray:
    start, w, h, _, depth, packed = struct.unpack("<10xI4xiiHHI", data[:34])
    if depth not in (24, 32) or packed not in (0, 3):
        raise ValueError("unsupported BMP")
    stride = (w * depth // 8 + 3) // 4 * 4
    rows = np.frombuffer(data, np.uint8, stride * abs(h), start).reshape(abs(h), stride)[:, : w * depth // 8]
    rows = rows.reshape(abs(h), w, depth // 8)[:, :, 2::-1]
    return rows[::-1] if h > 0 else rows


def decode(data: bytes | None) -> np.ndarray | None:
    """Rows x columns x RGB, or None."""
    if not data:
        return None
    try:
        try:
            from PIL import Image
        except ImportError:
            return _png(data) if data[:4] == b"\x89PNG" else _bmp(data) if data[:2] == b"BM" else jpeg.decode(data) if data[:3] == b"\xff\xd8\xff" else None
        picture = Image.open(io.BytesIO(data))
        return np.asarray((picture.convert("RGBA") if picture.mode == "P" and "transparency" in picture.info else picture).convert("RGB"))
    except Exception:
        return None


def grey(pixels: np.ndarray) -> np.ndarray:
    """Luma of RGB, whole numbers."""
    r, g, b = (pixels[:, :, i].astype(np.int64) for i in range(3))
    return (r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16


def _weights(n: int, to: int, radius: float = 3.0) -> np.ndarray:
    """to x n weights of a Lanczos window, widened when shrinking."""
    scale = max(1.0, n / to)
    centre = (np.arange(to) + 0.5) * n / to
    x = (np.arange(n) + 0.5 - centre[:, None]) / scale
    w = np.where(np.abs(x) < radius, np.sinc(x) * np.sinc(x / radius), 0)
    return w / w.sum(axis=1, keepdims=True)


def resize(plane: np.ndarray, width: int, height: int) -> np.ndarray:
    """A grey plane at another size, rounded to 0..255."""
    across = np.clip(np.rint(plane @ _weights(plane.shape[1], width).T), 0, 255)
    return np.clip(np.rint(_weights(plane.shape[0], height) @ across), 0, 255).astype(np.int64)


def laplacian_variance(plane: np.ndarray) -> float:
    """Variance of the 4-neighbour Laplacian, edges mirrored without repeating them."""
    p = np.pad(plane.astype(np.float64), 1, mode="reflect") if min(plane.shape) > 1 else np.pad(plane.astype(np.float64), 1, mode="edge")
    return float((p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * p[1:-1, 1:-1]).var())


def encode_png(pixels: np.ndarray) -> bytes:
    """RGB as a PNG."""
    h, w, _ = pixels.shape
    raw = np.concatenate([np.zeros((h, 1), np.uint8), pixels.reshape(h, w * 3).astype(np.uint8)], axis=1).tobytes()
    chunk = lambda k, b: struct.pack(">I", len(b)) + k + b + struct.pack(">I", zlib.crc32(k + b))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def _descriptors(content: pd.Series) -> pd.DataFrame:
    out = []
    for data in content:
        pixels = decode(None if data is None else bytes(data))
        if pixels is None:
            out.append((None, None, 0.0, "", None))
            continue
        plane = grey(pixels)
        small = resize(plane, 9, 8)
        bits = "".join("1" if a else "0" for a in (small[:, :-1] < small[:, 1:]).ravel())
        out.append((pixels.shape[1], pixels.shape[0], laplacian_variance(plane), bits, None))
    return pd.DataFrame(out, columns=["w", "h", "sharpness", "bits", "_"]).drop(columns="_").astype({"w": "Int32", "h": "Int32"})


def descriptors(content: Column) -> Column:
    """A struct of w, h, sharpness and gradient bits of each picture."""
    return F.pandas_udf(_descriptors, "w int, h int, sharpness double, bits string")(content)


def normalised(content: Column, to_width: int = 1024, to_height: int = 768) -> Column:
    """Each picture scaled and centred on black, as PNG; null if it can't be read."""

    def one(data: bytes | None) -> bytes | None:
        pixels = decode(None if data is None else bytes(data))
        if pixels is None:
            return None
        h, w, _ = pixels.shape
        scale = min(to_width / w, to_height / h)
        nw, nh = int(w * scale), int(h * scale)
        if not nw or not nh:
            return None
        canvas = np.zeros((to_height, to_width, 3), np.uint8)
        x, y = (to_width - nw) // 2, (to_height - nh) // 2
        canvas[y : y + nh, x : x + nw] = np.stack([resize(pixels[:, :, c], nw, nh) for c in range(3)], axis=2)
        return encode_png(canvas)

    def run(content: pd.Series) -> pd.Series:
        return content.map(one)

    return F.pandas_udf(run, "binary")(content)
