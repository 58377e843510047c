import pytest
import hashlib
import random
import struct

import numpy as np
from pyspark.sql import functions as F

from millrace.functions import images
from millrace.operators import dedup


def _picture(h=60, w=90, seed=1):
    return np.random.default_rng(seed).integers(0, 256, (h, w, 3), np.uint8)


def _bmp(p):
    h, w, _ = p.shape
    rows = [r[:, ::-1].tobytes() + b"\0" * (-w * 3 % 4) for r in p[::-1]]
    body = b"".join(rows)
    return b"BM" + struct.pack("<IHHI", 54 + len(body), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0) + body


def test_decoders_round_trip():
    p = _picture()
    assert (images.decode(images.encode_png(p)) == p).all()
    assert (images.decode(_bmp(p)) == p).all()
    assert images.decode(b"junk") is None and images.decode(None) is None


def test_descriptors(spark):
    p = _picture()
    df = spark.createDataFrame([(1, bytearray(images.encode_png(p))), (2, bytearray(b"junk")), (3, None)], "i int, content binary")
    rows = df.select("i", images.descriptors(F.col("content")).alias("d")).orderBy("i").select("d.*").collect()
    plane = images.grey(p)
    small = images.resize(plane, 9, 8)
    assert (rows[0].w, rows[0].h) == (90, 60)
    assert rows[0].bits == "".join("1" if small[y, x] < small[y, x + 1] else "0" for y in range(8) for x in range(8))
    padded = np.pad(plane.astype(float), 1, mode="reflect")
    lap = [padded[y - 1, x] + padded[y + 1, x] + padded[y, x - 1] + padded[y, x + 1] - 4 * padded[y, x] for y in range(1, 61) for x in range(1, 91)]
    assert abs(rows[0].sharpness - np.var(lap)) < 1e-6
    assert tuple(rows[1]) == (None, None, 0.0, "") == tuple(rows[2])


def test_normalised(spark):
    df = spark.createDataFrame([(bytearray(images.encode_png(_picture(30, 60))),), (None,)], "content binary")
    out = [r[0] for r in df.select(images.normalised(F.col("content"), 64, 48)).collect()]
    canvas = images.decode(bytes(out[0]))
    assert canvas.shape == (48, 64, 3) and not canvas[:8].any() and not canvas[40:].any() and canvas[8:40].any() and out[1] is None


def test_sniff_and_geometry(spark):
    df = spark.createDataFrame([(bytearray(images.encode_png(_picture())),), (bytearray(_bmp(_picture())),), (bytearray(b"GIF89a"),), (bytearray(b""),)], "c binary")
    assert [r[0] for r in df.select(images.sniff(F.col("c"))).collect()] == ["png", "bmp", "gif", None]
    assert [r[0] for r in df.select(images.is_allowed_format(images.sniff(F.col("c")))).collect()] == [True, True, False, False]
    box = spark.range(1).select(images.letterbox(F.lit(2000), F.lit(1000)).alias("b")).select("b.*").first()
    assert tuple(box) == (1024, 512, 0, 128)


def test_hashes(spark, column):
    grey = list(range(72))
    df = spark.createDataFrame([(grey,), (grey[::-1],)], "g array<int>")
    bits = [r[0] for r in df.select(images.gradient_bits(F.col("g"))).collect()]
    assert bits == ["1" * 64, "0" * 64]
    assert column(images.hash_of_bits, ["1" * 64]) == [hashlib.md5(b"1" * 64).hexdigest()[:16]]
    assert column(images.bits_to_long, ["0" * 63 + "1", "1" * 64]) == [1, -1]
    assert column(images.hex_distance, [("abc", "abd"), ("", "a"), ("ab", "abc")], "a string, b string") == [1, 999, 999]


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    other = [b ^ sum(1 << i for i in rng.sample(range(64), rng.randrange(0, 8))) for b in base]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    a = spark.createDataFrame([(i, signed(b)) for i, b in enumerate(base)], "id long, bits long")
    b = spark.createDataFrame([(i, signed(b)) for i, b in enumerate(other)], "id long, bits long")
    got = {(r.l_id, r.r_id, r.distance) for r in dedup.near_pairs(a, b, "id", "id").collect()}
    want = {(i, j, (x ^ y).bit_count()) for i, x in enumerate(base) for j, y in enumerate(other) if (x ^ y).bit_count() <= 4}
    assert got == want and want


@pytest.mark.parametrize("most", [0, 1, 4, 7])
def test_near_pairs_are_merged_and_found_once(spark, most):
    """Small tables too: keys are many times the rows, and a broadcast gathers them on the driver."""
    rng = random.Random(most)
    base = [0, -1, 1 << 62, *(rng.getrandbits(64) - (1 << 63) for _ in range(60))]
    turn = lambda x, n: ((x & (1 << 64) - 1) ^ sum(1 << i for i in rng.sample(range(64), n)))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    other = [signed(turn(b, n)) for b in base for n in (0, 1, 2, 4, 5, 7, 8)]
    a = spark.createDataFrame([*enumerate(base), (900, base[3]), (901, None)], "id long, bits long")
    b = spark.createDataFrame([*enumerate(other), (901, None)], "id long, bits long")
    pairs = dedup.near_pairs(a, b, "id", "id", most=most)
    got = sorted(tuple(r) for r in pairs.collect())
    holder = {}
    for i, x in enumerate(other):
        holder.setdefault(x, i)
    far = lambda x, y: ((x ^ y) & (1 << 64) - 1).bit_count()
    assert got == sorted((i, j, far(x, y)) for i, x in enumerate(base) for y, j in holder.items() if far(x, y) <= most)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


@pytest.mark.parametrize("kind", ["colour", "grey", "small", "noise"])
def test_jpeg_equals_the_jvm(spark, kind):
    """Pictures written and read by the JVM, against the own reader."""
    jvm = spark.sparkContext._jvm
    w, h = (5, 3) if kind == "small" else (61, 45)
    rng = np.random.default_rng(3)
    y, x = np.mgrid[0:h, 0:w]
    pixels = np.stack([x * 4 % 256, y * 5 % 256, (x + y) * 2 % 256], axis=2)
    if kind == "noise":
        pixels = rng.integers(0, 256, (h, w, 1)).repeat(3, axis=2)
    image = jvm.java.awt.image.BufferedImage(w, h, 10 if kind == "grey" else 1)
    for j in range(h):
        for i in range(w):
            r, g, b = (int(v) for v in (pixels[j, i] if kind != "grey" else [pixels[j, i, 0]] * 3))
            if kind == "grey":
                image.getRaster().setSample(i, j, 0, r)
            else:
                image.setRGB(i, j, (255 << 24 | r << 16 | g << 8 | b) - (1 << 32))
    out = jvm.java.io.ByteArrayOutputStream()
    assert jvm.javax.imageio.ImageIO.write(image, "jpg", out)
    data = bytes(out.toByteArray())
    back = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(bytearray(data)))
    want = np.array([[[(v >> s) & 255 for s in (16, 8, 0)] for v in (back.getRGB(i, j) for i in range(w))] for j in range(h)])
    if kind == "grey":  # as stored, not as a screen shows it
        want = np.array([[[back.getRaster().getSample(i, j, 0)] * 3 for i in range(w)] for j in range(h)])
    got = images.decode(data)
    assert got.shape == (h, w, 3)
    off = np.abs(got.astype(int) - want)
    assert off.mean() < (4 if kind != "grey" else 1) and np.abs(images.grey(got) - images.grey(want.astype(np.uint8))).mean() < 3
    assert images.decode(data[: len(data) // 2]) is None or images.decode(data[: len(data) // 2]).shape == (h, w, 3)
    assert images.decode(data[:2] + b"\xff\xc2" + data[4:]) is None
