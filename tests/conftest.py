from __future__ import annotations

import os
import struct
import sys
import tempfile
import zlib

import numpy as np
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMOKE = "/root/testdata/sf0.001"
SF_SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="vectable-test-ckpt-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("vectable-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def write_png(path: str, pixels: np.ndarray) -> None:
    """Minimal PNG writer (8-bit grey, RGB or RGBA), no imaging library."""
    px = np.asarray(pixels, dtype=np.uint8)
    if px.ndim == 2:
        px = px[:, :, None]
    h, w, c = px.shape
    colour = {1: 0, 3: 2, 4: 6}[c]
    raw = b"".join(b"\x00" + px[y].tobytes() for y in range(h))

    def chunk(tag: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)

    ihdr = struct.pack(">IIBBBBB", w, h, 8, colour, 0, 0, 0)
    data = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", ihdr) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


@pytest.fixture(scope="session")
def image_tree():
    """The file tree of FIXTURES.md §3 (plus a few regular images)."""
    base = tempfile.mkdtemp(prefix="vectable-images-")
    rng = np.random.default_rng(7)
    files = {}

    def img(rel, arr):
        write_png(os.path.join(base, rel), arr)
        files[rel] = np.asarray(arr, dtype=np.uint8)

    img("train/large.cell.x/0 - Copy (0).png", rng.integers(0, 256, (6, 5, 3)))
    img("train/large.cell.x/1.png", rng.integers(0, 256, (6, 5, 3)))
    img("train/normal/UP.PNG", rng.integers(0, 256, (4, 4, 3)))
    img("train/normal/a.jpg.png", rng.integers(0, 256, (3, 7, 3)))
    with open(os.path.join(base, "train/normal/bad.png"), "wb") as f:
        f.write(b"this is not an image")
    img("test/normal/grey.png", rng.integers(0, 256, (5, 5)))
    img("test/normal/rgba.png", rng.integers(0, 256, (5, 4, 4)))
    img("test/normal/flat.png", np.full((4, 4, 3), 77))
    img("test/adeno/x.png", rng.integers(0, 256, (8, 8, 3)))
    os.makedirs(os.path.join(base, "valid/empty_class"), exist_ok=True)
    with open(os.path.join(base, "valid/empty_class/placeholder"), "w") as f:
        f.write("keep")
    with open(os.path.join(base, "train/stray"), "w") as f:
        f.write("stray file beside class folders")
    img("train/normal/nested/deep.png", rng.integers(0, 256, (4, 4, 3)))
    return base, files
