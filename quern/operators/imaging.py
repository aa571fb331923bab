"""Images: decode checks, pixel statistics, difference hashes, masks, over Spark's image source."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

BLANK_STD = 1.0


def gray(data: bytes, width: int, height: int, channels: int) -> np.ndarray:
    """Pixels of Spark's image source (rows of BGR or BGRA, or gray) as 8-bit gray."""
    a = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    if channels == 1:
        return a[:, :, 0]
    b, g, r = (a[:, :, k].astype(np.uint32) for k in range(3))
    return ((r * 299 + g * 587 + b * 114 + 500) // 1000).astype(np.uint8)


def box_resize(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """Area means over a grid of ``height`` by ``width`` cells."""
    ys = np.linspace(0, pixels.shape[0], height + 1).round().astype(int)
    xs = np.linspace(0, pixels.shape[1], width + 1).round().astype(int)
    cell = lambda a, b, n: slice(min(a, n - 1), max(b, min(a, n - 1) + 1))
    return np.array([[pixels[cell(ys[i], ys[i + 1], pixels.shape[0]), cell(xs[j], xs[j + 1], pixels.shape[1])].mean() for j in range(width)] for i in range(height)])


def dhash(pixels: np.ndarray, size: int = 8) -> int:
    """Row-wise difference hash: bit set where a cell is brighter than the one left of it."""
    small = box_resize(pixels, size, size + 1)
    bits = (small[:, 1:] > small[:, :-1]).reshape(-1)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def normalise_mask(pixels: np.ndarray, threshold: int = 128) -> np.ndarray:
    """255 above the threshold, else 0."""
    return np.where(pixels > threshold, 255, 0).astype(np.uint8)


def overlay(pixels: np.ndarray, mask: np.ndarray, alpha: float = 0.4) -> np.ndarray:
    """Gray pixels as RGB, with the masked part tinted red."""
    rgb = np.repeat(pixels[:, :, None], 3, axis=2).astype(float)
    rgb[mask > 0] = (1 - alpha) * rgb[mask > 0] + alpha * np.array([255.0, 0.0, 0.0])
    return rgb.round().astype(np.uint8)


def side_by_side(left: np.ndarray, right: np.ndarray, gap: int = 2) -> np.ndarray:
    """Two images beside each other with a white bar between; the lower one is filled up with black. Gray
    ones become RGB where the other has colours."""
    if left.ndim != right.ndim:
        left, right = (p if p.ndim == 3 else np.repeat(p[:, :, None], 3, axis=2) for p in (left, right))
    height = max(len(left), len(right))
    fill = lambda p: np.pad(p, [(0, height - len(p))] + [(0, 0)] * (p.ndim - 1))
    bar = np.full((height, gap, *left.shape[2:]), 255, dtype=np.uint8)
    return np.concatenate([fill(left), bar, fill(right)], axis=1)


def png(pixels: np.ndarray) -> bytes:
    """Gray or RGB pixels as a PNG, without loss and always with the same bytes."""
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    height, width = pixels.shape[:2]
    rows = np.ascontiguousarray(pixels, dtype=np.uint8).reshape(height, -1)
    raw = b"".join(b"\0" + row.tobytes() for row in rows)
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if pixels.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw, 9)) + chunk(b"IEND", b"")


def normalised_masks(images: DataFrame, threshold: int = 128) -> DataFrame:
    """(path, n_white, pixels_sha256, png, sha256) of masks as 0 and 255: the digest of the pixels, and the
    PNG with the digest of its bytes. A file that can't be decoded has nulls. Written as a table, the PNGs
    need no other place; ``pixels_sha256`` doesn't depend on how they are packed."""
    schema = "path string, n_white long, pixels_sha256 string, png binary, sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if (r["width"] or -1) < 0:
                    rows.append((r["path"], None, None, None, None))
                    continue
                mask = normalise_mask(gray(r["data"], r["width"], r["height"], r["channels"]), threshold)
                packed = png(mask)
                rows.append((r["path"], int((mask > 0).sum()), hashlib.sha256(mask.tobytes()).hexdigest(), packed, hashlib.sha256(packed).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["path", "n_white", "pixels_sha256", "png", "sha256"])

    return images.select("path", "width", "height", "channels", "data").mapInArrow(run, schema)


def read_images(spark, path: str) -> DataFrame:
    """(path, width, height, channels, data) of every file; a file that can't be decoded has width -1."""
    return spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True).load(path).select("image.origin", "image.width", "image.height", F.col("image.nChannels").alias("channels"), "image.data").withColumnRenamed("origin", "path")


def validate(images: DataFrame, expected: tuple[int, int]) -> DataFrame:
    """(path, width, height, min, max, mean, std, dhash, reasons).

    An unreadable file has that reason alone; others may have wrong dimensions and be blank or
    constant (maximum 0, or standard deviation below 1).
    """
    schema = T.StructType([
        T.StructField("path", T.StringType()), T.StructField("width", T.IntegerType()), T.StructField("height", T.IntegerType()),
        T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType()), T.StructField("mean", T.DoubleType()), T.StructField("std", T.DoubleType()),
        T.StructField("dhash", T.LongType()), T.StructField("reasons", T.ArrayType(T.StringType())),
    ])
    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.float64()] * 4, pa.int64(), pa.list_(pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if (r["width"] or -1) < 0:
                    rows.append((r["path"], -1, -1, None, None, None, None, None, ["unreadable"]))
                    continue
                p = gray(r["data"], r["width"], r["height"], r["channels"])
                reasons = [f"wrong-dimensions:({r['width']}, {r['height']})"] if (r["width"], r["height"]) != expected else []
                reasons += ["blank-or-constant"] if p.max() == 0 or p.std() < BLANK_STD else []
                rows.append((r["path"], r["width"], r["height"], float(p.min()), float(p.max()), float(p.mean()), float(p.std()), dhash(p), reasons))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=schema.names)

    return images.mapInArrow(run, schema)
