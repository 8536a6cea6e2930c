"""Pixels of image regions: colour vectors and crops. PNG of 8 bits is read with zlib and numpy; other files give nulls."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimweft.functions.ids import json_string, stable_id

MODEL, SIDE = "mean_std_rgb_16", 16
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def read_png(data: bytes) -> np.ndarray | None:
    """(height, width, 3) 8-bit samples; None for what isn't a plain PNG of 8 bits a sample. Transparency is left out."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        return None
    at, body, palette, head = 8, [], None, None
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        at += 12 + size
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(part)
    if head is None or head[2] != 8 or head[3] not in CHANNELS or head[6]:
        return None
    width, height, _, color, *_ = head
    n = CHANNELS[color]
    rows = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, 1 + width * n)
    out = np.zeros((height, width * n), np.uint8)
    above = np.zeros(width * n, np.int32)
    for y in range(height):
        filter_, line = int(rows[y, 0]), rows[y, 1:].astype(np.int32)
        if filter_ == 2:
            line = (line + above) & 255
        elif filter_ == 1:
            line = np.cumsum(line.reshape(-1, n), axis=0).reshape(-1) & 255
        elif filter_ in (3, 4):
            for x in range(width * n):
                a, b, c = (int(line[x - n]) if x >= n else 0), int(above[x]), (int(above[x - n]) if x >= n else 0)
                p = a + b - c
                near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
                line[x] = (line[x] + ((a + b) // 2 if filter_ == 3 else near)) & 255
        out[y], above = line, line
    pixels = out.reshape(height, width, n)
    if color == 3:
        return None if palette is None else palette[pixels[:, :, 0]]
    return np.repeat(pixels[:, :, :1], 3, axis=2) if color in (0, 4) else pixels[:, :, :3]


def write_png(pixels: np.ndarray) -> bytes:
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    height, width, _ = pixels.shape
    rows = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(rows)) + part(b"IEND", b"")


def color_vector(pixels: np.ndarray, side: int = SIDE) -> list[float]:
    """Mean and deviation of red, green and blue, from 0 to 1, over side x side means of equal areas; six places."""

    def shrunk(a: np.ndarray, axis: int) -> np.ndarray:
        edges = np.linspace(0, a.shape[axis], side + 1)
        total = np.concatenate([np.zeros_like(a.take([0], axis)), np.cumsum(a, axis=axis)], axis=axis)
        low = np.floor(edges).astype(int)
        part = (edges - low).reshape([-1 if k == axis else 1 for k in range(a.ndim)])
        at = total.take(low, axis) + part * a.take(np.minimum(low, a.shape[axis] - 1), axis)
        return np.diff(at, axis=axis) / (a.shape[axis] / side)

    small = shrunk(shrunk(pixels.astype(np.float64) / 255.0, 0), 1).reshape(-1, 3)
    return [round(float(x), 6) for x in (*small.mean(axis=0), *small.std(axis=0))]


def _regions_of(images: DataFrame, regions: DataFrame) -> DataFrame:
    """A row an image: its file's bytes and its regions, which the grid bounds."""
    spark = images.sparkSession
    paths = [r[0] for r in images.select(F.regexp_replace("source_file", "/[^/]*$", "")).distinct().collect()]  # folders
    files = spark.read.format("binaryFile").load(paths).select("path", "content") if paths else spark.createDataFrame([], "path string, content binary")
    boxes = regions.groupBy("image_id").agg(F.collect_list(F.struct("region_id", "source_id", F.col("bbox").cast("array<int>").alias("bbox"), "risk_flags")).alias("regions"))
    return boxes.join(images.select("image_id", F.col("source_file").alias("f")), "image_id").join(files, F.col("f") == F.col("path")).select("image_id", "content", "regions")


def embeddings(regions: DataFrame, images: DataFrame) -> DataFrame:
    """Colour vectors of regions (region_id, image_id, source_id, bbox, risk_flags) of images with a readable file.

    Regions of files that can't be read have no row, as have regions of unknown images.
    """
    module = _shipped()

    def run(batches):
        for batch in batches:
            out = []
            for image, content, own in zip(*(batch.column(c).to_pylist() for c in ("image_id", "content", "regions"))):
                pixels = module["read_png"](content)
                for r in own if pixels is not None else ():
                    x, y, w, h = r["bbox"]
                    out.append((r["region_id"], image, r["source_id"], module["color_vector"](pixels[y : y + h, x : x + w]), r["risk_flags"]))
            kinds = (pa.string(), pa.string(), pa.string(), pa.list_(pa.float64()), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["region_id", "image_id", "source_id", "vector", "risk_flags"])

    rows = _regions_of(images, regions).mapInArrow(run, "region_id string, image_id string, source_id string, vector array<double>, risk_flags array<string>")
    return rows.select(embedding_id(F.col("region_id")).alias("embedding_id"), "region_id", "image_id", "source_id", F.lit(MODEL).alias("embedding_model"), "vector", "risk_flags")


def embedding_id(region: Column) -> Column:
    return stable_id("img_emb", region_id=json_string(region), embedding_model=json_string(F.lit(MODEL)))


def crops(regions: DataFrame, images: DataFrame) -> DataFrame:
    """region_id and crop (PNG bytes) of regions of images with a readable file."""
    module = _shipped()

    def run(batches):
        for batch in batches:
            out = []
            for content, own in zip(*(batch.column(c).to_pylist() for c in ("content", "regions"))):
                pixels = module["read_png"](content)
                for r in own if pixels is not None else ():
                    x, y, w, h = r["bbox"]
                    out.append((r["region_id"], module["write_png"](pixels[y : y + h, x : x + w])))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.binary())], ["region_id", "crop"])

    return _regions_of(images, regions).mapInArrow(run, "region_id string, crop binary")


def _shipped() -> dict:
    """The functions that workers need, sent by value: they need no copy of the package."""
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    return {"read_png": read_png, "write_png": write_png, "color_vector": color_vector}
