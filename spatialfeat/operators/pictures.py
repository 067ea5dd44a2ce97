"""Pictures of patches as PNG: in colour, gray, and masked by threshold or by cells, as one Arrow pass; each is a binary value in its row."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernels
from ..schema import MASK_HIGH, MASK_LOW
from .geometry import GEOMETRIES, cells_of, polygons_of
from .spread import spread

#: Kinds of pictures, in order; the last two and the outlines need cells.
KINDS = ("color", "gray", "masked_gray_threshold", "masked_color_threshold", "masked_gray_cellseg", "masked_color_cellseg", "outlines")
#: Colours of outlines by class name; others are white.
COLOURS = {"neoplastic": (255, 0, 0), "inflammatory": (0, 255, 0), "connective": (0, 0, 255), "dead": (255, 255, 0), "epithelial": (255, 165, 0)}
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def png(image: np.ndarray) -> bytes:
    """An image of 8 bits, gray (rows, columns) or RGB (rows, columns, 3); of each row the filter with the smallest differences is taken."""
    h, w = image.shape[:2]
    step = 1 if image.ndim == 2 else 3
    rows = image.reshape(h, w * step)
    left, above = np.zeros_like(rows), np.zeros_like(rows)
    left[:, step:], above[1:] = rows[:, :-step], rows[:-1]
    tried = np.stack([rows, rows - left, rows - above])  # filters 0, 1 and 2: as it is, less the left, less the upper pixel
    best = np.abs(tried.view(np.int8).astype(np.int64)).sum(2).argmin(0)
    lines = np.concatenate([best[:, None].astype(np.uint8), tried[best, np.arange(h)]], 1)

    def chunk(name: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))

    head = struct.pack(">IIBBBBB", w, h, 8, 0 if step == 1 else 2, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def drawn(image: np.ndarray, rings: list[np.ndarray], colours: np.ndarray) -> np.ndarray:
    """RGB with the edges of rings, each in its colour: a pixel for every step along the longer side of an edge, later rings above."""
    out = image.copy()
    if not rings:
        return out
    points = [np.trunc(r).astype(np.int64) for r in rings]
    start = np.concatenate(points)
    end = np.concatenate([np.roll(p, -1, 0) for p in points])
    own = np.repeat(np.arange(len(rings)), [len(p) for p in points])
    steps = np.maximum(1, np.abs(end - start).max(1))
    edge = np.repeat(np.arange(len(start)), steps)
    t = (np.arange(len(edge)) - np.repeat(np.cumsum(steps) - steps, steps)) / steps[edge]
    x, y = np.floor(start[edge] + t[:, None] * (end - start)[edge] + 0.5).astype(np.int64).T
    inside = (x >= 0) & (x < image.shape[1]) & (y >= 0) & (y < image.shape[0])
    out[y[inside], x[inside]] = colours[own[edge]][inside]
    return out


def variants(rgb: np.ndarray, cells: list | None, names: list[str | None], kinds: tuple[str, ...]) -> dict[str, np.ndarray]:
    """Images of a patch by kind. Without cells the kinds that need them are left out."""
    gray = kernels.luma(rgb).astype(np.uint8)
    out = {"color": rgb, "gray": gray}
    masks = {"threshold": (gray > MASK_LOW) & (gray < MASK_HIGH)}
    if cells:
        masks["cellseg"] = kernels.rasterised([rings for polygons in cells for rings in polygons], *gray.shape) > 0
        laid = [(kernels.points_of(ring), COLOURS.get(name or "", (255, 255, 255))) for polygons, name in zip(cells, names, strict=True) for rings in polygons for ring in rings if len(ring)]
        out["outlines"] = drawn(rgb, [ring for ring, _ in laid], np.array([c for _, c in laid], np.uint8).reshape(-1, 3))
    for name, mask in masks.items():
        out |= {f"masked_gray_{name}": np.where(mask, gray, 0).astype(np.uint8), f"masked_color_{name}": np.where(mask[..., None], rgb, 0).astype(np.uint8)}
    return {k: out[k] for k in kinds if k in out}


def _pictured(batches: Iterator[pa.RecordBatch], kinds: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        px, h, w, cells, names = batch.columns[:5]
        cells, names = cells_of(cells), names.to_pylist()
        for k, (values, rows, columns) in enumerate(zip(px, h.to_pylist(), w.to_pylist(), strict=True)):
            if not values.is_valid:
                continue
            rgb = np.asarray(values.values).astype(np.uint8).reshape(rows, columns, 3)
            made = {kind: png(image) for kind, image in variants(rgb, cells[k], names[k] or [], kinds).items()} if rgb.size else {}
            of_row = [pa.array([column[k].as_py()] * len(made), column.type) for column in batch.columns[5:]]
            yield pa.RecordBatch.from_arrays([*of_row, pa.array(made, pa.string()), pa.array(made.values(), pa.binary())], [*batch.schema.names[5:], "kind", "png"])


def pictures(patches: DataFrame, keys: list[str], kinds: tuple[str, ...] = KINDS, cells: str | None = None) -> DataFrame:
    """keys, kind and png of every patch (px as interleaved 8-bit RGB, h, w).

    cells names an array column of (class_name, geometry), as segmentation.overlay_rows makes it; without it, and for patches without
    cells, kinds that need cells have no row, and a patch without pixels has none at all.
    """
    if unknown := set(kinds) - set(KINDS):
        raise ValueError(f"no such pictures: {sorted(unknown)}, there are {KINDS}")
    if cells is None:
        drawn_, names = F.array().cast(T.ArrayType(GEOMETRIES)), F.array().cast("array<string>")
    else:
        one = patches.schema[cells].dataType.elementType["geometry"].dataType
        whole = isinstance(one.elementType.elementType, T.ArrayType)
        drawn_ = F.transform(cells, lambda c: polygons_of(c["geometry"] if whole else F.array(c["geometry"])))
        names = F.transform(cells, lambda c: c["class_name"])
    source = patches.select(F.col("px").cast("array<int>").alias("px_"), F.col("h").cast("int").alias("h_"), F.col("w").cast("int").alias("w_"), drawn_.alias("cells_"), names.alias("names_"), *keys)
    schema = T.StructType([*source.schema.fields[5:], T.StructField("kind", T.StringType()), T.StructField("png", T.BinaryType())])
    return spread(source).mapInArrow(lambda it: _pictured(it, tuple(kinds)), schema)
