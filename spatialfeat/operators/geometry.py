"""Polygons of cells: measures as column expressions, raster and shape as Arrow passes.

A geometry is an array of rings of (x, y) points, the first ring outside, the others holes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernels, wkb
from ..schema import RINGS
from .spread import spread

#: Polygons: arrays of rings of points.
GEOMETRIES = T.ArrayType(RINGS)


def rectangle(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """A geometry with the corners of a rectangle in order."""
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(point(x0, y0), point(x1, y0), point(x1, y1), point(x0, y1)))


def _over_edges(ring: Column, term) -> Column:
    """Sum of a term over the edges of a closed ring: its points beside the same ones moved on by one."""
    n = F.size(ring)
    moved = F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1))
    return F.when(n >= 3, F.aggregate(F.zip_with(ring, moved, term), F.lit(0.0), lambda a, b: a + b)).otherwise(0.0)


def ring_area(ring: Column) -> Column:
    return F.abs(_over_edges(ring, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])) / 2


def ring_length(ring: Column) -> Column:
    return _over_edges(ring, lambda p, q: F.sqrt((q["x"] - p["x"]) * (q["x"] - p["x"]) + (q["y"] - p["y"]) * (q["y"] - p["y"])))


def area(geometry: Column) -> Column:
    """Area of the outer ring less that of the holes."""
    holes = F.aggregate(F.transform(F.slice(geometry, 2, F.greatest(F.size(geometry) - 1, F.lit(0))), ring_area), F.lit(0.0), lambda a, b: a + b)
    return ring_area(F.get(geometry, F.lit(0))) - holes


def perimeter(geometry: Column) -> Column:
    return F.aggregate(F.transform(geometry, ring_length), F.lit(0.0), lambda a, b: a + b)


def bounding_box(geometry: Column, margin: int = 1) -> Column:
    """Whole-number box around a geometry with a margin: (min_x, min_y, max_x, max_y)."""
    ring = F.get(geometry, F.lit(0))
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(
        (F.floor(F.array_min(xs)) - margin).alias("min_x"), (F.floor(F.array_min(ys)) - margin).alias("min_y"),
        (F.ceil(F.array_max(xs)) + margin).alias("max_x"), (F.ceil(F.array_max(ys)) + margin).alias("max_y"),
    )


def crop(box: Column, h: Column, w: Column) -> Column:
    """A box within an image, and what of the box's own mask is cut on each side."""
    x0, y0 = F.greatest(box["min_x"], F.lit(0)), F.greatest(box["min_y"], F.lit(0))
    x1, y1 = F.least(box["max_x"], w - 1), F.least(box["max_y"], h - 1)
    return F.struct(
        x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"), F.greatest(x1 - x0 + 1, F.lit(0)).alias("width"), F.greatest(y1 - y0 + 1, F.lit(0)).alias("height"),
        (x0 - box["min_x"]).alias("cut_left"), (y0 - box["min_y"]).alias("cut_top"), (box["max_x"] - x1).alias("cut_right"), (box["max_y"] - y1).alias("cut_bottom"),
    )


@F.arrow_udf(GEOMETRIES)
def from_wkb(column: pa.Array) -> pa.Array:
    """The polygons of well-known binary, however collections nest; null is null, a geometry without polygons is empty."""
    return wkb.decoded(column)


@F.arrow_udf(GEOMETRIES)
def from_wkt(column: pa.Array) -> pa.Array:
    """The polygons of well-known text, however collections nest; null is null, a geometry without polygons is empty."""
    return wkb.parsed(column)


@F.arrow_udf(T.BinaryType())
def to_wkb(column: pa.Array) -> pa.Array:
    """Well-known binary of an array of polygons."""
    return wkb.encoded(column)


#: Bits of a place on the curve in each direction.
CURVE_BITS = 16


@F.arrow_udf(T.LongType())
def curve_place(x: pa.Array, y: pa.Array) -> pa.Array:
    """Place of whole coordinates below 2**CURVE_BITS on a Hilbert curve, on which near places are near; null is at the beginning."""
    x, y = (np.asarray(c.fill_null(0)).astype(np.int64) for c in (x, y))
    place = np.zeros(len(x), np.int64)
    for bit in reversed(range(CURVE_BITS)):
        right, low = (x >> bit) & 1, (y >> bit) & 1
        place = (place << 2) + ((3 * right) ^ low)
        flip = (low == 0) & (right == 1)
        x, y = np.where(flip, (1 << CURVE_BITS) - 1 - x, x), np.where(flip, (1 << CURVE_BITS) - 1 - y, y)
        x, y = np.where(low == 0, y, x), np.where(low == 0, x, y)
    return pa.array(place)


def bounds(polygons: Column) -> Column:
    """xmin, ymin, xmax and ymax of an array of polygons; null where there is no point."""
    points = F.flatten(F.flatten(polygons))
    x, y = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(x).alias("xmin"), F.array_min(y).alias("ymin"), F.array_max(x).alias("xmax"), F.array_max(y).alias("ymax"))


def polygons_of(geometry: Column) -> Column:
    """The single geometries of an array of geometries, empty ones dropped."""
    return F.filter(geometry, lambda g: (F.size(g) > 0) & (F.size(F.get(g, F.lit(0))) > 0))


def _rings(column: pa.Array) -> list[list[np.ndarray]]:
    """The rings of every row of a geometry column as arrays of (x, y); null rows have none."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rings = column.flatten()
    points = rings.flatten()
    xy = np.stack([np.asarray(points.field(k).cast(pa.float64())) for k in (0, 1)], 1) if len(points) else np.zeros((0, 2))
    ends = np.cumsum(np.asarray(rings.value_lengths().fill_null(0)))
    made = np.split(xy, ends)[:-1] if len(ends) else []
    counts = np.cumsum([0, *np.asarray(column.value_lengths().fill_null(0))])
    return [made[a:b] for a, b in zip(counts[:-1], counts[1:], strict=True)]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The points of a geometry column one after the other, the points of every ring and the rings of every row."""
    rings = column.flatten()
    points = rings.flatten()
    xy = np.stack([np.asarray(points.field(k).cast(pa.float64()).fill_null(np.nan)) for k in (0, 1)], 1) if len(points) else np.zeros((0, 2))
    return xy, *(np.asarray(c.value_lengths().fill_null(0)).astype(np.int64) for c in (rings, column))


def _numbers_within(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of some runs."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _grouped(items: list, column: pa.Array) -> list[list]:
    """Items of the flattened column by the row that they come from."""
    ends = np.cumsum([0, *np.asarray(column.value_lengths().fill_null(0))])
    return [items[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def cells_of(column: pa.Array) -> list[list[list[list[np.ndarray]]]]:
    """Cells (arrays of polygons, which are arrays of rings) of every row as arrays of (x, y); polygons without rings go."""
    cells = column.flatten()
    polygons = cells.flatten()
    return _grouped([[rings for rings in some if rings] for some in _grouped(_rings(polygons), cells)], column)


def flat_cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells (arrays of polygons, which are arrays of rings) of all rows: points of all rings, how many each ring has, its cell, whether
    it is an exterior; and the row of every cell."""
    cells = column.flatten()
    xy, points, rings = _flat(cells.flatten())
    of = lambda c: np.repeat(np.arange(len(c)), np.asarray(c.value_lengths().fill_null(0)))
    return xy, points, np.repeat(of(cells), rings), _numbers_within(rings) == 0, of(column)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    """One list of whole numbers a row, from flat arrays and without a Python object per number."""
    ends = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int32), *arrays]).astype(np.int32)))


#: Pixels of masks that a task paints at once.
MOST_PIXELS = 1 << 24


def _chunks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of rows of `most` pixels, or of one row that has more."""
    ends, at = np.concatenate([[0], np.cumsum(sizes)]), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
        yield at, to
        at = to


def _painted(batches: Iterator[pa.RecordBatch], label: int, what: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *keys, geometries, h, w = batch.columns
        shapes = np.stack([np.asarray(c.fill_null(0)) for c in (h, w)], 1).astype(np.int64)
        xy, points, rings = _flat(geometries.flatten())
        xy, points = kernels.opened(xy, points)
        xy, points = kernels.drawable(xy, points)
        values = np.where(_numbers_within(rings) == 0, label, 0).astype(np.uint8)
        polygons = np.asarray(geometries.value_lengths().fill_null(0))
        image = np.repeat(np.repeat(np.arange(batch.num_rows), polygons), rings)
        ends = np.concatenate([[0], np.cumsum(points)])
        made = []
        for a, b in _chunks(shapes.prod(1), MOST_PIXELS):
            i, j = np.searchsorted(image, [a, b])
            out, start = kernels.flat_painted(xy[ends[i] : ends[j]], points[i:j], values[i:j], image[i:j] - a, shapes[a:b])
            if what == "mask":
                made.append(pa.ListArray.from_arrays(pa.array(start.astype(np.int32)), pa.array(out.astype(np.int32))))
                continue
            at = np.flatnonzero(out)
            cuts = np.searchsorted(at, start)
            n = np.diff(cuts)
            places = lambda: pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array((at - np.repeat(start[:-1], n)).astype(np.int32)))  # noqa: B023, E731
            made.append(pa.array(n.astype(np.int64)) if what == "area" else places())
        column = pa.concat_arrays(made) if made else pa.array([], _PAINTED[what][1])
        yield pa.RecordBatch.from_arrays([*keys, column], [*batch.schema.names[: len(keys)], what])


#: What can be told of a painted mask.
_PAINTED = {"area": (T.LongType(), pa.int64()), "mask": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())), "places": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32()))}


def _raster(patches: DataFrame, keys: list[str], geometries: str, h: str, w: str, label: int, what: str) -> DataFrame:
    source = patches.select(*keys, geometries, F.col(h).cast("int").alias("rows_"), F.col(w).cast("int").alias("cols_"))
    schema = T.StructType([*source.schema.fields[: len(keys)], T.StructField(what, _PAINTED[what][0])])
    return spread(source).mapInArrow(lambda it: _painted(it, label, what), schema)


def rasterise(patches: DataFrame, keys: list[str], geometries: str = "geometries", h: str = "h", w: str = "w", label: int = 255) -> DataFrame:
    """keys and mask (row-major) of patches with an array of cell geometries, painted in their order, holes erased."""
    return _raster(patches, keys, geometries, h, w, label, "mask")


def raster_area(patches: DataFrame, keys: list[str], geometries: str = "geometries", h: str = "h", w: str = "w") -> DataFrame:
    """keys and area: the pixels of that mask, counted where it is painted."""
    return _raster(patches, keys, geometries, h, w, 1, "area")


def raster_places(patches: DataFrame, keys: list[str], geometries: str = "geometries", h: str = "h", w: str = "w") -> DataFrame:
    """keys and places: where that mask is set, row-major from 0 and ascending; much less than the mask where little of it is."""
    return _raster(patches, keys, geometries, h, w, 1, "places")


def _shaped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *keys, geometry = batch.columns
        xy, points, rings = _flat(geometry)
        made = kernels.shapes_of(xy, points, np.repeat(np.arange(batch.num_rows), rings), _numbers_within(rings) == 0, batch.num_rows)
        columns = [pa.array(c, pa.float64(), mask=np.isnan(c)) for c in np.ascontiguousarray(made.T)]
        yield pa.RecordBatch.from_arrays([*keys, *columns], [*batch.schema.names[: len(keys)], *kernels.SHAPE2D])


def shape2d(cells: DataFrame, keys: list[str], geometry: str = "geometry") -> DataFrame:
    """keys and nine shape features of each cell from its own raster; null where it has under three pixels or no outline."""
    source = cells.select(*keys, geometry)
    schema = T.StructType([*source.schema.fields[: len(keys)], *(T.StructField(f, T.DoubleType()) for f in kernels.SHAPE2D)])
    return spread(source).mapInArrow(_shaped, schema)


POINTS = pa.struct([("x", pa.float64()), ("y", pa.float64())])
PARTS = pa.list_(pa.struct([("cell_id_in_patch", pa.int32()), ("class_id", pa.int64()), ("geometry", pa.list_(pa.list_(POINTS)))]))


def _masks(mask: pa.Array, h: pa.Array, w: pa.Array) -> Iterator[np.ndarray]:
    """Each mask as an image of 0 and 1; one without values has no pixel."""
    for m, rows, cols in zip(mask, h.to_pylist(), w.to_pylist(), strict=True):
        yield (m.values.to_numpy(zero_copy_only=False).reshape(rows, cols) > 0).astype(int) if m.is_valid and len(m) else np.zeros((0, 0), int)


def _numbers(mask: np.ndarray) -> np.ndarray:
    label = kernels.zones(mask[None])[0].reshape(-1)
    return np.where(label >= 0, np.searchsorted(np.unique(label[label >= 0]), label) + 1, 0)


def _ring(points: list[tuple[float, float]]) -> list[list[dict]]:
    return [[{"x": x, "y": y} for x, y in points]]


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        *keys, mask, h, w = batch.columns
        out = [_numbers(m) if m.size else np.zeros(0, int) for m in _masks(mask, h, w)]
        yield pa.RecordBatch.from_arrays([*keys, _lists(out)], [*batch.schema.names[: len(keys)], "labels"])


def _outlined(batches: Iterator[pa.RecordBatch], kinds: bool, every: bool) -> Iterator[pa.RecordBatch]:
    """The parts of each mask that have an outline, or every one, the others with a null geometry; with kinds, the most frequent positive type of a part's pixels (the smallest of equals), -1 without any."""
    for batch in batches:
        *keys, types, mask, h, w = batch.columns
        out = []
        for m, kind in zip(_masks(mask, h, w), types, strict=True):
            found = kernels.numbered_outlines(m) if m.size else []
            number = _numbers(m) if m.size and (kinds or every) else np.zeros(0, int)
            if every:
                rings = dict(found)
                found = [(k, rings.get(k)) for k in range(1, int(number.max(initial=0)) + 1)]
            votes = None
            if kinds and found:
                kind = np.asarray(kind.values.fill_null(0))
                at = (number > 0) & (kind > 0)
                pairs, n = np.unique(np.stack([number[at], kind[at]]), axis=1, return_counts=True)
                best = np.lexsort((pairs[1], -n, pairs[0]))[::-1]
                votes = dict(zip(pairs[0][best].tolist(), pairs[1][best].tolist(), strict=True))
            out.append([{"cell_id_in_patch": k, "class_id": votes.get(k, -1) if votes is not None else -1, "geometry": None if points is None else _ring(points)} for k, points in found])
        yield pa.RecordBatch.from_arrays([*keys, pa.array(out, PARTS)], [*batch.schema.names[: len(keys)], "parts"])


def instance_labels(patches: DataFrame, keys: list[str], mask: str = "mask", h: str = "h", w: str = "w") -> DataFrame:
    """keys and labels: 8-connected parts of a mask numbered from 1 by their first pixel, 0 outside."""
    source = patches.select(*keys, mask, F.col(h).cast("int"), F.col(w).cast("int"))
    schema = T.StructType([*source.schema.fields[: len(keys)], T.StructField("labels", T.ArrayType(T.IntegerType()))])
    return spread(source).mapInArrow(_labelled, schema)


def instance_parts(patches: DataFrame, keys: list[str], types: str | None = None, mask: str = "mask", h: str = "h", w: str = "w", every: bool = False) -> DataFrame:
    """keys and parts (cell_id_in_patch, class_id, geometry): the parts of a mask that have an outline, in order, as one pass.

    A part keeps its number where others have no outline; with `every` those stand there as well, their geometry is null. class_id is the majority of the part's positive types, -1 without.
    """
    kind = F.array().cast("array<int>") if types is None else F.col(types).cast("array<long>")
    source = patches.select(*keys, kind.alias("types_"), mask, F.col(h).cast("int").alias("h_"), F.col(w).cast("int").alias("w_"))
    part = "parts array<struct<cell_id_in_patch: int, class_id: bigint, geometry: array<array<struct<x: double, y: double>>>>>"
    schema = T.StructType([*source.schema.fields[: len(keys)], *T.StructType.fromDDL(part).fields])
    return spread(source).mapInArrow(lambda it: _outlined(it, types is not None, every), schema)


def mask_polygons(patches: DataFrame, keys: list[str], mask: str = "mask", h: str = "h", w: str = "w") -> DataFrame:
    """keys and polygons: one geometry, its outer outline through pixel centres, per 8-connected part of a mask that has one."""
    return instance_parts(patches, keys, None, mask, h, w).select(*keys, F.transform("parts", lambda p: p["geometry"]).alias("polygons"))
