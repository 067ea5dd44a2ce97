"""Features of patches in one Arrow pass: gray, mask, first-order and texture features, shapes of cells.

Pixels stay in the row and never leave Python again: each task stacks the patches of a batch that have one shape and runs the
kernels over the stack. The pass needs no shuffle, but for inputs that are small as a whole, which are dealt over all cores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernels
from ..schema import ERROR_CELLSEG, ERROR_MORPHOLOGY, ERROR_PATCH, MASK_HIGH, MASK_LABEL, MASK_LOW, SKIPPED_NO_CELLS, SKIPPED_SMALL_MASK, SMALLEST_MASK, STATUS_ERROR, STATUS_OK
from .geometry import flat_cells
from .spread import spread

CLASSES = {
    "firstorder": kernels.FIRSTORDER, "glcm": kernels.GLCM, "glrlm": kernels.GLRLM, "glszm": kernels.GLSZM, "gldm": kernels.GLDM, "ngtdm": kernels.NGTDM,
}


def _stack_features(gray: np.ndarray, mask: np.ndarray, classes, width: int, offsets) -> dict[str, np.ndarray]:
    level = kernels.levels(gray, mask, width)
    make = {
        "firstorder": lambda: kernels.firstorder(gray, mask, width), "glcm": lambda: kernels.glcm(level, offsets), "glrlm": lambda: kernels.glrlm(level, offsets),
        "glszm": lambda: kernels.glszm(level, offsets), "gldm": lambda: kernels.gldm(level, offsets=offsets), "ngtdm": lambda: kernels.ngtdm(level, offsets),
    }
    return {f"{c}_{f}": v for c in classes for f, v in make[c]().items()}


def _rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and offsets of a list column; null rows are empty."""
    sizes = np.asarray(column.value_lengths().fill_null(0))
    return np.asarray(column.flatten()), np.concatenate([[0], np.cumsum(sizes)])


def _featured(batches: Iterator[pa.RecordBatch], names: list[str], classes, width: int, offsets, smallest: int, most_pixels: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        *keys, px, mask, h, w = batch.columns
        (values, at), (inside, at_mask) = _rows_of(px), _rows_of(mask)
        h, w = (np.asarray(x.fill_null(0)).astype(int) for x in (h, w))
        out = {f: np.full(batch.num_rows, np.nan) for f in names}
        whole = (np.diff(at) == h * w) & (np.diff(at_mask) == h * w) & (h * w > 0)
        for shape in sorted({*zip(h[whole].tolist(), w[whole].tolist(), strict=True)}):
            rows = np.flatnonzero(whole & (h == shape[0]) & (w == shape[1]))
            step = max(1, most_pixels // (shape[0] * shape[1]))
            for a in range(0, len(rows), step):
                some = rows[a : a + step]
                pick = (at[some][:, None] + np.arange(shape[0] * shape[1])).reshape(len(some), *shape)
                pick_mask = (at_mask[some][:, None] + np.arange(shape[0] * shape[1])).reshape(len(some), *shape)
                gray, m = values[pick].astype(np.int64), inside[pick_mask] > 0
                large = m.reshape(len(some), -1).sum(1) >= smallest
                if large.any():
                    for f, v in _stack_features(gray[large], m[large], classes, width, offsets).items():
                        out[f][some[large]] = v
        columns = [pa.array(out[f], pa.float64(), mask=np.isnan(out[f])) for f in names]
        yield pa.RecordBatch.from_arrays([*keys, *columns], [*batch.schema.names[: len(keys)], *names])


def texture_features(patches: DataFrame, keys: list[str], px: str = "px", mask: str = "mask", h: str = "h", w: str = "w", classes=tuple(CLASSES), prefix: str = "original_", width: int = 25, offsets=kernels.PLANE, smallest: int = SMALLEST_MASK) -> DataFrame:
    """keys and prefix_class_Feature of every patch; null where the region has fewer than `smallest` pixels."""
    names = [f"{c}_{f}" for c in classes for f in CLASSES[c]]
    source = patches.select(*keys, F.col(px).cast("array<int>"), F.col(mask).cast("array<int>"), F.col(h).cast("int"), F.col(w).cast("int"))
    schema = T.StructType([*source.schema.fields[: len(keys)], *(T.StructField(f, T.DoubleType()) for f in names)])
    made = spread(source).mapInArrow(lambda it: _featured(it, names, classes, width, offsets, smallest), schema)
    return made.select(*keys, *(F.col(f).alias(f"{prefix}{f}") for f in names)) if prefix else made


# ---------------------------------------------------------------- patches as a whole

#: Features that cells of a patch give, shape by shape.
MORPHOLOGY = tuple(f"{shape.lower()}_{stat}" for shape in kernels.SHAPE2D for stat in kernels.STATISTICS)
#: Extractors in their order, and the classes of each.
EXTRACTORS = (("firstorder",), ("glcm", "glrlm", "glszm", "gldm", "ngtdm"))


def feature_names(filters=()) -> list[str]:
    """imagetype_class_Feature of all classes, the original first."""
    return [f"{kind}_{c}_{f}" for kind in ("original", *filters) for classes in EXTRACTORS for c in classes for f in CLASSES[c]]


def _images(batch: pa.RecordBatch) -> tuple[dict[int, np.ndarray], dict[int, str]]:
    """Gray images by row, and what is wrong with the others. Columns px, layout, h, w come first."""
    px, layout, h, w = batch.columns[:4]
    images, errors = {}, {}
    for k, (one, order, rows, cols) in enumerate(zip(px, layout.to_pylist(), h.to_pylist(), w.to_pylist(), strict=True)):
        if not one.is_valid or rows is None or cols is None:
            errors[k] = "a patch without pixels or without a size"
            continue
        if isinstance(one, pa.BinaryScalar):
            values = np.frombuffer(one.as_buffer(), np.uint8)
        elif one.values.null_count:
            errors[k] = f"{one.values.null_count} pixels are missing"
            continue
        else:
            values = one.values.to_numpy(zero_copy_only=False)
        if rows * cols > 0 and len(values) == rows * cols:
            images[k] = values.reshape(rows, cols).astype(np.int64)
        elif rows * cols > 0 and len(values) == 3 * rows * cols:
            images[k] = kernels.luma(values.reshape(3, rows, cols).transpose(1, 2, 0) if order == "chw" else values.reshape(rows, cols, 3))
        else:
            errors[k] = f"a patch of {rows} x {cols} has {len(values)} values"
    return images, errors


def _guarded(make, rows: list[int]) -> tuple[list[tuple[list[int], dict]], dict[int, str]]:
    """make(rows), arrays by feature, with its rows; where it fails, row by row, with what went wrong."""
    try:
        return [(rows, make(rows))], {}
    except Exception as e:  # noqa: BLE001 (a patch that fails must not take others along)
        if len(rows) == 1:
            return [], {rows[0]: repr(e)}
    done, failed = [], {}
    for k in rows:
        some, wrong = _guarded(make, [k])
        done += some
        failed |= wrong
    return done, failed


#: Patches, and pixels of patches, that are taken from a batch at once: what Python holds besides the batch.
SLICE_ROWS, SLICE_PIXELS = 1024, 1 << 18


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch of patches in slices of few rows and pixels; columns h and w are the third and fourth."""
    h, w = (np.asarray(batch.column(i).fill_null(0)).astype(np.int64) for i in (2, 3))
    step = max(1, min(SLICE_ROWS, SLICE_PIXELS // max(1, int((h * w).max(initial=1)))))
    for at in range(0, max(1, batch.num_rows), step):
        yield batch.slice(at, step)


def _featured_patches(batches: Iterator[pa.RecordBatch], names: list[str], filters, width: int, offsets, smallest: int, label: int, with_cells: bool) -> Iterator[pa.RecordBatch]:
    skip = 5 if with_cells else 4
    shapes = MORPHOLOGY if with_cells else ()
    for batch in (some for whole in batches for some in _slices(whole)):
        images, errors = _images(batch)
        n = batch.num_rows
        status: list[str] = [STATUS_ERROR if k in errors else STATUS_OK for k in range(n)]
        area: list[int | None] = [None] * n
        out = {f: np.full(n, np.nan) for f in names}
        morphology = {f: np.full(n, np.nan) for f in shapes}
        masks: dict[int, np.ndarray] = {}
        size = np.array([images[k].shape if k in images else (0, 0) for k in range(n)], np.int64).reshape(n, 2)
        if with_cells:
            xy, points, ring_cell, outer, cell_row = flat_cells(batch.column(4))
            painted = kernels.flat_painted(*kernels.drawable(*kernels.opened(xy, points)), np.where(outer, label, 0).astype(np.uint8), cell_row[ring_cell], size)
            there = np.bincount(cell_row, minlength=n) > 0
        for k, image in images.items():
            if not with_cells:
                masks[k] = (image > MASK_LOW) & (image < MASK_HIGH)
            elif there[k]:
                masks[k] = painted[0][painted[1][k] : painted[1][k + 1]].reshape(image.shape) > 0
            else:
                status[k] = SKIPPED_NO_CELLS
                continue
            area[k] = int(masks[k].sum())
            if not with_cells and area[k] < smallest:
                status[k] = SKIPPED_SMALL_MASK
        large = [k for k in masks if area[k] >= smallest]
        for shape in sorted({images[k].shape for k in large}):
            rows = [k for k in large if images[k].shape == shape]
            for classes in EXTRACTORS:

                def make(own: list[int], classes=classes) -> dict[str, np.ndarray]:
                    gray, mask = np.stack([images[k] for k in own]), np.stack([masks[k] for k in own])
                    made = {}
                    for kind in ("original", *filters):
                        image = gray if kind == "original" else kernels.filtered(gray, kind)
                        if not np.isfinite(image).all():
                            raise ValueError(f"no {kind} image")
                        made |= {f"{kind}_{f}": v for f, v in _stack_features(image, mask, classes, width, offsets).items()}
                    return made

                done, failed = _guarded(make, rows)
                for own, values in done:
                    for f, v in values.items():
                        out[f][own] = v
                for k, wrong in failed.items():
                    status[k] = f"{ERROR_CELLSEG if with_cells else ERROR_PATCH}: {wrong}" if status[k] == STATUS_OK else status[k]
        if with_cells and masks:

            def measure(own: list[int]) -> dict[str, np.ndarray]:
                some = np.isin(cell_row, own)  # noqa: B023
                rings = some[ring_cell]  # noqa: B023
                number = np.cumsum(some) - 1
                row = cell_row[some]  # noqa: B023
                found = kernels.shapes_of(xy[np.repeat(rings, points)], points[rings], number[ring_cell[rings]], outer[rings], len(row), size[row])  # noqa: B023
                kept = ~np.isnan(found[:, 0])
                made = kernels.statistics_of(found[kept].round(10), np.searchsorted(own, row[kept]), len(own))
                return dict(zip(shapes, made.T, strict=True))

            done, failed = _guarded(measure, sorted(masks))
            for own, values in done:
                for f, v in values.items():
                    morphology[f][own] = v
            for k, wrong in failed.items():
                status[k] = f"{ERROR_MORPHOLOGY}: {wrong}" if status[k] == STATUS_OK else status[k]
        columns = [pa.array(area, pa.int64()), pa.array(status, pa.string()), pa.array([errors.get(k) for k in range(n)], pa.string())]
        columns += [pa.array(v, pa.float64(), mask=np.isnan(v)) for v in (*out.values(), *morphology.values())]
        yield pa.RecordBatch.from_arrays([*batch.columns[skip:], *columns], [*batch.schema.names[skip:], "mask_area", "status", "error", *names, *shapes])


def patch_features(patches: DataFrame, carry: list[str], cells: str | None = None, filters=(), width: int = 25, offsets=kernels.PLANE, smallest: int = SMALLEST_MASK, label: int = MASK_LABEL) -> DataFrame:
    """`carry`, mask_area, status, error, imagetype_class_Feature, and with cells shape_statistic (MORPHOLOGY) of every patch.

    patches has px (whole numbers, row by row, or bytes), h, w and maybe layout: h x w values are gray, 3 x h x w are RGB, in the
    last axis or, where layout is `chw`, in the first. Without cells the mask is the threshold's, else what the cells of the
    column (an array of cells, each an array of polygons) cover, painted in their order.

    A patch that is no image has status `error` and a message. A small threshold mask and a patch without cells are
    skipped. An extractor that fails leaves its features null and its code and message as status, the first one that fails.

    Python holds a batch of patches at a time, as many as the session says; spread.fitting_batches fits that to their size. What is made of
    them is made slice by slice.
    """
    filters = tuple(f.lower() for f in filters if f.lower() != "original")
    if unknown := set(filters) - set(kernels.FILTERS):
        raise ValueError(f"no such image types: {sorted(unknown)}, there are {sorted(kernels.FILTERS)}")
    names = feature_names(filters)
    px = F.col("px") if isinstance(patches.schema["px"].dataType, T.BinaryType) else F.col("px").cast("array<int>").alias("px")
    layout = F.col("layout") if "layout" in patches.columns else F.lit(None)
    source = patches.select(
        px, layout.cast("string").alias("layout"), F.col("h").cast("int").alias("h"), F.col("w").cast("int").alias("w"),
        *([F.col(cells).alias("cells")] if cells else []), *(F.col(c).alias(f"k{i}") for i, c in enumerate(carry)),
    )
    skip = 5 if cells else 4
    doubles = [T.StructField(f, T.DoubleType()) for f in (*names, *(MORPHOLOGY if cells else ()))]
    meta = [T.StructField("mask_area", T.LongType()), T.StructField("status", T.StringType()), T.StructField("error", T.StringType())]
    schema = T.StructType([*source.schema.fields[skip:], *meta, *doubles])
    dealt = source if cells else spread(source)  # patches with cells come from a join, which deals them
    made = dealt.mapInArrow(lambda it: _featured_patches(it, names, filters, width, offsets, smallest, label, cells is not None), schema)
    return made.select(*(F.col(f"k{i}").alias(c) for i, c in enumerate(carry)), *(f.name for f in (*meta, *doubles)))
