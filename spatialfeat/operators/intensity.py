"""Gray levels of patches of any size as counts, and what thresholds, percentiles and entropy follow from counts.

A patch is read once; what is kept of it are at most 256 counts, from which everything else is arithmetic. Counts of patches add up
to counts of samples, so statistics of a sample are exact without its pixels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import MASK_HIGH, MASK_LOW, SKIPPED_SMALL_MASK, SMALLEST_MASK, STATUS_ERROR, STATUS_OK

#: Pixels that are counted at once.
SLICE = 1 << 22


def _counts(pixels: np.ndarray) -> np.ndarray:
    out = np.zeros(256, np.int64)
    for at in range(0, len(pixels), SLICE):
        out += np.bincount(pixels[at : at + SLICE], minlength=256)
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(0).cast(pa.large_binary())
        offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
        valid = np.asarray(column.is_valid())
        levels, counts = [], []
        for k in range(len(column)):
            if not valid[k]:
                levels.append(None), counts.append(None)
                continue
            found = _counts(data[offsets[k] : offsets[k + 1]])
            at = np.flatnonzero(found)
            levels.append(at), counts.append(found[at])
        arrays = [pa.array(levels, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[1:], *arrays], [*batch.schema.names[1:], "levels", "counts"])


def level_counts(patches: DataFrame, keep: list[str], pixels: str = "pixels") -> DataFrame:
    """keep, levels (those that occur, ascending) and counts of patches of one byte a pixel; null for a patch that is null."""
    source = patches.select(F.col(pixels).cast("binary").alias("pixels_"), *keep)
    kind = T.StructType([*source.schema.fields[1:], T.StructField("levels", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.LongType()))])
    return source.mapInArrow(_counted, kind)


def _sum(pairs: Column, value) -> Column:
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda a, p: a + value(p).cast("long"))


def patch_summary(counted: DataFrame, low: int = MASK_LOW, high: int = MASK_HIGH, smallest: int = SMALLEST_MASK) -> DataFrame:
    """Adds n_pixels, mask_area (pixels strictly between low and high), mask_mean (null for an empty mask) and status."""
    inside = F.filter(F.arrays_zip("levels", "counts"), lambda p: (p["levels"] > low) & (p["levels"] < high))
    area = _sum(inside, lambda p: p["counts"])
    status = F.when(F.col("levels").isNull(), STATUS_ERROR).when(F.col("mask_area") < smallest, SKIPPED_SMALL_MASK).otherwise(STATUS_OK)
    return counted.withColumns({
        "n_pixels": _sum(F.arrays_zip("levels", "counts"), lambda p: p["counts"]), "mask_area": area,
        "mask_mean": F.try_divide(_sum(inside, lambda p: p["levels"] * p["counts"]).cast("double"), area.cast("double")),
    }).withColumn("status", status)


def sample_levels(counted: DataFrame, keys: list[str]) -> DataFrame:
    """keys, level and n: the counts of all patches of a sample."""
    pair = F.explode(F.arrays_zip("levels", "counts")).alias("p")
    return counted.select(*keys, pair).groupBy(*keys, F.col("p.levels").alias("level")).agg(F.sum("p.counts").alias("n"))


def level_statistics(levels: DataFrame, keys: list[str], at: tuple[float, ...] = (0.01, 0.5, 0.99)) -> DataFrame:
    """Per sample n_pixels, mean, percentiles (the least level that so large a share of pixels does not exceed), entropy in bits, and
    the threshold between dark and bright that separates them best (largest variance between the two; the darkest of equals).

    levels has keys, level and n; a sample has 256 rows at most.
    """
    all_ = Window.partitionBy(*keys)
    up = all_.orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weighted = F.col("level").cast("long") * F.col("n")
    rows = levels.withColumns({"all_": F.sum("n").over(all_), "sum_": F.sum(weighted).over(all_), "n_": F.sum("n").over(up), "s_": F.sum(weighted).over(up)})
    d = lambda c: F.col(c).cast("double")
    apart = d("all_") * d("s_") - d("sum_") * d("n_")
    between = F.when(F.col("n_") < F.col("all_"), apart * apart / (d("n_") * (d("all_") - d("n_"))))
    share = d("n") / d("all_")
    best = F.max(F.when(between.isNotNull(), F.struct(between.alias("between"), (-F.col("level")).alias("level"))))
    return rows.groupBy(*keys).agg(
        F.sum("n").alias("n_pixels"), (F.sum(weighted).cast("double") / F.sum("n").cast("double")).alias("mean"),
        *(F.min(F.when(d("n_") >= F.lit(p) * d("all_"), F.col("level"))).alias(f"p{round(100 * p):02d}") for p in at),
        F.greatest(-F.sum(share * F.log2(share)), F.lit(0.0)).alias("entropy"), (-best["level"]).alias("threshold"),
    )
