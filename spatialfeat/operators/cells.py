"""Cells per patch: composition, counts, numbering, majority class, summaries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import kernels
from ..functions.columns import finite
from ..functions.names import class_name
from ..schema import CLASS_NAMES, KNOWN_CELL_CLASSES, keys_of


def normalised_cells(cells: DataFrame) -> DataFrame:
    """Cells with a class: class_name from itself, else from class_id, else unknown; cells without geometry go."""
    raw = F.col("class_name") if "class_name" in cells.columns else F.col("class_id").cast("string") if "class_id" in cells.columns else F.lit("unknown")
    out = cells.withColumn("class_name", class_name(raw))
    return out.where(F.col("geometry").isNotNull()) if "geometry" in cells.columns else out


def class_counts(classes=KNOWN_CELL_CLASSES) -> list[Column]:
    """Aggregates over cells: dist_n and dist_n_CLASS."""
    c = class_name(F.col("class_name"))
    return [F.count("*").alias("dist_n"), *(F.count_if(c == k).alias(f"dist_n_{k}") for k in classes)]


def class_shares(classes=KNOWN_CELL_CLASSES) -> dict[str, Column]:
    """Total, counts and shares by name from class_counts; zeros where there are none."""
    count = lambda k: F.coalesce(F.col(k), F.lit(0)).cast("double")
    total = count("dist_n")
    out = {"dist_cell_count_total": total}
    for k in classes:
        out |= {f"dist_count_{k}": count(f"dist_n_{k}"), f"dist_ratio_{k}": F.when(total > 0, count(f"dist_n_{k}") / total).otherwise(0.0)}
    return out


def composition(patches: DataFrame, cells: DataFrame, keys=("patch_idx",), classes=KNOWN_CELL_CLASSES) -> DataFrame:
    """Counts and shares of known classes for every patch, zeros for patches without cells; unknown cells count in the total.

    Cells are summed up before they meet the patches, so the join carries one row per patch.
    """
    per = cells.groupBy(*keys).agg(*class_counts(classes))
    return patches.select(*keys).join(per, list(keys), "left").select(*keys, *(v.alias(k) for k, v in class_shares(classes).items()))


def patch_counts(cells: DataFrame, order: list[str] = ("cell_id_in_patch",)) -> DataFrame:
    """Cells per patch and barcode (and sample, if there is one); a count that the cells carry is taken from the first of a patch."""
    keys = keys_of(cells)
    if "n_cells" in cells.columns:
        return cells.groupBy(*keys).agg(F.min(F.struct(*order, "barcode", "n_cells")).alias("x")).select(*keys, "x.barcode", "x.n_cells")
    return cells.groupBy(*keys, "barcode").agg(F.count("*").alias("n_cells"))


def numbered(cells: DataFrame, order: list[str], keys=("patch_idx",)) -> DataFrame:
    """cell_id_in_patch: 1-based order of appearance."""
    return cells.withColumn("cell_id_in_patch", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))


def class_of(class_id: Column) -> Column:
    """The name of a class, class_N for one without."""
    name = F.concat(F.lit("class_"), class_id.cast("string"))
    for k, v in CLASS_NAMES.items():
        name = F.when(class_id == k, v).otherwise(name)
    return name


def majority_class(pixels: DataFrame, keys: list[str], class_id: str = "class_id") -> DataFrame:
    """Most frequent positive class, the smallest of equally frequent ones, -1 if there is none; with its name."""
    mode = F.mode(F.when(F.col(class_id) > 0, F.col(class_id)), True)
    found = pixels.groupBy(*keys).agg(F.coalesce(mode, F.lit(-1)).cast("long").alias("class_id"))
    return found.withColumn("class_name", class_of(F.col("class_id")))


def with_summary(cells: DataFrame, summary: DataFrame | None) -> DataFrame:
    """Cells with n_cells, coord_raw and its JSON twin of their sample (if both have it), patch and barcode (null meets null);
    patches without cells have no row."""
    if summary is None:
        return cells.withColumns({"coord_raw": F.lit(None).cast("array<double>"), "coord_raw_json": F.lit(None).cast("string"), "n_cells": F.lit(0).cast("long")})
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys_of(cells, summary, keys=("patch_idx", "barcode"))]
    met = cells.alias("a").join(summary.alias("b"), same, "left")
    return met.select("a.*", "b.coord_raw", F.to_json("b.coord_raw").alias("coord_raw_json"), F.coalesce("b.n_cells", F.lit(0)).alias("n_cells"))


def tallies(cells: DataFrame, patches: DataFrame) -> DataFrame:
    """Numbers of patches and polygons of a sample, as one row."""
    return patches.agg(F.count("*").alias("num_patches")).withColumn("num_polygons", cells.agg(F.count("*")).scalar())


#: Names of the statistics of a cell measurement over a patch.
MORPH_STATS = kernels.STATISTICS


def _statistics(measured: pa.Array) -> pa.Array:
    """The statistics of every member of arrays of structs of numbers, one after the other; null where an array has no number of it."""
    rows, most = len(measured), len(MORPH_STATS)
    cells = measured.flatten()
    row = np.repeat(np.arange(rows), np.asarray(measured.value_lengths().fill_null(0)))
    out, none = [], []
    for k in range(cells.type.num_fields):
        x = np.asarray(cells.field(k).fill_null(np.nan), float)
        own = np.isfinite(x)
        out.append(kernels.statistics_of(x[own][:, None], row[own], rows, floor=True))
        none.append(np.repeat(np.bincount(row[own], minlength=rows)[:, None] == 0, most, axis=1))
    values = pa.array(np.hstack(out).ravel(), pa.float64(), mask=np.hstack(none).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * most * len(out), pa.int32()), values)


def measured(features: list[str]) -> Column:
    """The measurements of a cell as one struct; what is not a finite number is null."""
    return F.struct(*(finite(F.col(f"`{f}`")).alias(f"m{i}") for i, f in enumerate(features)))


def statistics(of: Column, features: list[str], prefix: str = "morph_") -> list[Column]:
    """prefix_feature_statistic from an array of what measured() gives, for all features in one pass over it in Python."""
    made = F.arrow_udf(_statistics, "array<double>")(of)
    names = [f"{prefix}{f}_{k}" for f in features for k in MORPH_STATS]
    return [F.get(made, F.lit(i)).alias(n) for i, n in enumerate(names)]


def measurement_stats(cells: DataFrame, features: list[str], keys=("patch_idx",), prefix: str = "morph_") -> DataFrame:
    """18 statistics of each measurement over the cells of a patch, as prefix_feature_statistic.

    The cells of a patch are gathered once with all measurements (a patch holds a bounded number of cells), so that quantiles, deviations
    from the mean and the histogram need no second shuffle; arrays of many patches are then measured at once. Values that are not
    finite are left out; without any the statistics are null. Kurtosis is the excess; skewness and kurtosis of a constant are 0.
    """
    agg = cells.groupBy(*keys).agg(F.collect_list(measured(features)).alias("measured_"))
    return agg.select(*keys, *statistics(F.col("measured_"), features, prefix))


def of_patches(cells: DataFrame, patches: DataFrame, key: str = "patch_idx") -> DataFrame:
    """Cells of the patches that are there, with their sample.

    Numbers of patches that lie outside those of the patches cannot meet one: such cells are left out before the join, so that it does not shuffle
    the cells of a whole dataset for some of its patches.
    """
    low, high = (patches.agg(end(key)).scalar() for end in (F.min, F.max))
    return cells.where((F.col(key) >= low) & (F.col(key) <= high)).join(patches.select(key, "sample_id"), key)
