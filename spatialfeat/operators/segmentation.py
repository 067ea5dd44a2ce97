"""The relational side of cell segmentation: rows of cells from whatever a segmenter returns, and what is said of them.

A segmenter is not part of the engine; its output is a table with one row per polygon.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import decoded
from ..schema import keys_of
from .cells import class_of
from .geometry import instance_parts


def cell_rows(found: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Typed cells: class_id -1 and class_name unknown where missing, numbers from 1 in order where there are none."""
    has = found.columns
    class_id = F.coalesce(F.col("class_id").cast("long"), F.lit(-1).cast("long")) if "class_id" in has else F.lit(-1).cast("long")
    class_name = F.coalesce(F.col("class_name").cast("string"), F.lit("unknown")) if "class_name" in has else F.lit("unknown")
    if "cell_id_in_patch" in has:
        number = F.col("cell_id_in_patch").cast("long")
    else:
        own = Window.partitionBy(*keys_of(found, keys=("patch_idx", "barcode")))
        number = F.row_number().over(own.orderBy(*(order or ["geometry"]))).cast("long")
    keys = [c for c in ("sample_id",) if c in has]
    array = isinstance(found.schema["barcode"].dataType, T.ArrayType)
    columns = [F.col("patch_idx").cast("long").alias("patch_idx"), decoded(F.col("barcode"), array=array).alias("barcode"), number.alias("cell_id_in_patch")]
    return found.select(*keys, *columns, class_id.alias("class_id"), class_name.alias("class_name"), "geometry")


def patch_summary(patches: DataFrame, cells: DataFrame) -> DataFrame:
    """Sample (if both have it), patch_idx, barcode, coord_raw and n_cells of every patch; n_cells counts polygons, several may be
    of one instance."""
    keys = keys_of(patches, cells)
    met = patches.join(cells.groupBy(*keys).agg(F.count("*").alias("n_cells")), keys, "left")
    return met.select(*keys, "barcode", F.array("x", "y").alias("coord_raw"), F.coalesce("n_cells", F.lit(0)).alias("n_cells"))


def sample_summary(patches: DataFrame, cells: DataFrame) -> DataFrame:
    """num_patches and num_polygons of every sample, also of those without a cell."""
    n = cells.groupBy("sample_id").agg(F.count("*").alias("num_polygons"))
    return patches.groupBy("sample_id").agg(F.count("*").alias("num_patches")).join(n, "sample_id", "left").na.fill(0, ["num_polygons"])


def cells_from_masks(patches: DataFrame, keys: list[str], mask: str = "mask", types: str = "types", h: str = "h", w: str = "w", every: bool = False) -> DataFrame:
    """Cells of an instance mask: 8-connected parts that have an outline, the majority of their positive pixel types, and their outlines.

    With `every`, parts without an outline (pixels, lines, spikes) are instances too; their geometry is null.
    """
    parts = instance_parts(patches, keys, types, mask, h, w, every).select(*keys, F.explode("parts").alias("p"))
    return parts.select(*keys, "p.cell_id_in_patch", "p.class_id", class_of(F.col("p.class_id")).alias("class_name"), "p.geometry")


def overlay_rows(patches: DataFrame, cells: DataFrame) -> DataFrame:
    """Patches with their cells as arrays of (class_name, geometry), empty where there is none: what an overlay draws."""
    keys = keys_of(patches, cells)
    per = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("cell_id_in_patch", "class_name", "geometry"))).alias("cells"))
    none = F.array().cast(per.schema["cells"].dataType)
    return patches.join(per, keys, "left").withColumn("cells", F.coalesce("cells", none))
