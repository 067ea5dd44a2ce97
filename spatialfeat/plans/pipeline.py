"""The extraction drivers: masks, features and status of all patches of all samples in one plan, then normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import kernels
from ..functions.names import feature_prefix
from ..functions.status import blank_on_error
from ..operators.cells import class_counts, class_shares, measured, normalised_cells, statistics as cell_statistics
from ..operators.describe import box_stats, describe, ok_rows, representatives
from ..operators.geometry import polygons_of
from ..operators.normalize import normalization_stats, normalize
from ..operators.spread import enough_partitions, fitting_batches
from ..operators.texture import MORPHOLOGY, feature_names, patch_features
from ..schema import SMALLEST_MASK, Config, described_columns
from ..sources import sinks

KEYS = ["sample_id", "patch_idx"]
PLACES = ("barcode", "x", "y")


def _options(config: Config, smallest: int) -> dict:
    offsets = {"plane": kernels.PLANE, "axis": kernels.AXIS}[config.directions]
    return {"filters": config.filters, "width": config.bin_width, "offsets": offsets, "smallest": smallest, "label": config.label}


def _rows(made: DataFrame, places: list[str], areas: dict[str, Column], config: Config, prefix: str, rest: list[Column]) -> DataFrame:
    """The columns of a raw feature table in order; of a patch that is no image, nothing but keys, status and message stays."""
    keep = blank_on_error(F.col("status"))
    filters = [f.lower() for f in config.filters if f.lower() != "original"]
    return made.select(
        *KEYS, *(keep(F.col(c)).alias(c) for c in places), keep(F.lit("")).alias("mask_path"), "status", "error", *(keep(v).alias(k) for k, v in areas.items()),
        *(F.col(f).alias(f"{prefix}{f}") for f in feature_names(filters)), *rest,
    )


def threshold_features(patches: DataFrame, config: Config | None = None, smallest: int = SMALLEST_MASK) -> DataFrame:
    """Raw features of gray or RGB patches under the threshold mask, prefix patch_, in one pass without a shuffle.

    A patch with a small mask is skipped, one that is no image has status `error` and a message.
    """
    config = config or Config()
    places = [c for c in PLACES if c in patches.columns]
    made = patch_features(patches, [*KEYS, *places], **_options(config, smallest))
    return _rows(made, places, {"patch_mask_area": F.col("mask_area")}, config, feature_prefix("patch"), [])


def cell_features(patches: DataFrame, cells: DataFrame, config: Config | None = None, measurements: list[str] = (), order: list[str] = (), smallest: int = SMALLEST_MASK, bucketed: bool = False) -> DataFrame:
    """Raw features under the union of the cells, prefix cellseg_all_, with composition and morphology of the cells.

    Cells are summed up per patch, with their outlines and measurements, and meet it in one join. Both sides are dealt by patch for it, which also spreads the kernels,
    unless both tables are `bucketed` by sample_id and patch_idx; raster, texture and the shapes of all cells with their 18 statistics are then one pass. Shapes are
    painted in `order`, by default by cell_id_in_patch, the file order. Patches without cells are skipped with a composition of
    zeros; unions under `smallest` pixels have no texture but are ok. A cell without a shape is left out of the statistics, and
    so are null values of further `measurements`, columns of cells.
    """
    config = config or Config()
    cells = normalised_cells(cells)
    order = list(order) or [c for c in ("cell_id_in_patch",) if c in cells.columns]
    one = F.col("geometry")
    parts = one if isinstance(cells.schema["geometry"].dataType.elementType.elementType, T.ArrayType) else F.array(one)
    extra = [measured(measurements).alias("m")] if measurements else []
    drawn = F.collect_list(F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), polygons_of(parts).alias("geometry"), *extra))
    n = None if bucketed else enough_partitions(patches)
    dealt = lambda df: df if n is None else df.repartition(n, *KEYS)
    measures = cell_statistics(F.transform("drawn_", lambda c: c["m"]), list(measurements)) if measurements else []
    per = dealt(cells).groupBy(*KEYS).agg(*class_counts(), drawn.alias("drawn_"))
    per = per.select("*", F.transform(F.array_sort("drawn_"), lambda c: c["geometry"]).alias("cells"), *measures).drop("drawn_")
    told = [c for c in per.columns if c not in (*KEYS, "cells")]
    places = [c for c in PLACES if c in patches.columns]
    met = dealt(patches).join(per, KEYS, "left")
    made = patch_features(met, [*KEYS, *places, *told], cells="cells", **_options(config, smallest))
    keep = blank_on_error(F.col("status"))
    rest = [F.col(m).alias(f"morph_{m}") for m in MORPHOLOGY] + [keep(v).alias(k) for k, v in class_shares().items()]
    areas = {"n_cells_total": F.coalesce("dist_n", F.lit(0)), "cellseg_mask_area": F.col("mask_area")}
    rest += [F.col(f"`{c}`") for c in told if not c.startswith("dist_")]
    return _rows(made, places, areas, config, feature_prefix("cellseg", "all"), rest)


def raw_features(patches: DataFrame, cells: DataFrame | None, config: Config, measurements: list[str] = (), order: list[str] = ()) -> DataFrame:
    """Features before normalisation, by the mask source of the settings."""
    if config.mask_source == "threshold":
        return threshold_features(patches, config)
    if config.mask_source == "cellseg":
        if cells is None:
            raise ValueError("mask source cellseg needs cells")
        return cell_features(patches, cells, config, list(measurements), list(order))
    raise ValueError(f"mask source must be threshold or cellseg, is {config.mask_source!r}")


def extract(patches: DataFrame, cells: DataFrame | None, config: Config, measurements: list[str] = (), order: list[str] = ()) -> DataFrame:
    """The processed feature table of all samples, as one plan."""
    return normalize(raw_features(patches, cells, config, measurements, order), lower=config.lower_q, upper=config.upper_q)


def extract_to(patches: DataFrame, cells: DataFrame | None, config: Config, path: str, measurements: list[str] = (), order: list[str] = ()) -> None:
    """Extracts and writes all outputs of the samples of patches, and leaves those of other samples alone.

    Raw features are written once and read for all of the outputs.
    """
    spark = patches.sparkSession
    fitting_batches(patches)
    some = [r[0] for r in patches.select("sample_id").distinct().collect()]  # names of the samples of one run
    sinks.samples(raw_features(patches, cells, config, measurements, order), f"{path}/raw")
    raw = sinks.read_samples(spark, f"{path}/raw").where(F.col("sample_id").isin(some))
    options = {"lower": config.lower_q, "upper": config.upper_q}
    sinks.processed(normalize(raw, **options), normalization_stats(raw, **options), path, some)


def statistics(features: DataFrame, config: Config, order: list[str], carry: list[str]) -> dict[str, DataFrame]:
    """Descriptive statistics, and as the settings ask box statistics and representatives, of processed features per sample."""
    ok = ok_rows(features)
    names = [c for c in described_columns(ok) if c not in order]
    out = {"describe": describe(ok, names, ["sample_id"]).orderBy("sample_id", "feature_class", "feature_name")}
    if config.save_boxplot:
        out["box"] = box_stats(ok, names)
    if config.save_representative:
        out["representatives"] = representatives(ok, names, order, carry, stats=config.representative_stats)
    return out
