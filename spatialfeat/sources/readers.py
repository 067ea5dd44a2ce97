"""Readers. A dataset is one partitioned table instead of a file per sample; discovery lists its partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import class_name, decoded
from ..functions.pixels import as_uint8, interleaved, repeated, without_alpha
from ..operators.describe import ok_rows
from ..operators.expression import totals as matrix_totals
from ..operators.expression import unique_observations
from ..operators.genes import Totals
from ..operators.genes import totals as long_totals
from ..operators.geometry import from_wkb, from_wkt
from ..operators.selection import of_samples, wanted_datasets
from ..schema import resolve
from . import h5ad
from .sinks import files_at, read_samples, samples_at

#: Endings of files that hold the patches of a sample.
HDF5_ENDINGS = (".h5", ".hdf5")

#: Columns that a table of segmented cells must have.
CELL_COLUMNS = ("patch_idx", "barcode", "cell_id_in_patch", "class_id", "class_name", "geometry_wkt")


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """The dataset catalogue, a CSV with a header."""
    names = spark.read.csv(path, header=True)
    return names.select(*(F.col(c).cast("string").alias(c) for c in ("id", "species", "oncotree_code", "st_technology")))


def wanted(spark: SparkSession, path: str, oncotrees: list[str], technologies: list[str]) -> DataFrame:
    return wanted_datasets(metadata(spark, path), oncotrees, technologies)


def _nested(df: DataFrame, name: str) -> int:
    """How many arrays deep a column is."""
    kind, depth = df.schema[name].dataType, 0
    while isinstance(kind, T.ArrayType):
        kind, depth = kind.elementType, depth + 1
    return depth


def image_columns(df: DataFrame, name: str) -> dict[str, Column]:
    """px, h, w and layout of an image column.

    An image is an array of rows of pixels of channels (channels last if their number fits there, else first), of rows of
    gray values, or already flat (values or bytes) beside h, w and maybe layout.
    """
    image, depth = F.col(name), _nested(df, name)
    if depth < 2:
        return {"px": image, "h": F.col("h"), "w": F.col("w"), "layout": F.col("layout") if "layout" in df.columns else F.lit(None).cast("string")}
    first = F.get(image, F.lit(0))
    if depth == 2:
        return {"px": F.flatten(image), "h": F.size(image), "w": F.size(first), "layout": F.lit("gray")}
    second = F.get(first, F.lit(0))
    last = F.size(second).isin(1, 3, 4)
    return {
        "px": F.flatten(F.flatten(image)), "h": F.when(last, F.size(image)).otherwise(F.size(first)), "w": F.when(last, F.size(first)).otherwise(F.size(second)),
        "layout": F.when(last, "hwc").otherwise("chw"),
    }


def patches(df: DataFrame, reader: str = "extract") -> DataFrame:
    """Patches under the names of the engine: px, h, w, layout, barcode as text, x and y, from the names that a reader takes.

    The readers are `extract`, `patch` and `segment`; they differ in names and in what may be missing. Pixels stay as they are:
    the feature pass reads gray and RGB in either order, and gives what is no image an error status.
    """
    code, at = resolve(df, "barcode", reader), resolve(df, "coords", reader)
    out = df.withColumns(image_columns(df, resolve(df, "img", reader)))
    text = F.lit(None).cast("string") if code is None else decoded(F.col(code), array=_nested(df, code) > 0)
    place = (lambda k: F.lit(None).cast("double")) if at is None else (lambda k: F.get(at, F.lit(k)).cast("double"))
    return out.withColumns({"barcode": text, "x": place(0), "y": place(1)})


def as_rgb8(df: DataFrame) -> DataFrame:
    """px as interleaved 8-bit RGB whatever the layout: gray is repeated, a fourth channel goes, floats are scaled."""
    n = F.col("h") * F.col("w")
    whole = df.schema["px"].dataType.elementType
    px = F.col("px") if isinstance(whole, T.IntegralType) else as_uint8(F.col("px"))
    channels = F.size("px") / F.greatest(n, F.lit(1))
    px = F.when((F.col("layout") == "chw") & (channels > 1), interleaved(px, F.col("h"), F.col("w"), channels.cast("int"))).otherwise(px)
    px = F.when(channels == 1, repeated(px)).when(channels == 4, without_alpha(px)).when(channels == 3, px)
    bad = F.raise_error(F.concat(F.lit("a patch has "), F.size("px").cast("string"), F.lit(" values"))).cast("array<int>")
    return df.withColumns({"px": F.coalesce(px, bad), "layout": F.lit("hwc")})


def cells(spark: SparkSession, path: str, window: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Segmented cells; a table without geometry is an error.

    geometry is an array of rings, an array of polygons, or well-known binary as GeoParquet has it; geometry_wkt is well-known text. Of a
    table with bounds (sinks.geo_cells) a window (xmin, ymin, xmax, ymax) reads the cells that reach into it, and no others of its row groups.
    """
    df = read_samples(spark, path)
    if "geometry" not in df.columns:
        if "geometry_wkt" not in df.columns:
            raise KeyError(f"cells need a geometry column, there are {df.columns}")
        if missing := [c for c in CELL_COLUMNS if c not in df.columns]:
            raise KeyError(f"cells with WKT need {missing}, there are {df.columns}")
        return df.withColumn("geometry", from_wkt("geometry_wkt")).drop("geometry_wkt")
    if window is not None:
        if "bbox" not in df.columns:
            raise KeyError("cells without bounds cannot be read by window")
        xmin, ymin, xmax, ymax = window
        df = df.where((F.col("bbox.xmax") >= xmin) & (F.col("bbox.xmin") <= xmax) & (F.col("bbox.ymax") >= ymin) & (F.col("bbox.ymin") <= ymax))
    return df.withColumn("geometry", from_wkb("geometry")) if isinstance(df.schema["geometry"].dataType, T.BinaryType) else df


def cells_normalised(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Cells with a normalised class; no path, no cells."""
    if path is None:
        return None
    df = cells(spark, path)
    if "patch_idx" not in df.columns:
        raise KeyError("cells need patch_idx")
    raw = F.col("class_name") if "class_name" in df.columns else F.col("class_id").cast("string") if "class_id" in df.columns else F.lit("unknown")
    return df.withColumn("class_name", class_name(raw))


def expression(spark: SparkSession, path: str, samples: DataFrame | None = None) -> DataFrame:
    """Expression of the wanted samples: a long table (sample_id, obs_id, gene, value) or a matrix in rows (sample_id, obs_row, obs_id,
    indices, data), whose observations get names of their own. No sample is an error."""
    df = of_samples(read_samples(spark, path), samples)
    if df.isEmpty():
        raise FileNotFoundError(f"no sample to read in {path}")
    return unique_observations(df) if "indices" in df.columns else df


def expression_totals(spark: SparkSession, path: str, samples: DataFrame | None = None) -> Totals:
    """Sums per sample and gene of either form, or of the HDF5 files in the folder; the genes of a matrix are in the table `path`_var
    (sample_id, index, gene), or in its file."""
    if files_at(spark, path, (".h5ad",)):
        matrix, var = h5ad.matrix(spark, path)
        matrix, var = of_samples(matrix, samples), of_samples(var, samples)
        if matrix.isEmpty():
            raise FileNotFoundError(f"no sample to read in {path}")
        return matrix_totals(unique_observations(matrix), var)
    df = expression(spark, path, samples)
    return matrix_totals(df, of_samples(read_samples(spark, f"{path}_var"), samples)) if "indices" in df.columns else long_totals(df)


def features(spark: SparkSession, path: str, status_filter: str | None = "ok") -> DataFrame:
    """A feature table, of rows with the status if it has one."""
    return ok_rows(read_samples(spark, path), status_filter)


def sample_ids(spark: SparkSession, path: str, wanted_ids: list[str] | None = None) -> list[str]:
    """Samples of a partitioned table and of HDF5 files beside it in order, or the wanted ones in the order asked for; unknown ids are left out."""
    there = sorted({*samples_at(spark, path), *files_at(spark, path, HDF5_ENDINGS)})
    return there if wanted_ids is None else [s for s in dict.fromkeys(wanted_ids) if s in set(there)]
