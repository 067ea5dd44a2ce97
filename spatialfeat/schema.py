"""Tables of the engine: types, column roles by name, and aliases of source columns."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names that readers and writers of these tables agree on.
KNOWN_CELL_CLASSES = ("neoplastic", "inflammatory", "connective", "dead", "epithelial")
CLASS_NAMES = {0: "background", 1: "neoplastic", 2: "inflammatory", 3: "connective", 4: "dead", 5: "epithelial"}
IMAGE_TYPES = ("original_", "wavelet-", "log-sigma-", "square_", "squareroot_", "logarithm_", "exponential_")
META_COLUMNS = ("sample_id", "patch_idx", "barcode", "mask_path", "color_path", "gray_path", "x", "y", "coord_x", "coord_y", "status")
FEATURE_CLASS_PREFIXES = {
    "cell_count": ("n_cells_total", "cellseg_mask_area"),
    "cellseg_firstorder": ("cellseg_all_original_firstorder_",),
    "cellseg_glcm": ("cellseg_all_original_glcm_",),
    "cellseg_glrlm": ("cellseg_all_original_glrlm_",),
    "cellseg_glszm": ("cellseg_all_original_glszm_",),
    "cellseg_gldm": ("cellseg_all_original_gldm_",),
    "cellseg_ngtdm": ("cellseg_all_original_ngtdm_",),
    "morph": ("morph_",),
    "dist": ("dist_",),
}
# Names that a role may have, the first that is there counts, per reader.
ALIASES = {
    "extract": {"img": ("img", "imgs", "images", "patches"), "coords": ("coords", "coord", "coordinates", "spatial"), "barcode": ("barcodes", "barcode", "spot_id", "spot_ids")},
    "patch": {"img": ("img", "imgs", "images"), "coords": ("coords",), "barcode": ("barcodes", "barcode")},
    "segment": {"img": ("img", "imgs", "images"), "coords": ("coords",), "barcode": ("barcode", "barcodes")},
}
#: Roles that a reader cannot do without.
REQUIRED = {"extract": ("img", "coords", "barcode"), "patch": ("img",), "segment": ("img", "barcode")}
STATUS_OK, STATUS_ERROR = "ok", "error"
SKIPPED_SMALL_MASK, SKIPPED_NO_CELLS = "skipped_small_mask", "skipped_no_cellseg_mask"
ERROR_PATCH, ERROR_CELLSEG, ERROR_MORPHOLOGY = "error_patch_radiomics", "error_cellseg_radiomics", "error_morphology"
SMALLEST_MASK = 50
MASK_LOW, MASK_HIGH, MASK_LABEL = 30, 220, 255

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(POINT))
CELLS = T.StructType([
    T.StructField("patch_idx", T.LongType()), T.StructField("barcode", T.StringType()), T.StructField("cell_id_in_patch", T.LongType()),
    T.StructField("class_id", T.LongType()), T.StructField("class_name", T.StringType()), T.StructField("geometry", RINGS),
])
PATCHES = T.StructType([
    T.StructField("sample_id", T.StringType()), T.StructField("patch_idx", T.LongType()), T.StructField("barcode", T.StringType()), T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()), T.StructField("h", T.IntegerType()), T.StructField("w", T.IntegerType()), T.StructField("px", T.ArrayType(T.IntegerType())),
])


@dataclass(frozen=True)
class Config:
    """Settings of the drivers.

    directions: `plane` (four directions, eight neighbours) or `axis` (one direction, two neighbours) of texture features.
    filters: image types besides the original: square, squareroot, logarithm, exponential.
    """

    root: str = "data"
    oncotrees: tuple[str, ...] = ("IDC",)
    sample_ids: tuple[str, ...] | None = None
    mask_source: str = "threshold"
    output_dirname: str = "radiomics"
    lower_q: float = 0.01
    upper_q: float = 0.99
    bin_width: int = 25
    directions: str = "plane"
    filters: tuple[str, ...] = ()
    label: int = MASK_LABEL
    representative_stats: tuple[str, ...] = ("min", "q25", "q50", "q75", "max")
    save_boxplot: bool = True
    save_representative: bool = True
    genes_k: tuple[int, ...] = (50, 100, 250)
    genes_criteria: tuple[str, ...] = ("var", "mean")
    gene_share: float = 0.1
    vis_ratio: float = 0.02
    overwrite: bool = False

    def __post_init__(self):
        if self.directions not in ("plane", "axis"):
            raise ValueError(f"directions must be plane or axis, is {self.directions!r}")


def resolve(df: DataFrame, role: str, reader: str = "extract") -> str | None:
    """The column that plays a role for a reader: the first of its names that is there, None if it may be missing."""
    for name in ALIASES[reader][role]:
        if name in df.columns:
            return name
    if role in REQUIRED[reader]:
        raise KeyError(f"no column for {role}: one of {ALIASES[reader][role]} is needed, there are {df.columns}")
    return None


def keys_of(*tables: DataFrame, keys: tuple[str, ...] = ("patch_idx",)) -> list[str]:
    """Keys of patches, with the sample where all tables have it: patch numbers and barcodes repeat across samples."""
    return [*(("sample_id",) if all("sample_id" in t.columns for t in tables) else ()), *keys]


def is_normalised(name: str) -> bool:
    """Whether a column is a feature that is normalised: morphology, or texture of patch or cells."""
    low = name.lower()
    if low.startswith("morph_"):
        return True
    if not low.startswith(("patch_", "cellseg")):
        return False
    rest = low.partition("_")[2]
    return any(t in rest for t in IMAGE_TYPES)


def normalised_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if is_normalised(c)]


def described_columns(df: DataFrame) -> list[str]:
    """Numeric columns that are neither metadata nor diagnostics."""
    kinds = (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in META_COLUMNS and not f.name.startswith("diagnostics_")]


def radiomics_key(name: Column) -> Column:
    """Whether a raw result is a feature of some image type (diagnostics are not)."""
    low = F.lower(name)
    return reduce(or_, (low.startswith(t) for t in IMAGE_TYPES))
