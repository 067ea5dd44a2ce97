"""String functions on names, as columns and as Python for plan-time use."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import FEATURE_CLASS_PREFIXES

LONGEST_NAME = 180


def class_name(col: Column, missing: str = "unknown") -> Column:
    """Cell class: trimmed of all blanks, lower case, blanks to underscores; null is `missing`."""
    return F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(col.cast("string"), F.lit(missing)), r"^\s+|\s+$", "")), " ", "_")


def class_name_scalar(value: object) -> str:
    """The same for one value; None reads 'none'."""
    return str(value).strip().lower().replace(" ", "_")


def _squeezed(col: Column, pattern: str) -> Column:
    once = F.regexp_replace(col, pattern, "_")
    return F.substring(F.regexp_replace(F.regexp_replace(once, "_+", "_"), "^_|_$", ""), 1, LONGEST_NAME)


def file_name(col: Column) -> Column:
    """File name of a feature: runs of anything but word characters, - and . become one underscore."""
    return _squeezed(col, r"(?U)[^\w\-.]+")


def path_name(col: Column) -> Column:
    """File name of a barcode: runs of separators, reserved characters and blanks become one underscore; null is ''."""
    return _squeezed(F.coalesce(col, F.lit("")), r"""(?U)[\\/:*?"<>|\s]+""")


def base_name(index: Column, barcode: Column | None = None) -> Column:
    """patch_ and the index in six digits, with the barcode if there is one."""
    start = F.concat(F.lit("patch_"), F.when(F.length(index.cast("string")) < 6, F.lpad(index.cast("string"), 6, "0")).otherwise(index.cast("string")))
    if barcode is None:
        return start
    return F.when(F.coalesce(barcode, F.lit("")) != "", F.concat(start, F.lit("_"), path_name(barcode))).otherwise(start)


def without_shape2d(col: Column) -> Column:
    """Shape feature name in lower case without its image and class prefix."""
    return F.replace(F.replace(F.lower(col), F.lit("original_shape2d_"), F.lit("")), F.lit("original_shape2_d_"), F.lit(""))


def feature_prefix(*parts: str | None) -> str:
    """Normalised non-empty parts joined by underscores, with one at the end."""
    return "_".join(class_name_scalar(p) for p in parts if p) + "_"


def feature_class(name: Column) -> Column:
    """Class of a feature by its prefix; the first class that fits."""
    out = F.lit("others")
    for cls, prefixes in reversed(FEATURE_CLASS_PREFIXES.items()):
        fits = F.lit(False)
        for p in prefixes:
            fits = fits | name.startswith(p)
        out = F.when(fits, cls).otherwise(out)
    return out


def decoded(col: Column, missing: str | None = None, array: bool = False) -> Column:
    """Barcode as text: bytes are read as UTF-8, and with `array` the first element of an array."""
    text = (F.get(col, F.lit(0)) if array else col).cast("string")
    return text if missing is None else F.coalesce(text, F.lit(missing))


# Texts of truth values, and what means nothing.
TRUE, FALSE = ("true", "1", "yes", "y"), ("false", "0", "no", "n")
NOTHING = ("None", "none", "", [], None)


def as_bool(value: object) -> bool | None:
    """Truth of a setting; None stays None, other texts are an error."""
    if value is None or isinstance(value, bool):
        return value
    found = [truth for truth, texts in ((True, TRUE), (False, FALSE)) if str(value).strip().lower() in texts]
    if not found:
        raise ValueError(f"not a truth value: {value!r}")
    return found[0]


def none_like(value: object) -> object:
    """None for what means nothing."""
    return None if value in NOTHING else value
