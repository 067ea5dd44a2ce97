"""Pixel expressions on in-row arrays: gray, masks, regions, point-wise filters. Nothing is exploded."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MASK_HIGH, MASK_LABEL, MASK_LOW


def gray_of(r: Column, g: Column, b: Column) -> Column:
    """Luma of 8-bit channels in 16-bit fixed point, rounded."""
    return F.shiftright(r * 19595 + g * 38470 + b * 7471 + 32768, 16)


def gray(px: Column) -> Column:
    """Gray values of interleaved RGB pixels."""
    n = (F.size(px) / 3).cast("int")
    at = lambda i, c: F.get(px, i * 3 + c)
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: gray_of(at(i, 0), at(i, 1), at(i, 2)))).otherwise(F.array().cast("array<int>"))


def interleaved(px: Column, h: Column, w: Column, channels: int = 3) -> Column:
    """Pixels of a channels-first image in channels-last order."""
    n = h * w
    return F.transform(F.sequence(F.lit(0), n * channels - 1), lambda i: F.get(px, (i % channels) * n + (i / channels).cast("int")))


def without_alpha(px: Column) -> Column:
    """RGB of interleaved RGBA pixels."""
    return F.filter(px, lambda _, i: i % 4 != 3)


def repeated(px: Column) -> Column:
    """RGB of gray pixels."""
    return F.flatten(F.transform(px, lambda v: F.array(v, v, v)))


def as_uint8(values: Column) -> Column:
    """8-bit values of a float image: scaled by 255 if nothing is above 1, clipped and truncated."""
    x = F.transform(values, lambda v: v.cast("float"))
    scale = F.when(F.array_max(x) <= 1.0, F.lit(255.0)).otherwise(F.lit(1.0)).cast("float")
    return F.transform(x, lambda v: F.floor(F.greatest(F.least(v * scale, F.lit(255.0)), F.lit(0.0))).cast("int"))


def in_mask(g: Column) -> Column:
    """Tissue: strictly between the thresholds."""
    return (g > MASK_LOW) & (g < MASK_HIGH)


def threshold_mask(px: Column, label: int = MASK_LABEL) -> Column:
    return F.transform(px, lambda g: F.when(in_mask(g), label).otherwise(0))


def full_mask(px: Column, label: int = MASK_LABEL) -> Column:
    return F.transform(px, lambda _: F.lit(label))


def masked(px: Column, mask: Column) -> Column:
    """Pixels inside the mask, 0 outside."""
    return F.zip_with(px, mask, lambda v, m: F.when(m > 0, v).otherwise(0))


def mask_area(mask: Column) -> Column:
    return F.size(F.filter(mask, lambda m: m > 0)).cast("long")


def region(px: Column, mask: Column) -> Column:
    """Values inside the mask."""
    return F.filter(F.zip_with(px, mask, lambda v, m: F.when(m > 0, v)), lambda v: v.isNotNull())


def filtered(px: Column, kind: str) -> Column:
    """Point-wise image filters: square, squareroot, logarithm, exponential; scaled to the range of the image."""
    x = F.transform(px, lambda v: v.cast("double"))
    top = F.array_max(F.transform(x, F.abs))
    if kind == "square":
        return F.transform(x, lambda v: F.pow(v / F.sqrt(top), F.lit(2)))
    if kind == "squareroot":
        return F.transform(x, lambda v: F.signum(v) * F.sqrt(top * F.abs(v)))
    if kind == "logarithm":
        return F.transform(x, lambda v: F.signum(v) * top / F.log(top + 1) * F.log(F.abs(v) + 1))
    if kind == "exponential":
        return F.transform(x, lambda v: F.exp(F.log(top) / top * v))
    raise ValueError(f"no such filter: {kind}")


def in_bytes(px: Column) -> Column:
    """Pixels of 8 bits as bytes."""
    return F.unhex(F.array_join(F.transform(px, lambda v: F.lpad(F.hex(v.cast("long")), 2, "0")), ""))
