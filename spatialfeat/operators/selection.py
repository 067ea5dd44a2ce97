"""Choosing samples, patches and rows: semi and anti joins, first rows, metadata, even spacing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import keys_of


def of_samples(df: DataFrame, wanted: DataFrame | None, key: str = "sample_id") -> DataFrame:
    """Rows of the wanted samples in their own order; None keeps all, unknown ids are ignored."""
    return df if wanted is None else df.join(wanted.select(key).distinct(), key, "left_semi")


def not_done(requested: DataFrame, done: DataFrame, key: str = "sample_id", overwrite: bool = False) -> DataFrame:
    """Samples that are requested and not there yet."""
    return requested if overwrite else requested.join(done.select(key), key, "left_anti")


def by_barcode(features: DataFrame, expression: DataFrame, key: str = "barcode") -> DataFrame:
    """Rows of both tables that share a barcode, and a sample where both have one: barcodes repeat across samples."""
    return features.join(expression, keys_of(features, expression, keys=(key,)))


def chunks_joined(*chunks: DataFrame) -> DataFrame:
    """All chunks with the union of their columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)


def first_rows(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order, by a minimum over structs."""
    rest = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), *rest)).alias("best") if not set(order) & set(rest) else F.min(F.struct(*order, *(c for c in rest if c not in order))).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, *(F.col(f"best.{c}").alias(c) for c in rest))


def among(df: DataFrame, column: str, wanted: list[str] | DataFrame) -> DataFrame:
    """Rows whose column is one of some values: of a list that the settings hold, or of the only column of a table."""
    if not isinstance(wanted, DataFrame):
        return df.where(F.col(column).isin(wanted))
    values = wanted.toDF("wanted_")
    return df.join(values, F.col(column) == F.col("wanted_"), "left_semi")


def wanted_datasets(meta: DataFrame, oncotrees: list[str] | DataFrame, technologies: list[str] | DataFrame, species: str = "Homo sapiens") -> DataFrame:
    """The datasets of a species with a wanted tumour type and technology."""
    return among(among(meta.where(F.col("species") == species), "oncotree_code", oncotrees), "st_technology", technologies)


def allow_patterns(samples: DataFrame, required: list[str], optional: list[str]) -> DataFrame:
    """Download patterns of every folder (first seen order) and sample; the folders are a short list in the plan."""
    folders = F.array(*map(F.lit, dict.fromkeys([*required, *optional])))
    each = samples.select("sample_id", F.posexplode(folders).alias("place", "folder"))
    return each.select("place", "sample_id", F.concat("folder", F.lit("/*"), "sample_id", F.lit("[_.]**")).alias("pattern"))


def evenly_spaced(position: Column, n: Column, ratio: float) -> Column:
    """Whether a 0-based position is among the k = ceil(n ratio) evenly spaced ones of n, first and last included.

    The i-th is floor(i (n - 1) / (k - 1)); whether some i gives a position is decided from the position alone, so no list
    of positions is joined.
    """
    if not 0 < ratio <= 1:
        raise ValueError(f"ratio must be in (0, 1], is {ratio}")
    k = F.greatest(F.lit(1), F.ceil(n * F.lit(ratio)))
    step = F.try_divide((n - 1).cast("double"), k - 1)
    guess = F.floor(F.try_divide(position.cast("double"), step))
    at = lambda i: F.when(i == k - 1, n - 1).otherwise(F.floor(i * step))
    hit = F.lit(False)
    for shift in (0, 1):
        i = guess + shift
        hit = hit | ((i <= k - 1) & (at(i) == position))
    return F.when(k >= n, F.lit(True)).when(k == 1, position == 0).otherwise(F.coalesce(hit, F.lit(False)))


def chosen(patches: DataFrame, ratio: float = 1.0, listed: list[int] | None = None, sample: str = "sample_id", patch: str = "patch_idx") -> DataFrame:
    """(sample, patch) of the patches that are looked at: those listed, else the evenly spaced ones among the distinct patches
    of every sample in order. Only keys of patches meet in the window of a sample."""
    each = patches.select(sample, patch).distinct()
    if listed is not None:
        return each.where(F.col(patch).isin(list(listed)))
    own = Window.partitionBy(sample)
    placed = each.select("*", (F.row_number().over(own.orderBy(patch)) - 1).alias("place_"), F.count("*").over(own).alias("n_"))
    return placed.where(evenly_spaced(F.col("place_"), F.col("n_"), ratio)).select(sample, patch)
