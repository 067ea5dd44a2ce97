"""Column-wise robust normalisation per sample: quantile clip, z-score, min-max, as one aggregate and one join.

Clipping at quantiles leaves the lower quantile as minimum and the upper one as maximum, and a z-score in between does not
change a min-max scaling, so the scaled value needs the two quantiles only. They come from an aggregate per sample and
feature; rows meet them in an equi-join on the sample.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip
from ..schema import STATUS_OK, normalised_columns
from .quantiles import PLACE, VALUES, long, met, with_quantiles, with_values


def _features(df: DataFrame, features: list[str] | None) -> list[str]:
    features = normalised_columns(df) if features is None else features
    if not features:
        raise ValueError("no feature columns to normalise")
    return features


def _bounded(df: DataFrame, features: list[str], keys: list[str], status: str | None, lower: float, upper: float) -> DataFrame:
    """df with VALUES on rows that are ok, and q_: lower and upper quantile of every feature."""
    return with_quantiles(with_values(df, features, None if status is None else F.col(status) == STATUS_OK), keys, [lower, upper])


def normalize(df: DataFrame, features: list[str] | None = None, keys=("sample_id",), status: str | None = "status", lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """Features in [0, 1] on rows that are ok, null on others; other columns are untouched.

    A feature that is constant or all null in a sample is 0 on every row that is ok, null ones included.
    """
    features = _features(df, features)
    return _scaled(_bounded(df, features, list(keys), status, lower, upper), df.columns, features, status)


def normalize_by(df: DataFrame, known: DataFrame, features: list[str], keys=("sample_id",), status: str | None = "status") -> DataFrame:
    """normalize() by quantiles that are known already, and the other columns of `known`, in one join.

    `known` has a row per key with q_: an array, by feature, of its lower and upper quantile. Keys that it lacks have no rows that are ok.
    """
    rest = [c for c in known.columns if c not in (*keys, "q_")]
    return _scaled(met(with_values(df, features), known, list(keys)), [*df.columns, *rest], features, status)


def _scaled(found: DataFrame, columns: list[str], features: list[str], status: str | None) -> DataFrame:
    """The columns of rows that have VALUES and q_, features scaled."""
    place = {f: i for i, f in enumerate(features)}

    def scaled(x: Column, q: Column) -> Column:
        low, high = q[0], q[1]
        return F.when(low.isNull() | (low == high), F.lit(0.0)).otherwise((clip(x, low, high) - low) / (high - low))

    every = F.zip_with(VALUES, "q_", scaled)
    found = found.withColumn("scaled_", every if status is None else F.when(F.col(status) == STATUS_OK, every))
    return found.select(*(F.get("scaled_", F.lit(place[c])).alias(c) if c in place else F.col(f"`{c}`") for c in columns))


def normalization_stats(df: DataFrame, features: list[str] | None = None, keys=("sample_id",), status: str | None = "status", lower: float = 0.01, upper: float = 0.99) -> DataFrame:
    """One row per key and feature: quantiles, moments after the clip, and what z-score and scaling come to."""
    features = _features(df, features)
    found = _bounded(df, features, list(keys), status, lower, upper)
    clipped = F.zip_with(VALUES, "q_", lambda x, q: F.struct(clip(x, q[0], q[1]).alias("v"), q[0].alias("lo"), q[1].alias("hi")))
    rows = long(found, clipped, list(keys)).select(*keys, PLACE, "x.*")
    agg = rows.groupBy(*keys, PLACE).agg(
        F.max("lo").alias("lower_bound"), F.max("hi").alias("upper_bound"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("s"), F.min("v").alias("min_after_clip"), F.max("v").alias("max_after_clip"),
    )
    low, spread = F.col("min_after_clip"), F.coalesce(F.col("min_after_clip") < F.col("max_after_clip"), F.lit(False))
    one = F.when(spread, 1.0).otherwise(0.0)
    return agg.select(
        *keys, F.get(F.array(*map(F.lit, features)), F.col(PLACE)).alias("feature"), F.lit(lower).alias("lower_q"), F.lit(upper).alias("upper_q"), "lower_bound", "upper_bound", "mean",
        F.when(low.isNotNull() & ~spread, 0.0).otherwise(F.col("s")).alias("std"), "min_after_clip", "max_after_clip", F.lit(0.0).alias("z_mean"), one.alias("z_std"),
        F.lit(0.0).alias("scaled_min"), one.alias("scaled_max"),
    )
