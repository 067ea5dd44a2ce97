"""Descriptive statistics, box statistics and representative rows of feature tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import feature_class
from ..schema import STATUS_OK, described_columns
from .quantiles import PLACE, VALUES, gathered, long, met, with_quantiles, with_values

_AT = (0.01, 0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95, 0.99)
_NAMES = ("q01", "q05", "q10", "q25", "median", "q75", "q90", "q95", "q99")
TARGETS = {"min": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "max": 1.0}


def ok_rows(df: DataFrame, status_filter: str | None = STATUS_OK) -> DataFrame:
    """Rows with the status, if the table has one; None keeps all."""
    return df if status_filter is None or "status" not in df.columns else df.where(F.col("status") == status_filter)


def _named(features: list[str]):
    return F.get(F.array(*map(F.lit, features)), F.col(PLACE))


def describe(df: DataFrame, features: list[str] | None = None, keys=(), at=()) -> DataFrame:
    """22 statistics per key and feature, as one aggregate of long values.

    With `at`, also PLACE, the place of the feature, and at_, the array of the exact quantiles at these shares.
    """
    features = described_columns(df) if features is None else features
    keys = list(keys)
    x = F.col("x")
    agg = long(with_values(df, features), VALUES, keys).groupBy(*keys, PLACE).agg(
        F.count(x).alias("count"), F.count("*").alias("all_"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        F.percentile(x, F.array(*map(F.lit, (*_AT, *at)))).alias("q_"), F.count_if(x == 0).alias("zero_count"), F.count_if(x > 0).alias("positive_count"), F.count_if(x < 0).alias("negative_count"),
    )
    name, missing = _named(features), F.col("all_") - F.col("count")
    q = {n: F.get("q_", F.lit(i)) for i, n in enumerate(_NAMES)}
    return agg.select(
        *keys, name.alias("feature_name"), feature_class(name).alias("feature_class"), "count", missing.alias("nan_count"), F.try_divide(missing.cast("double"), F.col("all_")).alias("nan_ratio"),
        "mean", "std", "min", *(v.alias(n) for n, v in q.items()), "max", (q["q75"] - q["q25"]).alias("iqr"), "zero_count", "positive_count", "negative_count",
        *((PLACE, F.slice("q_", len(_AT) + 1, len(at)).alias("at_")) if at else ()),
    )


def box_stats(df: DataFrame, features: list[str], keys=("sample_id",), reach: float = 1.5) -> DataFrame:
    """Quartiles, and whiskers at the last values within `reach` times the box, at the box where none is."""
    found = with_quantiles(with_values(df, features), list(keys), [0.25, 0.5, 0.75])
    rows = long(found, F.arrays_zip(VALUES, "q_"), list(keys), "r")
    x, q = F.col(f"r.{VALUES}"), [F.get("r.q_", F.lit(i)) for i in range(3)]
    iqr = q[2] - q[0]
    agg = rows.groupBy(*keys, PLACE).agg(
        *(F.max(v).alias(n) for n, v in zip(("q1", "med", "q3"), q, strict=True)), F.min(F.when(x >= q[0] - reach * iqr, x)).alias("low"), F.max(F.when(x <= q[2] + reach * iqr, x)).alias("high")
    )
    return agg.select(*keys, _named(features).alias("feature_name"), "q1", "med", "q3", F.least("low", "q1").alias("whislo"), F.greatest("high", "q3").alias("whishi"))


def representatives(df: DataFrame, features: list[str], order: list[str], carry: list[str], keys=("sample_id",), stats=tuple(TARGETS)) -> DataFrame:
    """Per key, feature and statistic the row nearest to the statistic; ties by `order`, the file order.

    Differences are compared as they are. The smallest difference is found first, and only rows that have it are
    then made long and compared by order, so rows are not multiplied or sorted. Statistics with other names are ignored;
    features without values have no row.
    """
    stats = [s for s in stats if s in TARGETS]
    keys = list(keys)
    places = range(len(stats))
    near = lambda i: F.abs(F.col(f"r.{VALUES}") - F.get("r.q_", F.lit(i)))
    found = with_quantiles(with_values(df, features), keys, [TARGETS[s] for s in stats])
    least = long(found, F.arrays_zip(VALUES, "q_"), keys, "r").groupBy(*keys, PLACE).agg(*(F.min(near(i)).alias(f"m{i}") for i in places))
    found = met(found, gathered(least, keys, F.array(*(f"m{i}" for i in places)), "best_"), keys)
    # order and carry get names of their own, as a column may be in both
    own = [f"o{i}_" for i in range(len(order))], [f"c{i}_" for i in range(len(carry))]
    found = found.select(*keys, *(F.col(f"`{c}`").alias(n) for c, n in zip([*order, *carry], [*own[0], *own[1]], strict=True)), VALUES, "q_", "best_")
    rows = long(found, F.arrays_zip(VALUES, "q_", "best_"), [*keys, *own[0], *own[1]], "r")
    hit = [near(i) == F.get("r.best_", F.lit(i)) for i in places]
    rows = rows.where(reduce(or_, hit)).withColumn("x", F.col(f"r.{VALUES}"))
    matched = F.filter(F.array(*(F.when(h, F.struct(F.lit(i).alias("stat"), F.get("r.q_", F.lit(i)).alias("t"))) for i, h in zip(places, hit, strict=True))), lambda m: m.isNotNull())
    each = rows.select(*keys, PLACE, *own[0], *own[1], "x", F.explode(matched).alias("s")).select("*", F.col("s.stat").alias("stat_"))
    best = F.min(F.struct(*own[0], "x", F.col("s.t").alias("t"), *own[1])).alias("b")
    name = _named(features)
    return each.groupBy(*keys, PLACE, "stat_").agg(best).select(
        *keys, name.alias("feature_name"), feature_class(name).alias("feature_class"), F.get(F.array(*map(F.lit, stats)), F.col("stat_")).alias("stat_name"), F.col("b.t").alias("target_value"),
        F.col("b.x").alias("selected_value"), F.abs(F.col("b.x") - F.col("b.t")).alias("abs_diff"), *(F.col(f"b.c{i}_").alias(c) for i, c in enumerate(carry)),
    )
