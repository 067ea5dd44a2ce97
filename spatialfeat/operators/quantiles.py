"""Aggregates over many columns per key, by place in an array instead of by name.

Tables of features have hundreds of columns. Their values are gathered in one array a row and made long, one row per key and
column, so that plans do not grow with the columns, and a task of exact quantiles holds the values of one key and one column
at a time, however large a key is. What comes back is one array per key, whose size is that of the columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The column of values: for every column, in order, its number or null; and the place of a long row.
VALUES, PLACE = "values_", "place_"


def with_values(df: DataFrame, columns: list[str], where: Column | None = None) -> DataFrame:
    """df with VALUES; what is no number is null, NaN too, and all are where a condition does not hold."""
    every = F.transform(F.array(*(F.col(f"`{c}`").try_cast("double") for c in columns)), lambda x: F.when(~F.isnan(x), x))
    return df.withColumn(VALUES, every if where is None else F.when(where, every).otherwise(F.array_repeat(F.lit(None).cast("double"), len(columns))))


def long(df: DataFrame, values: Column | str, keep: list[str], name: str = "x") -> DataFrame:
    """keep, PLACE and the element of an array at it."""
    return df.select(*keep, F.posexplode(values).alias(PLACE, name))


def gathered(rows: DataFrame, keys: list[str], element: Column, name: str) -> DataFrame:
    """keys and the array, by place, of an element of rows, one a key and place."""
    sorted_ = F.array_sort(F.collect_list(F.struct(F.col(PLACE), element.alias("e"))))
    return rows.groupBy(*keys).agg(F.transform(sorted_, lambda r: r["e"]).alias(name))


def met(df: DataFrame, arrays: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the arrays of their key, in an equi-join: adaptive execution broadcasts the arrays where they turn out small
    enough, and else splits keys with many rows. An outer join, so that it can never be the rows that are broadcast."""
    same = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
    return df.alias("a").join(arrays.alias("b"), same, "left").select("a.*", *(f"b.{c}" for c in arrays.columns if c not in keys))


def with_quantiles(df: DataFrame, keys: list[str], at: list[float], name: str = "q_") -> DataFrame:
    """df, which has VALUES, with the array of the exact quantiles (an array each, null without values) of every column."""
    each = long(df, VALUES, keys).groupBy(*keys, PLACE).agg(F.percentile("x", F.array(*map(F.lit, at))).alias("q"))
    return met(df, gathered(each, keys, F.col("q"), name), keys)
