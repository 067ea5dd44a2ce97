"""Expression matrices in rows: an observation is a row with the places and values of its counts, beside a table of what genes the places are.

matrix: sample_id, obs_row (its place in the sample), obs_id, indices (ascending places of genes), data (their values). What is not listed is
zero, and an observation without counts is a row with empty arrays, so observations are counted by rows. var: sample_id, index, gene.

Sums per sample and gene are made in one pass: a task adds up the values of its rows by gene, so what is shuffled grows with genes and
tasks and not with counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .genes import Totals

MATRIX = "sample_id string, obs_row long, obs_id string, indices array<int>, data array<double>"
#: Samples that a task has sums of at once; sums of more are handed on earlier.
SAMPLES = 32


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = ["sample_id", "index", "n_detected", "s1", "s2"], [pa.string(), pa.int32(), pa.int64(), pa.float64(), pa.float64()]
    sums: dict[str | None, list[np.ndarray]] = {}

    def ready() -> Iterator[pa.RecordBatch]:
        for sample, (n, s1, s2, there) in sums.items():
            at = np.flatnonzero(there)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(([sample] * len(at), at, n[at], s1[at], s2[at]), kinds, strict=True)], names)
        sums.clear()

    for batch in batches:
        column, sizes = batch.column(0).to_pylist(), np.asarray(batch.column(1).value_lengths().fill_null(0))
        ends = np.concatenate([[0], np.cumsum(sizes)])
        index, value = np.asarray(batch.column(1).flatten()), np.asarray(batch.column(2).flatten())
        cuts = [0, *(k for k in range(1, len(column)) if column[k] != column[k - 1]), len(column)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # runs of rows of one sample
            i, v = index[ends[a] : ends[b]], value[ends[a] : ends[b]].astype(float)
            own = sums.setdefault(column[a], [np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0, np.int64)])
            top = max(int(i.max(initial=-1)) + 1, len(own[0]))
            for k, weight in enumerate((v > 0, v, v * v, np.ones(len(i)))):
                own[k] = np.pad(own[k], (0, top - len(own[k]))) + np.bincount(i, weight, top).astype(own[k].dtype)
            if len(sums) > SAMPLES:
                yield from ready()
    yield from ready()


def totals(matrix: DataFrame, var: DataFrame) -> Totals:
    """Sums per sample and gene, and the observations of each sample."""
    parts = matrix.select("sample_id", F.col("indices").cast("array<int>").alias("indices"), F.col("data").cast("array<double>").alias("data"))
    parts = parts.mapInArrow(_sums, "sample_id string, index int, n_detected long, s1 double, s2 double")
    summed = parts.groupBy("sample_id", "index").agg(*(F.sum(c).alias(c) for c in ("n_detected", "s1", "s2")))
    named = var.alias("v").join(summed.alias("s"), F.col("v.sample_id").eqNullSafe(F.col("s.sample_id")) & (F.col("v.index") == F.col("s.index")), "left")
    sums = named.select("v.sample_id", "v.gene", F.col("v.index").cast("long").alias("place"), *(F.coalesce(f"s.{c}", F.lit(0)).alias(c) for c in ("n_detected", "s1", "s2")))
    return Totals(sums, matrix.groupBy("sample_id").agg(F.count("*").alias("n_obs")))


def unique_observations(matrix: DataFrame) -> DataFrame:
    """Observations of a sample under one name get -1, -2 and so on from the second on, in their order; numbers whose name is there already are left out.

    A missing name stays missing. Names move with their rows. Only names that stand twice are looked at, and of the others those that are such a name and a number.
    """
    own = Window.partitionBy("sample_id", "obs_id")
    ranked = matrix.withColumns({"copy_": F.row_number().over(own.orderBy("obs_row")) - 1})
    names = matrix.select("sample_id", "obs_id").groupBy("sample_id", "obs_id").agg(F.count("*").alias("n"))
    split = r"(?s)\A(.*)-([1-9][0-9]{0,17})\z"
    numbered = names.select("sample_id", F.regexp_extract("obs_id", split, 1).alias("base"), F.regexp_extract("obs_id", split, 2).try_cast("long").alias("number")).where("number IS NOT NULL")
    twice = names.where("n > 1").select("sample_id", F.col("obs_id").alias("base"), "n")
    same = F.col("a.sample_id").eqNullSafe(F.col("b.sample_id")) & (F.col("a.base") == F.col("b.base"))
    taken = twice.alias("a").join(numbered.alias("b"), same).groupBy("a.sample_id", "a.base").agg(F.array_sort(F.collect_set("b.number")).alias("taken"))
    here = F.col("m.sample_id").eqNullSafe(F.col("t.sample_id")) & (F.col("m.obs_id") == F.col("t.base")) & (F.col("m.copy_") > 0)
    free = F.aggregate(F.coalesce("t.taken", F.array().cast("array<long>")), F.col("m.copy_").cast("long"), lambda n, t: F.when(t <= n, n + 1).otherwise(n))
    name = F.when(F.col("m.copy_") > 0, F.concat("m.obs_id", F.lit("-"), free.cast("string"))).otherwise(F.col("m.obs_id"))
    return ranked.alias("m").join(taken.alias("t"), here, "left").select(*(name.alias(c) if c == "obs_id" else F.col(f"m.`{c}`") for c in matrix.columns))


def long(matrix: DataFrame, var: DataFrame) -> DataFrame:
    """sample_id, obs_row, obs_id, gene and value of every count that is listed."""
    each = matrix.select("sample_id", "obs_row", "obs_id", F.explode(F.arrays_zip("indices", "data")).alias("c"))
    same = F.col("e.sample_id").eqNullSafe(F.col("v.sample_id")) & (F.col("e.c.indices") == F.col("v.index"))
    return each.alias("e").join(var.alias("v"), same).select("e.sample_id", "e.obs_row", "e.obs_id", "v.gene", F.col("e.c.data").alias("value"))


def from_long(observations: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """matrix and var from observations (sample_id, obs_row, obs_id) and counts (sample_id, obs_row, gene, value); genes in order of their names."""
    genes = counts.select("sample_id", "gene").distinct()
    var = genes.select("sample_id", (F.row_number().over(Window.partitionBy("sample_id").orderBy("gene")) - 1).alias("index"), "gene")
    pairs = counts.join(var, ["sample_id", "gene"]).groupBy("sample_id", "obs_row").agg(F.array_sort(F.collect_list(F.struct("index", F.col("value").cast("double").alias("value")))).alias("pairs"))
    of = lambda name, kind: F.coalesce(F.transform("pairs", lambda p: p[name]), F.array()).cast(f"array<{kind}>")
    met = observations.join(pairs, ["sample_id", "obs_row"], "left")
    return met.select("sample_id", "obs_row", "obs_id", of("index", "int").alias("indices"), of("value", "double").alias("data")), var

