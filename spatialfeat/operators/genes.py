"""Gene sets from sums per sample and gene.

The sums come from matrices in rows (operators/expression.py) or from long tables (sample_id, obs_id, gene, value), in which an observation
without counts is a row whose gene is null. Every observation counts, also where it has no row for a gene: that is a zero.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CRITERIA = ("mean", "var")


def check_criteria(criteria: str) -> None:
    if criteria not in CRITERIA:
        raise ValueError(f"criteria must be one of {CRITERIA}, is {criteria!r}")


@dataclass
class Totals:
    """sums: sample_id, gene, place (null if genes have none), n_detected (values above zero), s1 and s2 (sums of values and squares).
    sizes: sample_id, n_obs."""

    sums: DataFrame
    sizes: DataFrame


def totals(expr: DataFrame) -> Totals:
    """Totals of a long table; obs_row tells observations apart where there is one, obs_id where there is none."""
    own = "obs_row" if "obs_row" in expr.columns else "obs_id"
    sums = expr.where("gene IS NOT NULL").groupBy("sample_id", "gene").agg(
        F.lit(None).cast("long").alias("place"), F.count_if(F.col("value") > 0).alias("n_detected"), F.coalesce(F.sum("value"), F.lit(0.0)).alias("s1"), F.coalesce(F.sum(F.col("value") * F.col("value")), F.lit(0.0)).alias("s2"),
    )
    return Totals(sums, expr.select("sample_id", own).distinct().groupBy("sample_id").agg(F.count("*").alias("n_obs")))


def named_genes(rows: DataFrame) -> DataFrame:
    """Without blanks and controls."""
    return rows.where(~F.col("gene").contains("BLANK") & ~F.col("gene").contains("Control"))


def detected(of: Totals, share: float = 0.1) -> DataFrame:
    """(sample_id, gene, n_detected) of genes above zero in at least ceil(share x observations) of a sample."""
    same = F.col("s.sample_id").eqNullSafe(F.col("n.sample_id"))
    met = of.sums.alias("s").join(of.sizes.alias("n"), same)
    return met.where(F.col("n_detected") >= F.ceil(F.lit(share) * F.col("n_obs"))).select("s.sample_id", "gene", "n_detected")


def common_genes(of: Totals, share: float = 0.1) -> DataFrame:
    """(gene, place) detected in every sample, blanks and controls left out. Genes of a single sample keep their places, those of several
    are in order of their names (place is null). The number of samples is a scalar subquery."""
    samples = of.sizes.agg(F.count("*").alias("samples")).scalar()
    kept = named_genes(detected(of, share)).groupBy("gene").agg(F.count("*").alias("n")).where(F.col("n") == samples).select("gene")
    places = of.sums.groupBy("gene").agg(F.min("place").alias("place"))
    return kept.join(places, "gene").select("gene", F.when(samples == 1, F.col("place")).alias("place"))


def moments(of: Totals, genes: DataFrame) -> DataFrame:
    """Per common gene its place, the number of all observations and sums over them; absent values add nothing."""
    n = of.sizes.agg(F.sum("n_obs").alias("n_obs"))
    sums = of.sums.groupBy("gene").agg(F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))
    return genes.join(sums, "gene", "left").na.fill(0.0, ["s1", "s2"]).withColumn("n_obs", n.scalar())


#: Orders genes like the columns of a matrix.
COLUMNS = ("place", "gene")


def top_by_mean(sums: DataFrame, k: int) -> DataFrame:
    """(gene, mean) of the k largest means over all observations, from moments; ties in the order of columns."""
    return sums.select("gene", "place", (F.col("s1") / F.col("n_obs")).alias("mean")).orderBy(F.desc("mean"), *COLUMNS).limit(k).select("gene", "mean")


def dispersions(sums: DataFrame, bins: int = 20) -> DataFrame:
    """(gene, place, norm): dispersion of each gene normalised within genes of similar mean, from moments.

    Log dispersion of counts, centred and scaled in equal-width bins of log mean; a gene alone in its bin is at 1. Windows
    are over one row per gene.
    """
    n, s1, s2 = F.col("n_obs"), F.col("s1"), F.col("s2")
    mean = s1 / n
    var = (s2 - n * mean * mean) / (n - 1)
    m = sums.select("gene", "place", F.when(mean == 0, 1e-12).otherwise(mean).alias("mu"), var.alias("var"))
    d = F.col("var") / F.col("mu")
    m = m.select("gene", "place", F.log(F.when(d > 0, d)).alias("disp"), F.log1p("mu").alias("m"))
    every = Window.partitionBy(F.lit(0))
    low, high = F.min("m").over(every), F.max("m").over(every)
    m = m.withColumns({"low": low, "high": high})
    place = F.when(F.col("high") == F.col("low"), F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil((F.col("m") - F.col("low")) / ((F.col("high") - F.col("low")) / bins))))
    own = Window.partitionBy("bin")
    m = m.withColumn("bin", place.cast("int"))
    mean, std, alone = F.avg("disp").over(own), F.stddev_samp("disp").over(own), F.count("disp").over(own) == 1
    return m.select("gene", "place", F.when(F.col("disp").isNotNull() & alone, 1.0).otherwise((F.col("disp") - mean) / F.nullif(std, F.lit(0.0))).alias("norm"))


def highly_variable(sums: DataFrame, k: int) -> DataFrame:
    """(gene, norm): genes at or above the k-th largest dispersion, in the order of columns, cut to k; from moments.

    Values are compared as they are. The k-th largest is found in the same rows, so that no second sum decides in its last bit.
    """
    d = dispersions(sums).select("gene", "place", F.coalesce("norm", F.lit(0.0)).alias("norm"))
    every = Window.partitionBy(F.lit(0))
    d = d.withColumn("rank_", F.row_number().over(every.orderBy(F.desc("norm"))))
    d = d.withColumn("cut_", F.min(F.when(F.col("rank_") <= k, F.col("norm"))).over(every))
    return d.where(F.col("norm") >= F.col("cut_")).orderBy(*COLUMNS).limit(k).select("gene", "norm")


def gene_sets(sums: DataFrame, criteria=CRITERIA, ks=(50, 100, 250)) -> dict[tuple[str, int], DataFrame]:
    """A gene list per criterion and k, from the moments of the common genes, which are best written before."""
    for c in criteria:
        check_criteria(c)
    if sums.isEmpty():
        raise ValueError("no gene is common to all samples")
    pick = {"mean": top_by_mean, "var": highly_variable}
    return {(c, k): pick[c](sums, k) for c in criteria for k in ks}
