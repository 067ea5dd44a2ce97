"""Mixing sources to target weights by systematic sampling.

Within a source, every document is due target / source_size copies. Their prefix sum along a fixed order of the source
plus one random offset per source is cut at the integers: a document comes out once per integer it crosses. The order is by
the root of the size, then by an MD5 of id and text, so that copies spread evenly over short and long texts and the words
taken come close to the target. It does not depend on how many rows there are or how they are dealt.

The prefix sum never needs a source in one task: documents fall into blocks (root of their size, first three digits of the
MD5, so 4,096 slices of each size), their counts are summed up over the 256 slices of each of 16 parts of a size, over these
parts, and over the sizes of a source, and only rows of one block are ranked together. Rows that agree are counted first and take a run of ranks, so that copies of one row are one. Texts are read
once: sizes and MD5s are written before sums need them. Rows of `mixed` are grouped whole, with partial sums while scanning.

Defined cases: null or blank text has size 0, is due copies like any other, and takes nothing; a null source is a source of
its own, last in order; null ids count as '' in the MD5; repeated rows are separate documents, and rows with equal id and
text rank by their other columns, so that a rerun draws the same texts; very long texts are single documents like others; no
rows give no rows. The columns this module adds start with `mix_`; `mixed` gives back the columns of its input, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, repeated, word_count

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: No target is above so many times its source's size, so no document comes out more often.
MOST = 3


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Shares the sum of mix_size among sources (source, mix_size) by weight, no target above `most` times the size.

    Water filling in closed form: sources sorted by cap over weight fill up first; the level is that of the first one
    that stays under its cap. One narrow row per source, so the windows without partitions hold one row per source.
    """
    w = F.element_at(F.array(*map(F.lit, weights)), ((F.col("mix_rn") - 1) % len(weights) + 1).cast("int"))
    s = sources.withColumn("mix_rn", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    s = s.withColumn("mix_w", w).withColumn("mix_cap", F.col("mix_size") * most)
    s = s.withColumn("mix_full", F.col("mix_cap") / F.col("mix_w"))
    every = Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy("mix_full", "mix_rn").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda c: F.coalesce(c, F.lit(0))
    rest = F.sum("mix_size").over(every) - zero(F.sum("mix_cap").over(before))
    s = s.withColumn("mix_level", rest.cast("double") / (F.sum("mix_w").over(every) - zero(F.sum("mix_w").over(before))))
    level = F.min(F.when(F.col("mix_level") <= F.col("mix_full"), F.struct("mix_full", "mix_rn", "mix_level"))).over(every)
    return s.select(
        "source", F.col("mix_size").alias("mix_source_size"),
        F.least(F.col("mix_cap").cast("double"), level["mix_level"] * F.col("mix_w")).alias("mix_target"),
    )


def offset(source: Column, seed: str) -> Column:
    """The random offset of a source in (0, 1), the same in every run."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("")))), 1, 8)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 32))


def place_key(id: Column, text: Column) -> Column:
    """What documents of about one size are ordered by."""
    return F.md5(F.concat(F.coalesce(id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text.cast("string"), F.lit(""))).cast("binary"))


def _ranked(counted: DataFrame, order: list[str], seed: str, weights: tuple[int, ...], most: int) -> DataFrame:
    """Adds mix_source_size, mix_target, mix_due, mix_u and mix_before (rows of the source before these) to counted rows.

    counted has source, mix_size, mix_key, mix_n (how many rows a row stands for), and is read twice.
    """
    root = F.concat_ws(":", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")), F.floor(F.sqrt("mix_size")).cast("string"))
    sliced = counted.withColumn("mix_block", F.concat_ws(":", root, F.substring("mix_key", 1, 3)))
    blocks = sliced.groupBy("source", F.floor(F.sqrt("mix_size")).alias("mix_root"), root.alias("mix_of_root"), F.substring("mix_key", 1, 3).alias("mix_slice"), "mix_block")
    blocks = materialise(blocks.agg(F.sum("mix_n").alias("mix_rows"), F.sum(F.col("mix_size") * F.col("mix_n")).alias("mix_size")).withColumn("mix_part", F.concat_ws(":", "mix_of_root", F.substring("mix_slice", 1, 1))))
    share = targets(blocks.groupBy("source").agg(F.sum("mix_size").alias("mix_size")), weights, most)
    # a window holds the sizes of a source, the 16 parts of a size, or the 256 slices of a part
    earlier = lambda of, order: F.coalesce(F.sum("mix_rows").over(Window.partitionBy(of).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = blocks.groupBy("source", "mix_root", "mix_of_root", "mix_part").agg(F.sum("mix_rows").alias("mix_rows"))
    roots = parts.groupBy("source", "mix_root", "mix_of_root").agg(F.sum("mix_rows").alias("mix_rows"))
    roots = roots.select("source", "mix_of_root", earlier("source", "mix_root").alias("mix_first"))
    roots = roots.alias("a").join(share.alias("b"), F.col("a.source").eqNullSafe(F.col("b.source"))).select("mix_of_root", "mix_first", "mix_source_size", "mix_target")
    total = lambda own: (F.col("mix_first") + own).alias("mix_first")
    parts = parts.select("mix_part", "mix_of_root", earlier("mix_of_root", "mix_part").alias("mix_own")).join(roots, "mix_of_root").select("mix_part", total(F.col("mix_own")), "mix_source_size", "mix_target")
    first = blocks.select("mix_block", "mix_part", earlier("mix_part", "mix_slice").alias("mix_own")).join(parts, "mix_part").select("mix_block", total(F.col("mix_own")), "mix_source_size", "mix_target")
    before = Window.partitionBy("mix_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    due = F.coalesce(F.try_divide(F.col("mix_target"), F.col("mix_source_size")), F.lit(0.0))
    met = sliced.join(first, "mix_block")
    return met.withColumns({"mix_before": F.col("mix_first") + F.coalesce(F.sum("mix_n").over(before), F.lit(0)), "mix_due": due, "mix_u": offset(F.col("source"), seed)})


def _crossed(up_to: Column) -> Column:
    """Integers up to the prefix sum over so many rows."""
    return F.floor(F.col("mix_u") + F.col("mix_due") * up_to.cast("double"))


def mix(docs: DataFrame, text: str = "text", seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """doc_id, source, mix_size, mix_source_size, mix_target and mix_copies of every document of docs (doc_id, source, text)."""
    rows = docs.select("doc_id", "source", word_count(F.col(text)).alias("mix_size"), place_key(F.col("doc_id"), F.col(text)).alias("mix_key"))
    counted = materialise(rows.groupBy("doc_id", "source", "mix_size", "mix_key").agg(F.count("*").alias("mix_n")))
    ranked = _ranked(counted, ["mix_key"], seed, weights, most)
    each = repeated(ranked, "mix_n", "mix_row").withColumn("mix_at", F.col("mix_before") + F.col("mix_row"))
    copies = (_crossed(F.col("mix_at")) - _crossed(F.col("mix_at") - 1)).alias("mix_copies")
    return each.select("doc_id", "source", "mix_size", "mix_source_size", "mix_target", copies)


def mixed(docs: DataFrame, text: str = "text", seed: str = "mix", weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents of the mix, each as often as it was drawn, with the columns of docs."""
    same = docs.groupBy(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("mix_row")).agg(F.count("*").alias("mix_n"))
    own = lambda c: F.col("mix_row").getField(c)
    rows = same.select("*", own("source").alias("source"), word_count(own(text)).alias("mix_size"), place_key(own("doc_id"), own(text)).alias("mix_key"))
    counted = materialise(rows)
    tie = F.to_json(F.struct(*(own(c).alias(f"c{k}") for k, c in enumerate(docs.columns) if c != text)))
    ranked = _ranked(counted.withColumn("mix_tie", tie), ["mix_key", "mix_tie"], seed, weights, most)
    copies = _crossed(F.col("mix_before") + F.col("mix_n")) - _crossed(F.col("mix_before"))
    drawn = ranked.select("mix_row", copies.alias("mix_copies"))
    return repeated(drawn, "mix_copies", "mix_copy").select("mix_row.*")
