"""Line dedup by site-relative frequency.

A page's text is cut into lines at newlines and at the ends of block elements. For every host, the number of its pages
that contain a line is divided by the number of its pages; lines above a ratio are boilerplate and are dropped wherever
they stand. Only DataFrame functions.

The lines above a ratio r are few: their shares of pages sum to at most the mean number of distinct lines of a page, so a
host has at most mean / r of them. Lines are counted once, by 128 bits of hashes with partial sums on the scanning side, and
what may be boilerplate is written; the ids of a host's boilerplate are gathered as one array, which pages meet in a join by
host. Hosts with more than a thousandth of all pages, a thousand at most, are salted in that join, the others are not. A page
looks its lines up by a hashed intersection with the array.

Defined cases: a null url or one without :// has host ''; null html is a page without lines; blank lines are dropped and
not counted as lines; a line repeated in a page counts that page once; a line on fewer than `least` pages of a host stays at any
ratio, so a host with fewer pages loses nothing; very long pages are single rows; repeated rows count as pages of their own; the
other columns of pages come along, but for url and html, and give way where they are named host, lines or n_lines; no rows give
no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried, materialise

#: Where lines end: newlines and the ends of HTML block elements.
BREAK = r"\r?\n|</?(?:p|br|li|ul|div|h[1-6]|tr|table|section|article|nav|footer|header|title|style|script|head|body|html)(?: [^>]*)?/?>"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def host_of(url: Column) -> Column:
    """Between the first :// and the next /, ? or #, A-Z lower-cased; '' if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_of(html: Column) -> Column:
    """The trimmed, non-blank lines of a page in order."""
    cut = F.transform(F.split(F.coalesce(html, F.lit("")), BREAK), lambda x: F.btrim(x, F.lit(BLANKS)))
    return F.filter(cut, lambda x: x != "")


def line_id(line: Column) -> Column:
    """128 bits that stand for a line: two 64-bit hashes with different seeds."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(7), line).alias("b"))


def boilerplate(pages: DataFrame, ratio: float, least: int) -> tuple[DataFrame, DataFrame]:
    """(host, boiler: the ids of its lines on more than `ratio` of its pages, `least` at least), and (host, pages).

    pages has host and line_ids, the ids of each page's lines. Every page counts itself under a null id, so one
    aggregation gives both counts.
    """
    each = pages.select("host", F.explode(F.concat(F.array(F.lit(None).cast("struct<a: bigint, b: bigint>")), F.array_distinct("line_ids"))).alias("id"))
    counts = each.groupBy("host", "id").agg(F.count("*").alias("n"))
    counts = materialise(counts.where(F.col("id").isNull() | (F.col("n") >= least)))
    totals = counts.where("id IS NULL").select("host", F.col("n").alias("pages"))
    often = counts.where(F.col("id").isNotNull()).join(totals, "host").where(F.col("n") > ratio * F.col("pages"))
    return often.groupBy("host").agg(F.collect_list("id").alias("boiler")), totals


def drop_site_boilerplate(pages: DataFrame, ratio: float = 0.3, least: int = 3, salts: int = 32, url: str = "url", html: str = "html") -> DataFrame:
    """Adds host, lines (those kept, in order) and n_lines (before) to every page, without its url and html."""
    rest = [F.col(f"`{c}`") for c in carried(pages.columns, (url, html, "host", "lines", "n_lines"))]
    cut = pages.select(*rest, host_of(F.col(url)).alias("host"), lines_of(F.col(html)).alias("ld_lines"))
    found, totals = boilerplate(cut.select("host", F.transform("ld_lines", line_id).alias("line_ids")), ratio, least)
    every = totals.agg(F.sum("pages").alias("n"))
    # under a thousand hosts can have more than a thousandth of all pages each
    hot = totals.where(F.col("pages") * 1000 > every.scalar()).select("host", F.lit(salts).alias("ld_salts"))
    spread = lambda df: df.join(F.broadcast(hot), "host", "left").withColumn("ld_salts", F.coalesce("ld_salts", F.lit(1)))
    boiler = spread(found).select("host", "boiler", F.explode(F.sequence(F.lit(0), F.col("ld_salts") - 1)).alias("ld_salt"))
    salted = spread(cut).withColumn("ld_salt", F.pmod(F.xxhash64("ld_lines", *([F.to_json(F.struct(*rest))] if rest else [])), F.col("ld_salts")).cast("int")).drop("ld_salts")
    met = salted.join(boiler, ["host", "ld_salt"], "left")
    ids = F.transform("ld_lines", line_id)
    here = F.array_intersect(F.transform(ids, lambda x: x["a"]), F.transform("boiler", lambda x: x["a"]))
    met = met.withColumn("ld_here", F.coalesce(F.filter("boiler", lambda x: F.array_contains(here, x["a"])), F.array().cast("array<struct<a: bigint, b: bigint>>")))
    kept = F.filter("ld_lines", lambda x: ~F.array_contains("ld_here", line_id(x)))
    lines = F.when(F.size("ld_here") == 0, F.col("ld_lines")).otherwise(kept)
    return met.select(*rest, "host", F.size("ld_lines").cast("long").alias("n_lines"), lines.alias("lines"))
