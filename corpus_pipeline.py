"""A training corpus from raw documents: quality rules, exact dedup, near dedup, source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and reread as the next one's
docs. All but the last return the columns of documents, in their order and with whatever further columns there are; names of
further columns clash with nothing, as the operators see them inside one struct. A stage on no rows returns no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spatialfeat.llm import exact_dedup, mixing, ngram_join, packing, quality_rules
from spatialfeat.llm.common import materialise, small_batches, sweep, table, written
from spatialfeat.shipping import ship


def _ready(spark: SparkSession) -> None:
    ship(spark)
    small_batches(spark)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the base rules or the certified score reject.

    Null and empty texts have no words and go; very long texts are measured whole; a null id has no label, a null lang is a
    stratum of its own; rows that repeat an id are judged each by its own text, equal rows alike; a score at the cutoff stays.
    """
    _ready(spark)
    measured = materialise(quality_rules.measure(docs, ["doc_id", "lang"]))
    rules = quality_rules.fit(measured, table(spark, sf_dir, "labels"), "lang")
    rest = F.struct("lang", *(c for c in docs.columns if c not in ("lang", "text")))
    # a second look at each text is cheaper than a shuffle of all texts
    again = quality_rules.measure(docs.select("text", "lang", rest.alias("qr_rest")), ["lang", "qr_rest"], keep_text=True)
    own = F.col("qr_text").cast("string").alias("text")
    kept = rules.judge(again, "lang").where("kept")
    return kept.select(*(own if c == "text" else F.col("qr_rest").getField(c).alias(c) for c in docs.columns))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays.

    Null counts as the empty text, and of all of these one row stays, with its own text; a null id is smaller than any other;
    of rows with equal id and text the one with the largest hash of its other columns stays, in any order of rows;
    very long texts are compared whole.
    """
    _ready(spark)
    return exact_dedup.dedup(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are connected by links of 5-gram similarity 0.8 and more, the one with the smallest doc_id stays.

    Documents without an id go before others; where all of a group have none, or several rows share the smallest id, the
    smallest hash of the text decides, so one text of every group stays. Rows that are equal in id and text stand for one
    document (the stage before leaves none). Null and empty texts link with nothing and stay; very long texts are whole sets.
    """
    _ready(spark)
    linked = materialise(ngram_join.link_components(docs).where("component IS NOT NULL"))
    place = F.struct(F.col("doc_id").isNull().alias("last"), F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    groups = linked.groupBy("component").agg(F.min(place).alias("best"), F.max(place).alias("other"))
    groups = materialise(groups.where("best <> other").select("component", "best"))  # a table: the hot side of the join can be split
    leave = linked.join(groups, "component").where(place != F.col("best")).select("doc_id", "text_key").distinct()
    same = F.col("d.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.xxhash64("d.text") == F.col("l.text_key"))
    return docs.alias("d").join(leave.alias("l"), same, "left_anti").select(*(F.col(f"d.`{c}`") for c in docs.columns))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as systematic sampling to the target weights of its source draws it.

    A null source is one of its own; null and empty texts have no size and are drawn like others; rows that repeat an id are
    documents of their own, equal rows are drawn as one run; ties are broken by whole rows, so reruns draw the same.
    """
    _ready(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and the bins they are packed into.

    Null and empty texts are pieces of size 0; texts longer than a bin are cut; null ids stay null beside exact large ids; equal
    texts, which mixing draws, are a cluster and never share a bin; null sources conflict with nothing.
    """
    _ready(spark)
    return packing.pack(docs)


STAGES = [("quality rules", quality), ("exact dedup", exact), ("n-gram Jaccard join", near), ("mixing", mix), ("best-fit packing", pack)]

#: SQL expresses neither the fitted score nor best-fit packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the corpus. Tables of a stage are removed once the next one is written; those that the result reads stay."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        known = set(written(spark))
        docs = materialise(stage(spark, docs, sf_dir))
        *used, made = [path for path in written(spark) if path not in known]
        sweep(spark, [*used, *([before] if before else [])])
        before = made
    return STAGES[-1][1](spark, docs, sf_dir)
