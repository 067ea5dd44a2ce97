"""Intake of patches as they are delivered: gray levels per patch, thresholds and percentiles per sample.

Laboratories deliver patches for weeks, and thresholds of masks have to fit the stain of each sample. This job takes the files of a
folder that it has not taken yet (a file stream with a checkpoint, everything that is there now, then it ends), counts the gray
levels of every new patch once, and brings the statistics of the samples that got new patches up to date.

OUTPUT/patches, partitioned by intake (the stream's batch): sample_id, patch_idx, levels, counts, n_pixels, mask_area, mask_mean, status.
OUTPUT/samples, partitioned by sample_id: patches by status, and level statistics over the patches that are ok.
OUTPUT/checkpoint: what the stream has taken.

Reruns: a batch that is repeated after a failure writes over its own partition of patches, and then over the partitions of its samples,
so it comes to the same. A patch that is delivered again counts as its last delivery says (within one delivery, the greatest row).
Statistics of a sample are made from the counts of its patches, never from pixels again.

Defined cases: a patch without pixels is an error and counts as nothing else; patches without a sample are a sample of their own (null); a
patch_idx that is null is one patch of its sample; an empty folder of files leaves no output; further columns are not read.
"""

from __future__ import annotations

import logging
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobs.common import main, mapped, new_folder, settings
from spatialfeat.operators import intensity
from spatialfeat.operators.spread import spread
from spatialfeat.sources import sinks

NAME = "patch_intake"
log = logging.getLogger(NAME)
KEYS = ["sample_id", "patch_idx"]
MEASURED = ["n_pixels", "mask_area", "mask_mean", "status", "levels", "counts"]


def _patches(spark: SparkSession, out: str) -> DataFrame:
    """All deliveries; samples are text even where their names look like numbers."""
    return spark.read.parquet(f"{out}/patches").withColumn("sample_id", F.col("sample_id").cast("string"))


def current(spark: SparkSession, out: str, samples: DataFrame | None = None) -> DataFrame:
    """Every patch as it was delivered last, of some samples or of all."""
    rows = _patches(spark, out)
    if samples is not None:
        rows = rows.alias("a").join(samples.alias("b"), F.col("a.sample_id").eqNullSafe(F.col("b.sample_id")), "left_semi")
    last = F.max(F.struct("intake", *MEASURED)).alias("last")
    return rows.groupBy(*KEYS).agg(last).select(*KEYS, *(f"last.{c}" for c in MEASURED))


def sample_table(patches: DataFrame) -> DataFrame:
    """sample_id, patches by status, and level statistics of the patches that are ok; null where there are none."""
    by = [F.count_if(F.col("status") == s).alias(f"n_{n}") for n, s in (("ok", "ok"), ("small", "skipped_small_mask"), ("error", "error"))]
    counts = patches.groupBy("sample_id").agg(F.count("*").alias("n_patches"), *by)
    levels = intensity.level_statistics(intensity.sample_levels(patches.where("status = 'ok'"), ["sample_id"]), ["sample_id"])
    same = F.col("c.sample_id").eqNullSafe(F.col("l.sample_id"))
    return counts.alias("c").join(levels.alias("l"), same, "left").select("c.*", *(f"l.{c}" for c in levels.columns[1:]))


def run(spark: SparkSession, landing: str, out: str, config: dict | None = None) -> dict[str, int]:
    """Takes what is new below landing; tells how many batches and patches that were, and how many samples changed."""
    config = config or settings(NAME)
    out = out.rstrip("/")
    done = {"batches": 0, "patches": 0, "samples": 0}
    schema = spark.read.parquet(landing).schema
    landing = landing.rstrip("/")
    if not any(c in landing for c in "*?[{"):
        landing = f"{landing[:-1]}[{landing[-1]}]"  # as a pattern, a path may be one file as well as a folder
    arrived = spark.readStream.schema(schema).option("maxFilesPerTrigger", config["files_per_batch"]).option("maxFileAge", "36500d").parquet(landing)
    log.info("reads %s (%s)", landing, ", ".join(config["columns"].values()))

    def take(batch: DataFrame, number: int) -> None:
        rows = mapped(batch, config["columns"]).select(F.col("sample_id").cast("string"), "patch_idx", "pixels")
        counted = intensity.level_counts(spread(rows), KEYS)
        made = intensity.patch_summary(counted, config["mask_low"], config["mask_high"], config["smallest_mask"])
        made = made.select(F.lit(number).cast("long").alias("intake"), *KEYS, *MEASURED)
        ordered = made.sortWithinPartitions("sample_id", "patch_idx")
        ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("intake").parquet(f"{out}/patches")
        new = _patches(spark, out).where(F.col("intake") == number)
        touched = new.groupBy("sample_id").agg(F.count("*").alias("n")).cache()
        try:
            n = touched.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("patches"), F.count("*").alias("samples")).first()
            if n.patches:
                sinks.samples(sample_table(current(spark, out, touched.select("sample_id"))), f"{out}/samples")
        finally:
            touched.unpersist()
        done["batches"] += 1
        done["patches"] += n.patches
        done["samples"] += n.samples
        log.info("batch %d: wrote %d patches to %s/patches and %d samples to %s/samples", number, n.patches, out, n.samples, out)

    query = arrived.writeStream.foreachBatch(take).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()
    log.info("took %(patches)d new patches in %(batches)d batches; %(samples)d samples changed", done)
    return done


def output(spark: SparkSession, out: str) -> DataFrame:
    """Every patch as it stands, with what is known of its sample."""
    kinds = {"n_patches": "long", "n_ok": "long", "n_small": "long", "n_error": "long", "n_pixels": "long", "mean": "double", "p01": "int", "p50": "int", "p99": "int", "entropy": "double", "threshold": "int"}
    schema = T.StructType.fromDDL(", ".join(f"{c} {k}" for c, k in kinds.items()) + ", sample_id string")
    samples = spark.read.schema(schema).parquet(f"{out}/samples")
    same = F.col("p.sample_id").eqNullSafe(F.col("s.sample_id"))
    own = ["sample_id", "patch_idx", "n_pixels", "mask_area", "mask_mean", "status"]
    return current(spark, out).alias("p").join(samples.alias("s"), same, "left").select(*(f"p.{c}" for c in own), *(F.col(f"s.{c}").alias(f"sample_{c.removeprefix('n_')}") for c in kinds))


def job1_patch_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as patches of one byte a pixel, taken in, and once more when nothing is new."""
    out = new_folder(spark, NAME)
    for _ in range(2):
        run(spark, f"{sf_dir}/documents.parquet", out)
    found = output(spark, out)
    return found.select(*(F.round(F.col(c) + 1e-9, 6).alias(c) if k == "double" else F.col(c) for c, k in found.dtypes))


SQL = """
WITH d AS (SELECT row_number() OVER () AS rid, nullif(source, '') AS sample_id, doc_id AS patch_idx, hex(encode(text)) AS x FROM documents),
b AS (SELECT rid, unnest(regexp_extract_all(x, '..')) AS pair FROM d),
c AS (SELECT rid, ('0x' || pair)::INT AS level, count(*) AS n FROM b GROUP BY ALL),
m AS (SELECT rid, sum(n)::BIGINT AS n_pixels, coalesce(sum(n) FILTER (level > 30 AND level < 220), 0)::BIGINT AS mask_area, sum(level * n) FILTER (level > 30 AND level < 220) AS total FROM c GROUP BY rid),
p AS (SELECT rid, sample_id, patch_idx, CASE WHEN x IS NOT NULL THEN coalesce(n_pixels, 0) END AS n_pixels, CASE WHEN x IS NOT NULL THEN coalesce(mask_area, 0) END AS mask_area, total::DOUBLE / nullif(mask_area, 0)::DOUBLE AS mask_mean,
    CASE WHEN x IS NULL THEN 'error' WHEN coalesce(mask_area, 0) < 50 THEN 'skipped_small_mask' ELSE 'ok' END AS status FROM d LEFT JOIN m USING (rid)),
s AS (SELECT sample_id, count(*) AS n_patches, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status = 'skipped_small_mask') AS n_small, count(*) FILTER (status = 'error') AS n_error FROM p GROUP BY sample_id),
l AS (SELECT sample_id, level, sum(n)::BIGINT AS n FROM p JOIN c USING (rid) WHERE status = 'ok' GROUP BY ALL),
u AS (SELECT *, sum(n) OVER w AS all_, sum(level * n) OVER w AS sum_, sum(n) OVER v AS n_, sum(level * n) OVER v AS s_ FROM l WINDOW w AS (PARTITION BY sample_id), v AS (PARTITION BY sample_id ORDER BY level)),
a AS (SELECT *, (all_::DOUBLE * s_::DOUBLE - sum_::DOUBLE * n_::DOUBLE) AS apart FROM u),
t AS (SELECT sample_id, level AS threshold FROM a WHERE n_ < all_ QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY apart * apart / (n_::DOUBLE * (all_::DOUBLE - n_::DOUBLE)) DESC, level) = 1),
g AS (SELECT sample_id, sum(n)::BIGINT AS pixels, sum(level * n)::DOUBLE / sum(n)::DOUBLE AS mean, min(level) FILTER (n_ >= 0.01::DOUBLE * all_) AS p01, min(level) FILTER (n_ >= 0.5::DOUBLE * all_) AS p50, min(level) FILTER (n_ >= 0.99::DOUBLE * all_) AS p99,
    greatest(-sum(n::DOUBLE / all_::DOUBLE * log2(n::DOUBLE / all_::DOUBLE)), 0.0) AS entropy FROM a GROUP BY sample_id)
SELECT p.sample_id, patch_idx, n_pixels, mask_area, round(mask_mean + 1e-9, 6) AS mask_mean, status, n_patches AS sample_patches, n_ok AS sample_ok, n_small AS sample_small, n_error AS sample_error,
    g.pixels AS sample_pixels, round(mean + 1e-9, 6) AS sample_mean, p01 AS sample_p01, p50 AS sample_p50, p99 AS sample_p99, round(entropy + 1e-9, 6) AS sample_entropy, threshold AS sample_threshold
FROM p JOIN s ON p.sample_id IS NOT DISTINCT FROM s.sample_id LEFT JOIN g ON p.sample_id IS NOT DISTINCT FROM g.sample_id LEFT JOIN t ON p.sample_id IS NOT DISTINCT FROM t.sample_id"""

if __name__ == "__main__":
    main(NAME, run, sys.argv[1:])
