"""Drivers over all tumour types: discovery, skip of what is done, and outputs. The samples of a tumour type are one plan; only
where that fails are they run in halves, so that a sample that cannot be read does not keep the others from being written."""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pixels import in_bytes
from ..operators import genes, segmentation
from ..operators.selection import chosen, of_samples
from ..operators.texture import patch_features
from ..schema import Config
from ..sources import hdf5, paths, readers, sinks
from . import pipeline

#: What reading, planning and running can raise.
FAILURES = (PySparkException, Py4JJavaError, ValueError, KeyError, OSError, AssertionError)
WRITTEN, SKIPPED = "written", "skipped"


def _wanted(spark: SparkSession, config: Config) -> DataFrame | None:
    return None if config.sample_ids is None else spark.createDataFrame([(s,) for s in config.sample_ids], "sample_id string")


def _each(wanted: list[str], done: list[str], run: Callable[[list[str]], None]) -> dict[str, str]:
    """Runs the samples that are not done, all at once; where that fails, each half of them. Tells of each sample what came of it.

    A bad one of n samples takes two runs for each time that n can be halved, and only it is not written.
    """
    skip = set(done)
    out = {s: SKIPPED if s in skip else WRITTEN for s in wanted}
    groups = [[s for s in wanted if s not in skip]]
    while groups:
        todo = groups.pop()
        if not todo:
            continue
        try:
            run(todo)
        except FAILURES as e:
            if len(todo) == 1:
                out[todo[0]] = f"failed: {e}"
            else:
                groups += [todo[len(todo) // 2 :], todo[: len(todo) // 2]]
    return out


def _patches(spark: SparkSession, config: Config, tree: str, some: list[str], reader: str = "extract") -> DataFrame:
    """Patches of some samples, from the partitions of a table and from HDF5 files; only theirs are listed and read."""
    at = paths.stage(config.root, tree, "patches")
    files = set(sinks.files_at(spark, at, readers.HDF5_ENDINGS))
    stored, parts = [s for s in some if s not in files], []
    if stored:
        one = spark.read.option("basePath", at).parquet(f"{at}/sample_id={stored[0]}").schema
        fields = [T.StructField(f.name, T.StringType()) if f.name == "sample_id" else f for f in one.fields]
        found = spark.read.option("basePath", at).schema(T.StructType(fields)).parquet(*(f"{at}/sample_id={s}" for s in stored))
        parts.append(readers.patches(found, reader))
    if files & set(some):
        parts.append(hdf5.patches(spark, at, reader, [s for s in some if s in files]))
    if len(parts) == 1:
        return parts[0]
    columns = ("sample_id", "patch_idx", "barcode", "x", "y", "h", "w", "layout", "px")
    as_bytes = lambda df: df if isinstance(df.schema["px"].dataType, T.BinaryType) else df.withColumn("px", in_bytes(F.col("px")))
    first, second = (as_bytes(df).select(*columns) for df in parts)
    return first.unionByName(second)


def extract_all(spark: SparkSession, config: Config, measurements: list[str] = (), order: list[str] = ()) -> dict[str, dict[str, str]]:
    """Features of the wanted samples of every tumour type; samples that are done are left alone unless the settings overwrite.

    Tells for each tumour type and sample whether it was written, skipped, or why it failed. A tumour type without patches has
    no samples; neither it nor a sample that fails keeps others from running.
    """
    out = {}
    for tree in config.oncotrees:
        at = f"{config.root.rstrip('/')}/{tree}/{config.output_dirname}"
        wanted = readers.sample_ids(spark, paths.stage(config.root, tree, "patches"), config.sample_ids)
        done = [] if config.overwrite else sinks.processed_samples(spark, at)

        def run(some: list[str], tree=tree, at=at) -> None:
            cells = None
            if config.mask_source == "cellseg":
                cells = readers.cells_normalised(spark, paths.stage(config.root, tree, "segment")).where(F.col("sample_id").isin(some))
                if missing := set(some) - set(sinks.samples_at(spark, paths.stage(config.root, tree, "segment"))):
                    raise FileNotFoundError(f"no segmented cells of {sorted(missing)}")
            pipeline.extract_to(_patches(spark, config, tree, some), cells, config, at, measurements, order)

        out[tree] = _each(wanted, done, run)
    return out


def segment_all(spark: SparkSession, config: Config, found: dict[str, DataFrame]) -> dict[str, dict[str, str]]:
    """Cells of every tumour type with the summary of their patch, from segmenter outputs (sample_id, patch_idx, barcode, geometry
    and what else there is); samples that are done are left alone unless the settings overwrite."""
    out = {}
    for tree, cells in found.items():
        at = paths.stage(config.root, tree, "segment")
        wanted = readers.sample_ids(spark, paths.stage(config.root, tree, "patches"), config.sample_ids)
        done = [] if config.overwrite else sinks.samples_at(spark, at)

        def run(some: list[str], tree=tree, at=at, cells=cells) -> None:
            patches = _patches(spark, config, tree, some, "segment")
            rows = segmentation.cell_rows(cells.where(F.col("sample_id").isin(some)))
            sinks.cells(rows, segmentation.patch_summary(patches, rows), at)
            sinks.samples(segmentation.sample_summary(patches, rows), f"{at}_summary")

        out[tree] = _each(wanted, done, run)
    return out


def statistics_all(spark: SparkSession, config: Config, order: list[str] = ("patch_idx",), carry: list[str] = ("patch_idx", "barcode", "x", "y")) -> dict[str, bool]:
    """Descriptive statistics, box statistics and representatives of processed features, per sample; tells which types have any."""
    out = {}
    for tree in config.oncotrees:
        source = f"{config.root.rstrip('/')}/{tree}/{config.output_dirname}/table"
        try:
            features = of_samples(readers.features(spark, source), _wanted(spark, config))
            made = pipeline.statistics(features, config, list(order), [c for c in carry if c in features.columns])
            at = paths.stage(config.root, tree, "radiomics_statistics")
            sinks.csv_and_parquet(made["describe"], f"{at}/describe")
            if "box" in made:
                sinks.csv_and_parquet(made["box"], f"{at}/box")
            if "representatives" in made:
                sinks.manifest(made["representatives"], f"{at}/representatives")
            out[tree] = True
        except FAILURES as e:
            print(f"{tree}: {e}")
            out[tree] = False
    return out


def gene_sets_all(spark: SparkSession, config: Config) -> list[dict]:
    """Gene lists per tumour type, criterion and size as JSON, and one summary of all; tumour types without samples are left out."""
    summary = []
    for tree in config.oncotrees:
        at = paths.stage(config.root, tree, "genes")
        try:
            of = readers.expression_totals(spark, paths.stage(config.root, tree, "st"), _wanted(spark, config))
            genes.moments(of, genes.common_genes(of, config.gene_share)).write.mode("overwrite").parquet(f"{at}/moments")
            sets = genes.gene_sets(spark.read.parquet(f"{at}/moments"), config.genes_criteria, config.genes_k)
        except FAILURES as e:
            print(f"{tree}: {e}")
            continue
        for (criterion, k), chosen in sets.items():
            path = f"{at}/{criterion}_{k}genes.json"
            listed = [r.gene for r in chosen.collect()]  # k names at most
            sinks.json_rows(spark.createDataFrame([(listed,)], "genes array<string>"), path)
            summary.append({"oncotree_code": tree, "criteria": criterion, "k": k, "num_genes": len(listed), "save_path": path})
    if summary:
        sinks.json_rows(spark.createDataFrame(summary), f"{config.root.rstrip('/')}/gene_extraction_summary.json")
    return summary


def visualise_all(spark: SparkSession, config: Config, listed: list[int] | None = None) -> dict[str, dict[str, str]]:
    """What figures of chosen patches show: masks with their pixel counts, and, of chosen ones among those with cells, their cells."""
    out = {}
    for tree in config.oncotrees:
        at = paths.stage(config.root, tree, "patches_vis")
        wanted = readers.sample_ids(spark, paths.stage(config.root, tree, "patches"), config.sample_ids)
        segmented = sinks.samples_at(spark, paths.stage(config.root, tree, "segment"))
        done = [] if config.overwrite else sinks.samples_at(spark, at)

        def run(some: list[str], tree=tree, at=at, segmented=segmented) -> None:
            patches = _patches(spark, config, tree, some)
            keys = [*pipeline.KEYS, "barcode"]
            seen = patches.join(chosen(patches, config.vis_ratio, listed), pipeline.KEYS, "left_semi")
            sinks.samples(patch_features(seen, keys, label=config.label).select(*keys, "mask_area", "status"), at)
            if set(some) <= set(segmented):
                cells = readers.cells_normalised(spark, paths.stage(config.root, tree, "segment")).where(F.col("sample_id").isin(some))
                seen = patches.join(chosen(cells, config.vis_ratio, listed), pipeline.KEYS, "left_semi")
                sinks.samples(segmentation.overlay_rows(seen, cells).select(*keys, "px", "h", "w", "layout", "cells"), paths.stage(config.root, tree, "segment_vis"))

        out[tree] = _each(wanted, done, run)
    return out


def run_all(spark: SparkSession, config: Config, found: dict[str, DataFrame] | None = None, visualise: bool = False) -> dict:
    """All stages in order: gene sets, segmented cells, figures if asked for, features, statistics.

    Downloads and the segmenter are not part of the engine: patches and expression are in place, found are the cells.
    """
    out: dict = {"genes": gene_sets_all(spark, config), "segment": segment_all(spark, config, found or {})}
    if visualise:
        out["visualise"] = visualise_all(spark, config)
    return out | {"extract": extract_all(spark, config), "statistics": statistics_all(spark, config)}


def main(arguments: list[str]) -> None:
    """Runs all stages with the settings of YAML files, of which later ones stand above earlier ones; sections are only for the eye."""
    spark = SparkSession.builder.appName("spatialfeat").getOrCreate()
    found = paths.layered(*(paths.config_file(a) for a in arguments))
    print(run_all(spark, paths.settings(paths.without_sections(found))))


if __name__ == "__main__":
    import sys

    main(sys.argv[1:])
