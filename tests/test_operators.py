"""Operators on edge cases that the stand-in tables do not have."""

import math
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spatialfeat import schema
from spatialfeat.functions import names, pixels, wkb
from spatialfeat.operators import cells, describe, expression, genes, geometry, normalize, pictures, segmentation, selection, texture
from spatialfeat.plans import pipeline, relational
from spatialfeat.sources import readers, sinks


def test_normalise_constant_null_and_bad_values(spark):
    rows = [("s", "ok", 5.0, None, "1.5", 1.0), ("s", "ok", 5.0, None, "x", math.nan), ("s", "ok", None, None, "3", 2.0), ("s", "error", 9.0, 1.0, "9", 9.0), (None, "ok", 1.0, 1.0, "1", 1.0)]
    df = spark.createDataFrame(rows, "sample_id string, status string, morph_flat double, morph_null double, morph_text string, morph_x double")
    got = {(r.sample_id, r.status, r.morph_text): r for r in normalize.normalize(df).collect()}
    out = normalize.normalize(df).collect()
    flat = [r.morph_flat for r in out if r.sample_id == "s" and r.status == "ok"]
    assert flat == [0.0, 0.0, 0.0] and [r.morph_null for r in out if r.status == "ok"] == [0.0] * 4
    bad = [r for r in out if r.status == "error"][0]
    assert bad.morph_flat is None and bad.morph_text is None
    assert sorted(str(r.morph_text) for r in out if r.sample_id == "s") == ["0.0", "1.0", "None", "None"] and got
    assert sorted(str(r.morph_x) for r in out if r.sample_id == "s") == ["0.0", "1.0", "None", "None"]
    with pytest.raises(ValueError):
        normalize.normalize(df.select("sample_id", "status"))


def test_describe_ties_and_empty_features(spark):
    df = spark.createDataFrame([("a", i, v, None) for i, v in enumerate([2.0, 1.0, 3.0, 3.0, 1.0])], "sample_id string, ord long, f double, g double")
    out = {(r.feature_name, r.stat_name): r for r in describe.representatives(df, ["f", "g"], ["ord"], ["ord"]).collect()}
    assert out["f", "min"].ord == 1 and out["f", "max"].ord == 2 and out["f", "q50"].ord == 0 and ("g", "min") not in out
    one = {r.feature_name: r for r in describe.describe(df, ["f", "g"]).collect()}
    assert one["g"]["count"] == 0 and one["g"].nan_count == 5 and one["g"].mean is None and one["f"].iqr == 2.0
    single = describe.describe(df.limit(1), ["f"]).first()
    assert single.std is None and single["count"] == 1
    assert schema.described_columns(df) == ["ord", "f", "g"]


def test_measurements_drop_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1, v) for v in (1.0, 2.0, inf, -inf, math.nan, None)] + [(2, None), (3, 4.0)], "patch_idx long, f double")
    out = {r.patch_idx: r for r in cells.measurement_stats(df, ["f"]).collect()}
    assert out[1].morph_f_mean == 1.5 and out[1].morph_f_entropy == 1.0 and out[2].morph_f_mean is None
    assert out[3].morph_f_skewness == 0 and out[3].morph_f_kurtosis == 0 and out[3].morph_f_entropy == 0


def test_cells_without_class_or_geometry(spark):
    df = spark.createDataFrame([(1, None, [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0)]]), (1, " Dead\t", None), (2, "class_-1", [[(0.0, 0.0)]])], "patch_idx long, class_name string, geometry array<array<struct<x:double,y:double>>>")
    kept = cells.normalised_cells(df)
    assert sorted(r.class_name for r in kept.collect()) == ["class_-1", "unknown"]
    got = {r.patch_idx: r for r in cells.composition(spark.createDataFrame([(1,), (2,), (3,)], "patch_idx long"), df).collect()}
    assert got[1].dist_ratio_dead == 0.5 and got[2].dist_cell_count_total == 1 and got[3].dist_ratio_dead == 0
    assert cells.with_summary(df, None).first().n_cells == 0
    counted = df.withColumns({"sample_id": F.lit("s"), "barcode": F.col("class_name"), "cell_id_in_patch": F.col("patch_idx"), "n_cells": F.lit(9)})
    assert sorted(tuple(r) for r in cells.patch_counts(counted.where("class_name IS NOT NULL")).collect()) == [("s", 1, " Dead\t", 9), ("s", 2, "class_-1", 9)]
    assert cells.tallies(df, df.select("patch_idx").distinct()).first().num_polygons == 3


def test_region_of_49_and_50_pixels(spark):
    rows = [(n, 8, 8, [100] * 64, [255] * n + [0] * (64 - n)) for n in (49, 50)] + [(1, 8, 8, [1, 2], [1, 1])]
    df = spark.createDataFrame(rows, "n int, h int, w int, px array<int>, mask array<int>")
    out = {r.n: r for r in texture.texture_features(df, ["n"]).collect()}
    assert out[49].original_firstorder_Mean is None and out[50].original_firstorder_Mean == 100 and out[1].original_glcm_Id is None
    assert len(out[50]) == 94


def test_genes(spark):
    rows = [("a", "o1", "G1", 1.0), ("a", "o2", "G1", 0.0), ("a", "o2", "BLANK_1", 5.0), ("b", "p1", "G1", 2.0), ("b", "p1", "NegControl", 3.0), ("b", "p1", "G2", 3.0), ("a", "o1", "BLANK_1", 5.0), ("b", "p1", "BLANK_1", 1.0)]
    df = spark.createDataFrame(rows, "sample_id string, obs_id string, gene string, value double")
    of = genes.totals(df)
    common = genes.common_genes(of)
    assert [r.gene for r in common.collect()] == ["G1"]
    sums = genes.moments(of, common)
    assert genes.top_by_mean(sums, 5).first()["mean"] == 1.0
    assert [r.norm for r in genes.highly_variable(sums, 5).collect()] == [1.0]
    assert set(genes.gene_sets(sums, ks=(1,))) == {("mean", 1), ("var", 1)}
    with pytest.raises(ValueError):
        genes.gene_sets(sums, criteria=("median",))
    other = df.where("gene = 'G2'").unionByName(df.where("sample_id = 'a'"))
    with pytest.raises(ValueError):
        genes.gene_sets(genes.moments(genes.totals(other), genes.common_genes(genes.totals(other))))


def test_matrix_counts_observations_without_counts(spark):
    rows = [("a", i, f"o{i}", [0, 2] if i == 0 else [], [3.0, 0.0] if i == 0 else []) for i in range(10)] + [("b", 0, "p", [1], [1.0]), (None, 0, "q", [0], [2.0])]
    matrix = spark.createDataFrame(rows, expression.MATRIX)
    var = spark.createDataFrame([(s, i, g) for s in ("a", "b", None) for i, g in enumerate(("G2", "G1", "G3"))], "sample_id string, index int, gene string")
    of = expression.totals(matrix, var)
    assert {r.sample_id: r.n_obs for r in of.sizes.collect()} == {"a": 10, "b": 1, None: 1}
    got = {(r.sample_id, r.gene): (r.n_detected, r.s1, r.s2) for r in of.sums.collect()}
    assert got["a", "G2"] == (1, 3.0, 9.0) and got["a", "G3"] == (0, 0.0, 0.0) and got["b", "G1"] == (1, 1.0, 1.0) and len(got) == 9
    assert {(r.sample_id, r.gene) for r in genes.detected(of, 0.1).collect()} == {("a", "G2"), ("b", "G1"), (None, "G2")}
    assert genes.detected(of, 0.11).where("sample_id = 'a'").count() == 0
    one = expression.totals(matrix.where("sample_id = 'a'"), var.where("sample_id = 'a'"))
    assert [(r.gene, r.mean) for r in genes.top_by_mean(genes.moments(one, genes.common_genes(one, 0.0)), 3).collect()] == [("G2", 0.3), ("G1", 0.0), ("G3", 0.0)]  # ties in the order of columns
    back = expression.from_long(matrix.select("sample_id", "obs_row", "obs_id"), expression.long(matrix, var).where("sample_id IS NOT NULL"))[0]
    assert {(r.sample_id, r.obs_row): r.data for r in back.collect()}["a", 0] == [3.0, 0.0] and back.where("size(data) = 0").count() == 10
    empty = expression.totals(matrix.limit(0), var.limit(0))
    assert empty.sums.count() == empty.sizes.count() == 0


def test_sums_of_many_samples_and_of_any_partition(spark, monkeypatch):
    monkeypatch.setattr(expression, "SAMPLES", 3)
    rows = [(f"s{i % 50}", i, f"o{i}", [i % 7, 7 + i % 5], [float(i), 1.0]) for i in range(2000)]
    var = spark.createDataFrame([(f"s{k}", i, f"G{i}") for k in range(50) for i in range(12)], "sample_id string, index int, gene string")
    got = {(r.sample_id, r.gene): r.s1 for r in expression.totals(spark.createDataFrame(rows, expression.MATRIX).repartition(3), var).sums.collect()}
    want = {(f"s{k}", f"G{i}"): float(sum((r[1] if i < 7 else 1) for r in rows if r[0] == f"s{k}" and i in r[3])) for k in range(50) for i in range(12)}
    assert got == want


def test_names_move_with_their_rows_and_do_not_collide(spark):
    names = ["A", "A", "A-1", "B", "A", "B", "B-2", "B", None, None, "A-1"]
    df = spark.createDataFrame([("s", i, n, [0], [float(i)]) for i, n in enumerate(names)] + [("t", 0, "A", [], [])], expression.MATRIX)
    got = {(r.sample_id, r.obs_row): (r.obs_id, r.data) for r in expression.unique_observations(df).collect()}
    assert [got["s", i][0] for i in range(8)] == ["A", "A-2", "A-1", "B", "A-3", "B-1", "B-2", "B-3"] and got["s", 10][0] == "A-1-1"
    assert all(got["s", i][1] == [float(i)] for i in range(len(names))) and got["t", 0] == ("A", [])


def test_representatives_tell_tiny_differences_apart(spark):
    df = spark.createDataFrame([("a", i, i * 1e-8) for i in range(11)], "sample_id string, ord long, f double")
    out = {r.stat_name: r.ord for r in describe.representatives(df, ["f"], ["ord"], ["ord"]).collect()}
    assert out["min"] == 0 and out["max"] == 10 and out["q50"] == 5

@pytest.mark.parametrize("ratio", [0.01, 0.1, 0.33, 0.5, 0.99, 1.0])
def test_even_spacing_matches_numpy(spark, ratio):
    import numpy as np

    sizes = [*range(1, 60), 101, 399]
    df = spark.createDataFrame([(n, p) for n in sizes for p in range(n)], "n long, p long")
    got = {}
    for r in df.where(selection.evenly_spaced(F.col("p"), F.col("n"), ratio)).collect():
        got.setdefault(r.n, set()).add(r.p)
    for n in sizes:
        want = max(1, math.ceil(n * ratio))
        positions = set(range(n)) if want >= n else set(np.linspace(0, n - 1, want).astype(int).tolist())
        assert got[n] == positions
    with pytest.raises(ValueError):
        selection.evenly_spaced(F.col("p"), F.col("n"), 0)


def test_names():
    assert names.feature_prefix("Cell Seg", None, "ALL ") == "cell_seg_all_" and names.class_name_scalar(None) == "none"
    assert names.as_bool("Yes") and not names.as_bool("0") and names.as_bool(None) is None and names.as_bool(True)
    assert names.none_like("none") is None and names.none_like([]) is None and names.none_like("x") == "x"
    for text in ("maybe", "on", "t"):
        with pytest.raises(ValueError):
            names.as_bool(text)


def test_name_columns(spark):
    df = spark.createDataFrame([("é/ü__x",), ("_" * 5 + "a" * 200,), ("",), (None,)], "t string")
    got = [tuple(r) for r in df.select(names.file_name(F.col("t")), names.path_name(F.col("t")), names.without_shape2d(F.lit("Original_Shape2D_Area"))).collect()]
    assert got[0][:2] == ("é_ü_x", "é_ü_x") and len(got[1][0]) == 180 and got[2][:2] == ("", "") and got[3][:2] == (None, "") and got[0][2] == "area"
    rows = spark.range(1).select(names.base_name(F.lit(12), F.lit("a b")), names.base_name(F.lit(1234567), F.lit("")), names.decoded(F.lit(b"x")), names.decoded(F.lit(None), "")).first()
    assert tuple(rows) == ("patch_000012_a_b", "patch_1234567", "x", "")


def test_column_roles(spark):
    assert [c for c in ("morph_a", "patch_idx", "patch_mask_area", "patch_original_x", "cellseg_mask_area", "CELLSEG_all_wavelet-HH_x", "dist_a") if schema.is_normalised(c)] == ["morph_a", "patch_original_x", "CELLSEG_all_wavelet-HH_x"]
    df = spark.createDataFrame([([b"a", b"x"], b"b", [1.0, 2.0], [1] * 12, 2, 2)], "barcodes array<binary>, barcode binary, spatial array<double>, imgs array<int>, h int, w int")
    r = readers.patches(df).first()
    assert (r.barcode, r.x, r.y) == ("a", 1.0, 2.0)
    r = readers.patches(df, "segment").first()
    assert (r.barcode, r.x) == ("b", None)
    assert readers.patches(df.drop("barcode", "barcodes", "spatial"), "patch").first().barcode is None
    for column, reader in (("imgs", "extract"), ("spatial", "extract")):
        with pytest.raises(KeyError):
            readers.patches(df.drop(column), reader)
    with pytest.raises(KeyError):
        readers.patches(df.drop("barcode", "barcodes"), "segment")


def test_layouts(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5, 6], 1, 2, [1, 2, 3, 9, 4, 5, 6, 9], [0.5, 2.0, -1.0])], "chw array<int>, h int, w int, rgba array<int>, f array<float>")
    r = df.select(pixels.interleaved(F.col("chw"), F.col("h"), F.col("w")).alias("a"), pixels.without_alpha(F.col("rgba")).alias("b"), pixels.repeated(F.col("chw")).alias("c"), pixels.as_uint8(F.col("f")).alias("d"), pixels.full_mask(F.col("chw")).alias("e")).first()
    assert r.a == [1, 3, 5, 2, 4, 6] and r.b == [1, 2, 3, 4, 5, 6] and r.c[:4] == [1, 1, 1, 2] and r.d == [0, 2, 0] and r.e == [255] * 6
    with pytest.raises(ValueError):
        pixels.filtered(F.col("f"), "wavelet")


def test_polygon_with_hole(spark):
    ring = lambda a, b: [(a, a), (b, a), (b, b), (a, b)]
    df = spark.createDataFrame([([ring(0.0, 4.0), ring(1.0, 2.0)],), ([[(0.0, 0.0), (1.0, 1.0)]],)], "g array<array<struct<x:double,y:double>>>")
    got = [tuple(r) for r in df.select(geometry.area(F.col("g")), geometry.perimeter(F.col("g"))).collect()]
    assert got == [(15.0, 20.0), (0.0, 0.0)]


BOX = lambda a, b: [[(a, a), (b, a), (b, b), (a, b)]]
CELLS = "sample_id string, patch_idx long, barcode string, cell_id_in_patch long, size double, geometry array<array<struct<x:double,y:double>>>"


def some_patches(spark, sample="s", n=5):
    return spark.createDataFrame([(sample, i, f"B{i}", 1.0, 2.0, 8, 8, [(17 * i + 3 * k) % 256 for k in range(64)]) for i in range(n)], schema.PATCHES)


def some_cells(spark, sample="s"):
    rows = [(sample, 0, "B0", 0, 4.0, BOX(0.0, 7.0)), (sample, 1, "B1", 1, 2.0, BOX(2.0, 3.0)), (sample, 1, "B1", 2, None, BOX(5.0, 6.0))]
    return spark.createDataFrame(rows, CELLS).withColumn("class_name", F.lit("Dead"))


def test_features_under_cells(spark):
    table = pipeline.extract(some_patches(spark), some_cells(spark), schema.Config(mask_source="cellseg"), ["size"])
    got = {r.patch_idx: r for r in table.collect()}
    assert got[0].cellseg_mask_area == 64 and got[0].cellseg_all_original_glcm_Id is not None and got[0].status == "ok"
    # a feature with one value in a sample is constant there, and 0 on all rows that are ok
    assert got[1].cellseg_mask_area == 8 and got[1].cellseg_all_original_glcm_Id == 0.0 and got[1].status == "ok" and got[1].n_cells_total == 2
    assert got[3].status == schema.SKIPPED_NO_CELLS and got[3].dist_cell_count_total == 0 and got[3].morph_size_mean is None and got[3].cellseg_mask_area is None
    assert got[0].barcode == "B0" and got[0].mask_path == "" and got[1].dist_ratio_dead == 1.0
    assert len([c for c in table.columns if c.startswith("cellseg_all_original_")]) == 93
    assert len([c for c in table.columns if c.startswith("morph_") and not c.startswith("morph_size")]) == 162
    raw = pipeline.cell_features(some_patches(spark), some_cells(spark)).where("patch_idx = 1").first()
    assert raw.cellseg_all_original_glcm_Id is None and raw.morph_pixelsurface_mean == 4.0 and raw.morph_pixelsurface_variance == 0.0 and raw.morph_pixelsurface_entropy == 0.0
    for bad in (schema.Config(mask_source="other"), schema.Config(mask_source="cellseg")):
        with pytest.raises(ValueError):
            pipeline.extract(some_patches(spark), None, bad)


def test_file_order_of_cells_decides_what_holes_erase(spark):
    whole, holed = BOX(0.0, 7.0), [*BOX(0.0, 7.0), [(2.0, 2.0), (5.0, 2.0), (5.0, 5.0), (2.0, 5.0)]]
    for first, second, area in ((whole, holed, 48), (holed, whole, 64)):
        cells = spark.createDataFrame([("s", 0, "B0", 1, 1.0, first), ("s", 0, "B0", 2, 1.0, second)], CELLS)
        assert pipeline.cell_features(some_patches(spark, n=1), cells).first().cellseg_mask_area == area


def test_cells_of_several_polygons_and_outside(spark):
    rows = [("s", 0, 1, [BOX(0.0, 1.0), BOX(3.0, 4.0), []]), ("s", 0, 2, [BOX(-3.0, 1.0)]), ("s", 0, 3, [BOX(20.0, 30.0)]), ("s", 0, 4, [])]
    cells = spark.createDataFrame(rows, "sample_id string, patch_idx long, cell_id_in_patch long, geometry array<array<array<struct<x:double,y:double>>>>")
    r = pipeline.cell_features(some_patches(spark, n=1), cells).first()
    assert r.n_cells_total == 4 and r.cellseg_mask_area == 8 and r.morph_pixelsurface_maximum == 8.0 and r.morph_pixelsurface_minimum == 4.0 and r.status == "ok"


def test_images_of_all_layouts(spark):
    rgb = [[[10 * y + x, 60 + y, 90 + x] for x in range(8)] for y in range(8)]
    chw = [[[rgb[y][x][c] for x in range(8)] for y in range(8)] for c in range(3)]
    flat = [v for row in rgb for p in row for v in p]
    gray = [(p[0] * 19595 + p[1] * 38470 + p[2] * 7471 + 32768) >> 16 for row in rgb for p in row]
    frames = [
        spark.createDataFrame([("s", 0, rgb)], "sample_id string, patch_idx long, img array<array<array<int>>>"),
        spark.createDataFrame([("s", 1, chw)], "sample_id string, patch_idx long, img array<array<array<int>>>"),
        spark.createDataFrame([("s", 2, [gray[8 * k : 8 * k + 8] for k in range(8)])], "sample_id string, patch_idx long, img array<array<int>>"),
        spark.createDataFrame([("s", 3, flat, 8, 8)], "sample_id string, patch_idx long, img array<int>, h int, w int"),
        spark.createDataFrame([("s", 4, bytearray(flat), 8, 8)], "sample_id string, patch_idx long, img binary, h int, w int"),
    ]
    rows = [pipeline.threshold_features(readers.patches(f, "patch")).drop("patch_idx").first() for f in frames]
    assert len({*rows}) == 1 and rows[0].status == "ok" and rows[0].patch_original_firstorder_Mean == pytest.approx(sum(g for g in gray if 30 < g < 220) / sum(30 < g < 220 for g in gray))
    assert readers.as_rgb8(readers.patches(frames[1], "patch")).first().px == flat
    assert readers.as_rgb8(readers.patches(frames[2], "patch")).first().px == [g for g in gray for _ in range(3)]


def test_broken_patches_have_an_error_status(spark):
    good = [(7 * k) % 256 for k in range(64)]
    rows = [("s", 0, "a", 8, 8, good), ("s", 1, "b", 8, 8, good[:60]), ("s", 2, "c", 8, 8, [None, *good[1:]]), ("s", 3, "d", 8, 8, None), ("s", 4, "e", None, 8, good), ("s", 5, "f", 8, 8, [5] * 64)]
    df = spark.createDataFrame(rows, "sample_id string, patch_idx long, barcode string, h int, w int, px array<int>")
    got = {r.patch_idx: r for r in pipeline.threshold_features(df).collect()}
    assert got[0].status == "ok" and got[0].error is None and got[5].status == schema.SKIPPED_SMALL_MASK and got[5].patch_mask_area == 0
    for k in (1, 2, 3, 4):
        assert got[k].status == "error" and got[k].error and got[k].barcode is None and got[k].patch_mask_area is None and got[k].patch_original_firstorder_Mean is None
    assert "60 values" in got[1].error
    table = {r.patch_idx: r for r in pipeline.extract(df, None, schema.Config()).collect()}
    assert table[1].patch_original_firstorder_Mean is None and table[1].error == got[1].error


def test_an_extractor_that_fails_leaves_its_code(monkeypatch):
    import pyarrow as pa

    from spatialfeat.functions import kernels

    whole = kernels.glcm

    def failing(level, offsets=kernels.PLANE, mcc=True):
        if level.max() > 5:
            raise ArithmeticError("too many levels")
        return whole(level, offsets, mcc)

    monkeypatch.setattr(kernels, "glcm", failing)
    px = pa.array([[100 + k % 50 for k in range(64)], [31 + 3 * k % 189 for k in range(64)]], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([px, pa.nulls(2, pa.string()), pa.array([8, 8], pa.int32()), pa.array([8, 8], pa.int32()), pa.array([1, 2])], ["px", "layout", "h", "w", "k0"])
    names = texture.feature_names()
    (out,) = texture._featured_patches(iter([batch]), names, (), 25, kernels.PLANE, 50, 255, False)
    got = {c: out.column(c).to_pylist() for c in ("status", "original_firstorder_Mean", "original_glcm_Id", "original_ngtdm_Contrast")}
    assert got["status"][0] == "ok" and got["status"][1].startswith("error_patch_radiomics: ArithmeticError")
    assert got["original_firstorder_Mean"][1] is not None and got["original_glcm_Id"][1] is None and got["original_ngtdm_Contrast"][1] is None and got["original_glcm_Id"][0] is not None


def test_batches_fit_the_size_of_patches(spark):
    from spatialfeat.operators import spread

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        large = spark.range(3).select(F.col("id").alias("patch_idx"), F.lit("s").alias("sample_id"), F.array_repeat(F.lit(90), 512 * 512).alias("px"), F.lit(512).alias("h"), F.lit(512).alias("w"))
        assert spread.fitting_batches(large) == 32 == int(spark.conf.get(key))
        assert spread.fitting_batches(some_patches(spark)) == 10_000 and spread.fitting_batches(large.limit(0)) == 10_000
        assert {r.status for r in pipeline.threshold_features(large).select("status").collect()} == {"ok"}
        spark.conf.set(key, "77")
        assert spread.fitting_batches(large) == 77
    finally:
        spark.conf.set(key, before)


def test_settings_act(spark):
    patches = some_patches(spark)
    five, fifty = (pipeline.threshold_features(patches, schema.Config(bin_width=w)).orderBy("patch_idx").first() for w in (5, 50))
    assert five.patch_original_firstorder_Entropy > fifty.patch_original_firstorder_Entropy and five.patch_original_firstorder_Mean == fifty.patch_original_firstorder_Mean
    plane, axis = (pipeline.threshold_features(patches, schema.Config(directions=d)).orderBy("patch_idx").first() for d in ("plane", "axis"))
    assert plane.patch_original_glcm_Contrast != axis.patch_original_glcm_Contrast
    more = pipeline.threshold_features(patches, schema.Config(filters=("Square", "Original", "exponential")))
    assert len([c for c in more.columns if c.startswith(("patch_original_", "patch_square_", "patch_exponential_"))]) == 3 * 93
    for bad in ({"filters": ("Wavelet",)}, {"directions": "both"}):
        with pytest.raises(ValueError):
            pipeline.threshold_features(patches, schema.Config(**bad))


def test_statistics_of_cells_match_the_column_form(spark):
    import numpy as np

    from spatialfeat.functions import kernels

    rnd = np.random.default_rng(3)
    values = {k: rnd.choice([1.0, 2.5, 7.0, math.inf, math.nan, 4.25], size=n) for k, n in enumerate((1, 2, 5, 40, 300))}
    df = spark.createDataFrame([(k, float(v)) for k, x in values.items() for v in x], "patch_idx long, f double")
    for r in cells.measurement_stats(df, ["f"]).collect():
        got = kernels.statistics(values[r.patch_idx])
        want = [r[f"morph_f_{s}"] for s in kernels.STATISTICS]
        assert (got is None and want[0] is None) or got == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_bins_of_measurements_are_as_sql_says_and_cells_are_gathered_once(spark):
    import duckdb

    rows = [(k % 9, round(0.01 * (k * k % 11), 2), float(k % 50) if k % 7 else None) for k in range(500)]
    made = cells.measurement_stats(spark.createDataFrame(rows, "patch_idx long, f double, g double"), ["f", "g"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and plan.count("functions=[collect_list(") == 1 and "lambda" not in plan
    con = duckdb.connect()
    con.execute("CREATE TABLE t (patch_idx BIGINT, f DOUBLE, g DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    for x in ("f", "g"):
        want = dict(con.execute(f"""WITH a AS (SELECT patch_idx, {x} AS x, min({x}) OVER w AS lo, max({x}) OVER w AS hi, count(*) OVER w AS n, least(16, count(*) OVER w) AS bins FROM t WHERE {x} IS NOT NULL WINDOW w AS (PARTITION BY patch_idx)),
            b AS (SELECT patch_idx, any_value(n) AS n, count(*) AS k FROM a GROUP BY patch_idx, least(floor((x - lo) / ((hi - lo) / bins)), bins - 1)) SELECT patch_idx, -sum(k / n * log2(k / n)) FROM b GROUP BY patch_idx""").fetchall())
        assert {r.patch_idx: r[f"morph_{x}_entropy"] for r in made.collect()} == pytest.approx(want)


def test_cells_and_measurements_of_few_patches_are_shuffled_once(spark, tmp_path):
    some_cells(spark).withColumn("q", F.col("cell_id_in_patch") * 1.5).write.parquet(str(tmp_path / "cells"))
    drawn = spark.read.parquet(str(tmp_path / "cells"))
    made = pipeline.cell_features(some_patches(spark), drawn, measurements=["q"])
    assert made._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    want = {r.patch_idx: (r.m, r.n) for r in drawn.groupBy("patch_idx").agg(F.avg("q").alias("m"), F.count("q").alias("n")).collect()}
    got = {r.patch_idx: (r.morph_q_mean, r.n_cells_total) for r in made.collect()}
    assert want and {k: v for k, v in got.items() if v[1]} == want and all(v == (None, 0) for k, v in got.items() if k not in want)
    lines = spark.createDataFrame([(k, f"c{k}") for k in (-5, 1, 2, 2, 3, 9, None)], "patch_idx long, cell string")
    there = spark.createDataFrame([(1, "s"), (3, "t"), (4, "s")], "patch_idx long, sample_id string")
    assert sorted((r.patch_idx, r.cell, r.sample_id) for r in cells.of_patches(lines, there).collect()) == [(1, "c1", "s"), (3, "c3", "t")]
    assert cells.of_patches(lines, there.where("patch_idx > 9")).count() == 0


def test_rows_are_never_broadcast_to_meet_their_quantiles(spark):
    df = spark.createDataFrame([("s", "ok", 1.0), ("s", "ok", 2.0), (None, "error", 3.0)], "sample_id string, status string, morph_x double")
    plan = normalize.normalize(df)._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter" in plan and "BuildLeft" not in plan


# ------------------------------------------------------------ drivers


@pytest.fixture
def dataset(spark, tmp_path):
    root = str(tmp_path / "data")
    for sample in ("s1", "s2", "007"):
        some_patches(spark, sample).drop("sample_id").write.parquet(f"{root}/IDC/patches/sample_id={sample}")
    return root


def with_image(spark, root):
    """Patches as a source names them."""
    from spatialfeat.sources.sinks import read_samples, samples

    named = read_samples(spark, f"{root}/IDC/patches").select("sample_id", "patch_idx", F.col("px").alias("img"), "h", "w", F.array("x", "y").alias("coords"), F.col("barcode").alias("barcodes"))
    named = spark.createDataFrame(named.collect(), named.schema)
    samples(named, f"{root}/IDC/patches")


def test_samples_are_extracted_one_after_the_other(spark, dataset):
    from spatialfeat.plans import drivers
    from spatialfeat.sources.sinks import read_samples

    with_image(spark, dataset)
    config = lambda **k: schema.Config(root=dataset, oncotrees=("IDC", "NONE"), **k)
    assert drivers.extract_all(spark, config(sample_ids=("s1",))) == {"IDC": {"s1": "written"}, "NONE": {}}
    first = sorted(map(str, read_samples(spark, f"{dataset}/IDC/radiomics/table").collect()))
    assert drivers.extract_all(spark, config(sample_ids=("s2", "s1", "unknown"))) == {"IDC": {"s2": "written", "s1": "skipped"}, "NONE": {}}
    table = read_samples(spark, f"{dataset}/IDC/radiomics/table")
    assert {r.sample_id for r in table.collect()} == {"s1", "s2"} and sorted(map(str, table.where("sample_id = 's1'").collect())) == first
    assert drivers.extract_all(spark, config()) == {"IDC": {"007": "written", "s1": "skipped", "s2": "skipped"}, "NONE": {}}
    for part in ("table", "X", "obs", "stats", "raw"):
        assert {r.sample_id for r in read_samples(spark, f"{dataset}/IDC/radiomics/{part}").select("sample_id").distinct().collect()} == {"007", "s1", "s2"}
    features = [r.value for r in spark.read.text(f"{dataset}/IDC/radiomics/feature_list").collect()]
    assert len(features) == 93 and all(f.startswith("patch_original_") for f in features) and len(read_samples(spark, f"{dataset}/IDC/radiomics/X").first().X) == 93
    assert {"patch_mask_area", "status", "barcode"} <= {*read_samples(spark, f"{dataset}/IDC/radiomics/obs").columns}
    again = drivers.extract_all(spark, config(overwrite=True, sample_ids=("s1",)))
    assert again["IDC"] == {"s1": "written"} and read_samples(spark, f"{dataset}/IDC/radiomics/table").count() == 15
    assert drivers.statistics_all(spark, config()) == {"IDC": True, "NONE": False}
    at = f"{dataset}/IDC/radiomics_statistics/describe"
    assert read_samples(spark, f"{at}/parquet").count() == 3 * 94
    # statistics of one sample leave those of others
    before = sorted(map(str, read_samples(spark, f"{at}/parquet").where("sample_id <> 's1'").collect()))
    assert drivers.statistics_all(spark, config(sample_ids=("s1",))) == {"IDC": True, "NONE": False}
    assert read_samples(spark, f"{at}/parquet").count() == 3 * 94 and sorted(map(str, read_samples(spark, f"{at}/parquet").where("sample_id <> 's1'").collect())) == before
    assert spark.read.csv(f"{at}/csv", header=True).count() == 3 * 94
    chosen = spark.read.csv(f"{dataset}/IDC/radiomics_statistics/representatives", header=True)
    assert chosen.select("sample_id").distinct().count() == 3


@pytest.mark.parametrize("step", ["stats", "X", "done"])
def test_a_run_that_ends_between_its_outputs_is_repeated(spark, dataset, monkeypatch, step):
    from spatialfeat.plans import drivers

    with_image(spark, dataset)
    config = schema.Config(root=dataset, sample_ids=("s1",))
    whole, marked = sinks.samples, sinks.mark
    with monkeypatch.context() as m:

        def broken(df, path):
            if path.endswith(f"/{step}"):
                raise OSError("the cluster went away")
            whole(df, path)

        def unmarked(spark, path, some, state):
            if state == sinks.DONE and step == "done":
                raise OSError("the cluster went away")
            marked(spark, path, some, state)

        m.setattr(sinks, "samples", broken)
        m.setattr(sinks, "mark", unmarked)
        assert drivers.extract_all(spark, config)["IDC"]["s1"].startswith("failed")
    assert drivers.extract_all(spark, config)["IDC"] == {"s1": "written"} and drivers.extract_all(spark, config)["IDC"] == {"s1": "skipped"}
    with monkeypatch.context() as m:  # an overwrite that does not come to its end is no longer done either
        m.setattr(sinks, "samples", broken)
        m.setattr(sinks, "mark", unmarked)
        drivers.extract_all(spark, schema.Config(root=dataset, sample_ids=("s1",), overwrite=True))
    assert drivers.extract_all(spark, config)["IDC"] == {"s1": "written"}


@pytest.mark.parametrize("bad", [set(), {0}, {37}, {63}, {3, 50}])
def test_bad_samples_cost_few_runs(bad):
    from spatialfeat.plans import drivers

    runs, names = [], [f"s{k}" for k in range(64)]

    def run(some):
        runs.append(some)
        if any(names.index(s) in bad for s in some):
            raise ValueError("cannot be read")

    out = drivers._each(names, [], run)
    assert {k for k, v in enumerate(out.values()) if v != "written"} == bad and list(out) == names
    assert len(runs) <= 1 + 12 * len(bad)
    assert drivers._each(names, names, run) == dict.fromkeys(names, "skipped")


def test_a_sample_that_cannot_be_read_fails_alone(spark, dataset):
    from pathlib import Path

    from spatialfeat.plans import drivers

    with_image(spark, dataset)
    for file in Path(f"{dataset}/IDC/patches/sample_id=s2").iterdir():
        file.write_bytes(b"PAR1 nothing")
    out = drivers.extract_all(spark, schema.Config(root=dataset))
    assert out["IDC"]["s1"] == out["IDC"]["007"] == "written" and out["IDC"]["s2"].startswith("failed")


def test_two_samples_that_share_patches_and_barcodes(spark, dataset):
    from spatialfeat.plans import drivers
    from spatialfeat.sources.sinks import read_samples

    with_image(spark, dataset)
    found = some_cells(spark, "s1").unionByName(some_cells(spark, "s2")).drop("cell_id_in_patch")
    config = schema.Config(root=dataset, mask_source="cellseg", sample_ids=("s1", "s2", "007"), vis_ratio=0.5)
    out = drivers.run_all(spark, config, {"IDC": found}, visualise=True)
    assert out["segment"]["IDC"] == {"s1": "written", "s2": "written", "007": "written"} and out["genes"] == []
    rows = read_samples(spark, f"{dataset}/IDC/segment").collect()
    assert len(rows) == 6 and sorted((r.sample_id, r.patch_idx, r.cell_id_in_patch, r.n_cells) for r in rows) == [(s, *x) for s in ("s1", "s2") for x in ((0, 1, 1), (1, 1, 2), (1, 2, 2))]
    assert {r.sample_id: (r.num_patches, r.num_polygons) for r in read_samples(spark, f"{dataset}/IDC/segment_summary").collect()} == {"s1": (5, 3), "s2": (5, 3), "007": (5, 0)}
    assert out["extract"]["IDC"]["s1"] == out["extract"]["IDC"]["s2"] == "written" and out["extract"]["IDC"]["007"].startswith("failed")
    table = read_samples(spark, f"{dataset}/IDC/radiomics/table")
    assert table.count() == 10 and sorted(r.n_cells_total for r in table.where("sample_id = 's2'").collect()) == [0, 0, 0, 1, 2]
    assert read_samples(spark, f"{dataset}/IDC/patches_vis").groupBy("sample_id").count().collect()[0]["count"] == 3
    assert drivers.segment_all(spark, config, {"IDC": found})["IDC"]["s1"] == "skipped"


def test_gene_sets_of_a_folder(spark, tmp_path):
    from spatialfeat.plans import drivers

    rows = [(f"s{s}", f"o{o}", f"G{g}", float((g + 1) * (o % 3 + 1))) for s in range(2) for o in range(10) for g in range(12)]
    spark.createDataFrame(rows, "sample_id string, obs_id string, gene string, value double").write.partitionBy("sample_id").parquet(str(tmp_path / "IDC/st"))
    out = drivers.gene_sets_all(spark, schema.Config(root=str(tmp_path), oncotrees=("IDC", "NONE"), genes_k=(3,), genes_criteria=("mean",)))
    assert [(x["oncotree_code"], x["criteria"], x["k"], x["num_genes"]) for x in out] == [("IDC", "mean", 3, 3)]
    assert spark.read.json(str(tmp_path / "IDC/genes/mean_3genes.json")).first().genes == ["G11", "G10", "G9"]
    assert spark.read.json(str(tmp_path / "gene_extraction_summary.json")).count() == 1


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "m.csv").write_text("id,species,oncotree_code,st_technology,more\na,Homo sapiens,IDC,Visium,1\nb,Mus musculus,IDC,Visium,2\nc,Homo sapiens,LUAD,Visium,3\n")
    assert [r.id for r in readers.wanted(spark, str(tmp_path / "m.csv"), ["IDC"], ["Visium"]).collect()] == ["a"]
    wkt = ["POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5.5 5, 6 5, 6 6e0, 5.5 5)))", "POINT (1 1)", None, "POLYGON EMPTY"]
    g = [r.g for r in spark.createDataFrame([(w,) for w in wkt], "w string").select(geometry.from_wkt("w").alias("g")).collect()]
    assert [len(p) for p in g[0]] == [2] and tuple(g[0][0][1][2]) == (2.0, 2.0) and len(g[1]) == 2 and tuple(g[1][1][0][0]) == (5.5, 5.0) and g[2] == [] and g[3] is None and g[4] == []
    rows = [(0, "b", 1, 1, " Dead", wkt[0])]
    spark.createDataFrame(rows, "patch_idx long, barcode string, cell_id_in_patch long, class_id long, class_name string, geometry_wkt string").write.parquet(str(tmp_path / "cells/sample_id=1"))
    got = readers.cells_normalised(spark, str(tmp_path / "cells")).first()
    assert got.class_name == "dead" and got.sample_id == "1" and len(got.geometry) == 1 and readers.cells_normalised(spark, None) is None
    spark.createDataFrame([(0, wkt[0])], "patch_idx long, geometry_wkt string").write.parquet(str(tmp_path / "bad"))
    with pytest.raises(KeyError):
        readers.cells(spark, str(tmp_path / "bad"))
    made = pipeline.statistics(pipeline.extract(some_patches(spark), None, schema.Config()), schema.Config(save_boxplot=False), ["patch_idx"], ["barcode"])
    assert set(made) == {"describe", "representatives"}
    sinks.csv_and_parquet(made["describe"], str(tmp_path / "stats"))
    sinks.manifest(made["representatives"], str(tmp_path / "manifest"))
    sinks.json_rows(sinks.parquet_safe(some_patches(spark)), str(tmp_path / "json"))
    assert spark.read.parquet(str(tmp_path / "stats/parquet")).count() == made["describe"].count()
    assert readers.sample_ids(spark, str(tmp_path / "cells"), ["x", "1"]) == ["1"] and readers.sample_ids(spark, str(tmp_path / "none")) == []
    with pytest.raises(FileNotFoundError):
        readers.expression(spark, str(tmp_path / "cells"), spark.createDataFrame([("z",)], "sample_id string"))


def test_paths_and_settings(tmp_path):
    from spatialfeat.sources import paths

    assert paths.sample("r/", "IDC", "patches", "S1") == "r/IDC/patches/sample_id=S1" and set(paths.of_sample("r", "IDC", "S1")) == set(paths.STAGES)
    with pytest.raises(ValueError):
        paths.stage("r", "IDC", "other")
    yaml = pytest.importorskip("yaml")
    assert yaml
    for text, want in (("", {}), ("a: 1", {"a": 1})):
        (tmp_path / "c.yml").write_text(text)
        assert paths.config_file(str(tmp_path / "c.yml")) == want
    found = paths.settings({"overwrite": "no", "bin_width": "10", "oncotrees": "LUAD", "genes_k": [5], "sample_ids": "none", "lower_q": None}, root="r")
    assert (found.overwrite, found.bin_width, found.oncotrees, found.genes_k, found.sample_ids, found.lower_q, found.root) == (False, 10, ("LUAD",), (5,), None, 0.01, "r")
    with pytest.raises(KeyError):
        paths.settings({"colour": 1})
    (tmp_path / "c.yml").write_text("- 1")
    with pytest.raises(ValueError):
        paths.config_file(str(tmp_path / "c.yml"))


# ------------------------------------------------------------ well-known binary and text, cells with bounds


def _wkb(kind, body, order="<", flags=0, srid=None):
    head = (b"\x01" if order == "<" else b"\x00") + struct.pack(order + "I", kind | flags | (wkb.SRID if srid is not None else 0))
    return head + (struct.pack(order + "I", srid) if srid is not None else b"") + body


def _rings(rings, order="<", more=0):
    return struct.pack(order + "I", len(rings)) + b"".join(struct.pack(order + "I", len(r)) + b"".join(struct.pack(order + f"{2 + more}d", *p, *[7.0] * more) for p in r) for r in rings)


def _many(parts, order="<"):
    return struct.pack(order + "I", len(parts)) + b"".join(parts)


A, B = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (2.0, 1.0), (1.5, 2.25), (1.0, 1.0)]


def _plain(rows):
    return [None if r is None else [[[(p["x"], p["y"]) for p in ring] for ring in polygon] for polygon in r] for r in rows]


def test_settings_in_layers_and_sections():
    from spatialfeat.sources import paths

    base = {"a": {"x": 1, "deep": {"y": 2, "z": 3}}, "b": 4, "c": {"k": 1}}
    assert paths.layered(base, {"a": {"deep": {"z": 9, "y": None}}, "b": None, "c": 7}, {"c": {"m": 2}}) == {"a": {"x": 1, "deep": {"y": 2, "z": 9}}, "b": 4, "c": {"m": 2}}
    assert base == {"a": {"x": 1, "deep": {"y": 2, "z": 3}}, "b": 4, "c": {"k": 1}} and paths.layered() == {}
    assert paths.settings(paths.without_sections({"normalise": {"lower_q": 0.05}, "root": "r"})).lower_q == 0.05
    with pytest.raises(KeyError):
        paths.without_sections({"a": {"root": 1}, "root": 2})


def test_barcodes_meet_within_their_sample(spark):
    features = spark.createDataFrame([("s", "B1", 1), ("t", "B1", 2), ("t", "B2", 3)], "sample_id string, barcode string, f int")
    expr = spark.createDataFrame([("s", "B1", 7), ("t", "B1", 8)], "sample_id string, barcode string, g int")
    assert sorted((r.f, r.g) for r in selection.by_barcode(features, expr).collect()) == [(1, 7), (2, 8)]
    assert selection.by_barcode(features, expr.drop("sample_id")).count() == 4


def test_well_known_binary_of_all_kinds():
    point, line = _wkb(1, struct.pack("<2d", 5, 6)), _wkb(2, struct.pack(">I4d", 2, 0, 0, 1, 1), ">")
    cases = [
        (_wkb(3, _rings([A])), [[A]]), (_wkb(3, _rings([A, B], ">"), ">"), [[A, B]]), (None, None), (_wkb(6, _many([_wkb(3, _rings([A])), _wkb(3, _rings([B], ">"), ">")])), [[A], [B]]),
        (_wkb(7, _many([point, line, _wkb(7, _many([_wkb(3, _rings([A, B])), point])), _wkb(3, _rings([])), _wkb(6, _many([_wkb(3, _rings([B], ">"), ">")], ">"), ">")])), [[A, B], [B]]),
        (point, []), (line, []), (_wkb(4, _many([point, point])), []), (_wkb(5, _many([line])), []), (_wkb(7, _many([])), []),
        (_wkb(1003, _rings([A], more=1)), [[A]]), (_wkb(2003, _rings([A], more=1)), [[A]]), (_wkb(3003, _rings([A, B], more=2)), [[A, B]]),
        (_wkb(3, _rings([A], more=1), flags=wkb.Z), [[A]]), (_wkb(3, _rings([A], ">", more=2), ">", flags=wkb.Z | wkb.M, srid=4326), [[A]]), (_wkb(1001, struct.pack("<3d", 1, 2, 3)), []),
    ]
    column = pa.array([c for c, _ in cases], pa.binary())
    assert _plain(wkb.decoded(column).to_pylist()) == [w for _, w in cases]
    assert _plain(wkb.decoded(column[3:9]).to_pylist()) == [w for _, w in cases][3:9]  # a part of a column
    back = wkb.encoded(wkb.decoded(column))
    assert _plain(wkb.decoded(back).to_pylist()) == [w for _, w in cases] and back[0].as_py() == cases[0][0] and back[3].as_py()[5:9] == struct.pack("<I", 2)
    open_ = pa.array([[[[{"x": x, "y": y} for x, y in A[:-1]]]]], wkb.POLYGONS)
    assert wkb.encoded(open_)[0].as_py() == cases[0][0]  # rings are closed
    assert len(wkb.decoded(pa.array([], pa.binary()))) == len(wkb.encoded(pa.array([], wkb.POLYGONS))) == 0
    for bad in (cases[0][0][:-1], b"\x05", b"", _wkb(9, b""), _wkb(6, _many([_wkb(3, _rings([A]))])[:-3])):
        with pytest.raises(ValueError, match="a geometry"):
            wkb.decoded(pa.array([bad], pa.binary()))


def test_well_known_binary_of_random_cells():
    rng = np.random.default_rng(2)
    rows = [[[[(float(x), float(y)) for x, y in rng.normal(size=(rng.integers(1, 9), 2))] for _ in range(rng.integers(1, 4))] for _ in range(rng.integers(0, 4))] if k % 7 else None for k in range(200)]
    column = pa.array([r and [[[{"x": x, "y": y} for x, y in ring] for ring in p] for p in r] for r in rows], wkb.POLYGONS)
    closed = [None if r is None else [[ring if ring[0] == ring[-1] else [*ring, ring[0]] for ring in p] for p in r] for r in (r if r is None or r else [] for r in rows)]
    got = _plain(wkb.decoded(wkb.encoded(column)).to_pylist())
    assert got == [None if r is None and rows[k] is None else (r or []) for k, r in enumerate(closed)]


def test_well_known_text_of_all_kinds():
    text = wkb.polygons_of_text
    assert text("POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1,2 1,1.5 2.25,1 1))") == [[A, B]]
    assert text("MULTIPOLYGON Z (((0 0 9, 4 0 9, 4 4 9, 0 0 9)), ((1 1 9,2 1 9,1.5 2.25 9,1 1 9)))") == [[A], [B]]
    nested = "GEOMETRYCOLLECTION (POINT (1 2), POLYGON ((0 0,4 0,4 4,0 0)), GEOMETRYCOLLECTION(LINESTRING(0 0,1 1), MULTILINESTRING((0 0,1 1),(2 2,3 3)), MULTIPOLYGON(((1 1,2 1,1.5 2.25,1 1)))), POLYGON EMPTY)"
    assert text(nested) == [[A], [B]]
    assert [text(t) for t in ("POINT(1 2)", "polygon empty", "SRID=3;POLYGON((0 0,1e1 0,1 -1))", "")] == [[], [], [[[(0.0, 0.0), (10.0, 0.0), (1.0, -1.0)]]], []]
    for bad in ("POLYGON ((0 0, 1 1", "POLYGON ((0, 1 1))", "POLYGON ((a b, 1 1))"):
        with pytest.raises(ValueError):
            text(bad)


def test_cells_with_bounds_are_read_by_window(spark, tmp_path):
    rows = [(f"s{s}", k, f"B{k}", k, "Dead", BOX(100.0 * (k % 40), 100.0 * (k % 40) + 5.0)) for s in range(2) for k in range(1600)]
    rows += [("s0", 9999, "B", 1, "Dead", None)]
    df = spark.createDataFrame(rows, "sample_id string, patch_idx long, barcode string, cell_id_in_patch long, class_name string, geometry array<array<struct<x:double,y:double>>>")
    path = str(tmp_path / "cells")
    sinks.geo_cells(df, None, path, group_bytes=1)  # as small as row groups get
    back = readers.cells(spark, path)
    assert back.count() == len(rows) and spark.read.parquet(path).schema["geometry"].dataType.typeName() == "binary"
    assert {(r.sample_id, r.patch_idx): r.geometry and r.geometry[0][0][0].x for r in back.collect()} == {(r[0], r[1]): r[5] and r[5][0][0][0] for r in rows}
    assert spark.read.parquet(path).schema["geometry"].metadata["covering"]["bbox"]["xmin"] == ["bbox", "xmin"]
    some = readers.cells(spark, path, (1000.0, 0.0, 1101.0, 1e9))
    assert {r.patch_idx % 40 for r in some.collect()} == {10, 11} and some.count() == 2 * 2 * 40
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = readers.cells(spark, path, (1000.0, 0.0, 1101.0, 1e9))._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(bbox.xmax,1000.0)" in plan and "LessThanOrEqual(bbox.xmin,1101.0)" in plan
    with pytest.raises(KeyError):
        df.write.partitionBy("sample_id").parquet(str(tmp_path / "plain"))
        readers.cells(spark, str(tmp_path / "plain"), (0, 0, 1, 1))
    # the features of cells from this table are those of the cells themselves
    cells = some_cells(spark)
    sinks.geo_cells(cells, None, str(tmp_path / "few"))
    cols = ["patch_idx", "status", "cellseg_mask_area", "morph_pixelsurface_mean", "cellseg_all_original_glcm_Id"]
    got = pipeline.cell_features(some_patches(spark), readers.cells_normalised(spark, str(tmp_path / "few"))).select(cols).collect()
    assert sorted(map(str, got)) == sorted(map(str, pipeline.cell_features(some_patches(spark), cells).select(cols).collect()))


def test_places_on_the_curve_are_near(spark):
    df = spark.range(64 * 64).selectExpr("id % 64 AS x", "id DIV 64 AS y").withColumn("p", geometry.curve_place("x", "y"))
    at = [(r.x, r.y) for r in df.orderBy("p").collect()]
    assert df.select("p").distinct().count() == 64 * 64 and all(abs(a - c) + abs(b - d) == 1 for (a, b), (c, d) in zip(at, at[1:]))


def _unpacked(data):
    """The image of a PNG, by its own filters."""
    assert data.startswith(pictures.SIGNATURE)
    at, body = 8, b""
    while at < len(data):
        (n,), name = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        chunk = data[at + 8 : at + 8 + n]
        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(name + chunk)
        if name == b"IHDR":
            w, h, depth, kind = struct.unpack(">IIBB", chunk[:10])
        body += chunk if name == b"IDAT" else b""
        at += 12 + n
    step, lines = {0: 1, 2: 3}[kind], np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, -1)
    out = np.zeros((h, w * step), np.uint8)
    for y, line in enumerate(lines):
        for x in range(w * step):
            before = {0: 0, 1: out[y, x - step] if x >= step else 0, 2: out[y - 1, x] if y else 0}[int(line[0])]
            out[y, x] = (int(line[1 + x]) + int(before)) % 256
    assert depth == 8
    return out.reshape((h, w) if step == 1 else (h, w, 3))


def test_pictures_hold_what_masks_and_cells_say(spark):
    from spatialfeat.functions import kernels
    from spatialfeat.operators import segmentation

    rng = np.random.default_rng(6)
    rgb = rng.integers(0, 256, (2, 9, 7, 3))
    patches = spark.createDataFrame([("s", i, rgb[i].reshape(-1).tolist() if i < 2 else None, 9, 7) for i in range(3)], "sample_id string, patch_idx long, px array<int>, h int, w int")
    cells = spark.createDataFrame([("s", 0, 1, "dead", BOX(1.0, 4.0)), ("s", 0, 2, "other", BOX(5.0, 9.0))], "sample_id string, patch_idx long, cell_id_in_patch long, class_name string, geometry array<array<struct<x:double,y:double>>>")
    rows = pictures.pictures(segmentation.overlay_rows(patches, cells), ["sample_id", "patch_idx"], cells="cells").collect()
    got = {(r.patch_idx, r.kind): _unpacked(r.png) for r in rows}
    assert {k for i, k in got if i == 0} == set(pictures.KINDS) and {k for i, k in got if i == 1} == set(pictures.KINDS[:4]) and not any(i == 2 for i, _ in got)
    for i in (0, 1):
        gray = kernels.luma(rgb[i])
        inside = (gray > 30) & (gray < 220)
        assert np.array_equal(got[i, "color"], rgb[i]) and np.array_equal(got[i, "gray"], gray)
        assert np.array_equal(got[i, "masked_gray_threshold"], np.where(inside, gray, 0)) and np.array_equal(got[i, "masked_color_threshold"], np.where(inside[..., None], rgb[i], 0))
    covered = np.zeros((9, 7), bool)
    covered[1:5, 1:5] = covered[5:9, 5:7] = True
    assert np.array_equal(got[0, "masked_color_cellseg"], np.where(covered[..., None], rgb[0], 0))
    edges, want = got[0, "outlines"], rgb[0].copy()
    want[1:5, [1, 4]] = want[[1, 4], 1:5] = (255, 255, 0)
    want[5:9, 5] = want[5, 5:7] = (255, 255, 255)
    assert np.array_equal(edges, want)
    assert pictures.pictures(patches, ["patch_idx"], ("gray",)).count() == 2
    with pytest.raises(ValueError):
        pictures.pictures(patches, ["patch_idx"], ("sepia",))


def test_gene_queries_take_all_events_and_twenty_genes(spark, tmp_path):
    """Thirty genes that every user of a sample has, also the fifth ones."""
    rows = [(8 * k + u, "view" if u < 4 else "buy", 5 * (u % 4), float(k + u + 1), f'{{"k": {100 + k}}}') for k in range(30) for u in range(8)]
    spark.createDataFrame(rows, "event_id long, event_type string, user_id long, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    top = relational.topk_genes_mean(spark, str(tmp_path)).collect()
    assert [r.gene for r in top] == [f"g{k}" for k in range(129, 109, -1)]
    assert top[0].mean == 30 + 3.5
    assert relational.hvg_genes(spark, str(tmp_path)).count() == 20


def test_every_instance_has_a_class(spark):
    """A square, a pixel and a line: only the square has an outline, all three are instances."""
    mask = np.zeros((6, 6), int)
    mask[:3, :3], mask[0, 5], mask[5, 1:5] = 1, 1, 1
    types = np.where(mask > 0, 2, 0)
    types[0, 5] = 3
    one = spark.createDataFrame([(1, mask.reshape(-1).tolist(), types.reshape(-1).tolist(), 6, 6)], "id int, mask array<int>, types array<int>, h int, w int")
    found = segmentation.cells_from_masks(one, ["id"], every=True).orderBy("cell_id_in_patch").collect()
    assert [(r.cell_id_in_patch, r.class_id, r.geometry is None) for r in found] == [(1, 2, False), (2, 3, True), (3, 2, True)]
    assert [r.cell_id_in_patch for r in segmentation.cells_from_masks(one, ["id"]).collect()] == [1]


def test_places_are_those_of_the_mask(spark):
    square = [[{"x": 1.0, "y": 1.0}, {"x": 3.0, "y": 1.0}, {"x": 3.0, "y": 2.0}, {"x": 1.0, "y": 2.0}]]
    rows = [(1, [square], 4, 5), (2, [], 4, 5), (3, None, 4, 5), (4, [square], 2, 3)]
    patches = spark.createDataFrame(rows, "id int, geometries array<array<array<struct<x: double, y: double>>>>, h int, w int")
    places = {r.id: r.places for r in geometry.raster_places(patches, ["id"]).collect()}
    assert places == {1: [6, 7, 8, 11, 12, 13], 2: [], 3: [], 4: [4, 5]}
    masks = {r.id: [i for i, v in enumerate(r["mask"]) if v] for r in geometry.rasterise(patches, ["id"]).collect()}
    assert masks == places


def test_patches_are_measured_in_small_slices():
    """What Python makes of a batch of many patches at once is bounded, whatever the batch."""
    n = 2500
    px = pa.array([[100 + k % 7] * 64 for k in range(n)], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([px, pa.nulls(n, pa.string()), pa.array([8] * n, pa.int32()), pa.array([8] * n, pa.int32()), pa.array(range(n))], ["px", "layout", "h", "w", "k0"])
    names_ = texture.feature_names()
    made = list(texture._featured_patches(iter([batch]), names_, (), 25, texture.kernels.PLANE, 1, 255, False))
    assert [m.num_rows for m in made] == [1024, 1024, 452]
    assert [v for m in made for v in m.column(0).to_pylist()] == list(range(n))
    assert {s for m in made for s in m.column(2).to_pylist()} == {"ok"}
