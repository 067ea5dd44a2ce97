"""Queries over feature tables, cells, names, samples and genes, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..functions.columns import number, r6
from ..operators import cells as cell_ops
from ..operators import describe, expression, genes, normalize, segmentation, selection
from ..operators.geometry import area, bounding_box, crop, perimeter, rectangle
from ..schema import radiomics_key
from ..sources.sinks import parquet_safe
from . import standin as s

QUERIES: dict = {}
SQL: dict[str, str] = {}
KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
NORMALISED = s.FEATURES[:3]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, scale: dict[str, float] | None = None) -> DataFrame:
    """Double columns rounded for comparison."""
    return df.select(*(r6(F.col(c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


R = lambda x: f"round({x} + 1e-9, 6)"
FT = f"""ft AS (SELECT l_suppkey AS sample_id, CASE WHEN l_returnflag <> 'R' THEN 'ok' ELSE 'error' END AS status, {s.ORDER_SQL}, {s.FEATURES_SQL} FROM lineitem)"""


def _scaled_sql(f: str) -> str:
    return f"CASE WHEN status = 'ok' THEN CASE WHEN {f}_lo IS NULL OR {f}_lo = {f}_hi THEN 0.0 ELSE {R(f'(greatest(least({f}, {f}_hi), {f}_lo) - {f}_lo) / ({f}_hi - {f}_lo)')} END END"


def _nulls(f: str) -> str:
    """A scaled value is null for null input unless the feature is constant; greatest and least skip nulls here."""
    return f"CASE WHEN {f} IS NULL AND {f}_lo IS NOT NULL AND {f}_lo <> {f}_hi THEN NULL ELSE {_scaled_sql(f)} END AS {f}"


_BOUNDS = ", ".join(f"quantile_cont({f}, 0.01) FILTER (status = 'ok') AS {f}_lo, quantile_cont({f}, 0.99) FILTER (status = 'ok') AS {f}_hi" for f in NORMALISED)


@query(f"""WITH {FT}, q AS (SELECT sample_id, {_BOUNDS} FROM ft GROUP BY sample_id)
SELECT {', '.join(KEYS)}, status, {', '.join(map(_nulls, NORMALISED))}, dist_tax FROM ft JOIN q USING (sample_id)""")
def normalize_features(spark: SparkSession, d: str) -> DataFrame:
    out = normalize.normalize(s.feature_table(spark, d))
    return rounded(out.select(*KEYS, "status", *NORMALISED, "dist_tax"))


def _stats_sql(f: str) -> str:
    c = f"CASE WHEN status = 'ok' AND {f} IS NOT NULL THEN greatest(least({f}, {f}_hi), {f}_lo) END"
    spread = f"coalesce(min({c}) < max({c}), false)"
    return f"""SELECT sample_id, '{f}' AS feature, 0.01::DOUBLE AS lower_q, 0.99::DOUBLE AS upper_q, {R(f'any_value({f}_lo)')} AS lower_bound, {R(f'any_value({f}_hi)')} AS upper_bound,
 {R(f'avg({c})')} AS mean, {R(f'CASE WHEN min({c}) = max({c}) THEN 0.0 ELSE stddev_pop({c}) END')} AS std, {R(f'min({c})')} AS min_after_clip, {R(f'max({c})')} AS max_after_clip,
 0.0::DOUBLE AS z_mean, CASE WHEN {spread} THEN 1.0 ELSE 0.0 END::DOUBLE AS z_std, 0.0::DOUBLE AS scaled_min, CASE WHEN {spread} THEN 1.0 ELSE 0.0 END::DOUBLE AS scaled_max
 FROM ft JOIN q USING (sample_id) GROUP BY sample_id"""


@query(f"WITH {FT}, q AS (SELECT sample_id, {_BOUNDS} FROM ft GROUP BY sample_id) {' UNION ALL '.join(map(_stats_sql, NORMALISED))}")
def normalize_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(normalize.normalization_stats(s.feature_table(spark, d)))


_CLASS = """CASE WHEN feature_name LIKE 'cellseg_all_original_glcm_%' THEN 'cellseg_glcm' WHEN feature_name LIKE 'morph_%' THEN 'morph'
 WHEN feature_name LIKE 'dist_%' THEN 'dist' ELSE 'others' END"""


def _describe_sql(f: str) -> str:
    q = ", ".join(f"{R(f'quantile_cont({f}, {p})')} AS {n}" for n, p in zip(("q01", "q05", "q10", "q25", "median", "q75", "q90", "q95", "q99"), (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99), strict=True))
    return f"""SELECT sample_id, '{f}' AS feature_name, count({f}) AS "count", count(*) - count({f}) AS nan_count, {R(f'(count(*) - count({f}))::DOUBLE / count(*)')} AS nan_ratio,
 {R(f'avg({f})')} AS mean, {R(f'stddev_samp({f})')} AS std, {R(f'min({f})')} AS min, {q}, {R(f'max({f})')} AS max, {R(f'quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25)')} AS iqr,
 count(*) FILTER ({f} = 0) AS zero_count, count(*) FILTER ({f} > 0) AS positive_count, count(*) FILTER ({f} < 0) AS negative_count FROM ok GROUP BY sample_id"""


@query(f"WITH {FT}, ok AS (SELECT * FROM ft WHERE status = 'ok'), u AS ({' UNION ALL '.join(map(_describe_sql, s.FEATURES))}) SELECT *, {_CLASS} AS feature_class FROM u")
def describe_features(spark: SparkSession, d: str) -> DataFrame:
    out = describe.describe(describe.ok_rows(s.feature_table(spark, d)), list(s.FEATURES), ["sample_id"])
    return rounded(out.orderBy("feature_class", "feature_name"))


def _box_sql(f: str) -> str:
    return f"""SELECT sample_id, '{f}' AS feature_name, {R('any_value(q1)')} AS q1, {R('any_value(q2)')} AS med, {R('any_value(q3)')} AS q3,
 {R(f'least(min({f}) FILTER ({f} >= q1 - 1.5 * (q3 - q1)), any_value(q1))')} AS whislo, {R(f'greatest(max({f}) FILTER ({f} <= q3 + 1.5 * (q3 - q1)), any_value(q3))')} AS whishi
 FROM ok JOIN (SELECT sample_id, quantile_cont({f}, 0.25) AS q1, quantile_cont({f}, 0.5) AS q2, quantile_cont({f}, 0.75) AS q3 FROM ok GROUP BY sample_id) USING (sample_id) GROUP BY sample_id"""


@query(f"WITH {FT}, ok AS (SELECT * FROM ft WHERE status = 'ok') {' UNION ALL '.join(map(_box_sql, s.FEATURES))}")
def box_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(describe.box_stats(describe.ok_rows(s.feature_table(spark, d)), list(s.FEATURES)))


def _representative_sql(f: str) -> str:
    """The row nearest to each target by the difference as it is. Targets lie between two neighbours of the sorted values, weighted by the distance to each."""
    t = " UNION ALL ".join(f"SELECT sample_id, '{n}' AS stat_name, {p}::DOUBLE * (len(v) - 1) AS pos, v FROM sorted" for n, p in describe.TARGETS.items())
    low, high = "v[floor(pos)::INT + 1]", "v[ceil(pos)::INT + 1]"
    target = f"CASE WHEN floor(pos) = ceil(pos) OR {low} = {high} THEN {low} ELSE (ceil(pos) - pos) * {low} + (pos - floor(pos)) * {high} END"
    return f"""SELECT sample_id, '{f}' AS feature_name, stat_name, {R('target_value')} AS target_value, {R(f)} AS selected_value, {R(f'abs({f} - target_value)')} AS abs_diff, {', '.join(KEYS)}
 FROM ok JOIN (SELECT sample_id, stat_name, {target} AS target_value FROM (WITH sorted AS (SELECT sample_id, list_sort(list({f}) FILTER ({f} IS NOT NULL)) AS v FROM ok GROUP BY sample_id) {t})) USING (sample_id)
 WHERE {f} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY sample_id, stat_name ORDER BY abs({f} - target_value), {s.ORDER_SQL}) = 1"""


@query(f"WITH {FT}, ok AS (SELECT * FROM ft WHERE status = 'ok'), u AS ({' UNION ALL '.join(map(_representative_sql, s.FEATURES))}) SELECT *, {_CLASS} AS feature_class FROM u")
def representatives(spark: SparkSession, d: str) -> DataFrame:
    ok = describe.ok_rows(s.feature_table(spark, d))
    return rounded(describe.representatives(ok, list(s.FEATURES), list(s.ORDER), list(KEYS)))


_CELLS = f"""cells AS (SELECT *, l_orderkey AS patch_idx, {s.CLASS_SQL} AS raw_class, {s.CLASS_ID_SQL} AS class_id, CASE WHEN l_orderkey % 7 <> 0 THEN 'BC-' || l_orderkey END AS barcode FROM lineitem),
named AS (SELECT *, replace(lower(trim(coalesce(raw_class, 'unknown'))), ' ', '_') AS class_name FROM cells)"""


def _composition_sql() -> str:
    count = lambda c: f"coalesce(count(*) FILTER (class_name = '{c}'), 0)::DOUBLE"
    total = "count(class_name)::DOUBLE"
    out = ", ".join(f"{count(c)} AS dist_count_{c}, {R(f'CASE WHEN {total} > 0 THEN {count(c)} / {total} ELSE 0.0 END')} AS dist_ratio_{c}" for c in cell_ops.KNOWN_CELL_CLASSES)
    return f"WITH {_CELLS} SELECT o_orderkey AS patch_idx, {total} AS dist_cell_count_total, {out} FROM orders LEFT JOIN named ON patch_idx = o_orderkey GROUP BY o_orderkey"


@query(_composition_sql())
def cell_composition(spark: SparkSession, d: str) -> DataFrame:
    patches = s.load(spark, d, "orders").select(F.col("o_orderkey").alias("patch_idx"))
    return rounded(cell_ops.composition(patches, s.cells(spark, d)))


@query(f"""WITH {_CELLS}, summary AS (SELECT patch_idx, barcode, count(*) AS n_cells, [min(l_quantity), max(l_quantity)] AS coord_raw FROM cells WHERE patch_idx % 5 <> 0 GROUP BY ALL)
SELECT c.patch_idx, c.barcode, {', '.join(f'c.{k}' for k in KEYS[1:])}, coalesce(n_cells, 0) AS n_cells, '[' || coord_raw[1] || ',' || coord_raw[2] || ']' AS coord_raw_json
FROM cells c LEFT JOIN summary u ON c.patch_idx = u.patch_idx AND c.barcode IS NOT DISTINCT FROM u.barcode""")
def cell_summary_merge(spark: SparkSession, d: str) -> DataFrame:
    cells = s.cells(spark, d)
    summary = cells.where("patch_idx % 5 <> 0").groupBy("patch_idx", "barcode").agg(F.count("*").alias("n_cells"), F.array(F.min("l_quantity"), F.max("l_quantity")).alias("coord_raw"))
    return cell_ops.with_summary(cells, summary).select("patch_idx", "barcode", *KEYS[1:], "n_cells", "coord_raw_json")


_TWO = "two AS (SELECT *, l_suppkey % 2 AS sample_id, l_orderkey // 3 AS idx, CASE WHEN l_orderkey % 7 <> 0 THEN 'BC-' || (l_orderkey // 3) END AS code FROM lineitem)"


@query(f"""WITH {_TWO}, numbered AS (SELECT *, row_number() OVER (PARTITION BY sample_id, idx, code ORDER BY {s.ORDER_SQL}) AS cell_id_in_patch FROM two),
n AS (SELECT sample_id, idx, count(*) AS n FROM two GROUP BY ALL), patch AS (SELECT sample_id, idx, code FROM two GROUP BY ALL)
SELECT c.sample_id, c.idx AS patch_idx, c.code AS barcode, cell_id_in_patch, {', '.join(f'c.{k}' for k in KEYS)}, n AS n_cells, '[' || c.sample_id || '.0,' || c.idx || '.0]' AS coord_raw_json
FROM numbered c JOIN patch p ON c.sample_id = p.sample_id AND c.idx = p.idx AND c.code IS NOT DISTINCT FROM p.code JOIN n ON n.sample_id = c.sample_id AND n.idx = c.idx""")
def cell_summary_two_samples(spark: SparkSession, d: str) -> DataFrame:
    """Cells of two samples that share patch numbers and barcodes."""
    number = F.floor(F.col("l_orderkey") / 3)
    code = F.when(F.col("l_orderkey") % 7 != 0, F.concat(F.lit("BC-"), number.cast("string")))
    found = s.load(spark, d, "lineitem").withColumns({"sample_id": F.col("l_suppkey") % 2, "patch_idx": number, "barcode": code, "geometry": F.struct(*s.ORDER)})
    rows = segmentation.cell_rows(found, list(s.ORDER))
    patches = rows.select("sample_id", "patch_idx", "barcode").distinct().withColumns({"x": F.col("sample_id").cast("double"), "y": F.col("patch_idx").cast("double")})
    out = cell_ops.with_summary(rows, segmentation.patch_summary(patches, rows))
    return out.select("sample_id", "patch_idx", "barcode", "cell_id_in_patch", *(F.col("geometry").getField(k).alias(k) for k in KEYS), "n_cells", "coord_raw_json")


@query(f"""WITH {_CELLS} SELECT o_orderkey AS patch_idx, count(c.patch_idx) AS n_cells, coalesce(string_agg(c.class_name || ':' || c.l_linenumber, ',' ORDER BY c.l_linenumber, c.class_name), '') AS classes
FROM orders LEFT JOIN named c ON c.patch_idx = o_orderkey GROUP BY o_orderkey""")
def overlay_rows(spark: SparkSession, d: str) -> DataFrame:
    """The cells that an overlay of each patch draws."""
    found = s.cells(spark, d).select("patch_idx", F.col("l_linenumber").alias("cell_id_in_patch"), names.class_name(F.col("class_name")).alias("class_name"), F.lit(None).cast("string").alias("geometry"))
    rows = segmentation.overlay_rows(s.load(spark, d, "orders").select(F.col("o_orderkey").alias("patch_idx")), found)
    drawn = F.transform("cells", lambda c: F.concat(c["class_name"], F.lit(":"), c["cell_id_in_patch"].cast("string")))
    return rows.select("patch_idx", F.size("cells").cast("long").alias("n_cells"), F.array_join(drawn, ",").alias("classes"))


@query(f"""WITH {_CELLS} SELECT patch_idx, coalesce(barcode, 'BC-none') AS barcode, row_number() OVER (PARTITION BY patch_idx ORDER BY {s.ORDER_SQL}) AS cell_id_in_patch,
 CASE WHEN l_linenumber = 2 THEN -1 ELSE class_id END::BIGINT AS class_id, coalesce(raw_class, 'unknown') AS class_name FROM cells""")
def segmented_cell_rows(spark: SparkSession, d: str) -> DataFrame:
    found = s.cells(spark, d).withColumns({"class_id": F.when(F.col("l_linenumber") != 2, F.col("class_id")), "barcode": F.coalesce("barcode", F.lit("BC-none")), "geometry": F.lit(None)})
    return segmentation.cell_rows(found, list(s.ORDER)).drop("geometry")


@query("""SELECT o_custkey AS sample_id, count(*) AS num_patches, coalesce(any_value(n), 0) AS num_polygons FROM orders
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1) USING (o_custkey) GROUP BY o_custkey""")
def segmentation_summary(spark: SparkSession, d: str) -> DataFrame:
    patches = s.load(spark, d, "orders").select(F.col("o_custkey").alias("sample_id"), F.col("o_orderkey").alias("patch_idx"))
    cells = s.load(spark, d, "lineitem").select(F.col("l_orderkey").alias("patch_idx")).join(patches, "patch_idx")
    return segmentation.sample_summary(patches, cells)


@query(f"WITH {_CELLS} SELECT patch_idx, barcode, count(*) AS n_cells FROM cells GROUP BY ALL")
def patch_cell_counts(spark: SparkSession, d: str) -> DataFrame:
    return cell_ops.patch_counts(s.cells(spark, d))


@query(f"SELECT {', '.join(KEYS)}, row_number() OVER (PARTITION BY l_orderkey ORDER BY {s.ORDER_SQL}) AS cell_id_in_patch FROM lineitem")
def running_cell_id(spark: SparkSession, d: str) -> DataFrame:
    return cell_ops.numbered(s.cells(spark, d), list(s.ORDER)).select(*KEYS, "cell_id_in_patch")


@query(f"""WITH {_CELLS}, n AS (SELECT patch_idx, class_id, count(*) FILTER (class_id > 0) AS n FROM cells GROUP BY ALL),
best AS (SELECT patch_idx, CASE WHEN n > 0 THEN class_id ELSE -1 END AS class_id FROM n QUALIFY row_number() OVER (PARTITION BY patch_idx ORDER BY n DESC, class_id) = 1)
SELECT patch_idx, class_id::BIGINT AS class_id, CASE class_id WHEN 1 THEN 'neoplastic' WHEN 2 THEN 'inflammatory' WHEN 3 THEN 'connective' WHEN 4 THEN 'dead' WHEN 5 THEN 'epithelial' ELSE 'class_' || class_id END AS class_name FROM best""")
def majority_class(spark: SparkSession, d: str) -> DataFrame:
    return cell_ops.majority_class(s.cells(spark, d), ["patch_idx"])


@query(f"WITH {_CELLS} SELECT class_id, class_name, count(*) AS n FROM named GROUP BY ALL UNION ALL SELECT -1, replace(lower(trim('  ' || o_orderpriority || chr(9), ' ' || chr(9))), ' ', '_'), count(*) FROM orders GROUP BY ALL")
def class_name_normalize(spark: SparkSession, d: str) -> DataFrame:
    cells = s.cells(spark, d).select(F.col("class_id").cast("int").alias("class_id"), names.class_name(F.col("class_name")).alias("class_name"))
    orders = s.load(spark, d, "orders").select(F.lit(-1).alias("class_id"), names.class_name(F.concat(F.lit("  "), "o_orderpriority", F.lit("\t"))).alias("class_name"))
    return cells.unionByName(orders).groupBy("class_id", "class_name").agg(F.count("*").alias("n"))


def _squeeze_sql(text: str, pattern: str) -> str:
    return f"left(regexp_replace(regexp_replace(regexp_replace({text}, '{pattern}', '_', 'g'), '_+', '_', 'g'), '^_|_$', '', 'g'), 180)"


_PATH = r'[\\/:*?"<>|\s]+'


@query(f"SELECT page_id, {_squeeze_sql('url', r'[^a-zA-Z0-9_.-]+')} AS name FROM pages")
def sanitize_name_stats(spark: SparkSession, d: str) -> DataFrame:
    return s.load(spark, d, "pages").select("page_id", names.file_name(F.col("url")).alias("name"))


@query(f"SELECT page_id, {_squeeze_sql('''coalesce(url, '')''', _PATH)} AS name FROM pages")
def sanitize_name_utils(spark: SparkSession, d: str) -> DataFrame:
    return s.load(spark, d, "pages").select("page_id", names.path_name(F.col("url")).alias("name"))


@query(f"SELECT page_id, 'patch_' || lpad(page_id::VARCHAR, 6, '0') || CASE WHEN page_id % 3 = 0 THEN '' ELSE '_' || {_squeeze_sql('url', _PATH)} END AS name FROM pages")
def patch_base_name(spark: SparkSession, d: str) -> DataFrame:
    barcode = F.when(F.col("page_id") % 3 != 0, F.col("url"))
    return s.load(spark, d, "pages").select("page_id", names.base_name(F.col("page_id"), barcode).alias("name"))


@query("""SELECT f.feature, CASE WHEN feature IN ('n_cells_total') OR feature LIKE 'cellseg_mask_area%' THEN 'cell_count' WHEN feature LIKE 'cellseg_all_original_firstorder_%' THEN 'cellseg_firstorder'
 WHEN feature LIKE 'morph_%' THEN 'morph' WHEN feature LIKE 'dist_%' THEN 'dist' ELSE 'others' END AS feature_class, count(*) AS n
 FROM (SELECT CASE l_linenumber WHEN 1 THEN 'n_cells_total' WHEN 2 THEN 'cellseg_mask_area' WHEN 3 THEN 'cellseg_all_original_firstorder_Mean' WHEN 4 THEN 'morph_mean' WHEN 5 THEN 'dist_count_dead' ELSE 'patch_original_glcm_Id' END AS feature FROM lineitem) f GROUP BY ALL""")
def feature_class(spark: SparkSession, d: str) -> DataFrame:
    name = F.expr("CASE l_linenumber WHEN 1 THEN 'n_cells_total' WHEN 2 THEN 'cellseg_mask_area' WHEN 3 THEN 'cellseg_all_original_firstorder_Mean' WHEN 4 THEN 'morph_mean' WHEN 5 THEN 'dist_count_dead' ELSE 'patch_original_glcm_Id' END")
    df = s.load(spark, d, "lineitem").select(name.alias("feature"))
    return df.groupBy("feature", names.feature_class(F.col("feature")).alias("feature_class")).agg(F.count("*").alias("n"))


_RESULT = "CASE l_linenumber WHEN 1 THEN 'original_' WHEN 2 THEN 'diagnostics_' WHEN 3 THEN 'Wavelet-HH_' WHEN 4 THEN 'log-sigma-2-mm_' WHEN 5 THEN 'original_shape2D_' WHEN 6 THEN 'other' ELSE 'squareroot_' END || l_returnflag"


@query(f"""WITH r AS (SELECT {', '.join(KEYS)}, {_RESULT} AS name, CASE WHEN l_linenumber = 1 THEN 'x' ELSE l_quantity::VARCHAR END AS result FROM lineitem)
SELECT {', '.join(KEYS)}, replace(lower(name), 'original_shape2d_', '') AS name, TRY_CAST(result AS DOUBLE) AS value FROM r WHERE regexp_matches(lower(name), '^(original_|wavelet-|log-sigma-|square_|squareroot_|logarithm_|exponential_)')""")
def radiomics_keys(spark: SparkSession, d: str) -> DataFrame:
    """Raw results that are features, as numbers, without the prefix of shapes."""
    rows = s.load(spark, d, "lineitem").select(*KEYS, F.expr(_RESULT).alias("name"), F.expr("CASE WHEN l_linenumber = 1 THEN 'x' ELSE CAST(l_quantity AS STRING) END").alias("result"))
    return rows.where(radiomics_key(F.col("name"))).select(*KEYS, names.without_shape2d(F.col("name")).alias("name"), number(F.col("result")).alias("value"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority WHEN o_orderkey % 3 = 1 THEN 'é' || o_orderkey ELSE '' END AS barcode, '[' || o_orderkey || ',' || o_custkey || ']' AS pair FROM orders""")
def barcode_decode(spark: SparkSession, d: str) -> DataFrame:
    """Barcodes from bytes and from the first of an array, null as nothing; arrays as JSON text."""
    orders = s.load(spark, d, "orders")
    one = orders.withColumns({
        "bytes": F.when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("é"), F.col("o_orderkey").cast("string")).cast("binary")),
        "several": F.when(F.col("o_orderkey") % 3 == 0, F.array("o_orderpriority", F.lit("other"))), "pair": F.array("o_orderkey", "o_custkey"),
    })
    text = F.coalesce(names.decoded(F.col("several"), array=True), names.decoded(F.col("bytes"), ""))
    return parquet_safe(one.select("o_orderkey", text.alias("barcode"), "pair"))


def _catalogue(spark: SparkSession, d: str) -> DataFrame:
    nation = s.load(spark, d, "nation")
    return s.load(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").cast("string").alias("id"), F.when(F.col("c_custkey") % 3 == 0, "Mus musculus").otherwise("Homo sapiens").alias("species"), F.col("n_name").alias("oncotree_code"), F.col("c_mktsegment").alias("st_technology"),
    )


@query("""SELECT c_custkey::VARCHAR AS id, 'Homo sapiens' AS species, n_name AS oncotree_code, c_mktsegment AS st_technology FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE c_custkey % 3 <> 0 AND n_nationkey IN (1, 2, 3) AND c_mktsegment IN (SELECT min(c_mktsegment) FROM customer UNION ALL SELECT max(c_mktsegment) FROM customer)""")
def metadata_filter(spark: SparkSession, d: str) -> DataFrame:
    codes = s.load(spark, d, "nation").where("n_nationkey IN (1, 2, 3)").select("n_name")
    ends = s.load(spark, d, "customer").agg(F.array(F.min("c_mktsegment"), F.max("c_mktsegment")).alias("ends")).select(F.explode("ends").alias("end"))
    return selection.wanted_datasets(_catalogue(spark, d), codes, ends)


@query("SELECT place::INT AS place, s_name AS sample_id, folder || '/*' || s_name || '[_.]**' AS pattern FROM supplier, (VALUES (0, 'patches'), (1, 'st'), (2, 'metadata')) v(place, folder)")
def allow_patterns(spark: SparkSession, d: str) -> DataFrame:
    samples = s.load(spark, d, "supplier").select(F.col("s_name").alias("sample_id"))
    return selection.allow_patterns(samples, ["patches", "st", "patches"], ["metadata", "st"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def sample_semi(spark: SparkSession, d: str) -> DataFrame:
    wanted = s.load(spark, d, "customer").where("c_acctbal > 5000").select(F.col("c_custkey").alias("o_custkey"))
    return selection.of_samples(s.load(spark, d, "orders").select("o_orderkey", "o_custkey"), wanted, "o_custkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def skip_existing_anti(spark: SparkSession, d: str) -> DataFrame:
    done = s.load(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return selection.not_done(s.load(spark, d, "orders").select("o_orderkey", "o_orderstatus"), done, "o_orderkey")


@query("SELECT doc_id AS barcode, quality, label FROM labels JOIN embeddings ON vec_id = doc_id")
def barcode_join(spark: SparkSession, d: str) -> DataFrame:
    left = s.load(spark, d, "labels").select(F.col("doc_id").alias("barcode"), "quality")
    return selection.by_barcode(left, s.load(spark, d, "embeddings").select(F.col("vec_id").alias("barcode"), "label"))


@query("SELECT o_orderkey AS patch_idx, o_totalprice AS a, NULL::VARCHAR AS b FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderkey % 2 = 1")
def union_chunks(spark: SparkSession, d: str) -> DataFrame:
    orders = s.load(spark, d, "orders")
    even = orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("patch_idx"), F.col("o_totalprice").alias("a"))
    odd = orders.where("o_orderkey % 2 = 1").select(F.col("o_orderkey").alias("patch_idx"), F.col("o_orderpriority").alias("b"))
    return selection.chunks_joined(even, odd).orderBy(F.coalesce("patch_idx", F.lit(-1)))


@query(f"SELECT l_orderkey AS patch_idx, l_linenumber, l_partkey, l_suppkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {s.ORDER_SQL}) = 1")
def dedup_first(spark: SparkSession, d: str) -> DataFrame:
    cells = s.cells(spark, d).select("patch_idx", *s.ORDER)
    return selection.first_rows(cells, ["patch_idx"], list(s.ORDER)).select("patch_idx", *KEYS[1:])


@query("""WITH n AS (SELECT label, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
k AS (SELECT *, greatest(1, ceil(n * 0.23))::BIGINT AS k FROM n),
p AS (SELECT DISTINCT label, n, k, unnest(range(0, k)) AS i FROM k),
w AS (SELECT label, CASE WHEN k >= n THEN i WHEN i = k - 1 AND k > 1 THEN n - 1 ELSE floor(i * ((n - 1)::DOUBLE / nullif(k - 1, 0)))::BIGINT END AS pos FROM p)
SELECT vec_id, label FROM k SEMI JOIN w ON k.label = w.label AND k.pos = coalesce(w.pos, 0)""")
def even_sampling(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    own = Window.partitionBy("label")
    e = s.load(spark, d, "embeddings").select("vec_id", "label", (F.row_number().over(own.orderBy("vec_id")) - 1).alias("pos"), F.count("*").over(own).alias("n"))
    return e.where(selection.evenly_spaced(F.col("pos"), F.col("n"), 0.23)).select("vec_id", "label")


@query("""WITH e AS (SELECT DISTINCT l_suppkey % 7 AS sample_id, l_orderkey AS patch_idx FROM lineitem WHERE l_linenumber > 3), p AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY patch_idx) - 1 AS pos, count(*) OVER (PARTITION BY sample_id) AS n FROM e),
k AS (SELECT DISTINCT sample_id, n, greatest(1, ceil(n * 0.02))::BIGINT AS k FROM p), i AS (SELECT *, unnest(range(0, k)) AS i FROM k),
w AS (SELECT sample_id, CASE WHEN k >= n THEN i WHEN i = k - 1 AND k > 1 THEN n - 1 ELSE floor(i * ((n - 1)::DOUBLE / nullif(k - 1, 0)))::BIGINT END AS pos FROM i)
SELECT sample_id, patch_idx, 'spaced' AS how FROM p SEMI JOIN w ON p.sample_id = w.sample_id AND p.pos = coalesce(w.pos, 0) UNION ALL SELECT sample_id, patch_idx, 'listed' FROM e WHERE patch_idx IN (1, 7, 32, 99)""")
def chosen_patches(spark: SparkSession, d: str) -> DataFrame:
    """Patches with cells that are looked at, spaced and listed."""
    cells = s.load(spark, d, "lineitem").where("l_linenumber > 3").select((F.col("l_suppkey") % 7).alias("sample_id"), F.col("l_orderkey").alias("patch_idx"))
    spaced, listed = selection.chosen(cells, 0.02), selection.chosen(cells, listed=[1, 7, 32, 99])
    return spaced.withColumn("how", F.lit("spaced")).unionByName(listed.withColumn("how", F.lit("listed")))


def _morph_sql(f: str) -> str:
    m = f"avg({f})"
    v = {"mean": m, "median": f"quantile_cont({f}, 0.5)", "minimum": f"min({f})", "maximum": f"max({f})", "range": f"max({f}) - min({f})", "variance": f"var_pop({f})", "standarddeviation": f"stddev_pop({f})"}
    v |= {n: f"quantile_cont({f}, {q})" for n, q in (("p10", 0.1), ("p25", 0.25), ("p75", 0.75), ("p90", 0.9))} | {"iqr": f"quantile_cont({f}, 0.75) - quantile_cont({f}, 0.25)"}
    z = f"(({f} - {f}_m) / nullif({f}_s, 0))"
    flat = f"min({f}) = max({f})"
    v |= {"meanabsolutedeviation": f"avg(abs({f} - {f}_m))", "skewness": f"CASE WHEN {flat} THEN 0.0 ELSE avg(pow({z}, 3)) END", "kurtosis": f"CASE WHEN {flat} THEN 0.0 ELSE avg(pow({z}, 4)) - 3 END"}
    v |= {"entropy": f"any_value({f}_h)", "energy": f"sum({f} * {f})", "rootmeansquared": f"sqrt(avg({f} * {f}))"}
    return ", ".join(f"{R(v[n])} AS morph_{f}_{n}" for n in cell_ops.MORPH_STATS)


def _entropy_sql(f: str) -> str:
    """CTE h_f (patch_idx, f_h, f_m, f_s)."""
    return f"""b_{f} AS (SELECT l_orderkey AS patch_idx, {f}, min({f}) OVER w AS lo, max({f}) OVER w AS hi, count({f}) OVER w AS n, least(16, greatest(2, count({f}) OVER w)) AS bins FROM cm WHERE {f} IS NOT NULL WINDOW w AS (PARTITION BY l_orderkey)),
c_{f} AS (SELECT patch_idx, any_value(n) AS n, count(*) AS k, any_value(lo) AS lo, any_value(hi) AS hi FROM b_{f} GROUP BY patch_idx, CASE WHEN hi > lo THEN least(floor(({f} - lo) / ((hi - lo) / bins))::BIGINT, bins - 1) ELSE 0 END),
h_{f} AS (SELECT patch_idx, CASE WHEN any_value(n) <= 1 OR any_value(lo) = any_value(hi) THEN 0.0 ELSE -sum(k::DOUBLE / n * log2(k::DOUBLE / n)) END AS {f}_h FROM c_{f} GROUP BY patch_idx),
m_{f} AS (SELECT l_orderkey AS patch_idx, avg({f}) AS {f}_m, stddev_pop({f}) AS {f}_s FROM cm GROUP BY 1)"""


_CM = "cm AS (SELECT l_orderkey, l_quantity AS quantity, CASE WHEN l_linestatus = 'F' THEN l_discount END AS discount FROM lineitem)"


def _measured_cells(spark: SparkSession, d: str) -> DataFrame:
    return s.load(spark, d, "lineitem").selectExpr("l_orderkey AS patch_idx", "l_quantity AS quantity", "CASE WHEN l_linestatus = 'F' THEN l_discount END AS discount")


@query(f"""WITH {_CM}, {_entropy_sql('quantity')}, {_entropy_sql('discount')}
SELECT l_orderkey AS patch_idx, {_morph_sql('quantity')}, {_morph_sql('discount')} FROM cm LEFT JOIN h_quantity q ON q.patch_idx = l_orderkey LEFT JOIN h_discount d ON d.patch_idx = l_orderkey
LEFT JOIN m_quantity mq ON mq.patch_idx = l_orderkey LEFT JOIN m_discount md ON md.patch_idx = l_orderkey GROUP BY l_orderkey""")
def morph_aggregates(spark: SparkSession, d: str) -> DataFrame:
    return rounded(cell_ops.measurement_stats(_measured_cells(spark, d), ["quantity", "discount"]))


@query(f"WITH {_CM}, {_entropy_sql('quantity')} SELECT patch_idx, {R('quantity_h')} AS entropy FROM h_quantity")
def hist_entropy(spark: SparkSession, d: str) -> DataFrame:
    made = cell_ops.measurement_stats(_measured_cells(spark, d).where("quantity IS NOT NULL"), ["quantity"])
    return rounded(made.select("patch_idx", F.col("morph_quantity_entropy").alias("entropy")))


_BOX = "l_linenumber::DOUBLE - 3 AS x0, floor(l_quantity / 10) - 2 AS y0, l_linenumber::DOUBLE - 3 + l_quantity AS x1, floor(l_quantity / 10) - 2 + floor(l_discount * 100) + 1 AS y1"


def _boxes(spark: SparkSession, d: str) -> DataFrame:
    x0, y0 = F.col("l_linenumber").cast("double") - 3, F.floor(F.col("l_quantity") / 10) - 2
    corners = (x0, y0, x0 + F.col("l_quantity"), y0 + F.floor(F.col("l_discount") * 100) + 1)
    return s.load(spark, d, "lineitem").select(*KEYS, rectangle(*corners).alias("geometry"))


@query(f"""WITH b AS (SELECT {', '.join(KEYS)}, {_BOX} FROM lineitem) SELECT {', '.join(KEYS)}, {R('(x1 - x0) * (y1 - y0)')} AS area, {R('2 * (x1 - x0 + y1 - y0)')} AS perimeter,
 (floor(x0) - 1)::BIGINT AS min_x, (floor(y0) - 1)::BIGINT AS min_y, (ceil(x1) + 1)::BIGINT AS max_x, (ceil(y1) + 1)::BIGINT AS max_y FROM b""")
def polygon_measures(spark: SparkSession, d: str) -> DataFrame:
    g = F.col("geometry")
    return rounded(_boxes(spark, d).select(*KEYS, area(g).alias("area"), perimeter(g).alias("perimeter"), bounding_box(g).alias("box")).select(*KEYS, "area", "perimeter", "box.*"))


@query(f"""WITH b AS (SELECT {', '.join(KEYS)}, {_BOX} FROM lineitem), f AS (SELECT {', '.join(KEYS)}, (floor(x0) - 1)::BIGINT AS bx0, (floor(y0) - 1)::BIGINT AS by0, (ceil(x1) + 1)::BIGINT AS bx1, (ceil(y1) + 1)::BIGINT AS by1 FROM b)
SELECT {', '.join(KEYS)}, greatest(bx0, 0) AS x0, greatest(by0, 0) AS y0, least(bx1, 31) AS x1, least(by1, 7) AS y1, greatest(least(bx1, 31) - greatest(bx0, 0) + 1, 0) AS width, greatest(least(by1, 7) - greatest(by0, 0) + 1, 0) AS height,
 greatest(bx0, 0) - bx0 AS cut_left, greatest(by0, 0) - by0 AS cut_top, bx1 - least(bx1, 31) AS cut_right, by1 - least(by1, 7) AS cut_bottom FROM f""")
def bbox_crop(spark: SparkSession, d: str) -> DataFrame:
    cut = crop(bounding_box(F.col("geometry")), F.lit(8).cast("long"), F.lit(32).cast("long"))
    return _boxes(spark, d).select(*KEYS, cut.alias("cut")).select(*KEYS, "cut.*")


_GENES = f"""{s.EXPRESSION_SQL},
det AS (SELECT sample_id, gene, count(*) FILTER (value > 0) AS n_detected FROM expr JOIN obs USING (sample_id) GROUP BY sample_id, gene, n_obs HAVING count(*) FILTER (value > 0) >= ceil(0.1 * n_obs)),
common AS (SELECT gene FROM det WHERE NOT contains(gene, 'BLANK') AND NOT contains(gene, 'Control') GROUP BY gene HAVING count(*) = (SELECT count(*) FROM obs)),
tot AS (SELECT sum(n_obs) AS n FROM obs), mom AS (SELECT gene, coalesce(sum(value), 0) AS s1, coalesce(sum(value * value), 0) AS s2, (SELECT n FROM tot) AS n FROM expr JOIN common USING (gene) GROUP BY gene)"""

_EVERY_GENES = _GENES.replace(s.EXPRESSION_SQL, s.EVERY_EXPRESSION_SQL)


def _totals(spark: SparkSession, d: str, every: bool = False) -> genes.Totals:
    return expression.totals(*s.matrix(spark, d, every))


@query(f"WITH {_GENES} SELECT * FROM det")
def gene_detection_filter(spark: SparkSession, d: str) -> DataFrame:
    return genes.detected(_totals(spark, d))


@query(f"WITH {_GENES} SELECT * FROM common")
def common_genes(spark: SparkSession, d: str) -> DataFrame:
    return genes.common_genes(_totals(spark, d)).select("gene")


@query(f"WITH {_EVERY_GENES} SELECT gene, {R('s1 / n')} AS mean FROM mom ORDER BY s1 / n DESC, gene LIMIT 20")
def topk_genes_mean(spark: SparkSession, d: str) -> DataFrame:
    of = _totals(spark, d, every=True)
    return rounded(genes.top_by_mean(genes.moments(of, genes.common_genes(of)), 20))


@query(f"""WITH {_EVERY_GENES}, a AS (SELECT gene, CASE WHEN s1 = 0 THEN 1e-12 ELSE s1 / n END AS mu, (s2 - n * (s1 / n) * (s1 / n)) / (n - 1) AS var FROM mom),
b AS (SELECT gene, CASE WHEN var / mu > 0 THEN ln(var / mu) END AS disp, ln(1 + mu) AS m FROM a), c AS (SELECT *, min(m) OVER () AS lo, max(m) OVER () AS hi FROM b),
e AS (SELECT *, CASE WHEN hi = lo THEN 1 ELSE greatest(1, ceil((m - lo) / ((hi - lo) / 20))) END AS bin FROM c),
f AS (SELECT gene, coalesce(CASE WHEN disp IS NOT NULL AND count(disp) OVER w = 1 THEN 1.0 ELSE (disp - avg(disp) OVER w) / nullif(stddev_samp(disp) OVER w, 0) END, 0) AS norm FROM e WINDOW w AS (PARTITION BY bin)),
r AS (SELECT *, row_number() OVER (ORDER BY norm DESC) AS place FROM f)
SELECT gene, {R('norm')} AS norm FROM r WHERE norm >= (SELECT min(norm) FROM r WHERE place <= 20) ORDER BY gene LIMIT 20""")
def hvg_genes(spark: SparkSession, d: str) -> DataFrame:
    of = _totals(spark, d, every=True)
    return rounded(genes.highly_variable(genes.moments(of, genes.common_genes(of)), 20))


@query(f"""WITH {_GENES}, top AS (SELECT gene, row_number() OVER (ORDER BY s1 / n DESC, gene) AS rn FROM mom)
SELECT 'mean' AS criterion, k::INT AS k, gene FROM top, (VALUES (5), (20)) v(k) WHERE rn <= k""")
def gene_sets(spark: SparkSession, d: str) -> DataFrame:
    """Gene lists of several sizes from one table of moments."""
    of = _totals(spark, d)
    sets = genes.gene_sets(genes.moments(of, genes.common_genes(of)), ("mean",), (5, 20))
    parts = [chosen.select(F.lit(c).alias("criterion"), F.lit(k).alias("k"), "gene") for (c, k), chosen in sets.items()]
    return selection.chunks_joined(*parts)


_NAME = "CASE event_id % 11 WHEN 0 THEN user_id || '-1' WHEN 1 THEN user_id || '-2' WHEN 2 THEN user_id || '-2' ELSE user_id::VARCHAR END"


@query(f"""WITH RECURSIVE m AS (SELECT event_type AS sample_id, event_id AS obs_row, {_NAME} AS obs_id, value FROM events),
d AS (SELECT sample_id, obs_row, obs_id, row_number() OVER (PARTITION BY sample_id, obs_id ORDER BY obs_row) - 1 AS copy FROM m),
t AS (SELECT sample_id, obs_id, obs_row, copy, 0::BIGINT AS n, 0::BIGINT AS free FROM d WHERE copy > 0
 UNION ALL SELECT t.sample_id, t.obs_id, t.obs_row, t.copy, t.n + 1, t.free + CASE WHEN k.obs_id IS NULL THEN 1 ELSE 0 END
  FROM t LEFT JOIN (SELECT DISTINCT sample_id, obs_id FROM m) k ON k.sample_id = t.sample_id AND k.obs_id = t.obs_id || '-' || (t.n + 1) WHERE t.free < t.copy)
SELECT m.sample_id, m.obs_row, coalesce(t.obs_id || '-' || t.n, m.obs_id) AS obs_id, m.value FROM m LEFT JOIN t ON t.sample_id = m.sample_id AND t.obs_row = m.obs_row AND t.free = t.copy""")
def unique_observations(spark: SparkSession, d: str) -> DataFrame:
    """Observations under one name, told apart; some have a name already that another would get."""
    name = _NAME.replace("user_id::VARCHAR", "cast(user_id AS string)")
    rows = s.load(spark, d, "events").select(F.col("event_type").alias("sample_id"), F.col("event_id").alias("obs_row"), F.expr(name).alias("obs_id"), "value")
    return expression.unique_observations(rows)
