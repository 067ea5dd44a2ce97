"""Stand-in tables: orders are patches, their lines are cells, suppliers are samples, embeddings are 8 x 8 images."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.expression import from_long

#: Columns that give lines a total order up to rows that are equal throughout.
ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
ORDER_SQL = ", ".join(ORDER)

#: (return flag, line status) of each class; returned open lines are unknown.
CLASS_SQL = """CASE l_returnflag || l_linestatus WHEN 'AF' THEN ' Neoplastic' WHEN 'AO' THEN 'inflammatory ' WHEN 'NF' THEN 'Connective'
    WHEN 'NO' THEN 'dead' WHEN 'RF' THEN 'epithelial' END"""
CLASS_ID_SQL = "CASE l_returnflag || l_linestatus WHEN 'AF' THEN 1 WHEN 'AO' THEN 2 WHEN 'NF' THEN 3 WHEN 'NO' THEN 4 WHEN 'RF' THEN 5 ELSE 0 END"
#: A feature table with missing values.
FEATURES_SQL = """l_quantity AS morph_quantity, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS patch_original_price,
    CASE WHEN l_linestatus = 'F' THEN l_discount END AS cellseg_all_original_glcm_discount, l_tax AS dist_tax"""
FEATURES = ("morph_quantity", "patch_original_price", "cellseg_all_original_glcm_discount", "dist_tax")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as cells with class, class id and barcode of their patch."""
    return cells_of(load(spark, sf_dir, "lineitem"))


def cells_of(lines: DataFrame) -> DataFrame:
    barcode = "CASE WHEN l_orderkey % 7 <> 0 THEN concat('BC-', l_orderkey) END"
    return lines.selectExpr("*", "l_orderkey AS patch_idx", f"{CLASS_SQL} AS class_name", f"CAST({CLASS_ID_SQL} AS BIGINT) AS class_id", f"{barcode} AS barcode")


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as rows of features, one sample per supplier; returned lines are not ok."""
    status = "CASE WHEN l_returnflag <> 'R' THEN 'ok' ELSE 'error' END AS status"
    return load(spark, sf_dir, "lineitem").selectExpr("l_suppkey AS sample_id", status, *(f"{c}" for c in ORDER), *FEATURES_SQL_PARTS)


FEATURES_SQL_PARTS = (
    "l_quantity AS morph_quantity", "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_extendedprice END AS patch_original_price",
    "CASE WHEN l_linestatus = 'F' THEN l_discount END AS cellseg_all_original_glcm_discount", "l_tax AS dist_tax",
)


def images(spark: SparkSession, sf_dir: str, scale: int = 256) -> DataFrame:
    """Embeddings as gray images of 64 pixels."""
    gray = F.transform("embedding", lambda e: F.floor(F.greatest(F.least(F.lit(128.0) + F.lit(float(scale)) * e.cast("double"), F.lit(255.0)), F.lit(0.0))).cast("int"))
    return load(spark, sf_dir, "embeddings").select("vec_id", F.col("label").cast("string").alias("sample_id"), gray.alias("px"), F.lit(8).alias("h"), F.lit(8).alias("w"))


def colour_images(spark: SparkSession, sf_dir: str, scale: int = 256) -> DataFrame:
    """The images as red, green and blue that are shifted against each other."""
    at = lambda i: F.get("px", i % 64)
    rgb = F.flatten(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.array(at(k), at(k + 21), at(k + 42))))
    return images(spark, sf_dir, scale).withColumn("px", rgb)


def images_sql(scale: int = 256) -> str:
    """CTEs img (vec_id, px) and pix (vec_id, y, x, g, b): pixels in the region with their bins."""
    return f"""img AS (SELECT vec_id, label, list_transform(embedding, lambda e: floor(greatest(least(128.0 + {float(scale)} * e::DOUBLE, 255.0), 0.0))::BIGINT) AS px FROM embeddings),
raw AS (SELECT vec_id, k // 8 AS y, k % 8 AS x, px[(k + 1)::INT] AS g FROM img, range(0, 64) AS t(k)),
roi AS (SELECT * FROM raw WHERE g > 30 AND g < 220),
pix AS (SELECT vec_id, y, x, g, g // 25 - min(g) OVER (PARTITION BY vec_id) // 25 + 1 AS b FROM roi)"""


def expression(spark: SparkSession, sf_dir: str, every: bool = False) -> DataFrame:
    """Events as counts: sample by type, observation by user, gene by key, value summed; every fifth user has none unless `every` has."""
    gene = F.concat(F.lit("g"), F.get_json_object("props", "$.k"))
    gene = F.when(gene.isin("g3", "g33"), F.concat(F.lit("BLANK_"), gene)).when(gene == "g7", F.lit("NegControl7")).otherwise(gene)
    events = load(spark, sf_dir, "events")
    e = (events if every else events.where("user_id % 5 <> 0")).select(F.col("event_type").alias("sample_id"), F.col("user_id").alias("obs_row"), gene.alias("gene"), "value")
    return e.groupBy("sample_id", "obs_row", "gene").agg(F.round(F.sum("value"), 6).alias("value"))


def matrix(spark: SparkSession, sf_dir: str, every: bool = False) -> tuple[DataFrame, DataFrame]:
    """The counts as a matrix in rows with its genes; every user of a type is an observation, with or without counts."""
    events = load(spark, sf_dir, "events").select(F.col("event_type").alias("sample_id"), F.col("user_id").alias("obs_row")).distinct()
    named = events.withColumn("obs_id", F.concat_ws("-", "sample_id", "obs_row"))
    return from_long(named, expression(spark, sf_dir, every))


EXPRESSION_SQL = """ev AS (SELECT event_type AS sample_id, user_id, 'g' || json_extract_string(props, '$.k') AS g, value FROM events),
obs AS (SELECT sample_id, count(DISTINCT user_id) AS n_obs FROM ev GROUP BY sample_id),
expr AS (SELECT sample_id, user_id, CASE WHEN g IN ('g3', 'g33') THEN 'BLANK_' || g WHEN g = 'g7' THEN 'NegControl7' ELSE g END AS gene, round(sum(value), 6) AS value FROM ev WHERE user_id % 5 <> 0 GROUP BY ALL)"""
#: The same with the counts of every user.
EVERY_EXPRESSION_SQL = EXPRESSION_SQL.replace(" WHERE user_id % 5 <> 0", "")
