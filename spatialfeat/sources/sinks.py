"""Writers. Tables of samples are partitioned by sample, and writing some samples leaves the others alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import number
from ..operators.cells import with_summary
from ..operators.geometry import CURVE_BITS, bounds, curve_place, to_wkb
from ..schema import normalised_columns

#: Outputs of an extraction.
PROCESSED = ("table", "X", "obs", "stats")


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def samples_at(spark: SparkSession, path: str) -> list[str]:
    """Samples of a partitioned table in order, from its folders; none if there is no table."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    names = [f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()]
    return sorted(unescape(n.partition("=")[2]) for n in names if n.startswith("sample_id="))


def files_at(spark: SparkSession, path: str, endings: tuple[str, ...]) -> list[str]:
    """Names without their endings of the files in a folder that have one of some endings, in order."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(p) if not f.isDirectory()]
    return sorted(n.rpartition(".")[0] for n in names if n.endswith(endings))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """A table partitioned by sample, whose ids are text even where they look like numbers."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, T.StringType()) if f.name == "sample_id" else f for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def samples(df: DataFrame, path: str) -> None:
    """Writes the samples of df over what there is of them, each in its own partition."""
    df.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("sample_id").parquet(path)


#: States of a sample's outputs.
BEGUN, DONE = "begun", "done"


def mark(spark: SparkSession, path: str, some: list[str], state: str) -> None:
    """Says of samples that their outputs are being written, or are all there."""
    rows = spark.createDataFrame([(s, state) for s in some], "sample_id string, state string").coalesce(1)
    samples(rows, f"{path}/state")


def processed_samples(spark: SparkSession, path: str) -> list[str]:
    """Samples whose extraction is done: all outputs were written by one run that came to its end."""
    if not samples_at(spark, f"{path}/state"):
        return []
    return sorted(r.sample_id for r in read_samples(spark, f"{path}/state").where(F.col("state") == DONE).select("sample_id").collect())  # names of samples


def matrix(df: DataFrame) -> dict[str, DataFrame]:
    """X (sample_id, patch_idx and the features as floats), obs (all other columns, null texts empty), var and feature_list."""
    features = normalised_columns(df)
    rest = [c for c in df.columns if c not in features]
    keys = [c for c in ("sample_id", "patch_idx") if c in df.columns]
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in keys}
    names = df.sparkSession.createDataFrame([(f, k) for k, f in enumerate(features)], "feature string, place long").coalesce(1)
    return {
        "X": df.select(*keys, F.array(*(number(F.col(f)).cast("float") for f in features)).alias("X")),
        "obs": df.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) if c in text else F.col(c) for c in rest)),
        "var": names, "feature_list": names.select("feature"),
    }


def processed(df: DataFrame, stats: DataFrame, path: str, some: list[str]) -> None:
    """The processed table, its statistics, its feature list, and the matrix with its row and column tables, of some samples.

    The table is worked out once; the matrix and its rows are read from it. The samples are marked as begun before the first output
    and as done after the last one, so a run that ends in between is one that has to be repeated.
    """
    spark = df.sparkSession
    mark(spark, path, some, BEGUN)
    samples(df, f"{path}/table")
    samples(stats, f"{path}/stats")
    made = matrix(read_samples(spark, f"{path}/table").where(F.col("sample_id").isin(some)))
    made["feature_list"].write.mode("overwrite").text(f"{path}/feature_list")
    made["var"].write.mode("overwrite").parquet(f"{path}/var")
    samples(made["obs"], f"{path}/obs")
    samples(made["X"], f"{path}/X")
    mark(spark, path, some, DONE)


def cells(df: DataFrame, summary: DataFrame | None, path: str) -> None:
    """Cells with the summary of their patch, of the samples of df."""
    samples(with_summary(df, summary), path)


#: What GeoParquet says of a geometry column with bounds.
GEO = {
    "encoding": "WKB", "geometry_types": ["Polygon", "MultiPolygon"], "covering": {"bbox": {c: ["bbox", c] for c in ("xmin", "ymin", "xmax", "ymax")}},
}
#: Bytes of a row group of cells with bounds: small enough for a window to leave most of a file out.
GROUP_BYTES = 8 << 20


def geo_cells(df: DataFrame, summary: DataFrame | None, path: str, group_bytes: int = GROUP_BYTES) -> None:
    """Cells with the summary of their patch, of the samples of df, in the columns of GeoParquet: geometry as well-known binary and bbox with its bounds.

    Rows of a sample are in order along a Hilbert curve through the middles of their bounds, so that row groups are compact and a window
    reads few. Every sample is dealt to as many tasks as it needs, in runs of that order. What GeoParquet says of a geometry in a `geo` entry
    of the file stands in the column's metadata, as Spark's writer has no place for such an entry.
    """
    own = with_summary(df, summary)
    whole = F.col("geometry") if isinstance(own.schema["geometry"].dataType.elementType.elementType, T.ArrayType) else F.when(F.col("geometry").isNotNull(), F.array("geometry"))
    boxed = own.withColumn("geometry", whole).withColumn("bbox", bounds(F.col("geometry")))
    every = boxed.groupBy("sample_id").agg(
        *(F.min(f"bbox.{c}").alias(f"low_{c[0]}") for c in ("xmin", "ymin")), F.greatest(F.max("bbox.xmax") - F.min("bbox.xmin"), F.max("bbox.ymax") - F.min("bbox.ymin"), F.lit(1e-9)).alias("span_"),
    )
    met = boxed.alias("c").join(every.alias("e"), F.col("c.sample_id").eqNullSafe(F.col("e.sample_id"))).select("c.*", "low_x", "low_y", "span_")
    middle = lambda a: (F.col(f"bbox.{a}min") + F.col(f"bbox.{a}max")) / 2 - F.col(f"low_{a}")
    whole_number = lambda v: F.least(F.floor(v / F.col("span_") * (1 << CURVE_BITS)), F.lit((1 << CURVE_BITS) - 1)).cast("long")
    placed = met.withColumn("curve_", curve_place(whole_number(middle("x")), whole_number(middle("y")))).drop("low_x", "low_y", "span_").withColumn("geometry", to_wkb("geometry"))
    placed = placed.withColumn("geometry", F.col("geometry").alias("geometry", metadata=GEO))
    ordered = placed.repartitionByRange("sample_id", "curve_").sortWithinPartitions("sample_id", "curve_").drop("curve_")
    out = ordered.write.option("partitionOverwriteMode", "dynamic").option("parquet.block.size", group_bytes).mode("overwrite")
    out.partitionBy("sample_id").parquet(path)


def csv_and_parquet(df: DataFrame, path: str) -> None:
    """A table of statistics in both formats, of the samples of df; those of other samples stay."""
    samples(df, f"{path}/parquet")
    manifest(df, f"{path}/csv")


def manifest(df: DataFrame, path: str) -> None:
    """A table as text with a header, one folder a sample, of the samples of df; those of other samples stay."""
    out = df.repartition("sample_id").write.option("partitionOverwriteMode", "dynamic").mode("overwrite").option("header", True)
    out.partitionBy("sample_id").csv(path)


def json_rows(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").json(path)


def parquet_safe(df: DataFrame) -> DataFrame:
    """Arrays, structs and maps as JSON text; the rest as it is."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    return df.select(*(F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields))
