"""Queries over images and polygons, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kernels, pixels
from ..operators import geometry, pictures, segmentation, texture
from ..operators.cells import of_patches
from ..schema import SKIPPED_SMALL_MASK, SMALLEST_MASK, Config
from ..sources import readers, sinks
from . import pipeline
from . import standin as s
from .relational import KEYS, QUERIES, SQL, R, _boxes, query, rounded

__all__ = ["QUERIES", "SQL"]


@query(f"""WITH {s.images_sql()} SELECT vec_id, array_to_string(list_transform(range(0, 64), lambda k: (px[(k + 1)::INT] * 19595 + px[((k + 21) % 64 + 1)::INT] * 38470 + px[((k + 42) % 64 + 1)::INT] * 7471 + 32768) >> 16), ',') AS gray FROM img""")
def rgb_to_gray(spark: SparkSession, d: str) -> DataFrame:
    return s.colour_images(spark, d).select("vec_id", F.array_join(pixels.gray(F.col("px")).cast("array<string>"), ",").alias("gray"))


@query("""SELECT vec_id, list_sum(list_transform(embedding, lambda e: floor(greatest(least(e::FLOAT * (CASE WHEN list_max(embedding) <= 1 THEN 255 ELSE 1 END)::FLOAT, 255::FLOAT), 0::FLOAT))))::BIGINT AS total FROM embeddings""")
def uint8_coercion(spark: SparkSession, d: str) -> DataFrame:
    total = F.aggregate(pixels.as_uint8(F.col("embedding")), F.lit(0).cast("long"), lambda a, b: a + b)
    return s.load(spark, d, "embeddings").select("vec_id", total.alias("total"))


@query(f"WITH {s.images_sql(600)} SELECT vec_id, len(list_filter(px, lambda g: g > 30 AND g < 220))::BIGINT AS patch_mask_area FROM img")
def threshold_mask_area(spark: SparkSession, d: str) -> DataFrame:
    return s.images(spark, d, 600).select("vec_id", pixels.mask_area(pixels.threshold_mask(F.col("px"))).alias("patch_mask_area"))


@query(f"WITH {s.images_sql(600)} SELECT vec_id, array_to_string(list_transform(px, lambda g: CASE WHEN g > 30 AND g < 220 THEN g ELSE 0 END), ',') AS masked FROM img")
def apply_mask(spark: SparkSession, d: str) -> DataFrame:
    masked = pixels.masked(F.col("px"), pixels.threshold_mask(F.col("px")))
    return s.images(spark, d, 600).select("vec_id", F.array_join(masked.cast("array<string>"), ",").alias("masked"))


@query(f"""WITH {s.images_sql(600)}, kind AS (SELECT vec_id, px, vec_id % 4 AS k FROM img),
rgb AS (SELECT vec_id, CASE k WHEN 0 THEN flatten(list_transform(px, lambda g: [g, g, g])) ELSE flatten(list_transform(range(0, 16), lambda i: CASE WHEN k = 1 THEN [px[(i + 1)::INT], px[(i + 17)::INT], px[(i + 33)::INT]] WHEN k = 2 THEN [px[(4 * i + 1)::INT], px[(4 * i + 2)::INT], px[(4 * i + 3)::INT]] ELSE [px[(3 * i + 1)::INT], px[(3 * i + 2)::INT], px[(3 * i + 3)::INT]] END)) END AS v FROM kind)
SELECT vec_id, array_to_string(v, ',') AS rgb, 255 * 64::BIGINT AS full_mask FROM rgb""")
def layout_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Gray, channels first, four channels and channels last, all as interleaved RGB; and the mask of a whole patch."""
    img = s.images(spark, d, 600)
    k = F.col("vec_id") % 4
    px = F.when(k == 0, F.col("px")).when(k == 2, F.col("px")).otherwise(F.slice("px", 1, 48))
    size = F.when(k == 0, 8).otherwise(4)
    patches = img.select("vec_id", px.alias("px"), size.alias("h"), size.alias("w"), F.when(k == 1, "chw").otherwise("hwc").alias("layout"), F.aggregate(pixels.full_mask(F.col("px")), F.lit(0).cast("long"), lambda a, b: a + b).alias("full_mask"))
    return readers.as_rgb8(patches).select("vec_id", F.array_join(F.col("px").cast("array<string>"), ",").alias("rgb"), "full_mask")


@query(f"WITH {s.images_sql(600)} SELECT vec_id, CASE WHEN len(list_filter(px, lambda g: g > 30 AND g < 220)) < {SMALLEST_MASK} THEN '{SKIPPED_SMALL_MASK}' ELSE 'ok' END AS status FROM img")
def patch_status(spark: SparkSession, d: str) -> DataFrame:
    area = pixels.mask_area(pixels.threshold_mask(F.col("px")))
    return s.images(spark, d, 600).select("vec_id", F.when(area < SMALLEST_MASK, SKIPPED_SMALL_MASK).otherwise("ok").alias("status"))


@query(f"""WITH {s.images_sql(600)} SELECT vec_id, kind, 8::BIGINT AS width, 8::BIGINT AS height, CASE WHEN kind LIKE '%color%' THEN 2 ELSE 0 END::BIGINT AS colour_type, true AS intact
FROM img, (VALUES ('color'), ('gray'), ('masked_gray_threshold'), ('masked_color_threshold')) v(kind)""")
def patch_pictures(spark: SparkSession, d: str) -> DataFrame:
    """PNGs of patches: what their heads say, and whether head and end have their check sums."""
    made = pictures.pictures(s.colour_images(spark, d, 600), ["vec_id"])
    part = lambda at, n: F.substring("png", at, n)
    number = lambda at, n: F.conv(F.hex(part(at, n)), 16, 10).cast("long")
    end = F.unhex(F.lit("0000000049454E44AE426082"))
    intact = (F.crc32(part(13, 17)) == number(30, 4)) & (F.substring(F.col("png"), -12, 12) == end)
    return made.select("vec_id", "kind", number(17, 4).alias("width"), number(21, 4).alias("height"), number(26, 1).alias("colour_type"), intact.alias("intact"))


_KINDS = ("square", "squareroot", "logarithm", "exponential")


@query(f"""WITH {s.images_sql()}, t AS (SELECT vec_id, g::DOUBLE AS x, max(abs(g::DOUBLE)) OVER (PARTITION BY vec_id) AS m FROM raw)
SELECT vec_id, {R('avg(pow(x / sqrt(m), 2)) / 100')} AS square, {R('avg(sign(x) * sqrt(m * abs(x))) / 100')} AS squareroot, {R('avg(sign(x) * m / ln(m + 1) * ln(abs(x) + 1)) / 100')} AS logarithm, {R('avg(exp(ln(m) / m * x)) / 100')} AS exponential FROM t GROUP BY vec_id""")
def pointwise_filters(spark: SparkSession, d: str) -> DataFrame:
    mean = lambda k: F.aggregate(pixels.filtered(F.col("px"), k), F.lit(0.0), lambda a, b: a + b) / F.size("px") / 100
    return rounded(s.images(spark, d).select("vec_id", *(mean(k).alias(k) for k in _KINDS)))


#: Features with large values are compared after division by these.
_SCALE = {"firstorder_Energy": 1e4, "firstorder_TotalEnergy": 1e4, "glcm_ClusterProminence": 1e2}


def _features(spark: SparkSession, d: str, cls: str, without=(), only=None) -> DataFrame:
    img = s.images(spark, d).withColumn("mask", pixels.threshold_mask(F.col("px")))
    out = texture.texture_features(img, ["vec_id"], classes=(cls,), prefix="")
    names = [c for c in out.columns[1:] if c not in without and (only is None or c in only)]
    return rounded(out.select("vec_id", *((F.col(c) / _SCALE.get(c, 1.0)).alias(c) for c in names)))


def _named(cls: str, values: dict[str, str]) -> str:
    return ", ".join(f"{R(f'({v}) / {_SCALE[f'{cls}_{k}']}' if f'{cls}_{k}' in _SCALE else v)} AS {cls}_{k}" for k, v in values.items())


EPS = 2.220446049250313e-16
_FIRST = {
    "Energy": "sum(g * g)::DOUBLE", "TotalEnergy": "sum(g * g)::DOUBLE", "Minimum": "min(g)::DOUBLE", "Maximum": "max(g)::DOUBLE", "Range": "(max(g) - min(g))::DOUBLE", "Mean": "avg(g)",
    "Median": "quantile_cont(g, 0.5)", "10Percentile": "any_value(p10)", "90Percentile": "any_value(p90)", "InterquartileRange": "quantile_cont(g, 0.75) - quantile_cont(g, 0.25)",
    "MeanAbsoluteDeviation": "avg(abs(g - m))", "RobustMeanAbsoluteDeviation": "avg(abs(g - rm)) FILTER (g >= p10 AND g <= p90)", "RootMeanSquared": "sqrt(avg(g * g))",
    "Skewness": "CASE WHEN avg((g - m) ** 2) = 0 THEN 0 ELSE avg((g - m) ** 3) / avg((g - m) ** 2) ** 1.5 END", "Kurtosis": "CASE WHEN avg((g - m) ** 2) = 0 THEN 0 ELSE avg((g - m) ** 4) / avg((g - m) ** 2) ** 2 END",
    "Variance": "var_pop(g)", "Entropy": "any_value(h)", "Uniformity": "any_value(u)",
}


def _first_ctes(pix: str) -> str:
    """CTE fo: the first-order features of pixels (vec_id, g, b)."""
    return f"""fa AS (SELECT vec_id, avg(g) AS m, quantile_cont(g::DOUBLE, 0.1) AS p10, quantile_cont(g::DOUBLE, 0.9) AS p90 FROM {pix} GROUP BY vec_id),
fr AS (SELECT vec_id, avg(g) AS rm FROM {pix} JOIN fa USING (vec_id) WHERE g >= p10 AND g <= p90 GROUP BY vec_id),
fc AS (SELECT vec_id, b, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY vec_id) AS p FROM {pix} GROUP BY vec_id, b),
fe AS (SELECT vec_id, -sum(p * log2(p + {EPS})) AS h, sum(p * p) AS u FROM fc GROUP BY vec_id),
fo AS (SELECT vec_id, {', '.join(f'{v} AS "{k}"' for k, v in _FIRST.items())} FROM (SELECT vec_id, g::DOUBLE AS g FROM {pix}) JOIN fa USING (vec_id) JOIN fr USING (vec_id) JOIN fe USING (vec_id) GROUP BY vec_id)"""


def _quoted(names) -> dict[str, str]:
    return {k: f'"{k}"' for k in names}


@query(f"WITH {s.images_sql()}, {_first_ctes('pix')} SELECT vec_id, {_named('firstorder', _quoted(_FIRST))} FROM fo")
def firstorder_roi(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "firstorder")


_JOINT = {
    "Autocorrelation": "sum(p * i * j)", "JointAverage": "any_value(ux)", "ClusterTendency": "sum(p * (i + j - ux - uy) ** 2)", "ClusterShade": "sum(p * (i + j - ux - uy) ** 3)",
    "ClusterProminence": "sum(p * (i + j - ux - uy) ** 4)", "Contrast": "sum(p * (i - j) ** 2)",
    "Correlation": "CASE WHEN any_value(sx * sy) = 0 THEN 1 ELSE (sum(p * i * j) - any_value(ux * uy)) / any_value(sx * sy) END", "DifferenceAverage": "sum(p * abs(i - j))",
    "DifferenceEntropy": "any_value(dh)", "DifferenceVariance": "sum(p * (abs(i - j) - da) ** 2)", "JointEnergy": "sum(p * p)", "JointEntropy": f"-sum(p * log2(p + {EPS}))",
    "Imc1": f"(-sum(p * log2(p + {EPS})) + sum(p * log2(pi * pj + {EPS}))) / any_value(greatest(hx, hy))",
    "Imc2": f"sqrt(greatest(0, 1 - exp(-2 * (any_value(hxy2) + sum(p * log2(p + {EPS}))))))", "Id": "sum(p / (1 + abs(i - j)))", "Idn": "sum(p / (1 + abs(i - j) / ng))",
    "Idm": "sum(p / (1 + (i - j) ** 2))", "Idmn": "sum(p / (1 + (i - j) ** 2 / ng ** 2))", "InverseVariance": "coalesce(sum(p / (i - j) ** 2) FILTER (i <> j), 0)",
    "MaximumProbability": "max(p)", "SumAverage": "sum(p * (i + j))", "SumEntropy": "any_value(sh)", "SumSquares": "sum(p * (i - ux) ** 2)",
}
_PAIRS = """dirs(dir, dy, dx) AS (VALUES (0, 0, 1), (1, 1, 0), (2, 1, 1), (3, 1, -1)),
pr AS (SELECT a.vec_id, dir, a.b AS i, b.b AS j FROM pix a, dirs JOIN pix b ON b.vec_id = a.vec_id AND b.y = a.y + dy AND b.x = a.x + dx),
sym AS (SELECT * FROM pr UNION ALL SELECT vec_id, dir, j, i FROM pr)"""


def _glcm_sql() -> str:
    per_dir = ", ".join(f"{v} AS f{k}" for k, v in enumerate(_JOINT.values()))
    mean = _named("glcm", {n: f"avg(f{k})" for k, n in enumerate(_JOINT)})
    return f"""WITH {s.images_sql()}, {_PAIRS},
m AS (SELECT vec_id, dir, i::DOUBLE AS i, j::DOUBLE AS j, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY vec_id, dir) AS p FROM sym GROUP BY vec_id, dir, i, j),
mx AS (SELECT vec_id, dir, i, sum(p) AS pi FROM m GROUP BY ALL), g AS (SELECT vec_id, max(b)::DOUBLE AS ng FROM pix GROUP BY vec_id),
mm AS (SELECT vec_id, dir, sum(pi * i) AS ux, -sum(pi * log2(pi + {EPS})) AS hx FROM mx GROUP BY ALL),
ms AS (SELECT vec_id, dir, any_value(ux) AS ux, any_value(ux) AS uy, any_value(hx) AS hx, any_value(hx) AS hy, sqrt(sum(pi * (i - ux) ** 2)) AS sx, sqrt(sum(pi * (i - ux) ** 2)) AS sy FROM mx JOIN mm USING (vec_id, dir) GROUP BY vec_id, dir),
h2 AS (SELECT a.vec_id, a.dir, -sum(a.pi * b.pi * log2(a.pi * b.pi + {EPS})) AS hxy2 FROM mx a JOIN mx b ON a.vec_id = b.vec_id AND a.dir = b.dir GROUP BY ALL),
md AS (SELECT vec_id, dir, abs(i - j) AS k, sum(p) AS pk FROM m GROUP BY ALL), dd AS (SELECT vec_id, dir, sum(k * pk) AS da, -sum(pk * log2(pk + {EPS})) AS dh FROM md GROUP BY ALL),
mp AS (SELECT vec_id, dir, i + j AS k, sum(p) AS pk FROM m GROUP BY ALL), sp AS (SELECT vec_id, dir, -sum(pk * log2(pk + {EPS})) AS sh FROM mp GROUP BY ALL),
f AS (SELECT vec_id, dir, {per_dir} FROM m JOIN ms USING (vec_id, dir) JOIN dd USING (vec_id, dir) JOIN sp USING (vec_id, dir) JOIN h2 USING (vec_id, dir) JOIN g USING (vec_id)
 JOIN mx USING (vec_id, dir, i) JOIN (SELECT vec_id, dir, i AS j, pi AS pj FROM mx) USING (vec_id, dir, j) GROUP BY vec_id, dir)
SELECT vec_id, {mean} FROM f GROUP BY vec_id"""


@query(_glcm_sql())
def glcm_features(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "glcm", without=("glcm_MCC",))


def _mcc_sql(rounds: int = 26) -> str:
    """The second largest eigenvalue by repeated squaring: what is left of the scaled matrix without its first eigenvector, which is known
    (the roots of the margins, with eigenvalue 1), is squared until only the largest one counts."""
    return f"""WITH RECURSIVE {s.images_sql()}, {_PAIRS},
m AS (SELECT vec_id, dir, i, j, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY vec_id, dir) AS p FROM sym GROUP BY vec_id, dir, i, j),
mx AS (SELECT vec_id, dir, i, sum(p) AS pi FROM m GROUP BY ALL),
e AS (SELECT a.vec_id, a.dir, a.i, b.i AS j, coalesce(p, 0) / sqrt(a.pi * b.pi) - sqrt(a.pi * b.pi) AS v FROM mx a JOIN mx b ON a.vec_id = b.vec_id AND a.dir = b.dir LEFT JOIN m ON m.vec_id = a.vec_id AND m.dir = a.dir AND m.i = a.i AND m.j = b.i),
e2 AS (SELECT a.vec_id, a.dir, a.i, b.j, sum(a.v * b.v) AS v FROM e a JOIN e b ON a.vec_id = b.vec_id AND a.dir = b.dir AND a.j = b.i GROUP BY ALL),
sq(vec_id, dir, i, j, v, k) AS (SELECT vec_id, dir, i, j, v / nullif(sum(v) FILTER (i = j) OVER (PARTITION BY vec_id, dir), 0), 0 FROM e2 UNION ALL
 SELECT vec_id, dir, i, j, v / nullif(sum(v) FILTER (i = j) OVER (PARTITION BY vec_id, dir), 0), k FROM
 (SELECT a.vec_id, a.dir, a.i, b.j, sum(a.v * b.v) AS v, a.k + 1 AS k FROM sq a JOIN sq b ON a.vec_id = b.vec_id AND a.dir = b.dir AND a.j = b.i WHERE a.k < {rounds} GROUP BY ALL)),
l AS (SELECT e2.vec_id, e2.dir, count(DISTINCT e2.i) AS levels, sum(e2.v * sq.v) AS squared FROM e2 LEFT JOIN sq ON sq.vec_id = e2.vec_id AND sq.dir = e2.dir AND sq.i = e2.i AND sq.j = e2.j AND sq.k = {rounds} GROUP BY ALL)
SELECT vec_id, {R('avg(CASE WHEN levels < 2 THEN 1.0 ELSE sqrt(greatest(coalesce(squared, 0), 0)) END)')} AS "glcm_MCC" FROM l GROUP BY vec_id"""


@query(_mcc_sql())
def glcm_mcc(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "glcm", only=("glcm_MCC",))


def _matrix_sql(cls: str, names: tuple[str, ...], counts: str, skip: tuple[int, ...] = ()) -> str:
    """SQL of the features of counts: CTE cnt (vec_id, dir, i, j, c), np per patch from pix."""
    v = [
        "sum(c / j ** 2) / n", "sum(c * j ** 2) / n", "any_value(gn) / n", "any_value(gn) / n ** 2", "any_value(rn) / n", "any_value(rn) / n ** 2", "n / any_value(np)",
        "sum(c * (i - ui) ** 2) / n", "sum(c * (j - uj) ** 2) / n", f"-sum(c / n * log2(c / n + {EPS}))", "sum(c / i ** 2) / n", "sum(c * i ** 2) / n",
        "sum(c / (i * j) ** 2) / n", "sum(c * i ** 2 / j ** 2) / n", "sum(c * j ** 2 / i ** 2) / n", "sum(c * (i * j) ** 2) / n",
    ]
    v = [x for k, x in enumerate(v) if k not in skip]
    per = ", ".join(f"{x} AS f{k}" for k, x in enumerate(v))
    return f"""{counts}, t AS (SELECT vec_id, dir, sum(c) AS n, sum(c * i) / sum(c) AS ui, sum(c * j) / sum(c) AS uj FROM cnt GROUP BY ALL),
gi AS (SELECT vec_id, dir, sum(s * s) AS gn FROM (SELECT vec_id, dir, i, sum(c) AS s FROM cnt GROUP BY ALL) GROUP BY ALL), rj AS (SELECT vec_id, dir, sum(s * s) AS rn FROM (SELECT vec_id, dir, j, sum(c) AS s FROM cnt GROUP BY ALL) GROUP BY ALL),
np AS (SELECT vec_id, count(*)::DOUBLE AS np FROM pix GROUP BY vec_id),
f AS (SELECT vec_id, dir, {per} FROM cnt JOIN t USING (vec_id, dir) JOIN gi USING (vec_id, dir) JOIN rj USING (vec_id, dir) JOIN np USING (vec_id) GROUP BY vec_id, dir, n)
SELECT vec_id, {_named(cls, {name: f'avg(f{k})' for k, name in enumerate(names)})} FROM f GROUP BY vec_id"""


_RUNS = f"""WITH {s.images_sql()}, ln AS (SELECT vec_id, b, unnest([0, 1, 2, 3]) AS dir, unnest([y, x, y - x, y + x]) AS line, unnest([x, y, x, y]) AS pos FROM pix),
isl AS (SELECT *, pos - row_number() OVER (PARTITION BY vec_id, dir, line, b ORDER BY pos) AS grp FROM ln),
runs AS (SELECT vec_id, dir, b, count(*) AS len FROM isl GROUP BY vec_id, dir, line, b, grp), cnt AS (SELECT vec_id, dir, b::DOUBLE AS i, len::DOUBLE AS j, count(*)::DOUBLE AS c FROM runs GROUP BY ALL)"""


@query(_matrix_sql("glrlm", kernels.GLRLM, _RUNS))
def glrlm_features(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "glrlm")


_ZONES = f"""WITH RECURSIVE {s.images_sql()}, near AS (SELECT a.vec_id, a.y * 8 + a.x AS p, b.y * 8 + b.x AS q FROM pix a JOIN pix b ON a.vec_id = b.vec_id AND a.b = b.b AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
reach AS (SELECT vec_id, y * 8 + x AS p, y * 8 + x AS q FROM pix UNION SELECT r.vec_id, r.p, n.q FROM reach r JOIN near n ON r.vec_id = n.vec_id AND r.q = n.p),
lab AS (SELECT vec_id, p, min(q) AS z FROM reach GROUP BY ALL), zn AS (SELECT l.vec_id, z, any_value(b) AS b, count(*) AS len FROM lab l JOIN pix x ON x.vec_id = l.vec_id AND x.y * 8 + x.x = p GROUP BY l.vec_id, z),
cnt AS (SELECT vec_id, 0 AS dir, b::DOUBLE AS i, len::DOUBLE AS j, count(*)::DOUBLE AS c FROM zn GROUP BY ALL)"""


#: How two pixels a and b are neighbours, in a plane and along one axis.
_PLANE_NEAR, _AXIS_NEAR = "abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1", "a.y = b.y AND abs(a.x - b.x) <= 1"


def _axis_features(spark: SparkSession, d: str, cls: str) -> DataFrame:
    """Features of a class along one axis, through the driver's settings."""
    made = pipeline.threshold_features(s.images(spark, d).withColumnRenamed("vec_id", "patch_idx"), Config(directions="axis"), smallest=1)
    names = [c.removeprefix("patch_original_") for c in made.columns if c.startswith(f"patch_original_{cls}_") and not c.endswith("_MCC")]
    return rounded(made.where("patch_mask_area > 0").select(F.col("patch_idx").alias("vec_id"), *((F.col(f"patch_original_{f}") / _SCALE.get(f, 1.0)).alias(f) for f in names)))


@query(_matrix_sql("glszm", kernels.GLSZM, _ZONES))
def glszm_features(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "glszm")


@query(_matrix_sql("glszm", kernels.GLSZM, _ZONES.replace(_PLANE_NEAR, _AXIS_NEAR)))
def glszm_features_axis(spark: SparkSession, d: str) -> DataFrame:
    return _axis_features(spark, d, "glszm")


_DEPENDS = f"""WITH {s.images_sql()}, dep AS (SELECT a.vec_id, a.y, a.x, a.b, count(*) AS len FROM pix a JOIN pix b ON a.vec_id = b.vec_id AND a.b = b.b AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 GROUP BY ALL),
cnt AS (SELECT vec_id, 0 AS dir, b::DOUBLE AS i, len::DOUBLE AS j, count(*)::DOUBLE AS c FROM dep GROUP BY ALL)"""


@query(_matrix_sql("gldm", kernels.GLDM, _DEPENDS, skip=(3, 6)))
def gldm_features(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "gldm")


@query(_matrix_sql("gldm", kernels.GLDM, _DEPENDS.replace(_PLANE_NEAR, _AXIS_NEAR), skip=(3, 6)))
def gldm_features_axis(spark: SparkSession, d: str) -> DataFrame:
    return _axis_features(spark, d, "gldm")


_TONE = {
    "Coarseness": "CASE WHEN any_value(ps) = 0 THEN 1e6 ELSE 1 / any_value(ps) END",
    "Contrast": "CASE WHEN any_value(ng) = 1 THEN 0 ELSE sum(a.p * b.p * (a.i - b.i) ** 2) * any_value(ss) / (any_value(ng) * (any_value(ng) - 1) * any_value(nv)) END",
    "Busyness": "CASE WHEN sum(abs(a.i * a.p - b.i * b.p)) = 0 THEN 0 ELSE any_value(ps) / sum(abs(a.i * a.p - b.i * b.p)) END",
    "Complexity": "sum(abs(a.i - b.i) * (a.p * a.s + b.p * b.s) / (a.p + b.p)) / any_value(nv)", "Strength": "CASE WHEN any_value(ss) = 0 THEN 0 ELSE sum((a.p + b.p) * (a.i - b.i) ** 2) / any_value(ss) END",
}


_TONE_SQL = f"""WITH {s.images_sql()}, nb AS (SELECT a.vec_id, a.y, a.x, a.b, avg(b.b) AS m FROM pix a JOIN pix b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND NOT (a.y = b.y AND a.x = b.x) GROUP BY ALL),
l AS (SELECT vec_id, b::DOUBLE AS i, sum(abs(b - m)) AS s, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY vec_id) AS p, count(*) AS n FROM nb GROUP BY vec_id, b),
t AS (SELECT vec_id, sum(p * s) AS ps, sum(s) AS ss, sum(n) AS nv, count(*) AS ng FROM l GROUP BY vec_id)
SELECT a.vec_id, {_named('ngtdm', _TONE)} FROM l a JOIN l b ON a.vec_id = b.vec_id JOIN t ON t.vec_id = a.vec_id GROUP BY a.vec_id"""


@query(_TONE_SQL)
def ngtdm_features(spark: SparkSession, d: str) -> DataFrame:
    return _features(spark, d, "ngtdm")


@query(_TONE_SQL.replace(_PLANE_NEAR, _AXIS_NEAR))
def ngtdm_features_axis(spark: SparkSession, d: str) -> DataFrame:
    return _axis_features(spark, d, "ngtdm")


_PARTS = f"""{s.images_sql(600)}, near AS (SELECT a.vec_id, a.y * 8 + a.x AS p, b.y * 8 + b.x AS q FROM roi a JOIN roi b ON a.vec_id = b.vec_id AND {_PLANE_NEAR}),
reach AS (SELECT vec_id, y * 8 + x AS p, y * 8 + x AS q FROM roi UNION SELECT r.vec_id, r.p, n.q FROM reach r JOIN near n ON r.vec_id = n.vec_id AND r.q = n.p),
lab AS (SELECT vec_id, p, min(q) AS z FROM reach GROUP BY ALL)"""
#: CTE ring (vec_id, z, n, ps): the walk around the outer border of every part, of those it visits no pixel of twice. Directions are
#: counter-clockwise on the screen from the right; a walk looks around from after where it came from, and ends at its first step.
_WALKS = f"""{_PARTS}, dirs(d, dy, dx) AS (VALUES (0, 0, 1), (1, -1, 1), (2, -1, 0), (3, -1, -1), (4, 0, -1), (5, 1, -1), (6, 1, 0), (7, 1, 1)),
adj AS (SELECT a.vec_id, a.z, a.p, d, b.p AS q FROM lab a, dirs, lab b WHERE b.vec_id = a.vec_id AND b.z = a.z AND b.p // 8 = a.p // 8 + dy AND b.p % 8 = a.p % 8 + dx),
begun AS (SELECT vec_id, z, d AS came, q AS last FROM adj WHERE p = z QUALIFY row_number() OVER (PARTITION BY vec_id, z ORDER BY (12 - d) % 8) = 1),
nxt AS (SELECT vec_id, z, p, c AS came, d, q FROM adj, range(0, 8) AS t(c) QUALIFY row_number() OVER (PARTITION BY vec_id, z, p, c ORDER BY (d - c + 15) % 8) = 1),
walk AS (SELECT vec_id, z, 0 AS i, z AS p, came, last FROM begun UNION ALL
 SELECT w.vec_id, w.z, w.i + 1, n.q, (n.d + 4) % 8, w.last FROM walk w JOIN nxt n ON n.vec_id = w.vec_id AND n.z = w.z AND n.p = w.p AND n.came = w.came WHERE NOT (n.q = w.z AND w.p = w.last)),
ring AS (SELECT vec_id, z, count(*) AS n, list(p ORDER BY i) AS ps FROM walk GROUP BY vec_id, z HAVING count(*) > 2 AND count(DISTINCT p) = count(*))"""


@query(f"""WITH RECURSIVE {s.images_sql(600)}, near AS (SELECT a.vec_id, a.y * 8 + a.x AS p, b.y * 8 + b.x AS q FROM roi a JOIN roi b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
reach AS (SELECT vec_id, y * 8 + x AS p, y * 8 + x AS q FROM roi UNION SELECT r.vec_id, r.p, n.q FROM reach r JOIN near n ON r.vec_id = n.vec_id AND r.q = n.p),
lab AS (SELECT vec_id, p, min(q) AS z FROM reach GROUP BY ALL) SELECT vec_id, count(DISTINCT z)::BIGINT AS n_parts FROM img LEFT JOIN lab USING (vec_id) GROUP BY vec_id""")
def instance_labels(spark: SparkSession, d: str) -> DataFrame:
    img = s.images(spark, d, 600).withColumn("mask", pixels.threshold_mask(F.col("px")))
    return geometry.instance_labels(img, ["vec_id"]).select("vec_id", F.coalesce(F.array_max("labels"), F.lit(0)).cast("long").alias("n_parts"))


@query(f"""WITH RECURSIVE {s.images_sql(600)}, near AS (SELECT a.vec_id, a.y * 8 + a.x AS p, b.y * 8 + b.x AS q FROM roi a JOIN roi b ON a.vec_id = b.vec_id AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1),
reach AS (SELECT vec_id, y * 8 + x AS p, y * 8 + x AS q FROM roi UNION SELECT r.vec_id, r.p, n.q FROM reach r JOIN near n ON r.vec_id = n.vec_id AND r.q = n.p),
lab AS (SELECT vec_id, p, min(q) AS z FROM reach GROUP BY ALL), num AS (SELECT vec_id, z, row_number() OVER (PARTITION BY vec_id ORDER BY z) AS id FROM (SELECT DISTINCT vec_id, z FROM lab)),
votes AS (SELECT l.vec_id, id, g % 7 AS t, count(*) FILTER (g % 7 > 0) AS n FROM lab l JOIN num USING (vec_id, z) JOIN roi r ON r.vec_id = l.vec_id AND r.y * 8 + r.x = p GROUP BY ALL),
best AS (SELECT vec_id, id, CASE WHEN n > 0 THEN t ELSE -1 END AS class_id FROM votes QUALIFY row_number() OVER (PARTITION BY vec_id, id ORDER BY n DESC, t) = 1)
SELECT vec_id, id::INT AS cell_id_in_patch, class_id::BIGINT AS class_id, CASE class_id WHEN 1 THEN 'neoplastic' WHEN 2 THEN 'inflammatory' WHEN 3 THEN 'connective' WHEN 4 THEN 'dead' WHEN 5 THEN 'epithelial' ELSE 'class_' || class_id END AS class_name FROM best""")
def instance_classes(spark: SparkSession, d: str) -> DataFrame:
    img = s.images(spark, d, 600).withColumns({"mask": pixels.threshold_mask(F.col("px")), "types": F.transform("px", lambda g: g % 7)})
    return segmentation.cells_from_masks(img, ["vec_id"], every=True).select("vec_id", "cell_id_in_patch", "class_id", "class_name")


@query(f"""WITH RECURSIVE {_WALKS}, e AS (SELECT vec_id, z, n, ps[k::INT] AS p, ps[(k % n + 1)::INT] AS q, ps[((k + n - 2) % n + 1)::INT] AS o FROM ring, range(1, n + 1) AS t(k)),
g AS (SELECT vec_id, z, abs(sum((p % 8) * (q // 8) - (q % 8) * (p // 8))) / 2 AS area, count(*) FILTER (q // 8 - p // 8 <> p // 8 - o // 8 OR q % 8 - p % 8 <> p % 8 - o % 8) AS corners FROM e GROUP BY vec_id, z)
SELECT vec_id, count(z)::BIGINT AS n_polygons, coalesce(sum(area), 0)::DOUBLE AS outline_area, coalesce(sum(corners), 0)::BIGINT AS n_vertices FROM img LEFT JOIN g USING (vec_id) GROUP BY vec_id""")
def mask_polygons(spark: SparkSession, d: str) -> DataFrame:
    img = s.images(spark, d, 600).withColumn("mask", pixels.threshold_mask(F.col("px")))
    out = geometry.mask_polygons(img, ["vec_id"])
    total = F.aggregate(F.transform("polygons", geometry.area), F.lit(0.0), lambda a, b: a + b)
    vertices = F.aggregate("polygons", F.lit(0).cast("long"), lambda a, g: a + F.size(F.get(g, F.lit(0))))
    return out.select("vec_id", F.size("polygons").cast("long").alias("n_polygons"), total.alias("outline_area"), vertices.alias("n_vertices"))


_BOX = "l_linenumber - 3 AS x0, floor(l_quantity / 10)::BIGINT - 2 AS y0, l_linenumber - 3 + l_quantity::BIGINT AS x1, floor(l_quantity / 10)::BIGINT - 2 + floor(l_discount * 100)::BIGINT + 1 AS y1"


@query(f"""WITH b AS (SELECT {', '.join(KEYS)}, {_BOX} FROM lineitem)
SELECT {', '.join(KEYS)}, (greatest(0, least(x1, 31) - greatest(x0, 0) + 1) * greatest(0, least(y1, 7) - greatest(y0, 0) + 1))::BIGINT AS area FROM b""")
def rect_raster_area(spark: SparkSession, d: str) -> DataFrame:
    boxes = _boxes(spark, d).select(*KEYS, F.array("geometry").alias("geometries"), F.lit(8).alias("h"), F.lit(32).alias("w"))
    return geometry.raster_area(boxes, list(KEYS))


@query(f"""WITH b AS (SELECT {', '.join(KEYS)}, {_BOX} FROM lineitem), p AS (SELECT * FROM b, range(0, 256) AS t(k) WHERE k % 32 BETWEEN x0 AND x1 AND k // 32 BETWEEN y0 AND y1)
SELECT {', '.join(f'b.{k}' for k in KEYS)}, coalesce(string_agg(k::VARCHAR, ',' ORDER BY k), '') AS inside FROM b LEFT JOIN p USING ({', '.join(KEYS)}) GROUP BY ALL""")
def rect_raster_mask(spark: SparkSession, d: str) -> DataFrame:
    """Which pixels of a mask are inside."""
    boxes = _boxes(spark, d).select(*KEYS, F.array("geometry").alias("geometries"), F.lit(8).alias("h"), F.lit(32).alias("w"))
    return geometry.raster_places(boxes, list(KEYS)).select(*KEYS, F.array_join(F.col("places").cast("array<string>"), ",").alias("inside"))


@query(f"""WITH b AS (SELECT {', '.join(KEYS)}, {_BOX} FROM lineitem), v AS (SELECT *, ((x1 - x0 + 1) ** 2 - 1) / 12 AS vx, ((y1 - y0 + 1) ** 2 - 1) / 12 AS vy FROM b)
SELECT {', '.join(KEYS)}, {R('4 * sqrt(greatest(vx, vy))')} AS MajorAxisLength, {R('4 * sqrt(least(vx, vy))')} AS MinorAxisLength, {R('sqrt(least(vx, vy) / greatest(vx, vy))')} AS Elongation,
 ((x1 - x0 + 1) * (y1 - y0 + 1))::DOUBLE AS PixelSurface FROM v""")
def shape2d_axes(spark: SparkSession, d: str) -> DataFrame:
    shapes = geometry.shape2d(_boxes(spark, d), list(KEYS))
    return rounded(shapes.select(*KEYS, "MajorAxisLength", "MinorAxisLength", "Elongation", "PixelSurface"))


@query(f"""WITH b AS (SELECT {', '.join(KEYS)}, {_BOX} FROM lineitem), v AS (SELECT *, (x1 - x0 + 1)::DOUBLE AS w, (y1 - y0 + 1)::DOUBLE AS h FROM b),
m AS (SELECT *, w * h - 0.5 AS surface, 2 * (w + h - 2) + 4 * sqrt(0.5) AS p FROM v)
SELECT {', '.join(KEYS)}, {R('surface')} AS MeshSurface, {R('p')} AS Perimeter, {R('p / surface')} AS PerimeterSurfaceRatio, {R('2 * sqrt(pi() * surface) / p')} AS Sphericity,
 {R('sqrt(greatest(w ** 2 + (h - 1) ** 2, (w - 1) ** 2 + h ** 2))')} AS MaximumDiameter FROM m""")
def shape2d_mesh(spark: SparkSession, d: str) -> DataFrame:
    return rounded(geometry.shape2d(_boxes(spark, d), list(KEYS)).select(*KEYS, "MeshSurface", "Perimeter", "PerimeterSurfaceRatio", "Sphericity", "MaximumDiameter"))


def _scaled(f: str, sample: str = "sample_id", final=R) -> str:
    """A feature f of a table with status, clipped and scaled within its sample."""
    q = lambda p: f"quantile_cont({f}, {p}) FILTER (status = 'ok') OVER (PARTITION BY {sample})"
    low, high = q(0.01), q(0.99)
    scaled = final(f"(greatest(least({f}, {high}), {low}) - {low}) / ({high} - {low})")
    return f"CASE WHEN status = 'ok' THEN CASE WHEN {low} IS NULL OR {low} = {high} THEN 0.0 WHEN {f} IS NULL THEN NULL ELSE {scaled} END END"


def _scaled_first(prefix: str) -> str:
    return ", ".join(f"""{_scaled(f'"{f}"')} AS "{prefix}_original_firstorder_{f}" """ for f in _FIRST)


_THRESHOLD = f"""t AS (SELECT img.vec_id, label::VARCHAR AS sample_id, coalesce(area, 0)::BIGINT AS area, CASE WHEN coalesce(area, 0) < {SMALLEST_MASK} THEN '{SKIPPED_SMALL_MASK}' ELSE 'ok' END AS status FROM img LEFT JOIN (SELECT vec_id, count(*) AS area FROM pix GROUP BY vec_id) USING (vec_id))"""


@query(f"""WITH {s.images_sql(600)}, {_first_ctes('pix')}, {_THRESHOLD}, u AS (SELECT t.*, fo.* EXCLUDE (vec_id) FROM t LEFT JOIN fo ON fo.vec_id = t.vec_id AND area >= {SMALLEST_MASK})
SELECT sample_id, vec_id AS patch_idx, status, area AS patch_mask_area, {_scaled_first('patch')} FROM u""")
def pipeline_threshold(spark: SparkSession, d: str) -> DataFrame:
    patches = s.images(spark, d, 600).withColumnRenamed("vec_id", "patch_idx")
    table = pipeline.extract(patches, None, Config(mask_source="threshold"))
    return rounded(table.select("sample_id", "patch_idx", "status", "patch_mask_area", *(f"patch_original_firstorder_{f}" for f in kernels.FIRSTORDER)))


@query(f"""WITH {s.images_sql(600)}, col AS (SELECT vec_id, k // 8 AS y, k % 8 AS x, (px[(k + 1)::INT] * 19595 + px[((k + 21) % 64 + 1)::INT] * 38470 + px[((k + 42) % 64 + 1)::INT] * 7471 + 32768) >> 16 AS g FROM img, range(0, 64) AS t(k) WHERE vec_id % 50 <> 7),
gp AS (SELECT vec_id, y, x, g, g // 25 - min(g) OVER (PARTITION BY vec_id) // 25 + 1 AS b FROM col WHERE g > 30 AND g < 220), {_first_ctes('gp')},
t AS (SELECT vec_id, label::VARCHAR AS sample_id, CASE WHEN vec_id % 50 <> 7 THEN coalesce(area, 0)::BIGINT END AS area, CASE WHEN vec_id % 50 = 7 THEN 'error' WHEN coalesce(area, 0) < {SMALLEST_MASK} THEN '{SKIPPED_SMALL_MASK}' ELSE 'ok' END AS status,
 CASE WHEN vec_id % 50 = 7 THEN 'a patch of 8 x 8 has 191 values' END AS error FROM img LEFT JOIN (SELECT vec_id, count(*) AS area FROM gp GROUP BY vec_id) USING (vec_id)),
u AS (SELECT t.*, fo.* EXCLUDE (vec_id) FROM t LEFT JOIN fo ON fo.vec_id = t.vec_id AND area >= {SMALLEST_MASK})
SELECT sample_id, vec_id AS patch_idx, status, error, area AS patch_mask_area, CASE WHEN status <> 'error' THEN 'B' || vec_id END AS barcode, {_scaled_first('patch')} FROM u""")
def pipeline_rgb(spark: SparkSession, d: str) -> DataFrame:
    """RGB patches under the names of a source; some lack a value."""
    patches = s.colour_images(spark, d, 600).withColumnRenamed("vec_id", "patch_idx")
    broken = F.when(F.col("patch_idx") % 50 == 7, F.slice("px", 1, 191)).otherwise(F.col("px"))
    source = patches.select("sample_id", "patch_idx", broken.alias("imgs"), "h", "w", F.array(F.lit(1.0), F.lit(2.0)).alias("coords"), F.concat(F.lit("B"), "patch_idx").cast("binary").alias("barcodes"))
    table = pipeline.extract(readers.patches(source), None, Config(mask_source="threshold"))
    return rounded(table.select("sample_id", "patch_idx", "status", "error", "patch_mask_area", "barcode", *(f"patch_original_firstorder_{f}" for f in kernels.FIRSTORDER)))


_CELL_BOX = ("(l_linenumber - 1)", "(l_suppkey % 5)", "(l_linenumber + 4)", "(l_suppkey % 5 + 4)")
_CELL_CTES = f"""c AS (SELECT l_orderkey AS vec_id, l_quantity, l_returnflag || l_linestatus AS cls, {_CELL_BOX[0]} AS x0, {_CELL_BOX[1]} AS y0, {_CELL_BOX[2]} AS x1, {_CELL_BOX[3]} AS y1 FROM lineitem)"""


@query(f"""WITH {s.images_sql()}, {_CELL_CTES},
hit AS (SELECT vec_id, y, x, g, g // 25 - min(g) OVER (PARTITION BY vec_id) // 25 + 1 AS b FROM (SELECT DISTINCT r.vec_id, r.y, r.x, r.g FROM raw r JOIN c ON c.vec_id = r.vec_id AND r.x BETWEEN x0 AND x1 AND r.y BETWEEN y0 AND y1)),
{_first_ctes('hit')},
ar AS (SELECT vec_id, count(*) AS area FROM hit GROUP BY vec_id),
cc AS (SELECT vec_id, count(*) AS n, count(*) FILTER (cls = 'AF') AS neo, avg(l_quantity) AS q FROM c GROUP BY vec_id),
t AS (SELECT img.vec_id, label::VARCHAR AS sample_id, coalesce(n, 0) AS n, CASE WHEN n > 0 THEN coalesce(area, 0) END AS area, coalesce(neo, 0)::DOUBLE AS neo, q, CASE WHEN n > 0 THEN 'ok' ELSE 'skipped_no_cellseg_mask' END AS status
 FROM img LEFT JOIN cc USING (vec_id) LEFT JOIN ar USING (vec_id)),
u AS (SELECT t.*, fo.* EXCLUDE (vec_id) FROM t LEFT JOIN fo ON fo.vec_id = t.vec_id AND area >= {SMALLEST_MASK})
SELECT sample_id, vec_id AS patch_idx, status, n AS n_cells_total, area AS cellseg_mask_area, neo AS dist_count_neoplastic, {R('CASE WHEN n > 0 THEN neo / n ELSE 0.0 END')} AS dist_ratio_neoplastic,
 {_scaled_first('cellseg_all')}, {_scaled('q')} AS morph_quantity_mean FROM u""")
def pipeline_cellseg(spark: SparkSession, d: str) -> DataFrame:
    table = _cellseg(spark, d, ["quantity"])
    counts = ("n_cells_total", "cellseg_mask_area", "dist_count_neoplastic", "dist_ratio_neoplastic")
    return rounded(table.select("sample_id", "patch_idx", "status", *counts, *(f"cellseg_all_original_firstorder_{f}" for f in kernels.FIRSTORDER), "morph_quantity_mean"))


def _cellseg(spark: SparkSession, d: str, measurements=()) -> DataFrame:
    patches = s.images(spark, d).withColumnRenamed("vec_id", "patch_idx")
    # lines meet their patch as they are stored, and become cells with outlines after it
    lines = of_patches(s.load(spark, d, "lineitem"), patches.select(F.col("patch_idx").alias("l_orderkey"), "sample_id"), "l_orderkey")
    cells = s.cells_of(lines).withColumn("geometry", geometry.rectangle(*map(F.expr, _CELL_BOX))).withColumnRenamed("l_quantity", "quantity")
    return pipeline.extract(patches, cells, Config(mask_source="cellseg"), list(measurements), [c for c in s.ORDER if c != "l_quantity"])


@query(f"""WITH b AS (SELECT {', '.join(KEYS)}, {_BOX} FROM lineitem), n AS (SELECT *, CASE l_linenumber % 3 WHEN 0 THEN 2 WHEN 1 THEN 1 ELSE 0 END AS n FROM b)
SELECT {', '.join(KEYS)}, n::INT AS n_polygons, CASE n WHEN 1 THEN 1 + 4 + 4 + 4 + 16 * 5 WHEN 2 THEN 9 + 2 * (9 + 4 + 16 * 5) ELSE 9 END AS n_bytes, {R('n * (x1 - x0) * (y1 - y0)')} AS area,
 CASE WHEN n > 0 THEN x0::DOUBLE END AS xmin, CASE WHEN n > 0 THEN y0::DOUBLE END AS ymin, CASE n WHEN 1 THEN x1 WHEN 2 THEN x1 + 100 END::DOUBLE AS xmax, CASE n WHEN 1 THEN y1 WHEN 2 THEN y1 + 50 END::DOUBLE AS ymax FROM n""")
def wkb_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of no, one and two polygons written as well-known binary and read back."""
    g = F.col("geometry")
    moved = F.transform(g, lambda ring: F.transform(ring, lambda p: F.struct((p["x"] + 100).alias("x"), (p["y"] + 50).alias("y"))))
    kind = F.col("l_linenumber") % 3
    cells = _boxes(spark, d).select(*KEYS, F.when(kind == 0, F.array(g, moved)).when(kind == 1, F.array(g)).otherwise(F.array().cast(geometry.GEOMETRIES)).alias("polygons"))
    binary = cells.select(*KEYS, geometry.to_wkb("polygons").alias("wkb"))
    back = binary.select(*KEYS, F.octet_length("wkb").alias("n_bytes"), geometry.from_wkb("wkb").alias("polygons"))
    area = F.aggregate(F.transform("polygons", geometry.area), F.lit(0.0), lambda a, b: a + b)
    made = back.select(*KEYS, F.size("polygons").alias("n_polygons"), "n_bytes", area.alias("area"), geometry.bounds(F.col("polygons")).alias("box"))
    return rounded(made.select(*KEYS, "n_polygons", "n_bytes", "area", "box.*"))


#: Corners of a concave outline with slanted edges between pixels, and of the triangle that is cut out of it.
_CORNERS = (("ax", "ay"), ("ax + w", "ay + h / 3"), ("ax + w / 2", "ay + h / 2"), ("ax + w * 0.8", "ay + h"), ("ax - 2.5", "ay + h * 0.7"))
_HOLE = (("ax + w / 8", "ay + h / 8"), ("ax + w / 3", "ay + h / 3"), ("ax + w / 9", "ay + h / 2"))
_FRAME = {"ax": "l_linenumber * 1.75 - 3.4", "ay": "l_quantity / 9 - 2.3", "w": "l_quantity / 2.25 + 3", "h": "l_discount * 64 + 6.5"}


def _slanted_sql() -> str:
    """Spans by the rule of the scan conversion, row by row: crossings of edges in 32 bits, ends of edges twice but in the last row, in pairs."""
    corner = " UNION ALL ".join(f"SELECT id, {r} AS ring, {k} AS k, trunc({x})::BIGINT AS x, trunc({y})::BIGINT AS y FROM f" for r, corners in enumerate((_CORNERS, _HOLE)) for k, (x, y) in enumerate(corners))
    up, down = "CASE WHEN xx < 0 THEN -floor(abs(xx) + 0.5::FLOAT) ELSE floor(xx + 0.5::FLOAT) END", "CASE WHEN xb < 0 THEN -ceil(abs(xb) - 0.5::FLOAT) ELSE ceil(xb - 0.5::FLOAT) END"
    return f"""WITH l AS (SELECT row_number() OVER () AS id, {', '.join(f'{e} AS {c}' for c, e in _FRAME.items())}, {', '.join(KEYS)} FROM lineitem), f AS (SELECT id, {', '.join(f'{c}::DOUBLE AS {c}' for c in _FRAME)} FROM l),
v AS ({corner}), e AS (SELECT id, ring, x AS x0, y AS y0, coalesce(lead(x) OVER r, first_value(x) OVER r) AS x1, coalesce(lead(y) OVER r, first_value(y) OVER r) AS y1, max(y) OVER (PARTITION BY id, ring) AS last FROM v WINDOW r AS (PARTITION BY id, ring ORDER BY k)),
c AS (SELECT id, ring, y, least(y0, y1) AS lo, greatest(y0, y1) AS hi, last, ((y - y0)::FLOAT * ((x1 - x0)::FLOAT / (y1 - y0)::FLOAT) + x0::FLOAT)::FLOAT AS xx FROM e, range(0, 16) AS t(y) WHERE y0 <> y1 AND y BETWEEN least(y0, y1) AND greatest(y0, y1)),
d AS (SELECT id, ring, y, xx FROM c UNION ALL SELECT id, ring, y, xx FROM c WHERE y = hi AND y < last),
o AS (SELECT *, lead(xx) OVER w AS xb, row_number() OVER w AS n FROM d WINDOW w AS (PARTITION BY id, ring, y ORDER BY xx)),
s AS (SELECT id, ring, y, ({up})::BIGINT AS a, ({down})::BIGINT AS b FROM o WHERE n % 2 = 1 AND xb IS NOT NULL UNION ALL SELECT id, ring, y0, least(x0, x1), greatest(x0, x1) FROM e WHERE y0 = y1 AND y0 BETWEEN 0 AND 15),
p AS (SELECT id, y * 32 + x AS k, max(ring) AS ring FROM s, range(0, 32) AS t(x) WHERE x BETWEEN a AND b GROUP BY ALL),
g AS (SELECT id, count(*) AS area, sum(k)::BIGINT AS places, sum(k * k)::BIGINT AS squares FROM p WHERE ring = 0 GROUP BY id)
SELECT {', '.join(KEYS)}, coalesce(area, 0)::BIGINT AS area, coalesce(places, 0)::BIGINT AS places, coalesce(squares, 0)::BIGINT AS squares FROM l LEFT JOIN g USING (id)"""


@query(_slanted_sql())
def slanted_raster(spark: SparkSession, d: str) -> DataFrame:
    """Which pixels slanted, concave outlines with a hole cover: their number, and sums over their places and squared places."""
    f = s.load(spark, d, "lineitem").select(*KEYS, *(F.expr(e).cast("double").alias(c) for c, e in _FRAME.items()))
    ring = lambda corners: F.array(*(F.struct(F.expr(x).cast("double").alias("x"), F.expr(y).cast("double").alias("y")) for x, y in corners))
    cells = f.select(*KEYS, F.array(F.array(ring(_CORNERS), ring(_HOLE))).alias("geometries"), F.lit(16).alias("h"), F.lit(32).alias("w"))
    total = lambda g: F.aggregate("places", F.lit(0).cast("long"), lambda a, k: a + g(k.cast("long")))
    return geometry.raster_places(cells, list(KEYS)).select(*KEYS, F.size("places").cast("long").alias("area"), total(lambda k: k).alias("places"), total(lambda k: k * k).alias("squares"))


_SHAPES = {
    "meshsurface": "w * h - 0.5", "pixelsurface": "w * h", "perimeter": "2 * (w + h - 2) + 4 * sqrt(0.5)", "perimetersurfaceratio": "(2 * (w + h - 2) + 4 * sqrt(0.5)) / (w * h - 0.5)",
    "sphericity": "2 * sqrt(pi() * (w * h - 0.5)) / (2 * (w + h - 2) + 4 * sqrt(0.5))", "maximumdiameter": "sqrt(greatest(w ** 2 + (h - 1) ** 2, (w - 1) ** 2 + h ** 2))",
    "majoraxislength": "4 * sqrt((greatest(w, h) ** 2 - 1) / 12)", "minoraxislength": "4 * sqrt((least(w, h) ** 2 - 1) / 12)", "elongation": "sqrt((least(w, h) ** 2 - 1) / (greatest(w, h) ** 2 - 1))",
}


def _shapes_sql() -> str:
    every = " UNION ALL ".join(f"SELECT vec_id, '{k}' AS shape, round({v}, 10) AS v FROM box" for k, v in _SHAPES.items())
    z = "((v - m) / nullif(s, 0))"
    stats = {
        "mean": "avg(v)", "median": "quantile_cont(v, 0.5)", "minimum": "min(v)", "maximum": "max(v)", "range": "max(v) - min(v)", "variance": "var_pop(v)", "standarddeviation": "stddev_pop(v)",
        "p10": "quantile_cont(v, 0.1)", "p25": "quantile_cont(v, 0.25)", "p75": "quantile_cont(v, 0.75)", "p90": "quantile_cont(v, 0.9)", "iqr": "quantile_cont(v, 0.75) - quantile_cont(v, 0.25)",
        "meanabsolutedeviation": "avg(abs(v - m))", "skewness": f"CASE WHEN min(v) = max(v) THEN 0.0 ELSE avg(pow({z}, 3)) END", "kurtosis": f"CASE WHEN min(v) = max(v) THEN 0.0 ELSE avg(pow({z}, 4)) - 3 END",
        "entropy": "any_value(en)", "energy": "sum(v * v)", "rootmeansquared": "sqrt(avg(v * v))",
    }
    long = " UNION ALL ".join(f"SELECT vec_id, 'morph_' || shape || '_{k}' AS feature, {k} AS v FROM st" for k in stats)
    return f"""WITH {s.images_sql()}, {_CELL_CTES}, box AS (SELECT vec_id, (least(x1, 7) - x0 + 1)::DOUBLE AS w, (least(y1, 7) - y0 + 1)::DOUBLE AS h FROM c JOIN (SELECT vec_id FROM img) USING (vec_id)),
sh AS ({every}), b1 AS (SELECT *, min(v) OVER g AS lo, max(v) OVER g AS hi, count(*) OVER g AS n, least(16, greatest(2, count(*) OVER g)) AS bins FROM sh WINDOW g AS (PARTITION BY vec_id, shape)),
b2 AS (SELECT vec_id, shape, any_value(n) AS n, count(*) AS k, any_value(lo) AS lo, any_value(hi) AS hi FROM b1 GROUP BY vec_id, shape, CASE WHEN hi > lo THEN least(floor((v - lo) / ((hi - lo) / bins))::BIGINT, bins - 1) ELSE 0 END),
b3 AS (SELECT vec_id, shape, CASE WHEN any_value(lo) = any_value(hi) THEN 0.0 ELSE -sum(k::DOUBLE / n * log2(k::DOUBLE / n)) END AS en FROM b2 GROUP BY vec_id, shape),
mo AS (SELECT vec_id, shape, avg(v) AS m, stddev_pop(v) AS s FROM sh GROUP BY vec_id, shape),
st AS (SELECT vec_id, shape, {', '.join(f'{v} AS {k}' for k, v in stats.items())} FROM sh JOIN b3 USING (vec_id, shape) JOIN mo USING (vec_id, shape) GROUP BY vec_id, shape),
u AS (SELECT vec_id, label::VARCHAR AS sample_id, feature, v, 'ok' AS status FROM ({long}) JOIN (SELECT vec_id, label FROM img) USING (vec_id))
SELECT sample_id, vec_id AS patch_idx, feature, {_scaled('v', 'sample_id, feature')} AS value FROM u"""


@query(_shapes_sql())
def pipeline_cellseg_shapes(spark: SparkSession, d: str) -> DataFrame:
    """The 162 shape statistics of patches with cells, made long."""
    table = _cellseg(spark, d).where("status = 'ok'")
    names = [f"morph_{m}" for m in texture.MORPHOLOGY]
    return rounded(table.select("sample_id", "patch_idx", F.inline(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in names)))))


@query(_glcm_sql().replace(_PAIRS, _PAIRS.replace("(0, 0, 1), (1, 1, 0), (2, 1, 1), (3, 1, -1)", "(0, 0, 1)")))
def glcm_features_axis(spark: SparkSession, d: str) -> DataFrame:
    """Texture along one axis, the other preset of directions."""
    img = s.images(spark, d).withColumnsRenamed({"vec_id": "patch_idx"})
    made = pipeline.threshold_features(img, Config(directions="axis"), smallest=1)
    names = [f"glcm_{f}" for f in kernels.GLCM if f != "MCC"]
    return rounded(made.select(F.col("patch_idx").alias("vec_id"), *((F.col(f"patch_original_{f}") / _SCALE.get(f, 1.0)).alias(f) for f in names)))


@query(f"""WITH {s.images_sql()}, sq AS (SELECT vec_id, g, (g / sqrt(max(g) OVER (PARTITION BY vec_id))) ** 2 AS v FROM raw)
SELECT vec_id, {R('avg(v)')} AS "square_firstorder_Mean", {R('min(v)')} AS "square_firstorder_Minimum", {R('quantile_cont(v, 0.5)')} AS "square_firstorder_Median", {R('var_pop(v) / 1e4')} AS "square_firstorder_Variance" FROM sq WHERE g > 30 AND g < 220 GROUP BY vec_id""")
def filtered_features(spark: SparkSession, d: str) -> DataFrame:
    """Features of an image type besides the original."""
    img = s.images(spark, d).withColumnRenamed("vec_id", "patch_idx")
    made = pipeline.threshold_features(img, Config(filters=("Original", "Square")), smallest=1).where("patch_mask_area > 0")
    names = [f"square_firstorder_{f}" for f in ("Mean", "Minimum", "Median", "Variance")]
    return rounded(made.select(F.col("patch_idx").alias("vec_id"), *((F.col(f"patch_{f}") / (1e4 if f.endswith("Variance") else 1)).alias(f) for f in names)))


@query(f"""WITH {s.images_sql(600)}, {_THRESHOLD}, f AS (SELECT vec_id, avg(g) AS m FROM pix GROUP BY vec_id), u AS (SELECT t.*, m FROM t LEFT JOIN f ON f.vec_id = t.vec_id AND area >= {SMALLEST_MASK})
SELECT sample_id, vec_id AS patch_idx, 'patch_original_firstorder_Mean' AS feature, 5::BIGINT AS place, 93::BIGINT AS features, {_scaled('m', final='round(({})::FLOAT::DOUBLE, 6)'.format)} AS value FROM u""")
def processed_matrix(spark: SparkSession, d: str) -> DataFrame:
    """One column of the feature matrix with its name and place in var."""
    table = pipeline.extract(s.images(spark, d, 600).withColumnRenamed("vec_id", "patch_idx"), None, Config())
    made = sinks.matrix(table)
    place = made["var"].where("feature = 'patch_original_firstorder_Mean'").agg(F.max("place")).scalar()
    value = F.get("X", place.cast("int"))
    return made["X"].select("sample_id", "patch_idx", F.lit("patch_original_firstorder_Mean").alias("feature"), place.alias("place"), F.size("X").cast("long").alias("features"), F.round(value.cast("double"), 6).alias("value"))
