"""The queries of the text operators, one per operator, over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, language_id, line_dedup, merkle, mixing, ngram_join, packing, quality_rules, secret_scan, suffix_dedup, url_filters, warc
from .common import materialise, new_path, small_batches, table


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"), ["page_id"])


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language_id.predict(docs, language_id.learn(docs), ["doc_id"])
    return out.select("doc_id", (language_id.remainder(F.col("doc_id")) == 2).alias("held_out"), "lang_pred", "score")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_site_boilerplate(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    kept = F.size("lines").cast("long")
    return out.select("page_id", "host", "n_lines", kept.alias("n_kept"), (F.col("n_lines") - kept).alias("n_dropped"), F.sha2(F.array_join("lines", "\n"), 256).alias("kept_sha256"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    words = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", F.size("spans").cast("long").alias("n_spans"), words.alias("n_repeated_words"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), (F.col("mix_copies") * F.col("mix_size")).alias("taken"), "source", F.col("mix_copies").alias("copies"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = materialise(quality_rules.measure(table(spark, sf_dir, "documents"), ["doc_id", "lang"]))
    rules = quality_rules.fit(measured, table(spark, sf_dir, "labels"), "lang")
    return rules.judge(measured, "lang").select("doc_id", *quality_rules.MEASURES[:5], "base_failed", "kept", "score", "cutoff")


def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark)
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_described(spark, path)


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents")).drop("lang")


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(table(spark, sf_dir, "documents"), ["doc_id"])
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    counts = (F.size(of(k)).cast("long").alias(f"n_{k}") for k in secret_scan.STRONG)
    return out.select("doc_id", *counts, F.sha2(secret_scan.written(of(*secret_scan.STRONG)), 256).alias("base_sha256"), secret_scan.written(F.col("secrets")).alias("spans"))


_QUERIES = (
    op1_url_filters, op2_language_id, op3_line_dedup, op4_suffix_array_dedup, op5_exact_dedup,
    op6_best_fit_packing, op7_source_mixing, op8_quality_rules, op9_warc_archive, op10_ngram_jaccard,
    op11_merkle_manifest, op12_secret_scan,
)


def _batched(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: _batched(f) for f in _QUERIES}


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field_sql(n_chars if c == "n_chars" else c) for c in merkle.FIELDS) + ")"


def _tree_sql(name: str, first: str) -> str:
    """A recursive CTE (k, lvl, pos, h, cnt) of the trees over leaves."""
    return f"""{name}(k, lvl, pos, h, cnt) AS ({first} UNION ALL
    SELECT k, lvl + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (cnt + 1) // 2 FROM {name} WHERE cnt > 1 GROUP BY k, lvl, cnt, pos // 2)"""


def _steps_sql(tree: str, start: str, first: int) -> str:
    """Steps (rid, turn, step) up a tree: L or R and the sibling there, or N for none."""
    return f"""SELECT p.rid, {first} + a.lvl AS turn, CASE WHEN b.h IS NULL THEN 'N' WHEN b.pos < a.pos THEN 'L' || b.h ELSE 'R' || b.h END AS step FROM {start} p
    JOIN {tree} a ON a.k = p.k AND a.cnt > 1 AND a.pos = p.pos >> a.lvl LEFT JOIN {tree} b ON b.k = a.k AND b.lvl = a.lvl AND b.pos = xor(a.pos, 1)"""


_MERKLE_SQL = f"""
WITH RECURSIVE bits AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))),
d AS (SELECT row_number() OVER () AS rid, doc_id, n_chars, coalesce('=' || lang, '') AS k, {_leaf_sql('n_chars')} AS leaf, {_leaf_sql('n_chars + 1')} AS changed,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 AS hit FROM documents, bits),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS pos, count(*) OVER (PARTITION BY k) AS cnt FROM d),
{_tree_sql('n', 'SELECT k, 0, pos, leaf, cnt FROM o')},
t AS (SELECT k, h, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS cnt FROM n WHERE cnt = 1),
{_tree_sql('m', "SELECT '', 0, pos, h, cnt FROM t")},
u AS (SELECT o.rid, '' AS k, t.pos FROM o JOIN t USING (k)),
s AS ({_steps_sql('n', 'o', 0)} UNION ALL {_steps_sql('m', 'u', 1000)}),
p AS (SELECT rid, list(step ORDER BY turn) AS steps FROM s GROUP BY rid)
SELECT doc_id, leaf, t.h AS subroot, r.h AS root, sha256(coalesce(array_to_string(list_transform(steps, lambda x: x[2:]), ''), '')) AS proof_sha256, f AS folded_root, f = r.h AS verified
FROM (SELECT o.*, p.steps, list_reduce(list_prepend(CASE WHEN hit AND n_chars IS NOT NULL THEN changed ELSE leaf END, coalesce(steps, [])),
    lambda a, x: CASE x[1] WHEN 'L' THEN sha256(x[2:] || a) WHEN 'R' THEN sha256(a || x[2:]) ELSE sha256(a) END) AS f
    FROM o LEFT JOIN p USING (rid)) x JOIN t USING (k), (SELECT h FROM m WHERE cnt = 1) r"""


def _secrets_sql() -> str:
    quoted = {k: p.replace("'", "''") for k, (p, _, _) in secret_scan.KINDS.items()}
    number = secret_scan.NAMES.index
    found = " UNION ALL ".join(
        f"SELECT rid, {number(k)} AS kind, regexp_extract_all(t, '{quoted[k]}') AS w, regexp_extract_all(t, '{quoted[k]}', {group}) AS v, regexp_split_to_array(t, '{quoted[k]}') AS p FROM d WHERE regexp_matches(t, '{quoted[k]}')"
        for k, (_, group, _) in secret_scan.KINDS.items()
    )
    least = " ".join(f"WHEN {number(k)} THEN {n}" for k, (_, _, n) in secret_scan.KINDS.items())
    mixed = " AND ".join(f"regexp_matches(w, '{m}')" for m in secret_scan.MIXED)
    of = lambda kinds: f"kind IN ({', '.join(str(number(k)) for k in kinds)})"
    strong, near = of(secret_scan.STRONG), f"a.rid = b.rid AND a.s <= b.e + {secret_scan.REACH} AND b.s <= a.e + {secret_scan.REACH} AND NOT (a.s < b.e AND b.s < a.e)"
    names = "[" + ", ".join(f"'{k}'" for k in secret_scan.NAMES) + "]"
    text = lambda where: f"coalesce(string_agg({names}[kind + 1] || ':' || s || ':' || e, ',' ORDER BY s, kind) FILTER ({where}), '')"
    counts = ", ".join(f"count(*) FILTER (kind = {number(k)}) AS n_{k}" for k in secret_scan.STRONG)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents), f AS ({found}),
g AS (SELECT rid, kind, k, w[k] AS w, v[k] AS v, length(p[k]) AS gap FROM f, unnest(range(1, len(w) + 1)) AS r(k)),
h AS (SELECT rid, kind, w, v, (sum(gap + length(w)) OVER (PARTITION BY rid, kind ORDER BY k))::BIGINT AS e FROM g),
sp AS (SELECT rid, kind, e - length(w) AS s, e FROM h WHERE length(v) >= CASE kind {least} END AND (kind <> {number('blob')} OR ({mixed}))),
parts AS (SELECT * FROM sp a WHERE {strong} OR NOT EXISTS (SELECT 1 FROM sp b WHERE b.rid = a.rid AND b.{strong} AND a.s < b.e AND b.s < a.e)),
i AS (SELECT * FROM parts a WHERE {of(secret_scan.IDENTIFIERS)} AND EXISTS (SELECT 1 FROM parts b WHERE b.{of(secret_scan.SECRETS)} AND {near})),
x AS (SELECT * FROM parts WHERE {strong} UNION ALL SELECT * FROM i WHERE NOT {strong}
    UNION ALL SELECT * FROM parts a WHERE ({of(('key', 'blob', 'endpoint'))}) AND EXISTS (SELECT 1 FROM i b WHERE {near}))
SELECT doc_id, {counts}, sha256({text(strong)}) AS base_sha256, {text('kind IS NOT NULL')} AS spans FROM d LEFT JOIN x USING (rid) GROUP BY rid, doc_id"""


_SQL = {
    "op3_line_dedup": rf"""
WITH p AS (SELECT row_number() OVER () AS row_id, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    list_filter(list_transform(regexp_split_to_array(coalesce(html, ''), '{line_dedup.BREAK}'), lambda x: regexp_replace(x, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')), lambda x: x <> '') AS lines FROM pages),
totals AS (SELECT host, count(*) AS pages FROM p GROUP BY host),
counts AS (SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM p) GROUP BY host, line),
boiler AS (SELECT host, list(line) AS boiler FROM counts JOIN totals USING (host) WHERE n >= 3 AND n > 0.3 * pages GROUP BY host),
kept AS (SELECT page_id, host, lines, list_filter(lines, lambda x: NOT coalesce(list_contains(boiler, x), false)) AS kept FROM p LEFT JOIN boiler USING (host))
SELECT page_id, host, len(lines)::BIGINT AS n_lines, len(kept)::BIGINT AS n_kept, (len(lines) - len(kept))::BIGINT AS n_dropped, sha256(coalesce(array_to_string(kept, chr(10)), '')) AS kept_sha256 FROM kept""",
    "op4_suffix_array_dedup": r"""
WITH d AS (SELECT doc_id, coalesce('d' || doc_id, 'r' || row_number() OVER ()) AS own, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
r AS (SELECT own, doc_id, w, unnest(range(1, len(w) - 48)) AS pos FROM d),
k AS (SELECT own, doc_id, pos, hash(array_to_string(w[pos:pos + 49], ' ')) AS h FROM r),
m AS (SELECT own, doc_id, pos FROM k WHERE h IN (SELECT h FROM k GROUP BY h HAVING count(DISTINCT own) > 1)),
e AS (SELECT DISTINCT own, doc_id, pos FROM m),
g AS (SELECT own, doc_id, pos, pos - coalesce(lag(pos) OVER (PARTITION BY own ORDER BY pos), -1000) AS gap FROM e)
SELECT doc_id, count(*) FILTER (gap > 50)::BIGINT AS n_spans, sum(least(gap, 50))::BIGINT AS n_repeated_words FROM g GROUP BY own, doc_id""",
    "op5_exact_dedup": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size, row_number() OVER (PARTITION BY text, doc_id) AS rn FROM d)
SELECT doc_id, keep_id, group_size::BIGINT AS group_size, (doc_id IS NOT DISTINCT FROM keep_id AND rn = 1) AS kept, sha256(text) AS text_sha256 FROM g""",
    "op7_source_mixing": r"""
WITH d AS (SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rn FROM d GROUP BY source),
s1 AS (SELECT *, CASE (rn - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * source_size AS cap FROM s0),
s2 AS (SELECT *, cap::DOUBLE / w AS full_at FROM s1),
s3 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0))::DOUBLE / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level FROM s2
    WINDOW b AS (ORDER BY full_at, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT level FROM s3 WHERE level <= full_at ORDER BY full_at, rn LIMIT 1),
s4 AS (SELECT source, source_size, least(cap::DOUBLE, (SELECT level FROM l) * w) AS target,
    (('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 8))::BIGINT::DOUBLE + 0.5) / 4294967296.0 AS u FROM s3),
r AS (SELECT d.*, source_size, target, u, CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size END AS due,
    row_number() OVER (PARTITION BY d.source ORDER BY floor(sqrt(size)), key) AS k
    FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source),
c AS (SELECT *, (floor(u + due * k::DOUBLE) - floor(u + due * (k - 1)::DOUBLE))::BIGINT AS copies FROM r)
SELECT doc_id, size, source_size, target, copies * size AS taken, source, copies FROM c""",
    "op10_ngram_jaccard": r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
d AS (SELECT rid, doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w),
g AS (SELECT rid, len(s) AS n, unnest(s) AS gram FROM d),
r AS (SELECT rid, gram, n, row_number() OVER (PARTITION BY rid ORDER BY df, gram) AS pos FROM g JOIN (SELECT gram, count(*) AS df FROM g GROUP BY gram) USING (gram)),
p AS (SELECT rid, gram, n FROM r WHERE pos <= n - (80 * n + 99) // 100 + 1),
c AS (SELECT DISTINCT a.rid AS x, b.rid AS y FROM p a JOIN p b ON a.gram = b.gram AND a.rid < b.rid AND 80 * a.n <= 100 * b.n AND 80 * b.n <= 100 * a.n),
i AS (SELECT x, y, len(a.s) + len(b.s) AS total, len(list_intersect(a.s, b.s)) AS common FROM c JOIN d a ON a.rid = x JOIN d b ON b.rid = y),
e AS (SELECT x, y FROM i WHERE 100 * common >= 80 * (total - common) UNION ALL SELECT y, x FROM i WHERE 100 * common >= 80 * (total - common)),
t AS (SELECT rid, rid AS top FROM d UNION SELECT e.y, t.top FROM t JOIN e ON e.x = t.rid),
k AS (SELECT t.rid, min(o.doc_id) AS component_id FROM t JOIN d o ON o.rid = t.top GROUP BY t.rid)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id FROM d JOIN k USING (rid)""",
    "op9_warc_archive": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, url FROM pages),
h AS (SELECT *, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS hexed, max(page_id) OVER (PARTITION BY html) AS owner,
    row_number() OVER (PARTITION BY html ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS rn FROM p)
SELECT page_id, payload_bytes,
    list_aggregate(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hexed, (1 + 10 * (k // 8))::INT, 10))::BIGINT >> (35 - 5 * (k % 8))::INT) & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
    CASE WHEN rn = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN rn > 1 THEN owner END AS refers_to FROM h""",
    "op11_merkle_manifest": _MERKLE_SQL,
    "op12_secret_scan": _secrets_sql(),
}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
