"""Text operators on repeated ids, large ids, ties, hot groups and clashing names."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from spatialfeat.llm import exact_dedup, language_id, line_dedup, mixing, ngram_join, packing, quality_rules, suffix_dedup, url_filters

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
DATA = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


# ------------------------------------------------------------ url filters


def test_long_names_are_split_whole():
    model = url_filters.Words({"casino": 50, "no": 60, "casi": 2}, 200)
    assert model.split("x" * 60 + "casino") == ["x" * 60, "casino"] and model.split("casino" * 40) == ["casino"] * 40
    long = "q" * 5000
    assert model.split(long) == [long]


def test_viterbi_with_long_words_matches_brute_force():
    rnd = random.Random(4)
    for _ in range(20):
        counts = {"".join(rnd.choices("ab", k=rnd.randint(1, 5))): rnd.randint(1, 50) for _ in range(8)}
        model = url_filters.Words(counts, 300)
        for _ in range(10):
            name = "".join(rnd.choices("ab", k=rnd.randint(1, 11)))
            best = [0.0] + [math.inf] * len(name)
            for end in range(1, len(name) + 1):
                best[end] = min(best[at] + model.cost(name[at:end]) for at in range(end))
            assert sum(map(model.cost, model.split(name))) == pytest.approx(best[-1]) and "".join(model.split(name)) == name


def test_bayes_learns_from_rules_and_holds_out(spark):
    rnd = random.Random(6)
    vocabulary = {"net": ["bets", "jackpot", "loans", "pills"], "org": ["library", "museum", "school", "garden"]}
    rows = []
    for i in range(600):
        top = rnd.choice(["net", "org", "info"])
        kind = top if top != "info" else rnd.choice(["net", "org"])
        path = "fr" if top == "org" else "en"
        rows.append((i, f"http://{''.join(rnd.choices(vocabulary[kind], k=2))}{i % 7}.site.{top}/{path}/{rnd.choice(vocabulary[kind])}", kind))
    pages = spark.createDataFrame(rows, "page_id long, url string, kind string").withColumn("html", F.lit(" ".join(sum(vocabulary.values(), []) * 5)))
    out = url_filters.judge(pages, ["page_id", "kind"], block_words=[], allow_words=[], cutoff=0.5, train=F.col("page_id") % 4 != 2).collect()
    held = [r for r in out if r.page_id % 4 == 2]
    assert np.mean([(r.score > 0.5) == (r.kind == "net") for r in held]) > 0.95 and len({r.score for r in out}) > 10
    # the model against counts by hand
    split = url_filters.parts_of(pages, [])
    words = url_filters.word_counts(pages, seeds=())
    bayes = url_filters.learn(split, spark.sparkContext.broadcast(words), block_words=[], allow_words=[])
    counts, hosts = {"net": Counter(), "org": Counter()}, defaultdict(set)
    for _, url, _ in rows:
        host, _, path = url.split("://")[1].partition("/")
        if not host.endswith("info"):
            for run in url_filters.runs_of(*url_filters.undecided(host, "/" + path, 2, 1)):
                for w in words.split(run):
                    counts[host[-3:]][w] += 1
                    hosts[w].add(host)
    counts = {k: Counter({w: n for w, n in c.items() if len(hosts[w]) > 1}) for k, c in counts.items()}
    every = {*counts["net"], *counts["org"]}
    log = lambda k, w: math.log((counts[k][w] + 1) / (counts[k].total() + len(every)))
    assert bayes.logs == pytest.approx({w: log("net", w) - log("org", w) for w in every})


def test_host_path_and_rule_match_sql(spark):
    sql = r"""
    WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    r AS (SELECT * FROM (VALUES ('block', 'net/'), ('allow', 'example.net/en/'), ('block', 'example.com/de/'), ('allow', 'org/fr/')) AS t(act, rule)),
    s AS (SELECT *, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS q FROM r),
    f AS (SELECT page_id, arg_max(rule, len(rule)) AS rule, arg_max(act, len(rule)) AS act FROM p JOIN s ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id)
    SELECT page_id, host, path, rule, act FROM p LEFT JOIN f USING (page_id)"""
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{DATA}/pages.parquet'")
    want = {r[0]: r[1:] for r in con.sql(sql).fetchall()}
    for r in url_filters.judge(spark.read.parquet(f"{DATA}/pages.parquet"), ["page_id"]).collect():
        assert (r.host, r.path, r.rule) == want[r.page_id][:3] and (want[r.page_id][3] is None or r.verdict == want[r.page_id][3])


# ------------------------------------------------------------ language identification


def test_no_language_vanishes(spark):
    en = [(11, f"the quick brown fox {k} jumps over the lazy dog", "en", None, 0) for k in range(500)]
    fr = [(100 + k, f"le renard brun {k} saute par dessus le chien", "fr", None, 0) for k in range(200)]
    de = [(12, "der schnelle braune fuchs springt " * 2000, "de", None, 0)]
    model = language_id.learn(spark.createDataFrame(en + fr + de, SCHEMA), rows=50, longest=1 << 10)
    assert model.langs == ["de", "en", "fr"]
    same = language_id.learn(spark.createDataFrame([en[0]] * 300 + fr, SCHEMA), rows=50)
    assert same.langs == ["en", "fr"]


def test_languages_and_bytes_are_bounded(spark):
    rows = [(k, f"word{k % 30} text {k}", f"l{k % 30:02}", None, 0) for k in range(600)] + [(1000 + k, "abc def", "zz", None, 0) for k in range(9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert len(language_id.learn(docs, most_langs=10).langs) == 10
    tiny = language_id.learn(docs, total=31)
    assert len(tiny.langs) == 31
    whole = language_id.Model.trained({"a": [b"the cat sat"], "b": [b"le chat est"]}, 3)
    cut = language_id.Model.trained({"a": [b"the cat sat"], "b": [b"le chat est"]}, 3, most=6)
    data = np.frombuffer(b"the chat sat la", np.uint8)
    assert cut.bits(data, np.array([0, 15])) == pytest.approx(whole.bits(data, np.array([0, 15])), rel=1e-6)


def test_held_out_accuracy_on_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language_id.predict(docs, language_id.learn(docs), ["doc_id", "lang"]).where(language_id.remainder(F.col("doc_id")) == 2)
    right = out.where("lang = lang_pred").count()
    assert right >= 0.98 * out.where("lang IS NOT NULL AND lang_pred <> 'und'").count()


# ------------------------------------------------------------ exact dedup, mixing: ties


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [(1, "same text", lang, source, 9) for lang in ("en", "de", None) for source in ("a", "b", None)] + [(None, "x y", "fr", s, 1) for s in ("p", "q")] + [(2, f"text {k % 3}", "en", "a", k) for k in range(30)]
    got = []
    for seed in (1, 2, 3):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, SCHEMA).repartition(seed)
        got.append((rows_of(exact_dedup.dedup(docs)), rows_of(mixing.mixed(docs)), rows_of(mixing.mix(docs))))
    assert got[0] == got[1] == got[2]


def test_order_of_mixing_is_free_of_the_row_count(spark):
    """Adding another source changes no rank within a source: with equal due, the same documents are drawn."""
    rows = [(i, "w " * (1 + i % 50), None, "s", 0) for i in range(500)]
    small = {r.doc_id: r.mix_copies for r in mixing.mix(spark.createDataFrame(rows, SCHEMA), weights=(1,)).collect()}
    twin = rows + [(10_000 + i, "w " * (1 + i % 50), None, "t", 0) for i in range(500)]
    large = {r.doc_id: r.mix_copies for r in mixing.mix(spark.createDataFrame(twin, SCHEMA), weights=(1,)).collect() if r.source == "s"}
    assert small == large


def test_many_equal_rows_are_mixed_as_one_run(spark):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("a b c").alias("text"), F.lit("x").alias("source")).unionByName(
        spark.range(50).select(F.col("id").alias("doc_id"), F.lit("d e f g").alias("text"), F.lit("y").alias("source"))
    )
    got = mixing.mix(docs).collect()
    assert len(got) == 3050 and all(0 <= r.mix_copies <= 3 for r in got)
    assert mixing.mixed(docs).count() == sum(r.mix_copies for r in got)


# ------------------------------------------------------------ packing


def test_large_ids_beside_null_ids(spark):
    rows = [((1 << 60) + 1, "a b c", None, "s", 0), (None, "d e", None, "s", 0), ((1 << 53) + 1, "f", None, None, 0)]
    got = packing.pack(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id for r in got} == {(1 << 60) + 1, None, (1 << 53) + 1}


def test_packing_matches_a_plain_best_fit():
    rnd = random.Random(9)
    rows = [(rnd.choice([None, *range(80)]), rnd.randint(0, 150), rnd.choice([None, "a", "b", "c"]), rnd.choice([None, None, "k1", "k2", "k3"])) for _ in range(250)]
    got = packing.pack_rows(7, rows, 60, 2)
    pieces, rests = [], []
    for id, size, source, cluster in rows:
        n = 0
        while size > 60:
            pieces.append((id, n, 60, source, cluster))
            size, n = size - 60, n + 1
        rests.append((id, n, size, source, cluster))
    rests.sort(key=lambda r: (-r[2], r[0] is not None, r[0] or 0, r[1], r[3] or "", r[4] or ""))
    bins: list[dict] = []
    for id, n, size, source, cluster in rests:
        fits = [(b["left"], k) for k, b in enumerate(bins) if b["left"] >= size and (cluster is None or cluster not in b["clusters"]) and (source is None or b["sources"][source] < 2)]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"left": 60, "clusters": set(), "sources": Counter()})
        b = bins[k]
        pieces.append((id, n, size, source, cluster, f"7-{k}", 60 - b["left"]))
        b["left"] -= size
        b["clusters"].add(cluster)
        b["sources"][source] += 1
    full = [p for p in got if "full" in p[5]]
    assert sorted(map(str, (p[:5] for p in full))) == sorted(map(str, (p for p in pieces if len(p) == 5)))
    assert [p for p in got if "full" not in p[5]] == [p for p in pieces if len(p) == 7]


# ------------------------------------------------------------ quality rules


def test_cutoffs_match_brute_force_in_many_strata(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(6000):
        bad = i % 3 == 0
        w = ["".join(rnd.choices("etaoins", k=4)) + ("#" if bad and rnd.random() < 0.7 or rnd.random() < 0.02 else "") for _ in range(25)]
        rows.append((i // 2 if i % 500 == 0 else i, " ".join(w), f"l{i % 40 if i % 2 else 99}", None, 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = docs.select("doc_id", (F.col("doc_id") % 3 != 0).cast("int").alias("quality"))
    labels = labels.unionByName(labels.where("doc_id % 100 = 1").withColumn("quality", F.lit(0)))
    measured = quality_rules.measure(docs, ["doc_id", "lang"])
    rules = quality_rules.fit(measured, labels, "lang", grid=64)
    out = rules.judge(measured, "lang").toPandas()
    good = {}
    for r in labels.collect():
        good[r.doc_id] = min(good.get(r.doc_id, 1), r.quality)
    import zlib

    held = defaultdict(list)
    for r in out[~out.base_failed].itertuples():
        if good.get(r.doc_id) == 1 and zlib.crc32(str(r.doc_id).encode()) % 2 == 1:
            held[r.lang].append(r.score)
    cut = {r.qr_stratum: r for r in rules.cutoffs.collect()}
    assert cut.keys() == held.keys() and len(cut) == 21
    for lang, scores in held.items():
        assert cut[lang].good == len(scores)
        if cut[lang].cutoff is not None:
            k, n = sum(s > cut[lang].cutoff for s in scores), len(scores)
            assert sum(math.comb(n, i) * 0.05**i * 0.95 ** (n - i) for i in range(k + 1)) <= 0.05 / len(held)
        elif cut[lang].certified == 0:
            assert 0.95 ** len(scores) > 0.05 / len(held) or max(scores) > 0
    assert (out.kept == ~(out.base_failed | (out.score > out.cutoff.fillna(math.inf)))).all()
    assert cut["l99"].cutoff is not None and out[(out.lang == "l99") & (out.doc_id % 3 == 0)].kept.mean() < 0.1


def test_an_id_cannot_fill_the_fitting_sample(spark):
    rows = [(3, f"{'word ' * 30} {k}", "en", None, 0) for k in range(2000)] + [(k, "# " * 30 if k % 2 else "good " * 25 + "plain", "en", None, 0) for k in range(10, 60)]
    measured = quality_rules.measure(spark.createDataFrame(rows, SCHEMA), ["doc_id", "lang"])
    labels = spark.range(100).select(F.col("id").alias("doc_id"), (F.col("id") % 2 == 0).cast("int").alias("quality"))
    assert quality_rules.fit(measured, labels, "lang", fit_rows=10).judge(measured, "lang").count() == len(rows)


# ------------------------------------------------------------ suffix arrays


@pytest.mark.parametrize("hot_least", [0, 3, 1000])
def test_hot_grams_in_other_surroundings(spark, hot_least):
    """A passage that many documents share, shorter and longer than the least, each time in other surroundings."""
    rnd = random.Random(12)
    fresh = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    short, long = fresh(9), fresh(20)
    rows = []
    for i in range(120):
        w = fresh(15) + (short if i % 3 else long) + fresh(15)
        rows.append((i // 2 if i < 6 else None if i == 7 else i, " ".join(w + (rows[i - 1][1].split()[:18] if i % 10 == 9 else [])), None, None, 0))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    least, gram = 12, 4
    where, want = defaultdict(set), defaultdict(set)
    for r in docs.collect():
        w = r.text.split()
        for k in range(len(w) - least + 1):
            where[tuple(w[k : k + least])].add(r.doc_id)
    for r in docs.collect():
        w = r.text.split()
        for k in range(len(w) - least + 1):
            if len(where[tuple(w[k : k + least])]) > 1:
                want[r.doc_id].update(range(k, k + least))
    out = suffix_dedup.repeated_spans(docs, least, gram, cells=1 << 8, hot_least=hot_least).collect()
    assert {r.doc_id: {i for s in r.spans for i in range(s.start, s.end)} for r in out} == {k: v for k, v in want.items() if v}
    assert all(a.end < b.start for r in out for a, b in zip(r.spans[:-1], r.spans[1:], strict=True))


# ------------------------------------------------------------ n-gram join


@pytest.mark.parametrize("options", [{"block": 4, "heavy": 5, "cells": 1 << 12}, {"block": 8}])
def test_pages_of_one_template_and_their_near_copies(spark, options):
    """Many texts share most of their words, some are similar, some are not, and sizes vary."""
    rnd = random.Random(21)
    fresh = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    template, rows = fresh(40), []
    for i in range(140):
        w = fresh(rnd.choice([1, 2, 3, 12, 25])) + template[: rnd.choice([40, 40, 36, 20])] + fresh(rnd.choice([0, 1, 4]))
        rows.append((i, " ".join(w), None, None, 0))
        if i % 6 == 0:
            w[rnd.randrange(len(w))] = "other"
            rows.append((1000 + i, " ".join(w), None, None, 0))
    rows.append((5000, " ".join(fresh(30_000)), None, None, 0))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.link_components(docs, **options).collect())
    sets = {r.doc_id: {tuple(r.text.split()[k : k + 5]) for k in range(len(r.text.split()) - 4)} for r in docs.collect()}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    assert got == sorted((i, len(s), find(i)) for i, s in sets.items()) and len({find(i) for i in sets}) < len(sets) - 10


# ------------------------------------------------------------ line dedup


def test_hot_host_and_long_page(spark):
    rows = [(i, "http://hot.x/", f"menu\nown {i}\nfoot" + ("\nfill" * 20000 if i == 5 else ""), "keep") for i in range(400)] + [(1000 + i, f"http://h{i // 2}.x/", "menu\nown", "keep") for i in range(100)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, note string")
    got = {r.page_id: r for r in line_dedup.drop_site_boilerplate(pages).collect()}
    assert got[3].lines == ["own 3"] and got[5].lines[0] == "own 5" and len(got[5].lines) == 20001 and got[1001].lines == ["menu", "own"] and got[3].note == "keep"


# ------------------------------------------------------------ clashing names


def test_carried_columns_that_clash_give_way(spark):
    docs = spark.createDataFrame([(1, "one two three", "en", "s", 0)], SCHEMA).select("*", *(F.lit("own").alias(c) for c in ("lang_pred", "score", "n_words", "host", "path", "kept", "mix_size", "target")))
    model = language_id.Model.trained({"en": [b"one two"]}, 3)
    assert language_id.predict(docs, model, ["doc_id", "lang_pred", "score"]).columns == ["doc_id", "lang_pred", "score"]
    assert quality_rules.measure(docs, ["doc_id", "n_words"]).first().n_words == 3
    judged = quality_rules.Rules([0.0] * len(quality_rules.RATES), 0.0).judge(quality_rules.measure(docs, ["doc_id", "lang", "score", "kept"]), "lang")
    assert len(judged.columns) == len({*judged.columns}) and judged.first().kept is False
    pages = docs.select("*", F.lit("http://a.net/").alias("url"), F.lit("x").alias("html"))
    out = url_filters.judge(pages, ["doc_id", "host", "path", "score"])
    assert len(out.columns) == len({*out.columns}) and out.first().host == "a.net"


def test_rows_without_ids_are_documents_of_their_own(spark):
    passage = " ".join(f"w{k}" for k in range(60))
    rows = [(None, passage), (None, passage), (None, "short"), (7, f"before it {passage}"), (7, "nothing else"), (None, " ".join(f"v{k}" for k in range(70)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), [tuple(s) for s in r.spans]) for r in suffix_dedup.repeated_spans(docs).collect())
    assert got == [("7", [(2, 62)]), ("None", [(0, 60)]), ("None", [(0, 60)])]
    only = suffix_dedup.repeated_spans(docs.where("doc_id IS NULL")).collect()
    assert len(only) == 2 and all(r.doc_id is None for r in only)
    own = spark.createDataFrame([(7, passage), (7, passage)], "doc_id long, text string")
    assert suffix_dedup.repeated_spans(own).count() == 0


def test_rows_are_repeated_in_two_levels(spark):
    from spatialfeat.llm.common import repeated

    rows = [("a", 1), ("b", 4), ("c", 5), ("d", 0), ("e", None), ("f", 17)]
    got = repeated(spark.createDataFrame(rows, "own string, n long"), "n", "k", 4).collect()
    assert sorted((r.own, r.k) for r in got) == [(own, k) for own, n in rows for k in range(1, (n or 0) + 1)]
    many = repeated(spark.createDataFrame([("x", 5_000_000)], "own string, n long"), "n", "k").agg(F.count("*"), F.count_distinct("k"), F.max("k")).first()
    assert tuple(many) == (5_000_000,) * 3


def test_millions_of_equal_rows(spark):
    docs = spark.range(2_000_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one text").alias("text"), F.lit("s").alias("source"))
    out = mixing.mix(docs).agg(F.count("*").alias("n"), F.sum(F.col("mix_copies") * F.col("mix_size")).alias("taken"), F.first("mix_target").alias("target")).first()
    assert out.n == 2_000_000 and abs(out.taken - out.target) <= 2
