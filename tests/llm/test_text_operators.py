"""Text operators against brute force, and on nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spatialfeat.llm import exact_dedup, language_id, line_dedup, mixing, ngram_join, packing, quality_rules, suffix_dedup, url_filters, warc
from spatialfeat.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", "   \n\t ", "a", "One two", "é è ü ñ 漢字 \u00a0x", "x " * 3000, "same line\nsame line\nsame line\n"]


def words(text):
    return WORD.findall(text or "")


def corpus(n=60, seed=1):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(1, 6))) for _ in range(80)]
    base = [" ".join(rnd.choices(vocabulary, k=rnd.randint(5, 60))) for _ in range(n // 3)]
    out = []
    for i in range(n):
        t = list(rnd.choice(base).split())
        for _ in range(rnd.choice([0, 0, 1, 2])):
            t[rnd.randrange(len(t))] = rnd.choice(vocabulary).upper()
        out.append(" ".join(t))
    return out + ODD + ODD


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 3}" if i % 7 else None, len(t or "")) for i, t in enumerate(corpus())]
    rows += [rows[3], rows[3], (None, rows[5][1], None, "s1", 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ------------------------------------------------------------ words


def test_words_are_split_like_the_pattern():
    from spatialfeat.llm.common import Words, texts

    column = pa.array(corpus(), pa.string())
    got = []
    for _, data, offsets in texts(column, 500):
        w = Words(data, offsets)
        flat = [data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends, strict=True)]
        got += [flat[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
    assert got == [words(t) for t in corpus()]


# ------------------------------------------------------------ exact dedup


def test_grace_with_spills_matches_a_dictionary():
    rnd = random.Random(3)
    rows = [(rnd.choice([b"a" * k for k in range(200)] + [b""]), rnd.choice([None, *range(1000)]), 1, 0) for _ in range(3000)]
    schema = pa.schema([("c", pa.binary()), ("id", pa.int64()), ("n", pa.int64()), ("tie", pa.int64())])
    batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    want = defaultdict(lambda: [None, 0])
    for c, i, n, _ in rows:
        own = want[c]
        own[0] = i if own[0] is None or (i is not None and i > own[0]) else own[0]
        own[1] += n
    for fits in (300, 2000, 1 << 20):
        local = list(exact_dedup.merged_while_scanning(iter([batch]), fits))
        got = [r for b in exact_dedup.grace(iter(local), fits, 4) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert len(got) == len(want) and {c: [i, n] for c, i, n, _ in got} == dict(want)


def test_exact_groups(docs, none):
    by = defaultdict(list)
    rows = docs.collect()
    for r in rows:
        by[r.text or ""].append(r.doc_id)
    got = exact_dedup.groups(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in rows)
    text = {hashlib.sha256(t.encode()).hexdigest(): t for t in by}
    for r in got:
        ids = by[text[r.text_sha256]]
        assert r.keep_id == max((i for i in ids if i is not None), default=None) and r.group_size == len(ids)
    assert Counter(r.text_sha256 for r in got if r.kept) == Counter(dict.fromkeys(text, 1))
    assert exact_dedup.groups(none).count() == 0 and exact_dedup.dedup(none).columns == none.columns


def test_exact_dedup_keeps_columns_that_clash(docs):
    wide = docs.select("*", F.lit(1).alias("gd_id"), F.lit("x").alias("gd_content"), F.lit(2).alias("rest"))
    out = exact_dedup.dedup(wide)
    assert out.columns == wide.columns
    assert out.count() == len({r.text or "" for r in docs.collect()})
    assert {r.gd_content for r in out.collect()} == {"x"}


# ------------------------------------------------------------ n-gram join


def brute_components(rows, percent=80):
    sets = []
    for r in rows:
        w = words((r.text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                up[find(i)] = find(j)
    names = defaultdict(list)
    for i, r in enumerate(rows):
        names[find(i)].append(r.doc_id)
    return [(r.doc_id, len(sets[i]), min((x for x in names[find(i)] if x is not None), default=None)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("options", [{}, {"block": 2, "heavy": 3, "cells": 1 << 12}, {"block": 3, "name_bits": 4}])
def test_ngram_components_match_brute_force(docs, options):
    key = lambda r: tuple(map(str, r))
    got = sorted(map(tuple, ngram_join.link_components(docs, **options).drop("text_key", "component").collect()), key=key)
    assert got == sorted(brute_components(docs.collect()), key=key)


def test_ngram_join_of_nothing(none):
    assert ngram_join.link_components(none).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_prefix_tree_joins_all_similar_pairs(seed):
    rnd = random.Random(seed)
    base = [rnd.sample(range(400), 40) for _ in range(4)]
    sets = [sorted({*rnd.sample(rnd.choice(base), rnd.randint(30, 40)), *rnd.sample(range(400), rnd.randint(0, 4))}) for _ in range(60)]
    edges = ngram_join.join_block([np.array(s, np.uint64) for s in sets], 80)
    forest, want = ngram_join.Forest(60), ngram_join.Forest(60)
    for a, b in edges:
        assert 100 * len({*sets[a]} & {*sets[b]}) >= 80 * len({*sets[a]} | {*sets[b]})
        assert forest.join(a, b)
    for i in range(60):
        for j in range(i):
            if 100 * len({*sets[i]} & {*sets[j]}) >= 80 * len({*sets[i]} | {*sets[j]}):
                want.join(i, j)
    assert all((forest.find(i) == forest.find(j)) == (want.find(i) == want.find(j)) for i in range(60) for j in range(i))


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, 200), (200, 7), (300, 300)]
    random.Random(0).shuffle(edges)
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, 5: 5, 200: 5, 7: 5}
    odd = spark.createDataFrame([(1, None, "x"), (None, 2, "x"), (3, 3, "x"), (5, 4, "x"), (4, 5, "x"), (4, 5, "x")], "a long, b long, component string")
    assert dict(map(tuple, connected_components(odd).collect())) == {4: 4, 5: 4} and connected_components(odd.limit(0)).count() == 0


# ------------------------------------------------------------ suffix arrays


def test_repeated_spans_match_brute_force(docs):
    least, gram = 12, 4
    rows = docs.collect()
    where = defaultdict(set)
    lowered = [words((r.text or "").translate({c: c + 32 for c in range(65, 91)})) for r in rows]
    for r, w in zip(rows, lowered, strict=True):
        for i in range(len(w) - least + 1):
            where[tuple(w[i : i + least])].add(r.doc_id)
    want = defaultdict(set)
    for r, w in zip(rows, lowered, strict=True):
        for i in range(len(w) - least + 1):
            if len(where[tuple(w[i : i + least])]) > 1:
                want[r.doc_id].update(range(i, i + least))
    got = {r.doc_id: {i for s in r.spans for i in range(s.start, s.end)} for r in suffix_dedup.repeated_spans(docs, least, gram).collect()}
    assert got == {k: v for k, v in want.items() if v}


def test_repeated_spans_of_nothing(none):
    assert suffix_dedup.repeated_spans(none).count() == 0


# ------------------------------------------------------------ quality rules


def brute_measures(text):
    w = words(text)
    windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    seen, dups = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dups, len(hit)


def test_measures_match_brute_force(docs):
    rows = docs.withColumn("own", F.col("text"))
    got = quality_rules.measure(rows, ["own"]).collect()
    assert all(tuple(r[1:6]) == brute_measures(r.own) for r in got) and len(got) == docs.count()


def test_binomial_bound_is_exact():
    for n, k, p in ((20, 0, 0.05), (300, 7, 0.05), (1000, 49, 0.05), (5, 5, 0.3)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality_rules.at_most(k, n, p) == pytest.approx(want, rel=1e-9)


def test_binomial_bound_above_the_mean_and_of_many():
    from fractions import Fraction

    assert quality_rules.at_most(500, 1000, 0.05) == quality_rules.at_most(1500, 6000, 0.05) == 1.0
    for n in (7, 60, 400):
        p, sums = Fraction(1, 20), Fraction(0)
        for k in range(n + 1):
            sums += math.comb(n, k) * p**k * (1 - p) ** (n - k)
            assert quality_rules.at_most(k, n, 0.05) == pytest.approx(float(sums), rel=1e-9, abs=1e-300)
    for n in (10**5, 10**7):
        deviation = math.sqrt(n * 0.05 * 0.95)
        for z in (-3, -1, 0, 1, 3, 60):  # further out the normal curve is another one
            got = quality_rules.at_most(round(n * 0.05 + z * deviation), n, 0.05)
            assert got == pytest.approx(0.5 * math.erfc(-z / math.sqrt(2)), rel=0.05 if z < -2 else 0.02)
        assert quality_rules.at_most(n // 2, n, 0.05) == quality_rules.at_most(n - 1, n, 0.05) == 1.0


def test_allowed_is_the_last_certified_count():
    for n in (0, 10, 58, 59, 400, 3000):
        most = quality_rules.allowed(n, 0.05, 0.05)
        assert most < 0 or quality_rules.at_most(most, n, 0.05) <= 0.05
        assert quality_rules.at_most(most + 1, n, 0.05) > 0.05


def test_a_template_that_half_of_the_good_documents_share_stays(spark):
    rnd = random.Random(8)
    template = " ".join(["template", "of", "many##", "pages"] + [f"w{k}" for k in range(36)])
    rows = []
    for i in range(6000):
        kind = i % 3
        text = " ".join("".join(rnd.choices("etaoins", k=5)) + ("#" if kind == 2 or rnd.random() < 0.001 else "") for _ in range(40)) if kind else template
        rows.append((i, text, "en", None, 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = docs.select("doc_id", (F.col("doc_id") % 3 < 2).cast("int").alias("quality"))
    measured = quality_rules.measure(docs, ["doc_id", "lang"])
    rules = quality_rules.fit(measured, labels, "lang")
    out = rules.judge(measured, "lang").toPandas()
    good = out[out.doc_id % 3 < 2]
    assert good.kept.mean() >= 0.95 and out[out.doc_id % 3 == 0].kept.all()
    assert 0 < rules.cutoffs.first().certified < quality_rules.GRID


def test_cutoffs_reject_junk_and_bound_false_rejection(spark):
    rnd = random.Random(5)
    clean = lambda: " ".join("".join(rnd.choice("etaoins") for _ in range(rnd.randint(2, 8))) for _ in range(60))
    rows = [(i, clean() if i % 4 else re.sub(" ", "### ", clean()), "en" if i % 3 else "fr", None, 0) for i in range(3000)]
    d = spark.createDataFrame(rows, SCHEMA)
    labels = d.select("doc_id", (F.col("doc_id") % 4 != 0).cast("int").alias("quality"))
    measured = quality_rules.measure(d, ["doc_id", "lang"])
    rules = quality_rules.fit(measured, labels, "lang")
    out = rules.judge(measured, "lang").toPandas()
    assert out[out.doc_id % 4 != 0].kept.mean() > 0.97 and out[out.doc_id % 4 == 0].kept.mean() < 0.03
    assert all(r.good >= 59 for r in rules.cutoffs.collect() if r.certified)


def test_quality_without_labels_keeps_what_the_base_keeps(docs, none, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    measured = quality_rules.measure(docs, ["doc_id", "lang"])
    out = quality_rules.fit(measured, labels, "lang").judge(measured, "lang").collect()
    assert len(out) == docs.count() and all(r.kept != r.base_failed for r in out)
    assert quality_rules.measure(none, ["doc_id"]).count() == 0


# ------------------------------------------------------------ language identification


def brute_bits(samples, order, text):
    """Prediction by partial matching with exclusion, byte by byte from dictionaries."""
    counts = defaultdict(Counter)
    for t in samples:
        t = b"\0" * order + t
        for i in range(order, len(t)):
            for k in range(order + 1):
                counts[k, t[i - k : i]][t[i]] += 1
    total, t = 0.0, b"\0" * order + text
    for i in range(order, len(t)):
        out = set()
        for k in range(order, -1, -1):
            own = {s: n for s, n in counts.get((k, t[i - k : i]), {}).items() if s not in out}
            if not own:
                continue
            whole = sum(own.values()) + len(own)
            if t[i] in own:
                total -= math.log2(own[t[i]] / whole)
                break
            total -= math.log2(len(own) / whole)
            out |= set(own)
        else:
            total -= math.log2(1 / (256 - len(out)))
    return total


def test_code_lengths_match_brute_force():
    samples = {"a": [b"the cat sat on the mat", b"that hat"], "b": ["le chat est l\u00e0".encode(), b""]}
    model = language_id.Model.trained(samples, 3)
    tests = [b"the chat", b"", "z\u00e9ro that".encode(), b"\0\0x", b"qqqq"]
    offsets = np.cumsum([0, *map(len, tests)])
    got = model.bits(np.frombuffer(b"".join(tests), np.uint8), offsets)
    for i, t in enumerate(tests):
        for j, lang in enumerate(model.langs):
            assert got[i, j] == pytest.approx(brute_bits(samples[lang], 3, t), rel=1e-5, abs=1e-5)


def test_language_prediction(spark, docs, none):
    import zlib

    rnd = random.Random(2)
    letters = {"xx": "aeilmnrst", "yy": "bcdfghkop"}
    rows = [(i, " ".join("".join(rnd.choices(letters[k], k=5)) for _ in range(20)), k, None, 0) for i, k in ((i, rnd.choice(["xx", "yy"])) for i in range(400))]
    d = spark.createDataFrame(rows, SCHEMA)
    out = language_id.predict(d, language_id.learn(d), ["doc_id", "lang"]).withColumn("held", language_id.remainder(F.col("doc_id")) == 2).collect()
    held = [r for r in out if r.held]
    assert {r.doc_id for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.98 and all(0 <= r.score <= 1 for r in out)
    odd = language_id.predict(docs, language_id.learn(d), ["text"]).collect()
    assert all((r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or "")) for r in odd)
    assert language_id.predict(none, language_id.learn(none), ["doc_id"]).count() == 0
    assert {r.lang_pred for r in language_id.predict(d, language_id.learn(none), ["doc_id"]).collect()} == {"und"}


# ------------------------------------------------------------ url filters


def test_viterbi_finds_the_likeliest_split():
    model = url_filters.Words({"cheap": 50, "pills": 40, "pill": 30, "s": 5, "heap": 10, "c": 5, "news": 60, "new": 50}, 250)

    def splits(x):
        if not x:
            yield []
        for k in range(1, len(x) + 1):
            for rest in splits(x[k:]):
                yield [x[:k], *rest]

    for name in ("cheappills", "newspills", "pillsnews", "abcnews"):
        cost = lambda ws: sum(map(model.cost, ws))
        assert cost(model.split(name)) == pytest.approx(min(map(cost, splits(name))))
    assert model.split("cheappills") == ["cheap", "pills"]


def test_urls(spark):
    urls = [None, "", "nothing", "http://", "HTTP://A.Example.NET/en/x?q#f", "http://example.com/de", "http://example.com/de/", "x://www.example.com/DE/", "http://a.org/fr/1", "http://net/", "http://sub.net/",
            "http://sub.net", "http://freecasinobets.io/play", "http://citylibrary.io/book/x://y", "http://h?x/y", "http://h#x", "a://b://c/d"]
    pages = spark.createDataFrame([(i, u, "<p>free casino bets city library book</p>", 1) for i, u in enumerate(urls)], "page_id long, url string, html string, host int")
    got = {r.page_id: r for r in url_filters.judge(pages, ["page_id"]).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0].lower()
        path = re.match(r"[^?#]*", re.sub(r"^[^/?#]*", "", rest))[0]
        assert (got[i].host, got[i].path) == (host, path)
        fits = [(r, a) for a, r in url_filters.RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
        best = max(fits, key=lambda x: len(x[0])) if fits else (None, None)
        assert got[i].rule == best[0] and (best[1] is None or got[i].verdict == best[1])
    assert got[12].verdict == "block" and got[13].verdict == "allow" and got[0].verdict == "allow"
    assert url_filters.judge(pages.limit(0), ["page_id"]).count() == 0


# ------------------------------------------------------------ line dedup


def test_boilerplate_lines(spark):
    pages = spark.createDataFrame(
        [(i, f"http://H{i % 2}.x/p", f"<ul><li>menu</li></ul><p>text {i}</p>\nfoot<br> \n" + ("once" if i == 4 else ""), "a") for i in range(10)] + [(99, None, None, "b"), (None, "http://h1.x", "", "c")],
        "page_id long, url string, html string, lines string",
    )
    got = {r.page_id: r for r in line_dedup.drop_site_boilerplate(pages).collect()}
    assert got[3].lines == ["text 3"] and got[4].lines == ["text 4", "once"] and got[3].n_lines == 3
    assert got[99].host == "" and got[99].lines == [] and got[None].host == "h1.x"
    assert line_dedup.drop_site_boilerplate(pages.limit(0)).count() == 0


# ------------------------------------------------------------ packing


@pytest.mark.parametrize("shard_rows", [4096, 20])
def test_packing_holds_capacity_and_conflicts(docs, none, shard_rows):
    capacity = 64
    rows = packing.pack(docs, capacity, 2, shard_rows=shard_rows).collect()
    assert Counter((r.doc_id) for r in rows for _ in [0] if r.piece == max(x.piece for x in rows if x.doc_id == r.doc_id))
    assert sum(r.n_words for r in rows) == sum(len(words(r.text)) for r in docs.collect())
    bins = defaultdict(list)
    for r in rows:
        bins[r.bin_id].append(r)
    for own in bins.values():
        own.sort(key=lambda r: (r.bin_offset, r.n_words))
        assert sum(r.n_words for r in own) <= capacity
        at = 0
        for r in own:
            assert r.bin_offset == at
            at += r.n_words
        clusters = [r.cluster for r in own if r.cluster]
        assert len(clusters) == len({*clusters})
        assert max(Counter(r.source for r in own if r.source).values(), default=0) <= 2
    assert packing.pack(none).count() == 0


def test_the_tightest_compatible_bin_is_taken():
    rnd = random.Random(8)
    shelf, bins = packing.Shelf(100, 1), []
    for _ in range(300):
        size, source, cluster = rnd.randint(1, 60), 1 << rnd.randrange(12), rnd.choice([0, 1 << rnd.randrange(5)])
        fits = [(r, k) for k, (r, s, c) in enumerate(bins) if r >= size and not s & source and not c & cluster]
        k, fill = shelf.place(size, source, cluster)
        if fits:
            assert (bins[k][0], k) == min(fits) and fill == 100 - bins[k][0]
        else:
            assert k == len(bins) and fill == 0
            bins.append((100, 0, 0))
        r, s, c = bins[k]
        bins[k] = (r - size, s | source, c | cluster)


# ------------------------------------------------------------ mixing


def test_targets_fill_up_by_weight(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, "d": 5, None: 300, "e": 0}
    t = spark.createDataFrame(list(sizes.items()), "source string, mix_size long")
    got = {r.source: r.mix_target for r in mixing.targets(t).collect()}
    weights = dict(zip(["a", "b", "c", "d", "e", None], [5, 2, 1, 5, 2, 1], strict=True))
    level, full = {}, set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[x] for x in full)
        level = {s: 3 * sizes[s] if s in full else rest * weights[s] / sum(weights[x] for x in sizes if x not in full) for s in sizes}
        more = {s for s in sizes if s not in full and level[s] > 3 * sizes[s]}
        if not more:
            break
        full |= more
    assert got == pytest.approx(level)


def test_mixing(spark, docs, none):
    rows = [(i, "w " * (1 + i * 7 % 90), None, f"s{i % 4 if i % 3 else 0}", 0) for i in range(2000)]
    d = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix(d).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.mix_copies * r.mix_size
        target[r.source] = r.mix_target
        assert 0 <= r.mix_copies <= 3
    assert all(abs(taken[s] - t) <= 0.02 * t + 100 for s, t in target.items())
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(d.repartition(5)).collect()))
    clash = docs.select("*", F.lit(1).alias("mix_size"), F.lit(2).alias("target"))
    out = mixing.mixed(clash)
    assert out.columns == clash.columns and out.count() == sum(r.mix_copies for r in mixing.mix(docs).collect())
    assert mixing.mixed(none).count() == 0


# ------------------------------------------------------------ WARC


def test_archive_round_trip(spark, tmp_path):
    html = ["a", "a", "", None, "long " * 2000, "a", "é"]
    rows = [(i, f"http://x/{i}\r\n" if i else None, h) for i, h in enumerate(html)] + [(6, "http://x/6", "é"), (6, "http://x/6", "é"), (None, "u", "a"), (6, "http://x/7", "é")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "a"))
    archive = warc.read_archive(spark, str(tmp_path / "a"))
    got = warc.described(warc.rebuild(archive)).collect()
    assert len(got) == len(rows) and spark.read.parquet(str(tmp_path / "a/payloads")).count() == 4
    # every record byte for byte
    sha1 = lambda h: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode()
    name = lambda i, u, h, k: f"<urn:page:{'null' if i is None else i}:{hashlib.sha256((hashlib.sha256(h.encode()).hexdigest() + ('n' if u is None else 'u' + u)).encode()).hexdigest()[:16]}:{k}>"
    by, want, facts, seen = defaultdict(list), [], [], Counter()
    for i, u, h in rows:
        by[h or ""].append((i is not None, i or 0, u is not None, u or ""))
    for i, u, h in rows:
        h = h or ""
        _, top, has_url, top_url = max(by[h])
        seen[i, u, h] += 1
        own = (i, u) == (top, top_url if has_url else None) and seen[i, u, h] == 1
        lines = ["WARC/1.1", f"WARC-Type: {'response' if own else 'revisit'}", f"WARC-Record-ID: {name(i, u, h, seen[i, u, h])}", f"WARC-Date: {warc.DATE}"]
        lines += [] if u is None else ["WARC-Target-URI: " + u.replace("\r", "%0D").replace("\n", "%0A")]
        lines += [f"WARC-Payload-Digest: sha1:{sha1(h)}"]
        lines += [] if own else [f"WARC-Refers-To: {name(top, top_url if has_url else None, h, 1)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(h.encode()) if own else 0}", "", ""]
        want.append("\r\n".join(lines).encode() + (h.encode() if own else b"") + b"\r\n\r\n")
        facts.append((i, len(h.encode()), sha1(h), "response" if own else "revisit", None if own else top))
    assert sorted(bytes(r.record) for r in warc.rebuild(archive).collect()) == sorted(want) and len({*want}) == len(want)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, facts))
    # read without a join of payloads it comes to the same, also where small payloads are all responses
    assert sorted(map(str, warc.read_described(spark, str(tmp_path / "a")).collect())) == sorted(map(str, got))
    warc.write_archive(pages, str(tmp_path / "c"), least=5)
    small = warc.described(warc.rebuild(warc.read_archive(spark, str(tmp_path / "c")))).collect()
    assert sorted(map(str, warc.read_described(spark, str(tmp_path / "c")).collect())) == sorted(map(str, small))
    warc.write_archive(pages.limit(0), str(tmp_path / "b"))
    assert warc.described(warc.rebuild(warc.read_archive(spark, str(tmp_path / "b")))).count() == 0


def test_sweep_removes_tables(spark):
    from spatialfeat.llm.common import materialise, sweep

    sweep(spark)
    df = materialise(spark.range(5))
    assert df.count() == 5 and sweep(spark) == 1 and sweep(spark) == 0
