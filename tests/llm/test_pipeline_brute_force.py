"""The whole pipeline against a plain version of every stage."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from spatialfeat.llm import quality_rules
from spatialfeat.llm.common import sweep, written
from test_text_operators import SCHEMA, brute_components, brute_measures, words


def brute_kept(rows, rules):
    """Base rules, and the fitted score against the certified cutoff of the stratum, from measures by hand."""
    cutoffs = {r.qr_stratum: r.cutoff for r in rules.cutoffs.collect()} if rules.cutoffs is not None else {}
    out = []
    for r in rows:
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = brute_measures(r.text)
        text = r.text or ""
        m = {
            "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words,
            "n_lines": sum(bool(words(x)) for x in text.split("\n")), "n_upper": sum("A" <= c <= "Z" for c in text), "n_shouts": sum(c in "!?" for c in text), "n_digits": sum("0" <= c <= "9" for c in text),
        }
        if n_words < 20 or 100 * n_repeat_words > 30 * n_words:
            continue
        score = rules.bias + sum(w * m[a] / (m[b] + more) for w, (a, b, more) in zip(rules.weights, quality_rules.RATES, strict=True))
        cut = cutoffs.get(r.lang)
        if cut is None or score <= cut:
            out.append(r)
    return out


def brute_exact(rows):
    best = {}
    for r in rows:
        key = r.text or ""
        if key not in best or (r.doc_id is not None, r.doc_id or 0) > (best[key].doc_id is not None, best[key].doc_id or 0):
            best[key] = r
    return list(best.values())


def brute_near(rows):
    named = brute_components(rows)
    return [r for r, (doc_id, _, component) in zip(rows, named, strict=True) if doc_id == component]


def brute_mix(rows):
    size = lambda r: len(words(r.text))
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    order = sorted(by, key=lambda s: (s is None, s or ""))
    whole, weight = {s: sum(map(size, by[s])) for s in order}, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full = set()
    while True:
        level = (sum(whole.values()) - sum(3 * whole[s] for s in full)) / max(1, sum(weight[s] for s in order if s not in full))
        more = {s for s in order if s not in full and level * weight[s] > 3 * whole[s]}
        if not more:
            break
        full |= more
    out = []
    for s in order:
        target = 3 * whole[s] if s in full else level * weight[s]
        due = target / whole[s] if whole[s] else 0.0
        u = (int(hashlib.md5(f"mix:{s or ''}".encode()).hexdigest()[:8], 16) + 0.5) / 2**32
        key = lambda r: (math.isqrt(size(r)), hashlib.md5(f"{'' if r.doc_id is None else r.doc_id}:{r.text or ''}".encode()).hexdigest())
        for k, r in enumerate(sorted(by[s], key=key)):
            out += [r] * (math.floor(u + due * (k + 1)) - math.floor(u + due * k))
    return out


def brute_pack(rows, capacity=2048, most=3):
    """Best fit over all bins in turn, as one shard."""
    rests, out = [], []
    for r in rows:
        n, left = 0, len(words(r.text))
        cluster = hashlib.sha256(r.text.encode()).hexdigest()[:32] if left else None
        while left > capacity:
            out.append((r.doc_id, n, capacity, r.source, cluster, None, 0))
            left, n = left - capacity, n + 1
        rests.append((-left, r.doc_id is not None, r.doc_id or 0, n, r.source, cluster))
    rests.sort(key=lambda r: (*r[:4], r[4] or "", r[5] or ""))
    bins = []
    for minus, has, id, n, source, cluster in rests:
        fits = [(b[0], k) for k, b in enumerate(bins) if b[0] >= -minus and (cluster is None or cluster not in b[1]) and (source is None or b[2][source] < most)]
        k = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append([capacity, set(), Counter()])
        b = bins[k]
        out.append((id if has else None, n, -minus, source, cluster, k, capacity - b[0]))
        b[0] += minus
        b[1].add(cluster)
        b[2][source] += 1
    return out


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rnd = random.Random(31)
    vocabulary = ["".join(rnd.choices("abcdefghijklmno", k=rnd.randint(2, 8))) for _ in range(900)]
    rows = []
    for i in range(1300):
        w = rnd.choices(vocabulary, k=rnd.choice([5, 30, 60, 120, 300]))
        kind = rnd.random()
        if kind < 0.15 and rows:  # exact copy
            w = (rnd.choice(rows)[1] or "x").split(" ")
        elif kind < 0.3 and rows:  # near copy
            w = (rnd.choice(rows)[1] or "x").split(" ")
            w[rnd.randrange(len(w))] = "Changed"
        elif kind < 0.45:
            w = [x + rnd.choice(["##", "", "$!"]) for x in w]
        rows.append((i * 7 % 4001, " ".join(w), rnd.choice(["en", "en", "de", None]), rnd.choice(["a", "a", "a", "b", "c", None]), 0))
    rows += [(5000, " ".join(rnd.choices(vocabulary, k=5000)), "en", "b", 0), (5001, None, None, None, None), (5002, "", "en", "a", 0), (5003, " \n ", "de", "a", 0)]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int("##" not in (t or "") and "$!" not in (t or "")), 0) for i, t, *_ in rows if i % 5 < 4]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_pipeline_matches_plain_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    rules = quality_rules.fit(quality_rules.measure(docs, ["doc_id", "lang"]), spark.read.parquet(f"{corpus}/labels.parquet"), "lang")
    assert any(r.cutoff is not None for r in rules.cutoffs.collect())
    rows = docs.collect()
    kept = brute_kept(rows, rules)
    once = brute_exact(kept)
    apart = brute_near(once)
    mixed = brute_mix(apart)
    want = brute_pack(mixed)
    assert len(rows) > len(kept) > len(once) > len(apart) and len(want) < 4096
    got = corpus_pipeline.run(spark, corpus).collect()
    assert Counter((r.doc_id, r.piece, r.n_words, r.source, r.cluster, r.bin_offset) for r in got) == Counter((*w[:5], w[6]) for w in want)
    # the same pieces share bins
    shared = lambda pieces: Counter(tuple(sorted(map(str, b))) for b in pieces.values())
    mine, theirs = defaultdict(list), defaultdict(list)
    for r in got:
        mine[r.bin_id].append((r.doc_id, r.piece, r.bin_offset))
    for k, w in enumerate(want):
        theirs[f"full{k}" if w[5] is None else w[5]].append((w[0], w[1], w[6]))
    assert shared(mine) == shared(theirs)


def test_near_copies_without_ids_go_and_one_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(None, text + f" end{k}", "en", "a", 0) for k in range(4)] + [(9, text + " last", "en", "a", 0), (9, text + " more", "en", "a", 0), (None, "", None, None, 0), (None, "other words " * 9, None, None, 0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = corpus_pipeline.near(spark, docs, "").collect()
    assert sorted(str(r.doc_id) for r in out) == ["9", "None", "None"]
    alone = corpus_pipeline.near(spark, docs.where("doc_id IS NULL"), "").collect()
    assert len(alone) == 3


def test_tables_of_stages_are_removed(spark, corpus):
    sweep(spark)
    out = corpus_pipeline.run(spark, corpus)
    assert len(written(spark)) <= 1 and out.count() > 0


def test_shared_folder_must_be_set_on_a_cluster():
    from types import SimpleNamespace

    from spatialfeat.llm import common

    none = SimpleNamespace(getOrElse=lambda x: x)
    sc = SimpleNamespace(getConf=lambda: {}, _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)), master="spark://host:7077")
    with pytest.raises(ValueError):
        common.shared_dir(SimpleNamespace(sparkContext=sc))
