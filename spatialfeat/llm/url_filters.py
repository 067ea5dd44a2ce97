"""URL filters: rules first, then naive Bayes over segmented names.

Host labels and path parts are often words written together. A unigram Viterbi search splits them into the likeliest
words; a multinomial naive Bayes model then scores all words of host and path. Word counts are taken from the visible
letters of all pages plus a fixed list of words that matter to the decision; words rarer than `share` of all are left out,
so the model holds at most 1 / share words whatever the size of the corpus, which is the bound of what is broadcast.

Rules name a host with its subdomains and the start of a path; of those that fit, the longest decides. All urls that a rule
decides are the labelled data of the Bayes model: their split words are counted per class, over all rows. What the rules
look at is left out of them (as many last labels of the host and first parts of the path as the longest rule has), since
labels follow from these by definition. A word counts if it stands in urls of `hosts` hosts at least, since the name of one host
says nothing of others. Two word lists are the prior: a listed word counts as often in its class as
`prior_share` of all labelled words, ten times at least. Words rarer than `share` of the labelled words are left out of the
model, which bounds it. A url is blocked above `cutoff`, which is far from even odds, so that words which are a
little more common in one class by chance block nothing.

Defined cases: a null url or one without :// has an empty host and path, no words and the verdict allow; very long names are
split whole; without urls that a rule decides the lists alone make the model; repeated rows are judged alike; carried columns
named like an output give way; no rows give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, materialise
from .line_dedup import host_of

#: (action, host/path) as given for the production query.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: Prior words of the two classes.
BLOCK_WORDS = """
ad ads adserver adult affiliate banner bet bets betting bingo bonus bride cam cams casino cheap cialis click clicks cracked
credit deal deals discount dating download escort fake farm free gamble gambling hack hacked hot jackpot keygen loan loans
lottery malware money naked nude offer offers payday phishing pharmacy pill pills poker popup porn prize promo replica rich
sale sex sexy slots spam sponsor stream torrent track tracker tracking viagra virus warez webcam win winner wins x xxx
""".split()
ALLOW_WORDS = """
about academy archive art article articles author blog book books city college community data docs documentation edu
education encyclopedia family feed forum garden gov government guide health help history institute
journal language learn library local magazine museum music nature news notes open page pages paper people physics press
project reference report research review school science society story support teaching travel tutorial university weather
wiki world
""".split()
#: Above this probability of the class `block`, a url that no rule decides is blocked.
CUTOFF = 0.9
#: What a listed word counts in its class at least.
LISTED = 10.0
OWN = ("host", "path", "rule", "verdict", "words", "score")


class Words:
    """Unigram log probabilities; unknown runs of n letters cost what a random string of that length would."""

    def __init__(self, counts: dict[str, int], total: int):
        self.logs = {w: math.log(total) - math.log(n) for w, n in counts.items() if n}
        self.total = math.log(total)
        self.lengths = sorted({*map(len, self.logs)} - {0})
        self.cache: dict[str, list[str]] = {}

    def cost(self, word: str) -> float:
        return self.logs.get(word, self.total + len(word) * _LETTER)

    def split(self, name: str) -> list[str]:
        """The likeliest words of a run of letters; the fewest of equally likely splits, then the longest last word."""
        if (known := self.cache.get(name)) is None:
            known = self._viterbi(name)
            if len(self.cache) < 100_000 and len(name) < 100:
                self.cache[name] = known
        return known

    def _viterbi(self, name: str) -> list[str]:
        """Known words are looked up at their lengths; of all unknown last words, the best start is kept along the way."""
        logs, lengths = self.logs, self.lengths
        best: list[tuple[float, int, int]] = [(0.0, 0, 0)]  # cost, words, start of the last word
        start = (0.0, 0, 0)  # best start of an unknown word: cost up to it less that of its letters before, words, start
        for end in range(1, len(name) + 1):
            cost, words, at = start
            found = (cost + self.total + end * _LETTER, words + 1, at)
            for n in lengths:
                if n > end:
                    break
                if (log := logs.get(name[end - n : end])) is not None:
                    cost, words, _ = best[end - n]
                    found = min(found, (cost + log, words + 1, end - n))
            best.append(found)
            start = min(start, (found[0] - end * _LETTER, found[1], end))
        words, end = [], len(name)
        while end:
            at = best[end][2]
            words.append(name[at:end])
            end = at
        return words[::-1]


_LETTER = math.log(26)


@dataclass
class Bayes:
    """Multinomial naive Bayes with Laplace smoothing and even odds of the classes; words of neither class say nothing."""

    logs: dict[str, float]  # log P(word | block) - log P(word | allow)
    prior: float = 0.0

    @classmethod
    def trained(cls, block: dict[str, float], allow: dict[str, float], prior: float = 0.0) -> Bayes:
        """From (weighted) counts of words per class."""
        every = {*block, *allow}
        sums = [sum(c.values()) + len(every) for c in (block, allow)]
        log = lambda c, n, w: math.log((c.get(w, 0) + 1) / n)
        return cls({w: log(block, sums[0], w) - log(allow, sums[1], w) for w in every}, prior)

    def score(self, words: list[str]) -> float:
        """P(block | words)."""
        odds = self.prior + sum(self.logs.get(w, 0.0) for w in words)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its action, null if none does."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, _, below = text.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(f"/{below}")
        rule, action = F.when(fits, text).otherwise(rule), F.when(fits, what).otherwise(action)
    return rule, action


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    tag, letters = re.compile(r"<(script|style)\b.*?</\1>|<[^>]*>", re.S | re.I), re.compile(r"[a-z]+")
    for batch in batches:
        for html in batch.column(0).to_pylist():
            counts.update(letters.findall(tag.sub(" ", html).lower()))
            if len(counts) > 200_000:
                yield out()
                counts.clear()
    if counts:
        yield out()


def word_counts(pages: DataFrame, html: str = "html", share: float = 1e-5, seeds: tuple[str, ...] = (*BLOCK_WORDS, *ALLOW_WORDS)) -> Words:
    """Counts the words of all pages; keeps those with at least `share` of all, 1 / share at most, and the seeds."""
    counted = materialise(pages.where(F.col(html).isNotNull()).select(html).mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    summed = counted.agg(F.sum("n")).first()[0] or 0
    counts = {r.word: r.n for r in counted.where(F.col("n") >= max(1.0, share * summed)).collect()}
    common = max(1, int(summed * share * 10))
    for w in seeds:  # a word of the decision counts as a fairly common one
        counts[w] = max(counts.get(w, 0), common if len(w) > 1 else 1)
    return Words(counts, max(1, sum(counts.values())))


def runs_of(host: str, path: str) -> list[str]:
    """The runs of letters of a host and a path, A-Z lower-cased."""
    return re.findall("[a-z]+", f"{host} {path}".translate(_LOWER))


_LOWER = {c: c + 32 for c in range(65, 91)}


def undecided(host: str, path: str, labels: int, parts: int) -> tuple[str, str]:
    """What of a host and a path rules with so many labels and parts do not look at."""
    return ".".join(host.split(".")[: -labels or None]), "/".join(path.split("/")[1 + parts :])


def _labelled(batches: Iterator[pa.RecordBatch], model, labels: int, parts: int) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out():
        columns = list(zip(*counts, strict=True))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns), pa.array(list(counts.values()), pa.int64())], ["word", "host", "action", "n"])

    for batch in batches:
        for host, path, action in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts.update((w, host, action) for run in runs_of(*undecided(host, path, labels, parts)) for w in model.value.split(run))
            if len(counts) > 200_000:
                yield out()
                counts.clear()
    if counts:
        yield out()


def learn(split: DataFrame, words, rules=RULES, block_words: list[str] = BLOCK_WORDS, allow_words: list[str] = ALLOW_WORDS, prior_share: float = 0.1, share: float = 1e-5, hosts: int = 2) -> Bayes:
    """Fits the model on the rows of split (uf_host, uf_path) that a rule decides; words is a broadcast Words."""
    labels = max((len(text.partition("/")[0].split(".")) for _, text in rules), default=0)
    parts = max((sum(map(bool, text.split("/")[1:])) for _, text in rules), default=0)
    _, action = rule_of(F.col("uf_host"), F.col("uf_path"), rules)
    known = split.select("uf_host", "uf_path", action.alias("action")).where("action IS NOT NULL")
    of_host = known.mapInArrow(lambda it: _labelled(it, words, labels, parts), "word string, host string, action string, n long").groupBy("word", "host").agg(
        *(F.sum(F.when(F.col("action") == k, F.col("n")).otherwise(0)).alias(k) for k in ("block", "allow"))
    )
    counted = of_host.groupBy("word").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count("*").alias("hosts"))
    counted = materialise(counted.where(F.col("hosts") >= hosts))
    sums = counted.agg(F.sum("block"), F.sum("allow")).first()
    summed = sum(x or 0 for x in sums)
    kept = counted.where(F.col("block") + F.col("allow") >= max(1.0, share * summed)).collect()  # at most 1 / share rows
    counts = tuple({r.word: float(r[k]) for r in kept} for k in ("block", "allow"))
    for own, listed, n in zip(counts, (block_words, allow_words), sums, strict=True):
        for w in dict.fromkeys(listed):
            own[w] = own.get(w, 0.0) + max(LISTED, prior_share * (n or 0))
    return Bayes.trained(*counts)


def _judged(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    words, bayes = model.value
    for batch in batches:
        host, path = (batch.column(k).to_pylist() for k in (batch.num_columns - 2, batch.num_columns - 1))
        tokens = [[w for run in runs_of(h, p) for w in words.split(run)] for h, p in zip(host, path, strict=True)]
        score = [bayes.score(t) for t in tokens]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([" ".join(t) for t in tokens], pa.string()), pa.array(score, pa.float64())], [*batch.schema.names, "uf_words", "uf_score"]
        )


def parts_of(pages: DataFrame, carry: list[str], url: str = "url") -> DataFrame:
    """The columns that come along, uf_host and uf_path."""
    return pages.select(*carried(carry, OWN), host_of(F.col(url)).alias("uf_host"), path_of(F.col(url)).alias("uf_path"))


def judge(pages: DataFrame, carry: list[str], rules=RULES, url: str = "url", html: str = "html", block_words: list[str] = BLOCK_WORDS, allow_words: list[str] = ALLOW_WORDS, cutoff: float = CUTOFF, train: Column | None = None) -> DataFrame:
    """Adds host, path, rule, verdict, words (split names, blank between) and score (of naive Bayes) to `carry`.

    train: which rows of pages the Bayes model may learn from, if not from all.
    """
    sc = pages.sparkSession.sparkContext
    words = word_counts(pages, html, seeds=(*block_words, *allow_words))
    split = parts_of(pages, carry, url)
    own = parts_of(pages if train is None else pages.where(train), [], url)
    bayes = learn(own, sc.broadcast(words), rules, block_words, allow_words)
    model = sc.broadcast((words, bayes))
    schema = T.StructType([*split.schema.fields, T.StructField("uf_words", T.StringType()), T.StructField("uf_score", T.DoubleType())])
    scored = split.mapInArrow(lambda it: _judged(it, model), schema)
    rule, action = rule_of(F.col("uf_host"), F.col("uf_path"), rules)
    verdict = F.coalesce(action, F.when(F.col("uf_score") > cutoff, "block").otherwise("allow"))
    return scored.select(*carried(carry, OWN), F.col("uf_host").alias("host"), F.col("uf_path").alias("path"), rule.alias("rule"), verdict.alias("verdict"), F.col("uf_words").alias("words"), F.col("uf_score").alias("score"))
