"""Language identification by prediction by partial matching.

Per language, a tree of byte contexts of orders 0 to K with symbol counts is learned from a bounded sample of labelled
documents and frozen. A text costs, per language, the sum over its bytes of the exact code length under that tree: the
longest known context predicts the byte or escapes (method C: as many escapes as the context has distinct symbols) to the
next shorter one, where symbols that the longer one has seen are excluded; below order 0 the bytes left are equally likely.
The language with the shortest code wins.

Under frozen statistics the cost of a byte depends on it and the K bytes before it only. So costs of all (K+1)-grams of the
trees are laid out once in an open-addressing table, and a text is scored by looking up all of its grams at once; grams in
no tree are priced by walking down the orders, for all of them together.

The sample: of each language, the `rows` documents with the smallest hash of id and text, of longer ones a window of
`longest` bytes at a place that the hash gives. `total` bounds the bytes of all languages together: each takes its share, one
document at least. At most `most_langs` languages are learned, those with the most labelled documents. This bounds the trees,
which the driver holds and sends out; the table of costs holds the most frequent grams only, and the rest are priced by the
trees, so it is bounded too and changes no result. Every byte of every text is scored.

Defined cases: null texts and texts without a letter are `und` with score 0; null ids count as '' in the split; rows that
repeat an id are samples of their own, and equal rows are one; very long texts are scored whole; ties go to the first language
in code point order; without labelled documents every text is `und`; carried columns named lang_pred or score give way; no
rows give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import carried, texts

ORDER = 3
SAMPLE_ROWS = 400
SAMPLE_BYTES = 1 << 15
#: Bytes of the samples of all languages together, and the largest number of languages.
SAMPLE_TOTAL = 16 << 20
MOST_LANGS = 1000
#: Costs (grams times languages) in the table.
TABLE_COSTS = 1 << 25
_LETTER = re.compile(r"[^\W\d_]")
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mask(order: int) -> np.uint64:
    """The last `order` bytes."""
    return np.uint64((1 << (8 * order)) - 1)


def grams(data: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Every byte with the `order` bytes before it in its text, zeros before the text; one number each, the byte lowest."""
    out = np.zeros(len(data), np.uint64)
    since = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for back in range(order + 1):
        shifted = np.zeros(len(data), np.uint64)
        shifted[back:] = data[: len(data) - back]
        shifted[since < back] = 0
        out |= shifted << np.uint64(8 * back)
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Tree:
    """Counts of one language: per order k, symbols after contexts of k bytes, and what contexts sum up to."""

    def __init__(self, seen: np.ndarray, order: int):
        self.order = order
        self.symbols, self.counts, self.contexts, self.totals, self.distinct = [], [], [], [], []
        for k in range(order + 1):
            keys, n = np.unique(seen & _mask(k + 1), return_counts=True)
            contexts, first = np.unique(keys >> np.uint64(8), return_index=True)
            self.symbols.append(keys)
            self.counts.append(n)
            self.contexts.append(contexts)
            self.totals.append(np.add.reduceat(n, first))
            self.distinct.append(np.diff(np.append(first, len(keys))))
        # per context of order k: what is left of its suffix once the context's own symbols are excluded
        self.left: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0))]
        for k in range(1, order + 1):
            below = self.counts[k - 1][_find(self.symbols[k - 1], self.symbols[k] & _mask(k))[0]]
            own = np.searchsorted(self.symbols[k] >> np.uint64(8), self.contexts[k])
            suffix = _find(self.contexts[k - 1], self.contexts[k] & _mask(k - 1))[0]
            self.left.append((self.totals[k - 1][suffix] - np.add.reduceat(below, own), self.distinct[k - 1][suffix] - self.distinct[k]))

    def bits(self, wanted: np.ndarray) -> np.ndarray:
        """Exact code length of the last byte of every gram."""
        cost, open_ = np.zeros(len(wanted)), np.ones(len(wanted), bool)
        above = np.full(len(wanted), -1)  # the context of the next longer order, if known
        for k in range(self.order, -1, -1):
            context, known = _find(self.contexts[k], (wanted >> np.uint64(8)) & _mask(k))
            symbol, hit = _find(self.symbols[k], wanted & _mask(k + 1))
            total, distinct = self.totals[k][context].astype(float), self.distinct[k][context].astype(float)
            if k < self.order:
                came = above >= 0
                total[came], distinct[came] = self.left[k + 1][0][above[came]], self.left[k + 1][1][above[came]]
            here = open_ & known
            some = here & (total + distinct > 0)
            cost[some] += np.log2(total[some] + distinct[some])
            found, escaped = here & hit, here & ~hit & (distinct > 0)
            cost[found] -= np.log2(self.counts[k][symbol[found]])
            cost[escaped] -= np.log2(distinct[escaped])
            open_ &= ~found
            above = np.where(known, context, -1)
        cost[open_] += np.log2(256 - len(self.symbols[0]))
        return cost


@dataclass
class Model:
    """The trees of all languages and the table of costs; built once, then only read."""

    langs: list[str]
    trees: list[Tree]
    order: int
    keys: np.ndarray
    rows: np.ndarray
    costs: np.ndarray

    @classmethod
    def trained(cls, samples: dict[str, list[bytes]], order: int = ORDER, most: int = TABLE_COSTS) -> Model:
        langs = sorted(x for x, t in samples.items() if any(t))
        seen = []
        for lang in langs:
            sizes = [0, *map(len, samples[lang])]
            seen.append(grams(np.frombuffer(b"".join(samples[lang]), np.uint8), np.cumsum(sizes), order))
        trees = [Tree(s, order) for s in seen]
        every, times = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64),) * 2
        if len(every) * len(langs) > most:
            every = np.sort(every[np.argsort(-times, kind="stable")[: most // len(langs)]])
        costs = np.stack([t.bits(every) for t in trees], 1).astype(np.float32) if trees else np.zeros((0, 0), np.float32)
        size = 1 << max(10, int(4 * max(1, len(every)) - 1).bit_length())
        keys, rows = np.full(size, _EMPTY), np.zeros(size, np.int32)
        wait, at = np.arange(len(every)), _slots(every, size)
        while len(wait):
            free = keys[at] == _EMPTY
            slot, first = np.unique(at[free], return_index=True)
            taken = wait[free][first]
            keys[slot], rows[slot] = every[taken], taken
            rest = keys[at] != every[wait]
            wait, at = wait[rest], (at[rest] + (keys[at[rest]] != _EMPTY)) & (size - 1)
        return cls(langs, trees, order, keys, rows, costs)

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length of every text under every language."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        if not len(data) or not self.langs:
            return out
        wanted = grams(data, offsets, self.order)
        at = _slots(wanted, len(self.keys))
        row = self.rows[at]
        bad = np.flatnonzero(self.keys[at] != wanted)
        at, missing = at[bad], []
        while len(bad):  # go on probing where another key or nothing stood
            empty = self.keys[at] == _EMPTY
            missing.append(bad[empty])
            bad, at = bad[~empty], (at[~empty] + 1) & (len(self.keys) - 1)
            hit = self.keys[at] == wanted[bad]
            row[bad[hit]] = self.rows[at[hit]]
            bad, at = bad[~hit], at[~hit]
        cost = self.costs[row]
        if missing and len(lost := np.concatenate(missing)):
            unseen, back = np.unique(wanted[lost], return_inverse=True)
            cost[lost] = np.stack([t.bits(unseen) for t in self.trees], 1)[back]
        full = np.flatnonzero(np.diff(offsets))
        out[full] = np.add.reduceat(cost, offsets[:-1][full], axis=0, dtype=np.float64)
        return out

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and posterior under equal priors of every text."""
        bits, n = self.bits(data, offsets), len(offsets) - 1
        if not self.langs:
            return ["und"] * n, np.zeros(n)
        best = bits.argmin(1)
        score = 1 / np.exp2(-np.minimum(bits - bits.min(1, keepdims=True), 1000)).sum(1)
        sums = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_ASCII_LETTER[data], out=sums[1:])
        lettered = sums[offsets[1:]] > sums[offsets[:-1]]
        for k in np.flatnonzero(~lettered):
            lettered[k] = bool(_LETTER.search(data[offsets[k] : offsets[k + 1]].tobytes().decode("utf-8", "replace")))
        return [self.langs[b] if yes else "und" for b, yes in zip(best, lettered, strict=True)], np.where(lettered, score, 0.0)


def _slots(keys: np.ndarray, size: int) -> np.ndarray:
    return ((keys * _ODD) >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)


def remainder(id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit("")).cast("binary")), F.lit(4))


def learn(docs: DataFrame, rows: int = SAMPLE_ROWS, longest: int = SAMPLE_BYTES, order: int = ORDER, total: int = SAMPLE_TOTAL, most_langs: int = MOST_LANGS) -> Model:
    """Learns from documents that are not held out; docs has doc_id, text and lang."""
    spark = docs.sparkSession
    fit = docs.where((remainder(F.col("doc_id")) != 2) & F.col("lang").isNotNull() & (F.length("text") > 0))
    fit = fit.select("lang", "text", F.xxhash64("doc_id", "text").alias("li_place"))
    # about 2 rows + 50 of each language have a place below its bound, all where it has no more; never fewer than rows else
    place = F.shiftrightunsigned("li_place", 34)
    sizes = fit.select("lang", "li_place").distinct().groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_langs)
    known = [(r.lang, min(1 << 30, (2 * rows + 50) * (1 << 30) // r.n + 1)) for r in sizes.collect()]  # at most most_langs rows
    if not known:
        return Model.trained({}, order)
    bounds = F.broadcast(spark.createDataFrame(known, "lang string, li_most long"))
    whole = F.col("text").cast("binary")
    at = F.pmod(F.col("li_place"), F.greatest(F.octet_length("text") - longest, F.lit(1))) + 1
    window = F.when(F.octet_length("text") <= longest, whole).otherwise(F.substring(whole, at.cast("int"), F.lit(longest)))
    chosen = fit.join(bounds, "lang").where(place < F.col("li_most")).select("lang", "li_place", window.alias("text")).distinct()
    share = max(1, total // len(known))
    own = Window.partitionBy("lang").orderBy("li_place", "text")
    before = F.coalesce(F.sum(F.octet_length("text")).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chosen = chosen.withColumns({"li_rank": F.row_number().over(own), "li_before": before}).where((F.col("li_rank") <= rows) & (F.col("li_before") < share))
    samples: dict[str, list[bytes]] = {}
    for r in chosen.select("lang", "text").orderBy("lang", "li_place").collect():  # at most total, and one document a language more
        samples.setdefault(r.lang, []).append(bytes(r.text))
    return Model.trained(samples, order)


def _predicted(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, scores = [], []
        for _, data, offsets in texts(batch.column(0), 1 << 19):
            lang, score = model.value.predict(data, offsets)
            langs += lang
            scores.append(score)
        if langs:
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(langs, pa.string()), pa.array(np.concatenate(scores), pa.float64())], [*batch.schema.names[1:], "lang_pred", "score"])


def predict(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """The columns `carry`, lang_pred and score of every row."""
    carry = carried(carry, ("lang_pred", "score"))
    source = docs.select(F.col(text).cast("binary").alias("li_text"), *carry)
    schema = T.StructType([*source.schema.fields[1:], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return source.mapInArrow(lambda it: _predicted(it, shared), schema)
