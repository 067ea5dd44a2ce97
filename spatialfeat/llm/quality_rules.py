"""Quality rules with risk-controlled thresholds.

Every text is measured once. Two base rules reject short and repetitive texts. A further score, a logistic model of the
measurements fitted on a bounded sample of one half of the labelled documents, rejects above a cutoff that is chosen per
stratum on the other half: going down an even grid of cutoffs, a cutoff is certified while an exact binomial test rejects
that it drops more than `alpha` of the good documents, at level delta / strata. The fixed order needs no correction within
a stratum, Bonferroni's corrects over strata: with probability 1 - delta no stratum loses more than alpha of its good
documents to the cutoff. Among the certified cutoffs, the one with the least error on the fitting half is taken. A stratum
with too few labels for any certificate keeps everything the base rules keep.

The counts behind the tests cover all labelled documents. They are summed up per stratum and cutoff, and every stratum is
certified by itself in a task, so nothing that grows with the strata reaches the driver.

Defined cases: null text has no words and fails the base rules; very long texts are measured whole; null strata are a stratum;
null ids have no label; labels given twice count as the worse; rows that repeat an id are judged by their own text, and in the
fitting sample rows with equal id and measures count once, so that no id can fill it; without labels of both kinds nothing but
the base rules rejects; ties of scores fall on one side of a cutoff; carried columns named like an output give way; no rows give
no rows. Words and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, carried, materialise, mix, shingle_hashes, texts

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_shouts", "n_digits")
#: So many labelled documents are fitted on, chosen by hashes of their ids and measures; twice as many are never exceeded.
FIT_ROWS = 20_000
GRID = 1024
#: Cutoffs are evenly spaced over the scores of the fitting half within this many logits.
LOGIT = 10.0
#: Cutoffs are broadcast up to so many strata; beyond, they are joined.
FEW_STRATA = 10_000
GOOD = 20


def _bytes(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _UPPER, _SHOUT, _DIGIT = (_bytes(x) for x in (b"#*$%&|<>", bytes(range(65, 91)), b"!?", bytes(range(48, 58))))
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False
_LEAD[[0x20, *range(0x09, 0x0E)]] = False


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])


def measure_texts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """MEASURES of the texts laid end to end in data."""
    n = len(offsets) - 1
    words = Words(data, offsets)
    n_words = np.diff(words.first)
    of_word = np.repeat(np.arange(n), n_words)
    # lines: they start at texts and after newlines, and end before newlines and at ends of texts
    newline = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], newline + 1]), kind="stable")
    of_line = np.repeat(np.arange(n), np.diff(np.searchsorted(newline, offsets)) + 1)
    order = np.argsort(np.concatenate([offsets[1:], newline]), kind="stable")
    ends = np.concatenate([offsets[1:], newline])[order]
    full = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    key = mix(words.span_hashes(starts[full], ends[full]) + mix(of_line[full].astype(np.uint64) + np.uint64(1)))
    first = np.unique(key, return_index=True)[1]
    lines = np.bincount(of_line[full], minlength=n)
    distinct = np.bincount(of_line[full][first], minlength=n)
    # windows of eight words found twice in a text
    repeated = np.zeros(n, np.int64)
    if len(words.hashes) >= WINDOW:
        at = np.flatnonzero(of_word[: len(of_word) - WINDOW + 1] == of_word[WINDOW - 1 :])
        key = mix(shingle_hashes(words.hashes, WINDOW)[at] + mix(of_word[at].astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        repeated = _per_text(_covered(at[twice], len(of_word)), words.first)
    return [
        n_words, _per_text(_LEAD[data], offsets), _per_text(_SYMBOL[data], offsets), lines - distinct, repeated,
        lines, _per_text(_UPPER[data], offsets), _per_text(_SHOUT[data], offsets), _per_text(_DIGIT[data], offsets),
    ]


def _covered(at: np.ndarray, n: int) -> np.ndarray:
    """Which of n words lie in a window that starts at one of `at`."""
    edge = np.bincount(at, minlength=n + 1).astype(np.int64)[: n + 1]
    edge -= np.bincount(at + WINDOW, minlength=n + 1)[: n + 1]
    return np.cumsum(edge)[:n] > 0


def _measured(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    skip = 0 if keep_text else 1
    for batch in batches:
        rows = [measure_texts(data, offsets) for _, data, offsets in texts(batch.column(0))]
        if rows:
            columns = [pa.array(np.concatenate(x), pa.int64()) for x in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[skip:], *columns], [*batch.schema.names[skip:], *MEASURES])


def measure(docs: DataFrame, carry: list[str], text: str = "text", keep_text: bool = False) -> DataFrame:
    """The columns `carry` and MEASURES of every row; with keep_text also the bytes of the text as qr_text."""
    source = docs.select(F.col(text).cast("binary").alias("qr_text"), *carried(carry, MEASURES))
    schema = T.StructType(source.schema.fields[0 if keep_text else 1 :] + [T.StructField(m, T.LongType()) for m in MEASURES])
    return source.mapInArrow(lambda it: _measured(it, keep_text), schema)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


#: Rates that the score is a function of: the first argument counts, the second is the whole, and the third is added to the
#: whole, so that a few characters of a short text do not make a high rate.
RATES = (
    ("n_symbols", "word_chars", 100), ("n_upper", "word_chars", 100), ("n_shouts", "n_words", 20), ("n_digits", "word_chars", 100),
    ("n_dup_lines", "n_lines", 2), ("n_repeat_words", "n_words", 20), ("word_chars", "n_words", 20),
)


@dataclass
class Rules:
    """A fitted score and a table (qr_stratum, cutoff, good, certified) with a row per stratum of the holdouts.

    cutoff is null where none is certified; good is the number of good holdouts, certified that of certified cutoffs.
    """

    weights: list[float]
    bias: float
    cutoffs: DataFrame | None = None
    few: bool = True  # whether the table is small enough to be broadcast

    def score(self) -> Column:
        total = F.lit(self.bias)
        for w, (part, whole, more) in zip(self.weights, RATES, strict=True):
            total = total + F.lit(w) * (F.col(part).cast("double") / (F.col(whole) + more))
        return total

    def judge(self, measured: DataFrame, stratum: str) -> DataFrame:
        """Adds base_failed, score, cutoff and kept."""
        rest = [F.col(f"m.`{c}`") for c in carried(measured.columns, ("base_failed", "score", "cutoff", "kept"))]
        if self.cutoffs is None:
            met = measured.alias("m").select(*rest, F.lit(None).cast("double").alias("cutoff"))
        else:
            table = self.cutoffs.select("qr_stratum", F.col("cutoff").alias("qr_cutoff"))
            same = F.col(f"m.`{stratum}`").cast("string").eqNullSafe(F.col("qr_stratum"))
            met = measured.alias("m").join(F.broadcast(table) if self.few else table, same, "left").select(*rest, F.col("qr_cutoff").alias("cutoff"))
        met = met.withColumns({"base_failed": base_failed(), "score": self.score()})
        return met.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(F.col("score") > F.col("cutoff"), F.lit(False)))


def at_most(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exact up to rounding.

    The tail that does not hold the mode is summed, from its largest term on: where that underflows, the tail is nothing.
    """
    if k < 0:
        return 0.0
    if n == 0 or k >= n:
        return 1.0
    upper = k + 1 > (n + 1) * p
    i, odds = (k + 1 if upper else k), p / (1 - p)
    term = math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
    total = term
    while term > 1e-18 * total and (i < n if upper else i > 0):
        if upper:
            term *= (n - i) / (i + 1) * odds
            i += 1
        else:
            term *= i / (n - i + 1) / odds
            i -= 1
        total += term
    return max(0.0, 1 - total) if upper else min(1.0, total)


def allowed(n: int, alpha: float, level: float) -> int:
    """The most of n good documents that a certified cutoff drops: the largest k with P(Bin(n, alpha) <= k) <= level, -1 for none."""
    low, high = -1, n
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if at_most(middle, n, alpha) <= level else (low, middle)
    return low


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 10.0) -> tuple[np.ndarray, float]:
    """Class-balanced ridge logistic regression by Newton's method, for y = 1 at bad documents."""
    mean, scale = x.mean(0), np.where((s := x.std(0)) > 1e-12, s, 1.0)
    z = np.c_[(x - mean) / scale, np.ones(len(x))]
    balance = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    w = np.zeros(z.shape[1])
    penalty = np.diag([ridge] * x.shape[1] + [1e-9])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (balance * p * (1 - p))[:, None]).T @ z + penalty, z.T @ (balance * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / scale
    return weights, float(w[-1] - weights @ mean)


def _certified(batches: Iterator[pa.RecordBatch], cuts: np.ndarray, error: np.ndarray, alpha: float, level: float) -> Iterator[pa.RecordBatch]:
    """For every stratum (qr_stratum, counts by place on the grid) its cutoff, good holdouts and certified cutoffs."""
    for batch in batches:
        rows = []
        for s, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            by = np.zeros(len(cuts) + 1, np.int64)
            for c in counts:
                by[c["b"]] += c["n"]
            # a document with score above b of the cutoffs is above the b smallest, the last b of the falling grid
            total = int(by.sum())
            dropped = np.cumsum(by[::-1])[: len(cuts)]
            certified = int(np.searchsorted(dropped, allowed(total, alpha, level), "right"))
            rows.append((s, float(cuts[int(np.argmin(error[:certified]))]) if certified else None, total, certified))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), _CUTOFFS.values(), strict=True)], list(_CUTOFFS))


_CUTOFFS = {"qr_stratum": pa.string(), "cutoff": pa.float64(), "good": pa.int64(), "certified": pa.int64()}


def fit(measured: DataFrame, labels: DataFrame, stratum: str, alpha: float = 0.05, delta: float = 0.05, grid: int = GRID, fit_rows: int = FIT_ROWS) -> Rules:
    """Fits score and cutoffs. measured has doc_id, the stratum and MEASURES; labels has doc_id and quality (1: good)."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("qr_good"))
    rows = measured.where(~base_failed()).join(known, "doc_id").select(F.col(stratum).cast("string").alias("qr_stratum"), *MEASURES, "qr_good", "doc_id")
    rows = materialise(rows.withColumn("qr_half", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(2))))
    fitted = rows.where("qr_half = 0").select(*MEASURES, "qr_good", "doc_id").distinct()
    share = min(1.0, fit_rows / max(1, fitted.count()))
    place = F.shiftrightunsigned(F.xxhash64("doc_id", *MEASURES), 34)
    sample = fitted.where(place < int(share * (1 << 30))).limit(2 * fit_rows).toPandas()
    rules = Rules([0.0] * len(RATES), 0.0)
    sample = sample.sort_values(["doc_id", *MEASURES])
    y = 1.0 - sample["qr_good"].to_numpy(float)
    if not 0 < y.sum() < len(y):
        return rules
    x = np.stack([sample[a].to_numpy(float) / (sample[b].to_numpy(float) + more) for a, b, more in RATES], 1)
    weights, rules.bias = _logistic(x, y)
    rules.weights = [float(w) for w in weights]
    scores = x @ weights + rules.bias
    low, high = np.clip([scores.min(), scores.max()], -LOGIT, LOGIT)
    step = float(max(high - low, 1e-6) / grid)
    cuts = (float(low) + step * np.arange(grid))[::-1].copy()
    error = np.array([GOOD * (scores[y == 0] > c).mean() + (scores[y == 1] <= c).mean() for c in cuts])
    above = F.greatest(F.least(F.ceil((F.col("qr_score") - float(low)) / step), F.lit(grid)), F.lit(0))
    held = rows.where("qr_half = 1 AND qr_good = 1").select("qr_stratum", rules.score().alias("qr_score"))
    counts = held.select("qr_stratum", above.cast("int").alias("b")).groupBy("qr_stratum", "b").agg(F.count("*").alias("n"))
    # grid + 1 counts a stratum at most
    by = materialise(counts.groupBy("qr_stratum").agg(F.collect_list(F.struct("b", "n")).alias("counts")))
    strata = by.count()
    made = by.mapInArrow(lambda it: _certified(it, cuts, error, alpha, delta / max(1, strata)), "qr_stratum string, cutoff double, good long, certified long")
    rules.cutoffs, rules.few = materialise(made), strata <= FEW_STRATA
    return rules
