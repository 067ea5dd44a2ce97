"""Suffix-array dedup with sparse suffix arrays.

Passages of at least `least` words that stand in another document too are found from suffixes at few positions only. Of
every run of `least` words, the k-word gram with the smallest hash is selected by its content (a minimiser), so two equal
passages select the same position. Each selected suffix is kept with the words around it that a passage of `least` words
can reach. Suffixes that start with one gram meet, are sorted, and neighbours are compared; matches are extended to the
right and to the left of the selected position. Where neighbours do not settle it, since the longest common prefix and
the longest common extension to the left may come from different suffixes, all runs of `least` words around the position
are compared, so that the result is exact for any group.

Records travel packed, a few large rows per task. Before they are sent, suffixes whose whole surroundings agree between
documents of one task settle each other, and two of them stand for all. The longest passages need no long records: they
contain many selected positions, and what these find is joined per document.

A first look at all texts counts selected grams in a sketch of fixed size. A gram with more records than a quarter of a task's
share is hot: it may stand in a third of all documents, in other surroundings each time. Its suffixes do not meet under the
gram. Instead, every run of `least` words whose smallest gram it is is sent under the hash of the whole run, so that hot grams
spread over all tasks, as far as their surroundings differ; runs that documents of one task share settle each other, and
two stand for all. Two equal runs have the same smallest gram, so both take the same way, and the result does not
depend on which grams are hot.

Words are compared under A-Z lower-casing by hashes, 64 bits for the gram and 16 bits a word around it.

Defined cases: null and short texts have no passage; a row without an id is a document of its own, and its output has no id either; a
passage repeated only within one document (rows with one doc_id are one document) is none; ids below -2**62 are an error; very long texts are read whole, in one piece; the order of equal rows says
nothing; columns but doc_id and the text do not come along, so none can clash; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SEGMENTS, Words, dealing_keys, folded, materialise, mix, reduce_partitions, shingle_hashes, texts

LEAST = 50
GRAM = 10
#: Counters of the sketch.
CELLS = 1 << 20
#: Records of a gram from which it may be hot, whatever the share of a task.
HOT_LEAST = 1000
#: Records that a task gathers before it sends them.
BUFFER = 120_000
#: Rows without an id get ids below this one.
_NULL = -(1 << 62)
_OUT = pa.schema([("part", pa.int32()), ("seeds", pa.binary()), ("docs", pa.binary()), ("at", pa.binary()), ("around", pa.binary())])
_SPANS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over every run of `width` neighbours, by doubling."""
    have, out = 1, x
    while 2 * have <= width:
        out, have = pick(out[: len(out) - have], out[have:]), 2 * have
    return pick(out[: len(out) - (width - have)], out[width - have :]) if have < width else out


def selected(hashes: np.ndarray, of_word: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes of the grams that are the smallest of some run of `least` words of one text, and for every word
    the smallest gram of the run that starts there, 0 if none does."""
    width, n = least - gram + 1, len(hashes)
    if n < least:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = shingle_hashes(hashes, gram) | np.uint64(1)
    smallest = _slide(grams, width, np.minimum)
    smallest[of_word[: n - least + 1] != of_word[least - 1 :]] = 0
    padded = np.concatenate([np.zeros(width - 1, np.uint64), smallest, np.zeros(width - 1, np.uint64)])
    at = np.flatnonzero(_slide(padded, width, np.maximum) == grams)
    return at, grams[at], smallest


def _counted(batches: Iterator[pa.RecordBatch], least: int, gram: int, cells: int) -> Iterator[pa.RecordBatch]:
    """The task's share of the sketch of selected grams."""
    count = np.zeros(cells, np.int64)
    for batch in batches:
        for _, data, offsets in texts(batch.column(0)):
            words = Words(data, offsets, lower=True)
            counts = np.diff(words.first)
            seeds = selected(words.hashes, np.repeat(np.arange(len(counts)), counts), least, gram)[1]
            if len(seeds):
                count += np.bincount(_cell(seeds, cells), minlength=cells)
    if count.any():
        packed = [zstandard.compress(part.astype(np.uint32).tobytes(), 1) for part in count.reshape(SEGMENTS, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SEGMENTS), pa.int32()), pa.array(packed, pa.binary())], ["segment", "cells"])


def _cell(seeds: np.ndarray, cells: int) -> np.ndarray:
    return (mix(seeds) & np.uint64(cells - 1)).astype(np.int64)


def merged_spans(docs: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of documents in order, those that overlap or touch as one."""
    order = np.lexsort((start, docs))
    docs, start, end = docs[order], start[order], end[order]
    if not len(docs):
        return docs, start, end
    new_doc = np.concatenate([[True], docs[1:] != docs[:-1]])
    far = np.int64(end.max()) + 1
    lift = np.cumsum(new_doc) * far  # ends of later documents are above all of earlier ones
    reached = np.maximum.accumulate(end + lift)
    new = new_doc | np.concatenate([[True], (start + lift)[1:] > reached[:-1]])
    first = np.flatnonzero(new)
    return docs[first], start[first], (reached - lift)[np.append(first[1:], len(docs)) - 1]


class Records:
    """Selected suffixes: seed, document, position, and 16-bit words around (0 outside of the text)."""

    def __init__(self, seeds, docs, at, around):
        self.seeds, self.docs, self.at, self.around = seeds, docs, at, around

    def __len__(self):
        return len(self.seeds)

    def take(self, index) -> Records:
        return Records(self.seeds[index], self.docs[index], self.at[index], self.around[index])

    @staticmethod
    def joined(parts: list[Records]) -> Records:
        return Records(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("seeds", "docs", "at", "around")))


class Runs:
    """Runs of `least` words, by the hash of all their words: document and position of the first word."""

    def __init__(self, keys, docs, at):
        self.keys, self.docs, self.at = keys, docs, at

    def __len__(self):
        return len(self.keys)

    @staticmethod
    def joined(parts: list[Runs]) -> Runs:
        return Runs(*(np.concatenate([getattr(p, k) for p in parts]) if parts else np.zeros(0, t) for k, t in (("keys", np.uint64), ("docs", np.int64), ("at", np.int64))))


def records_of(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, least: int, gram: int, hot: np.ndarray) -> tuple[Records, Runs]:
    """Records of selected suffixes, and instead of those of hot grams the runs that they are the smallest of."""
    words = Words(data, offsets, lower=True)
    counts = np.diff(words.first)
    of_word = np.repeat(np.arange(len(counts)), counts)
    at, seeds, smallest = selected(words.hashes, of_word, least, gram)
    is_hot = hot[_cell(seeds, len(hot))]
    start = np.flatnonzero((smallest > 0) & hot[_cell(smallest, len(hot))]) if is_hot.any() else np.zeros(0, np.int64)
    keys = np.zeros(len(start), np.uint64)
    for j in range(least if len(start) else 0):
        keys = keys * np.uint64(0x9E3779B97F4A7C15) + words.hashes[start + j]
        keys ^= keys >> np.uint64(29)
    runs = Runs(mix(keys), ids[of_word[start]], start - words.first[of_word[start]])
    at, seeds = at[~is_hot], seeds[~is_hot]
    short = (words.hashes >> np.uint64(48)).astype(np.uint16)
    short[short == 0] = 1
    where = at[:, None] + np.arange(gram - least, least)[None, :]
    inside = (where >= 0) & (where < len(short))
    where = np.where(inside, where, 0)
    around = np.where(inside & (of_word[where] == of_word[at][:, None]), short[where], 0).astype(np.uint16) if len(at) else np.zeros((0, 2 * least - gram), np.uint16)
    doc = of_word[at]
    return Records(seeds, ids[doc], at - words.first[doc], around), runs


def shared_runs(r: Runs, least: int) -> tuple[Runs, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Runs in order of key and document, of which groups each is the first or last document, and spans of those that
    stand in two documents and more."""
    order = np.lexsort((r.at, r.docs, r.keys))
    r = Runs(r.keys[order], r.docs[order], r.at[order])
    start = np.flatnonzero(np.concatenate([[True], r.keys[1:] != r.keys[:-1]])) if len(r) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(r)))
    last = start + size - 1
    shared = np.repeat(r.docs[start] != r.docs[last], size)
    edge = ~shared
    edge[start] = edge[last] = True
    return r, edge, merged_spans(r.docs[shared], r.at[shared], r.at[shared] + least)


def _reach(around: np.ndarray, least: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of the text that are in sight before and from the position."""
    left = least - gram
    return (around[:, :left] > 0).sum(1), (around[:, left:] > 0).sum(1)


def _span_batch(docs, start, end) -> pa.RecordBatch:
    doc = pa.array(docs, pa.int64())
    return pa.RecordBatch.from_arrays([doc, pa.array(start, pa.int64()), pa.array(end, pa.int64())], schema=_SPANS)


def _settle(r: Records, least: int, gram: int) -> tuple[Records, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """What of a buffer has to be sent, and the spans of records that agree in full between two documents."""
    key = mix(r.seeds)
    for column in r.around.view(np.uint16).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    order = np.lexsort((r.docs, key))
    r, key = r.take(order), key[order]
    same = (key[1:] == key[:-1]) & (r.seeds[1:] == r.seeds[:-1]) & (r.around[1:] == r.around[:-1]).all(1)
    start = np.flatnonzero(np.concatenate([[True], ~same])) if len(key) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(key)))
    last = start + size - 1
    shared = np.repeat(r.docs[start] != r.docs[last], size)
    keep = ~shared
    keep[start] = keep[last] = True
    left, right = _reach(r.around, least, gram)
    return r.take(keep), merged_spans(r.docs[shared], (r.at - left)[shared], (r.at + right)[shared])


def _sent(batches: Iterator[pa.RecordBatch], keys: np.ndarray, least: int, gram: int, hot) -> Iterator[pa.RecordBatch]:
    """Packed records, one row per partition and buffer; rows without words around carry runs, and rows without seeds spans
    that are settled."""
    parts: list[Records] = []
    runs: list[Runs] = []

    def dealt(by: np.ndarray, columns: list[np.ndarray]) -> Iterator[tuple]:
        """The columns cut by the partition that each row of them goes to."""
        to = (mix(by) % np.uint64(len(keys))).astype(np.int64)
        order = np.argsort(to, kind="stable")
        edges = np.searchsorted(to[order], np.arange(len(keys) + 1))
        for k in np.flatnonzero(np.diff(edges)):
            yield int(keys[k]), *(c[order[edges[k] : edges[k + 1]]].tobytes() for c in columns)

    def flush():
        rows, spans = [], []
        if parts:
            r, found = _settle(Records.joined(parts), least, gram)
            spans.append(found)
            rows += dealt(r.seeds, [r.seeds, r.docs, r.at, r.around])
        if runs:
            r, edge, found = shared_runs(Runs.joined(runs), least)
            spans.append(found)
            rows += ((*row, b"") for row in dealt(r.keys[edge], [r.keys[edge], r.docs[edge], r.at[edge]]))
        parts.clear()
        runs.clear()
        for docs, start, end in spans:
            rows += ((k, b"", d, at, b"") for k, d, at in dealt(docs.astype(np.uint64), [docs.astype(np.int64), np.stack([start, end], 1).astype(np.int64)]))
        for k in range(0, len(rows), 64):  # rows of a few MB at once
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + 64], strict=True), _OUT, strict=True)], schema=_OUT)

    held = 0
    for batch in batches:
        ids = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for row, data, offsets in texts(batch.column(0)):
            r, more = records_of(data, offsets, ids[row:], least, gram, hot.value)
            if len(r):
                parts.append(r)
            if len(more):
                runs.append(more)
            held += len(r) + len(more) // 8  # a run takes a ninth of the room
            if held >= BUFFER:
                yield from flush()
                held = 0
    if parts or runs:
        yield from flush()


def matched(r: Records, least: int, gram: int) -> np.ndarray:
    """For every record and shift i, whether the run of `least` words that starts i words before it stands in another
    document. Records come in any order; those of one seed are compared."""
    left = least - gram
    shifts = np.arange(left + 1)
    # sort suffixes: by seed, then by the words from the position on
    columns = [r.around[:, j] for j in range(2 * least - gram - 1, left - 1, -1)]
    packed = [sum(c.astype(np.uint64) << np.uint64(16 * j) for j, c in enumerate(columns[a : a + 4])) for a in range(0, len(columns), 4)]
    order = np.lexsort((*packed, r.seeds))
    r = r.take(order)
    found = np.zeros((len(r), left + 1), bool)
    # compare neighbours: extend to the right and to the left
    equal = (r.around[1:] == r.around[:-1]) & (r.around[1:] > 0)
    run_right = np.cumprod(equal[:, left:], axis=1, dtype=np.uint8).sum(1)
    run_left = np.cumprod(equal[:, :left][:, ::-1], axis=1, dtype=np.uint8).sum(1)
    pair = (r.seeds[1:] == r.seeds[:-1]) & (r.docs[1:] != r.docs[:-1])
    hit = pair[:, None] & (shifts <= run_left[:, None]) & (least - shifts <= run_right[:, None])
    found[1:] |= hit
    found[:-1] |= hit
    # runs that neighbours did not settle, in groups of more than two
    before, after = _reach(r.around, least, gram)
    whole = (shifts <= before[:, None]) & (least - shifts <= after[:, None])
    start = np.flatnonzero(np.concatenate([[True], r.seeds[1:] != r.seeds[:-1]]))
    size = np.diff(np.append(start, len(r)))
    open_ = np.add.reduceat((whole & ~found).any(1), start) > 0
    rest = np.flatnonzero(np.repeat(open_ & (size > 2), size))
    if len(rest):
        group, docs = mix(r.seeds[rest]), r.docs[rest]
        powers = np.multiply.accumulate(np.full(2 * least - gram, 0x9E3779B97F4A7C15, np.uint64))
        back = np.multiply.accumulate(np.full(2 * least - gram, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64))
        sums = np.zeros((len(rest), 2 * least - gram + 1), np.uint64)
        np.cumsum(r.around[rest].astype(np.uint64) * powers, axis=1, out=sums[:, 1:])
        for i in shifts:
            here = np.flatnonzero(whole[rest, i])
            a = left - i
            key = mix((sums[here, a + least] - sums[here, a]) * back[a]) ^ group[here]
            by = np.lexsort((docs[here], key))
            key, doc = key[by], docs[here][by]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            length = np.diff(np.append(first, len(key)))
            many = np.repeat(doc[first] != doc[first + length - 1], length)
            found[rest[here[by[many]]], i] = True
    out = np.zeros_like(found)
    out[order] = found & whole
    return out


def _met(batches: Iterator[pa.RecordBatch], least: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Spans of the documents whose records meet in this partition."""
    parts: list[Records] = []
    runs: list[Runs] = []
    for batch in batches:
        for seeds, docs, at, around in zip(*(batch.column(k).to_pylist() for k in range(1, 5)), strict=True):
            docs, at = np.frombuffer(docs, np.int64), np.frombuffer(at, np.int64)
            if around:
                parts.append(Records(np.frombuffer(seeds, np.uint64), docs, at, np.frombuffer(around, np.uint16).reshape(-1, 2 * least - gram)))
            elif seeds:
                runs.append(Runs(np.frombuffer(seeds, np.uint64), docs, at))
            else:
                spans = at.reshape(-1, 2)
                yield _span_batch(docs, spans[:, 0], spans[:, 1])
    if runs:
        yield _span_batch(*shared_runs(Runs.joined(runs), least)[2])
    if not parts:
        return
    r = Records.joined(parts)
    parts.clear()
    order = np.argsort(r.seeds, kind="stable")
    seeds = r.seeds[order]
    same = seeds[1:] == seeds[:-1]
    several = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    order = order[several]
    step = 50_000
    edges = [0]
    while edges[-1] < len(order):  # runs of whole groups
        edges.append(int(np.searchsorted(r.seeds[order], r.seeds[order][min(len(order), edges[-1] + step) - 1], "right")))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        some = r.take(order[a:b])
        found = matched(some, least, gram)
        yes = np.flatnonzero(found.any(1))
        most, fewest = found.shape[1] - 1 - found[yes][:, ::-1].argmax(1), found[yes].argmax(1)
        yield _span_batch(*merged_spans(some.docs[yes], some.at[yes] - most, some.at[yes] - fewest + least))


def _of_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, spans) of every document; rows (doc_id, start, end) of a document stand together."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def rows(docs, start, end):
        first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]]))
        ends = pa.array(np.append(first, len(docs)), pa.int32())
        spans = pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(end, pa.int64())], ["start", "end"])
        return pa.RecordBatch.from_arrays([pa.array(docs[first], pa.int64()), pa.ListArray.from_arrays(ends, spans, type=kind)], ["doc_id", "spans"])

    held = None  # the document that may go on
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
        held = merged_spans(*(columns if held is None else [np.concatenate(x) for x in zip(held, columns, strict=True)]))
        if len(held[0]):
            cut = int(np.searchsorted(held[0], held[0][-1]))
            if cut:
                yield rows(*(x[:cut] for x in held))
            held = tuple(x[cut:] for x in held)
    if held is not None and len(held[0]):
        yield rows(*held)


def repeated_spans(docs: DataFrame, least: int = LEAST, gram: int = GRAM, text: str = "text", cells: int = CELLS, hot_least: int = HOT_LEAST) -> DataFrame:
    """doc_id and spans, an array of (start, end) in words, of every document with a passage that another one has too."""
    n = reduce_partitions(docs)
    keys = dealing_keys(docs.sparkSession, n)
    id = F.col("doc_id").cast("long")
    low = F.raise_error(F.lit("ids must not be below -2**62")).cast("long")
    own = F.when(id.isNull(), F.lit(2 * _NULL) + F.monotonically_increasing_id()).when(id < _NULL, low).otherwise(id)
    source = docs.select(F.col(text).cast("binary").alias("text"), own.alias("doc_id"))
    sketch = materialise(source.select("text").mapInArrow(lambda it: _counted(it, least, gram, cells), "segment int, cells binary"))
    counts = folded(sketch, cells)
    hot = docs.sparkSession.sparkContext.broadcast(counts > max(hot_least, int(counts.sum()) // (4 * n)))
    sent = source.mapInArrow(lambda it: _sent(it, keys, least, gram, hot), "part int, seeds binary, docs binary, at binary, around binary")
    spans = sent.repartition(n, "part").mapInArrow(lambda it: _met(it, least, gram), "doc_id long, start long, end long")
    one = spans.repartition(n, "doc_id").sortWithinPartitions("doc_id").mapInArrow(_of_document, "doc_id long, spans array<struct<start: bigint, end: bigint>>")
    return one.select(F.when(F.col("doc_id") >= _NULL, F.col("doc_id")).alias("doc_id"), "spans")
