"""N-gram Jaccard join with prefix trees.

Two documents link when the Jaccard similarity of their sets of word 5-grams is at least 0.8; the result is the component
of links that a document lies in, exact, with no cap on partners or candidates.

Order. A sketch counts 5-grams of all documents in a fixed number of cells; 5-grams are ordered by the count of their cell,
then by hash. Any order is right; this one puts common passages last. The sketch is the only thing sent to all tasks.

Candidates. Similar sets share one of their first |x| - ceil(0.8 |x|) + 1 grams in this order. Those are posted under the
id of the set (a digest, so that equal sets are one) with their place in it, packed, to the task of the gram, which makes a
list of the sets that share it. Equal short lists are one list. Grams of a heavy cell (with more grams than a quarter of a task's
share, and than 16 cells have on average) are dealt over several tasks by set.

Bitmaps. Each set has a parity bitmap: the bits in which two bitmaps differ are at most the grams in which the sets differ.
Lists of up to a block are cut into the parts that sizes and bitmaps leave connected, so that sets which merely share a
passage drop out before any set is read.

Joining. Sets of a group are stored in a prefix tree, commonest gram first, so that similar sets share paths. A set
traverses the tree; the overlap with a path counts for all sets below it, and subtrees are left where even all remaining
grams could not reach the bound, or where all sets are connected to the probing set already. Out come the edges of a
spanning forest, never all pairs.

First round: groups of equal min-hash, in blocks of bounded size with one common member each. It connects most near copies,
so that a third of all rows being near copies of one text collapse to a component early. Second round: of all lists, those
whose sets lie in different components by now; lists over the same components are joined as one. A list that is too large
for a block is cut into blocks of sets of about one size. Two blocks are joined unless they are of one component or places
and sizes rule it out: if the gram of the list is the first that two sets share, their overlap is at most what is left of
either set from that gram on, and if it is not, they meet in another list. So every pair of sets that can be similar is
compared or connected, and sets that merely share a common passage are not compared block by block. A block holds
at most 512 sets and about a million grams.

Defined cases: null texts and texts without words have an empty set and link with nothing; very long texts are whole sets;
null ids take the component of their set and are never its name unless all are null; repeated rows are equal sets; columns but
doc_id and the text do not come along, so none can clash; no rows give no rows. Grams are hashed to 64 bits, compared by 48
bits and their rank. Sets are told apart by 128 bits: they are named by 64 of them, and where two sets would have one name, both
are named by the other 64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SEGMENTS, Words, dealing_keys, folded, materialise, mix, reduce_partitions, shingle_hashes, texts
from .components import connected_components

GRAM = 5
#: Cells of the sketch; its size is fixed, 4 bytes each.
CELLS = 1 << 20
#: Sets of a block; a set counts as several by its grams, so that a block holds about BLOCK * GRAMS_A_SET of them at most.
BLOCK = 512
GRAMS_A_SET = 2048
#: Grams of a cell from which it may be heavy, whatever the share of a task.
HEAVY = 1 << 18
BUFFER = 4 << 20
BLOOM_BITS = 1 << 27
#: Bits of the smallest parity bitmap; larger sets have the next power of two from their size on, up to the largest.
PARITY = 1024
PARITY_MOST = 1 << 14
#: So many sets at most may need another name. Among n sets about n * n / 2**65 do.
CLASHES = 10_000
_OCTAVE = 64  # ranks per doubling of a count


def gram_sets(data: np.ndarray, offsets: np.ndarray, gram: int = GRAM) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its grams; with fewer words, of the whole sequence."""
    words = Words(data, offsets, lower=True)
    for a, b in zip(words.first[:-1], words.first[1:], strict=True):
        h = words.hashes[a:b]
        if len(h) >= gram:
            s = shingle_hashes(h, gram)
            s.sort()
            yield s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif len(h):
            yield mix(shingle_hashes(h, len(h)) + np.uint64(len(h)))
        else:
            yield h


def digest(s: np.ndarray, bits: int = 64) -> tuple[int, int]:
    """Two 64-bit digests of a set; of the first one, so many bits count."""
    with np.errstate(over="ignore"):
        a = mix(np.array([mix(s).sum() + np.uint64(len(s))], np.uint64))[0]
        b = mix(np.array([mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()], np.uint64))[0]
    return int((a >> np.uint64(64 - bits)).astype(np.int64)), int(b.astype(np.int64))


def name_of(s: np.ndarray, clashes: frozenset[int], bits: int) -> int:
    """The digest that names a set: the first unless another set has it too."""
    a, b = digest(s, bits)
    return b if a in clashes else a


_FIRST = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("s", pa.int64()), ("check", pa.int64()), ("bits", pa.binary()), ("segment", pa.int32()), ("cells", pa.binary())])


def parity(s: np.ndarray) -> bytes:
    """Bit b tells whether an odd number of grams of the set falls on it."""
    bits = min(PARITY_MOST, max(PARITY, 1 << (len(s) - 1).bit_length()))
    odd = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def halved(bits: np.ndarray) -> np.ndarray:
    """The parity bitmap of half the bits."""
    return bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]


def _first_pass(batches: Iterator[pa.RecordBatch], cells: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Size and digests of every document's set, and at the end the task's share of the sketch."""
    count = np.zeros(cells, np.int64)
    for batch in batches:
        rows, held = [], []

        def counted():
            if held:
                np.add(count, np.bincount((np.concatenate(held) & np.uint64(cells - 1)).astype(np.int64), minlength=cells), out=count)
                held.clear()

        size = 0
        for _, data, offsets in texts(batch.column(0)):
            for s in gram_sets(data, offsets):
                rows.append((len(s), *digest(s, bits), parity(s)) if len(s) else (0, None, None, None))
                if len(s):
                    held.append(s)
                    size += len(s)
            if size > 2 * cells:
                counted()
                size = 0
        counted()
        n = len(rows)
        if n:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(_FIRST)[2:6], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), *columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], schema=_FIRST)
    if count.any():
        packed = [zstandard.compress(part.astype(np.uint32).tobytes(), 1) for part in count.reshape(SEGMENTS, -1)]
        none = pa.nulls(SEGMENTS, pa.int64())
        yield pa.RecordBatch.from_arrays([*[none] * 5, pa.nulls(SEGMENTS, pa.binary()), pa.array(range(SEGMENTS), pa.int32()), pa.array(packed, pa.binary())], schema=_FIRST)


def ordered(s: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """A set in the global order: rank of the cell in the upper 16 bits, hash below."""
    out = (ranks[(s & np.uint64(len(ranks) - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(48)) | (s >> np.uint64(16))
    out.sort()
    return out


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _posted(batches: Iterator[pa.RecordBatch], shared, keys: np.ndarray, percent: int, heavy: int, clashes: frozenset[int], bits: int) -> Iterator[pa.RecordBatch]:
    """Packed postings (gram, set, place of the gram in the set) for each partition; a set once per task."""
    ranks, known, grams, sets, held = shared.value, set(), [], [], 0
    schema = pa.schema([("part", pa.int32()), ("grams", pa.binary()), ("sets", pa.binary()), ("places", pa.binary())])

    def flush():
        g = np.concatenate(grams)
        s = np.repeat(np.array([x for x, _ in sets], np.int64), [n for _, n in sets])
        at = np.concatenate([np.arange(n, dtype=np.uint32) for _, n in sets])
        count = np.exp2((g >> np.uint64(48)).astype(float) / _OCTAVE)
        salt = np.where(count > heavy, mix(s.astype(np.uint64)) % np.maximum(1, count // heavy).astype(np.uint64), 0)
        to = (mix(g + salt * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(len(keys))).astype(np.int64)
        order = np.argsort(to, kind="stable")
        edges = np.searchsorted(to[order], np.arange(len(keys) + 1))
        g, s, at = g[order], s[order], at[order]
        rows = [(int(keys[k]), *(x[edges[k] : edges[k + 1]].tobytes() for x in (g, s, at))) for k in np.flatnonzero(np.diff(edges))]
        grams.clear()
        sets.clear()
        for k in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + 64], strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        for _, data, offsets in texts(batch.column(0)):
            for s in gram_sets(data, offsets):
                if len(s) and (name := name_of(s, clashes, bits)) not in known:
                    known.add(name)
                    first = ordered(s, ranks)[: prefix_length(len(s), percent)]
                    grams.append(first)
                    sets.append((name, len(first)))
                    held += len(first)
            if held > BUFFER // 4:
                yield from flush()
                held = 0
    if grams:
        yield from flush()


def _listed(batches: Iterator[pa.RecordBatch], heavy: int, block: int) -> Iterator[pa.RecordBatch]:
    """Distinct lists of two and more sets that share a gram. Lists that are longer than a block, or of which other tasks hold
    parts, have the gram as `part` and the places of the gram."""
    parts: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in (np.uint64, np.int64, np.uint32)]
    for batch in batches:
        for k, (own, kind) in enumerate(zip(parts, (np.uint64, np.int64, np.uint32), strict=True)):
            own += [np.frombuffer(x, kind) for x in batch.column(k + 1).to_pylist()]
    g, s, at = map(np.concatenate, parts)
    parts.clear()
    if not len(g):
        return
    order = np.argsort(g)
    same = g[order][1:] == g[order][:-1]
    order = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]  # grams of one set are of no use
    cut = np.exp2((g >> np.uint64(48)).astype(float) / _OCTAVE) > heavy
    order = np.concatenate([order, np.flatnonzero(cut)])
    order = order[np.lexsort((s[order], g[order]))]
    g, s, at = g[order], s[order], at[order]
    if not len(g):
        return
    new = np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])])
    g, s, at = g[new], s[new], at[new]
    start = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    size = np.diff(np.append(start, len(g)))
    found: dict[bytes, None] = {}
    two = start[(size == 2)]
    pairs = np.unique(np.stack([s[two], s[two + 1]], 1), axis=0) if len(two) else np.zeros((0, 2), np.int64)
    rows: list[tuple] = []
    for a, n in zip(start, size, strict=True):
        if n > block or np.exp2(int(g[a] >> np.uint64(48)) / _OCTAVE) > heavy:
            part = (int(g[a]) >> 1) + 1
            for b in range(a, a + n, 1 << 16):
                end = min(b + (1 << 16), a + n)
                rows.append((part, s[b:end].tobytes(), at[b:end].tobytes()))
        elif n > 2:
            found[s[a : a + n].tobytes()] = None
    rows += ((0, p.tobytes(), None) for p in pairs)
    rows += ((0, x, None) for x in found)
    for k in range(0, len(rows), 1024):
        part, sets, places = zip(*rows[k : k + 1024], strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(sets, pa.binary()), pa.array(places, pa.binary())], ["part", "sets", "places"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(list, s, place) of every set of every list (list, sets, places); place is null in short lists."""
    for batch in batches:
        for name, packed, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sets = np.frombuffer(packed, np.int64)
            at = None if places is None else np.frombuffer(places, np.uint32).astype(np.int64)
            for k in range(0, len(sets), 1 << 16):
                own = sets[k : k + (1 << 16)]
                place = pa.nulls(len(own), pa.int64()) if at is None else pa.array(at[k : k + (1 << 16)], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), name), pa.int64()), pa.array(own, pa.int64()), place], ["list", "s", "place"])


def near(n: np.ndarray, bits: list[np.ndarray], percent: int) -> np.ndarray:
    """For sizes and bitmaps (64-bit words) of one list, which pairs sizes and bitmaps do not rule out.

    Similar sets differ in size by less than a doubling, so their bitmaps do by one at most: they meet at the smaller.
    """
    both = n[:, None] + n[None, :]
    need = -(-percent * both // (100 + percent))
    differ = np.full(both.shape, np.iinfo(np.int64).max)
    width = np.array([len(b) for b in bits])
    for w in np.unique(width):
        here = np.flatnonzero((width == w) | (width == 2 * w))
        words = np.stack([bits[k] if width[k] == w else halved(bits[k]) for k in here])
        for row, k in enumerate(here):
            meet = np.minimum(width[k], width[here]) == w
            differ[k, here[meet]] = np.bitwise_count(words[row] ^ words[meet]).sum(1)
    return (need <= np.minimum(n[:, None], n[None, :])) & (differ <= both - 2 * need)


def parts_of(fits: np.ndarray) -> list[np.ndarray]:
    """Connected parts of two and more of a symmetric relation."""
    left, out = np.ones(len(fits), bool), []
    while left.any():
        part = np.zeros(len(fits), bool)
        new = np.zeros(len(fits), bool)
        new[left.argmax()] = True
        while new.any():
            part |= new
            new = fits[new].any(0) & left & ~part
        left &= ~part
        if part.sum() > 1:
            out.append(np.flatnonzero(part))
    return out


def _refined(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(list, s) of the parts of lists that may hold similar sets; rows (list, s, n, bits) of a list stand together."""
    group, rows, names, sets = None, [], [], []

    def judged():
        n = np.array([r[1] for r in rows])
        for part in parts_of(near(n, [np.frombuffer(r[2], np.uint64) for r in rows], percent)):
            name = mix(np.array([group]).view(np.uint64) + np.uint64(part[0])).view(np.int64)[0]
            names.extend([int(name)] * len(part))
            sets.extend(rows[k][0] for k in part)

    def out():
        made = pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(sets, pa.int64())], ["list", "s"])
        names.clear()
        sets.clear()
        return made

    for batch in batches:
        for g, s, n, bits in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if g != group:
                if len(rows) > 1:
                    judged()
                group, rows = g, []
            rows.append((s, n, bits))
        if names:
            yield out()
    if len(rows) > 1:
        judged()
    if names:
        yield out()


def _bloomed(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    out = np.zeros(bits // 32, np.uint32)
    for batch in batches:
        for at in _bloom_places(batch.column(0).to_numpy(zero_copy_only=False), bits):
            np.bitwise_or.at(out, at >> 5, (np.uint32(1) << (at & 31).astype(np.uint32)))
    if out.any():
        packed = [zstandard.compress(part.tobytes(), 1) for part in out.reshape(SEGMENTS, -1)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SEGMENTS), pa.int32()), pa.array(packed, pa.binary())], ["segment", "cells"])


def _bloom_places(s: np.ndarray, bits: int) -> list[np.ndarray]:
    h = mix(s.astype(np.int64).view(np.uint64))
    return [(h & np.uint64(bits - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)]


def _content(batches: Iterator[pa.RecordBatch], shared, bloom, clashes: frozenset[int], name_bits: int) -> Iterator[pa.RecordBatch]:
    """(s, doc_id, key, grams) of documents whose set may be in a list: min-hash and the set in the global order."""
    ranks, bits = shared.value, bloom.value
    known = set()
    for batch in batches:
        ids, rows, size = batch.column(1).to_pylist(), [], 0
        for row, data, offsets in texts(batch.column(0)):
            for k, s in enumerate(gram_sets(data, offsets)):
                if not len(s):
                    continue
                name = name_of(s, clashes, name_bits)
                if (name, ids[row + k]) in known or not all(bits[at >> 5] >> (at & 31) & 1 for (at,) in _bloom_places(np.array([name]), 32 * len(bits))):
                    continue
                known.add((name, ids[row + k]))
                rows.append((name, ids[row + k], int(mix(s ^ np.uint64(0x5BD1E995)).min().astype(np.int64)), ordered(s, ranks).tobytes()))
                size += 8 * len(s)
            if size > 8 << 20:
                yield _content_batch(rows)
                rows, size = [], 0
        if rows:
            yield _content_batch(rows)


def _content_batch(rows) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["s", "doc_id", "key", "grams"])


class Forest:
    """Union-find."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


class Node:
    """Sets lo to hi - 1, which share the grams of the path; `part` are those since the parent."""

    __slots__ = ("lo", "hi", "depth", "part", "below", "ends", "least", "most", "one")

    def __init__(self, lo, hi, depth, part, least, most):
        self.lo, self.hi, self.depth, self.part, self.least, self.most = lo, hi, depth, part, least, most
        self.below: list[Node] = []
        self.ends, self.one = False, hi - lo == 1  # whether set lo ends here; whether all sets are known to be connected


def tree_of(sets: list[np.ndarray]) -> Node:
    """The prefix tree, with runs of single children merged, of distinct sets in lexicographic order."""
    shared = [0]
    for a, b in zip(sets[:-1], sets[1:], strict=True):
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        shared.append(int(differ[0]) if len(differ) else n)
    sizes = [len(s) for s in sets]

    def build(lo: int, hi: int, above: int) -> Node:
        depth = min(shared[lo + 1 : hi]) if hi - lo > 1 else sizes[lo]
        node = Node(lo, hi, depth, sets[lo][above:depth], min(sizes[lo:hi]), max(sizes[lo:hi]))
        node.ends = sizes[lo] == depth
        todo.append((node, [lo, *(k for k in range(lo + 1, hi) if shared[k] == depth), hi]))
        return node

    todo: list = []
    top = build(0, len(sets), 0)
    while todo:
        node, edges = todo.pop()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if node.ends and a == node.lo:
                if b - a > 1:  # cannot be: sets are distinct, so others start after the one that ends here
                    raise AssertionError
                continue
            node.below.append(build(a, b, node.depth))
    return top


def join_block(grams: list[np.ndarray], percent: int, group: list[int] | None = None) -> list[tuple[int, int]]:
    """Edges (positions) that connect similar sets; group: those of equal number are connected from the start.

    grams: sets in the global order, rarest first. They need not be distinct.
    """
    n = len(grams)
    vocabulary, flat = np.unique(np.concatenate(grams), return_inverse=True)
    flat = (len(vocabulary) - 1 - flat).astype(np.int32)
    edges = np.cumsum([0, *map(len, grams)])
    local = [flat[a:b][::-1] for a, b in zip(edges[:-1], edges[1:], strict=True)]
    forest, out = Forest(n), []
    if group is not None:
        first: dict[int, int] = {}
        for k, c in enumerate(group):
            forest.join(first.setdefault(c, k), k)
    # big-endian bytes compare like the sequences they hold
    order = sorted(range(n), key=lambda k: local[k].astype(">i4").tobytes())
    distinct: list[int] = []
    for k in order:
        if distinct and np.array_equal(local[distinct[-1]], local[k]):
            if forest.join(distinct[-1], k):
                out.append((distinct[-1], k))
        else:
            distinct.append(k)
    sets = [local[k] for k in distinct]
    if len(sets) < 2:
        return out
    tree, has = tree_of(sets), np.zeros(len(vocabulary), bool)

    def reachable(size: int, other: int) -> int:
        return -(-percent * (size + other) // (100 + percent))

    for i, x in enumerate(sets):
        if i == 0:
            continue
        has[x] = True
        mine = distinct[i]
        todo = [(tree, 0, 0, False)]
        while todo:
            node, overlap, depth, left = todo.pop()
            if left:  # all below are visited
                roots = {forest.find(distinct[c.lo]) for c in node.below} | ({forest.find(distinct[node.lo])} if node.ends else set())
                node.one = len(roots) == 1 and all(c.one for c in node.below)
                continue
            if node.lo >= i or (node.one and forest.find(distinct[node.lo]) == forest.find(mine)):
                continue
            if overlap + min(len(x), node.most - depth) < reachable(len(x), node.least):
                continue
            part = node.part
            overlap += int(np.count_nonzero(has[part]))
            rest = len(x) - (int(np.searchsorted(x, part[-1], "right")) if len(part) else 0)
            if overlap + min(rest, node.most - node.depth) < reachable(len(x), node.least):
                continue
            if node.ends and node.lo < i:
                y = sets[node.lo]
                if 100 * overlap >= percent * (len(x) + len(y) - overlap) and forest.join(mine, distinct[node.lo]):
                    out.append((distinct[node.lo], mine))
            if node.below:
                todo.append((node, 0, 0, True))
                todo += [(c, overlap, node.depth, False) for c in node.below]
        has[x] = False
    return out


def _joined(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b) for every component b that turns out to be connected to a smaller one a of its group; rows (group, s,
    component, grams) of a group stand together. All components that meet in a group name the same smallest one."""
    group, rows = None, []

    def edges():
        names = [r[1] for r in rows]
        forest = Forest(len(rows))
        for i, j in join_block([np.frombuffer(r[2], np.uint64) for r in rows], percent, names):
            forest.join(i, j)
        first: dict[int, int] = {}
        for k, c in enumerate(names):
            forest.join(first.setdefault(c, k), k)
        least: dict[int, int] = {}
        for k, c in enumerate(names):
            least[forest.find(k)] = min(c, least.get(forest.find(k), c))
        return {(least[forest.find(k)], c) for c, k in first.items() if least[forest.find(k)] != c}

    def batch_of(found):
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    found: list = []
    for batch in batches:
        for g, s, c, grams in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            if g != group:
                if len(rows) > 1:
                    found += edges()
                group, rows = g, []
            rows.append((s, c, grams))
        if found:
            yield batch_of(found)
            found = []
    if len(rows) > 1:
        found += edges()
    if found:
        yield batch_of(found)


def joined_groups(groups: DataFrame, n: int, percent: int) -> DataFrame:
    """Edges (a, b), a < b, between components of groups (group, s, component, grams), each in one task and of bounded size."""
    dealt = groups.select("group", "s", "component", "grams").repartition(n, "group").sortWithinPartitions("group")
    return dealt.mapInArrow(lambda it: _joined(it, percent), "a long, b long")


def salted(many: DataFrame, few: DataFrame, keys: list[str], salts: int = 16) -> DataFrame:
    """Inner join on keys where many rows may have one key: few, with one row a key, is repeated for each of the salts."""
    left = many.withColumn("salt", F.pmod(F.xxhash64("s"), F.lit(salts)).cast("int"))
    right = few.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "salt"]).drop("salt")


def weight(n: Column) -> Column:
    """What a set of n grams counts in a block."""
    return F.greatest(F.lit(1.0), n / F.lit(float(GRAMS_A_SET)))


def _blocks(sets: DataFrame, block: int, percent: int) -> DataFrame:
    """Groups (group, s, component) of at most about two blocks for lists (list, s, component, n, place).

    Lists of up to a block are a group. Of larger ones, components larger than a block and the rest are cut, in order of
    size, into blocks; a block, and every pair of blocks, is a group unless it is within one component or sizes and places
    rule out that two of its sets are similar and share the list's gram before any other.
    """
    weighed = sets.withColumn("w", weight(F.col("n")))
    sized = salted(weighed, weighed.groupBy("list").agg(F.sum("w").alias("total")), ["list"])
    small = sized.where(F.col("total") <= block).select(F.xxhash64("list").alias("group"), "s", "component")
    large = sized.where(F.col("total") > block).drop("total")
    own = large.groupBy("list", "component").agg((F.sum("w") > block).alias("pure"))
    large = salted(large, own, ["list", "component"]).withColumn("own", F.when(F.col("pure"), F.col("component")))
    # bands of neighbouring sizes; a size with more sets than a block is a band of several blocks
    of_size = large.groupBy("list", "own", "n").agg(F.sum("w").alias("c"))
    before = Window.partitionBy("list", "own").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    alone = F.col("c") > block
    band = F.when(alone, -F.col("n")).otherwise(F.floor(F.coalesce(F.sum("c").over(before), F.lit(0.0)) / block))
    bands = of_size.select(
        "list", F.xxhash64("own", F.col("own").isNull()).alias("of"), "n", band.alias("band"), F.when(alone, F.ceil(F.col("c") / block)).otherwise(1).cast("int").alias("cuts"),
    )
    large = salted(large.withColumn("of", F.xxhash64("own", F.col("own").isNull())), bands, ["list", "of", "n"])
    place = F.pmod(F.when(F.col("pure"), F.xxhash64("s")).otherwise(F.xxhash64("component")), "cuts")
    # the largest set that can be similar to this one and share the list's gram first
    reach = F.floor(((100 + percent) * (F.col("n") - F.coalesce("place", F.lit(0))) - percent * F.col("n")) / percent)
    large = large.select("list", "s", "component", "own", "n", reach.alias("reach"), F.xxhash64("of", "band", place).alias("piece"))
    pieces = large.groupBy("list", "piece").agg(F.first("own").alias("own"), F.min("n").alias("low"), F.max("n").alias("high"), F.max("reach").alias("reach"))
    a, b = (pieces.select("list", *(F.col(c).alias(f"{c}_{k}") for c in ("piece", "own", "low", "high", "reach"))) for k in "ab")
    fits = f"low_a <= reach_b AND low_b <= reach_a AND {percent} * low_a <= 100 * high_b AND {percent} * low_b <= 100 * high_a"
    pairs = a.join(b, "list").where(f"{fits} AND ((piece_a < piece_b AND NOT (own_a IS NOT NULL AND own_a <=> own_b)) OR (piece_a = piece_b AND own_a IS NULL))")
    pairs = pairs.select("list", F.xxhash64("list", "piece_a", "piece_b").alias("group"), F.explode(F.array_distinct(F.array("piece_a", "piece_b"))).alias("piece"))
    return small.unionByName(large.join(pairs, ["list", "piece"]).select("group", "s", "component"))


def link_components(docs: DataFrame, percent: int = 80, text: str = "text", block: int = BLOCK, cells: int = CELLS, heavy: int = HEAVY, name_bits: int = 64) -> DataFrame:
    """doc_id, text_key (xxhash64 of the text), n_shingles, component_id and component of every row of docs (doc_id, text).

    component is a number that the documents of a component share, null for empty sets; component_id is their smallest doc_id.
    """
    spark, sc = docs.sparkSession, docs.sparkSession.sparkContext
    source = docs.select(F.col(text).cast("binary").alias("text"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"))
    n = reduce_partitions(source)
    first = materialise(source.mapInArrow(lambda it: _first_pass(it, cells, name_bits), "doc_id long, text_key long, n long, s long, check long, bits binary, segment int, cells binary"))
    members = first.where("n IS NOT NULL").select("doc_id", "text_key", "n", "s", "check", "bits")
    counts = folded(first.where("segment IS NOT NULL").select("segment", "cells"), cells)
    heavy = max(heavy, int(counts.sum()) // (4 * n), 16 * int(counts.sum()) // cells)
    ranks = sc.broadcast(np.minimum(_OCTAVE * np.log2(np.maximum(counts, 1)), 65535).astype(np.uint16))

    def sets_of(members: DataFrame) -> DataFrame:
        same = members.where("s IS NOT NULL").groupBy("s")
        return materialise(same.agg(F.min("doc_id").alias("first"), F.min("check").alias("low"), F.max("check").alias("high"), F.first("n").alias("n"), F.first("bits").alias("bits")))

    sets = sets_of(members)
    clashes = frozenset(r.s for r in sets.where("low <> high").select("s").limit(CLASHES + 1).collect())
    if len(clashes) > CLASHES:
        raise ValueError(f"more than {CLASHES} pairs of sets have one name")
    if clashes:  # both digests of these sets change places
        again = F.col("s").isin(*clashes)
        members = members.withColumns({"s": F.when(again, F.col("check")).otherwise(F.col("s")), "check": F.when(again, F.col("s")).otherwise(F.col("check"))})
        sets = sets_of(members)
        one = F.when(F.col("low") == F.col("high"), F.col("first")).otherwise(F.raise_error(F.lit("two sets have one name")).cast("long"))
        sets = materialise(sets.withColumn("first", one))
    sets = sets.select("s", "first", "n", "bits")

    keys = dealing_keys(spark, n)
    posted = source.mapInArrow(lambda it: _posted(it, ranks, keys, percent, heavy, clashes, name_bits), "part int, grams binary, sets binary, places binary")
    lists = posted.repartition(n, "part").mapInArrow(lambda it: _listed(it, heavy, block), "part long, sets binary, places binary")
    lists = materialise(lists.groupBy("part", "sets", "places").agg(F.lit(1).alias("one")))
    short, long = lists.where("part = 0"), lists.where("part <> 0")
    every = short.select(F.xxhash64("sets").alias("list"), "sets", F.lit(None).cast("binary").alias("places")).mapInArrow(_unpacked, "list long, s long, place long")
    judged = every.select("list", "s").join(sets.select("s", "n", "bits"), "s").select("list", "s", "n", "bits")
    refined = judged.repartition(n, "list").sortWithinPartitions("list").mapInArrow(lambda it: _refined(it, percent), "list long, s long")
    whole = long.select(F.col("part").alias("list"), "sets", "places").mapInArrow(_unpacked, "list long, s long, place long")
    each = materialise(refined.withColumn("place", F.lit(None).cast("long")).unionByName(whole))
    active = each.select("s").distinct().join(sets.select("s", "first"), "s")
    bits = min(BLOOM_BITS, 1 << max(12, (16 * max(1, each.count())).bit_length()))
    bloom = sc.broadcast(folded(each.select("s").mapInArrow(lambda it: _bloomed(it, bits), "segment int, cells binary"), bits // 32, np.bitwise_or).astype(np.uint32))
    content = source.mapInArrow(lambda it: _content(it, ranks, bloom, clashes, name_bits), "s long, doc_id long, key long, grams binary")
    same = F.col("c.doc_id").eqNullSafe(F.col("a.first")) & (F.col("c.s") == F.col("a.s"))
    content = materialise(content.alias("c").join(active.alias("a"), same).select("c.s", "key", "grams"))

    # first round: equal min-hash, in blocks that share one set. It is the smallest of its min-hash, so all blocks give its
    # component the same name, and as every set is in one block but for that one, the edges are the components themselves
    large = content.groupBy("key").agg(F.sum(weight(F.octet_length("grams") / 8)).alias("w"), F.min("s").alias("anchor")).where(F.col("w") > block)
    large = materialise(large.select("key", "anchor", F.ceil(F.col("w") / block).cast("int").alias("cuts")))
    met = content.join(large, "key", "left")
    at = F.coalesce(F.pmod(F.xxhash64("s"), "cuts"), F.lit(0)).cast("int")
    places = F.when(F.col("s") == F.col("anchor"), F.sequence(F.lit(0), F.col("cuts") - 1)).otherwise(F.array(at))
    rows = met.select("key", "s", "grams", F.explode(places).alias("at")).select(F.xxhash64("key", "at").alias("group"), "s", F.col("s").alias("component"), "grams")
    where = materialise(joined_groups(rows, n, percent).select(F.col("b").alias("id"), F.col("a").alias("component")).distinct())

    # second round: lists that are not within one component yet, as one where they are over the same components
    known = each.join(where, each["s"] == where["id"], "left").select("list", "s", "place", F.coalesce("component", "s").alias("component"))
    over = known.groupBy("list", "component").agg(F.lit(1).alias("one"))
    over = over.groupBy("list").agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("component"), F.lit(1 << 40))).alias("x"), F.bit_xor(F.xxhash64("component", F.lit(1))).alias("y"))
    over = over.where("n > 1").select("list", F.xxhash64("n", "x", "y").alias("over"))
    # a set's place is the least in the lists that are one
    mixed = salted(known, over, ["list"]).groupBy(F.col("over").alias("list"), "s", "component").agg(F.min(F.coalesce("place", F.lit(0))).alias("place"))
    mixed = materialise(mixed.join(sets.select("s", "n"), "s"))
    groups = _blocks(mixed, block, percent).join(content.select("s", "grams"), "s")
    more = joined_groups(groups, n, percent)
    merged = connected_components(more)

    # names of components: the smallest document of all their sets
    of_set = sets.join(where.select(F.col("id").alias("s"), "component"), "s", "left").select("s", "first", F.coalesce("component", "s").alias("c"))
    of_set = of_set.join(merged.select(F.col("id").alias("c"), F.col("component").alias("d")), "c", "left").select("s", "first", F.coalesce("d", "c").alias("c"))
    of_set = materialise(of_set)
    names = materialise(of_set.groupBy("c").agg(F.min("first").alias("component_id")))
    named = materialise(of_set.join(names, "c").select("s", "component_id", F.col("c").alias("component")))
    met = members.join(named, "s", "left")
    own = F.when(F.col("s").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return met.select("doc_id", "text_key", F.col("n").alias("n_shingles"), own.alias("component_id"), "component")
