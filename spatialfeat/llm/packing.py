"""Conflict-constrained best-fit packing.

Documents are laid into bins of `capacity` words. Bins are kept in order of their residual, each with a bitmap of the
sources and one of the duplicate clusters it holds. A piece goes to the successor of its size, the tightest bin it fits
into; where that bin conflicts, the search goes on to the next larger residual until a compatible bin is found, and opens a
bin if none is. A bin conflicts with a piece if it holds a document of the same duplicate cluster, or already holds
`source_most` documents of the same source (one bitmap per number held).

A document longer than a bin is cut into full pieces, which fill bins of their own, and a rest, which is packed.

Rows are dealt into shards by a hash that does not depend on clusters or sources, so that a cluster or a source with a third
of all rows is spread over all shards; the number of shards grows with the rows, and bins do not cross shards. Within a
shard pieces come in falling order of size, then by id. Only ids, sizes, sources and clusters are shuffled, no text.

Defined cases: null or blank text has size 0 and is packed as a piece of size 0; null sources conflict with nothing as a
source; documents with size 0 have no cluster; a very long text is cut as above, its size is all that is held of it; null ids
come first among equal sizes, and ids stay exact beside them; ties in size and id go by source, then cluster; repeated rows are
packed separately and conflict as duplicates; columns of docs but those named do not come along, so none can clash; no rows
give no rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import repeated, word_count

CAPACITY = 2048
SOURCE_MOST = 3
#: Rows of a shard on average.
SHARD_ROWS = 4096
SCHEMA = "doc_id long, piece long, n_words long, source string, cluster string, bin_id string, bin_offset long"
_PACKED = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int64()), ("n_words", pa.int64()), ("source", pa.string()), ("cluster", pa.string()), ("bin_id", pa.string()), ("bin_offset", pa.int64()),
])


class Shelf:
    """Open bins in order of (residual, number)."""

    def __init__(self, capacity: int, source_most: int):
        self.capacity, self.source_most = capacity, source_most
        self.order: list[tuple[int, int]] = []
        self.sources: list[list[int]] = []  # per bin: bitmaps of sources held once, twice, ...
        self.clusters: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Number and fill of the bin that a piece goes to; source and cluster are bits, 0 if they conflict with nothing."""
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            residual, k = self.order[at]
            if not self.clusters[k] & cluster and not self.sources[k][-1] & source:
                break
            at += 1
        else:
            residual, k = self.capacity, len(self.clusters)
            self.sources.append([0] * self.source_most)
            self.clusters.append(0)
            at = None
        if at is not None:
            self.order.pop(at)
        for j, held in enumerate(self.sources[k]):
            if not held & source:
                self.sources[k][j] |= source
                break
        self.clusters[k] |= cluster
        insort(self.order, (residual - size, k))
        return k, self.capacity - residual


def pack_rows(shard: int, rows: Iterable[tuple], capacity: int, source_most: int) -> list[tuple]:
    """Packs (doc_id, n_words, source, cluster) of one shard into rows of SCHEMA."""
    out, full, rests = [], 0, []
    for id, size, source, cluster in rows:
        pieces = max(0, size - 1) // capacity
        for k in range(pieces):
            out.append((id, k, capacity, source, cluster, f"{shard}-full-{full}", 0))
            full += 1
        rests.append((-(size - pieces * capacity), id is not None, id or 0, pieces, source, cluster))
    rests.sort(key=lambda r: (*r[:4], r[4] or "", r[5] or ""))
    many = {c for c, n in Counter(r[5] for r in rests).items() if n > 1 and c is not None}  # only these can conflict
    bit_of_source, bit_of_cluster, shelf = {}, {}, Shelf(capacity, source_most)
    for minus, has, id, piece, source, cluster in rests:
        s = 0 if source is None else bit_of_source.setdefault(source, 1 << len(bit_of_source))
        c = bit_of_cluster.setdefault(cluster, 1 << len(bit_of_cluster)) if cluster in many else 0
        k, fill = shelf.place(-minus, s, c)
        out.append((id if has else None, piece, -minus, source, cluster, f"{shard}-{k}", fill))
    return out


def _packed(rows: pa.Table, capacity: int, source_most: int) -> pa.Table:
    """A shard in Arrow, whose whole numbers stay whole numbers beside nulls."""
    columns = (rows.column(c).to_pylist() for c in ("doc_id", "n_words", "source", "cluster"))
    out = pack_rows(rows.column("shard")[0].as_py(), zip(*columns, strict=True), capacity, source_most)
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PACKED, strict=True)], schema=_PACKED)


def pack(docs: DataFrame, capacity: int = CAPACITY, source_most: int = SOURCE_MOST, text: str = "text", cluster: str | None = None, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row of SCHEMA per piece. docs has doc_id, source and text; cluster: a column, or else equal texts are a cluster."""
    size = word_count(F.col(text))
    same = F.when(size > 0, F.substring(F.sha2(F.col(text), 256), 1, 32)) if cluster is None else F.col(cluster).cast("string")
    small = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("n_words"), F.col("source").cast("string").alias("source"), same.alias("cluster"))
    shards = max(1, -(-docs.count() // shard_rows))
    # repeated rows are counted first and then spread by their number, so that many of them do not meet in one shard
    counted = small.groupBy(*small.columns).agg(F.count("*").alias("rows"))
    each = repeated(counted, "rows", "copy")
    dealt = each.select(*small.columns, F.pmod(F.xxhash64("doc_id", "n_words", "cluster", "copy"), F.lit(shards)).alias("shard"))
    return dealt.groupBy("shard").applyInArrow(lambda rows: _packed(rows, capacity, source_most), SCHEMA)
