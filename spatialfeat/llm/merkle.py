"""Merkle manifest of a table, by the broadcast upper-tree variant.

Every row is a leaf, the SHA-256 over its fields. The leaves of a group (a language) ascend by id; pairs of neighbours become the
hash of both, the last one alone its own hash, until one node is left, the group's subroot. The subroots, ordered by group, are
reduced to the root in the same way. All digests are hashed as hexadecimal text and stored as 32 bytes.

* Leaves are written in one global order (a range exchange); a leaf's place is its place in its file and a prefix sum over files.
* Distributed reduction: 2**BLOCK neighbouring leaves are one row, which the tasks reduce to one node. While more than TOP nodes are
  left, blocks of those are reduced in the same way, so the driver never gets more than TOP nodes, whatever the input.
* The driver builds the tree over what is left and broadcasts, for each node of it, its suffix path: its siblings up to the root. The
  bound is TOP paths of at most 64 siblings of 32 bytes. Paths of more nodes than that stay in tables and are joined by place.
* A task finishes the proofs of a block from its own nodes and the suffix path, and folds every row's leaf up to the root.

A path has no sides: whether a node has a sibling, and on which side, follows from its place and from the number of leaves.

Defined cases: null fields are `-`, and others their length in bytes, a colon and the value; null groups come first, null ids come
first in their group; rows of equal id are ordered by their leaf, and those that are equal throughout are leaves of their own whose
paths are interchangeable; a group of one leaf has it as subroot, a table of one group has the subroot as root; a row without siblings has
the hash of nothing as its proof; columns but the five fields do not come along, so none can clash; no rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, new_path, reduce_partitions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Levels that one row of neighbouring nodes has: 1,024 of them.
BLOCK = 10
#: Nodes that the driver builds a tree over, and paths that are broadcast.
TOP = 4096
DIGEST = 32


# ---------------------------------------------------------------- trees in one task


def height(n: int) -> int:
    """Levels between n leaves and their root."""
    return max(n - 1, 0).bit_length()


def pair(parts: list[bytes]) -> bytes:
    """The digest over digests, as hexadecimal text."""
    return hashlib.sha256(b"".join(p.hex().encode() for p in parts)).digest()


def climb(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The nodes and the levels above them."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([pair(below[k : k + 2]) for k in range(0, len(below), 2)])
    return out


def siblings(tree: list[list[bytes]], at: int) -> bytes:
    """The siblings of a node below the top of a tree, from below."""
    found = []
    for level in tree[:-1]:
        if at ^ 1 < len(level):
            found.append(level[at ^ 1])
        at >>= 1
    return b"".join(found)


def fold(node: bytes, at: int, total: int, path: bytes) -> tuple[bytes, bytes]:
    """The top over a node at a place among `total`, and what of the path is left."""
    used = 0
    while total > 1:
        if at ^ 1 < total:
            other = path[used : used + DIGEST]
            used += DIGEST
            node = pair([other, node] if at & 1 else [node, other])
        else:
            node = pair([node])
        at, total = at >> 1, (total + 1) >> 1
    return node, path[used:]


# ---------------------------------------------------------------- leaves in order


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: dict[str, Column]) -> Column:
    """The digest over the fields of a row."""
    return F.unhex(F.sha2(F.concat(*(field(values[c]) for c in FIELDS)), 256))


def tampered(doc_id: Column) -> Column:
    """Whether a row's n_chars is tampered with in the exercise that verification has to notice."""
    return F.crc32(doc_id.cast("string")) % 7 == 0


def leaves(docs: DataFrame) -> DataFrame:
    """group (text that orders like lang, null first), doc_id, leaf, and changed: the leaf after tampering, null where there is none."""
    own = {c: F.col(c) for c in FIELDS}
    more = own | {"n_chars": F.col("n_chars").cast("decimal(38,0)") + 1}
    group = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    return docs.select(group.alias("group"), "doc_id", leaf(own).alias("leaf"), F.when(tampered(F.col("doc_id")), leaf(more)).alias("changed"))


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds place and total, the rows of the group, in a total order; equal rows are told apart by where they are stored."""
    spark, path = rows.sparkSession, new_path(rows.sparkSession)
    stored = materialise(rows)
    stored = stored.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    by = ["group", *order, "_file", "_row"]
    stored.repartitionByRange(reduce_partitions(stored), *by).sortWithinPartitions(*by).drop("_file", "_row").write.parquet(path)
    sorted_ = spark.read.schema(rows.schema).parquet(path).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    runs = sorted_.groupBy("group", "_file").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    number = F.regexp_extract("_file", r"part-(\d+)", 1).cast("long")
    here = Window.partitionBy("group").orderBy(number, "_file")
    runs = runs.select(
        "group", "_file", (F.sum("_n").over(here) - F.col("_n") - F.col("_first")).alias("_shift"), F.sum("_n").over(Window.partitionBy("group")).alias("total"),
    )
    return sorted_.join(runs, ["group", "_file"]).withColumn("place", F.col("_row") + F.col("_shift")).drop("_file", "_row", "_shift")


# ---------------------------------------------------------------- blocks


def blocks(nodes: DataFrame, carry: list[str], block: int) -> DataFrame:
    """One row for 2**block neighbours: group, total, block and nodes (place and what is carried), written to the shared folder."""
    at = F.shiftright("place", block)
    grouped = nodes.groupBy("group", "total", at.alias("block")).agg(F.sort_array(F.collect_list(F.struct("place", *carry))).alias("nodes"))
    return materialise(grouped)


def _rows(batch: pa.RecordBatch, name: str) -> Iterator[tuple[dict, pa.StructArray]]:
    """The plain columns of each row of a batch and the structs of its list column."""
    plain = [c for c in batch.schema.names if c != name]
    values = {c: batch.column(c).to_pylist() for c in plain}
    for k, nodes in enumerate(batch.column(name)):
        yield {c: values[c][k] for c in plain}, nodes.values


def _reduced(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    names = ["group", "total", "place", "leaf"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for row, nodes in _rows(batch, "nodes"):
            top = climb(nodes.field("leaf").to_pylist(), min(block, height(row["total"])))[-1][0]
            for column, value in zip(out, (row["group"], -(-row["total"] >> block), row["block"], top), strict=True):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names)


def reduced(blocked: DataFrame, block: int) -> DataFrame:
    """The node over each block: group, total, place, leaf."""
    return materialise(blocked.mapInArrow(lambda it: _reduced(it, block), "group string, total long, place long, leaf binary"))


def _suffixed(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Paths of the nodes of blocks, from the paths of the blocks."""
    for batch in batches:
        for row, nodes in _rows(batch, "nodes"):
            tree = climb(nodes.field("leaf").to_pylist(), min(block, height(row["total"])))
            n = len(nodes)
            made = [siblings(tree, k) + row["path"] for k in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array([row["group"]] * n), nodes.field("place"), pa.array(made, pa.binary()), pa.array([row["top"]] * n, pa.binary())], ["group", "place", "path", "top"])


PATHS = "group string, place long, path binary, top binary"


def suffixes(nodes: DataFrame, block: int = BLOCK, top: int = TOP) -> tuple[DataFrame, bool]:
    """group, place, path (siblings up to the top of the group) and top of every node, and whether the driver built them.

    nodes: group, total, place, leaf. Groups of one node are at their top, and no further round has them, so there is an end to rounds
    also where there are more groups than `top`.
    """
    spark = nodes.sparkSession
    few = nodes.limit(top + 1).collect()
    if len(few) > top:
        ready = nodes.where("total = 1").select("group", "place", F.lit(b"").alias("path"), F.col("leaf").alias("top"))
        rest = nodes.where("total > 1")
        if rest.isEmpty():
            return ready, False
        blocked = blocks(rest, ["leaf"], block)
        above, small = suffixes(reduced(blocked, block), block, top)
        met = blocked.join(_hinted(above, small).withColumnRenamed("place", "block"), ["group", "block"])
        return ready.unionByName(met.mapInArrow(lambda it: _suffixed(it, block), PATHS)), False
    groups: dict[str, dict[int, bytes]] = {}
    for r in few:
        groups.setdefault(r.group, {})[r.place] = bytes(r.leaf)
    made = []
    for group, found in groups.items():
        tree = climb([found[k] for k in range(len(found))], height(len(found)))
        made += [(group, k, siblings(tree, k), tree[-1][0]) for k in range(len(found))]
    return spark.createDataFrame(made, PATHS).coalesce(1), True


def _hinted(paths: DataFrame, small: bool) -> DataFrame:
    """TOP paths at most are broadcast; more are joined as Spark sees fit."""
    return F.broadcast(paths) if small else paths


def roots(tops: DataFrame, block: int = BLOCK, top: int = TOP) -> tuple[DataFrame, bool]:
    """of (a group), path (siblings of its subroot up to the root), root, rank and groups for every row of tops (of, leaf); and whether these are few."""
    spark = tops.sparkSession
    few = sorted(tops.limit(top + 1).collect())
    columns = "of string, rank long, groups long, path binary, root binary"
    if len(few) <= top:
        tree = climb([bytes(r.leaf) for r in few], height(len(few)))
        made = [(r.of, k, len(few), siblings(tree, k), tree[-1][0]) for k, r in enumerate(few)]
        return spark.createDataFrame(made, columns).coalesce(1), True
    ranked = materialise(placed(tops.select(F.lit("").alias("group"), "of", "leaf"), ["of"]))
    paths, _ = suffixes(ranked.select("group", "total", "place", "leaf"), block, top)
    return ranked.join(paths, ["group", "place"]).select("of", F.col("place").alias("rank"), F.col("total").alias("groups"), "path", F.col("top").alias("root")), False


# ---------------------------------------------------------------- proofs and folds


def _finished(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "lang", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    for batch in batches:
        for row, nodes in _rows(batch, "nodes"):
            own, changed = nodes.field("leaf").to_pylist(), nodes.field("changed").to_pylist()
            tree = climb(own, min(block, height(row["total"])))
            first, proofs, folded = row["block"] << block, [], []
            above = row["path"] + row["root_path"]
            for k, (node, other) in enumerate(zip(own, changed, strict=True)):
                path = siblings(tree, k) + above
                proofs.append(hashlib.sha256(path.hex().encode()).hexdigest())
                subroot, rest = fold(other or node, first + k, row["total"], path)
                folded.append(fold(subroot, row["rank"], row["groups"], rest)[0])
            n, root = len(own), row["root"]
            same = lambda x, n=n: pa.array([x] * n, pa.string())
            lang = row["group"][1:] if row["group"] else None
            yield pa.RecordBatch.from_arrays([
                nodes.field("doc_id"), same(lang), pa.array([x.hex() for x in own]), same(row["subroot"].hex()), same(root.hex()),
                pa.array(proofs), pa.array([x.hex() for x in folded]), pa.array([x == root for x in folded]),
            ], names)


def manifest(docs: DataFrame, block: int = BLOCK, top: int = TOP) -> DataFrame:
    """doc_id, lang, leaf, subroot, root, proof_sha256, folded_root and verified of every row; digests as hexadecimal text."""
    rows = placed(leaves(docs), ["doc_id", "leaf"])
    blocked = blocks(rows, ["doc_id", "leaf", "changed"], block)
    paths, small = suffixes(reduced(blocked, block), block, top)
    paths = paths if small else materialise(paths)
    tops, few = roots(paths.where("place = 0").select(F.col("group").alias("of"), F.col("top").alias("leaf")), block, top)
    upper = paths.withColumnsRenamed({"place": "block", "top": "subroot"})
    lower = tops.withColumnsRenamed({"of": "group", "path": "root_path"})
    met = blocked.join(_hinted(upper, small), ["group", "block"]).join(_hinted(lower, few), ["group"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    hexed = "lang string, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    return met.mapInArrow(lambda it: _finished(it, block), f"doc_id {kind}, {hexed}, verified boolean")
