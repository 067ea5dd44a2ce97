"""Exact dedup by Grace hash deduplication.

Texts meet in an open-addressing table that compares complete contents; a 64-bit hash only says where to look. While
scanning, each task merges its own copies and passes on one record per distinct text, so a text with a third of all rows
crosses the shuffle once per task. Records are then dealt out by the hash of their text. Where what a task receives does
not fit its table, it is parted into spill files by further bits of the hash, again and again until each file fits.

Spill files live only while a task runs, in its own temporary folder: a lost executor costs a rerun of the task. The rows
of single documents never meet in one task: they find the row of their text by SHA-256 in a join whose hot side adaptive
execution splits; two contents under one SHA-256 make the job fail.

Defined cases: null text counts as empty, and empty texts are equal; a very long text is one content like others; null ids are
smaller than any other; rows with equal id and text are copies of which one stays, that with the largest hash of its other
columns, whatever the order of rows; columns other than id and text come along from the row that stays, whatever their names;
no rows give no rows.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, reduce_partitions, repeated, whole_row

#: Columns of a record before those that come along; of rows with one id, the larger tie stays.
CONTENT, ID, COUNT, TIE = "gd_content", "gd_id", "gd_count", "gd_tie"
#: Bytes of distinct contents in a table, on either side of the shuffle.
FITS = 48 << 20
FAN_OUT = 16
SEED = 0x5EED


def _place(row: list) -> tuple:
    return row[1] is not None, row[1] or 0, row[3]


class Table:
    """Open addressing with linear probing; a slot holds the number of an entry, whose content is compared in full."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.rows: list[list] = []  # content, id, count, tie, what comes along
        self.bytes = 0

    def add(self, h: int, row: list) -> None:
        slots, mask = self.slots, len(self.slots) - 1
        at = h & mask
        while (k := slots[at]) >= 0:
            if self.hashes[k] == h and (own := self.rows[k])[0] == row[0]:
                count = own[2] + row[2]
                if _place(own) < _place(row):
                    self.rows[k] = own = row
                own[2] = count
                return
            at = (at + 1) & mask
        slots[at] = len(self.rows)
        self.hashes.append(h)
        self.rows.append(row)
        self.bytes += len(row[0]) + 200
        if 2 * len(self.rows) > len(slots):
            self.grow()

    def grow(self) -> None:
        mask = 4 * len(self.slots) - 1
        slots = [-1] * (mask + 1)
        for k, h in enumerate(self.hashes):
            at = h & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = k
        self.slots = slots


def _rows(batch: pa.RecordBatch) -> Iterator[list]:
    step = max(1, min(batch.num_rows, (8 << 20) * max(1, batch.num_rows) // max(1, batch.nbytes)))
    for start in range(0, batch.num_rows, step):
        yield from map(list, zip(*(c.to_pylist() for c in batch.slice(start, step).columns), strict=True))


def _batches(rows: list[list], schema: pa.Schema, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += len(row[0]) + 64
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)
            part, size = [], 0
    if part:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


def merged_while_scanning(batches: Iterator[pa.RecordBatch], fits: int = FITS) -> Iterator[pa.RecordBatch]:
    """One record per distinct text of a table's fill; a full table is passed on and emptied."""
    table, schema = Table(), None
    for batch in batches:
        schema = batch.schema
        for row in _rows(batch):
            table.add(xxhash.xxh64_intdigest(row[0], SEED), row)
            if table.bytes > fits:
                yield from _batches(table.rows, schema)
                table = Table()
    if table.rows:
        yield from _batches(table.rows, schema)


def grace(batches: Iterator[pa.RecordBatch], fits: int = FITS, fan_out: int = FAN_OUT, level: int = 0, folder: str | None = None) -> Iterator[pa.RecordBatch]:
    """One record per distinct text of all batches, in memory of about `fits` bytes."""
    if folder is None:
        with tempfile.TemporaryDirectory(prefix="grace-") as folder:
            yield from grace(batches, fits, fan_out, level, folder)
        return
    table, schema, parts = Table(), None, None
    for batch in batches:
        schema = batch.schema
        for row in _rows(batch):
            table.add(xxhash.xxh64_intdigest(row[0], SEED), row)
            if table.bytes > fits and len(table.rows) > 1:
                parts = _part(table, schema, fan_out, level, folder, parts)
                table = Table()
    if parts is None:
        if table.rows:
            yield from _batches(table.rows, schema)
        return
    _part(table, schema, fan_out, level, folder, parts)
    for path, writer in parts.values():
        writer.close()
    for path, _ in parts.values():
        with pa.OSFile(path) as file, pa.ipc.open_stream(file) as stream:
            below = tempfile.mkdtemp(dir=folder)
            yield from grace(iter(stream), fits, fan_out, level + 1, below)
        Path(path).unlink()


def _part(table: Table, schema: pa.Schema, fan_out: int, level: int, folder: str, parts: dict | None) -> dict:
    """Writes what a full table holds to the spill files of this level; each level takes other bits of the hash."""
    parts = {} if parts is None else parts
    by: dict[int, list] = {}
    for h, row in zip(table.hashes, table.rows, strict=True):
        by.setdefault(xxhash.xxh64_intdigest(h.to_bytes(8, "little"), level + 1) % fan_out, []).append(row)
    for k, rows in by.items():
        if k not in parts:
            path = f"{folder}/{level}-{k}"
            parts[k] = path, pa.ipc.new_stream(path, schema)
        for batch in _batches(rows, schema):
            parts[k][1].write_batch(batch)
    return parts


def distinct_texts(docs: DataFrame, carry: list[str] | None = None, id: str = "doc_id", text: str = "text", fits: int = FITS) -> DataFrame:
    """gd_content, gd_id (the largest), gd_count and gd_tie of every distinct text, with columns of the row that stays."""
    tie = F.xxhash64(whole_row(docs, (id, text))) if carry else F.lit(0).cast("long")
    records = docs.select(
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias(CONTENT), F.col(id).cast("long").alias(ID), F.lit(1).cast("long").alias(COUNT), tie.alias(TIE), *(carry or [])
    )
    local = records.mapInArrow(lambda it: merged_while_scanning(it, fits), records.schema)
    dealt = local.repartition(reduce_partitions(docs), F.xxhash64(CONTENT))
    return dealt.mapInArrow(lambda it: grace(it, fits), records.schema)


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with the columns of docs: of equal texts the row with the largest id."""
    others = F.struct(F.col(text).isNull().alias("gd_null"), F.struct(*(c for c in docs.columns if c != text)).alias("rest"))
    kept = distinct_texts(docs.select(id, text, others.alias("gd_row")), ["gd_row"], id, text)
    own = F.when(~F.col("gd_row.gd_null"), F.col(CONTENT).cast("string")).alias(text)
    return kept.select(*(own if c == text else F.col("gd_row.rest").getField(c).alias(c) for c in docs.columns))


def groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with keep_id, group_size, kept and text_sha256 of its text's group."""
    texts = distinct_texts(docs, None, id, text).select(F.sha2(CONTENT, 256).alias("text_sha256"), F.col(ID).alias("keep_id"), F.col(COUNT).alias("group_size"))
    members = docs.select(F.col(id).alias("doc_id"), F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256).alias("text_sha256"))
    members = members.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("gd_rows"))
    once = Window.partitionBy("text_sha256")
    same = F.when(F.count("*").over(once) > 1, F.raise_error(F.lit("two texts have one SHA-256")).cast("long")).otherwise(F.col("keep_id"))
    texts = materialise(texts.withColumn("keep_id", same))
    met = repeated(members.join(texts, "text_sha256"), "gd_rows", "gd_row")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("gd_row") == 1)
    return met.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
