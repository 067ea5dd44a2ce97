"""What the text operators share: tables, the shared checkpoint folder and vectorised word hashing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


#: Rows of an Arrow batch where the session has no setting of its own: texts are long.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Hands few rows at once to Python from here on, unless the session has a setting of its own. Queries call it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Where that is unset, a temporary one, but only if driver and executors are one machine; on a cluster it is an error.
    """
    sc = spark.sparkContext
    place = sc.getConf().get("spark.checkpoint.dir", None) or sc._jsc.sc().getCheckpointDir().getOrElse(None)
    if not place:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        place = tempfile.mkdtemp(prefix="spatialfeat-")
        sc.setCheckpointDir(place)
    return place.rstrip("/")


_written: dict[str, list[str]] = {}


def written(spark: SparkSession) -> list[str]:
    """Paths of the tables that this application has put into the shared folder and not removed, in order."""
    return _written.setdefault(spark.sparkContext.applicationId, [])


def new_path(spark: SparkSession) -> str:
    """A path in the shared folder that nothing else has; sweep() removes what is there."""
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}"
    written(spark).append(path)
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Removes these tables, or all that this application has put into the shared folder, once results are written; tells how many."""
    known = written(spark)
    paths = list(known) if paths is None else paths
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        if path in known:
            known.remove(path)
    return len(paths)


def whole_row(df: DataFrame, without: tuple[str, ...] = ()):
    """A text that stands for all columns of a row but some, to break ties by: rows that agree in it are interchangeable."""
    columns = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(df.columns) if c not in without]
    return F.to_json(F.struct(*columns)) if columns else F.lit("")


def carried(columns: list[str], own: tuple[str, ...]) -> list[str]:
    """The columns that come along: one that is named like an output gives way to it."""
    return [c for c in dict.fromkeys(columns) if c not in own]


#: Rows that one value of an array stands for at most where rows are repeated.
REPEATED = 1 << 16


def repeated(df: DataFrame, count: str, number: str, block: int = REPEATED) -> DataFrame:
    """Every row as often as its column `count` says, numbered from 1; not at all where that is null or below 1.

    Numbers are made in two levels, of which neither is an array of more than `block` values (a count of up to block squared), so a row that stands
    for very many is never one large value.
    """
    many = F.col(count) >= 1
    last = F.shiftright((F.col(count) - 1).cast("long"), block.bit_length() - 1)
    blocks = df.where(many).withColumn("rp_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    first = F.col("rp_block") * block
    own = F.explode(F.sequence(first + 1, F.least(first + block, F.col(count).cast("long"))))
    return blocks.withColumn(number, own).drop("rp_block")


def word_count(col):
    """Number of words of a text column; 0 for null."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def partitions(df: DataFrame, default: int = 64) -> int:
    """Reduce-side partitions for operators that deal rows out by their own hash."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", str(default))))


def dealing_keys(spark: SparkSession, n: int) -> np.ndarray:
    """For each of n partitions an integer that repartition(n, key) deals to it; found by asking Spark's own hash."""
    found = np.full(n, -1, np.int64)
    at = 0
    while (found < 0).any():
        ids = spark.range(at, at + 32 * n + 256, 1, 1).select(F.col("id").cast("int").alias("key"))
        for key, to in ids.select("key", F.pmod(F.hash("key"), F.lit(n)).alias("to")).groupBy("to").agg(F.min("key").alias("key")).select("key", "to").collect():
            found[to] = key if found[to] < 0 else found[to]
        at += 32 * n + 256
    return found


def reduce_partitions(df: DataFrame) -> int:
    """Partitions for packed records: no fewer than the scan has, so that what one of them gets does not grow."""
    return max(partitions(df), df.rdd.getNumPartitions())


# ---------------------------------------------------------------- arrays of a fixed size that all tasks add to

SEGMENTS = 16


def _folded(batches: Iterator[pa.RecordBatch], add) -> Iterator[pa.RecordBatch]:
    """Adds up the packed segments of a partition."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            part = np.frombuffer(zstandard.decompress(part), np.uint32).astype(np.int64)
            sums[k] = add(sums[k], part) if k in sums else part
    if sums:
        packed = [zstandard.compress(np.minimum(s, 0xFFFFFFFF).astype(np.uint32).tobytes(), 1) for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array(packed, pa.binary())], ["segment", "cells"])


def folded(segments: DataFrame, size: int, add=np.add) -> np.ndarray:
    """The whole array whose segments (segment, cells) are added up; its size is fixed, whatever the input."""
    summed = segments.repartition(SEGMENTS, "segment").mapInArrow(lambda it: _folded(it, add), "segment int, cells binary")
    out = np.zeros((SEGMENTS, size // SEGMENTS), np.int64)
    for k, part in summed.collect():
        out[k] = np.frombuffer(zstandard.decompress(part), np.uint32)
    return out.reshape(-1)


# ---------------------------------------------------------------- vectorised words

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n; kept by the worker."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of several texts laid end to end.

    hashes: 64-bit hash of every word; starts, ends: byte positions; first: index of the first word of each text, and
    the number of words at the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False, hashed: bool = True):
        n = len(data)
        blank = _BLANK[data]
        cut = np.zeros(n + 1, bool)
        cut[offsets] = True
        inside = np.zeros(n + 2, bool)  # shifted by one: a blank stands before and after the data
        inside[1:-1] = ~blank
        self.starts = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
        self.ends = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
        self.first = np.searchsorted(self.starts, offsets)
        if hashed:
            power, inverse = _power_tables(n)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum((_LOWER[data] if lower else data).astype(np.uint64) * power[:n] + power[:n], out=sums[1:])
            self._sums, self._inverse = sums, inverse
            self.hashes = self.span_hashes(self.starts, self.ends)

    def span_hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the bytes between starts and ends."""
        return mix((self._sums[ends] - self._sums[starts]) * self._inverse[starts])


def texts(column: pa.Array, limit: int = 1 << 20):
    """Cuts an Arrow string or binary column into runs of rows of about `limit` bytes (one row may be longer).

    Yields (first row, data, offsets); offsets start at 0 and have one more entry than the run has rows. Null counts as
    empty. Nothing is copied but the run itself.
    """
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        end = min(end, len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def shingle_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k neighbouring words (order counts); empty if there are fewer."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
        out ^= out >> np.uint64(29)
    return mix(out)
