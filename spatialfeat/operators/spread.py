"""Spreading small inputs over all cores before expensive kernels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of pixels that Python gets at once.
BATCH_BYTES = 32 << 20
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_set_here: set[str] = set()
#: Input bytes a core from which the partitions of the scan are enough.
ENOUGH_BYTES = 32 << 20


def spread(df: DataFrame) -> DataFrame:
    """df dealt evenly over the cores if the whole of it is small, as a table in one file would be one task; large tables as they are."""
    sc = df.sparkSession.sparkContext
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(sc.defaultParallelism) if size < ENOUGH_BYTES * sc.defaultParallelism else df


def enough_partitions(df: DataFrame) -> int:
    """Partitions for a shuffle before expensive kernels: those of the session or of the scan, whichever are more. Rows that
    are dealt into so many by number stay so, where adaptive execution would put small ones together."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


def fitting_batches(patches: DataFrame) -> int:
    """Hands so many patches to Python at once, from here on in this session, as make BATCH_BYTES; tells how many.

    One patch tells the size of all: those of a dataset are of one size. A session with a setting of its own keeps it.
    """
    conf, binary = patches.sparkSession.conf, isinstance(patches.schema["px"].dataType, T.BinaryType)
    if conf.get(_BATCH_ROWS) != "10000" and conf.get(_BATCH_ROWS) not in _set_here:
        return int(conf.get(_BATCH_ROWS))
    size = F.octet_length("px") if binary else 4 * F.size("px")
    one = patches.where("px IS NOT NULL").select(size.alias("n")).first()
    rows = 10_000 if one is None else max(1, min(10_000, BATCH_BYTES // max(1, one.n)))
    conf.set(_BATCH_ROWS, str(rows))
    _set_here.add(str(rows))
    return rows
