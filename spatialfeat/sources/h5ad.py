"""Expression matrices in HDF5 files as a Spark source: spark.read.format("hdf5_matrix").load(folder).

A file is a sample, named by its stem. X is a group of data, indices and indptr (rows in compressed form) or a table of all values; the names
of observations and genes are the index tables of obs and var. A partition is a run of observations: it reads the edges of its rows and then
the counts between them, so no file is read whole by one task; what is planned are headers and the indexes of pieces. The result is a matrix
in rows as operators/expression.py has it; with option `names` it is the table of genes (sample_id, index, gene).

Defined cases: an observation without counts is a row with empty arrays; values that are zero in a full table are not listed; a matrix in
columns, a file without X or without names, and a damaged one are errors that name the file; no files give no rows.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions import hdf5
from .hdf5 import files_at, opened

FORMAT = "hdf5_matrix"
MATRIX = "sample_id string, obs_row long, obs_id string, indices array<int>, data array<double>"
NAMES = "sample_id string, index int, gene string"
ENDINGS = (".h5ad", ".h5", ".hdf5")
#: What the index of a table of names may be called.
INDEX = ("_index", "index", "barcode", "gene", "gene_name")
#: Observations of a task.
PARTITION_ROWS = 4096


@dataclass
class Run(InputPartition):
    """A run of observations, or with names of genes, of a file; tables by what they are for, and where the headers of the counts are: which
    of these a run needs is known where it is read."""

    path: str
    first: int
    last: int
    tables: dict = field(default_factory=dict)
    counts: dict = field(default_factory=dict)
    offset_size: int = 8

    def __post_init__(self):
        super().__init__(None)


def _index(file: hdf5.File, group: str) -> hdf5.Table:
    at = file.at(group)
    names = {} if at is None else file.names(at)
    name = next((n for n in INDEX if n in names), None)
    if name is None:
        raise KeyError(f"{group} has no index, one of {INDEX} is needed, there are {sorted(names)}")
    return file.table(names[name])


def planned(path: str, names: bool, most: int) -> list[Run]:
    """The partitions of a file."""
    handle, read = opened(path)
    try:
        file, counts = hdf5.File(read), {}
        if names:
            tables = {"names": _index(file, "var")}
            n = tables["names"].shape[0]
        else:
            at = file.at("X")
            if at is None:
                raise KeyError(f"no X, there are {sorted(file.names())}")
            tables = {"names": _index(file, "obs")}
            n = tables["names"].shape[0]
            if file.is_table(at):
                tables["X"] = file.table(at)
                rows = tables["X"].shape[0]
            else:
                parts = file.names(at)
                if missing := {"data", "indices", "indptr"} - set(parts):
                    raise KeyError(f"X has no {sorted(missing)}")
                tables["indptr"] = file.table(parts["indptr"])
                rows = tables["indptr"].shape[0] - 1
                counts = {k: parts[k] for k in ("data", "indices")}
            if rows != n:
                raise hdf5.Unsupported(f"X has {rows} rows for {n} observations")
    except (ValueError, IndexError, KeyError) as e:
        raise ValueError(f"{path}: {e}") from e
    finally:
        handle.close()
    out = []
    for a in range(0, n, most):
        out.append(Run(path, a, min(a + most, n), {k: t.rows(a, a + most + 1) for k, t in tables.items()}, counts, file.o))
    return out


def _texts(values: np.ndarray) -> pa.Array:
    return pa.array([v.decode() if isinstance(v, bytes) else str(v) for v in values.tolist()], pa.string())


def batch_of(p: Run, names: bool) -> pa.RecordBatch:
    """The rows of a partition."""
    handle, read = opened(p.path)
    of = lambda name, a, b: hdf5.rows(read, p.tables[name], a, b, p.offset_size)
    sample, n = posixpath.splitext(posixpath.basename(p.path))[0], p.last - p.first
    try:
        ids, number = _texts(of("names", p.first, p.last)), pa.array(np.arange(p.first, p.last))
        if names:
            return pa.RecordBatch.from_arrays([pa.array([sample] * n, pa.string()), number.cast(pa.int32()), ids], ["sample_id", "index", "gene"])
        if "X" in p.tables:
            x = of("X", p.first, p.last).astype(float)
            row, index = np.nonzero(x)
            value, edges = x[row, index], np.searchsorted(row, np.arange(n + 1))
        else:
            edges = of("indptr", p.first, p.last + 1).astype(np.int64)
            a, b, file = int(edges[0]), int(edges[-1]), hdf5.File(read)
            index, value = (hdf5.rows(read, file.table(p.counts[k], a, b), a, b) for k in ("indices", "data"))
            edges = edges - edges[0]
    except (ValueError, IndexError, KeyError) as e:
        raise ValueError(f"{p.path}: {e}") from e
    finally:
        handle.close()
    lists = lambda v, kind: pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(v.astype(kind)))
    columns = [pa.array([sample] * n, pa.string()), number, ids, lists(index, np.int32), lists(value, np.float64)]
    return pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in MATRIX.split(", ")])


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}
        self.names = self.options.get("names", "false").lower() == "true"

    def partitions(self) -> list[Run]:
        paths = files_at(self.options["path"], ENDINGS)
        if wanted := self.options.get("samples"):
            paths = [p for p in paths if posixpath.splitext(posixpath.basename(p))[0] in wanted.split(",")]
        most = int(self.options.get("partitionrows", PARTITION_ROWS))
        return [r for p in paths for r in planned(p, self.names, most)] or [Run("", 0, 0)]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield batch_of(partition, self.names)


class Hdf5Matrix(DataSource):
    """Options: path (a folder or a file), names (true for the table of genes), samples (names with commas), partitionRows."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return NAMES if self.options.get("names", "false").lower() == "true" else MATRIX

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


def matrix(spark: SparkSession, path: str, samples: list[str] | None = None, partition_rows: int = PARTITION_ROWS) -> tuple[DataFrame, DataFrame]:
    """The matrix in rows of all files in a folder, and the table of their genes."""
    spark.dataSource.register(Hdf5Matrix)
    found = spark.read.format(FORMAT).option("partitionRows", partition_rows)
    found = found.option("samples", ",".join(samples)) if samples is not None else found
    return found.load(path), found.option("names", "true").load(path)
