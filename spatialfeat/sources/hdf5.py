"""Patches in HDF5 files as a Spark source: spark.read.format("hdf5_patches").load(folder).

A file is a sample, named by its stem, with tables for images, coordinates and barcodes under the names that a reader takes. The files are
looked into when the query is planned, for headers and indexes only; a partition is a run of rows that whole pieces of the image table
hold, of PARTITION_BYTES before compression, and reads those pieces and the same rows of the other tables. No file is read whole by one task.

Paths are local or of any file system that Arrow opens. Defined cases: a file without images, or one that is damaged, is an error that
names the file; missing coordinates are null, and so are missing barcodes where a reader can do without; images of floats become bytes
as elsewhere (times 255 if nothing is above 1, cut to 0 to 255); no files give no rows.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from ..functions import hdf5
from ..schema import ALIASES, REQUIRED

FORMAT = "hdf5_patches"
SCHEMA = "sample_id string, patch_idx long, barcode string, x double, y double, h int, w int, layout string, px binary"
#: Bytes of images before compression that a task gets, rounded up to whole pieces.
PARTITION_BYTES = 64 << 20
ENDINGS = (".h5", ".hdf5")


def _system(path: str):
    system, at = arrow_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("/") else (arrow_fs.LocalFileSystem(), path)
    return system, at


def files_at(path: str, endings: tuple[str, ...] = ENDINGS) -> list[str]:
    """The HDF5 files in a folder, in order, or the file itself."""
    system, at = _system(path)
    info = system.get_file_info(at)
    if info.type == arrow_fs.FileType.File:
        return [path]
    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
    found = system.get_file_info(arrow_fs.FileSelector(at, allow_not_found=True))
    return sorted(prefix + f.path for f in found if f.type == arrow_fs.FileType.File and f.path.endswith(endings))


def opened(path: str):
    """An open file and a function that reads bytes at a place of it."""
    system, at = _system(path)
    handle = system.open_input_file(at)

    def read(start: int, n: int) -> bytes:
        got = handle.read_at(n, start)
        if len(got) < n and start + n > handle.size() and start > 96:
            raise hdf5.Unsupported("the file ends early")
        return got

    return handle, read


@dataclass
class Rows(InputPartition):
    """A run of rows of a file, and of each of its tables the pieces that hold them."""

    path: str
    first: int
    last: int
    tables: dict = field(default_factory=dict)
    offset_size: int = 8

    def __post_init__(self):
        super().__init__(None)


def planned(path: str, reader: str, most: int) -> list[Rows]:
    """The partitions of a file."""
    handle, read = opened(path)
    try:
        file = hdf5.File(read)
        names, tables = file.names(), {}
        for role, aliases in ALIASES[reader].items():
            name = next((a for a in aliases if a in names), None)
            if name is not None:
                tables[role] = file.table(names[name])
            elif role in REQUIRED[reader]:
                raise KeyError(f"no table for {role}: one of {aliases} is needed, there are {sorted(names)}")
    except (ValueError, IndexError, KeyError) as e:
        raise ValueError(f"{path}: {e}") from e
    finally:
        handle.close()
    image = tables["img"]
    each = max(1, int(np.prod(image.shape[1:], dtype=np.int64)) * image.kind.size)
    tall = image.piece[0] if image.piece and image.piece != image.shape else 1
    step = max(1, -(-most // (each * tall))) * tall
    return [Rows(path, a, min(a + step, image.shape[0]), {k: t.rows(a, a + step) for k, t in tables.items()}, file.o) for a in range(0, image.shape[0], step)]


def as_bytes(images: np.ndarray) -> np.ndarray:
    """Values of 8 bits; each float image is scaled by its own largest value."""
    if images.dtype == np.uint8:
        return images
    if images.dtype.kind != "f":
        return np.clip(images, 0, 255).astype(np.uint8)
    x = images.astype(np.float32)
    top = x.reshape(len(x), -1).max(1, initial=-np.inf)
    scale = np.where(top <= 1, np.float32(255), np.float32(1)).reshape(-1, *[1] * (x.ndim - 1))
    return np.floor(np.clip(np.nan_to_num(x * scale), 0, 255)).astype(np.uint8)


def layout_of(shape: tuple[int, ...]) -> tuple[str, int, int]:
    """Layout, rows and columns of images by the shape of one: channels are last if their number fits there, else first."""
    if len(shape) == 2:
        return "gray", *shape
    if len(shape) == 3 and shape[2] in (1, 3, 4):
        return "hwc", *shape[:2]
    if len(shape) == 3 and shape[0] in (1, 3, 4):
        return "chw", *shape[1:]
    raise hdf5.Unsupported(f"images of shape {shape}")


def batch_of(p: Rows) -> pa.RecordBatch:
    """The rows of a partition."""
    handle, read = opened(p.path)
    try:
        n = p.last - p.first
        got = {k: hdf5.rows(read, t, p.first, p.last, p.offset_size) for k, t in p.tables.items()}
        layout, h, w = layout_of(p.tables["img"].shape[1:])
    except (ValueError, IndexError, KeyError) as e:
        raise ValueError(f"{p.path}: {e}") from e
    finally:
        handle.close()
    images = np.ascontiguousarray(as_bytes(got["img"])).reshape(n, -1)
    sample = posixpath.splitext(posixpath.basename(p.path))[0]
    places = got["coords"].reshape(n, -1).astype(float) if "coords" in got else np.full((n, 2), np.nan)
    codes = [None] * n
    if "barcode" in got:
        codes = [v.decode() if isinstance(v, bytes) else str(v) for v in got["barcode"].reshape(n, -1)[:, 0].tolist()]
    same = lambda v, kind: pa.array([v] * n, kind)
    place = lambda k: pa.array(places[:, k], mask=np.isnan(places[:, k]))
    columns = [
        same(sample, pa.string()), pa.array(np.arange(p.first, p.last)), pa.array(codes, pa.string()), place(0), place(1),
        same(h, pa.int32()), same(w, pa.int32()), same(layout, pa.string()), pa.array([r.tobytes() for r in images], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in SCHEMA.split(", ")])


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[Rows]:
        paths = files_at(self.options["path"])
        if wanted := self.options.get("samples"):
            paths = [p for p in paths if posixpath.splitext(posixpath.basename(p))[0] in wanted.split(",")]
        most = int(self.options.get("partitionbytes", PARTITION_BYTES))
        return [r for p in paths for r in planned(p, self.options.get("reader", "extract"), most)] or [Rows("", 0, 0)]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield batch_of(partition)


class Hdf5Patches(DataSource):
    """Options: path (a folder or a file), reader (extract, patch or segment), samples (names with commas), partitionBytes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options))


def patches(spark: SparkSession, path: str, reader: str = "extract", samples: list[str] | None = None, partition_bytes: int = PARTITION_BYTES):
    """The patches of all files in a folder, in the columns of the engine."""
    spark.dataSource.register(Hdf5Patches)
    found = spark.read.format(FORMAT).option("reader", reader).option("partitionBytes", partition_bytes)
    return (found.option("samples", ",".join(samples)) if samples else found).load(path)
