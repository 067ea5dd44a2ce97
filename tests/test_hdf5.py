"""The HDF5 source against files written byte by byte."""

import struct
import zlib

import numpy as np
import pytest

from spatialfeat import schema
from spatialfeat.functions import hdf5
from spatialfeat.operators import expression
from spatialfeat.plans import drivers, pipeline
from spatialfeat.sources import h5ad, readers
from spatialfeat.sources import hdf5 as source

NOWHERE = b"\xff" * 8
TYPES = {"u1": bytes([0x10, 0, 0, 0]) + struct.pack("<IHH", 1, 0, 8), "<f8": bytes([0x11, 0x20, 0x3F, 0]) + struct.pack("<I", 8) + b"\0" * 12, ">i4": bytes([0x10, 9, 0, 0]) + struct.pack("<IHH", 4, 0, 32), "<f4": bytes([0x11, 0x20, 0x1F, 0]) + struct.pack("<I", 4) + b"\0" * 12}


class Writer:
    def __init__(self, head):
        self.data = bytearray(head)

    def put(self, body):
        self.data += b"\0" * (-len(self.data) % 8)
        at = len(self.data)
        self.data += body
        return at

    def header(self, messages, new=False, cut=False):
        """A header of the old or the new form; with cut, its last message is in a continuation."""
        if new:
            one = lambda k, m: struct.pack("<BHB", k, len(m), 0) + m
            if cut:
                more = self.put(b"OCHK" + one(*messages[-1]) + b"\0" * 4)
                messages = [*messages[:-1], (hdf5.CONTINUED, struct.pack("<QQ", more, 8 + len(one(*messages[-1]))))]
            body = b"".join(one(k, m) for k, m in messages)
            return self.put(b"OHDR" + struct.pack("<BBI", 2, 2, len(body)) + body + b"\0" * 4)
        one = lambda k, m: struct.pack("<HHB3x", k, len(m) + -len(m) % 8, 0) + m + b"\0" * (-len(m) % 8)
        if cut:
            last = one(*messages[-1])
            messages = [*messages[:-1], (hdf5.CONTINUED, struct.pack("<QQ", self.put(last), len(last)))]
        body = b"".join(one(k, m) for k, m in messages)
        return self.put(struct.pack("<BxHII4x", 1, len(messages), 1, len(body)) + body)

    def tree(self, kind, level, entries, last):
        return self.put(b"TREE" + struct.pack("<BBH", kind, level, len(entries)) + NOWHERE * 2 + b"".join(k + struct.pack("<Q", a) for k, a in entries) + last)

    def table(self, array, how="contiguous", piece=None, filters=(), new=False, texts=None, cut=False):
        space = struct.pack("<BBB5x", 1, array.ndim, 0) if not new else struct.pack("<BBBB", 2, array.ndim, 0, 1)
        space += struct.pack(f"<{array.ndim}Q", *array.shape)
        kind = texts or TYPES[array.dtype.str.lstrip("|")]
        messages = [(hdf5.SPACE, space), (hdf5.TYPE, kind)]
        if how == "compact":
            messages.append((hdf5.LAYOUT, struct.pack("<BBH", 3, 0, array.nbytes) + array.tobytes()))
        elif how == "contiguous":
            messages.append((hdf5.LAYOUT, struct.pack("<BB", 3, 1) + struct.pack("<QQ", self.put(array.tobytes()), array.nbytes)))
        else:
            entries, size = [], array.dtype.itemsize
            for place in np.ndindex(*(-(-s // p) for s, p in zip(array.shape, piece, strict=True))):
                at = tuple(i * p for i, p in zip(place, piece, strict=True))
                own = np.zeros(piece, array.dtype)
                part = array[tuple(slice(a, a + p) for a, p in zip(at, piece, strict=True))]
                own[tuple(slice(0, s) for s in part.shape)] = part
                body, mask = own.tobytes(), 0
                for k, f in enumerate(filters):
                    if f == hdf5.SHUFFLE:
                        body = np.frombuffer(body, np.uint8).reshape(-1, size).T.tobytes()
                    elif f == hdf5.DEFLATE and len(entries) % 3 == 1:
                        mask |= 1 << k  # this piece is stored without it
                    elif f == hdf5.DEFLATE:
                        body = zlib.compress(body)
                    elif f == hdf5.CHECKSUM:
                        body += b"\1\2\3\4"
                entries.append((struct.pack(f"<II{array.ndim + 1}Q", len(body), mask, *at, 0), self.put(body)))
            last, level = entries[-1][0], 0
            if len(entries) > 2:  # two levels
                half, level = len(entries) // 2, 1
                entries = [(part[0][0], self.tree(1, 0, part, last)) for part in (entries[:half], entries[half:])]
            tree = self.tree(1, level, entries, last)
            messages.append((hdf5.LAYOUT, struct.pack("<BBB", 3, 2, array.ndim + 1) + struct.pack("<Q", tree) + struct.pack(f"<{array.ndim + 1}I", *piece, size)))
            if filters:
                values = {hdf5.SHUFFLE: (size,), hdf5.DEFLATE: (6,), hdf5.CHECKSUM: ()}
                if new:
                    pipe = bytes([2, len(filters)]) + b"".join(struct.pack(f"<HHH{len(values[f])}I", f, 0, len(values[f]), *values[f]) for f in filters)
                else:
                    pipe = bytes([1, len(filters)]) + b"\0" * 6 + b"".join(struct.pack("<HHHH", f, 8, 0, len(values[f])) + b"filter\0\0" + struct.pack(f"<{len(values[f])}I", *values[f]) + b"\0" * (4 * (len(values[f]) % 2)) for f in filters)
                messages.insert(2, (hdf5.FILTERS, pipe))
        return self.header(messages, new, cut)

    def texts(self, values):
        """Texts of any length, in heaps of three; the pointers to them."""
        out = []
        for a in range(0, len(values), 3):
            body = b"".join(struct.pack("<HH4xQ", k + 1, 1, len(v)) + v + b"\0" * (-len(v) % 8) for k, v in enumerate(values[a : a + 3]))
            heap = self.put(b"GCOL" + struct.pack("<B3xQ", 1, 16 + len(body) + 16) + body + b"\0" * 16)
            out += [struct.pack("<IQI", len(v), heap, k + 1) for k, v in enumerate(values[a : a + 3])]
        return np.frombuffer(b"".join(out), "V16")


ANY_LENGTH = bytes([0x19, 1, 0, 0]) + struct.pack("<I", 16) + TYPES["u1"]


def old_file(path, tables):
    """Superblock 0, a group with a symbol table."""
    w = Writer(b"\0" * 96)
    at = {name: make(w) for name, make in sorted(tables.items())}
    names, offsets = b"\0" * 8, {}
    for name in at:
        offsets[name] = len(names)
        names += name.encode() + b"\0" * (8 - len(name) % 8)
    heap = w.put(b"HEAP" + struct.pack("<B3xQQQ", 0, len(names), 0xFFFFFFFFFFFFFFFF, w.put(names)))
    node = w.put(b"SNOD" + struct.pack("<BxH", 1, len(at)) + b"".join(struct.pack("<QQI4x16x", offsets[n], a, 0) for n, a in at.items()))
    tree = w.tree(0, 0, [(struct.pack("<Q", 0), node)], struct.pack("<Q", offsets[list(at)[-1]]))
    root = w.header([(hdf5.SYMBOLS, struct.pack("<QQ", tree, heap))])
    w.data[:96] = hdf5.SIGNATURE + struct.pack("<BBBxBBBxHHI", 0, 0, 0, 0, 8, 8, 4, 16, 0) + struct.pack("<Q", 0) + NOWHERE + struct.pack("<Q", len(w.data)) + NOWHERE + struct.pack("<QQI4x16x", 0, root, 0)
    path.write_bytes(bytes(w.data))


class Group:
    """Tables under a name, with links in its header."""

    def __init__(self, tables):
        self.tables = tables

    def __call__(self, w):
        links = [(hdf5.LINK, struct.pack("<BBB", 1, 0, len(n)) + n.encode() + struct.pack("<Q", make(w))) for n, make in self.tables.items()]
        return w.header([(hdf5.LINK_INFO, bytes([0, 0]) + NOWHERE * 2), *links], new=True)


def new_file(path, tables):
    """Superblock 2, a group with links in its header."""
    w = Writer(b"\0" * 48)
    links = [(hdf5.LINK, struct.pack("<BBB", 1, 0, len(n)) + n.encode() + struct.pack("<Q", make(w))) for n, make in tables.items()]
    root = w.header([(hdf5.LINK_INFO, bytes([0, 0]) + NOWHERE * 2), *links], new=True)
    w.data[:48] = hdf5.SIGNATURE + struct.pack("<BBBB", 2, 8, 8, 0) + struct.pack("<Q", 0) + NOWHERE + struct.pack("<QQI", len(w.data), root, 0)
    path.write_bytes(bytes(w.data))


@pytest.fixture(scope="module")
def images():
    rng = np.random.default_rng(3)
    return rng.integers(0, 256, (23, 8, 8, 3), dtype=np.uint8)


@pytest.fixture
def folder(tmp_path, images):
    at = tmp_path / "data/IDC/patches"
    at.mkdir(parents=True)
    codes = [f"Bé{i}-{'x' * (i % 5)}" for i in range(23)]
    places = np.arange(46, dtype=float).reshape(23, 2)
    old_file(at / "s1.h5", {
        "img": lambda w: w.table(images, "chunked", (4, 5, 8, 2), (hdf5.SHUFFLE, hdf5.DEFLATE), cut=True), "coords": lambda w: w.table(places),
        "barcodes": lambda w: w.table(w.texts([c.encode() for c in codes]).reshape(23, 1), texts=ANY_LENGTH),
    })
    fixed = np.array([c.encode() for c in codes], "S12")
    new_file(at / "s2.h5", {
        "images": lambda w: w.table(images.transpose(0, 3, 1, 2), "chunked", (10, 3, 8, 8), (hdf5.DEFLATE, hdf5.CHECKSUM), new=True, cut=True), "coordinates": lambda w: w.table(places.astype(">i4"), "chunked", (6, 2), (hdf5.SHUFFLE,), new=True),
        "spot_id": lambda w: w.table(fixed, "compact", new=True, texts=bytes([0x13, 0, 0, 0]) + struct.pack("<I", 12)),
    })
    (at / "notes.txt").write_text("no patches")
    return at, codes, places


def test_patches_of_both_forms_of_files(spark, folder, images):
    at, codes, places = folder
    df = source.patches(spark, str(at), partition_bytes=4 * 8 * 8 * 3)
    assert df.rdd.getNumPartitions() == 6 + 3  # runs of whole pieces
    rows = df.orderBy("sample_id", "patch_idx").collect()
    assert [(r.sample_id, r.patch_idx) for r in rows] == [(s, i) for s in ("s1", "s2") for i in range(23)]
    for r in rows:
        image = np.frombuffer(r.px, np.uint8)
        want = images[r.patch_idx] if r.layout == "hwc" else images[r.patch_idx].transpose(2, 0, 1)
        assert np.array_equal(image.reshape(want.shape), want) and (r.h, r.w) == (8, 8) and r.layout == ("hwc" if r.sample_id == "s1" else "chw")
        assert r.barcode == codes[r.patch_idx] and (r.x, r.y) == tuple(places[r.patch_idx])
    one = source.patches(spark, str(at / "s2.h5")).collect()
    assert len(one) == 23 and source.patches(spark, str(at), samples=["s2"]).count() == 23
    empty = at / "none"
    empty.mkdir()
    assert source.patches(spark, str(empty)).count() == 0


def test_only_pieces_of_the_rows_are_read(folder):
    at, _, _ = folder
    handle, read = source.opened(str(at / "s1.h5"))
    file = hdf5.File(read)
    table = file.table(file.names()["img"])
    seen = []
    got = hdf5.rows(lambda a, n: seen.append(a) or read(a, n), table, 9, 10)
    assert got.shape == (1, 8, 8, 3) and len(seen) == len(table.pieces) // 6  # one of six layers of pieces
    handle.close()


def test_features_from_files_are_those_of_tables(spark, folder, images):
    at, codes, places = folder
    flat = [("s1", i, codes[i], float(places[i, 0]), float(places[i, 1]), 8, 8, images[i].reshape(-1).tolist()) for i in range(23)]
    table = spark.createDataFrame(flat, schema.PATCHES)
    # sums over other batches may differ in their last bits
    plain = lambda rows, s: sorted(str([float(f"{v:.9g}") if isinstance(v, float) else v for c, v in r.asDict().items() if c != "sample_id"]) for r in rows if r.sample_id == s)
    want = plain(pipeline.threshold_features(table).collect(), "s1")
    got = pipeline.threshold_features(source.patches(spark, str(at))).collect()
    assert plain(got, "s1") == want and plain(got, "s2") == want


def test_drivers_read_files(spark, folder):
    at, _, _ = folder
    root = str(at.parent.parent)
    assert readers.sample_ids(spark, str(at)) == ["s1", "s2"]
    assert drivers.extract_all(spark, schema.Config(root=root, sample_ids=("s2",)))["IDC"] == {"s2": "written"}
    (at / "s3.h5").write_bytes(hdf5.SIGNATURE + b"\0" * 50)
    out = drivers.extract_all(spark, schema.Config(root=root))["IDC"]
    assert out["s1"] == "written" and out["s2"] == "skipped" and out["s3"].startswith("failed")


def test_floats_gray_images_and_missing_tables(spark, tmp_path):
    x = np.array([[[0.0, 0.5], [1.0, 0.999]], [[0.0, 2.0], [300.0, -4.0]]], "<f4")
    old_file(tmp_path / "f.h5", {"img": lambda w: w.table(x)})
    rows = source.patches(spark, str(tmp_path), "patch").orderBy("patch_idx").collect()
    assert [list(r.px) for r in rows] == [[0, 127, 255, 254], [0, 2, 255, 0]] and rows[0].layout == "gray" and rows[0].barcode is None and rows[0].x is None
    with pytest.raises(Exception, match="no table for coords"):
        source.patches(spark, str(tmp_path), "extract").count()
    (tmp_path / "f.h5").write_bytes(b"nothing of the kind")
    with pytest.raises(Exception, match="f.h5: this is no HDF5 file"):
        source.patches(spark, str(tmp_path), "patch").count()


def test_pieces_that_were_never_stored_are_zero():
    table = hdf5.Table((5, 2), hdf5.Kind("<f8"), (2, 2), [])
    assert hdf5.rows(None, table, 1, 4).tolist() == [[0.0, 0.0]] * 3


# ------------------------------------------------------------ matrices


def names_of(values):
    return Group({"_index": lambda w: w.table(w.texts([v.encode() for v in values]), texts=ANY_LENGTH)})


def test_matrices_in_rows_and_full_ones(spark, tmp_path):
    rng = np.random.default_rng(5)
    full = np.where(rng.random((50, 9)) < 0.2, rng.integers(1, 9, (50, 9)), 0).astype("<f8")
    full[[3, 4, 49]] = 0
    full[:, 2] = np.arange(50) % 2
    full[[3, 4, 49]] = 0
    row, index = np.nonzero(full)
    edges = np.searchsorted(row, np.arange(51))
    obs, var = [f"o{i // 2}" for i in range(50)], [f"G{8 - i}" for i in range(9)]
    X = Group({
        "data": lambda w: w.table(full[row, index].astype("<f4"), "chunked", (16,), (hdf5.SHUFFLE, hdf5.DEFLATE)), "indices": lambda w: w.table(index.astype(">i4"), "chunked", (16,), (hdf5.DEFLATE,)),
        "indptr": lambda w: w.table(edges.astype(">i4")),
    })
    new_file(tmp_path / "a.h5ad", {"X": X, "obs": names_of(obs), "var": names_of(var)})
    new_file(tmp_path / "b.h5ad", {"X": lambda w: w.table(full, "chunked", (7, 4), (hdf5.DEFLATE,)), "obs": names_of(obs), "var": names_of(var)})
    matrix, genes_ = h5ad.matrix(spark, str(tmp_path), partition_rows=8)
    assert matrix.rdd.getNumPartitions() == 14
    rows = {(r.sample_id, r.obs_row): r for r in matrix.collect()}
    for s in "ab":
        for i in range(50):
            r = rows[s, i]
            assert r.obs_id == obs[i] and r.indices == np.flatnonzero(full[i]).tolist() and r.data == full[i][full[i] != 0].tolist()
    assert {(r.sample_id, r["index"], r.gene) for r in genes_.collect()} == {(s, i, g) for s in "ab" for i, g in enumerate(var)}
    of = expression.totals(matrix, genes_)
    assert {r.n_obs for r in of.sizes.collect()} == {50}
    assert {(r.sample_id, r.gene): r.n_detected for r in of.sums.collect()} == {(s, g): int((full[:, i] > 0).sum()) for s in "ab" for i, g in enumerate(var)}
    one = h5ad.matrix(spark, str(tmp_path), ["b"])[0]
    assert one.count() == 50
    # the drivers take gene sets from the files
    at = tmp_path / "data/IDC/st"
    at.mkdir(parents=True)
    for f in "ab":
        (at / f"{f}.h5ad").write_bytes((tmp_path / f"{f}.h5ad").read_bytes())
    out = drivers.gene_sets_all(spark, schema.Config(root=str(tmp_path / "data"), oncotrees=("IDC",), genes_k=(2,), genes_criteria=("mean",)))
    means = sorted(((-full[:, i].mean(), g) for i, g in enumerate(var) if (full[:, i] > 0).sum() >= 5))[:2]
    assert out[0]["num_genes"] == 2 and spark.read.json(str(tmp_path / "data/IDC/genes/mean_2genes.json")).first().genes == [g for _, g in means]


def test_matrices_that_cannot_be_read(spark, tmp_path):
    new_file(tmp_path / "a.h5ad", {"X": lambda w: w.table(np.zeros((3, 2))), "obs": names_of(["a", "b"]), "var": names_of(["g", "h"])})
    with pytest.raises(Exception, match="a.h5ad: X has 3 rows for 2 observations"):
        h5ad.matrix(spark, str(tmp_path))[0].count()
    new_file(tmp_path / "a.h5ad", {"obs": names_of(["a", "b"])})
    with pytest.raises(Exception, match="no X"):
        h5ad.matrix(spark, str(tmp_path))[0].count()
