"""Well-known binary and text of polygons, decoded and encoded over whole Arrow columns.

Polygons are what cells are made of: of every geometry, however collections nest, its polygons in order are taken; points and lines
have none. The binary form is read header by header for all rows at once: what is left to read of a row is a number of headers, to
which a collection adds its members, so nesting needs no stack. Either byte order, Z, M and SRID are read; only x and y are kept.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 (pa.compute)

POINTS = pa.struct([("x", pa.float64()), ("y", pa.float64())])
RINGS = pa.list_(pa.list_(POINTS))
POLYGONS = pa.list_(RINGS)
#: Kinds of geometries, and what is added to them for an SRID, M and Z in the extended form.
POINT, LINE, POLYGON, MULTI_POLYGON = 1, 2, 3, 6
COLLECTIONS = (4, 5, 6, 7)
SRID, M, Z = 0x20000000, 0x40000000, 0x80000000


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The data of a binary column and the edges of its rows; null rows are empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    edges = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    buffer = column.buffers()[2]
    return np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8), edges


class _Cursor:
    """Reads of many rows at once, each at its own place and in its own byte order; beyond the end of a row is an error."""

    def __init__(self, column: pa.Array):
        self.data, edges = _bytes(column)
        self.at, self.end = edges[:-1].copy(), edges[1:]
        self.big = np.zeros(len(self.at), bool)

    def _take(self, rows: np.ndarray, n: int | np.ndarray) -> np.ndarray:
        start = self.at[rows]
        self.at[rows] = start + n
        if (self.at[rows] > self.end[rows]).any():
            raise ValueError("a geometry ends early")
        return start

    def order(self, rows: np.ndarray) -> None:
        found = self.data[self._take(rows, 1)]
        if (found > 1).any():
            raise ValueError("a geometry has no byte order")
        self.big[rows] = found == 0

    def number(self, rows: np.ndarray) -> np.ndarray:
        """An unsigned whole number of 32 bits of each row."""
        raw = self.data[self._take(rows, 4)[:, None] + np.arange(4)]
        raw = np.where(self.big[rows][:, None], raw[:, ::-1], raw)
        return np.ascontiguousarray(raw).view("<u4").reshape(-1).astype(np.int64)

    def skip(self, rows: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Passes over so many bytes of each row; where they begin."""
        return self._take(rows, n)

    def points(self, start: np.ndarray, n: np.ndarray, size: np.ndarray, big: np.ndarray) -> np.ndarray:
        """x and y of runs of points of so many numbers each."""
        run = np.repeat(np.arange(len(n)), n)
        at = start[run] + (np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)) * 8 * size[run]
        raw = self.data[at[:, None] + np.arange(16)].reshape(-1, 2, 8) if len(at) else np.zeros((0, 2, 8), np.uint8)
        raw = np.where(big[run][:, None, None], raw[:, :, ::-1], raw)
        return np.ascontiguousarray(raw).view("<f8").reshape(-1, 2)


def _nested(sizes: list[np.ndarray], xy: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Polygons of rows from how many polygons, rings and points each level has; rows that are not valid are null."""
    edges = lambda n: np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
    points = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=list(POINTS))
    rings = pa.ListArray.from_arrays(pa.array(edges(sizes[2])), points)
    polygons = pa.ListArray.from_arrays(pa.array(edges(sizes[1])), rings)
    mask = None if valid.all() else pa.array(~valid)
    return pa.ListArray.from_arrays(pa.array(edges(sizes[0])), polygons, mask=mask).cast(POLYGONS)


def decoded(column: pa.Array) -> pa.Array:
    """The polygons of each row of a column of well-known binary; a null row is null, one without polygons is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    valid = np.asarray(column.is_valid())
    read = _Cursor(column)
    left = np.where(valid, 1, 0)
    turn, polygons, rings = 0, [], []
    while (rows := np.flatnonzero(left)).size:
        left[rows] -= 1
        read.order(rows)
        kind = read.number(rows)
        with_srid = rows[(kind & SRID) > 0]
        read.skip(with_srid, np.full(len(with_srid), 4))
        iso = kind & 0xFFFF
        if not np.isin(iso % 1000, range(1, 8)).all() or (iso >= 4000).any():
            raise ValueError("a geometry is of an unknown kind")
        numbers = 2 + ((kind & Z) > 0) + ((kind & M) > 0) + np.where(iso // 1000 == 3, 2, np.minimum(iso // 1000, 1))
        kind = iso % 1000
        of = lambda *kinds, rows=rows, kind=kind: (rows[np.isin(kind, kinds)], np.isin(kind, kinds))
        own, at = of(POINT)
        read.skip(own, 8 * numbers[at])
        own, at = of(LINE)
        read.skip(own, read.number(own) * 8 * numbers[at])
        own, at = of(*COLLECTIONS)
        left[own] += read.number(own)
        own, at = of(POLYGON)
        count, size = read.number(own), numbers[at]
        polygons.append(np.stack([own, np.full(len(own), turn), count], 1))
        for k in range(int(count.max(initial=0))):
            some = count > k
            n = read.number(own[some])
            start = read.skip(own[some], n * 8 * size[some])
            rings.append(np.stack([own[some], np.full(len(n), turn), np.full(len(n), k), n, start, size[some], read.big[own[some]]], 1))
        turn += 1
    p = np.concatenate([np.zeros((0, 3), np.int64), *polygons]).astype(np.int64)
    r = np.concatenate([np.zeros((0, 7), np.int64), *rings]).astype(np.int64)
    p, r = p[np.lexsort((p[:, 1], p[:, 0]))], r[np.lexsort((r[:, 2], r[:, 1], r[:, 0]))]
    p = p[p[:, 2] > 0]
    xy = read.points(r[:, 4], r[:, 3], r[:, 5], r[:, 6] > 0)
    return _nested([np.bincount(p[:, 0], minlength=len(column)), p[:, 2], r[:, 3]], xy, valid)


def _levels(column: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """How many polygons, rings and points each level has, and the points."""
    sizes, level = [], column
    for _ in range(3):
        sizes.append(np.asarray(level.value_lengths().fill_null(0)).astype(np.int64))
        level = level.flatten()
    return sizes, np.stack([np.asarray(level.field(k).cast(pa.float64())) for k in (0, 1)], 1) if len(level) else np.zeros((0, 2))


def encoded(column: pa.Array) -> pa.Array:
    """Well-known binary, little-endian, of rows of polygons: a polygon, or where there is not just one, all in a multi-polygon. Rings
    that are open are closed; a null row is null."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    (per_row, per_polygon, per_ring), xy = _levels(column)
    ring_edges, polygon_edges, row_edges = (np.concatenate([[0], np.cumsum(n)]) for n in (per_ring, per_polygon, per_row))
    first, last = ring_edges[:-1], ring_edges[1:] - 1
    there = per_ring > 0
    open_ = np.zeros(len(per_ring), bool)
    open_[there] = (xy[first[there]] != xy[last[there]]).any(1)
    points = per_ring + open_
    summed = lambda v, edges: np.concatenate([[0], np.cumsum(v)])[edges]
    ring_bytes = 4 + 16 * points
    polygon_bytes = 9 + np.diff(summed(ring_bytes, polygon_edges))
    many = per_row != 1
    row_bytes = np.where(np.asarray(column.is_valid()), np.diff(summed(polygon_bytes, row_edges)) + 9 * many, 0)
    row_at = np.concatenate([[0], np.cumsum(row_bytes)])
    row_of = np.repeat(np.arange(len(per_row)), per_row)
    polygon_of = np.repeat(np.arange(len(per_polygon)), per_polygon)
    polygon_at = row_at[:-1][row_of] + 9 * many[row_of] + _within(polygon_bytes, row_of)
    ring_at = polygon_at[polygon_of] + 9 + _within(ring_bytes, polygon_of) if len(per_ring) else np.zeros(0, np.int64)
    out = np.zeros(int(row_at[-1]), np.uint8)

    def put(at: np.ndarray, values: np.ndarray, kind: str) -> None:
        raw = np.ascontiguousarray(values.astype(kind)).view(np.uint8)
        if len(values):
            raw = raw.reshape(len(values), -1)
            out[at[:, None] + np.arange(raw.shape[1])] = raw

    whole = np.flatnonzero(many & (row_bytes > 0))
    for at, kind, count in ((row_at[whole], MULTI_POLYGON, per_row[whole]), (polygon_at, POLYGON, per_polygon)):
        put(at, np.ones(len(at)), "u1")
        put(at + 1, np.full(len(at), kind), "<u4")
        put(at + 5, count, "<u4")
    put(ring_at, points, "<u4")
    ring_of = np.repeat(np.arange(len(per_ring)), per_ring)
    put(ring_at[ring_of] + 4 + 16 * (np.arange(len(xy)) - first[ring_of]), xy, "<f8")
    put((ring_at + 4 + 16 * per_ring)[open_], xy[first[open_]], "<f8")
    buffers = [None, pa.py_buffer(row_at.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())]
    made = pa.Array.from_buffers(pa.large_binary(), len(column), buffers).cast(pa.binary())
    return pa.compute.if_else(column.is_valid(), made, pa.scalar(None, pa.binary())) if column.null_count else made


def _within(sizes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Sums of the sizes before each one, of the same owner; owners stand together."""
    before = np.cumsum(sizes) - sizes
    new = np.ones(len(sizes), bool)
    new[1:] = owner[1:] != owner[:-1]
    return before - np.maximum.accumulate(np.where(new, before, 0)) if len(sizes) else before


# ---------------------------------------------------------------- text

#: The kinds of well-known text.
KINDS = ("POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "MULTIPOLYGON", "GEOMETRYCOLLECTION")
_TOKEN = re.compile(r"[A-Za-z]+|[(),]|[^\s(),]+")


def polygons_of_text(text: str) -> list[list[list[tuple[float, float]]]]:
    """The polygons of a well-known text, however collections nest."""
    polygons, rings, ring, point = [], [], [], []
    kind, depth = "", 0
    for token in _TOKEN.findall(text.rpartition(";")[2]):
        if token == "(":
            depth += 1
        elif token in (",", ")"):
            if point:
                if len(point) < 2:
                    raise ValueError("a point has one number")
                ring.append((point[0], point[1]))
                point = []
            if token == ")":
                depth -= 1
                if ring:
                    rings.append(ring)
                elif rings:
                    polygons += [rings] if "POLYGON" in kind else []
                    rings = []
                ring = []
                if "POLYGON" not in kind:
                    rings = []
        elif token[0].isalpha() and token.upper() not in ("Z", "M", "ZM", "EMPTY", "NAN", "INF"):
            kind = token.upper()
            if kind.removesuffix("ZM").removesuffix("Z").removesuffix("M") not in KINDS:
                raise ValueError(f"no such geometry: {token}")
        elif not token[0].isalpha() or token.upper() in ("NAN", "INF"):
            point.append(float(token))
    if depth:
        raise ValueError("brackets of a geometry do not match")
    return polygons


def parsed(column: pa.Array) -> pa.Array:
    """The polygons of each row of a column of well-known text; a null row is null, one without polygons is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = [None if t is None else polygons_of_text(t) for t in column.to_pylist()]
    flat = [p for row in rows if row for p in row]
    rings = [r for p in flat for r in p]
    xy = np.array([q for r in rings for q in r], float).reshape(-1, 2)
    sizes = [np.array([len(x or ()) for x in level], np.int64) for level in (rows, flat, rings)]
    return _nested(sizes, xy, np.array([r is not None for r in rows], bool))
