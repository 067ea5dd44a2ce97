"""Tables of HDF5 files, read by rows: where the pieces of a table are, and their values.

A file is read at the places that matter only: the superblock, the headers of groups and tables, the index of a table's pieces, and then
the pieces that hold the rows asked for. Read are the forms in which patches and matrices are kept: groups with symbol tables or with
links in their headers; compact, contiguous and chunked tables (pieces indexed by a B-tree); the filters shuffle, deflate and checksum;
whole numbers, floats, fixed texts and texts of any length. Anything else is an error that says what it is.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

#: Signatures, kinds of messages in headers, numbers of filters.
SIGNATURE = b"\x89HDF\r\n\x1a\n"
SPACE, LINK_INFO, TYPE, LINK, LAYOUT, FILTERS, CONTINUED, SYMBOLS = 0x01, 0x02, 0x03, 0x06, 0x08, 0x0B, 0x10, 0x11
DEFLATE, SHUFFLE, CHECKSUM = 1, 2, 3

Read = Callable[[int, int], bytes]


class Unsupported(ValueError):
    """A file has a form that is not read."""


@dataclass
class Kind:
    """The type of values: a NumPy type, or texts of any length."""

    dtype: str
    texts: bool = False

    @property
    def size(self) -> int:
        return 16 if self.texts else np.dtype(self.dtype).itemsize


@dataclass
class Table:
    """What a header says of a table. pieces: (offset in each direction, address, bytes, filters left out) of stored pieces."""

    shape: tuple[int, ...]
    kind: Kind
    piece: tuple[int, ...] = ()
    pieces: list[tuple[tuple[int, ...], int, int, int]] = field(default_factory=list)
    filters: list[tuple[int, tuple[int, ...]]] = field(default_factory=list)
    inline: bytes | None = None

    def rows(self, first: int, last: int) -> Table:
        """The table with those pieces only that hold some of the rows."""
        tall = self.piece[0] if self.piece else 1
        some = [p for p in self.pieces if p[0][0] < last and p[0][0] + tall > first]
        return Table(self.shape, self.kind, self.piece, some, self.filters, self.inline)


class File:
    """The groups and tables of a file, by name."""

    def __init__(self, read: Read):
        self.read = read
        head = read(0, 96)
        if head[:8] != SIGNATURE:
            raise Unsupported("this is no HDF5 file")
        version = head[8]
        if version > 3:
            raise Unsupported(f"superblock of version {version}")
        if version < 2:
            self.o, self.l = head[13], head[14]
            at = 24 + (4 if version == 1 else 0) + 4 * self.o
            self.root = self._number(head, at + self.o, self.o)
        else:
            self.o, self.l = head[9], head[10]
            self.root = self._number(head, 12 + 3 * self.o, self.o)

    @staticmethod
    def _number(data: bytes, at: int, size: int) -> int:
        return int.from_bytes(data[at : at + size], "little")

    # ---- headers

    def messages(self, at: int) -> list[tuple[int, bytes]]:
        """(kind, body) of the messages in a header and its continuations."""
        head = self.read(at, 32)
        if head[:4] == b"OHDR":
            flags = head[5]
            skip = 6 + (16 if flags & 0x20 else 0) + (4 if flags & 0x10 else 0)
            width = 1 << (flags & 3)
            first = (at + skip + width, self._number(self.read(at + skip, width), 0, width))
            return self._walk([first], lambda b, k: (b[k], self._number(b, k + 1, 2), 4 + (2 if flags & 4 else 0)), (4, 4))
        if head[0] != 1:
            raise Unsupported("a header of an unknown version")
        return self._walk([(at + 16, self._number(head, 8, 4))], lambda b, k: (self._number(b, k, 2), self._number(b, k + 2, 2), 8), (0, 0))

    def _walk(self, blocks: list[tuple[int, int]], one, frame: tuple[int, int]) -> list[tuple[int, bytes]]:
        out = []
        while blocks:
            at, size = blocks.pop(0)
            body, k = self.read(at, size), 0
            while k + 4 <= size:
                kind, n, head = one(body, k)
                if k + head + n > size:
                    break
                data = body[k + head : k + head + n]
                if kind == CONTINUED:
                    blocks.append((self._number(data, 0, self.o) + frame[0], self._number(data, self.o, self.l) - sum(frame)))
                elif kind:
                    out.append((kind, data))
                k += head + n
        return out

    # ---- groups

    def names(self, at: int | None = None) -> dict[str, int]:
        """Names in a group and the addresses of their headers."""
        out: dict[str, int] = {}
        for kind, m in self.messages(self.root if at is None else at):
            if kind == SYMBOLS:
                tree, heap = self._number(m, 0, self.o), self._number(m, self.o, self.o)
                head = self.read(heap, 8 + 2 * self.l + self.o)
                names = self.read(self._number(head, 8 + 2 * self.l, self.o), self._number(head, 8, self.l))
                for leaf in self._leaves(tree, 0, self.l):
                    out |= self._symbols(leaf[1], names)
            elif kind == LINK:
                out |= self._link(m)
            elif kind == LINK_INFO:
                more = 2 + (8 if m[1] & 1 else 0)
                if self._number(m, more, self.o) != (1 << 8 * self.o) - 1:
                    raise Unsupported("a group whose links are in a heap of their own")
        return out

    def at(self, path: str) -> int | None:
        """The header of what a path of names leads to, None if there is nothing."""
        place: int | None = None
        for name in path.split("/"):
            place = self.names(place).get(name)
            if place is None:
                return None
        return place

    def is_table(self, at: int) -> bool:
        return LAYOUT in dict(self.messages(at))

    def _symbols(self, at: int, names: bytes) -> dict[str, int]:
        count, each = self._number(self.read(at, 8), 6, 2), 2 * self.o + 24
        body = self.read(at + 8, count * each)
        found = {}
        for k in range(0, len(body), each):
            start = self._number(body, k, self.o)
            found[names[start : names.index(b"\0", start)].decode()] = self._number(body, k + self.o, self.o)
        return found

    def _link(self, m: bytes) -> dict[str, int]:
        flags, k = m[1], 2
        kind = m[k] if flags & 8 else 0
        k += (1 if flags & 8 else 0) + (8 if flags & 4 else 0) + (1 if flags & 16 else 0)
        width = 1 << (flags & 3)
        n = self._number(m, k, width)
        name = m[k + width : k + width + n].decode()
        return {name: self._number(m, k + width + n, self.o)} if kind == 0 else {}

    def _leaves(self, at: int, kind: int, key: int, wanted: Callable[[bytes, bytes], bool] = lambda low, high: True) -> list[tuple[bytes, int]]:
        """(key, address) of what the lowest nodes of a B-tree point to, in order; only branches whose first and last key are wanted."""
        out, todo = [], [at]
        while todo:
            at = todo.pop()
            head = self.read(at, 8 + 2 * self.o)
            if head[:4] != b"TREE" or head[4] != kind:
                raise Unsupported("an index that is no B-tree")
            n = self._number(head, 6, 2)
            body = self.read(at + 8 + 2 * self.o, n * (key + self.o) + key)
            step = key + self.o
            found = [(body[k : k + key], self._number(body, k + key, self.o)) for k in range(0, n * step, step) if wanted(body[k : k + key], body[k + step : k + step + key])]
            if head[5]:
                todo += [a for _, a in reversed(found)]
            else:
                out += found
        return out

    # ---- tables

    def table(self, at: int, first: int = 0, last: int = 1 << 62) -> Table:
        """The table with a header at an address, with the pieces of some of its rows; other branches of their index are not read."""
        found = dict(self.messages(at))
        if not {SPACE, TYPE, LAYOUT} <= set(found):
            raise Unsupported("a name that is no table")
        space = found[SPACE]
        start = 8 if space[0] == 1 else 4
        shape = tuple(self._number(space, start + k * self.l, self.l) for k in range(space[1]))
        out = Table(shape, self._kind(found[TYPE]), filters=self._filters(found[FILTERS]) if FILTERS in found else [])
        layout = found[LAYOUT]
        if layout[0] == 4 and layout[1] == 2 or layout[0] not in (3, 4):
            raise Unsupported(f"a layout of version {layout[0]}")
        if layout[1] == 0:
            out.inline = layout[4 : 4 + self._number(layout, 2, 2)]
        elif layout[1] == 1:
            at, size = self._number(layout, 2, self.o), self._number(layout, 2 + self.o, self.l)
            out.piece = shape
            out.pieces = [((0,) * len(shape), at, size, 0)] if self._there(at) and size else []
        else:
            rank = layout[2] - 1
            tree = self._number(layout, 3, self.o)
            out.piece = struct.unpack(f"<{rank}I", layout[3 + self.o : 3 + self.o + 4 * rank])
            place = lambda key: struct.unpack("<Q", key[8:16])[0]
            held = lambda low, high: place(low) < last and place(high) + out.piece[0] > first
            for key, address in self._leaves(tree, 1, 8 + 8 * (rank + 1), held) if self._there(tree) else []:
                size, left_out = struct.unpack("<II", key[:8])
                out.pieces.append((struct.unpack(f"<{rank}Q", key[8 : 8 + 8 * rank]), address, size, left_out))
        return out

    def _there(self, at: int) -> bool:
        return at != (1 << 8 * self.o) - 1

    def _kind(self, m: bytes) -> Kind:
        kind, bits, size = m[0] & 15, m[1], self._number(m, 4, 4)
        order = ">" if bits & 1 else "<"
        if kind == 0:
            return Kind(f"{order}{'i' if bits & 8 else 'u'}{size}")
        if kind == 1:
            return Kind(f"{order}f{size}")
        if kind == 3:
            return Kind(f"S{size}")
        if kind == 9 and bits & 15 == 1:
            return Kind("", True)
        raise Unsupported(f"values of kind {kind}")

    def _filters(self, m: bytes) -> list[tuple[int, tuple[int, ...]]]:
        out, k = [], 8 if m[0] == 1 else 2
        for _ in range(m[1]):
            number, named = self._number(m, k, 2), m[0] == 1 or self._number(m, k, 2) >= 256
            length = self._number(m, k + 2, 2) if named else 0
            k += 4 if named else 2
            count = self._number(m, k + 2, 2)
            k += 4 + length
            out.append((number, struct.unpack(f"<{count}I", m[k : k + 4 * count])))
            k += 4 * count + (4 if m[0] == 1 and count % 2 else 0)
        return out


def _unpacked(data: bytes, table: Table, left_out: int) -> bytes:
    """A stored piece before its filters."""
    for k, (number, values) in reversed(list(enumerate(table.filters))):
        if left_out >> k & 1:
            continue
        if number == DEFLATE:
            data = zlib.decompress(data)
        elif number == SHUFFLE:
            width = values[0] if values else table.kind.size
            whole = len(data) // width * width
            data = np.frombuffer(data[:whole], np.uint8).reshape(width, -1).T.tobytes() + data[whole:]
        elif number == CHECKSUM:
            data = data[:-4]
        else:
            raise Unsupported(f"filter {number}")
    return data


def rows(read: Read, table: Table, first: int, last: int, offset_size: int = 8) -> np.ndarray:
    """The rows from first to last of a table; what was never stored is zero. Texts are objects."""
    kind = np.dtype("V16") if table.kind.texts else np.dtype(table.kind.dtype)
    out = np.zeros((max(0, last - first), *table.shape[1:]), kind)
    if table.inline is not None:
        out[:] = np.frombuffer(table.inline, kind).reshape(table.shape)[first:last]
    elif table.piece == table.shape and not table.filters and table.pieces:  # as they are, in order: only these rows are read
        each = int(np.prod(table.shape[1:], dtype=np.int64)) * kind.itemsize
        out[:] = np.frombuffer(read(table.pieces[0][1] + first * each, len(out) * each), kind).reshape(out.shape)
    else:
        for offset, at, size, left_out in table.rows(first, last).pieces:
            data = _unpacked(read(at, size), table, left_out)
            piece = np.frombuffer(data, kind, int(np.prod(table.piece))).reshape(table.piece)
            low = (max(offset[0], first), *offset[1:])
            high = tuple(min(o + p, s) for o, p, s in zip(offset, table.piece, (last, *table.shape[1:]), strict=True))
            source = tuple(slice(a - o, b - o) for a, b, o in zip(low, high, offset, strict=True))
            target = (slice(low[0] - first, high[0] - first), *(slice(a, b) for a, b in zip(low[1:], high[1:], strict=True)))
            out[target] = piece[source]
    return _texts(read, out, offset_size) if table.kind.texts else out


def _texts(read: Read, pointers: np.ndarray, offset_size: int) -> np.ndarray:
    """Texts of any length, from the heaps that their pointers (length, heap, number) lead to; each heap is read once."""
    heaps: dict[int, dict[int, bytes]] = {}
    out = np.empty(pointers.shape, object)
    for place in np.ndindex(pointers.shape):
        raw = pointers[place].tobytes()
        length, at, number = int.from_bytes(raw[:4], "little"), int.from_bytes(raw[4 : 4 + offset_size], "little"), int.from_bytes(raw[4 + offset_size : 8 + offset_size], "little")
        if not length or not at:
            out[place] = b""
            continue
        if at not in heaps:
            size = int.from_bytes(read(at + 8, 8), "little")
            body, k, found = read(at, size), 16, {}
            while k + 16 <= size and (own := int.from_bytes(body[k : k + 2], "little")):
                n = int.from_bytes(body[k + 8 : k + 16], "little")
                found[own] = body[k + 16 : k + 16 + n]
                k += 16 + -(-n // 8) * 8
            heaps[at] = found
        out[place] = heaps[at][number][:length]
    return out
