"""Reading of HDF5 files, the container of NetCDF-4, after the published file format (version 3 of its specification).

Only what tables need is read, and only the bytes that it lies in: headers, groups, attributes, and of a one-dimensional
dataset those chunks that hold the rows asked for. Both generations of structures are known: symbol tables and link
messages, compact or in a fractal heap; object headers of versions 1 and 2; contiguous, compact and chunked layouts with
the filters shuffle, deflate and checksum. Newer chunk indexes than the first B-tree, compound types and external or
virtual storage are told apart and refused.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

import numpy as np

SIGNATURE = b"\x89HDF\r\n\x1a\n"
# Fixed values of the format: kinds of messages in an object's header, and filters.
_SPACE, _LINK_INFO, _TYPE, _FILL, _LINK, _LAYOUT, _FILTERS, _ATTRIBUTE, _MORE, _SYMBOLS, _ATTRIBUTE_INFO = 0x01, 0x02, 0x03, 0x05, 0x06, 0x08, 0x0B, 0x0C, 0x10, 0x11, 0x15
_DEFLATE, _SHUFFLE, _CHECKSUM = 1, 2, 3


class Unsupported(ValueError):
    """A structure of the format that isn't read."""


class _Bytes:
    """Numbers from bytes, one after another."""

    def __init__(self, data: bytes, wide: tuple[int, int], at: int = 0):
        self.data, self.wide, self.at = data, wide, at

    def number(self, size: int) -> int:
        self.at += size
        return int.from_bytes(self.data[self.at - size : self.at], "little")

    def offset(self) -> int | None:
        """An address; None where it is undefined."""
        x = self.number(self.wide[0])
        return None if x == (1 << 8 * self.wide[0]) - 1 else x

    def length(self) -> int:
        return self.number(self.wide[1])

    def raw(self, size: int) -> bytes:
        self.at += size
        return self.data[self.at - size : self.at]


@dataclass
class Kind:
    """A datatype: one of numpy's, a text of fixed size, or a value of varying length in a global heap."""

    dtype: np.dtype | None
    size: int
    text: bool = False
    varying: bool = False
    base: Kind | None = None


def _kind(b: _Bytes) -> Kind:
    head = b.number(1)
    code, version = head & 15, head >> 4
    bits, size = b.number(3), b.number(4)
    order = ">" if bits & 1 else "<"
    if code == 0:
        b.raw(4)
        return Kind(np.dtype(f"{order}{'i' if bits & 8 else 'u'}{size}"), size)
    if code == 1:
        b.raw(12)
        return Kind(np.dtype(f"{order}f{size}"), size)
    if code == 3:
        return Kind(None, size, text=True)
    if code == 7:
        return Kind(np.dtype(f"<u{size}") if size in (1, 2, 4, 8) else None, size)
    if code == 8:  # an enumeration is stored as its base
        base = _kind(b)
        return Kind(base.dtype, size)
    if code == 9:
        return Kind(None, size, text=bits & 15 == 1, varying=True, base=_kind(b))
    return Kind(None, size)


def _shape(b: _Bytes) -> tuple[int, ...]:
    version, rank, flags = b.number(1), b.number(1), b.number(1)
    b.raw(5 if version == 1 else 1)
    return tuple(b.length() for _ in range(rank))


@dataclass
class Dataset:
    """A dataset of a file: its type and shape, and rows() of it if it has one dimension."""

    name: str
    address: int
    shape: tuple[int, ...]
    kind: Kind
    attrs: dict[str, Any]
    chunk: int | None = None
    references: list[int] = field(default_factory=list)  # addresses of the datasets that its dimensions are scales of
    rows: Callable[[int, int], np.ndarray] | None = None


class File:
    """An open file; read(offset, size) gives its bytes."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read, self.heaps = read, {}
        at = 0
        while (head := read(at, 64 + 96))[:8] != SIGNATURE:
            if len(head) < 8:
                raise ValueError("not an HDF5 file")
            at = 2 * at or 512
        version = head[8]
        if version > 3:
            raise Unsupported(f"superblock {version}")
        self.wide = (head[13], head[14]) if version < 2 else (head[9], head[10])
        b = _Bytes(head, self.wide, (24 if version == 0 else 28) if version < 2 else 12)
        self.base = b.offset() or 0
        b.raw(2 * self.wide[0])
        if version < 2:
            b.raw(2 * self.wide[0])  # the driver's block, and the root's name
        self.root = b.offset()

    def at(self, address: int, size: int) -> _Bytes:
        return _Bytes(self.read(self.base + address, size), self.wide)

    # object headers

    def messages(self, address: int) -> list[tuple[int, _Bytes]]:
        """The messages of an object's header: (kind, body)."""
        head = self.at(address, 64)
        out: list[tuple[int, _Bytes]] = []
        if head.data[:4] == b"OHDR":
            head.raw(5)
            flags = head.number(1)
            head.raw((16 if flags & 32 else 0) + (4 if flags & 16 else 0))
            size = head.number(1 << (flags & 3))
            todo, prefix, tail = [(address + head.at, size)], 0, 0
            first = True
            while todo:
                where, n = todo.pop(0)
                b = self.at(where, n)
                end = n if first else n - 4
                if not first:
                    b.raw(4)
                while b.at + 4 <= end:
                    kind, length, marks = b.number(1), b.number(2), b.number(1)
                    if flags & 4:
                        b.raw(2)
                    self._message(out, todo, kind, marks, b.raw(length))
                first = False
            return out
        if head.number(1) != 1:
            raise Unsupported("object header")
        head.raw(1)
        count = head.number(2)
        head.raw(4)
        todo = [(address + 16, head.number(4))]
        seen = 0
        while todo and seen < count:
            where, n = todo.pop(0)
            b = self.at(where, n)
            while b.at + 8 <= n and seen < count:
                kind, length, marks = b.number(2), b.number(2), b.number(1)
                b.raw(3)
                seen += 1
                self._message(out, todo, kind, marks, b.raw(length))
        return out

    def _message(self, out: list, todo: list, kind: int, marks: int, body: bytes) -> None:
        b = _Bytes(body, self.wide)
        if kind == _MORE:
            todo.append((b.offset(), b.length()))
        elif marks & 2 and kind == _TYPE:  # a type that other objects share lies in a header of its own
            b.raw(7 if b.number(1) == 1 else 1)
            out += [m for m in self.messages(b.offset()) if m[0] == kind]
        else:
            out.append((kind, b))

    # groups

    def links(self, address: int) -> dict[str, int]:
        """Names in a group and the addresses of their objects."""
        out: dict[str, int] = {}
        for kind, b in self.messages(address):
            if kind == _LINK:
                self._link(out, b)
            elif kind == _SYMBOLS:
                tree, heap = b.offset(), self.at(b.offset(), 8 + 2 * self.wide[1] + self.wide[0])
                heap.raw(8)
                size = heap.length()
                heap.raw(self.wide[1])
                names = self.read(self.base + heap.offset(), size)
                self._symbols(out, tree, names)
            elif kind == _LINK_INFO:
                b.raw(1)
                b.raw(8 if b.number(1) & 1 else 0)
                heap, index = b.offset(), b.offset()
                if heap is not None and index is not None:
                    objects = _FractalHeap(self, heap)
                    for record in self._records(index):
                        self._link(out, _Bytes(objects.get(record[4:]), self.wide))
        return out

    def _link(self, out: dict[str, int], b: _Bytes) -> None:
        b.raw(1)
        flags = b.number(1)
        hard = b.number(1) == 0 if flags & 8 else True
        b.raw((8 if flags & 4 else 0) + (1 if flags & 16 else 0))
        name = b.raw(b.number(1 << (flags & 3))).decode()
        if hard:
            out[name] = b.offset()

    def _symbols(self, out: dict[str, int], address: int, names: bytes) -> None:
        head = self.at(address, 8 + 2 * self.wide[0])
        if head.data[:4] == b"SNOD":
            head.raw(6)
            n = head.number(2)
            b = self.at(address + 8, n * (2 * self.wide[0] + 24))
            for _ in range(n):
                name, where = b.number(self.wide[0]), b.offset()
                b.raw(24)
                out[names[name : names.index(b"\0", name)].decode()] = where
            return
        head.raw(6)
        n = head.number(2)
        b = self.at(address + 8 + 2 * self.wide[0], n * sum(self.wide) + self.wide[1])
        for _ in range(n):
            b.length()
            self._symbols(out, b.offset(), names)

    def _records(self, address: int) -> list[bytes]:
        """The records of a version 2 B-tree, in its order."""
        b = self.at(address, 22 + sum(self.wide))
        if b.raw(4) != b"BTHD":
            raise Unsupported("B-tree")
        b.raw(2)
        node, record, depth = b.number(4), b.number(2), b.number(2)
        b.raw(2)
        root, n = b.offset(), b.number(2)
        if root is None:
            return []
        # how many bytes the numbers of records take, from how many records a node of each level can have
        width = lambda x: max(1, (x.bit_length() + 7) // 8)
        most = [(node - 10) // record]
        total, sizes = [most[0]], [(0, 0)]
        for level in range(1, depth + 1):
            a, c = width(most[0]), width(total[level - 1]) if level > 1 else 0
            sizes.append((a, c))
            most.append((node - 10 - self.wide[0] - a - c) // (record + self.wide[0] + a + c))
            total.append((most[level] + 1) * total[level - 1] + most[level])

        def walk(at: int, count: int, level: int) -> list[bytes]:
            b = self.at(at, node)
            b.raw(6)
            own = [b.raw(record) for _ in range(count)]
            if not level:
                return own
            out: list[bytes] = []
            for i in range(count + 1):
                child, below = b.offset(), b.number(sizes[level][0])
                b.raw(sizes[level][1])
                out += walk(child, below, level - 1) + own[i : i + 1]
            return out

        return walk(root, n, depth)

    # attributes

    def _attribute(self, b: _Bytes) -> tuple[str, Any]:
        version, flags = b.number(1), b.number(1)
        sizes = [b.number(2) for _ in range(3)]
        if version == 3:
            b.raw(1)
        padded = lambda n: n + (-n % 8 if version == 1 else 0)
        name = b.raw(padded(sizes[0]))[: sizes[0]].split(b"\0")[0].decode()
        kind_bytes = _Bytes(b.raw(padded(sizes[1])), self.wide)
        if flags & 1:
            kind_bytes.at = 2 if kind_bytes.data[0] != 1 else 8
            kind_bytes = next(m for k, m in self.messages(kind_bytes.offset()) if k == _TYPE)
        kind = _kind(kind_bytes)
        space = b.raw(padded(sizes[2]))
        shape = _shape(_Bytes(space, self.wide)) if space and not (space[0] == 2 and space[3] == 2) else (0,)
        n = int(np.prod(shape, dtype=int))
        raw = b.raw(n * kind.size)
        if kind.varying:
            values = [self._global(raw[i * kind.size : (i + 1) * kind.size]) for i in range(n)]
            values = [v.decode("utf-8", "replace") if kind.text else v for v in values]
        elif kind.text:
            values = [raw[i * kind.size : (i + 1) * kind.size].split(b"\0")[0].decode("utf-8", "replace") for i in range(n)]
        elif kind.dtype is not None:
            values = np.frombuffer(raw, kind.dtype).tolist()
        else:
            return name, None
        return name, values[0] if len(values) == 1 and not (kind.varying and not kind.text) else values

    def _global(self, reference: bytes) -> bytes:
        """A value of varying length from its global heap."""
        b = _Bytes(reference, self.wide)
        b.raw(4)
        where, number = b.offset(), b.number(4)
        if not where:
            return b""
        if where not in self.heaps:
            head = self.at(where, 8 + self.wide[1])
            head.raw(8)
            data = self.at(where, head.length())
            data.raw(8 + self.wide[1])
            found = {}
            while data.at + 8 + self.wide[1] <= len(data.data):
                index = data.number(2)
                data.raw(6)
                size = data.length()
                if not index:
                    break
                found[index] = data.raw(size)
                data.raw(-size % 8)
            self.heaps[where] = found
        return self.heaps[where].get(number, b"")

    def attributes(self, messages: list[tuple[int, _Bytes]]) -> dict[str, Any]:
        out = dict(self._attribute(b) for k, b in messages if k == _ATTRIBUTE)
        for kind, b in messages:
            if kind == _ATTRIBUTE_INFO:
                b.raw(1)
                b.raw(2 if b.number(1) & 1 else 0)
                heap, index = b.offset(), b.offset()
                if heap is not None and index is not None:
                    objects = _FractalHeap(self, heap)
                    out |= dict(self._attribute(_Bytes(objects.get(r), self.wide)) for r in self._records(index))
        return out

    # datasets

    def dataset(self, name: str, address: int) -> Dataset | None:
        """A dataset by its header; None for anything else, as a group."""
        messages = self.messages(address)
        parts = {k: b for k, b in messages if k in (_SPACE, _TYPE, _LAYOUT, _FILTERS, _FILL)}
        if not {_SPACE, _TYPE, _LAYOUT} <= parts.keys():
            return None
        kind, shape = _kind(parts[_TYPE]), _shape(parts[_SPACE])
        attrs = self.attributes(messages)
        scales = attrs.pop("DIMENSION_LIST", None) or []
        references = [int.from_bytes(v[: self.wide[0]], "little") for v in scales]
        out = Dataset(name, address, shape, kind, attrs, references=references)
        if len(shape) == 1 and kind.dtype is not None:
            self._storage(out, parts)
        return out

    def _storage(self, d: Dataset, parts: dict[int, _Bytes]) -> None:
        dtype, n, b = d.kind.dtype, d.shape[0], parts[_LAYOUT]
        fill = np.zeros(1, dtype)
        if (f := parts.get(_FILL)) is not None:
            version = f.number(1)
            given = bool(f.number(1) & 32) if version == 3 else (f.raw(2) and f.number(1) == 1)
            if given and f.number(4) == dtype.itemsize:
                fill = np.frombuffer(f.raw(dtype.itemsize), dtype)
        version = b.number(1)
        if version in (1, 2):
            rank, layout = b.number(1), b.number(1)
            b.raw(5)
            where = b.offset() if layout else None
            lengths = [b.number(4) for _ in range(rank)]
            data = b.raw(b.number(4)) if layout == 0 else b""
            chunk = lengths[0] if layout == 2 else n
        elif version == 3 or (version == 4 and b.data[1] < 2):
            layout = b.number(1)
            data, where, chunk = b"", None, n
            if layout == 0:
                data = b.raw(b.number(2))
            elif layout == 1:
                where = b.offset()
            elif layout == 2:
                b.raw(1)
                where, chunk = b.offset(), b.number(4)
            else:
                raise Unsupported(f"layout {layout} of {d.name}")
        else:
            raise Unsupported(f"chunk index of {d.name}; write the file with the library's earlier format")
        if layout == 2:
            d.chunk = chunk
            filters = self._filters(parts.get(_FILTERS))
            index: list[tuple[int, int, int, int]] = []

            def rows(a: int, z: int) -> np.ndarray:
                if not index and where is not None:
                    index.extend(sorted(self._chunks(where, 1)))
                out = np.repeat(fill, z - a)
                for first, at, size, mask in index:
                    if first < z and first + chunk > a:
                        values = np.frombuffer(_unfilter(self.read(self.base + at, size), filters, mask, dtype.itemsize), dtype)
                        lo, hi = max(a, first), min(z, first + chunk)
                        out[lo - a : hi - a] = values[lo - first : hi - first]
                return out
        elif layout == 0:

            def rows(a: int, z: int) -> np.ndarray:
                return np.frombuffer(data, dtype)[a:z]
        else:

            def rows(a: int, z: int) -> np.ndarray:
                return np.repeat(fill, z - a) if where is None else np.frombuffer(self.read(self.base + where + a * dtype.itemsize, (z - a) * dtype.itemsize), dtype)

        d.rows = rows

    def _chunks(self, address: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(first row, address, stored size, filters left out) of each chunk, from the version 1 B-tree."""
        head = self.at(address, 8 + 2 * self.wide[0])
        if head.raw(4) != b"TREE":
            raise Unsupported("chunk index")
        head.raw(1)
        level, n = head.number(1), head.number(2)
        key = 8 + 8 * (rank + 1)
        b = self.at(address + 8 + 2 * self.wide[0], n * (key + self.wide[0]) + key)
        out = []
        for _ in range(n):
            size, mask, first = b.number(4), b.number(4), b.number(8)
            b.raw(8 * rank)
            child = b.offset()
            out += self._chunks(child, rank) if level else [(first, child, size, mask)]
        return out

    def _filters(self, b: _Bytes | None) -> list[int]:
        if b is None:
            return []
        version, n = b.number(1), b.number(1)
        b.raw(6 if version == 1 else 0)
        out = []
        for _ in range(n):
            code = b.number(2)
            name = b.number(2) if version == 1 or code >= 256 else 0
            b.raw(2)
            values = b.number(2)
            b.raw(name + (-name % 8 if version == 1 else 0) + 4 * values + (4 * (values % 2) if version == 1 else 0))
            if code not in (_DEFLATE, _SHUFFLE, _CHECKSUM):
                raise Unsupported(f"filter {code}")
            out.append(code)
        return out

    def datasets(self) -> dict[str, Dataset]:
        """The datasets of the root group by name."""
        found = ((n, self.dataset(n, a)) for n, a in self.links(self.root).items())
        return {n: d for n, d in found if d is not None}


def _unfilter(data: bytes, filters: list[int], mask: int, size: int) -> bytes:
    for i in reversed(range(len(filters))):
        if mask >> i & 1:
            continue
        if filters[i] == _DEFLATE:
            data = zlib.decompress(data)
        elif filters[i] == _CHECKSUM:
            data = data[:-4]
        else:
            n = len(data) // size
            data = np.frombuffer(data, np.uint8, n * size).reshape(size, n).T.tobytes() + data[n * size :]
    return data


class _FractalHeap:
    """Objects of a fractal heap by their ids."""

    def __init__(self, file: File, address: int):
        self.file = file
        o, n = file.wide
        b = file.at(address, 30 + 12 * n + 3 * o)
        if b.raw(4) != b"FRHP":
            raise Unsupported("heap")
        b.raw(1)
        b.raw(2)
        if b.number(2):
            raise Unsupported("heap with filters")
        b.raw(1)
        biggest = b.number(4)
        b.raw(n + o + n + o + 4 * n + 4 * n)
        self.table, self.start, self.direct, bits = b.number(2), b.length(), b.length(), b.number(2)
        b.raw(2)
        self.root, self.rows = b.offset(), b.number(2)
        self.offset_size = (bits + 7) // 8
        self.length_size = min(((self.direct.bit_length() - 1) + 7) // 8, (biggest.bit_length() - 1) // 8 + 1)
        self.blocks: list[tuple[int, int, int]] = []  # (offset in the heap, size, address)
        if self.root is not None:
            if self.rows:
                self._indirect(self.root, 0, self.rows)
            else:
                self.blocks.append((0, self.start, self.root))

    def _row(self, r: int) -> int:
        return self.start * (1 << max(r - 1, 0))

    def _indirect(self, address: int, begin: int, rows: int) -> None:
        o = self.file.wide[0]
        b = self.file.at(address, 5 + o + self.offset_size + rows * self.table * o)
        if b.raw(4) != b"FHIB":
            raise Unsupported("heap")
        b.raw(1 + o + self.offset_size)
        for r in range(rows):
            size = self._row(r)
            for _ in range(self.table):
                child = b.offset()
                if child is not None:
                    if size <= self.direct:
                        self.blocks.append((begin, size, child))
                    else:
                        self._indirect(child, begin, (size // self.start // self.table).bit_length())
                begin += size

    def get(self, key: bytes) -> bytes:
        b = _Bytes(key, self.file.wide)
        head = b.number(1)
        if head >> 4 & 3 == 2:
            return b.raw((head & 15) + 1)
        if head >> 4 & 3:
            raise Unsupported("huge object")
        offset, length = b.number(self.offset_size), b.number(self.length_size)
        for begin, size, address in self.blocks:
            if begin <= offset < begin + size:
                return self.file.read(self.file.base + address + offset - begin, length)
        raise ValueError("an object lies outside its heap")
