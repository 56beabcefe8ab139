"""A small generator of HDF5 files for tests, after the published format: both generations of its structures.

It shares no code with the reader. old(): superblock 0, symbol tables, headers of version 1, messages padded to 8 bytes.
new(): superblock 2, headers of version 2 with checksums left zero, links and attributes compact or, if they are many, in
fractal heaps with B-trees of version 2; dimension scales by references in a global heap, as NetCDF-4 has them.
"""

import struct
import zlib

import numpy as np

UNDEFINED = (1 << 64) - 1


def pad8(b):
    return b + b"\0" * (-len(b) % 8)


def datatype(kind):
    if kind == "references":
        return bytes([0x19]) + b"\0\0\0" + struct.pack("<I", 16) + bytes([0x17]) + b"\0\0\0" + struct.pack("<I", 8)
    if isinstance(kind, int):
        return bytes([0x13]) + b"\0\0\0" + struct.pack("<I", kind)
    order = 1 if kind.byteorder == ">" else 0
    if kind.kind in "iu":
        return bytes([0x10, order | (8 if kind.kind == "i" else 0), 0, 0]) + struct.pack("<IHH", kind.itemsize, 0, 8 * kind.itemsize)
    exp, mant, bias = (8, 23, 127) if kind.itemsize == 4 else (11, 52, 1023)
    return bytes([0x11, 0x20 | order, 8 * kind.itemsize - 1, 0]) + struct.pack("<IHHBBBBI", kind.itemsize, 0, 8 * kind.itemsize, mant, exp, 0, mant, bias)


def space(shape, version):
    head = bytes([1, len(shape), 0]) + b"\0" * 5 if version == 1 else bytes([2, len(shape), 0, 1 if shape else 0])
    return head + b"".join(struct.pack("<Q", n) for n in shape)


class Out:
    def __init__(self, size):
        self.data = bytearray(size)

    def put(self, b):
        self.data += b"\0" * (-len(self.data) % 8)
        at = len(self.data)
        self.data += b
        return at

    # values

    def attribute(self, name, value, version):
        name = name.encode() + b"\0"
        if isinstance(value, list):  # references to datasets, each in a value of varying length
            body = b"".join(pad8(struct.pack("<HHIQ", i + 1, 1, 0, 8) + struct.pack("<Q", a)) for i, a in enumerate(value))
            heap = self.put(b"GCOL" + bytes([1, 0, 0, 0]) + struct.pack("<Q", 16 + len(body) + 16) + body + b"\0" * 16)
            kind, shape, raw = datatype("references"), (len(value),), b"".join(struct.pack("<IQI", 1, heap, i + 1) for i in range(len(value)))
        elif isinstance(value, str):
            raw = value.encode() + b"\0"
            kind, shape = datatype(len(raw)), ()
        else:
            value = np.asarray(value)
            kind, shape, raw = datatype(value.dtype), value.shape, value.tobytes()
        sp = space(shape, 1 if version == 1 else 2)
        head = bytes([version, 0]) + struct.pack("<HHH", len(name), len(kind), len(sp)) + (b"\0" if version == 3 else b"")
        fit = pad8 if version == 1 else bytes
        return head + fit(name) + fit(kind) + fit(sp) + raw

    def storage(self, values, chunk, filters):
        """The layout message of a dataset, whose values are put."""
        if chunk == "compact":
            return bytes([3, 0]) + struct.pack("<H", values.nbytes) + values.tobytes()
        if not chunk:
            return bytes([3, 1]) + struct.pack("<QQ", self.put(values.tobytes()), values.nbytes)
        size, leaves = values.dtype.itemsize, []
        for a in range(0, len(values), chunk):
            block = np.zeros(chunk, values.dtype)
            block[: len(values[a : a + chunk])] = values[a : a + chunk]
            raw, mask = block.tobytes(), 0
            for i, f in enumerate(filters):
                if f == 2:
                    raw = np.frombuffer(raw, np.uint8).reshape(-1, size).T.tobytes()
                elif f == 1:
                    packed = zlib.compress(raw)
                    raw, mask = (packed, mask) if a % (3 * chunk) else (raw, mask | 1 << i)  # some chunks aren't compressed
                else:
                    raw += b"sums"
            leaves.append((len(raw), mask, a, self.put(raw)))

        def node(level, entries, end):
            body = b"".join(struct.pack("<IIQQQ", n, m, a, 0, at) for n, m, a, at in entries) + struct.pack("<IIQQ", 0, 0, end, 0)
            return self.put(b"TREE" + bytes([1, level]) + struct.pack("<HQQ", len(entries), UNDEFINED, UNDEFINED) + body)

        level = 0
        while len(leaves) > 4 or not level:
            leaves = [(*g[0][:3], node(level, g, len(values))) for g in (leaves[i : i + 4] for i in range(0, len(leaves), 4))]
            level += 1
        top = leaves[0][3] if len(leaves) == 1 else node(level, leaves, len(values))
        return bytes([3, 2, 2]) + struct.pack("<QII", top, chunk, size)

    def pipeline(self, filters, version):
        if version == 1:
            return bytes([1, len(filters)]) + b"\0" * 6 + b"".join(struct.pack("<HHHH", f, 8, 0, 1) + b"deflate\0" + struct.pack("<II", 4, 0) for f in filters)
        return bytes([2, len(filters)]) + b"".join(struct.pack("<HHH", f, 0, 1) + struct.pack("<I", 4) for f in filters)

    # object headers

    def header1(self, messages):
        """Version 1, its second half in a continuation."""
        pack = lambda ms: b"".join(struct.pack("<HHBBBB", k, len(pad8(b)), 0, 0, 0, 0) + pad8(b) for k, b in ms)
        half = len(messages) // 2
        rest = pack(messages[half:])
        first = pack([*messages[:half], (0x10, struct.pack("<QQ", self.put(rest), len(rest)))])
        return self.put(struct.pack("<BBHIII", 1, 0, len(messages) + 1, 1, len(first), 0) + first)

    def header2(self, messages):
        """Version 2, with times and creation orders; what is beyond four messages is in a continuation."""
        pack = lambda ms: b"".join(struct.pack("<BHBH", k, len(b), 0, i) + b for i, (k, b) in enumerate(ms))
        if len(messages) > 4:
            rest = b"OCHK" + pack(messages[4:]) + b"\0" * 4
            messages = [*messages[:4], (0x10, struct.pack("<QQ", self.put(rest), len(rest)))]
        body = pack(messages)
        return self.put(b"OHDR" + bytes([2, 0x20 | 0x04 | 0x02]) + b"\0" * 16 + struct.pack("<I", len(body)) + body + b"\0" * 4)

    # many links or attributes

    def heap(self, objects):
        """A fractal heap: its address, and the ids of the objects."""
        start, width = 512, 4
        blocks, ids, begin, row, slot = [], [], 0, 0, 0
        current = bytearray(b"FHDB" + bytes(5 + 8 + 4))
        size = start
        for o in objects:
            while len(current) + len(o) > size:
                blocks.append((begin, size, current))
                begin, slot = begin + size, slot + 1
                row, slot = (row + 1, 0) if slot == width else (row, slot)
                size, current = start * (1 << max(row - 1, 0)), bytearray(b"FHDB" + bytes(5 + 8 + 4))
            ids.append(bytes([0]) + struct.pack("<I", begin + len(current)) + struct.pack("<H", len(o)))
            current += o
        blocks.append((begin, size, current))
        places = [self.put(bytes(c) + b"\0" * (s - len(c))) for _, s, c in blocks]
        if len(blocks) == 1:
            root, rows = places[0], 0
        else:
            rows = row + 1
            places += [UNDEFINED] * (rows * width - len(places))
            root = self.put(b"FHIB" + bytes(1 + 8 + 4) + b"".join(struct.pack("<Q", p) for p in places) + b"\0" * 4)
        q = lambda *x: b"".join(struct.pack("<Q", v) for v in x)
        head = b"FRHP" + struct.pack("<BHHBI", 0, 7, 0, 0, 4096) + q(0, UNDEFINED, 0, UNDEFINED, 0, 0, 0, len(objects), 0, 0, 0, 0)
        return self.put(head + struct.pack("<HQQHHQH", width, start, 65536, 32, 1, root, rows) + b"\0" * 4), ids

    def tree2(self, kind, records, size):
        """A B-tree of version 2 of one or two levels."""
        node = 512
        most = (node - 10) // size
        leaf = lambda rs: self.put((b"BTLF" + bytes([0, kind]) + b"".join(rs)).ljust(node, b"\0"))
        if len(records) <= most:
            root, depth, n = leaf(records), 0, len(records)
        else:
            parts, between = [], []
            rest = list(records)
            while rest:
                parts.append(rest[:most])
                rest = rest[most:]
                if rest:
                    between.append(rest.pop(0))
            if not parts[-1]:
                raise AssertionError
            children = [(leaf(p), len(p)) for p in parts]
            root = self.put((b"BTIN" + bytes([0, kind]) + b"".join(between) + b"".join(struct.pack("<QB", a, n) for a, n in children)).ljust(node, b"\0"))
            depth, n = 1, len(between)
        return self.put(b"BTHD" + bytes([0, kind]) + struct.pack("<IHHBBQHQI", node, size, depth, 100, 40, root, n, len(records), 0))


def old(variables, attrs=None):
    """variables: name -> (values, chunk, filters, attributes)."""
    out = Out(24 + 8 * 4 + 40)
    entries = []
    for name, (values, chunk, filters, given) in sorted(variables.items()):
        ms = [(1, space(values.shape, 1)), (3, datatype(values.dtype)), (5, bytes([2, 2, 0, 0])), (8, out.storage(values, chunk, filters))]
        ms += [(0x0B, out.pipeline(filters, 1))] if filters else []
        ms += [(0x0C, out.attribute(k, v, 1)) for k, v in given.items()]
        entries.append((name, out.header1(ms)))
    names, at = b"\0" * 8, {}
    for name, _ in entries:
        at[name] = len(names)
        names += pad8(name.encode() + b"\0")
    heap = out.put(b"HEAP" + bytes(4) + struct.pack("<QQQ", len(names), UNDEFINED, out.put(names)))
    nodes = []
    for i in range(0, len(entries), 3):
        part = entries[i : i + 3]
        nodes.append((at[part[-1][0]], out.put(b"SNOD" + struct.pack("<BBH", 1, 0, len(part)) + b"".join(struct.pack("<QQII", at[n], a, 0, 0) + b"\0" * 16 for n, a in part))))
    tree = out.put(b"TREE" + bytes([0, 0]) + struct.pack("<HQQ", len(nodes), UNDEFINED, UNDEFINED) + struct.pack("<Q", 0) + b"".join(struct.pack("<QQ", a, k) for k, a in nodes))
    root = out.header1([(0x11, struct.pack("<QQ", tree, heap)), *((0x0C, out.attribute(k, v, 1)) for k, v in (attrs or {}).items())])
    head = b"\x89HDF\r\n\x1a\n" + bytes([0, 0, 0, 0, 0, 8, 8, 0]) + struct.pack("<HHI", 4, 16, 0) + struct.pack("<QQQQ", 0, UNDEFINED, len(out.data), UNDEFINED)
    head += struct.pack("<QQII", 0, root, 0, 0) + b"\0" * 16
    out.data[: len(head)] = head
    return bytes(out.data)


def new(variables, attrs=None, scale=None):
    """As old(); scale is the variable that the others' dimension is: they refer to it."""
    out = Out(48)
    placed = {}
    for name in sorted(variables, key=lambda n: n != scale):
        values, chunk, filters, given = variables[name]
        ms = [(1, space(values.shape, 2)), (3, datatype(values.dtype)), (5, bytes([3, 2])), (8, out.storage(values, chunk, filters))]
        ms += [(0x0B, out.pipeline(filters, 2))] if filters else []
        given = dict(given)
        if name == scale:
            given |= {"CLASS": "DIMENSION_SCALE", "NAME": name}
        elif scale and len(values) == len(variables[scale][0]):
            given["DIMENSION_LIST"] = [placed[scale]]
        bodies = [out.attribute(k, v, 3) for k, v in given.items()]
        if len(bodies) > 8:
            heap, ids = out.heap(bodies)
            tree = out.tree2(8, [b"\0" + i[1:] + b"\0" + bytes(9) for i in ids], 17)
            ms.append((0x15, bytes([0, 0]) + struct.pack("<QQ", heap, tree)))
        else:
            ms += [(0x0C, b) for b in bodies]
        placed[name] = out.header2(ms)
    links = [bytes([1, 0x04]) + struct.pack("<Q", i) + bytes([len(n)]) + n.encode() + struct.pack("<Q", a) for i, (n, a) in enumerate(placed.items())]
    ms = [(0x0C, out.attribute(k, v, 3)) for k, v in (attrs or {}).items()]
    if len(links) > 8:
        heap, ids = out.heap(links)
        ms.append((2, bytes([0, 1]) + struct.pack("<QQQ", len(links), heap, out.tree2(5, [b"hash" + i for i in ids], 11))))
    else:
        ms += [(2, bytes([0, 0]) + struct.pack("<QQ", UNDEFINED, UNDEFINED)), *((6, x) for x in links)]
    root = out.header2(ms)
    head = b"\x89HDF\r\n\x1a\n" + bytes([2, 8, 8, 0]) + struct.pack("<QQQQI", 0, UNDEFINED, len(out.data), root, 0)
    out.data[: len(head)] = head
    return bytes(out.data)
