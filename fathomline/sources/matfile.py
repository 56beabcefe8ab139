"""MATLAB version 5 files of structures of columns, written after the published format."""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame

from .netcdf import put_bytes

# Fixed values of the format: data types and array classes.
_INT8, _INT32, _UINT32, _DOUBLE, _MATRIX, _STRUCT, _FULL = 1, 5, 6, 9, 14, 2, 6


def _element(kind: int, raw: bytes) -> bytes:
    return struct.pack("<II", kind, len(raw)) + raw + b"\0" * (-len(raw) % 8)


def _matrix(name: str, kind: int, shape: tuple[int, int], body: bytes) -> bytes:
    head = _element(_UINT32, struct.pack("<II", kind, 0)) + _element(_INT32, struct.pack("<ii", *shape)) + _element(_INT8, name.encode())
    return _element(_MATRIX, head + body)


def encode(structures: dict[str, dict[str, np.ndarray]]) -> bytes:
    """A file with a structure for each name, of column vectors."""
    out = b"MATLAB 5.0 MAT-file".ljust(124) + struct.pack("<H", 0x0100) + b"IM"
    for name, fields in structures.items():
        width = max(map(len, fields)) + 1
        names = b"".join(f.encode().ljust(width, b"\0") for f in fields)
        body = struct.pack("<HHI", _INT32, 4, width) + _element(_INT8, names)
        for values in fields.values():
            v = np.asarray(values, "<f8")
            body += _matrix("", _FULL, (len(v), 1), _element(_DOUBLE, v.tobytes()))
        out += _matrix(name, _STRUCT, (1, 1), body)
    return out


def write_channels(channels: DataFrame, path: str) -> None:
    """A table (channel, time, data) as structures {time, data}; it comes to the driver, so for one deployment."""
    pdf = channels.orderBy("channel", "time").toPandas()
    put_bytes(channels.sparkSession, path, encode({str(c): {"time": g["time"].to_numpy(float), "data": g["data"].to_numpy(float)} for c, g in pdf.groupby("channel", sort=True)}))
