"""NetCDF as a Spark source and sink: spark.read.format("netcdf").load(path), df.write.format("netcdf").save(folder).

Reading. The schema is that of the first file's numeric variables over its longest dimension, their attributes going
along as metadata, and the columns `i` (a row's number in its file) and `file`; with the option mergeSchema it is that
of all files. A schema that is given is the list of columns wanted: of other variables not a byte is read, and what a
file lacks is null. Small files share a task; a large one is cut into runs of whole chunks, each read by itself. Bounds
on columns are pushed down: of a run without a row within them nothing but those columns is read.

Writing. Each task writes classic files of at most rowsPerFile rows under hidden names; when all tasks are done they are
renamed, and only then, when overwriting, the old files go. Files of tasks that failed or ran twice are removed. Columns
have to be numbers; their metadata become attributes, the option attrs (JSON) the file's.

Paths are anything that pyarrow's file systems open; a path without a scheme is local to every machine.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema

from . import netcdf

#: Bytes that one task reads, about, and what opening a file counts as.
SPLIT, OPEN_COST = 128 << 20, 4 << 20
#: Rows that are in memory at once, about.
BATCH = 1 << 18
#: Rows of a written file, unless told otherwise.
ROWS_PER_FILE = 1 << 22

_SPARK = {"i1": T.ByteType(), "i2": T.ShortType(), "i4": T.IntegerType(), "i8": T.LongType(), "u1": T.ShortType(), "u2": T.IntegerType(), "u4": T.LongType(), "f4": T.FloatType()}


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def files_of(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the *.nc files of a folder, by name."""
    where, inner = store(path)
    info = where.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    root = path.rstrip("/")
    found = where.get_file_info(fs.FileSelector(inner))
    return sorted((f"{root}/{f.base_name}", f.size) for f in found if f.is_file and f.base_name.endswith(".nc") and not f.base_name.startswith("."))


class OpenFile:
    """A file's header; taken counts the bytes that were read."""

    def __init__(self, path: str):
        where, inner = store(path)
        self.file, self.taken = where.open_input_file(inner), 0
        self.header = netcdf.header(self.read)

    def read(self, offset: int, size: int) -> bytes:
        data = self.file.read_at(size, offset)
        self.taken += len(data)
        return data

    def __enter__(self) -> OpenFile:
        return self

    def __exit__(self, *_) -> None:
        self.file.close()


def fields(header: netcdf.Header) -> list[T.StructField]:
    """The columns of a file, with their variables' attributes."""
    out = []
    for name, v in header.columns().items():
        scaled = {"scale_factor", "add_offset"} & v.attrs.keys()
        kind = T.DoubleType() if scaled else _SPARK.get(f"{v.dtype.kind}{v.dtype.itemsize}", T.DoubleType())
        plain = {k: x for k, x in v.attrs.items() if isinstance(x, (str, int, float)) and x == x and k not in ("scale_factor", "add_offset", "_FillValue", "missing_value")}
        out.append(T.StructField(name, kind, True, plain))
    return out


@dataclass
class Piece(InputPartition):
    """What one task reads: (path, first row, row after the last or None for all)."""

    parts: list[tuple[str, int, int | None]]


class NetcdfSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "netcdf"

    def paths(self) -> list[tuple[str, int]]:
        given = json.loads(self.options["paths"]) if "paths" in self.options else [self.options["path"]]
        out = [f for p in given for f in files_of(p)]
        if not out:
            raise FileNotFoundError(f"no file in {', '.join(given)}")
        return out

    def schema(self) -> T.StructType:
        found: dict[str, T.StructField] = {}
        every = self.options.get("mergeSchema", "false").lower() == "true"
        for path, _ in self.paths() if every else self.paths()[:1]:
            with OpenFile(path) as f:
                for field in fields(f.header):
                    old = found.setdefault(field.name, field)
                    if old.dataType != field.dataType:  # numbers of two kinds are doubles
                        found[field.name] = T.StructField(field.name, T.DoubleType(), True, old.metadata)
        return T.StructType([*(f for n, f in found.items() if n not in ("i", "file")), T.StructField("i", T.LongType()), T.StructField("file", T.StringType())])

    def reader(self, schema: T.StructType) -> NetcdfReader:
        return NetcdfReader(self.paths(), schema, int(self.options.get("splitBytes", SPLIT)))

    def writer(self, schema: T.StructType, overwrite: bool) -> NetcdfWriter:
        return NetcdfWriter(self.options["path"], schema, overwrite, json.loads(self.options.get("attrs", "{}")), self.options.get("dim", "time"), int(self.options.get("rowsPerFile", ROWS_PER_FILE)))


class NetcdfReader(DataSourceReader):
    def __init__(self, paths: list[tuple[str, int]], schema: T.StructType, split: int):
        self.paths, self.schema, self.split = paths, schema, split
        self.bounds: dict[str, tuple[float, float]] = {}

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        names = {f.name for f in self.schema if isinstance(f.dataType, T.NumericType)} - {"i"}
        for f in filters:
            low, high = -np.inf, np.inf
            if isinstance(f, (GreaterThan, GreaterThanOrEqual, EqualTo)):
                low = f.value
            if isinstance(f, (LessThan, LessThanOrEqual, EqualTo)):
                high = f.value
            column = getattr(f, "attribute", (None,))
            if len(column) == 1 and column[0] in names and (low, high) != (-np.inf, np.inf):
                a, b = self.bounds.get(column[0], (-np.inf, np.inf))
                self.bounds[column[0]] = (max(a, float(low)), min(b, float(high)))
            yield f  # rows are filtered again, as a run is left out whole or not at all

    def partitions(self) -> list[Piece]:
        out: list[Piece] = []
        shared: list[tuple[str, int, int | None]] = []
        room = self.split
        for path, size in self.paths:
            if size > self.split:
                out += self._runs(path)
                continue
            if shared and room < size + OPEN_COST:
                out.append(Piece(shared))
                shared, room = [], self.split
            shared.append((path, 0, None))
            room -= size + OPEN_COST
        return out + [Piece(shared)] if shared else out

    def _runs(self, path: str) -> list[Piece]:
        with OpenFile(path) as f:
            columns = f.header.columns()
            used = [columns[c.name] for c in self.schema if c.name in columns]
            n = f.header.sizes.get(f.header.main(), 0)
        step = _step(used, max(1, self.split // max(1, sum(v.dtype.itemsize for v in used))))
        return [Piece([(path, a, min(n, a + step))]) for a in range(0, n, step)]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(self.schema)
        for path, first, last in partition.parts:
            with OpenFile(path) as f:
                yield from self._rows(f, path, first, last, kinds)

    def _rows(self, f: OpenFile, path: str, first: int, last: int | None, kinds: pa.Schema) -> Iterator[pa.RecordBatch]:
        columns = f.header.columns()
        used = {c.name: columns[c.name] for c in self.schema if c.name in columns and c.name not in ("i", "file")}
        n = f.header.sizes.get(f.header.main(), 0)
        last = n if last is None else last
        bounds = {c: b for c, b in self.bounds.items() if c in used}
        if self.bounds.keys() - bounds.keys() - {"i"}:
            return  # a bounded column that a file lacks is null, and so within no bounds
        step = _step(list(used.values()), BATCH)
        for a in range(first, last, step):
            b = min(a + step, last)
            got = {c: netcdf.decoded(used[c], used[c].rows(a, b)) for c in bounds}
            within = np.ones(b - a, bool)
            for c, (low, high) in bounds.items():
                within &= np.ma.filled((got[c] >= low) & (got[c] <= high), False)
            if bounds and not within.any():
                continue
            arrays = []
            for kind in kinds:
                if kind.name == "i":
                    arrays.append(pa.array(np.arange(a, b), pa.int64()).cast(kind.type))
                elif kind.name == "file":
                    arrays.append(pa.array([path] * (b - a), kind.type))
                elif kind.name in used:
                    v = used[kind.name]
                    x = got[kind.name] if kind.name in got else netcdf.decoded(v, v.rows(a, b))
                    arrays.append(pa.array(x.data, mask=np.ma.getmaskarray(x)).cast(kind.type))
                else:
                    arrays.append(pa.nulls(b - a, kind.type))
            yield pa.RecordBatch.from_arrays(arrays, schema=kinds)


def _step(variables: list[netcdf.Variable], about: int) -> int:
    """Rows of about so many that end where chunks do."""
    chunk = max((v.chunk or 1 for v in variables), default=1)
    return max(1, about // chunk) * chunk


@dataclass
class Written(WriterCommitMessage):
    """Files that a task wrote, under their hidden names."""

    names: list[str]
    rows: int


class NetcdfWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema: T.StructType, overwrite: bool, attrs: dict, dim: str, rows: int):
        for f in schema:
            if not isinstance(f.dataType, (T.NumericType, T.BooleanType)) or isinstance(f.dataType, T.DecimalType):
                raise ValueError(f"{f.name} is of the type {f.dataType.simpleString()}; only numbers are written")
        self.path, self.overwrite, self.attrs, self.dim, self.rows = path.rstrip("/"), overwrite, attrs, dim, rows
        self.given = {f.name: {k: v for k, v in (f.metadata or {}).items() if isinstance(v, (str, int, float))} for f in schema}
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        where, folder = store(self.path)
        where.create_dir(folder, recursive=True)
        task, names, total = uuid.uuid4().hex, [], 0
        held, n = [], 0

        def put() -> None:
            nonlocal held, n
            if n:
                name = f".{self.job}-{task}-{len(names):05d}.nc"
                with where.open_output_stream(f"{folder}/{name}") as out:
                    out.write(self.encoded(pa.Table.from_batches(held)))
                names.append(name)
            held, n = [], 0

        for batch in iterator:
            total += batch.num_rows
            while batch.num_rows:
                part = batch.slice(0, self.rows - n)
                held.append(part)
                n += part.num_rows
                batch = batch.slice(part.num_rows)
                if n == self.rows:
                    put()
        put()
        return Written(names, total)

    def encoded(self, table: pa.Table) -> bytes:
        columns, attrs = {}, {}
        for name in table.column_names:
            column = table.column(name)
            attrs[name] = dict(self.given[name])
            if pa.types.is_boolean(column.type):
                column = column.cast(pa.int8())
            if pa.types.is_floating(column.type) or column.type == pa.int64():
                columns[name] = column.to_numpy().astype(np.float32 if column.type == pa.float32() else float)
                attrs[name]["_FillValue"] = columns[name].dtype.type(np.nan)
            else:
                kind = column.type.to_pandas_dtype()
                fill = kind(np.iinfo(kind).min)
                attrs[name]["_FillValue"] = fill
                columns[name] = column.fill_null(int(fill)).to_numpy().astype(kind)
        return netcdf.encode(columns, self.attrs, self.dim, attrs)

    def _listed(self, hidden: bool) -> list[str]:
        where, folder = store(self.path)
        found = where.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        return [f.base_name for f in found if f.is_file and f.base_name.endswith(".nc") and f.base_name.startswith(f".{self.job}" if hidden else "") and (hidden or not f.base_name.startswith("."))]

    def commit(self, messages: list[Written | None]) -> None:
        where, folder = store(self.path)
        where.create_dir(folder, recursive=True)
        old = self._listed(False) if self.overwrite else []
        names = [n for m in messages if m for n in m.names]
        for k, name in enumerate(names):
            where.move(f"{folder}/{name}", f"{folder}/part-{k:05d}-{self.job}.nc")
        for name in old + self._listed(True):
            where.delete_file(f"{folder}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        where, folder = store(self.path)
        for name in self._listed(True):
            where.delete_file(f"{folder}/{name}")


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(NetcdfSource)


def read_netcdf(spark: SparkSession, paths: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """One table of files or folders; columns are read as doubles, and no others."""
    register(spark)
    reader = spark.read.format("netcdf").option("paths", json.dumps([paths] if isinstance(paths, str) else paths))
    if columns is None:
        return reader.option("mergeSchema", True).load()
    kinds = {"i": T.LongType(), "file": T.StringType()}
    return reader.schema(T.StructType([T.StructField(c, kinds.get(c, T.DoubleType())) for c in columns])).load()


def write_netcdf(df: DataFrame, path: str, attrs: dict | None = None, dim: str = "time", mode: str = "overwrite", **options) -> None:
    """The numeric columns as classic files in a folder; each task's rows in their order."""
    register(df.sparkSession)
    numbers = [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and not isinstance(f.dataType, T.DecimalType)]
    plain = {k: v for k, v in (attrs or {}).items() if isinstance(v, (str, int, float))}
    df.select(*numbers).write.format("netcdf").mode(mode).options(attrs=json.dumps(plain), dim=dim, **options).save(path)
