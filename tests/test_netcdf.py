"""NetCDF: the newer format against made files of both generations, the Spark source and sink, raw tables of many files."""

import struct
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import hdf5_writer  # noqa: E402

from fathomline.sources import hdf5, level1, netcdf, netcdf_source  # noqa: E402


def reader(data):
    return lambda offset, size: data[offset : offset + size]


def variables(n=1000, more=0):
    rng = np.random.default_rng(n)
    t = 1.7e9 + np.arange(n) * 2.0
    out = {
        "time": (t, 64, [2, 1], {"units": "seconds since 1970-01-01"}),
        "pressure": (rng.normal(100, 50, n), 100, [2, 1, 3], {"units": "dbar", "_FillValue": np.float64(-999.0), "valid_min": np.float64(0)}),
        "temperature": (rng.normal(10, 2, n).astype("<f4"), 0, [], {}),
        "qc": (rng.integers(-1, 9, n).astype("<i1"), 50, [1], {"_FillValue": np.int8(-1), "long": "x" * 300}),
        "packed": (rng.integers(0, 1000, n).astype(">i2"), 33, [2], {"scale_factor": np.float64(0.01), "add_offset": np.float64(5)}),
        "number": (np.arange(n, dtype="<i4"), "compact" if n < 5000 else 0, [], {f"a{k}": np.int32(k) for k in range(12)}),
        "short": (np.arange(7.0), 0, [], {}),
    }
    out["pressure"][0][5] = -999.0
    out["temperature"][0][6] = np.nan
    return out | {f"sensor_{k:02d}": (rng.normal(size=n), 128, [2, 1], {"k": np.int64(k)}) for k in range(more)}


@pytest.mark.parametrize("make", [hdf5_writer.old, hdf5_writer.new])
@pytest.mark.parametrize("more", [0, 70])
def test_newer_files_hold_what_was_written(make, more):
    given = variables(more=more)
    f = hdf5.File(reader(make(given, {"title": "a title", "year": np.int32(2020)})))
    found = f.datasets()
    assert found.keys() == given.keys()
    for name, (values, chunk, _, attrs) in given.items():
        d = found[name]
        assert d.shape == values.shape and np.array_equal(d.rows(0, len(values)), values, equal_nan=True)
        for a, b in ((0, 1), (min(63, len(values) - 2), min(65, len(values))), (len(values) - 3, len(values)), (2, 2)):
            assert np.array_equal(d.rows(a, b), values[a:b], equal_nan=True)
        assert {k: v for k, v in d.attrs.items() if k in attrs} == {k: v if isinstance(v, str) else v.item() for k, v in attrs.items()}
    assert f.attributes(f.messages(f.root)) == {"title": "a title", "year": 2020}


def test_dimension_scales_tell_dimensions_apart():
    given = variables(200) | {"other": (np.arange(200.0), 0, [], {})}
    h = netcdf.header(reader(hdf5_writer.new(given, scale="time")))
    assert h.main() == "time" and h.sizes["time"] == 200 and h.variables["short"].dims == ("dim_7",)
    assert set(h.columns()) == set(given) - {"short"}
    plain = netcdf.header(reader(hdf5_writer.old(given)))
    assert plain.main() == "dim_200" and set(plain.columns()) == set(given) - {"short"}


def test_values_are_decoded():
    h = netcdf.header(reader(hdf5_writer.new(variables(), scale="time")))
    got = {n: netcdf.decoded(v, v.rows(0, 1000)) for n, v in h.columns().items()}
    given = variables()
    assert got["pressure"].mask.tolist() == [i == 5 for i in range(1000)] and got["temperature"].mask.sum() == 1
    assert (got["qc"].mask == (given["qc"][0] == -1)).all() and np.allclose(got["packed"], given["packed"][0] * 0.01 + 5)


def test_what_is_not_read_is_refused():
    with pytest.raises(ValueError):
        netcdf.header(reader(b"no file"))
    data = hdf5_writer.new({"x": (np.arange(10.0), 5, [1], {})})
    at = data.index(bytes([2, 1]) + struct.pack("<HHH", 1, 0, 1))
    with pytest.raises(hdf5.Unsupported):
        hdf5.File(reader(data[: at + 2] + struct.pack("<H", 32001) + data[at + 4 :])).datasets()


# the Spark source


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("nc")
    for k, make in enumerate((hdf5_writer.old, hdf5_writer.new)):
        (path / f"{k}.nc").write_bytes(make(variables(1000 + k)))
    big = variables(40_000)
    (path / "big").mkdir()
    (path / "big" / "b.nc").write_bytes(hdf5_writer.new(big, scale="time"))
    columns = {n: v for n, (v, *_) in big.items() if n != "short"}
    (path / "big" / "classic").mkdir()
    (path / "big" / "classic" / "b.nc").write_bytes(netcdf.encode(columns, of={n: a for n, (_, _, _, a) in big.items() if n != "number"}))
    return path


def test_source_reads_all_files(spark, folder):
    netcdf_source.register(spark)
    df = spark.read.format("netcdf").option("mergeSchema", True).load(str(folder))
    kinds = dict(df.dtypes)
    assert kinds["time"] == "double" and kinds["temperature"] == "float" and kinds["qc"] == "tinyint" and kinds["packed"] == "double" and kinds["number"] == "int" and "short" not in kinds
    assert df.schema["pressure"].metadata["units"] == "dbar"
    assert [tuple(r) for r in df.groupBy("file").agg(F.count("*"), F.min("i"), F.max("i"), F.count("pressure")).orderBy("file").collect()] == [(f"{folder}/0.nc", 1000, 0, 999, 999), (f"{folder}/1.nc", 1001, 0, 1000, 1000)]
    given = variables(1001)["pressure"][0]
    got = df.where(F.col("file").endswith("1.nc")).orderBy("i").toPandas()["pressure"].to_numpy()
    assert np.isnan(got[5]) and np.array_equal(np.delete(got, 5), np.delete(given, 5))


def test_newer_and_classic_files_give_one_table(spark, folder):
    a, b = (netcdf_source.read_netcdf(spark, f"{folder}/big{x}").drop("file").orderBy("i").toPandas() for x in ("", "/classic"))
    assert len(a) == 40_000 and set(a.columns) == set(b.columns)
    for c in a.columns:
        assert np.allclose(a[c].to_numpy(float), b[c].to_numpy(float), equal_nan=True), c


def taken(source, columns, bounds=None, split=1 << 17):
    """Bytes read for some columns, and the rows."""
    from pyspark.sql import types as T

    r = netcdf_source.NetcdfReader(netcdf_source.files_of(source), T.StructType([T.StructField(c, T.DoubleType()) for c in columns]), split)
    r.bounds = bounds or {}
    total, rows, seen, opened = 0, 0, [], netcdf_source.OpenFile
    pieces = r.partitions()

    class Counting(opened):
        def __init__(self, path):
            super().__init__(path)
            seen.append(self)

    netcdf_source.OpenFile = Counting
    try:
        for p in pieces:
            rows += sum(b.num_rows for b in r.read(p))
    finally:
        netcdf_source.OpenFile = opened
    total = sum(f.taken for f in seen)
    return total, rows, len(pieces)


def test_only_wanted_bytes_are_read(folder, monkeypatch):
    monkeypatch.setattr(netcdf_source, "BATCH", 4096)
    source = f"{folder}/big/b.nc"
    size = Path(source).stat().st_size
    everything, rows, pieces = taken(source, ["time", "pressure", "temperature", "qc", "packed", "number"])
    one, rows_one, pieces_one = taken(source, ["qc"], split=1 << 30)
    assert rows == rows_one == 40_000 and pieces > 5 and pieces_one == 1
    assert one < 0.35 * size < everything
    early, rows_early, _ = taken(source, ["time", "pressure", "temperature"], {"time": (1.7e9 + 100, 1.7e9 + 200)}, split=1 << 30)
    whole, _, _ = taken(source, ["time", "pressure", "temperature"], split=1 << 30)
    assert 51 <= rows_early <= 4096 and early < 0.55 * whole


def test_bounds_reach_the_source(spark, folder):
    df = netcdf_source.read_netcdf(spark, f"{folder}/big", ["time", "pressure", "i"]).where("time >= 1700000100 AND time < 1700000200")
    assert df.count() == 50 and df.agg(F.min("i")).first()[0] == 50
    assert netcdf_source.read_netcdf(spark, f"{folder}/big", ["time", "absent"]).where("absent > 1").count() == 0


# the sink


def test_written_files_come_back(spark, tmp_path):
    rows = [(float(i), None if i % 7 == 0 else i / 3, i % 100 if i % 5 else None, i % 2 == 0, "s") for i in range(5000)]
    df = spark.createDataFrame(rows, "time double, y double, n int, even boolean, s string").withMetadata("y", {"units": "m"}).repartitionByRange(3, "time").sortWithinPartitions("time")
    netcdf_source.write_netcdf(df, f"{tmp_path}/out", {"title": "t", "none": None}, rowsPerFile=1000)
    files = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert len(files) >= 5 and all(n.startswith("part-") for n in files)
    back = netcdf_source.read_netcdf(spark, f"{tmp_path}/out")
    assert back.schema["y"].metadata["units"] == "m" and dict(back.dtypes)["n"] == "int"
    got = sorted(map(tuple, back.select("time", "y", "n", "even").collect()))
    assert got == [(t, y, n, int(e)) for t, y, n, e, _ in rows]
    sizes, attrs, _ = netcdf.parse((tmp_path / "out" / files[0]).read_bytes())
    assert attrs == {"title": "t"} and sizes["time"] <= 1000
    netcdf_source.write_netcdf(df.limit(10), f"{tmp_path}/out", mode="append")
    assert netcdf_source.read_netcdf(spark, f"{tmp_path}/out").count() == 5010
    netcdf_source.write_netcdf(df.limit(10), f"{tmp_path}/out")
    assert netcdf_source.read_netcdf(spark, f"{tmp_path}/out").count() == 10


def test_a_failed_write_leaves_what_was_there(spark, tmp_path):
    netcdf_source.write_netcdf(spark.range(10).select(F.col("id").cast("double").alias("time")), f"{tmp_path}/out")
    before = sorted(p.name for p in (tmp_path / "out").iterdir())
    bad = spark.range(0, 1000, 1, 4).select(F.when(F.col("id") < 900, F.col("id")).otherwise(F.raise_error(F.lit("stop")).cast("bigint")).cast("double").alias("time"))
    with pytest.raises(Exception, match="stop"):
        netcdf_source.write_netcdf(bad, f"{tmp_path}/out")
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == before
    with pytest.raises(Exception, match="only numbers"):
        spark.range(1).select(F.lit("x").alias("s")).write.format("netcdf").mode("append").save(f"{tmp_path}/out")


# raw tables


def test_raw_tables_of_many_files_are_few_scans(spark, tmp_path):
    paths = []
    for k in range(300):
        p = tmp_path / f"a {k:03d}+%20é.sbd.csv"
        head = "x,y" if k % 3 else "y,z,x"
        p.write_text("\n".join([head, *(",".join(str(k * 10 + j) for _ in head.split(",")) for j in range(3))]) + "\n")
        paths.append(str(p))
    (tmp_path / "n.sbd.nc").write_bytes(netcdf.encode({"x": np.array([7.0, np.nan])}))
    spark.createDataFrame([(1.0, 2), (3.0, None)], "x double, w int").coalesce(1).write.parquet(f"{tmp_path}/p.parquet")
    paths += [f"{tmp_path}/n.sbd.nc", f"{tmp_path}/p.parquet"]
    (tmp_path / "empty.sbd.csv").write_text("")
    got = level1.read_raw(spark, [*paths[::-1], f"{tmp_path}/empty.sbd.csv"], "t")
    rows = got.orderBy("file_ord", "i").collect()
    assert len(rows) == 904 and [r.file_ord for r in rows] == [0, 0, 1, 1, *(k for k in range(2, 302) for _ in range(3))]
    assert [(r.x, r.w, r.i) for r in rows[:4]] == [(1.0, 2.0, 0), (3.0, None, 1), (7.0, None, 0), (None, None, 1)]
    assert [r.x for r in rows[4:]] == [float(k * 10 + j) for k in reversed(range(300)) for j in range(3)]
    assert all((r.z is not None) == ((301 - r.file_ord) % 3 == 0) for r in rows[4:])
    plan = got._jdf.queryExecution().analyzed().toString()
    assert plan.count("Union") <= 4 and plan.count("csv") < 12


def test_turbulence_of_several_files(spark, tmp_path):
    for k in range(3):
        (tmp_path / f"q{k}.nc").write_bytes(hdf5_writer.new({n: (np.arange(5.0) + 5 * k, 2, [1], {}) for n in ("time", "e_1", "e_2", "pressure", "other")}, scale="time"))
    got = level1.read_turbulence(spark, f"{tmp_path}/q*.nc")
    assert got.columns == ["time", "e_1", "e_2", "pressure"] and sorted(r.e_1 for r in got.collect()) == [float(i) for i in range(15)]
