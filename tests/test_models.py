"""Seawater, flight model, file formats, streams, command line, and all queries against DuckDB."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline import cli
from fathomline.functions import seawater
from fathomline.operators import flight
from fathomline.plans import config as cfg
from fathomline.plans import queries
from fathomline.sources import level1, matfile, netcdf, netcdf_source, sinks
from fathomline.streaming import live

BY = ["trajectory"]


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_practical_salinity_check_values(spark):
    got = one(spark, *(seawater.practical_salinity(F.lit(r * 42.914), F.lit(t / 1.00024), F.lit(p)) for r, t, p in ((1.0, 15.0, 0.0), (1.2, 20.0, 2000.0), (0.65, 5.0, 1500.0))))
    assert all(abs(a - b) < 1e-5 for a, b in zip(got, (35.0, 37.245628, 27.995347)))


def test_potential_temperature_check_values(spark):
    """Published values of UNESCO 1983 (technical paper 44), with the decimals that it prints."""
    rows = [(40.0, 40.0, 10000.0, 36.89073, 1e-5), (25.0, 10.0, 5000.0, 9.3531, 5e-5), (25.0, 10.0, 10000.0, 8.4684, 5e-5), (25.0, 40.0, 10000.0, 36.9254, 5e-5), (35.0, 10.0, 0.0, 10.0, 1e-12)]
    df = spark.createDataFrame([*rows, (25.0, None, 1000.0, None, None)], "s double, t double, p double, want double, near double")
    got = df.select(seawater.potential_temperature(F.col("s"), F.col("t"), F.col("p")).alias("x"), "want", "near").collect()
    assert all(abs(r.x - r.want) <= r.near for r in got[:-1]) and got[-1].x is None


def test_density_and_sound_check_values(spark):
    rows = [(34.7118, 28.8099, 10.0), (35.0256, 22.7862, 125.0), (34.7324, 4.3236, 1000.0)]
    df = spark.createDataFrame(rows, "sa double, ct double, p double")
    c = F.col
    got = df.select(seawater.density(c("sa"), c("ct"), c("p")), seawater.sound_speed(c("sa"), c("ct"), c("p"))).collect()
    assert np.allclose([r[0] for r in got], [1021.839935738108, 1024.427195413316, 1032.002453224572], atol=1e-9)
    # sound speed and density are bound together: c^-2 is the derivative of density by pressure
    up, down = (df.select(seawater.density(c("sa"), c("ct"), c("p") + d)).collect() for d in (0.5, -0.5))
    assert np.allclose([r[1] for r in got], [1 / math.sqrt((a[0] - b[0]) / 1e4) for a, b in zip(up, down)], rtol=1e-5)


def test_conservative_temperature_check_values(spark):
    got = one(spark, *(seawater.conservative_from_potential(F.lit(s), F.lit(t)) for s, t in ((34.7118, 28.7832), (34.8472, 10.2305), (34.7324, 4.3245))))
    assert np.allclose(got, (28.809923015982083, 10.226165605435785, 4.323565182322069), atol=1e-9)


def test_height_and_stability(spark):
    z = one(spark, seawater.height(F.lit(10.0), F.lit(4.0)), seawater.height(F.lit(1000.0), F.lit(4.0)), seawater.height(F.lit(0.0), F.lit(4.0)))
    assert abs(z[0] + 9.9446) < 1e-3 and abs(z[1] + 992.092) < 1e-2 and z[2] == 0
    n = one(spark, seawater.buoyancy_frequency(*(F.lit(x) for x in (35.0, 20.0, 10.0, 35.0, 15.0, 20.0)), F.lit(20.0)), seawater.buoyancy_frequency(*(F.lit(x) for x in (35.0, 20.0, 10.0, 35.0, 15.0, 10.0)), F.lit(20.0)))
    assert 1e-3 < n[0] < 1e-1 and n[1] is None


# flight


def test_parameters():
    p = flight.parameters()
    assert abs(p["Cd1"] - (p["aw"] ** 2 / (math.pi * 0.8 * 7.0) + 9.7)) < 1e-12
    assert flight.parameters({"Cd1": 5.0, "aw": 3.0, "other": 1})["Cd1"] == 5.0
    pitch, a = flight.attack_table(p)
    assert np.abs((p["Cd0"] + p["Cd1"] * a**2) / ((p["ah"] + p["aw"]) * np.tan(a + pitch)) - a).max() < 1e-12


def test_angle_is_odd_and_zero_outside(spark):
    p = flight.parameters()
    got = one(spark, *(flight.attack(F.lit(math.radians(d)), p) for d in (4.9, -4.9, 61.0, 25.0, -25.0)), flight.attack(F.lit(None).cast("double"), p))
    assert got[0] == got[1] == got[2] == 0 and got[3] == -got[4] > 0 and got[5] is None


def test_model_adds_columns_only(spark):
    df = spark.createDataFrame([("a", 1.0, 100.0, 26.0, 300.0, 1025.0, 0.1), ("a", 2.0, None, 26.0, 300.0, 1025.0, 0.1)], "trajectory string, time double, pressure double, pitch double, ballast_pumped double, density double, dzdt double")
    got = flight.apply_model(df, BY).orderBy("time").collect()
    assert got[0].speed_through_water > 0 and abs(got[0].vertical_water_velocity - (0.1 - got[0].vertical_glider_velocity)) < 1e-6
    assert got[1].speed_through_water is None and len(df.columns) == 7


def test_calibration_finds_the_truth_and_wants_rows(spark):
    truth = flight.parameters({"Vg": 0.0675, "Cd0": 0.2})
    fit = flight.fit_parameters(queries.flown(spark, "/root/testdata/sf0.001", truth), BY, fit=("Vg", "Cd0"))
    assert all(abs(fit.params[k] - truth[k]) < 1e-4 * abs(truth[k]) for k in ("Vg", "Cd0"))
    assert fit.at_bound == () and fit.covariance.shape == (2, 2) and (np.diag(fit.covariance) >= 0).all() and fit.rows >= flight.LEAST_ROWS
    # with a truth beyond a bound the fit ends on it, and says so
    beyond = flight.parameters({"Vg": 0.0675, "Cd0": 2.5})
    held = flight.fit_parameters(queries.flown(spark, "/root/testdata/sf0.001", beyond), BY, fit=("Cd0",), params={"Vg": 0.0675})
    assert held.at_bound == ("Cd0",) and abs(held.params["Cd0"] - 2.0) < 1e-4 and np.isnan(held.covariance).all()
    few = spark.createDataFrame([("a", 1.0, 100.0, 26.0, 300.0, 1025.0, 0.1)] * 99, "trajectory string, time double, pressure double, pitch double, ballast_pumped double, density double, dzdt double")
    with pytest.raises(ValueError):
        flight.calibrate(few, BY)
    with pytest.raises(ValueError):
        flight.calibrate(few, BY, fit=("rho0",))


# formats


def test_netcdf_round_trip(spark, tmp_path):
    columns = {"time": np.arange(5.0), "n": np.arange(5, dtype="i4"), "b": np.arange(5, dtype="i1")}
    data = netcdf.encode(columns, {"title": "x", "year": 2020}, of={"time": {"units": "s", "_FillValue": 3.0}})
    sizes, attrs, variables = netcdf.parse(data)
    assert sizes == {"time": 5} and attrs == {"title": "x", "year": 2020.0} and variables["time"][1]["units"] == "s"
    assert all((variables[k][2] == v).all() for k, v in columns.items())
    (tmp_path / "a.sbd.nc").write_bytes(data)
    got = level1.read_raw(spark, f"{tmp_path}/a.sbd.nc").orderBy("i").collect()
    assert [r.time for r in got] == [0.0, 1.0, 2.0, None, 4.0] and [r.n for r in got] == [0.0, 1.0, 2.0, 3.0, 4.0]
    with pytest.raises(ValueError):
        netcdf.parse(b"\x89HDF....")


def test_mat_layout():
    raw = matfile.encode({"ctd_temp": {"time": np.array([1.0, 2.0]), "data": np.array([3.0, 4.0])}})
    assert raw[:10] == b"MATLAB 5.0" and raw[124:128] == b"\x00\x01IM" and len(raw) % 8 == 0
    assert b"ctd_temp" in raw and np.array([3.0, 4.0]).tobytes() in raw
    kind, size = np.frombuffer(raw[128:136], "<u4")
    assert kind == 14 and 136 + size == len(raw)


# streams


def test_streams(spark, tmp_path):
    rows = [("a", 1.7e9 + t, float(t % 7), float(t)) for t in (0, 10, 10, 20, 700, 1400, 1410)]
    spark.createDataFrame(rows, "trajectory string, time double, u double, depth double").write.parquet(f"{tmp_path}/in")
    read = lambda: live.with_event_time(live.read_stream(spark, f"{tmp_path}/in", "trajectory string, time double, u double, depth double"), late="1 hour")
    live.write_idempotent(live.unique_times(read(), BY), f"{tmp_path}/u", f"{tmp_path}/cu").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/u").count() == 6
    live.write_idempotent(live.last_reports(read(), BY, ["u"]), f"{tmp_path}/s", f"{tmp_path}/cs", mode="complete").awaitTermination()
    assert sorted(r.time for r in spark.read.parquet(f"{tmp_path}/s").collect()) == [1.7e9 + t for t in (20.0, 700.0, 1410.0)]
    live.write_idempotent(live.depth_bins(read(), BY, 100.0, ["u"]), f"{tmp_path}/b", f"{tmp_path}/cb", mode="complete").awaitTermination()
    assert {r.bin for r in spark.read.parquet(f"{tmp_path}/b").collect()} == {1, 7, 14, 15}


# command line


def raw_files(path):
    t = np.arange(0, 20_000, 10.0)
    wave = 100 * (1 - np.abs(2 * ((t / 4000) % 1) - 1))
    p = np.where(wave < 8, 0.0, wave)
    half = len(t) // 2
    for k, part in enumerate((slice(0, half), slice(half, None))):
        f = ["i,m_present_time,m_lat,m_lon,m_gps_lat,m_gps_lon,m_depth,m_pitch,m_roll,m_de_oil_vol,m_water_vx,m_water_vy,other"]
        s = ["i,sci_m_present_time,sci_water_pressure,sci_water_cond,sci_water_temp,"]
        for i, (x, y) in enumerate(zip(t[part], p[part])):
            fix = "2133.7,12945.2" if y == 0 and i % 3 == 0 else ","
            v = "0.1,0.2" if y == 0 and i % 20 == 0 else ","
            f.append(f"{i},{1.7e9 + x + 1},2133.5,12945.5,{fix},{y},{0.4},{0.01},{250 if i % 400 < 200 else -250},{v},1")
            s.append(f"{i},{1.7e9 + x},{y / 10},{3.5 + y / 500},{18 - y / 20},")
        s[0] = s[0].rstrip(",")
        (path / f"m{k}.sbd.csv").write_text("\n".join(f) + "\n")
        (path / f"m{k}.tbd.csv").write_text("\n".join(x.rstrip(",") for x in s) + "\n")


def test_command_line(spark, tmp_path, monkeypatch):
    raw_files(tmp_path)
    monkeypatch.setattr(cli, "session", lambda: spark)
    run = lambda *a: cli.main([str(x) for x in a])
    run("cfg", "-o", tmp_path / "c.yml")
    run("l1b", f"{tmp_path}/m*.tbd.csv", "-o", tmp_path / "l1b")
    assert spark.read.parquet(f"{tmp_path}/l1b/obs").count() == 2000
    run("l2", f"{tmp_path}/*.sbd.csv", f"{tmp_path}/*.tbd.csv", "-o", tmp_path / "l2", "-c", tmp_path / "c.yml", "--profiles", tmp_path / "profiles")
    level = level1.read_level(spark, f"{tmp_path}/l2")
    assert level.obs.count() == 2000 and level.gps.count() > 20 and level.uv.where("u IS NOT NULL").count() >= 4
    for name, v in cfg.load_config(tmp_path / "c.yml").variables.items():
        if v.track_qc and name in level.obs.columns:
            assert f"{name}_qc" in level.obs.columns
    assert {r.state for r in level.obs.select("state").distinct().collect()} >= {0, 1, 2}
    assert spark.read.parquet(f"{tmp_path}/profiles").select("profile_key").distinct().count() >= 8
    run("l2", f"{tmp_path}/*.sbd.csv", f"{tmp_path}/*.tbd.csv", "-o", tmp_path / "l2b", "-c", tmp_path / "c.yml", "--profiles", tmp_path / "files", "--profile-files", "-g", "unit9")
    assert len(list((tmp_path / "files").glob("unit9_*.nc"))) == spark.read.parquet(f"{tmp_path}/profiles").select("profile_key").distinct().count()
    pinged = tmp_path / "pinged"
    pinged.mkdir()
    for k in (0, 1):
        (pinged / f"m{k}.sbd.csv").write_text((tmp_path / f"m{k}.sbd.csv").read_text())
        lines = (tmp_path / f"m{k}.tbd.csv").read_text().splitlines()
        (pinged / f"m{k}.tbd.csv").write_text("\n".join([lines[0] + "," + ",".join(sinks.PING_SENSORS), *(x + "," + ",".join(["19000", "5", "7"] + ["1"] * 8 if i % 50 == 0 else [""] * 11) for i, x in enumerate(lines[1:]))]) + "\n")
    run("l2", f"{pinged}/*.sbd.csv", f"{pinged}/*.tbd.csv", "-o", tmp_path / "l2p", "--pings", tmp_path / "pings", "--ping-positions")
    sent = spark.read.option("header", True).csv(f"{tmp_path}/pings")
    assert sent.count() == 40 and sent.columns[-3:] == ["depth", "lat", "lon"] and sent.where("lat IS NOT NULL").count() > 30
    run("l3", tmp_path / "l2", "-o", tmp_path / "l3", "-b", 10)
    bins_ = spark.read.parquet(f"{tmp_path}/l3/obs")
    assert bins_.where("temperature IS NOT NULL AND abs(temperature - (18 - pressure / 20)) > 0.01").count() == 0
    assert spark.read.parquet(f"{tmp_path}/l3/uv").where("u IS NOT NULL").count() > 0
    level.obs.select("time", F.lit(-9.0).alias("e_1"), F.lit(-8.0).alias("e_2"), "pressure").write.parquet(f"{tmp_path}/q")
    run("merge", tmp_path / "l3", tmp_path / "q", "q", "-o", tmp_path / "merged")
    assert abs(spark.read.parquet(f"{tmp_path}/merged/obs").agg(F.avg("e_1")).first()[0] - 1e-9) < 1e-15
    with pytest.raises(FileExistsError):
        run("merge", tmp_path / "l3", tmp_path / "q", "q", "-o", tmp_path / "merged")
    run("merge", tmp_path / "merged", tmp_path / "q", "q", "-o", tmp_path / "merged", "--overwrite")
    assert spark.read.parquet(f"{tmp_path}/merged/obs").where("e_1 IS NOT NULL").count() > 0
    for a in (("merge", tmp_path / "l2", tmp_path / "q", "q"), ("merge", tmp_path / "l3", tmp_path / "q", "p")):
        with pytest.raises(NotImplementedError):
            run(*a, "-o", tmp_path / "x")
    run("hot", tmp_path / "l2", "-o", tmp_path / "h.mat")
    assert (tmp_path / "h.mat").stat().st_size > 2000 * 32
    run("gps", tmp_path / "l2", "-o", tmp_path / "track")
    run("gps", tmp_path / "l2", "-o", tmp_path / "fixes", "--fixes")
    assert spark.read.option("header", True).csv(f"{tmp_path}/track").count() == level.obs.where("lat IS NOT NULL AND lon IS NOT NULL").count()
    with pytest.raises(ValueError):
        run("gps", tmp_path / "l1b", "-o", tmp_path / "x", "--fixes")
    run("concat", tmp_path / "l2", tmp_path / "l2", "-o", tmp_path / "twice")
    assert spark.read.parquet(f"{tmp_path}/twice/obs").count() == 4000
    run("concat", tmp_path / "l2", tmp_path / "l2", "-o", tmp_path / "fixes_twice", "-d", "time_gps")
    both = level1.read_level(spark, f"{tmp_path}/fixes_twice")
    assert both.obs.count() == 2000 and both.gps.count() == 2 * level.gps.count() and both.uv.count() == level.uv.count()
    run("flight", tmp_path / "l2", "-o", tmp_path / "f", "--no-fit")
    run("flight", tmp_path / "twice", "--inplace", "--no-fit")
    assert "speed_through_water" in spark.read.parquet(f"{tmp_path}/twice/obs").columns
    with pytest.raises(ValueError):
        run("flight", tmp_path / "l2")
    run("netcdf", tmp_path / "l2", "-o", tmp_path / "l2.nc")
    assert netcdf_source.read_netcdf(spark, f"{tmp_path}/l2.nc").count() == 2000


# queries


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events".split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


def tidy(v):
    return round(v, 5) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_against_sql(spark, tables, name):
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    want = tables.sql(queries.SQL[name])
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    a = sorted((tuple(tidy(r[c]) for c in columns) for r in got.collect()), key=repr)
    b = sorted((tuple(tidy(r[want.columns.index(c)]) for c in columns) for r in want.fetchall()), key=repr)
    assert len(a) == len(b) and (a or name == "drift_runs")
    for x, y in zip(a, b):
        assert all(p == q or (isinstance(p, float) and isinstance(q, float) and abs(p - q) <= 2e-5 * max(1, abs(p))) for p, q in zip(x, y)), (x, y)


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_without_sql(spark, name):
    got = queries.QUERIES[name](spark, "/root/testdata/sf0.001")
    assert got.count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_steps_of_the_fit_go_over_distinct_rows(spark, monkeypatch):
    """Rows with equal inputs are one row with their number, and the fit is that of all rows."""
    made = queries.flown(spark, "/root/testdata/sf0.001", flight.parameters({"Vg": 0.0675, "Cd0": 0.2})).cache()
    sizes, model = [], flight.with_model

    def counted(df, p):
        sizes.append(df.count() if not sizes else sizes[0])
        return model(df, p)

    monkeypatch.setattr(flight, "with_model", counted)
    fit = flight.fit_parameters(made, BY, fit=("Vg", "Cd0"))
    assert fit.rows == made.count() and sizes[0] <= 100 < fit.rows
    assert abs(fit.params["Vg"] - 0.0675) < 1e-6 and abs(fit.params["Cd0"] - 0.2) < 1e-4
