"""Flags, ranges, times, formats, configuration, pairing."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fathomline.functions import units
from fathomline.operators import gps, quality
from fathomline.plans import config as cfg
from fathomline.sources import level1

BY = ["trajectory"]


def test_conversions(spark):
    c = units.CONVERSIONS
    r = spark.range(1).select(c["dpm_to_dd"](F.lit(4355.1)).alias("a"), c["dpm_to_dd"](F.lit(-12410.5)).alias("b"), c["bar_to_dbar"](F.lit(1.5)).alias("c"), c["rad_to_deg"](F.lit(math.pi)).alias("d"), c["deg_to_rad"](F.lit(180.0)).alias("e"), c["dbar_to_Pa"](F.lit(2.0)).alias("f"), c["cm3_to_m3"](F.lit(5.0)).alias("g")).first()
    want = (43 + 55.1 / 60, -(124 + 10.5 / 60), 15.0, 180.0, math.pi, 2e4, 5e-6)
    assert all(abs(x - y) < 1e-9 for x, y in zip(r, want))
    assert spark.range(1).select(units.epoch_stamp(F.lit(0.0)), units.epoch_iso(F.lit(86399.9)), units.last_part(F.lit("a_b_c"))).first()[:] == ("19700101T000000Z", "1970-01-01T23:59:59", "c")


def test_flags_and_ranges(spark):
    df = spark.createDataFrame([(1.0,), (5.0,), (0.999,), (None,)], "y double")
    got = quality.apply_bounds(quality.init_qc(df, ["y"]), {"y": (1.0, 5.0), "absent": (0, 1)}).collect()
    assert [tuple(r) for r in got] == [(1.0, 2), (5.0, 2), (None, 4), (None, 9)]
    assert quality.update_flag(df, "y", 4, F.lit(True)).columns == ["y"]
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "y double")
    assert [r.y for r in quality.missing_to_null(nan).collect()] == [None, 1.0]


def test_first_row_of_a_time_wins_whole(spark):
    rows = [("a", 0, 0, 5.0, None), ("a", 0, 1, 5.0, 7.0), ("a", 0, 2, None, 1.0), ("a", 0, 3, 1.0, 2.0), ("a", 1, 0, 1.0, 3.0)]
    df = quality.init_qc(spark.createDataFrame(rows, "trajectory string, file_ord int, i long, time double, y double"), ["time"])
    got = quality.unique_times(df, BY, ["file_ord", "i"]).orderBy("time").collect()
    assert [(r.time, r.y, r.time_qc) for r in got] == [(1.0, 2.0, 2), (5.0, None, 2)]


def test_format_keeps_the_catalogue_only(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 4355.1, 9.0)], "trajectory string, m_present_time double, sci_m_present_time double, m_lat double, other double")
    got = quality.format_variables(df, cfg.load_config(), keep=BY)
    assert got.columns == ["trajectory", "time", "lat"] and got.first().time == 1.0
    assert got.schema["lat"].metadata["units"] == "degrees_north"
    with pytest.raises(ValueError):
        quality.format_variables(df.select("other"), cfg.load_config())


def test_merge_flags(spark):
    science = quality.init_qc(spark.createDataFrame([("a", float(t), 1.0) for t in range(4)], "trajectory string, time double, temperature double"), ["temperature"])
    flight = spark.createDataFrame([("a", 1.0, 10.0, 3.0, 0.1), ("a", 2.0, 20.0, None, 0.2)], "trajectory string, time double, pressure double, pitch double, lat_gps double")
    got = quality.merge_streams(flight, science, cfg.load_config(), BY).orderBy("time").collect()
    assert [(r.pressure, r.pressure_qc, r.temperature_qc) for r in got] == [(None, 9, 0), (10.0, 8, 0), (20.0, 8, 0), (None, 9, 0)]
    assert "pitch_qc" not in got[0] and "lat_gps" not in got[0]
    back = quality.merge_streams(flight, science, cfg.load_config(), BY, "flight")
    assert back.count() == 2 and back.first().temperature == 1.0


def test_fixes(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0, None), ("a", 2.0, 1.0, 2.0)], "trajectory string, time double, lat_gps double, lon_gps double")
    assert [r.time_gps for r in gps.fixes(df, cfg.load_config(), BY).collect()] == [2.0]
    assert gps.fixes(df.limit(1), cfg.load_config(), BY) is None
    assert gps.fixes(df.select("trajectory", "time"), cfg.load_config(), BY) is None


def test_dead_reckoning_meets_the_fixes(spark):
    """Positions off by a drift between two groups of fixes are moved onto the line between them."""
    rows = []
    for t in range(0, 10_001, 100):
        fix = t <= 400 or t >= 9600
        rows.append(("a", float(t), 10 + t / 10_000 + 0.3 * t / 10_000 if not fix else None, 20.0 + t / 1e5 if not fix else None, 10 + t / 10_000 if fix else None, 20.0 if fix else None, 0.0))
    df = quality.init_qc(spark.createDataFrame(rows, "trajectory string, time double, lon double, lat double, lon_gps double, lat_gps double, m_depth double"), ["lon", "lat"])
    got = gps.correct_dead_reckoning(df, BY).orderBy("time").collect()
    moved = [r for r in got if r.lon is not None]
    assert all(abs(r.lon - (10 + r.time / 10_000)) < 1e-6 and abs(r.lat - 20) < 1e-6 and r.lon_qc == 2 for r in moved)
    assert [r.time for r in got if r.lon_gps is not None] == [100.0, 200.0, 300.0, 400.0, 9700.0, 9800.0, 9900.0, 10000.0]  # the first of each group goes


def test_a_deep_fix_goes(spark):
    rows = [("a", float(t), 1.0, 1.0, 5.0 if t == 2 else 0.0) for t in range(6)]
    df = spark.createDataFrame(rows, "trajectory string, time double, lon_gps double, lat_gps double, m_depth double")
    assert [r.time for r in gps.good_fixes(df, BY).where("fix").orderBy("time").collect()] == [1.0, 3.0, 4.0, 5.0]


# configuration


def write(tmp_path, text):
    (tmp_path / "c.yml").write_text(text)
    return tmp_path / "c.yml"


def test_default_configuration(tmp_path):
    cfg.write_default(tmp_path / "c.yml")
    c = cfg.load_config(tmp_path / "c.yml")
    assert c.trajectory == "trajectory" and "heading" in c.variables and "speed_through_water" not in c.variables
    assert "speed_through_water" in cfg.load_config().variables


def test_overrides_and_own_variables(tmp_path, caplog):
    text = cfg.DEFAULT_YAML.replace("qc: {}", "qc: {pressure: {valid_max: 900, nonsense: 1}, nothing: {valid_max: 1}}").replace("l1_variables: {}", "l1_variables: {oxygen: {source: sci_oxy, CF: {valid_min: 0, valid_max: 500, units: umol}}, pressure: {source: x}}")
    c = cfg.load_config(write(tmp_path, text))
    assert c.variables["pressure"].valid_max == 900 and c.variables["pressure"].sources == ("sci_water_pressure",)
    assert c.variables["oxygen"].valid_max == 500 and c.by_source()["sci_oxy"].name == "oxygen"
    assert len(caplog.records) == 3


@pytest.mark.parametrize("text", ["a: [", "- 1\n- 2", "globals: {}", cfg.DEFAULT_YAML + "---\na: 1"])
def test_bad_configuration(tmp_path, text):
    with pytest.raises(cfg.ConfigError):
        cfg.load_config(write(tmp_path, text))


def test_times_are_utc():
    assert cfg.utc_epoch(dt.datetime(1970, 1, 2)) == 86400 == cfg.utc_epoch(dt.date(1970, 1, 2))
    assert cfg.utc_epoch(dt.datetime(1970, 1, 2, 1, tzinfo=dt.timezone(dt.timedelta(hours=1)))) == 86400


# pairing


def test_pairs(spark, tmp_path):
    assert level1.classify("x/a.b.sbd.csv") == ("flight", "a.b") and level1.classify("s.ebd.nc") == ("science", "s")
    for name in ("b.sbd.csv", "a.sbd.csv", "a.tbd.csv", "b.tbd.csv"):
        (tmp_path / name).write_text("i,x\n0,1.5\n")
    got = level1.pair_input_files(spark, f"{tmp_path}/*.sbd.csv", f"{tmp_path}/*.tbd.csv")
    assert [tuple(p.rsplit("/", 1)[1] for p in x) for x in got] == [("a.sbd.csv", "a.tbd.csv"), ("b.sbd.csv", "b.tbd.csv")]
    assert [tuple(r) for r in level1.read_raw(spark, [x[0] for x in got]).orderBy("file_ord").collect()] == [(0, 0, 1.5), (1, 0, 1.5)]


@pytest.mark.parametrize("flight, science", [([], ["a.tbd.csv"]), (["a.tbd.csv"], ["a.tbd.csv"]), (["a.txt"], ["a.tbd.csv"]), (["a.sbd.csv", "a.dbd.csv"], ["a.tbd.csv"]), (["a.sbd.csv", "b.sbd.csv"], ["a.tbd.csv"]), (["b.sbd.csv"], ["a.tbd.csv"])])
def test_bad_pairs(flight, science):
    with pytest.raises(level1.PairingError):
        level1.pair_names(flight, science)


def test_unpaired_files_can_be_left_out():
    assert level1.pair_names(["a.sbd.csv", "b.sbd.csv"], ["b.tbd.csv", "c.tbd.csv"], skip_unpaired=True) == [("b.sbd.csv", "b.tbd.csv")]
    with pytest.raises(level1.PairingError):
        level1.pair_names(["a.sbd.csv"], ["c.tbd.csv"], skip_unpaired=True)


def test_levels():
    assert level1.product_level({"time", "pressure"}) == 2 and level1.product_level({"profile_id", "bin", "time"}) == 3
    with pytest.raises(ValueError):
        level1.product_level({"x"})
