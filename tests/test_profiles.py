"""Labels of synthetic dives, velocities, exports."""

import collections

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fathomline.operators import bins, profiles
from fathomline.plans import queries
from fathomline.sources import level1, netcdf, netcdf_source, sinks

BY = ["trajectory"]


def dive(dt, deep=100.0, rate=0.15, rest=400.0, count=3):
    one = np.concatenate([np.arange(0, deep, rate * dt), np.arange(deep, 0, -rate * dt), np.zeros(int(rest / dt))])
    p = np.concatenate([np.zeros(int(rest / dt)), *[one] * count])
    return np.arange(len(p)) * float(dt), p


@pytest.mark.parametrize("dt", [1, 15])
def test_dives_and_climbs(dt):
    t, p = dive(dt)
    got = profiles.label(t, p, None, 5.0)
    assert got["dive_id"].max() == got["climb_id"].max() == 3
    for k in (1, 2, 3):
        d, c = p[got["dive_id"] == k], p[got["climb_id"] == k]
        assert d.min() < 6 and d.max() > 90 and c.min() < 6 and c.max() > 90
        assert set(got["profile_id"][got["dive_id"] == k]) == {2 * k - 1} and set(got["profile_id"][got["climb_id"] == k]) == {2 * k}
    assert ((got["state"] == 1) == (got["dive_id"] > 0)).all()


@pytest.mark.parametrize("dt", [1, 15])
def test_drift_between_dive_and_climb(dt):
    draw = np.random.default_rng(0)
    down, up = np.arange(0, 90, 0.15 * dt), np.arange(90, 0, -0.15 * dt)
    hover = 90 + draw.normal(0, 0.3, int(3600 / dt))
    p = np.concatenate([np.zeros(int(400 / dt)), down, hover, up, np.zeros(int(400 / dt))])
    got = profiles.label(np.arange(len(p)) * float(dt), p, None, 5.0)
    a = int(400 / dt) + len(down)
    assert (got["state"][a : a + len(hover)] == 3).mean() > 0.7
    climb = p[got["climb_id"] == 1]
    assert climb.max() > 80 and climb.min() < 5 and (got["profile_id"][got["state"] == 3] == -1).all()


def test_a_stall_keeps_one_climb():
    dt = 5
    up = np.arange(100, 0, -0.15 * dt)
    up = np.concatenate([up[: len(up) // 2], np.full(24, up[len(up) // 2]), up[len(up) // 2 :]])
    p = np.concatenate([np.zeros(80), np.arange(0, 100, 0.15 * dt), up, np.zeros(80)])
    got = profiles.label(np.arange(len(p)) * float(dt), p, None, 5.0)
    assert got["climb_id"].max() == 1 and (got["climb_id"] == 1).sum() > 0.9 * len(up)


def test_nothing_to_find():
    for p in (np.zeros(50), np.full(50, np.nan), np.zeros(0), np.zeros(1)):
        assert (profiles.label(np.arange(len(p), dtype=float), p, None, 5.0)["state"] == -1).all()


def labels(state):
    state = np.array(state, np.int8)
    return profiles.Labels(state, np.where(state == 1, 1, -1), np.where(state == 2, 1, -1), np.where(state == 1, 1, np.where(state == 2, 2, -1)))


def test_turns_part_at_the_extreme():
    got = profiles.Labels([1, 1, -1, -1, -1, 2, -1, -1, 1], [1, 1, -1, -1, -1, -1, -1, -1, 2], [-1, -1, -1, -1, -1, 1, -1, -1, -1], [1, 1, -1, -1, -1, 2, -1, -1, 3])
    profiles.split_turns(got, np.array([80.0, 90, 95, 99, 97, 90, 20, 25, 30]), 5)
    state, dive, climb, profile = (c.tolist() for c in got.columns)
    assert state == [1, 1, 1, 1, 2, 2, 2, 1, 1] and profile == [1, 1, 1, 1, 2, 2, 2, 3, 3]
    assert dive == [1, 1, 1, 1, -1, -1, -1, 2, 2] and climb == [-1, -1, -1, -1, 1, 1, 1, -1, -1]
    for p in ([5.0, 1.0, 5.0], [5.0, np.nan, 5.0]):  # shallow, unknown
        got = labels([1, -1, 2])
        profiles.split_turns(got, np.array(p), 5)
        assert got.state.tolist() == [1, -1, 2]


def test_transients_around_a_drift():
    def run(state, window):
        got = labels(state)
        profiles.settle_drifts(got, window)
        return got.state.tolist()

    assert run([1, 1, 2, -1, 3, 3, 2], 3) == [1, 1, 3, 3, 3, 3, 2]
    assert run([1, 2, 2, 2, 3, 3], 3) == [1, 2, 2, 2, 3, 3]
    assert run([3, 3, 1, -1, 2, 2], 3) == [3, 3, 2, 2, 2, 2]
    assert run([3, 3, 1, 1, 1, 2], 3) == [3, 3, 1, 1, 1, 2]
    assert run([3, 3, 2], 3) == [3, 3, 2] and run([3], 3) == [3] and run([], 3) == []


def naive_peaks(x, prominence, distance, width, height):
    """The definitions of peaks, one by one."""
    n, tops, i = len(x), [], 1
    while i < n - 1:
        j = i
        while j < n - 1 and x[j + 1] == x[i]:
            j += 1
        if x[i - 1] < x[i] and j < n - 1 and x[j + 1] < x[i]:
            tops.append((i + j) // 2)
        i = j + 1
    tops = [i for i in tops if height is None or x[i] >= height]
    stays = []
    for i in sorted(tops, key=lambda i: (-x[i], -i)):
        if all(abs(i - j) >= distance for j in stays):
            stays.append(i)
    out = []
    for i in sorted(stays):
        a = max((j for j in range(i) if x[j] > x[i]), default=-1)
        b = min((j for j in range(i + 1, n) if x[j] > x[i]), default=n)
        rise = x[i] - max(min(x[a + 1 : i + 1]), min(x[i:b]))
        if rise < prominence:
            continue
        bar, a, b = x[i] - rise / 2, i, i
        while x[a] > bar:
            a -= 1
        while x[b] > bar:
            b += 1
        lo = a + (bar - x[a]) / (x[a + 1] - x[a]) if x[a] < bar else a
        hi = b - (bar - x[b]) / (x[b - 1] - x[b]) if x[b] < bar else b
        if hi - lo >= width:
            out.append(i)
    return out


@pytest.mark.parametrize("seed", range(40))
def test_peaks_against_their_definition(seed):
    draw = np.random.default_rng(seed)
    x = np.round(np.cumsum(draw.normal(0, 2, 400)) if seed % 2 else 30 * np.sin(np.arange(400) / draw.uniform(5, 40)) + draw.normal(0, 4, 400))
    for height in (None, 3.0):
        given = (float(draw.integers(1, 12)), int(draw.integers(1, 30)), float(draw.integers(0, 10)), height)
        assert profiles.find_peaks(x, *given).tolist() == naive_peaks(x.tolist(), *given)


def test_time_of_labels_is_in_proportion():
    import time

    def seconds(n):
        draw = np.random.default_rng(1)
        t = np.arange(n, dtype=float)
        p = np.maximum(0, 300 * (1 - np.abs(2 * (t / 7000 % 1) - 1)) - 20) + draw.normal(0, 0.5, n)
        began = time.process_time()
        profiles.label(t, p, None, 5.0)
        return time.process_time() - began

    seconds(20_000)
    assert seconds(800_000) < 12 * seconds(100_000) + 0.5


def test_stretches_are_cut_at_the_surface(spark):
    t, p = dive(10, rest=1000.0, count=4)
    rows = [(s, float(x), float(y) if i % 13 else None) for s in ("a", "b", None) for i, (x, y) in enumerate(zip(t, p))]
    obs = spark.createDataFrame(rows, "trajectory string, time double, pressure double")
    cut = profiles.stretches(obs, BY).toPandas()
    assert cut.groupby("trajectory", dropna=False)["__stretch"].nunique(dropna=False).tolist() == [4, 4, 4]
    got = profiles.get_profiles(obs.where("trajectory IS NOT NULL"), BY).where("profile_id > 0").groupBy(*BY, "profile_id", "dive_id", "climb_id", "state").agg(F.min("time").alias("t")).orderBy("trajectory", "t").collect()
    assert [(r.profile_id, r.dive_id, r.climb_id, r.state) for r in got] == [x for k in range(1, 5) for x in ((2 * k - 1, k, -1, 1), (2 * k, -1, k, 2))] * 2


@pytest.fixture(scope="module")
def obs(spark):
    t, p = dive(10)
    rows = [(s, float(x), float(y) if i % 13 else None, 10 + float(x) / 1e5, 20 + float(x) / 1e5) for s in ("a", "b") for i, (x, y) in enumerate(zip(t, p))]
    return spark.createDataFrame(rows, "trajectory string, time double, pressure double, lat double, lon double").withColumn("depth", F.col("pressure"))


def test_labels_in_spark(spark, obs):
    got = profiles.assign_surface(profiles.get_profiles(obs, BY), BY, spark.createDataFrame([("a", 100.0)], "trajectory string, time double"))
    assert got.count() == obs.count()
    counts = {(r.trajectory, r.state): r["count"] for r in got.groupBy("trajectory", "state").count().collect()}
    assert all(counts[s, 1] > 150 and counts[s, 2] > 150 and counts[s, 0] > 80 for s in "ab")


def test_hover_reports_are_used_where_there_are_any(spark, obs):
    flight = spark.createDataFrame([("a", 1000.0, 1.0), ("a", 1500.0, 0.0), ("a", 1600.0, -127.0), ("a", 1700.0, None)], "trajectory string, m_present_time double, x_hover_active double")
    got = profiles.get_profiles(obs, BY, flight=flight)
    drift = got.where("state = 3").groupBy("trajectory").agg(F.min("time"), F.max("time")).collect()
    assert [tuple(r) for r in drift] == [("a", 1000.0, 1490.0)]


def test_velocities_and_exports(spark, obs, tmp_path):
    labelled = profiles.assign_surface(profiles.get_profiles(obs, BY), BY)
    ends = {r.trajectory: r.t for r in labelled.where("climb_id = 1").groupBy("trajectory").agg(F.max("time").alias("t")).collect()}
    flight = spark.createDataFrame([(s, ends[s] + d, u, v) for s in "ab" for d, u, v in ((50.0, 0.1, 0.2), (100.0, 0.3, 0.4), (150.0, None, 1.0))], "trajectory string, m_present_time double, m_water_vx double, m_water_vy double")
    reports = profiles.velocity_reports(flight, BY)
    assert sorted((r.trajectory, r.u) for r in reports.collect()) == [("a", 0.3), ("b", 0.3)]
    uv = profiles.velocities(labelled, reports, BY)
    assert sorted((r.trajectory, r.u) for r in uv.collect() if r.u) == [("a", 0.3), ("b", 0.3)] and uv.count() == 4
    only = labelled.where("trajectory = 'a'")
    assert [sinks.emit_profiles(only, uv, BY, f"{tmp_path}/p", "unit", force=f) for f in (False, False, True)] == [2, 0, 2]
    again = spark.read.parquet(f"{tmp_path}/p")
    assert again.select("profile_id").distinct().count() == 2 and {"profile_time", "u", "v", "crs", "platform"} <= set(again.columns)
    assert sinks.emit_profiles(only.drop("state"), uv, BY, f"{tmp_path}/q", "unit") == 0
    assert [sinks.emit_profile_files(only, uv, BY, f"{tmp_path}/nc", "unit", {"ctd": "a"}, force=f, attrs={"title": "t"}) for f in (False, False, True)] == [2, 0, 2]
    files = sorted((tmp_path / "nc").glob("*.nc"))
    assert [f.stem for f in files] == sorted(r[0] for r in again.select("profile_key").distinct().collect())
    sizes, attrs, variables = netcdf.parse(files[0].read_bytes())
    rows = again.where(F.col("profile_key") == files[0].stem).orderBy("time").toPandas()
    assert attrs == {"title": "t"} and sizes == {"time": len(rows)} and np.allclose(variables["pressure"][2], rows.pressure, equal_nan=True)
    assert variables["crs"][0] == () and variables["crs"][1] == {"_FillValue": sinks.INT_FILL, **sinks.CRS} and variables["ctd"][1] == {"_FillValue": sinks.INT_FILL, "description": "a"}
    assert variables["platform"][1] == {"_FillValue": sinks.INT_FILL, "ancillary_variables": " ", "comment": "Autonomous vehicle", "long_name": "platform", "type": "platform", "id": "unit", "instrument": "ctd"}
    assert variables["profile_id"][2].dtype.str == ">i4" and int(variables["profile_id"][2]) == rows.profile_id[0] and variables["profile_lat"][1]["standard_name"] == "latitude"
    assert again.schema["profile_id"].dataType.simpleString() == "int" and again.schema["crs"].metadata == sinks.CRS
    with_attrs = sinks.profile_tables(only, uv, BY, "unit", {"ctd": {"serial_number": "7", "type": "instrument"}})
    assert with_attrs.schema["instrument_ctd"].metadata == {"serial_number": "7", "type": "instrument"}
    assert float(variables["profile_time"][2]) == rows.profile_time[0] and float(variables["u"][2]) == rows.u[0]
    assert netcdf_source.read_netcdf(spark, str(files[0])).count() == len(rows)
    nothing = profiles.velocities(obs.withColumns({"dive_id": F.lit(-1), "climb_id": F.lit(-1)}), reports, BY).collect()
    assert len(nothing) == 2 and all(r.time_uv is None for r in nothing)


def test_bins_and_facts(spark, obs):
    cells, facts = bins.bin_profiles(profiles.get_profiles(obs, BY), BY, 20.0)
    assert cells.groupBy("trajectory", "profile_id").count().where("count <> 5").count() == 0
    assert [r.profile_id for r in facts.where("trajectory = 'a'").orderBy("profile_time").collect()] == [1, 2, 3, 4, 5, 6]
    assert cells.where("pressure IS NOT NULL AND (pressure <= (bin - 1) * 20 OR pressure > bin * 20)").count() == 0


def test_velocity_next_to_an_unknown_one_is_unknown(spark):
    facts = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 15.0), ("a", 3, 25.0), ("a", 4, 10.0), ("a", 5, 99.0)], "trajectory string, profile_id int, profile_time double")
    uv = spark.createDataFrame([("a", 0.0, 1.0, 1.0), ("a", 10.0, 2.0, 3.0), ("a", 20.0, 1.0, None), ("a", 30.0, 4.0, 5.0)], "trajectory string, time_uv double, u double, v double")
    got = {r.profile_id: (r.u, r.v) for r in bins.interpolate_velocity(facts, uv, BY).collect()}
    assert got == {1: (1.5, 2.0), 2: (None, None), 3: (None, None), 4: (2.0, 3.0), 5: (None, None)}


def test_turbulence_is_averaged_before_the_logarithm(spark):
    facts = spark.createDataFrame([("a", 1, 0.5, 10.9)], "trajectory string, profile_id int, profile_time_start double, profile_time_end double")
    cells = spark.createDataFrame([("a", 1, 1, 5.0), ("a", 1, 2, 15.0)], "trajectory string, profile_id int, bin int, depth double")
    q = spark.createDataFrame([("a", 0.0, 3.0, -1.0), ("a", 10.0, 4.0, -2.0), ("a", 10.5, 5.0, 0.0)], "trajectory string, time double, depth double, e_1 double")
    got = {r.bin: r.e_1 for r in bins.bin_turbulence(cells, facts, q, BY, 10.0, ("e_1",)).collect()}
    assert got == {1: pytest.approx(0.055), 2: None}


def test_turbulence_of_a_shared_second_is_in_both_profiles(spark):
    """Profiles that meet within a second, one that holds another, and a sample in none, against the join of ranges."""
    facts = spark.createDataFrame([("a", 1, 100.2, 200.7), ("a", 2, 200.9, 300.1), ("a", 3, 150.0, 250.0), ("b", 1, 0.0, 90000.0), (None, 1, 5.0, 6.0)], "trajectory string, profile_id int, profile_time_start double, profile_time_end double")
    cells = facts.select(*BY, "profile_id", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("bin"), F.lit(5.0).alias("depth"))
    q = spark.createDataFrame([(s, float(t), 3.0 + 10 * (t % 2), -float(t % 7)) for s in ("a", "b", None) for t in range(0, 320, 5)] + [("a", 200.5, 3.0, 0.0)], "trajectory string, time double, depth double, e_1 double")
    got = {(r.trajectory, r.profile_id, r.bin): r.e_1 for r in bins.bin_turbulence(cells, facts, q, BY, 10.0, ("e_1",)).where("trajectory IS NOT NULL").collect()}
    rows = q.collect()
    for f in facts.where("trajectory IS NOT NULL").collect():
        for b in (1, 2):
            of = [10**r.e_1 for r in rows if r.trajectory == f.trajectory and int(f.profile_time_start) <= r.time <= int(f.profile_time_end) and 10 * (b - 1) < r.depth <= 10 * b]
            assert got[f.trajectory, f.profile_id, b] == (pytest.approx(sum(of) / len(of)) if of else None)
    assert {r.profile_id for r in bins.ts.interval_join(q.where("time = 200"), facts.select(*BY, "profile_id", F.floor("profile_time_start").cast("double").alias("start"), F.floor("profile_time_end").cast("double").alias("end")), ["profile_id"], BY).where("trajectory = 'a'").collect()} == {1, 2, 3}


# pings


def pings(spark, rows):
    names = ", ".join(f"{s} double" for s in sinks.PING_SENSORS)
    return spark.createDataFrame(rows, f"trajectory string, time double, {names}, depth double, lat double, lon double")


def test_ping_table(spark, tmp_path):
    ping = (1.0, 2.0, 3.9, 10.0, 69.0, 7.0, 1.0, None, 2.0, 3.0, 0.0)
    df = pings(spark, [("a", 1.0, *ping, 5.0, 1.0, 2.0), ("a", 2.0, *[0.0] * 11, None, None, None), ("a", 3.0, *[None] * 11, 1.0, 1.0, 1.0), ("a", 4.0, *ping, 0.0, None, 2.0), ("a", 5.0, *ping, 9.0, 3.0, 4.0)])
    got = sinks.ping_table(df, BY)
    assert got.columns == ["riotDataPrefix", "epochMsecs", "rtMsecs", "freq", "detectionLevel", "sequenceNumber", "group", "slot", "platformId", "platformState", "recNumInFile"]
    assert got.count() == 3 and got.first().epochMsecs == 86_402_003 and got.first().platformId is None
    placed = [(r.depth, r.lat, r.lon) for r in sinks.ping_table(df, BY, positions=True).collect()]
    assert placed[0] == (5.0, 1.0, 2.0) and placed[1] == (8.0, 2.5, 3.5)
    assert [r.lat for r in sinks.ping_table(df.drop("lat"), BY, positions=True).collect()] == [None] * 3
    assert sinks.ping_table(df.drop("sr_ping_freq"), BY) is None and sinks.ping_table(df.where("time IN (2, 3)"), BY) is None
    for _ in range(2):
        sinks.write_csv(got, f"{tmp_path}/pings")
    assert spark.read.option("header", True).csv(f"{tmp_path}/pings").count() == 3


def test_level_round_trip(spark, obs, tmp_path):
    sinks.write_level(level1.Level(obs, None, obs.select("trajectory").distinct(), {"title": "x", "none": None}), f"{tmp_path}/l")
    got = level1.read_level(spark, f"{tmp_path}/l")
    assert got.obs.count() == obs.count() and got.gps is None and got.uv.count() == 2 and got.attrs == {"title": "x"}


def test_labels_of_a_dense_series_are_those_of_the_sql(spark, tmp_path):
    """Samples less than a minute apart in bursts that last as long as a drift, as in tables larger than the tests'."""
    rng = np.random.default_rng(5)
    at = np.cumsum(np.where(np.arange(3000) % 60 == 0, 3000.0, rng.uniform(11, 14, 3000)))
    rows = pd.DataFrame({"event_id": np.arange(len(at)) * 11 + 1, "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta((at * 1e6).astype("int64"), unit="us"), "user_id": rng.integers(0, 2, len(at)), "event_type": "click", "value": 1.0})
    rows["ts"] = rows["ts"].astype("datetime64[us]")
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    db.register("rows", rows)
    db.execute(f"COPY (SELECT event_id, ts, user_id, event_type, value FROM rows) TO '{tmp_path}/events.parquet'")
    db.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    columns = ["trajectory", "event_id", "time", "pressure", *profiles.Labels.NAMES]
    want = db.sql(f"SELECT {', '.join(columns)} FROM ({queries.SQL['profile_label']})").fetchall()
    got = [tuple(r) for r in queries.profile_label(spark, str(tmp_path)).select(*columns).collect()]
    assert len(got) == len(rows) and collections.Counter(got) == collections.Counter(want)
