"""Time-series operators: edges, ties, nulls; and the same rows for any width of blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathomline.operators import bins
from fathomline.operators import timeseries as ts

BY = ["s"]


def frame(spark, rows, schema="s string, time double, y double"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def series(spark):
    rows = [(s, float(t), None if (t * 7 + k) % 5 < 2 else float((t * 13 + k) % 17)) for k, s in enumerate("ab") for t in range(0, 120, 3)]
    return frame(spark, [*rows, (None, 5.0, 1.0), (None, 9.0, None)])


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("width", [1.0, 7.0, 40.0])
def test_blocks_change_nothing(series, width):
    for f in (
        lambda w: ts.lag_lead(series, BY, ["time"], {"a": F.col("y")}, {"b": F.col("time")}, w),
        lambda w: ts.numbered(series, BY, ["time"], "n", w).withColumn("n", F.col("n").cast("long")),
        lambda w: ts.running_count(series, BY, ["time"], F.col("y") > 5, "n", w),
        lambda w: ts.islands(series, F.col("y") > 8, BY, ["time"], "n", w),
        lambda w: ts.sessionize(series.where("y IS NOT NULL"), 3.0, BY, width=w),
        lambda w: ts.fill_gaps(series, {"y": 9.0}, BY, width=w),
        lambda w: ts.gradient(series, "y", "time", BY, width=w),
        lambda w: ts.interp_join(series.select("s", "time"), series.where("time % 2 = 0"), ["y"], BY, skip_nulls=True, width=w),
    ):
        assert rows(f(width)) == rows(f(None))


def test_carry_directions(spark):
    df = frame(spark, [("a", 1.0, None), ("a", 2.0, 5.0), ("a", 3.0, None), ("a", 9.0, 7.0)])
    got = ts.carry(df, BY, ["time"], {k: (F.col("y"), k) for k in ("last", "before", "next", "after")}, 2.0)
    assert [tuple(r)[3:] for r in got.orderBy("time").collect()] == [(None, None, 5.0, 5.0), (5.0, None, 5.0, 7.0), (5.0, 5.0, 7.0, 7.0), (7.0, 5.0, 7.0, None)]


def test_locf_takes_the_report_at_the_time(spark):
    left = frame(spark, [("a", 1.0, 0.0), ("a", 2.0, 0.0), ("a", 3.0, 0.0), ("b", 3.0, 0.0)]).drop("y")
    right = frame(spark, [("a", 2.0, 20.0), ("a", 2.5, None), ("a", 4.0, 40.0)])
    assert rows(ts.locf_join(left, right, ["y"], BY)) == [("a", 1.0, None), ("a", 2.0, 20.0), ("a", 3.0, None), ("b", 3.0, None)]
    assert rows(ts.next_join(left, right, ["y"], BY)) == [("a", 1.0, 20.0), ("a", 2.0, 20.0), ("a", 3.0, 40.0), ("b", 3.0, None)]


def test_interpolation_and_null_policies(spark):
    left = frame(spark, [("a", float(t), 0.0) for t in range(7)]).drop("y")
    right = frame(spark, [("a", 1.0, 10.0), ("a", 3.0, None), ("a", 5.0, 50.0)])
    assert [r.y for r in ts.interp_join(left, right, ["y"], BY).orderBy("time").collect()] == [None, 10.0, None, None, None, 50.0, None]
    assert [r.y for r in ts.interp_join(left, right, ["y"], BY, skip_nulls=True).orderBy("time").collect()] == [None, 10.0, 20.0, 30.0, 40.0, 50.0, None]


def test_a_name_on_both_sides_is_the_right_one(spark):
    df = frame(spark, [("a", 1.0, 1.0)])
    assert rows(ts.interp_join(df, df.withColumn("y", F.lit(9.0)), ["y"], BY)) == [("a", 1.0, 9.0)]


def test_gap_limit_is_inclusive(spark):
    df = frame(spark, [("a", 0.0, 0.0), ("a", 30.0, None), ("a", 60.0, 60.0), ("a", 90.0, None), ("a", 121.0, 0.0), ("a", 130.0, None)])
    assert [(r.y, r.y_filled) for r in ts.fill_gaps(df, {"y": 60.0}, BY).orderBy("time").collect()] == [(0.0, False), (30.0, True), (60.0, False), (None, False), (0.0, False), (None, False)]


def test_sessions_part_beyond_the_gap(spark):
    df = frame(spark, [("a", 0.0, 1.0), ("a", 600.0, 2.0), ("a", 1200.5, 3.0)])
    assert [r.session_start for r in ts.sessionize(df, 600.0, BY).orderBy("time").collect()] == [0.0, 0.0, 1200.5]
    assert [r.y for r in ts.last_of_session(df, 600.0, BY).orderBy("time").collect()] == [2.0, 3.0]


def test_nearest(spark):
    left = frame(spark, [("a", 0.0, 0.0), ("a", 7.0, 0.0), ("b", 1.0, 0.0)])
    right = frame(spark, [("a", 5.0, 0.0), ("a", 8.0, 0.0)])
    assert {(r.s, r.time): r.gap for r in ts.nearest_gap(left, right, BY, "gap").collect()} == {("a", 0.0): 5.0, ("a", 7.0): 1.0, ("b", 1.0): None}


@pytest.mark.parametrize("part", [3, 5, 1000])
def test_rolling_over_parts(spark, part):
    import numpy as np

    y = [None if t % 6 == 1 else float(t * t % 23) for t in range(40)]
    df = frame(spark, [("a", float(t), v) for t, v in enumerate(y)])
    got = ts.rolling_stats(df, "y", 2, BY, ["time"], rows=part).orderBy("time").collect()
    for t, r in enumerate(got):
        around = [v for v in y[max(0, t - 2) : t + 3] if v is not None]
        assert r.y_count == len(around) and abs(r.y_mean - np.mean(around)) < 1e-9 and abs(r.y_std - np.std(around)) < 1e-9
    assert len(got) == 40


def test_gradient_is_second_order(spark):
    t = [0.0, 1.0, 3.0, 4.0, 7.0]
    got = ts.gradient(frame(spark, [("a", x, x * x) for x in t]), "y", "time", BY).orderBy("time").collect()
    assert [round(r.gradient, 9) for r in got] == [1.0, 2.0, 6.0, 8.0, 11.0]
    assert [r.mid for r in ts.midpoints(frame(spark, [("a", x, x) for x in t]), "y", BY, ["time"]).orderBy("time").collect()] == [0.5, 2.0, 3.5, 5.5]


def test_bins_are_closed_below_and_empty_ones_stay(spark):
    df = frame(spark, [("a", 0.0, 1.0), ("a", 10.0, 2.0), ("a", 10.1, 4.0), ("a", 35.0, None), ("b", 5.0, 9.0)], "s string, depth double, y double")
    got = {(r.s, r.bin): (r.depth, r.y) for r in bins.bin_mean(df, ["s"], "depth", 10.0, ["y"]).collect()}
    assert got == {("a", 1): (5.0, 2.0), ("a", 2): (15.0, 4.0), ("a", 3): (25.0, None), ("a", 4): (35.0, None), ("b", 1): (5.0, 9.0), ("b", 2): (15.0, None), ("b", 3): (25.0, None), ("b", 4): (35.0, None)}
    assert bins.bin_mean(df.limit(0), ["s"], "depth", 10.0, ["y"]).count() == 0


def test_empty_series(spark):
    none = frame(spark, [])
    assert ts.fill_gaps(none, {"y": 1.0}, BY).count() == ts.interp_join(none, none, ["y"], BY).count() == ts.islands(none, F.col("y") > 0, BY, ["time"]).count() == 0


def test_edges_and_angles(spark):
    df = frame(spark, [("a", x, x) for x in (0.0, 1.0, 3.0)] + [("b", 1.0, 1.0)])
    assert sorted(r.edge for r in ts.edges(df, "y", BY).collect()) == [-0.5, 0.5, 2.0, 4.0]
    got = spark.range(1).select(*(ts.interpolate_angle(F.lit(0.5), F.lit(0.0), F.lit(a), F.lit(1.0), F.lit(b)) for a, b in ((350.0, 10.0), (10.0, 350.0), (90.0, 180.0)))).first()
    assert [round(x, 9) % 360 for x in got] == [0.0, 0.0, 135.0]


def test_counts_come_with_the_rows(spark):
    from fathomline.operators.quality import observed

    df, seen = observed(frame(spark, [("a", 1.0, None), ("a", 2.0, 3.0)]), known=F.col("y").isNotNull())
    assert df.count() == 2 and seen.get == {"rows": 2, "known": 1}


@pytest.mark.parametrize("most,parts", [(10, 4), (50, 1024), (10**6, 7)])
def test_median_of_large_groups(spark, most, parts):
    """Selected, sorted or both: even and odd sizes, repeated and far values, nulls, a null key, a group without values."""
    rng = np.random.default_rng(most)
    rows = [("even", float(x)) for x in rng.normal(size=400)] + [("odd", float(x)) for x in rng.integers(0, 5, 333)] + [("far", float(10.0 ** (i % 17)) * (-1) ** i) for i in range(301)]
    rows += [("one", 7.0)] * 120 + [("few", 1.0), ("few", 2.0), ("few", None), ("none", None)] + [(None, float(x)) for x in range(100)] + [("half", float(i // 200)) for i in range(400)]
    got = {r.k: r.v for r in ts.grouped_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", most, parts).collect()}
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    assert got.keys() == groups.keys()
    for k, v in groups.items():
        known = [x for x in v if x is not None]
        assert got[k] == (pytest.approx(float(np.median(known)), rel=1e-12) if known else None), k
