"""Profiles averaged in bins of depth, with facts of each profile and velocities interpolated to it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import timeseries as ts


def bin_number(depth: Column, size: float) -> Column:
    """Bins are open above and closed below: (0, size] is 1; depth 0 is in none."""
    return F.ceil(depth / size).cast("int")


def bin_mean(df: DataFrame, keys: list[str], depth: str, size: float, values: list[str], deepest: float | None = None, grid: bool = True) -> DataFrame:
    """(keys, bin, depth, values): means without nulls; with a grid, empty bins are rows of nulls.

    The grid goes to `deepest`, or to the deepest sample of all; it has a row for each key and bin.
    """
    k = bin_number(F.col(depth), size)
    used = df.where(F.col(depth) > 0)
    means = used.groupBy(*keys, k.alias("bin")).agg(*(F.avg(v).alias(v) for v in values))
    middle = ((F.col("bin") - 0.5) * size).alias(depth)
    if not grid:
        return (means if deepest is None else means.where(F.col("bin") <= F.ceil(F.lit(deepest / size)))).select(*keys, "bin", middle, *(v for v in values if v != depth))
    last = F.ceil(F.lit(float(deepest)) / size).cast("int") if deepest is not None else df.agg(F.ceil(F.max(depth) / size).cast("int")).scalar()
    cells = df.select(*keys).distinct().withColumn("__bins", last).where("__bins > 0").select(*keys, F.explode(F.sequence(F.lit(1), F.col("__bins"))).alias("bin"))
    return cells.join(means, [*keys, "bin"], "left").select(*keys, "bin", middle, *(v for v in values if v != depth))


def profile_regions(obs: DataFrame, by: list[str], merged: bool = False) -> DataFrame:
    """Samples of dives and climbs with l2_profile_id, the profile's id.

    merged: profiles that follow each other without another sample between are one region instead, and l2_profile_id
    is the number of the run of samples within or outside of profiles.
    """
    if merged:
        return ts.islands(obs, F.col("profile_id") >= 0, by, ["time"], "l2_profile_id").where("profile_id >= 0").drop("profile_id")
    return obs.where("profile_id >= 0").withColumnRenamed("profile_id", "l2_profile_id")


def profile_facts(df: DataFrame, by: list[str], key: str = "l2_profile_id") -> DataFrame:
    """State, start, end, and time, lat and lon at the first sample from the middle of the time on; numbered from 1."""
    ends = df.groupBy(*by, key).agg(F.min_by("state", "time").alias("state"), F.min("time").alias("profile_time_start"), F.max("time").alias("profile_time_end"), F.max("depth").alias("__deep"))
    ends = ends.where("__deep IS NOT NULL").drop("__deep")
    middle = df.join(ends.select(*by, key, ((F.col("profile_time_start") + F.col("profile_time_end")) / 2).alias("__mid")), [*by, key]).where("time >= __mid")
    at = middle.groupBy(*by, key).agg(F.min_by(F.struct("time", "lat", "lon"), "time").alias("m"))
    got = ends.join(at, [*by, key]).select(*by, key, "state", "profile_time_start", "profile_time_end", F.col("m.time").alias("profile_time"), F.col("m.lat").alias("profile_lat"), F.col("m.lon").alias("profile_lon"))
    return got.withColumn("profile_id", F.row_number().over(Window.partitionBy(*by).orderBy("profile_time_start", key)))


def interpolate_velocity(facts: DataFrame, uv: DataFrame, by: list[str], needed: tuple[str, ...] = ("u", "v")) -> DataFrame:
    """facts with u and v at profile_time: between known reports only, null next to an unknown one.

    Unknown is a report without one of the needed components. Profiles and reports are sparse: a series of them takes one window.
    """
    reports = uv.where("time_uv IS NOT NULL").select(*by, F.col("time_uv").alias("time"), "u", "v")
    known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in needed))
    whole = reports.where(known).select(*by, "time", "u", "v")
    left = facts.withColumn("time", F.col("profile_time"))
    got = ts.interp_join(left, whole, ["u", "v"], by, width=None)
    marks = reports.select(*by, "time", known.alias("__known"))
    # as a search for the place of a time does, a report at that very time counts as the one after
    after = ts.next_join(got, marks, ["__known"], by, width=None).withColumnRenamed("__known", "__after")
    tagged = ts._tagged(after, marks, by, "time", ["__known"]).withColumn("__late", F.lit(1) - F.col("__side"))
    before = ts.carry(tagged, by, ["time", "__late"], {"__b": (F.col("__right"), "before")}, width=None)
    out = before.where("__side = 1").select("__left.*", F.col("__b.__known").alias("__before"))
    fine = F.coalesce("__after", F.lit(True)) & F.coalesce("__before", F.lit(True))
    return out.withColumns({"u": F.when(fine, F.col("u")), "v": F.when(fine, F.col("v"))}).drop("__after", "__before", "time")


def bin_profiles(obs: DataFrame, by: list[str], size: float = 10.0, deepest: float | None = None, drop: set[str] = frozenset()) -> tuple[DataFrame, DataFrame]:
    """(bins, profiles) of labelled samples. Flags, labels, z and the variables in drop are not averaged."""
    rows = profile_regions(obs, by)
    facts = profile_facts(rows, by)
    values = [c for c, t in rows.dtypes if t in ("double", "float") and c not in drop and not c.endswith("_qc") and c not in ("z", "depth", "u", "v")]
    named = rows.join(facts.select(*by, "l2_profile_id", F.col("profile_id").alias("profile_id")), [*by, "l2_profile_id"])
    return bin_mean(named, [*by, "profile_id"], "depth", size, values, deepest), facts


def bin_turbulence(bins: DataFrame, facts: DataFrame, q: DataFrame, by: list[str], size: float, columns: tuple[str, ...] = ("e_1", "e_2"), depth: str = "depth") -> DataFrame:
    """bins with means of log10 quantities, taken of the quantities themselves, over each profile's time.

    Times of profiles are cut to whole seconds, so a sample may be in two of them; it counts in both.
    """
    spans = facts.select(*by, "profile_id", *(F.floor(f"profile_time_{x}").cast("double").alias(x) for x in ("start", "end")))
    placed = ts.interval_join(q, spans, ["profile_id"], by)
    linear = placed.withColumns({c: F.pow(F.lit(10.0), F.col(c)) for c in columns})
    means = bin_mean(linear, [*by, "profile_id"], depth, size, list(columns), grid=False).drop(depth)
    return bins.drop(*columns).join(means, [*by, "profile_id", "bin"], "left")
