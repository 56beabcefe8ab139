"""Positions: fixes at the surface, and dead reckoning corrected between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import cut
from ..plans.config import Config
from . import timeseries as ts


def fixes(flight: DataFrame, config: Config, by: list[str]) -> DataFrame | None:
    """(time, anchors, companions) of the rows where all anchors are valid; None without an anchor or such a row."""
    anchors = [v.name for v in config.variables.values() if v.anchor and v.name in flight.columns]
    if not anchors:
        return None
    companions = [v.name for v in config.variables.values() if v.companion and v.name in flight.columns]
    out = flight.na.drop("any", subset=anchors).select(*by, F.col("time").alias("time_gps"), *anchors, *companions)
    return None if out.isEmpty() else out


def good_fixes(df: DataFrame, by: list[str], gap: float = 600.0, time: str = "time") -> DataFrame:
    """df with `fix`: whether a row has a fix that holds, and `fix_group`: the time at which its group begins.

    Groups of fixes part where fixes are more than gap apart. The first fix of a group goes (of the last group only
    if it has more than two), and so do fixes more than 0.5 m deeper than the median fix; a missing depth counts as 0.
    """
    have = F.col("lon_gps").isNotNull() & F.col("lat_gps").isNotNull()
    # fixes are few, a handful for each surfacing
    found = cut(ts.sessionize(df.where(have), gap, by, time, start="__group", width=None))
    sizes = found.groupBy(*by, "__group").agg(F.count("*").alias("__size"))
    last = sizes.groupBy(*by).agg(F.max("__group").alias("__last"))
    deep = ts.grouped_median(found.select(*by, F.coalesce("m_depth", F.lit(0.0)).alias("__median")), by, "__median")
    facts = sizes.join(last, by).join(deep, by)
    judged = found.join(facts, [*by, "__group"])
    first = (F.col(time) == F.col("__group")) & ((F.col("__group") != F.col("__last")) | (F.col("__size") > 2))
    bad = first | (F.coalesce("m_depth", F.lit(0.0)) > F.col("__median") + 0.5)
    kept = judged.where(~bad).select(*by, F.col(time).alias("__t"))
    out = df.join(kept.withColumnsRenamed({b: f"__{b}" for b in by}), [F.col(b) == F.col(f"__{b}") for b in by] + [F.col(time) == F.col("__t")], "left")
    return out.withColumn("fix", F.col("__t").isNotNull()).drop("__t", *(f"__{b}" for b in by))


def correct_dead_reckoning(df: DataFrame, by: list[str], gap: float = 600.0, time: str = "time") -> DataFrame:
    """lon and lat moved, between groups of fixes, by the line through the bounding fixes less that of the reckoning.

    A gap runs from the last fix of one group up to, but not with, the first of the next, and needs two positions at
    different times. Moved rows get flag 2; fixes that don't hold become null. df: unique times.
    """
    marked = cut(good_fixes(df, by, gap, time))
    groups = ts.sessionize(marked.where("fix"), gap, by, time, start="__group", width=None).groupBy(*by, "__group").agg(
        *(F.max_by(c, time).alias(f"__end_{c}") for c in (time, "lon_gps", "lat_gps")), *(F.min_by(c, time).alias(f"__begin_{c}") for c in (time, "lon_gps", "lat_gps"))
    )
    # gaps as points at their beginnings, carried forward
    following = ts.lag_lead(groups.withColumn("__at", F.col(f"__end_{time}")), by, ["__at"], lead={f"__n_{c}": F.col(f"__begin_{c}") for c in (time, "lon_gps", "lat_gps")}, width=None)
    gaps = following.where(F.col(f"__n_{time}").isNotNull()).select(*by, F.col("__at").alias(time), F.struct(F.col("__at").alias("t0"), F.col("__end_lon_gps").alias("x0"), F.col("__end_lat_gps").alias("y0"), F.col(f"__n_{time}").alias("t1"), F.col("__n_lon_gps").alias("x1"), F.col("__n_lat_gps").alias("y1")).alias("__gap"))
    placed = cut(ts.locf_join(marked, cut(gaps), ["__gap"], by, time)).withColumn("__gap", F.when(F.col(time) < F.col("__gap.t1"), F.col("__gap")))
    valid = F.col("lon").isNotNull() & F.col("lat").isNotNull()
    point = F.struct(F.col(time).alias("t"), "lon", "lat")
    ends = placed.where(valid & F.col("__gap").isNotNull()).groupBy(*by, F.col("__gap.t0").alias("__g")).agg(F.min_by(point, time).alias("__a"), F.max_by(point, time).alias("__z"))
    ends = ends.where("__a.t < __z.t").withColumnsRenamed({b: f"__{b}" for b in by})
    got = placed.join(ends, [F.col(b) == F.col(f"__{b}") for b in by] + [F.col("__gap.t0") == F.col("__g")], "left")

    def moved(c: str, g: str):
        line = lambda t0, y0, t1, y1: y0 + (y1 - y0) / (t1 - t0) * (F.col(time) - t0)
        fix = line(F.col("__gap.t0"), F.col(f"__gap.{g}0"), F.col("__gap.t1"), F.col(f"__gap.{g}1"))
        own = line(F.col("__a.t"), F.col(f"__a.{c}"), F.col("__z.t"), F.col(f"__z.{c}"))
        return F.when(F.col("__a").isNotNull(), F.col(c) + fix - own).otherwise(F.col(c))

    touched = F.col("__a").isNotNull() & valid
    out = {"lon": moved("lon", "x"), "lat": moved("lat", "y"), "lon_gps": F.when(F.col("fix"), F.col("lon_gps")), "lat_gps": F.when(F.col("fix"), F.col("lat_gps"))}
    out |= {f"{c}_qc": F.when(touched, F.lit(2).cast("tinyint")).otherwise(F.col(f"{c}_qc")) for c in ("lon", "lat") if f"{c}_qc" in df.columns}
    return got.select(*(out[c].alias(c) if c in out else F.col(c) for c in df.columns))


def gps_track(obs: DataFrame) -> DataFrame:
    """The dead-reckoned track: rows with time, lat and lon."""
    return obs.select("time", "lat", "lon").na.drop()
