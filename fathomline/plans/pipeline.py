"""The dataflows: raw tables to checked ones, to a merged and labelled series, to binned profiles; and the flight model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import cut, cut_all
from ..functions import seawater
from ..operators import bins, flight, gps, profiles, quality
from ..operators import timeseries as ts
from ..sources.level1 import Level
from .config import Config

BY = ["trajectory"]
ORDER = ["file_ord", "i"]


def l1b(raw: DataFrame, config: Config) -> DataFrame:
    """Formatted and checked, streams apart."""
    formatted = quality.format_variables(raw, config, keep=[*BY, *ORDER])
    return quality.apply_qc(formatted, config, BY, ORDER).drop(*ORDER)


def thermodynamics(df: DataFrame, config: Config) -> DataFrame:
    """Salinity, Absolute Salinity, Conservative Temperature, densities, sound speed, height, depth and N squared.

    Positions are interpolated over gaps of any length. Flags follow those of conductivity and of pressure. df is read
    twice; write a costly one first.
    """
    if not config.include.get("thermo", True) or not {"conductivity", "temperature", "pressure", "lat", "lon"} <= set(df.columns):
        return df
    c, p = F.col, F.col("pressure")
    df = df.withColumn("salinity", seawater.practical_salinity(c("conductivity") * 10, c("temperature"), p))
    df = df.withColumn("SA", seawater.absolute_salinity(c("salinity")))
    df = df.withColumn("CT", seawater.conservative_temperature(c("SA"), c("temperature"), p))
    # positions around gaps, and both neighbours of a sample, in one pass
    state = F.struct(c("SA").alias("s"), c("CT").alias("t"), p.alias("p"), c("time").alias("x"))
    point = lambda v: F.when(c(v).isNotNull(), F.struct(c("time").alias("t"), c(v).alias("v")))
    add = {"__a": (state, "before"), "__b": (state, "after")} | {f"__p_{v}": (point(v), "last") for v in ("lat", "lon")} | {f"__n_{v}": (point(v), "next") for v in ("lat", "lon")}
    df = ts.carry(df, BY, ["time"], add)
    df = df.withColumns({v: F.coalesce(c(v), ts.interpolate(c("time"), c(f"__p_{v}.t"), c(f"__p_{v}.v"), c(f"__n_{v}.t"), c(f"__n_{v}.v"))) for v in ("lat", "lon")})
    df = df.withColumns({"density": seawater.density(c("SA"), c("CT"), p), "rho0": seawater.density(c("SA"), c("CT"), F.lit(0.0)), "sound_speed": seawater.sound_speed(c("SA"), c("CT"), p)})
    df = df.withColumn("z", seawater.height(p, c("lat"))).withColumn("depth", -c("z"))
    # N squared lies between samples; at a sample it is interpolated between the two around it
    frequency = lambda a, b: seawater.buoyancy_frequency(*a, *b, c("lat"))
    at = lambda n: (c(f"{n}.s"), c(f"{n}.t"), c(f"{n}.p"))
    own = (c("SA"), c("CT"), p)
    middle = lambda n: (c("time") + c(f"{n}.x")) / 2
    df = df.withColumns({"__n0": frequency(at("__a"), own), "__n1": frequency(own, at("__b"))})
    df = df.withColumn("N2", ts.interpolate(c("time"), middle("__a"), c("__n0"), middle("__b"), c("__n1"))).drop("__n0", "__n1", *add)
    derived = ["salinity", "SA", "CT", "density", "rho0", "sound_speed"]
    inherit = lambda of: F.col(f"{of}_qc") if f"{of}_qc" in df.columns else quality.tag(quality.UNCHECKED)
    flags = {f"{v}_qc": inherit("conductivity") for v in derived} | {f"{v}_qc": inherit("pressure") for v in ("z", "depth")}
    df = quality.init_qc(df.withColumns(flags), ["N2"])
    return quality.apply_bounds(df, quality.bounds_of(v for v in config.variables.values() if v.name in derived))


def l2(raw_flight: DataFrame, raw_science: DataFrame, config: Config, shallowest: float = 5.0, surface_time: float = 180.0, adjust_dead_reckoning: bool = False) -> Level:
    """Merged on the science clock, derived, labelled, with velocities and fixes.

    Labels look at the raw flight table, fixes at the checked one.
    """
    flight_, science = cut_all(l1b(raw_flight, config), l1b(raw_science, config))
    if adjust_dead_reckoning and {"lon", "lat", "lon_gps", "lat_gps", "m_depth"} <= set(flight_.columns):
        flight_ = gps.correct_dead_reckoning(flight_, BY)
    obs = cut(thermodynamics(cut(quality.merge_streams(flight_, science, config, BY)), config))
    raw_fixes = None
    if "m_gps_lat" in raw_flight.columns:
        raw_fixes = raw_flight.where("m_gps_lat IS NOT NULL AND m_present_time IS NOT NULL").select(*BY, F.col("m_present_time").alias("time"))
    # labels are made of a few columns; the others join them once
    labels = profiles.assign_surface(cut(profiles.label_samples(obs, BY, shallowest, surface_time, raw_flight)), BY, raw_fixes)
    obs = cut(obs.drop(*profiles.Labels.NAMES).join(labels.drop("pressure"), [*BY, "time"]))
    if {"m_water_vx", "m_water_vy"} <= set(raw_flight.columns):
        reports = profiles.velocity_reports(raw_flight, BY)
    else:
        reports = obs.select(*BY, "time", F.lit(None).cast("double").alias("u"), F.lit(None).cast("double").alias("v")).limit(0)
    uv = profiles.velocities(obs, reports, BY)
    return Level(quality.enforce_types(obs, config), gps.fixes(flight_, config, BY), uv, config.global_attributes)


def l3(level: Level, config: Config, size: float = 10.0, deepest: float | None = None) -> tuple[DataFrame, DataFrame]:
    """(bins, profiles): means by depth and facts of profiles with velocities."""
    drop = {v.name for v in config.variables.values() if v.drop_from_l3}
    cells, facts = bins.bin_profiles(level.obs, BY, size, deepest, drop)
    if level.uv is not None:
        facts = bins.interpolate_velocity(facts, level.uv, BY)
    return cells, facts


def merge_turbulence(cells: DataFrame, facts: DataFrame, q: DataFrame, size: float, latitude: float | None = None) -> DataFrame:
    """bins with turbulence of a file (time, e_1, e_2, pressure), whose depth is from its pressure at the mean latitude."""
    at = F.lit(latitude) if latitude is not None else F.lit(facts.agg(F.avg("profile_lat")).first()[0] or 0.0)
    rows = q.withColumn("depth", -seawater.height(F.col("pressure"), at))
    if "trajectory" not in rows.columns:
        only = [r[0] for r in facts.select("trajectory").distinct().limit(2).collect()]
        if len(only) != 1:
            raise ValueError("turbulence without a trajectory can be merged into one trajectory only")
        rows = rows.withColumn("trajectory", F.lit(only[0]))
    return bins.bin_turbulence(cells, facts, rows, BY, size)


def fly(level: Level, config: Config, fit: bool = True, **chosen) -> tuple[Level, dict[str, float]]:
    """The level with the flight model's columns, its parameters fitted first unless told not to."""
    given = {k: v for k, v in config.flight.items() if k in flight.DEFAULTS}
    names = tuple(config.flight.get("fit", flight.FITTED))
    params = flight.calibrate(level.obs, BY, names, given, **chosen) if fit else flight.parameters(given)
    return Level(flight.apply_model(level.obs, BY, params), level.gps, level.uv, level.attrs | {f"flight_model_{k}": v for k, v in params.items()}), params
