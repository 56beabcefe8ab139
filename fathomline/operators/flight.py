"""Steady-state flight model after Merckelbach et al. (2019), and its calibration by distributed least squares."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import timeseries as ts
from .least_squares import minimise

# Parameters of the model and bounds of those that can be fitted.
DEFAULTS: dict[str, float | None] = {
    "rho0": 1025.0,
    "mg": 70.0,
    "Vg": 0.090,
    "Cd0": 0.15,
    "Cd1": 10.0,
    "Cd1_hull": 9.7,
    "ah": 3.8,
    "aw": None,
    "reference_area": 0.10,
    "aspect_ratio": 7.0,
    "sweep_angle": 0.7505,
    "osborne_efficiency": 0.8,
    "hull_compressibility": 5e-10,
}
BOUNDS = {"mg": (40.0, 150.0), "Vg": (0.005, 0.2), "Cd0": (0.0, 2.0), "ah": (0.0, 10.0), "Cd1": (0.0, 100.0), "aw": (0.0, 30.0)}
FITTED = ("Vg", "mg", "Cd0", "ah")
GRAVITY, LEAST, STEEPEST, TABLE = 9.81, math.radians(5), math.radians(60), 120
INPUTS = ("pressure", "pitch", "ballast_pumped", "density", "dzdt")
LEAST_ROWS = 100


def wing_slope(aspect: float, sweep: float) -> float:
    return 2 * math.pi * aspect / (2 + math.sqrt(aspect**2 * (1 + math.tan(sweep) ** 2) + 4))


def induced_drag(aw: float, efficiency: float, aspect: float, hull: float) -> float:
    return aw**2 / (math.pi * efficiency * aspect) + hull


def parameters(given: dict | None = None) -> dict[str, float]:
    """Defaults with the given ones; aw and Cd1 follow from the wing unless given."""
    given = {k: v for k, v in (given or {}).items() if k in DEFAULTS}
    p = DEFAULTS | given
    if p["aw"] is None:
        p["aw"] = wing_slope(p["aspect_ratio"], p["sweep_angle"])
    if "Cd1" not in given:
        p["Cd1"] = induced_drag(p["aw"], p["osborne_efficiency"], p["aspect_ratio"], p["Cd1_hull"])
    return p


def attack_table(p: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
    """Angles of attack over 120 pitches from 5 to 60 degrees, by Newton's method."""
    pitch = np.linspace(LEAST, STEEPEST, TABLE)
    a, lift = pitch / 50, p["ah"] + p["aw"]
    for _ in range(60):
        tan = np.tan(a + pitch)
        f = (p["Cd0"] + p["Cd1"] * a * a) / (lift * tan) - a
        slope = (2 * p["Cd1"] * a * tan - (p["Cd0"] + p["Cd1"] * a * a) * (1 + tan * tan)) / (lift * tan * tan) - 1
        step = f / slope
        a = a - step
        if np.abs(step).max() < 1e-14:
            break
    return pitch, a


def attack(pitch: Column, p: dict[str, float]) -> Column:
    """Angle of attack by linear interpolation in the table, odd in pitch; 0 below 5 and above 60 degrees."""
    grid, values = attack_table(p)
    table = F.array(*(F.lit(float(v)) for v in values))
    place = (F.abs(pitch) - LEAST) / ((STEEPEST - LEAST) / (TABLE - 1))
    i = F.least(F.floor(place), F.lit(TABLE - 2)).cast("int")
    y0, y1 = F.get(table, i), F.get(table, i + 1)
    inside = F.abs(pitch).between(float(grid[0]), float(grid[-1]))
    return F.when(pitch.isNull(), None).when(inside, (y0 + (y1 - y0) * (place - i)) * F.signum(pitch)).otherwise(0.0)


def with_model(df: DataFrame, p: dict[str, float]) -> DataFrame:
    """df with the model's four columns; inputs in dbar, degrees, cm3, kg/m3 and m/s."""
    rho = F.col("density")
    # named in steps, so that each is one expression in the plan
    df = df.withColumn("__pitch", F.radians("pitch"))
    df = df.withColumn("__alpha", attack(F.col("__pitch"), p))
    buoyancy = GRAVITY * rho * (p["Vg"] * (1 - p["hull_compressibility"] * F.col("pressure") * 1e4) + F.col("ballast_pumped") * 1e-6)
    angle = F.col("__pitch") + F.col("__alpha")
    drag = rho * p["reference_area"] * (p["Cd0"] + p["Cd1"] * F.col("__alpha") * F.col("__alpha"))
    square = F.when(drag != 0, 2 * (buoyancy - p["mg"] * GRAVITY) * F.sin(angle) / drag).otherwise(F.when(drag.isNotNull(), 0.0))
    df = df.withColumn("speed_through_water", F.sqrt(F.when(square.isNotNull(), F.greatest(square, F.lit(0.0)))))
    df = df.withColumn("vertical_glider_velocity", F.col("speed_through_water") * F.sin(angle))
    return df.withColumns({"vertical_water_velocity": F.col("dzdt") - F.col("vertical_glider_velocity"), "angle_of_attack": F.degrees("__alpha")}).drop("__pitch", "__alpha")


def with_dzdt(obs: DataFrame, by: list[str]) -> DataFrame:
    return obs if "dzdt" in obs.columns else ts.gradient(obs, "z", "time", by, "dzdt")


def apply_model(obs: DataFrame, by: list[str], params: dict | None = None) -> DataFrame:
    """obs with the model's columns as floats; the parameters go along as metadata."""
    out = with_model(with_dzdt(obs, by), p := parameters(params))
    meta = {f"flight_model_{k}": float(v) for k, v in p.items()}
    names = ("speed_through_water", "vertical_glider_velocity", "vertical_water_velocity", "angle_of_attack")
    return out.select(*obs.columns, *(F.col(c).cast("float").alias(c, metadata=meta) for c in names))


def calibration_rows(obs: DataFrame, by: list[str], start: float | None = None, end: float | None = None, pressures: tuple[float, float] = (20.0, 1000.0)) -> DataFrame:
    """Complete rows within times (inclusive) and pressures (exclusive); at least 100 of them."""
    rows = with_dzdt(obs, by).select(*by, "time", *INPUTS).na.drop("any", subset=list(INPUTS))
    if start is not None:
        rows = rows.where(F.col("time") >= start)
    if end is not None:
        rows = rows.where(F.col("time") <= end)
    return rows.where((F.col("pressure") > pressures[0]) & (F.col("pressure") < pressures[1]))


@dataclass
class Fit:
    """All parameters, those fitted in their order, their covariance (nan where one is at its bound), and which are."""

    params: dict[str, float]
    fitted: tuple[str, ...]
    covariance: np.ndarray
    at_bound: tuple[str, ...]
    cost: float
    rows: int


def calibrate(obs: DataFrame, by: list[str], fit: tuple[str, ...] = FITTED, params: dict | None = None, rounds: int = 100, **chosen) -> dict[str, float]:
    """Parameters that make the modelled vertical velocity fit the observed one best, within their bounds."""
    return fit_parameters(obs, by, fit, params, rounds, **chosen).params


def fit_parameters(obs: DataFrame, by: list[str], fit: tuple[str, ...] = FITTED, params: dict | None = None, rounds: int = 100, **chosen) -> Fit:
    """The fit of calibrate(), with its covariance.

    A step of the trust region is one aggregation over all rows: of the residual and its differences by each parameter
    it sums the products, so that a few numbers reach the driver. Rows with equal inputs are one row with their number,
    so steps don't go over repeated rows again; that takes one shuffle of the rows.
    """
    if unknown := [n for n in fit if n not in BOUNDS]:
        raise ValueError(f"parameters without bounds: {', '.join(unknown)}")
    rows = calibration_rows(obs, by, **chosen).groupBy(*INPUTS).agg(F.count("*").alias("__rows")).persist()
    if (n := rows.agg(F.sum("__rows")).first()[0] or 0) < LEAST_ROWS:
        rows.unpersist()
        raise ValueError(f"{n} rows are too few to calibrate; {LEAST_ROWS} are needed")
    base = parameters(params)

    def full(x) -> dict[str, float]:
        p = base | dict(zip(fit, map(float, x)))
        if "aw" in fit:
            p["Cd1"] = induced_drag(p["aw"], p["osborne_efficiency"], p["aspect_ratio"], p["Cd1_hull"])
        return p

    low, high = (np.array([BOUNDS[k][i] for k in fit]) for i in (0, 1))
    size = np.maximum(np.abs(np.array([base[k] for k in fit])), 1e-6)

    def sums(x):
        frame = with_model(rows, full(x)).withColumn("r0", F.col("vertical_glider_velocity") - F.col("dzdt"))
        names = ["r0"]
        for k in range(len(fit)):
            h = 1e-6 * size[k] * (1 if x[k] + 1e-6 * size[k] <= high[k] else -1)
            moved = np.array(x, float)
            moved[k] += h
            frame = with_model(frame.select(*INPUTS, "__rows", *names), full(moved))
            frame = frame.withColumn(f"r{k + 1}", (F.col("vertical_glider_velocity") - F.col("dzdt") - F.col("r0")) / h)
            names.append(f"r{k + 1}")
        pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
        got = frame.agg(*(F.sum(F.col("__rows") * F.col(names[i]) * F.col(names[j])).alias(f"s{i}_{j}") for i, j in pairs)).first()
        m = np.zeros((len(names), len(names)))
        for i, j in pairs:
            m[i, j] = m[j, i] = np.nan if got[f"s{i}_{j}"] is None else got[f"s{i}_{j}"]
        return m

    try:
        got = minimise(sums, [base[k] for k in fit], low, high, n, rounds)
        return Fit(full(got.x), tuple(fit), got.covariance, tuple(k for k, b in zip(fit, got.bound) if b), got.cost, n)
    finally:
        rows.unpersist()
