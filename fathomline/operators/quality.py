"""Quality control: flags, valid ranges, unique times, gap filling, and projections by the catalogue.

Flags: 0 not checked, 2 probably good, 4 bad, 8 interpolated, 9 missing. A flag of variable v is the column v_qc.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.units import CONVERSIONS
from ..plans.config import Config, VariableSpec
from . import timeseries as ts

GOOD, BAD, FILLED, MISSING, UNCHECKED = 2, 4, 8, 9, 0
TYPES = {"f4": "float", "f8": "double", "i4": "int", "i1": "tinyint", "b": "tinyint"}


def missing_to_null(df: DataFrame) -> DataFrame:
    """NaN to null in all floating columns."""
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c, t in df.dtypes if t in ("double", "float")})


def tag(value: int) -> Column:
    return F.lit(value).cast("tinyint")


def format_variables(raw: DataFrame, config: Config, keep: Iterable[str] = ()) -> DataFrame:
    """Sensors converted and renamed to variables, with attributes as metadata; other columns but `keep` go.

    Where both clocks are there the science one goes. An error if no column is a known sensor.
    """
    columns = [c for c in raw.columns if not (c == "sci_m_present_time" and "m_present_time" in raw.columns)]
    by_source, chosen = config.by_source(), {}
    for c in columns:
        if (v := by_source.get(c)) is not None:
            value = F.col(c).cast("double")
            value = CONVERSIONS[v.conversion](value) if v.conversion else value
            chosen[v.name] = value.alias(v.name, metadata={"units": v.units or "", "source": c, **{k: str(x) for k, x in v.attrs.items()}})
    if not chosen:
        raise ValueError("none of the columns is a sensor of the configuration")
    return raw.select(*(k for k in keep if k in columns and k not in chosen), *chosen.values())


def init_qc(df: DataFrame, names: Iterable[str], flags: Column | None = None) -> DataFrame:
    """Flag 0 where there is a value, 9 where not; or the given flags."""
    return df.withColumns({f"{n}_qc": (flags if flags is not None else F.when(F.col(n).isNull(), MISSING).otherwise(UNCHECKED)).cast("tinyint") for n in names})


def update_flag(df: DataFrame, name: str, flag: int, where: Column) -> DataFrame:
    """The flag where the condition holds; nothing happens without a column of flags."""
    qc = f"{name}_qc"
    return df.withColumn(qc, F.when(F.coalesce(where, F.lit(False)), tag(flag)).otherwise(F.col(qc))) if qc in df.columns else df


def changed(a: Column, b: Column, relative: float = 1e-5, absolute: float = 1e-8) -> Column:
    """Whether values differ beyond a tolerance; two nulls don't."""
    near = F.abs(a - b) <= absolute + relative * F.abs(b)
    return ~F.coalesce(near, a.isNull() & b.isNull())


def apply_bounds(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Nulls values outside inclusive bounds; flags 4 where nulled, 2 where within, missing ones as they were."""
    out = {}
    for name, (low, high) in bounds.items():
        if name not in df.columns:
            continue
        value, inside = F.col(name), F.col(name).between(low, high)
        out[name] = F.when(inside, value)
        if (qc := f"{name}_qc") in df.columns:
            out[qc] = F.when(value.isNull(), F.col(qc)).when(inside, tag(GOOD)).otherwise(tag(BAD))
    return df.withColumns(out)


def bounds_of(variables: Iterable[VariableSpec]) -> dict[str, tuple[float, float]]:
    return {v.name: (v.valid_min, v.valid_max) for v in variables if v.valid_min is not None and v.valid_max is not None}


def unique_times(df: DataFrame, by: list[str], order: list[str], time: str = "time") -> DataFrame:
    """Rows with a time, the first in file order of each; flags of time become 2.

    The rows of one time come together by a minimum, which is taken before the shuffle as well, so a time that very
    many rows share is no burden.
    """
    kept = df.where(F.col(time).isNotNull()).groupBy(*by, F.col(time).alias("__t")).agg(F.min_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")
    return update_flag(kept, time, GOOD, F.lit(True))


def drop_empty(df: DataFrame, names: list[str]) -> DataFrame:
    return df.na.drop("all", subset=names)


def interpolate_missing(df: DataFrame, gaps: dict[str, float | None], by: list[str], time: str = "time") -> DataFrame:
    """Gaps filled, with flag 8 where they were."""
    out = ts.fill_gaps(df, {c: g for c, g in gaps.items() if c in df.columns}, by, time)
    for c in gaps:
        if c in df.columns:
            out = update_flag(out, c, FILLED, F.col(f"{c}_filled")).drop(f"{c}_filled")
    return out.select(*df.columns)


def enforce_types(df: DataFrame, config: Config) -> DataFrame:
    """Casts to the types of the catalogue, and integers of labels and flags."""
    given = {v.name: TYPES.get(v.dtype, v.dtype) for v in config.variables.values() if v.dtype}
    given |= {"dive_id": "int", "climb_id": "int", "profile_id": "int", "state": "tinyint"}
    return df.select(*(F.col(c).cast(given[c]).alias(c, metadata=df.schema[c].metadata) if c in given else F.col(c) for c in df.columns))


def apply_qc(df: DataFrame, config: Config, by: list[str], order: list[str]) -> DataFrame:
    """Flags, ranges, unique times and gaps, in that order."""
    have = [v for v in config.variables.values() if v.name in df.columns]
    df = init_qc(df, [v.name for v in have if v.track_qc])
    df = apply_bounds(df, bounds_of(have))
    df = unique_times(df, by, order)
    return interpolate_missing(df, {v.name: v.max_gap for v in have if v.interpolate_missing}, by)


def observed(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """df, and an observation that counts rows with each condition when df is first computed; no pass of its own."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *(F.count(F.when(c, 1)).alias(n) for n, c in counts.items())), seen


def any_nonzero(names: Iterable[str]) -> Column:
    """Whether any of the columns is neither null nor zero."""
    return reduce(lambda a, b: a | b, (F.coalesce(F.col(c), F.lit(0)) != 0 for c in names))


def merge_streams(flight: DataFrame, science: DataFrame, config: Config, by: list[str], times_from: str = "science") -> DataFrame:
    """One stream interpolated to the times of the other; new tracked columns get flag 8, or 9 where null."""
    if times_from not in ("science", "flight"):
        raise ValueError("times_from has to be science or flight")
    left, right = (science, flight) if times_from == "science" else (flight, science)
    dropped = {v.name for v in config.variables.values() if v.drop_from_l2}
    left = left.drop(*dropped)
    values = [c for c, t in right.dtypes if c not in by and c != "time" and not c.endswith("_qc") and c not in dropped and t in ("double", "float")]
    out = ts.interp_join(left, right.select(*by, "time", *values), values, by)
    for c in values:
        if (v := config.variables.get(c)) and v.track_qc and f"{c}_qc" not in left.columns:
            out = out.withColumn(f"{c}_qc", F.when(F.col(c).isNull(), tag(MISSING)).otherwise(tag(FILLED)))
    return out
