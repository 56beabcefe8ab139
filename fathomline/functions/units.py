"""Unit conversions of columns, by the names that a configuration gives them."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def dpm_to_dd(x: Column) -> Column:
    """Degrees and decimal minutes (dddmm.mm) to decimal degrees; the degrees are cut towards zero."""
    whole = F.when(x < 0, F.ceil(x / 100)).otherwise(F.floor(x / 100)).cast("double")
    return whole + (x - 100 * whole) / 60


def scaled(by: float) -> Callable[[Column], Column]:
    return lambda x: x * by


#: Conversions by name.
CONVERSIONS: dict[str, Callable[[Column], Column]] = {
    "dpm_to_dd": dpm_to_dd,
    "bar_to_dbar": scaled(10.0),
    "spm_to_mspcm": scaled(10.0),
    "rad_to_deg": scaled(180.0 / math.pi),
    "deg_to_rad": scaled(math.pi / 180.0),
    "dbar_to_Pa": scaled(1e4),
    "cm3_to_m3": scaled(1e-6),
}


def _utc(seconds: Column) -> Column:
    """Seconds since 1970 as a time without zone, so that no session's zone moves it."""
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def epoch_iso(seconds: Column) -> Column:
    """2020-01-02T03:04:05 in UTC."""
    return F.date_format(_utc(seconds), "yyyy-MM-dd'T'HH:mm:ss")


def epoch_stamp(seconds: Column) -> Column:
    """20200102T030405Z in UTC, for file names."""
    return F.date_format(_utc(seconds), "yyyyMMdd'T'HHmmss'Z'")


def last_part(x: Column, mark: str = "_") -> Column:
    return F.substring_index(x, mark, -1)
