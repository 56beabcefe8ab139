"""Variables and configuration: what the pipeline reads, how it converts and checks it, and what it writes.

A configuration is a YAML mapping with the sections below. The catalogue of variables is the core, the suites that are
switched on, and the user's own; a plan is a projection made from it.
"""

from __future__ import annotations

import dataclasses
import logging
from dataclasses import dataclass, field
from datetime import UTC, date, datetime
from pathlib import Path
from typing import Any

_log = logging.getLogger(__name__)

#: The sections that a configuration has to have.
SECTIONS = ("globals", "include", "trajectory", "netcdf_attributes", "qc", "l1_variables", "flight")
#: What a user may override of a known variable's checks.
OVERRIDES = ("valid_min", "valid_max", "max_gap", "interpolate_missing")


@dataclass(frozen=True)
class VariableSpec:
    """One variable of the catalogue."""

    name: str
    sources: tuple[str, ...] = ()
    conversion: str | None = None
    valid_min: float | None = None
    valid_max: float | None = None
    track_qc: bool = False
    interpolate_missing: bool = False
    max_gap: float = 60.0
    drop_from_l2: bool = False
    drop_from_l3: bool = False
    dtype: str | None = "float"
    units: str | None = None
    anchor: bool = False
    companion: bool = False
    attrs: dict[str, Any] = field(default_factory=dict)


def _epoch(year: int, month: int = 1, day: int = 1) -> float:
    return datetime(year, month, day, tzinfo=UTC).timestamp()


def _v(name: str, *sources: str, **given) -> VariableSpec:
    return VariableSpec(name, sources, **given)


#: The core variables with their sensors, conversions and valid ranges.
CORE = (
    _v("time", "m_present_time", "sci_m_present_time", valid_min=_epoch(2000), valid_max=_epoch(2040), track_qc=True, dtype=None, units="seconds since 1970-01-01T00:00:00Z"),
    _v("lat", "m_lat", conversion="dpm_to_dd", valid_min=-90, valid_max=90, track_qc=True, interpolate_missing=True, max_gap=600, units="degrees_north"),
    _v("lon", "m_lon", conversion="dpm_to_dd", valid_min=-180, valid_max=180, track_qc=True, interpolate_missing=True, max_gap=600, units="degrees_east"),
    _v("lat_gps", "m_gps_lat", conversion="dpm_to_dd", valid_min=-90, valid_max=90, drop_from_l2=True, drop_from_l3=True, anchor=True, units="degrees_north"),
    _v("lon_gps", "m_gps_lon", conversion="dpm_to_dd", valid_min=-180, valid_max=180, drop_from_l2=True, drop_from_l3=True, anchor=True, units="degrees_east"),
    _v("m_depth", "m_depth", valid_min=0, valid_max=2000, drop_from_l2=True, dtype=None, units="m"),
    _v("pressure", "sci_water_pressure", conversion="bar_to_dbar", valid_min=0, valid_max=2000, track_qc=True, interpolate_missing=True, units="dbar"),
    _v("conductivity", "sci_water_cond", valid_min=0.1, valid_max=10, track_qc=True, interpolate_missing=True, units="S m-1"),
    _v("temperature", "sci_water_temp", valid_min=-5, valid_max=50, track_qc=True, interpolate_missing=True, units="degree_Celsius"),
    _v("pitch", "m_pitch", conversion="rad_to_deg", valid_min=-180, valid_max=180, interpolate_missing=True, units="degree"),
    _v("roll", "m_roll", conversion="rad_to_deg", valid_min=-180, valid_max=180, interpolate_missing=True, units="degree"),
)
#: Suites of further variables, by name.
SUITES = {
    "flight": (
        _v("heading", "m_heading", conversion="rad_to_deg", valid_min=0, valid_max=360, interpolate_missing=True, units="degree"),
        _v("battpos", "m_battpos", interpolate_missing=True, units="inch"),
        _v("fin", "m_fin", conversion="rad_to_deg", units="degree"),
        _v("ballast_pumped", "m_de_oil_vol", units="cm3"),
    ),
    "thermo": (
        _v("salinity", valid_min=0, valid_max=40, track_qc=True, units="1"),
        _v("SA", valid_min=0, valid_max=40, track_qc=True, units="g kg-1"),
        _v("z", valid_min=-2000, valid_max=0, track_qc=True, units="m"),
        _v("CT", valid_min=-5, valid_max=50, track_qc=True, units="degree_Celsius"),
        _v("density", valid_min=1015, valid_max=1040, track_qc=True, units="kg m-3"),
        _v("rho0", valid_min=1015, valid_max=1040, track_qc=True, units="kg m-3"),
        _v("depth", valid_min=0, valid_max=2000, track_qc=True, units="m"),
        _v("sound_speed", valid_min=1400, valid_max=1600, track_qc=True, units="m s-1"),
        _v("N2", track_qc=True, units="s-2"),
    ),
    "flight_model": (
        _v("speed_through_water", units="m s-1"),
        _v("vertical_glider_velocity", units="m s-1"),
        _v("vertical_water_velocity", units="m s-1"),
        _v("angle_of_attack", units="degree"),
    ),
}


class ConfigError(ValueError):
    """A configuration that can't be used."""


@dataclass(frozen=True)
class Config:
    variables: dict[str, VariableSpec]
    trajectory: str = "trajectory"
    global_attributes: dict[str, Any] = field(default_factory=dict)
    include: dict[str, bool] = field(default_factory=dict)
    flight: dict[str, Any] = field(default_factory=dict)
    sections: dict[str, Any] = field(default_factory=dict)

    def by_source(self) -> dict[str, VariableSpec]:
        """Sensor -> variable; of two that name one sensor the later one holds."""
        return {s: v for v in self.variables.values() for s in v.sources}


def utc_epoch(when: datetime | date) -> float:
    """Seconds since 1970 in UTC; a time without a zone is in UTC."""
    if not isinstance(when, datetime):
        when = datetime(when.year, when.month, when.day)
    return (when if when.tzinfo else when.replace(tzinfo=UTC)).timestamp()


def parse_user_config(path: str | Path) -> dict[str, Any]:
    """The sections of a YAML file; an error unless it is one mapping with all of them."""
    import yaml

    try:
        documents = list(yaml.safe_load_all(Path(path).read_text()))
    except yaml.YAMLError as e:
        raise ConfigError(f"{path} is not YAML: {e}") from e
    if len(documents) != 1:
        raise ConfigError(f"{path} holds {len(documents)} documents; it has to hold one")
    if not isinstance(documents[0], dict):
        raise ConfigError(f"{path} is not a mapping")
    if missing := [s for s in SECTIONS if s not in documents[0]]:
        raise ConfigError(f"{path} lacks the sections {', '.join(missing)}")
    return documents[0]


def merge_suites(include: dict[str, bool]) -> dict[str, VariableSpec]:
    """Core variables and those of the suites that aren't switched off."""
    chosen = list(CORE)
    for suite, members in SUITES.items():
        if include.get(suite, True):
            chosen += members
    return {v.name: v for v in chosen}


def apply_overrides(variables: dict[str, VariableSpec], overrides: dict[str, dict[str, Any]] | None) -> dict[str, VariableSpec]:
    """Variables with the user's checks; what isn't known or isn't a check is warned of and left out."""
    out = dict(variables)
    for name, given in (overrides or {}).items():
        if name not in out:
            _log.warning("checks of %s are left out: no such variable", name)
            continue
        known = {k: v for k, v in (given or {}).items() if k in OVERRIDES}
        for k in set(given or {}) - set(known):
            _log.warning("%s of %s is left out: not a check", k, name)
        out[name] = dataclasses.replace(out[name], **known)
    return out


def user_variables(given: dict[str, dict[str, Any]] | None) -> dict[str, VariableSpec]:
    fields = {f.name for f in dataclasses.fields(VariableSpec)}
    out = {}
    for name, spec in (given or {}).items():
        spec = dict(spec or {})
        cf = spec.pop("CF", {}) or {}
        source = spec.pop("source", ())
        spec["companion"] = bool(spec.pop("companion_dim", None))
        known = {k: v for k, v in spec.items() if k in fields and k not in ("name", "sources")}
        for bound in ("valid_min", "valid_max"):
            if bound in cf:
                known[bound] = utc_epoch(cf[bound]) if isinstance(cf[bound], date) else cf[bound]
        out[name] = VariableSpec(name, (source,) if isinstance(source, str) else tuple(source), attrs=cf, units=cf.get("units"), **known)
    return out


def load_config(path: str | Path | None = None) -> Config:
    """The configuration of a file, or the built-in one."""
    user = parse_user_config(path) if path else dict.fromkeys(SECTIONS)
    include = user.get("include") or {}
    variables = apply_overrides(merge_suites(include), user.get("qc"))
    for name, spec in user_variables(user.get("l1_variables")).items():
        if name in variables:
            _log.warning("the variable %s is left out: it is one of the core", name)
        else:
            variables[name] = spec
    trajectory = (user.get("trajectory") or {}).get("name", "trajectory")
    return Config(variables, trajectory, {k: v for k, v in (user.get("netcdf_attributes") or {}).items() if v is not None}, include, user.get("flight") or {}, user)


DEFAULT_YAML = """\
globals: {}
include: {flight: true, thermo: true, flight_model: false}
trajectory: {name: trajectory}
netcdf_attributes: {}
qc: {}
l1_variables: {}
flight: {}
"""


def write_default(path: str | Path) -> None:
    Path(path).write_text(DEFAULT_YAML)
