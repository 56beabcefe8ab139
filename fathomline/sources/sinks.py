"""Sinks: products as Parquet with attributes beside, one table or NetCDF file for each profile, CSV, channel tables."""

from __future__ import annotations

import json
import uuid
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import cut
from ..functions.units import epoch_stamp
from ..operators import profiles as pr
from ..operators import timeseries as ts
from ..operators.quality import any_nonzero
from .level1 import Level, list_paths
from .netcdf import encode

#: Sensors of an acoustic ping, and the names of the export's columns in their order.
PING_SENSORS = (
    "sr_ping_epoch_days",
    "sr_ping_secs",
    "sr_ping_msecs",
    "sr_ping_rt_msecs",
    "sr_ping_freq",
    "sr_ping_detection_level",
    "sr_ping_sequence_number",
    "sr_ping_platform_id",
    "sr_ping_slot",
    "sr_ping_group",
    "sr_platform_state",
)
PING_COLUMNS = {
    "sr_ping_rt_msecs": "rtMsecs",
    "sr_ping_freq": "freq",
    "sr_ping_detection_level": "detectionLevel",
    "sr_ping_sequence_number": "sequenceNumber",
    "sr_ping_group": "group",
    "sr_ping_slot": "slot",
    "sr_ping_platform_id": "platformId",
    "sr_platform_state": "platformState",
}
PING_PREFIX, PING_NUMBER = "$riotData", 65535
#: Fixed value: what stands for no integer in a profile's structural fields.
INT_FILL = -2147483647


# Attributes of a profile file's structural fields.
CRS = {
    "epsg_code": "EPSG:4326",
    "grid_mapping_name": "latitude_longitude",
    "inverse_flattening": 298.257223563,
    "long_name": "http://www.opengis.net/def/crs/EPSG/0/4326",
    "semi_major_axis": 6378137.0,
}
PLATFORM = {"ancillary_variables": " ", "comment": "Autonomous vehicle", "long_name": "platform", "type": "platform"}
PROFILE_FIELDS = {
    "profile_time": {
        "axis": "T",
        "calendar": "gregorian",
        "comment": "Timestamp corresponding to the mid-point of the profile",
        "long_name": "Profile Center Time",
        "observation_type": "calculated",
        "platform": "platform",
        "standard_name": "time",
        "units": "seconds since 1970-01-01T00:00:00Z",
    },
    "profile_lat": {
        "axis": "Y",
        "comment": "Value is interpolated to provide an estimate of the latitude at the mid-point of the profile",
        "long_name": "Profile Center Latitude",
        "observation_type": "calculated",
        "platform": "platform",
        "standard_name": "latitude",
        "units": "degrees_north",
        "valid_max": 90.0,
        "valid_min": -90.0,
    },
    "profile_lon": {
        "axis": "X",
        "comment": "Value is interpolated to provide an estimate of the longitude at the mid-point of the profile",
        "long_name": "Profile Center Longitude",
        "observation_type": "calculated",
        "platform": "platform",
        "standard_name": "longitude",
        "units": "degrees_east",
        "valid_max": 180.0,
        "valid_min": -180.0,
    },
}


def platform_attributes(platform: str, instruments: dict | None) -> dict[str, Any]:
    return PLATFORM | {"id": platform, "instrument": ", ".join(instruments or {}) or " "}


def instrument_attributes(given: Any) -> dict[str, Any]:
    """An instrument's attributes as the configuration has them; a plain text describes it."""
    return dict(given) if isinstance(given, dict) else {"description": str(given)}


def write_level(level: Level, path: str, mode: str = "overwrite", partition: str | None = None) -> None:
    for name, df in (("obs", level.obs), ("gps", level.gps), ("uv", level.uv)):
        if df is not None:
            writer = df.write.mode(mode)
            (writer.partitionBy(partition) if partition else writer).parquet(f"{path}/{name}")
    attrs = {k: v for k, v in level.attrs.items() if v is not None}
    level.obs.sparkSession.createDataFrame([(json.dumps(attrs, default=str),)], "value string").coalesce(1).write.mode(mode).text(f"{path}/attrs")


def profile_tables(obs: DataFrame, uv: DataFrame, by: list[str], platform: str, instruments: dict[str, str] | None = None) -> DataFrame:
    """Samples of the profiles that are complete, with their velocity and structural fields and a name for each table."""
    ready = pr.profile_velocities(obs, uv, by)
    rows = obs.where("profile_id >= 0").drop("dive_id", "climb_id", "state", "u", "v")
    scalars = rows.groupBy(*by, "profile_id").agg(F.avg("time").alias("profile_time"), F.avg("lat").alias("profile_lat"), F.avg("lon").alias("profile_lon"), F.min("time").alias("__first"))
    named = scalars.withColumn("profile_key", F.concat_ws("_", F.lit(platform), epoch_stamp(F.col("__first")))).drop("__first")
    out = rows.join(named, [*by, "profile_id"]).join(ready, [*by, "profile_id"])
    fill = F.lit(INT_FILL)
    out = out.withColumns({"profile_id": F.col("profile_id").cast("int"), "platform": fill, "crs": fill, **{f"instrument_{n}": fill for n in instruments or {}}})
    attrs = {"platform": platform_attributes(platform, instruments), "crs": CRS, **PROFILE_FIELDS, **{f"instrument_{n}": instrument_attributes(d) for n, d in (instruments or {}).items()}}
    for column, given in attrs.items():
        out = out.withMetadata(column, given)
    return out


def missing_profiles(rows: DataFrame, listed: DataFrame | None) -> DataFrame:
    """The rows whose profile_key isn't listed."""
    return rows if listed is None else rows.join(listed.select("profile_key").distinct(), "profile_key", "left_anti")


def emit_profiles(obs: DataFrame, uv: DataFrame, by: list[str], path: str, platform: str, instruments: dict[str, str] | None = None, force: bool = False) -> int:
    """Writes each complete profile to <path>/profile_key=<name>; those that are there stay unless force. How many.

    Without labels or velocities nothing is written.
    """
    if uv is None or not {"profile_id", "state"} <= set(obs.columns):
        return 0
    spark = obs.sparkSession
    rows = profile_tables(obs, uv, by, platform, instruments)
    if not force and list_paths(spark, f"{path}/profile_key=*"):
        rows = missing_profiles(rows, spark.read.parquet(path))
    rows = cut(rows)
    # a profile is a table of its own, so its rows come together; profiles are many and small
    number = rows.select("profile_key").distinct().count()
    if number:
        writer = rows.repartition("profile_key").sortWithinPartitions("profile_key", "time").write.partitionBy("profile_key")
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    return number


def emit_profile_files(obs: DataFrame, uv: DataFrame, by: list[str], path: str, platform: str, instruments: dict[str, str] | None = None, force: bool = False, attrs: dict | None = None) -> int:
    """Writes each complete profile as a NetCDF classic file <path>/<name>.nc; those that are there stay unless force.

    Samples lie over time; profile_id, profile_time, profile_lat, profile_lon, time_uv, lat_uv, lon_uv, u, v, platform,
    crs and the instruments are scalars. Executors write, each file under another name first. How many were written.
    """
    if uv is None or not {"profile_id", "state"} <= set(obs.columns):
        return 0
    spark = obs.sparkSession
    rows = profile_tables(obs, uv, by, platform, instruments)
    if not force and list_paths(spark, f"{path}/*.nc"):
        there = spark.read.format("binaryFile").option("pathGlobFilter", "*.nc").load(path)  # names only are read
        rows = missing_profiles(rows, there.select(F.regexp_extract("path", r"([^/]+)\.nc$", 1).alias("profile_key")))
    given = {f.name: {k: v for k, v in (f.metadata or {}).items() if isinstance(v, (str, int, float))} for f in rows.schema}
    scalar = [c for c in rows.columns if c in {"profile_id", "profile_time", "profile_lat", "profile_lon", "time_uv", "lat_uv", "lon_uv", "u", "v"}]
    marks = {"platform": platform_attributes(platform, instruments), "crs": CRS, **{n: instrument_attributes(d) for n, d in (instruments or {}).items()}}
    marks = {n: {"_FillValue": np.int32(INT_FILL), **a} for n, a in marks.items()}
    left_out = {*by, "profile_key", *scalar, *marks, *(f"instrument_{n}" for n in instruments or {})}
    numeric = [c for c, t in rows.dtypes if t in ("double", "float", "int", "smallint", "tinyint", "bigint") and c not in left_out]

    def put(pdf: pd.DataFrame) -> pd.DataFrame:
        from pyarrow import fs

        pdf = pdf.sort_values("time", kind="stable")
        columns = {c: pdf[c].to_numpy(float, na_value=np.nan) if pdf[c].dtype.kind != "i" else pdf[c].to_numpy() for c in numeric}
        scalars = {c: np.int32(pdf[c].iloc[0]) if c == "profile_id" else float(pdf[c].iloc[0]) for c in scalar} | {n: np.int32(0) for n in marks}
        key = pdf["profile_key"].iloc[0]
        data = encode(columns, attrs, "time", given | marks, scalars)
        store, folder = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
        store.create_dir(folder, recursive=True)
        part = f"{folder}/.{key}.{uuid.uuid4().hex}"
        with store.open_output_stream(part) as out:
            out.write(data)
        store.move(part, f"{folder}/{key}.nc")
        return pd.DataFrame({"profile_key": [key], "bytes": [len(data)]})

    return rows.groupBy("profile_key").applyInPandas(put, "profile_key string, bytes long").agg(F.count("*")).first()[0]


def ping_filter(df: DataFrame) -> DataFrame:
    return df.where(any_nonzero(PING_SENSORS))


def ping_columns(df: DataFrame) -> list[Column]:
    """The export's columns; parts of a time are cut to integers."""
    whole = lambda c: F.col(c).cast("bigint")
    at = whole("sr_ping_epoch_days") * 86_400_000 + whole("sr_ping_secs") * 1000 + whole("sr_ping_msecs")
    return [F.lit(PING_PREFIX).alias("riotDataPrefix"), at.alias("epochMsecs"), *(whole(s).alias(c) for s, c in PING_COLUMNS.items()), F.lit(PING_NUMBER).alias("recNumInFile")]


def ping_positions(df: DataFrame, by: list[str]) -> DataFrame:
    """Rows with depth, lat and lon interpolated over the rows that have them; depth 0 counts as missing.

    lat and lon are taken together. A missing column gives three columns of nulls.
    """
    if not {"depth", "lat", "lon"} <= set(df.columns):
        return df.drop("depth", "lat", "lon").withColumns({c: F.lit(None).cast("double") for c in ("depth", "lat", "lon")})
    clean = df.withColumn("depth", F.when(F.col("depth") != 0, F.col("depth")))
    both = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    clean = clean.withColumns({"lat": F.when(both, F.col("lat")), "lon": F.when(both, F.col("lon"))})
    out = ts.fill_gaps(clean, {"depth": None, "lat": None, "lon": None}, by)
    return out.drop("depth_filled", "lat_filled", "lon_filled")


def ping_table(df: DataFrame, by: list[str], positions: bool = False) -> DataFrame | None:
    """The export's rows in order of time; None where a sensor is missing or no row counts."""
    if not set(PING_SENSORS) <= set(df.columns):
        return None
    kept = ping_filter(df)
    if kept.isEmpty():
        return None
    extra = ["depth", "lat", "lon"] if positions else []
    kept = ping_positions(kept, by) if positions else kept
    return kept.orderBy(*by, "time").select(*ping_columns(kept), *extra)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header in a folder, replacing what was there."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def channel_table(obs: DataFrame, channels: dict[str, str] | None = None) -> DataFrame:
    """(channel, time, data): the samples of some columns, one below the other."""
    channels = channels or {"ctd_temp": "temperature", "ctd_cond": "conductivity"}
    parts = F.array(*(F.struct(F.lit(n).alias("channel"), F.col("time"), F.col(c).cast("double").alias("data")) for n, c in channels.items()))
    return obs.select(F.inline(parts))
