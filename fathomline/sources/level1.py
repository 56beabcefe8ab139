"""Readers: raw flight and science tables, products of any level, turbulence files.

Paths may be in any store that Spark reads; listings go through Spark's own file systems.
"""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import missing_to_null
from .netcdf_source import read_netcdf

#: Kinds of raw files by their extension.
KINDS = {"sbd": "flight", "dbd": "flight", "tbd": "science", "ebd": "science"}
_NAME = re.compile(r"([^/]+)\.(sbd|dbd|tbd|ebd)\.(nc|csv|parquet)$")


@dataclass
class Level:
    """A product: samples, and tables of fixes and of velocities, with attributes."""

    obs: DataFrame
    gps: DataFrame | None = None
    uv: DataFrame | None = None
    attrs: dict[str, Any] = field(default_factory=dict)


class PairingError(ValueError):
    """Raw files that can't be paired."""


def classify(path: str) -> tuple[str, str]:
    """(kind, stem) of a raw file's name; an error for any other name."""
    if not (m := _NAME.search(path)):
        raise PairingError(f"{path} is not named <stem>.(sbd|dbd|tbd|ebd).(nc|csv|parquet)")
    return KINDS[m[2]], m[1]


def list_paths(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(s.getPath().toString() for s in found) if found else []


def pair_names(flight: list[str], science: list[str], skip_unpaired: bool = False) -> list[tuple[str, str]]:
    """Pairs of flight and science files of one stem, in order of stems."""
    sides = []
    for kind, paths in (("flight", flight), ("science", science)):
        if not paths:
            raise PairingError(f"no {kind} file matches")
        by_stem: dict[str, str] = {}
        for p in paths:
            found, stem = classify(p)
            if found != kind:
                raise PairingError(f"{p} is not a {kind} file")
            if stem in by_stem:
                raise PairingError(f"two {kind} files of {stem}")
            by_stem[stem] = p
        sides.append(by_stem)
    left, right = sides
    if (alone := sorted(left.keys() ^ right.keys())) and not skip_unpaired:
        raise PairingError(f"without a partner: {', '.join(alone)}")
    both = sorted(left.keys() & right.keys())
    if not both:
        raise PairingError("no flight file has a science file of its stem")
    return [(left[s], right[s]) for s in both]


def pair_input_files(spark: SparkSession, flight: str, science: str, skip_unpaired: bool = False) -> list[tuple[str, str]]:
    return pair_names(list_paths(spark, flight), list_paths(spark, science), skip_unpaired)


def pair_table(files: DataFrame, path: str = "path") -> DataFrame:
    """(stem, flight, science) of a table of paths, by a full join; a side without a file is null."""
    pattern = r"([^/]+)\.(sbd|dbd|tbd|ebd)\.(nc|csv|parquet)$"
    named = files.select(path, F.regexp_extract(path, pattern, 1).alias("stem"), F.regexp_extract(path, pattern, 2).alias("ext"))
    side = lambda kind: named.where(F.col("ext").isin(*(e for e, k in KINDS.items() if k == kind))).groupBy("stem").agg(F.min(path).alias(kind))
    return side("flight").join(side("science"), "stem", "full_outer")


def place(path: Column) -> Column:
    """A file's place in one spelling: decoded, and with one slash after the scheme."""
    plain = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(F.when(plain.startswith("/"), F.concat(F.lit("file:"), plain)).otherwise(plain), r"^([A-Za-z][A-Za-z0-9+.-]*:)/+", "$1/")


def file_order(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, file_ord): the files' places in their order; the files of a folder have the folder's."""
    each = [(f, k) for k, p in enumerate(paths) for f in (list_paths(spark, f"{p}/*.parquet") if p.endswith("parquet") else ()) or (p,)]
    escaped = [(p.replace("%", "%25"), k) for p, k in each]
    return spark.createDataFrame(escaped, "path string, file_ord int").select(place(F.col("path")).alias("__path"), "file_ord")


def csv_headers(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Header line -> the files that begin with it. Headers are few; files of one header are read by one scan."""
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("line"))
    first = lines.where("at = 0").groupBy("path").agg(F.min_by("value", "line").alias("header"))
    by_place = {r[0]: r[1] for r in first.select(place(F.col("path")), "header").collect()}
    named = {r.file_ord: r[0] for r in file_order(spark, paths).collect()}
    out: dict[str, list[str]] = {}
    for k, p in enumerate(paths):
        if (header := by_place.get(named[k])) is not None:  # an empty file has no rows
            out.setdefault(header, []).append(p)
    return out


def _doubles(df: DataFrame, i: Column) -> DataFrame:
    """Columns as doubles, with the row's number i in its file and the file's place."""
    i = F.col("i") if "i" in df.columns else i
    file = F.replace("file", F.lit("%"), F.lit("%25")) if "file" in df.columns else F.col("_metadata.file_path")
    columns = [F.col(f"`{c}`").cast("double").alias(c) for c in df.columns if c not in ("i", "j", "file")]
    return df.select(i.cast("long").alias("i"), place(file).alias("__path"), *columns)


def read_raw(spark: SparkSession, paths: list[str] | str, trajectory: str | None = None) -> DataFrame:
    """Raw tables, one after another: all columns as doubles, with the file's place in the list and the row's (file_ord, i).

    One scan for all Parquet files, one for all NetCDF files and one for the CSV files of each header, however many files
    there are; the order of files is a small table joined by their paths. What a file lacks is null, NaN becomes null,
    and so does what is no number. i is the row's number in a Parquet or NetCDF file; in a CSV file it only rises along
    the file. A column i of the file's own is taken instead.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    kinds = {k: [p for p in paths if p.endswith(f".{k}")] for k in ("csv", "nc")}
    rest = [p for p in paths if p not in {*kinds["csv"], *kinds["nc"]}]
    parts = []
    # rows of a split come in order, and splits begin at greater bytes
    rising = F.shiftleft(F.col("_metadata.file_block_start"), 28) + F.monotonically_increasing_id().bitwiseAND((1 << 28) - 1)
    for header, files in csv_headers(spark, kinds["csv"]).items() if kinds["csv"] else ():
        names = next(csv.reader([header.lstrip("\ufeff").rstrip("\r")]))
        schema = T.StructType([T.StructField(n, T.DoubleType()) for n in names])
        parts.append(_doubles(spark.read.option("header", True).schema(schema).csv(files), rising))
    if kinds["nc"]:
        parts.append(_doubles(read_netcdf(spark, kinds["nc"]), F.col("i")))
    if rest:
        parts.append(_doubles(spark.read.option("mergeSchema", True).parquet(*rest), F.col("_metadata.row_index")))
    out = union_segments(parts).join(file_order(spark, paths), "__path").drop("__path")
    out = missing_to_null(out.select("file_ord", "i", *(c for c in out.columns if c not in ("file_ord", "i"))))
    return out.withColumn("trajectory", F.lit(trajectory)) if trajectory is not None else out


def union_segments(parts: list[DataFrame]) -> DataFrame:
    """Tables one after another, by name; what one lacks is null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def read_level(spark: SparkSession, path: str) -> Level:
    """A product that write_level() wrote."""
    import json

    tables = {p.rstrip("/").rsplit("/", 1)[-1] for p in list_paths(spark, f"{path}/*")}
    get = lambda t: spark.read.parquet(f"{path}/{t}") if t in tables else None
    attrs = json.loads("".join(r.value for r in spark.read.text(f"{path}/attrs").collect())) if "attrs" in tables else {}
    return Level(get("obs"), get("gps"), get("uv"), attrs)


def read_turbulence(spark: SparkSession, path: str, columns: tuple[str, ...] = ("e_1", "e_2", "pressure")) -> DataFrame:
    """Only the time and the columns named, of Parquet or of NetCDF files; path may be a pattern of those."""
    files = [p for p in list_paths(spark, path) if p.endswith(".nc")]
    if files:
        return missing_to_null(read_netcdf(spark, files, ["time", *columns]))
    return missing_to_null(spark.read.parquet(path).select("time", *columns))


def product_level(columns: set[str]) -> int:
    """2 for samples over time, 3 for profiles over bins; an error otherwise."""
    if {"profile_id", "bin"} <= columns:
        return 3
    if "time" in columns and "bin" not in columns:
        return 2
    raise ValueError("neither samples nor binned profiles")


def bin_size(bins: DataFrame, depth: str = "depth") -> float:
    """The distance of the first two bins."""
    first = [r[0] for r in bins.select(depth).distinct().orderBy(depth).limit(2).collect()]
    return first[1] - first[0] if len(first) == 2 else 2 * first[0]
