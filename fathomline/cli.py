"""Command line: the dataflows over files. python -m fathomline <command> --help"""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import __version__
from .durable import cut
from .operators import timeseries as ts
from .plans import config as cfg
from .plans import pipeline
from .sources import level1, matfile, sinks
from .sources.level1 import Level
from .sources.netcdf_source import write_netcdf

_log = logging.getLogger(__name__)


def session() -> SparkSession:
    return SparkSession.builder.appName("fathomline").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def _raw(spark, pairs, config):
    parts = [level1.read_raw(spark, list(p), config.trajectory) for p in zip(*pairs)]
    return parts[0], parts[1]


def l1b(a, spark):
    """One raw table, formatted and checked."""
    config = cfg.load_config(a.config)
    sinks.write_level(Level(pipeline.l1b(level1.read_raw(spark, level1.list_paths(spark, a.file), config.trajectory), config), attrs=config.global_attributes), a.out)


def l2(a, spark):
    """Flight and science tables, merged and labelled; and, if asked, tables of profiles and of pings."""
    config = cfg.load_config(a.config)
    raw = _raw(spark, level1.pair_input_files(spark, a.flight, a.science, a.skip_unpaired), config)
    level = pipeline.l2(*raw, config, a.shallowest, a.surface_time)
    sinks.write_level(level, a.out)
    if a.profiles:
        done = level1.read_level(spark, a.out)
        emit = sinks.emit_profile_files if a.profile_files else sinks.emit_profiles
        glider = a.glider or config.trajectory.rsplit("_", 1)[-1]
        more = {"attrs": config.global_attributes} if a.profile_files else {}  # a table's attributes are its columns' metadata
        _log.info("%d profiles written", emit(done.obs, done.uv, pipeline.BY, a.profiles, glider, config.sections.get("instruments"), a.force, **more))
    if a.pings:
        rows = raw[1].withColumn("time", F.col("sci_m_present_time")).where("time IS NOT NULL")
        if a.ping_positions:
            track = level1.read_level(spark, a.out).obs
            have = [c for c in ("depth", "lat", "lon") if c in track.columns]
            rows = ts.interp_join(rows.drop(*have), track.select(*pipeline.BY, "time", *(F.col(c).cast("double").alias(c) for c in have)), have, pipeline.BY, skip_nulls=True)
        pings = sinks.ping_table(rows, pipeline.BY, a.ping_positions)
        if pings is not None:
            sinks.write_csv(pings, a.pings)


def l3(a, spark):
    """A merged table averaged by depth, with turbulence if a file of it is given."""
    config = cfg.load_config(a.config)
    cells, facts = pipeline.l3(level1.read_level(spark, a.file), config, a.bin, a.depth)
    if a.turbulence:
        cells = pipeline.merge_turbulence(cells, facts, level1.read_turbulence(spark, a.turbulence), a.bin)
    sinks.write_level(Level(cells, None, facts, config.global_attributes), a.out)


def merge(a, spark):
    """Turbulence merged into binned profiles; a product that is there stays unless told to overwrite it."""
    if not a.overwrite and level1.list_paths(spark, a.out):
        raise FileExistsError(f"{a.out} is there; --overwrite replaces it")
    if a.kind != "q":
        raise NotImplementedError("only files of the kind q can be merged")
    level = level1.read_level(spark, a.file)
    if level1.product_level(set(level.obs.columns)) != 3:
        raise NotImplementedError("turbulence is merged into binned profiles only")
    cells = pipeline.merge_turbulence(level.obs, level.uv, level1.read_turbulence(spark, a.turbulence), level1.bin_size(level.obs))
    if a.out == a.file:
        cells, level.uv = cut(cells), cut(level.uv)  # they are read from where they will be written
    sinks.write_level(Level(cells, None, level.uv, level.attrs), a.out)


def hot(a, spark):
    """Temperature and conductivity as structures of a MATLAB file."""
    matfile.write_channels(sinks.channel_table(level1.read_level(spark, a.file).obs), a.out)


def gps(a, spark):
    """The track, or the fixes, as CSV."""
    from .operators.gps import gps_track

    level = level1.read_level(spark, a.file)
    if a.fixes and level.gps is None:
        raise ValueError(f"{a.file} has no table of fixes")
    sinks.write_csv(level.gps.orderBy("time_gps") if a.fixes else gps_track(level.obs).orderBy("time"), a.out)


#: Tables of a product by the dimension they lie over.
DIMENSIONS = {"time": "obs", "time_gps": "gps", "time_uv": "uv"}


def concat(a, spark):
    """Products one after another along a dimension; the tables of other dimensions and attributes are the first's."""
    levels = [level1.read_level(spark, f) for f in a.files]
    join = lambda parts: level1.union_segments(kept) if (kept := [p for p in parts if p is not None]) else None
    along = set(DIMENSIONS.values()) if a.concat_dim == "all" else {DIMENSIONS[a.concat_dim]}
    tables = {t: join(getattr(x, t) for x in levels) if t in along else getattr(levels[0], t) for t in DIMENSIONS.values()}
    sinks.write_level(Level(tables["obs"], tables["gps"], tables["uv"], levels[0].attrs), a.out)


def flight(a, spark):
    """The flight model's columns, with parameters fitted first."""
    if a.inplace == bool(a.out):
        raise ValueError("either --inplace or --out")
    level, params = pipeline.fly(level1.read_level(spark, a.file), cfg.load_config(a.config), not a.no_fit)
    _log.info("parameters: %s", params)
    if a.inplace:
        level.obs = cut(level.obs)  # it is read from where it will be written
        level.gps, level.uv = (cut(x) if x is not None else None for x in (level.gps, level.uv))
    sinks.write_level(level, a.out or a.file)


def netcdf_export(a, spark):
    """The samples of a product as NetCDF classic files in a folder, in order of time."""
    level = level1.read_level(spark, a.file)
    write_netcdf(level.obs.repartitionByRange("time").sortWithinPartitions("time"), a.out, level.attrs)


def default_config(a, spark):
    """The default configuration."""
    cfg.write_default(a.out)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser("fathomline")
    p.add_argument("--version", action="version", version=__version__)
    p.add_argument("--log-level", default="WARNING")
    p.add_argument("--log-file")
    commands = p.add_subparsers(dest="command", required=True)

    def add(name, run, *args):
        c = commands.add_parser(name, help=run.__doc__)
        c.set_defaults(run=run)
        for flags, given in args:
            c.add_argument(*flags, **given)

    out, file, config = (("-o", "--out"), {"required": True}), (("file",), {}), (("-c", "--config"), {})
    on = {"action": "store_true"}
    add("l1b", l1b, file, out, config)
    add("l2", l2, (("flight",), {}), (("science",), {}), out, config, (("--shallowest",), {"type": float, "default": 5.0}), (("--surface-time",), {"type": float, "default": 180.0}), (("--skip-unpaired",), on), (("--profiles",), {}), (("--profile-files",), {**on, "help": "profiles as NetCDF files"}), (("-g", "--glider"), {}), (("--force",), on), (("--pings",), {}), (("--ping-positions",), on))
    add("l3", l3, file, out, config, (("-b", "--bin"), {"type": float, "default": 10.0}), (("-d", "--depth"), {"type": float}), (("-q", "--turbulence"), {}))
    add("merge", merge, file, (("turbulence",), {}), (("kind",), {"choices": ["q", "p"]}), out, (("-w", "--overwrite"), on))
    add("hot", hot, file, out)
    add("gps", gps, file, out, (("--fixes",), on))
    add("concat", concat, (("files",), {"nargs": "+"}), out, (("-d", "--concat-dim"), {"choices": [*DIMENSIONS, "all"], "default": "all"}))
    add("flight", flight, file, (("-o", "--out"), {}), (("--inplace",), on), (("--no-fit",), on), config)
    add("netcdf", netcdf_export, file, out)
    add("cfg", default_config, out)
    return p


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    logging.basicConfig(level=a.log_level.upper(), filename=a.log_file)
    _log.debug("%s", vars(a))
    a.run(a, None if a.command == "cfg" else session())
    return 0


if __name__ == "__main__":
    sys.exit(main())
