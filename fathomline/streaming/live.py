"""The pipeline's steps over streams: unique times, sessions of reports, depth bins, labels, idempotent output.

Streams carry `ts` (a timestamp), made from the sample's time; a watermark bounds what is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import profiles
from ..operators.bins import bin_number


def with_event_time(df: DataFrame, time: str = "time", late: str = "10 minutes") -> DataFrame:
    return df.withColumn("ts", F.timestamp_seconds(time)).withWatermark("ts", late)


def read_stream(spark: SparkSession, path: str, schema: str, files: int = 32) -> DataFrame:
    """New Parquet files of a folder, some at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def unique_times(stream: DataFrame, by: list[str]) -> DataFrame:
    """The first sample to come of each time, within the watermark."""
    return stream.dropDuplicatesWithinWatermark([*by, "ts"])


def last_reports(stream: DataFrame, by: list[str], values: list[str], gap: str = "600 seconds") -> DataFrame:
    """(by, start, time, values): the last report of each session; a difference beyond the gap begins one."""
    got = stream.groupBy(*by, F.session_window("ts", gap).alias("w")).agg(F.max_by(F.struct("time", *values), "time").alias("r"))
    return got.select(*by, F.col("w.start").alias("start"), "r.*")


def depth_bins(stream: DataFrame, by: list[str], size: float, values: list[str], window: str = "1 hour", depth: str = "depth") -> DataFrame:
    """Means by depth bin in windows of time."""
    k = bin_number(F.col(depth), size)
    return stream.where(F.col(depth) > 0).groupBy(*by, F.window("ts", window).alias("w"), k.alias("bin")).agg(*(F.avg(v).alias(v) for v in values)).select(*by, F.col("w.start").alias("start"), "bin", *values)


def labels(stream: DataFrame, by: list[str], interval: float, shallowest: float = 5.0, surface_time: float = 180.0, duration: float = 600.0, limit: float = 2.0, idle: float = 86400.0) -> DataFrame:
    """(by, time, pressure, state, dive_id, climb_id, profile_id) of a stream (by, time, pressure, ts) with a watermark.

    A series' samples are held until the watermark has passed them, so any order within it is the same. A stretch is
    labelled once the stretch after it is closed, with both neighbours beside it, as the batch does; what remains is
    labelled when the watermark is `idle` seconds past the last sample, and a series that goes on later begins anew, its
    numbers following. interval is the series' sampling interval, which the batch takes from all of its samples. The
    state of a series is some four stretches.
    """
    given = (shallowest, surface_time, duration, limit, interval, 1 << 40)
    kinds = "".join(f"{b} {stream.schema[b].dataType.simpleString()}, " for b in by)
    out_type = f"{kinds}time double, pressure double, state tinyint, dive_id int, climb_id int, profile_id int"

    def told(key: tuple, t: np.ndarray, p: np.ndarray, part: np.ndarray, k: int, before: int) -> tuple[pd.DataFrame, int]:
        near = np.abs(part - k) <= 1
        own = part[near] == k
        state, dive, climb, count = profiles.own_labels(t[near], p[near], None, own, *given)
        number = lambda c: np.where(np.isnan(c), -1, np.nan_to_num(c) + before).astype(np.int32)
        d, c = number(dive), number(climb)
        rows = pd.DataFrame(dict(zip(by, key)) | {"time": t[part == k], "pressure": p[part == k], "state": state, "dive_id": d, "climb_id": c, "profile_id": np.where(d > 0, 2 * d - 1, np.where(c > 0, 2 * c, -1))})
        return rows, before + count

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        t, p, kept, dives = (np.array(state.get[0]), np.array(state.get[1], float), *state.get[2:]) if state.exists else (np.zeros(0), np.zeros(0), 0, 0)
        for pdf in batches:
            t = np.concatenate([t, pdf["time"].to_numpy(float)])
            p = np.concatenate([p, pdf["pressure"].to_numpy(float, na_value=np.nan)])
        order = np.argsort(t, kind="stable")
        t, p = t[order], p[order]
        final = len(t) if state.hasTimedOut else int(np.searchsorted(t, state.getCurrentWatermarkMs() / 1000, "right"))
        starts = profiles.stretch_starts(t[:final], p[:final], shallowest, surface_time, interval)
        part = np.searchsorted(starts, np.arange(final), "right")
        first = 1 if kept else 0  # the first stretch is one that was told before, there for its neighbour
        last = int(part[-1]) if final else -1
        upto = last if state.hasTimedOut else last - 2
        for k in range(first, upto + 1):
            rows, dives = told(key, t[:final], p[:final], part, k, dives)
            yield rows
        if state.hasTimedOut:
            t, p, kept = t[:0], p[:0], 0
        elif upto >= first:
            begin = int(np.searchsorted(part, upto))
            t, p, kept = t[begin:], p[begin:], 1
        state.update((t.tolist(), p.tolist(), kept, dives))
        if len(t):
            state.setTimeoutTimestamp(max(int((t[-1] + idle) * 1000), state.getCurrentWatermarkMs() + 1))

    slim = stream.select(*by, "time", "pressure", "ts")
    return slim.groupBy(*by).applyInPandasWithState(step, out_type, "t array<double>, p array<double>, kept int, dives int", "append", GroupStateTimeout.EventTimeTimeout)


def velocity_groups(stream: DataFrame, by: list[str], gap: float = 600.0) -> DataFrame:
    """(by, group_start, time_uv, lat_uv, lon_uv, u, v) of a stream (by, time, lat, lon, u, v, ts) with a watermark.

    Rows with u and v are reports, the others samples of profiles. The last report of a session, whose reports are at
    most gap apart, holds for the samples since the one before it, as profiles.velocities() has it. Samples that wait for
    their report are a group without velocity; it comes again, under the same group_start (null for a series' first),
    when more of it have come, and once more when its report is known. settled() keeps the last of each. Any order within
    the watermark is the same; the state of a series is what came since its last surfacing.
    """
    kinds = "".join(f"{b} {stream.schema[b].dataType.simpleString()}, " for b in by)
    names = ("t", "lat", "lon", "u", "v")

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = np.array([np.array(x, float) for x in state.get[:5]]) if state.exists else np.zeros((5, 0))
        begin, told = state.get[5:] if state.exists else (None, 0)
        for pdf in batches:
            held = np.hstack([held, np.array([pdf[c].to_numpy(float, na_value=np.nan) for c in ("time", "lat", "lon", "u", "v")])])
        held = held[:, np.argsort(held[0], kind="stable")]
        now = state.getCurrentWatermarkMs() / 1000
        t, report = held[0], np.isfinite(held[3]) & np.isfinite(held[4])
        known = np.flatnonzero(report & (t <= now))
        last = known[np.append(np.diff(t[known]) > gap, True)] if len(known) else known  # of each session
        out = []

        def group(upto: float, u: float | None, v: float | None) -> int:
            of = ~report & (t <= upto) & (t > (-np.inf if begin is None else begin))
            if of.any():
                mean = [float(np.nanmean(x)) if np.isfinite(x).any() else None for x in held[:3, of]]
                out.append((*key, begin, *mean, u, v))
            return int(of.sum())

        for k in last.tolist():
            if t[k] + gap < now:
                group(float(t[k]), float(held[3, k]), float(held[4, k]))
                begin, told = float(t[k]), 0
        if begin is not None:
            held, report = held[:, t > begin], report[t > begin]
            t = held[0]
        waiting = int((~report & (t <= now)).sum())
        if waiting > told:
            told = group(now, None, None)
        state.update((*(x.tolist() for x in held), begin, told))
        if len(t):
            state.setTimeoutTimestamp(max(int((t[-1] + (gap if report.any() else 0)) * 1000) + 1001, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=[*by, "group_start", "time_uv", "lat_uv", "lon_uv", "u", "v"])

    slim = stream.select(*by, "time", "lat", "lon", "u", "v", "ts")
    kept = ", ".join(f"{n} array<double>" for n in names)
    return slim.groupBy(*by).applyInPandasWithState(step, f"{kinds}group_start double, time_uv double, lat_uv double, lon_uv double, u double, v double", f"{kept}, start double, told int", "append", GroupStateTimeout.EventTimeTimeout)


def settled(rows: DataFrame, by: list[str], batch: str = "batch") -> DataFrame:
    """The last that was written of each group of velocity_groups()."""
    values = [c for c in rows.columns if c not in (*by, "group_start", batch)]
    return rows.groupBy(*by, "group_start").agg(F.max_by(F.struct(*values), batch).alias("r")).select(*by, "group_start", "r.*")


def write_idempotent(stream: DataFrame, path: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None, mode: str = "append", once: bool = True) -> StreamingQuery:
    """Each batch replaces its own partition, so one that is run again leaves no rows twice."""

    def put(batch: DataFrame, number: int) -> None:
        rows = prepare(batch) if prepare else batch
        rows.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(put)
    return (writer.trigger(availableNow=True) if once else writer).start()
