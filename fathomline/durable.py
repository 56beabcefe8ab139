"""Cuts of lineage: rows written to the folder that driver and executors share, and read from there."""

from __future__ import annotations

import tempfile
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in spark.checkpoint.dir.

    A session on one machine that names none (tests) gets a temporary one. On a cluster that is an error, as executors
    don't see each other's folders.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    current = context._jsc.sc().getCheckpointDir()
    if not current.isDefined():
        if not named and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="fathomline-"))
    return named or context._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from the shared folder: later stages don't depend on any executor's disk.

    The written rows go when nothing refers to them any more, if spark.cleaner.referenceTracking.cleanCheckpoints is on.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_all(*frames: DataFrame) -> list[DataFrame]:
    """cut() of several frames, whose jobs run side by side."""
    shared_dir(frames[0].sparkSession)
    with ThreadPoolExecutor(len(frames)) as pool:
        return list(pool.map(cut, frames))
