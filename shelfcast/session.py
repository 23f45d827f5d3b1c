"""Session settings the package relies on, and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # HotSpot does not compile methods beyond 8000 bytes; let Spark split such a stage instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", **settings: str) -> SparkSession:
    """A local session with the package's settings, for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("shelfcast")
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder named by ``spark.checkpoint.dir``.

    Where it is unset a session whose executors live in the driver's own process, as in tests, gets
    a folder for itself; with any other master, executors could not read each other's files there, so
    an unset folder is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        shared = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_STAGED: list[str] = []


def discard_staged(spark: SparkSession, keep: int = 0) -> None:
    """Delete the staged tables of this process but the first ``keep``; frames that read them end with it."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    for path in _STAGED[keep:]:
        folder = hadoop.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    del _STAGED[keep:]


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session for as long as the block runs."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def end_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of finished writes be deleted now.

    Spark deletes a shuffle's files once the driver's garbage collector has met its plan. A driver that only plans seldom
    collects (by default Spark asks it to every half hour), so the executors' disks hold the shuffles of every step so far. Only
    what nothing refers to any more goes; frames and writers beside this one keep theirs. A plan that has just run goes
    with the second collection.
    """
    spark._jvm.System.gc()
    time.sleep(0.2)
    spark._jvm.System.gc()


def _staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = work_folder(spark, name)
    _STAGED.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a columnar table, so later readers prune columns and a lost executor costs
    a re-read of its splits instead of a recomputation of the whole plan.
    """
    return _staged(df, name)[0]


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``materialise`` for as long as the block runs: the folder is deleted at its end, and frames that read it end with it."""
    frame, path = _staged(df, name)
    end_shuffles(df.sparkSession)
    try:
        yield frame
    finally:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)
        if path in _STAGED:
            _STAGED.remove(path)
