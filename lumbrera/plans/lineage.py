"""Cutting lineage durably, spreading work and shipping the package to executors."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Tables written by each settled() that runs.
_WRITTEN: list[list[DataFrame]] = []
#: Seconds between collections of the driver's garbage, on which the deletion of shuffle files waits.
COLLECT_S = 10.0


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only where none is set in local mode. On a cluster
    a folder that other machines can't see would lose what was cut, so there it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = found.get() if found.isDefined() else None
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="lumbrera-")
        spark.sparkContext.setCheckpointDir(base)
    return base


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the driver ends."""
    sc = spark.sparkContext
    path = f"{shared_dir(spark).rstrip('/')}/lumbrera/{sc.applicationId}/{label}-{uuid.uuid4().hex[:10]}"
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(hpath)
    return path


def cut(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` as a table to the shared folder and reads it back: the plan behind it ends there and a lost
    executor costs nothing but the tasks it ran. The files go when the driver ends."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    _tidy(spark)
    table = spark.read.schema(df.schema).parquet(path)
    for written in _WRITTEN:
        written.append(table)
    return table


def settled(make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` returns, cut; the tables that were cut on the way to it are deleted."""
    written: list[DataFrame] = []
    _WRITTEN.append(written)
    try:
        table = cut(make(), label)
    finally:
        _WRITTEN.pop()
    drop(*written[:-1])
    return table


def _tidy(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a plan once the driver has collected it as garbage, which a long chain of
    tables can fill the disk before; so it is done after a table that took its time."""
    sc = spark.sparkContext
    if time.monotonic() - getattr(sc, "_lumbrera_tidied", 0.0) > COLLECT_S:
        gc.collect()
        sc._jvm.System.gc()
        sc._lumbrera_tidied = time.monotonic()


def drop(*tables: DataFrame) -> None:
    """Deletes the files of tables that cut() wrote, as soon as no plan needs them any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/lumbrera/" in folder:
                hpath = sc._jvm.org.apache.hadoop.fs.Path(folder)
                hpath.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hpath, True)


def width(spark: SparkSession, waves: int = 2) -> int:
    """Tasks for a Python-heavy stage: some waves over all cores, or the configured shuffle width if that is more."""
    return max(spark.sparkContext.defaultParallelism * waves, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))


def spread(df: DataFrame, waves: int = 2) -> DataFrame:
    """Even round-robin partitions before an expensive stage over few or uneven input splits."""
    return df.repartition(width(df.sparkSession, waves))


def ship(spark: SparkSession) -> None:
    """Gives executors this package, once per application, for clusters where it isn't installed."""
    sc = spark.sparkContext
    if getattr(sc, "_lumbrera_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = os.path.join(tempfile.mkdtemp(prefix="lumbrera-ship-"), "lumbrera.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(target)
    sc._lumbrera_shipped = True
