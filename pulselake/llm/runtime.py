"""Shared plumbing of the training-data operators: shared folder, written tables, worker caches."""

from __future__ import annotations

import atexit
import gc
import sys
import tempfile
import types
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; a local session without it (tests) gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="pulselake-")
        spark.conf.set("spark.checkpoint.dir", folder)
        atexit.register(_remove_quietly, folder)
    return folder.rstrip("/")


def _remove_quietly(folder: str) -> None:
    import shutil

    shutil.rmtree(folder.removeprefix("file://"), ignore_errors=True)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Rows of a file of a written table of which the number of rows is known to be bounded.
PER_FILE = 100_000


def written(df: DataFrame, label: str, rows: int | None = None, per_file: int = PER_FILE) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back: cuts lineage and survives lost executors.

    With ``rows``, a bound on its rows, small tables do not become a file for every shuffle partition.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    (df if rows is None else df.coalesce(-(-rows // per_file) or 1)).write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._pulselake_path = path
    return out


def drop_written(df: DataFrame) -> None:
    """Remove a table of ``written`` that nothing reads any more."""
    path = getattr(df, "_pulselake_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(df: DataFrame) -> None:
    """Let the shuffle files of finished steps go now, not whenever the driver collects its garbage."""
    gc.collect()
    df.sparkSession._jvm.System.gc()


#: Rows up to which a table of ids is broadcast, checked by a count (16 MB of longs).
MOST_BROADCAST = 1_000_000


def bounded_broadcast(ids: DataFrame) -> DataFrame:
    """The table (written, or cheap to make twice) with a broadcast hint if it holds at most MOST_BROADCAST rows."""
    return F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids


def worker_cache() -> dict:
    """A dict that lives as long as the Python worker (workers are reused over tasks)."""
    name = "_pulselake_worker_cache"
    if name not in sys.modules:
        module = types.ModuleType(name)
        module.store = {}
        sys.modules[name] = module
    return sys.modules[name].store


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
