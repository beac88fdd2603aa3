"""Session settings for this engine."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; cluster settings given from outside are left alone."""
    builder = SparkSession.builder.appName("pulselake")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    if master:
        cores = master[6:-1] if master.startswith("local[") else ""
        builder = builder.master(master)
        settings.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions or (int(cores) if cores.isdigit() else os.cpu_count() or 8)))
    elif shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
