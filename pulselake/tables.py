"""Long-format relations of the engine over the input tables (DataFrame forms)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ORIGIN_US = 1704067200000000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """track_id, stem, v, us, t (hours from the origin), event_id."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return load(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("track_id"), F.col("event_type").alias("stem"), F.col("value").alias("v"), us.alias("us"), ((us - ORIGIN_US) / 3.6e9).alias("t"))


def frames(spark: SparkSession, sf_dir: str, by_stem: bool = True) -> DataFrame:
    """Events as frames 0, 1, ... of each stream: of a track and stem, or of a whole track."""
    keys = ["track_id", "stem"] if by_stem else ["track_id"]
    order = Window.partitionBy(*keys).orderBy("us", "event_id")
    return events(spark, sf_dir).withColumn("i", (F.row_number().over(order) - 1).cast("long"))
