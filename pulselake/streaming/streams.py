"""The append-only and windowed operators on unbounded input, with watermarks.

The functions that take a stream (``tumbling_energy`` ...) hold for any source; the queries run them over
the event table to its end and return what the stream has written.
"""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").option("recursiveFileLookup", "true").parquet(sf_dir)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling_energy(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """RMS of each stream in tumbling windows of event time."""
    energy = events.withWatermark("ts", late).groupBy(F.window("ts", width), "user_id", "event_type")
    return energy.agg(F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("rms"), F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "user_id", "event_type", "rms", "n")


def sliding_energy(events: DataFrame, width: str = "2 days", step: str = "1 day", late: str = "1 hour") -> DataFrame:
    """RMS of each track in sliding windows of event time."""
    energy = events.withWatermark("ts", late).groupBy(F.window("ts", width, step), "user_id")
    return energy.agg(F.sqrt(F.avg(F.col("value") * F.col("value"))).alias("rms"), F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), "user_id", "rms", "n")


def peaks(events: DataFrame, least: float = 0.0) -> DataFrame:
    """Strict local maxima of each track's values; a value is decided when its successor arrives, so the last two are the state.

    Within a batch values are taken in the order of (ts, event_id); what arrives after a later value has been seen is left out.
    """

    def pick(key, batches, state):
        rows = pd.concat(list(batches)).sort_values(["ts", "event_id"], kind="stable")
        before, held, held_id, last = state.get if state.exists else (None, None, None, None)
        found = []
        for ts, event_id, value in zip(rows["ts"], rows["event_id"], rows["value"]):
            at = ts.value
            if last is not None and at < last:
                continue
            if held is not None and before is not None and held > before and held > value and held >= least:
                found.append((int(key[0]), int(held_id), float(held)))
            before, held, held_id, last = held, float(value), int(event_id), at
        state.update((before, held, held_id, last))
        yield pd.DataFrame(found, columns=["user_id", "event_id", "value"])

    return events.groupBy("user_id").applyInPandasWithState(pick, "user_id long, event_id long, value double", "before double, held double, held_id long, last long", "append", "NoTimeout")


def session_segments(events: DataFrame, gap: str = "12 hours", late: str = "1 hour") -> DataFrame:
    """Active segments of each track: events less than ``gap`` apart."""
    segments = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return segments.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")


def deduped_log(events: DataFrame, late: str = "1 day") -> DataFrame:
    """The first of the rows with one key within the watermark, for an append-only log."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["user_id", "event_type", "event_id"]).select("event_id", "user_id", "event_type", "ts")


def run_to_end(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Write all that is available to Parquet files and read them back."""
    spark = stream.sparkSession
    name = uuid.uuid4().hex
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{folder}/out-{name}").option("checkpointLocation", f"{folder}/state-{name}").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out-{name}")


@contextlib.contextmanager
def folder_of(spark: SparkSession):
    """The shared folder of the streams; a local session without ``spark.checkpoint.dir`` (tests) gets a temporary one that goes at exit."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="pulselake-stream-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        shared = f"file://{folder}"
    yield shared.rstrip("/")


def _run(spark: SparkSession, stream: DataFrame) -> DataFrame:
    with folder_of(spark) as folder:
        return run_to_end(stream, folder)


def streaming_tumbling_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, tumbling_energy(event_stream(spark, sf_dir)))


def streaming_sliding_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sliding_energy(event_stream(spark, sf_dir)))


def streaming_session_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, session_segments(event_stream(spark, sf_dir)))


def streaming_dedupe_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, deduped_log(event_stream(spark, sf_dir)))


def streaming_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, peaks(event_stream(spark, sf_dir).select("user_id", "event_id", "ts", "value")))
