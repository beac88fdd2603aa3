"""Streams give what the batch forms give."""

from pyspark.sql import functions as F

from pulselake.plans import kernel_queries
from pulselake.streaming import streams

SF = "/root/testdata/sf0.001"


def test_dedupe_log_keeps_each_event_once(spark):
    got = streams.streaming_dedupe_log(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/events.parquet").select("event_id").distinct().count()


def test_tumbling_windows_agree_with_batch(spark):
    got = {(r.start, r.user_id, r.event_type): r.n for r in streams.streaming_tumbling_energy(spark, SF).collect()}
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    batch = {(r.start, r.user_id, r.event_type): r.n for r in streams.tumbling_energy(events).collect()}
    assert got and all(batch[k] == n for k, n in got.items())


def test_kernel_queries_run(spark):
    for name, q in kernel_queries.QUERIES.items():
        if not name.startswith("streaming"):
            assert q(spark, SF).count() > 0, name
