"""Append-only event logs, wide exports and document output."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The key of a logged event.
KEY = ["track_name", "event", "start", "stem", "target"]


def new_events(rows: DataFrame, log: DataFrame | None, key: list[str] = KEY, within: bool = False) -> DataFrame:
    """The rows whose key is not in the log yet (nulls equal nulls); ``within`` also drops repeats among the rows."""
    rows = rows.dropDuplicates(key) if within else rows
    if log is None:
        return rows
    old = log.select(*[F.col(k).alias(f"_{k}") for k in key]).distinct()
    return rows.join(old, reduce(lambda a, b: a & b, [rows[k].eqNullSafe(old[f"_{k}"]) for k in key]), "left_anti")


def append_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").option("header", "true").csv(path)


def write_patterns(rows: DataFrame, path: str) -> None:
    """Kick patterns without a header: onset time, then the steps (``onset_time``, ``pattern``)."""
    rows.select(F.concat_ws(",", F.col("onset_time").cast("string"), F.array_join(F.transform("pattern", lambda x: x.cast("string")), ",")).alias("value")).write.mode("errorifexists").text(path)


def overlay_rows(curves: DataFrame, centres: DataFrame, reach: float) -> DataFrame:
    """track_id, stem, offset, v: the samples (``track_id``, ``stem``, ``t``, ``v``) around each track's centre, at their distance from it."""
    near = curves.join(centres.select("track_id", F.col("t").alias("centre")), "track_id").withColumn("offset", F.col("t") - F.col("centre"))
    return near.where(F.abs("offset") <= reach).select("track_id", "stem", "offset", "v")


def preview(rows: DataFrame, n: int = 10) -> DataFrame:
    """The first rows in the order of all sortable columns: the same ones every time."""
    return rows.orderBy(*[f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]).limit(n)


def append_table(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").partitionBy("track_name").parquet(path)


def wide_union(parts: list[DataFrame]) -> DataFrame:
    """All rows under the union of all columns, in order of name; what a part lacks is null."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.select(*sorted(out.columns))


def flatten_events(documents: DataFrame, stem_name: Column | None = None) -> DataFrame:
    """One row per event of each document (``track_name``, ``feature_events``); documents without events give one row of nulls."""
    e = documents.withColumn("e", F.explode_outer("feature_events"))
    return e.select("track_name", *[F.col(f"e.{c}").alias(c) for c in ("event", "start", "end", "position", "stem", "target")])


def write_documents(rows: DataFrame, path: str) -> None:
    """A JSON object per row; a new version of the folder, never an edit in place."""
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("errorifexists").text(path)


def status_row(df: DataFrame, stage: str, status: str, note: str = "") -> DataFrame:
    """A row of the pipeline status table."""
    return df.sparkSession.range(1).select(F.lit(stage).alias("stage"), F.lit(status).alias("status"), F.current_timestamp().alias("time"), F.lit(note).alias("note"))
