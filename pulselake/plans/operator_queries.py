"""Queries over the operators themselves: sources, sinks and DataFrame joins, with oracle SQL for their rows."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from .. import tables
from ..operators import joins, windows
from ..sinks import logs
from ..sources import documents
from ..streaming.streams import folder_of


def _folder(spark: SparkSession, label: str) -> str:
    with folder_of(spark) as folder:
        return f"{folder}/{label}-{uuid.uuid4().hex}"


def kick_patterns_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patterns of 16 steps written without a header and read back."""
    ev = tables.events(spark, sf_dir).where("stem = 'click'")
    step = F.floor(F.col("t") / 11.25).cast("int") % 16
    rows = ev.groupBy("track_id").agg(F.min("event_id").cast("double").alias("onset_time"), F.collect_set(step).alias("on"))
    rows = rows.select("onset_time", F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.array_contains("on", k).cast("int")).alias("pattern"))
    path = _folder(spark, "patterns")
    logs.write_patterns(rows, path)
    back = documents.read_patterns(spark, path)
    return back.select("onset_time", F.aggregate("pattern", F.lit(0), lambda a, x: a + x).cast("long").alias("hits"), F.element_at("pattern", 1).cast("long").alias("first_step"), F.size("pattern").cast("long").alias("steps"))


def event_log_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log appended in two parts, the second without what the first holds, and read back by its header."""
    ev = tables.events(spark, sf_dir)
    rows = ev.select(F.col("track_id").cast("string").alias("track_name"), F.lit("scan").alias("source"), F.col("stem").alias("event"), F.floor("t").cast("double").alias("start"), (F.floor("t") + 1).cast("double").alias("end"), F.lit("pre").alias("position"), F.col("stem"), F.lit(None).cast("string").alias("target"), (F.col("track_id") % 60 + 90).cast("double").alias("bpm"), F.lit(None).cast("double").alias("duration_s"), F.lit("v1").alias("schema_version"), "event_id")
    path = _folder(spark, "log")
    logs.append_csv(logs.new_events(rows.where("event_id % 2 = 0"), None, within=True).drop("event_id"), path)
    logs.append_csv(logs.new_events(rows, documents.read_log(spark, path), within=True).drop("event_id"), path)
    return documents.read_log(spark, path).groupBy("track_name").agg(F.count(F.lit(1)).alias("logged"), F.max("bpm").alias("bpm"), F.count("target").alias("targets"))


def stem_mix_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streams of the stems and their mix by the hour as one relation."""
    ev = tables.events(spark, sf_dir).select("track_id", "stem", F.floor("t").cast("long").alias("t"), "v")
    both = documents.with_mix(ev, ev.groupBy("track_id", "t").agg(F.sum("v").alias("v")))
    return both.groupBy("track_id", "stem").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("v") + 1.7e-10, 6).alias("total"))


def overlay_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples within 24 hours of each track's strongest one, by their distance from it."""
    ev = tables.events(spark, sf_dir)
    centres = ev.groupBy("track_id").agg(F.min(F.struct((-F.col("v")).alias("x"), "us", "t")).alias("m")).select("track_id", "m.t")
    return logs.overlay_rows(ev, centres, 24.0).groupBy("track_id", "stem").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("offset") + 1.7e-10, 6).alias("first_offset"), F.round(F.max("v") + 1.7e-10, 6).alias("top"))


def operator_band_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks and views of a track less than an hour apart, by the bucketed equi-join."""
    ev = tables.events(spark, sf_dir)
    left = ev.where("stem = 'click'").select("track_id", F.col("event_id").alias("lid"), F.col("t").alias("lt"))
    right = ev.where("stem = 'view'").select("track_id", F.col("event_id").alias("rid"), F.col("t").alias("rt"))
    return joins.band_join(left, right, ["track_id"], "lt", "rt", 1.0).groupBy("track_id").agg(F.count(F.lit(1)).alias("pairs"))


def operator_window_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = windows.window_features(tables.frames(spark, sf_dir), ["track_id", "stem"], 5.0)
    return out.select("track_id", "stem", F.round(F.col("mean_energy") + 1.7e-10, 6).alias("mean_energy"), F.round(F.col("slope") + 1.7e-10, 6).alias("slope"), F.col("spike_count").cast("long").alias("spike_count"))


@udtf(returnType="slot long, bar long, step long, beat_in_bar long, t double")
class GridSlots:
    """The 64 slots of a grid: of four bars, from ``start``, a quarter beat apart."""

    def eval(self, start: float, bpm: float):
        if start is None or bpm is None or bpm <= 0:
            return
        for k in range(64):
            yield k, k // 16, k % 16, k % 16 // 4, start + k * 15.0 / bpm


def grid_udtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid generator as a table function, called for each track."""
    spark.udtf.register("grid_slots", GridSlots)
    tr = tables.events(spark, sf_dir).select("track_id", (F.col("track_id") % 60 + 90).cast("double").alias("bpm")).distinct()
    return spark.sql("SELECT track_id, slot, bar, step, beat_in_bar, round(t + 1.7e-10, 6) AS t FROM {tr}, LATERAL grid_slots(0e0, bpm)", tr=tr)


#: Stages by name, for pipelines that run a part of them (first and last name included).
STAGES = {"frames": ["gradient_zscore"], "windows": ["stem_window_features"], "grid": ["beat_grid"], "rules": ["rule_match_compiled"], "hub": ["feature_hub"]}


def select_stages(first: str | None = None, last: str | None = None, skip: tuple[str, ...] = ()) -> list[str]:
    """Names of the queries from the first to the last stage; unknown names are an error."""
    names = list(STAGES)
    for n in (first, last, *skip):
        if n is not None and n not in STAGES:
            raise ValueError(f"no stage {n!r}; there are {', '.join(names)}")
    chosen = names[names.index(first) if first else 0 : names.index(last) + 1 if last else None]
    return [q for n in chosen if n not in skip for q in STAGES[n]]


_T = "(epoch_us(ts) - 1704067200000000) / 3.6e9"
_ROUND = "round({} + 1.7e-10, 6)"
ORACLES = {
    "kick_patterns_roundtrip": f"WITH e AS (SELECT user_id, event_id, CAST(floor({_T} / 11.25) AS BIGINT) % 16 AS step FROM events WHERE event_type = 'click') SELECT CAST(min(event_id) AS DOUBLE) AS onset_time, count(DISTINCT step) AS hits, CAST(max(CASE WHEN step = 0 THEN 1 ELSE 0 END) AS BIGINT) AS first_step, CAST(16 AS BIGINT) AS steps FROM e GROUP BY user_id",
    "event_log_roundtrip": f"SELECT CAST(user_id AS VARCHAR) AS track_name, count(DISTINCT event_type || ':' || CAST(floor({_T}) AS VARCHAR)) AS logged, CAST(max(user_id % 60 + 90) AS DOUBLE) AS bpm, CAST(0 AS BIGINT) AS targets FROM events GROUP BY user_id",
    "stem_mix_union": f"WITH e AS (SELECT user_id AS track_id, event_type AS stem, CAST(floor({_T}) AS BIGINT) AS t, value AS v FROM events), u AS (SELECT * FROM e UNION ALL SELECT track_id, 'mix' AS stem, t, sum(v) AS v FROM e GROUP BY track_id, t) SELECT track_id, stem, count(*) AS n, {_ROUND.format('sum(v)')} AS total FROM u GROUP BY track_id, stem",
    "overlay_windows": f"WITH e AS (SELECT user_id AS track_id, event_type AS stem, {_T} AS t, value AS v, epoch_us(ts) AS us FROM events), c AS (SELECT track_id, t AS centre FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY v DESC, us) AS rk FROM e) WHERE rk = 1) SELECT e.track_id, e.stem, count(*) AS n, {_ROUND.format('min(t - centre)')} AS first_offset, {_ROUND.format('max(v)')} AS top FROM e JOIN c ON e.track_id = c.track_id WHERE abs(t - centre) <= 24 GROUP BY e.track_id, e.stem",
    "operator_band_join": f"WITH e AS (SELECT user_id AS track_id, event_type AS stem, {_T} AS t FROM events) SELECT a.track_id, count(*) AS pairs FROM e a JOIN e b ON a.track_id = b.track_id AND a.stem = 'click' AND b.stem = 'view' AND abs(a.t - b.t) <= 1 GROUP BY a.track_id",
    "operator_window_features": f"WITH f AS (SELECT user_id AS track_id, event_type AS stem, value AS v, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) - 1 AS i FROM events), w AS (SELECT *, lag(v) OVER (PARTITION BY track_id, stem ORDER BY i) AS p, lead(v) OVER (PARTITION BY track_id, stem ORDER BY i) AS q, avg(v) OVER (PARTITION BY track_id, stem) AS mu FROM f) SELECT track_id, stem, {_ROUND.format('avg(v)')} AS mean_energy, {_ROUND.format('CASE WHEN count(*) > 1 THEN regr_slope(v, i) END')} AS slope, count(CASE WHEN v > p AND v > q AND v >= mu + 5 THEN 1 END) AS spike_count FROM w GROUP BY track_id, stem",
    "grid_udtf": f"WITH t AS (SELECT DISTINCT user_id AS track_id, CAST(user_id % 60 + 90 AS DOUBLE) AS bpm FROM events), k AS (SELECT unnest(range(64)) AS slot) SELECT track_id, slot, slot // 16 AS bar, slot % 16 AS step, slot % 16 // 4 AS beat_in_bar, {_ROUND.format('slot * 15e0 / bpm')} AS t FROM t CROSS JOIN k",
}
QUERIES = {f.__name__: f for f in (kick_patterns_roundtrip, event_log_roundtrip, stem_mix_union, overlay_windows, operator_band_join, operator_window_features, grid_udtf)}
