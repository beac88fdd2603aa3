"""Window statistics of streams (track, stem) as DataFrame operators; SQL forms are in the plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stream(keys: list[str], order: str = "i"):
    return Window.partitionBy(*keys).orderBy(order)


def with_neighbours(frames: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    w = stream(keys)
    return frames.withColumns({"prev": F.lag(value).over(w), "next": F.lead(value).over(w)})


def peak(value: str = "v", above: Column | None = None) -> Column:
    """A strict local maximum, over a bound if given; needs ``with_neighbours``."""
    out = (F.col(value) > F.col("prev")) & (F.col(value) > F.col("next"))
    return F.coalesce(out if above is None else out & (F.col(value) >= above), F.lit(False))


def window_features(frames: DataFrame, keys: list[str], spike_margin: float) -> DataFrame:
    """One shuffle on the keys: mean, slope, spikes, jump, flatness and tail of each stream."""
    whole = Window.partitionBy(*keys)
    rows = with_neighbours(frames, keys).withColumns({"mu": F.avg("v").over(whole), "n": F.count(F.lit(1)).over(whole)})
    spikes = F.count(F.when(peak(above=F.col("mu") + spike_margin), 1))
    long_enough = F.count(F.lit(1)) > 2
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("v").alias("mean_energy"),
        F.when(F.count(F.lit(1)) > 1, F.regr_slope("v", "i")).alias("slope"),
        spikes.alias("spike_count"),
        (spikes / F.count(F.lit(1))).alias("spike_density"),
        F.when(long_enough, F.max_by("v", "i") - F.min_by("v", "i")).alias("energy_jump"),
        F.when(long_enough, F.stddev_pop(F.col("v") - F.col("prev"))).alias("flatness_score"),
        F.when(long_enough, F.avg(F.when(F.col("i") >= F.col("n") - 5, F.col("v")))).alias("tail_energy"),
    )


def tumbling_rms(frames: DataFrame, keys: list[str], size: int) -> DataFrame:
    return frames.groupBy(*keys, F.floor(F.col("i") / size).alias("frame")).agg(F.sqrt(F.avg(F.col("v") * F.col("v"))).alias("rms"))


def sliding_rms(frames: DataFrame, keys: list[str], size: int, hop: int) -> DataFrame:
    """RMS of whole frames of ``size`` samples every ``hop``: each sample goes to the frames that hold it."""
    first = F.greatest(F.ceil((F.col("i") - size + 1) / hop), F.lit(0))
    rows = frames.withColumn("frame", F.explode(F.sequence(first, F.floor(F.col("i") / hop))))
    out = rows.groupBy(*keys, "frame").agg(F.sqrt(F.avg(F.col("v") * F.col("v"))).alias("rms"), F.count(F.lit(1)).alias("n"))
    return out.where(F.col("n") == size).drop("n")


def moving_average(frames: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Centred sum over ``width`` (odd) divided by it: the ends see zeros."""
    w = stream(keys).rowsBetween(-(width // 2), width // 2)
    return frames.withColumn("smooth", F.sum("v").over(w) / width)


def z_score(column: str, keys: list[str]) -> Column:
    w = Window.partitionBy(*keys)
    return (F.col(column) - F.avg(column).over(w)) / (F.stddev_pop(column).over(w) + 1e-9)


def segments(frames: DataFrame, keys: list[str], active: Column) -> DataFrame:
    """Runs of rows between active ones (each active row starts one): first index and length."""
    w = stream(keys).rowsBetween(Window.unboundedPreceding, 0)
    return frames.withColumn("segment", F.sum(active.cast("int")).over(w)).groupBy(*keys, "segment").agg(F.min("i").alias("first"), F.count(F.lit(1)).alias("length"))
