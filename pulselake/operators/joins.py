"""Tolerance, nearest and as-of joins that stay equi-joins.

Spark runs a join on ``abs(a.t - b.t) <= tol`` alone as a nested loop.  Here time is cut into buckets as wide as the
tolerance, the right side stands in its bucket and both neighbours, and the join meets on (keys, bucket): its cost
follows the pairs within reach, a hot key spreads over its buckets, and adaptive execution may split any of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def band_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, tolerance: float, how: str = "inner") -> DataFrame:
    """Pairs with equal keys whose times differ by at most ``tolerance``; ``how`` is inner, left, left_semi or left_anti.

    Column names of both sides must differ but for the keys.  Rows with a null time have no partner.
    """
    if tolerance <= 0:
        raise ValueError("the tolerance must be positive")
    bucket = lambda c: F.floor(F.col(c) / F.lit(float(tolerance)))
    near = right.withColumn("_bucket", F.explode(F.array(*[bucket(right_time) + d for d in (-1, 0, 1)])))
    far = left.withColumn("_bucket", bucket(left_time))
    for k in keys:
        near = near.withColumnRenamed(k, f"_r_{k}")
    on = [far[k] == near[f"_r_{k}"] for k in keys]
    on += [far["_bucket"] == near["_bucket"], F.abs(far[left_time] - near[right_time]) <= F.lit(float(tolerance))]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    out = far.join(near, condition, how)
    return out.drop(far["_bucket"]).drop("_bucket", *[f"_r_{k}" for k in keys])


def nearest_within(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, left_time: str, right_id: str, right_time: str, tolerance: float) -> DataFrame:
    """left_id, right_id, distance of the nearest partner within ``tolerance``; ties go to the smaller right_id."""
    pairs = band_join(left, right, keys, left_time, right_time, tolerance)
    best = F.min(F.struct(F.abs(F.col(left_time) - F.col(right_time)).alias("distance"), F.col(right_id)))
    return pairs.groupBy(left_id).agg(best.alias("b")).select(left_id, f"b.{right_id}", "b.distance")


def asof_join(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, value: str, direction: str = "backward") -> DataFrame:
    """Each left row with ``value`` of the last right row at or before it (forward: first at or after), without a tolerance.

    Both sides are laid out on one time line per key and the value is carried along, in one shuffle and one sort.  Of
    right rows at one time the greatest value counts.  A key with very many rows is one window partition.
    """
    backward = direction == "backward"
    rows = left.select(*keys, F.col(left_time).alias("_t"), F.lit(1 if backward else 0).alias("_side"), F.struct(*left.columns).alias("_row"), F.lit(None).cast(right.schema[value].dataType).alias("_v"))
    marks = right.groupBy(*keys, F.col(right_time).alias("_t")).agg(F.max(value).alias("_v"))
    marks = marks.select(*keys, "_t", F.lit(0 if backward else 1).alias("_side"), F.lit(None).cast(rows.schema["_row"].dataType).alias("_row"), "_v")
    order = (F.col("_t"), F.col("_side")) if backward else (F.desc("_t"), F.desc("_side"))
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.union(marks).withColumn(value, F.last("_v", ignorenulls=True).over(w))
    return carried.where("_row is not null").select("_row.*", value)


def window_around(frames: DataFrame, centres: DataFrame, keys: list[str], index: str, centre: str, before: int, after: int) -> DataFrame:
    """Frames from ``before`` before a centre to ``after`` - 1 after it, with the position pre or post."""
    near = frames.join(centres, keys).where((F.col(index) >= F.col(centre) - before) & (F.col(index) < F.col(centre) + after))
    return near.withColumn("position", F.when(F.col(index) < F.col(centre), "pre").otherwise("post"))
