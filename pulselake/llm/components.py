"""Connected components of a link table, by alternating large and small stars (DataFrame operations only).

Every step replaces the links of a node by links to the smallest node it sees; a fixed point is a set of
stars, one for each component.  Minima are aggregated before they are shuffled and joined back, so a node
with very many links is no single task's burden.  Each round is a written table: nothing is
collected, and a lost executor costs one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import drop_written, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Expects links (u, v) with v < u; gives the same."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """node, root: for each node that has a link, the smallest node it can reach (itself included).

    Nodes may be of any ordered type.  Links may repeat, come in both directions or lead to their own
    node; links with a null end are none.  A link table without links gives no rows.
    """
    oriented = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = written(oriented.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links", links.count())
    state = _state(edges)
    for _ in range(most_rounds):
        if not state[0]:
            break
        after = written(_small_star(_large_star(edges)), "links", 2 * state[0])
        drop_written(edges)
        edges, before, state = after, state, _state(after)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
