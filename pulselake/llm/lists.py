"""Pairs out of inverted lists: which rows that share a key are compared, without any list being paired as a whole.

Rows (key, node, n) say that a node, a set of n elements, stands in the list of a key.  Small lists are
paired at once; of larger ones each node meets a few leaders.  After the links of these are components, only
the nodes outside the most frequent component of a list (``away``) have something to find there.  Where these are
few, they meet the whole list; the nodes of the other lists go to a prefix filter over their full sets, which
is exact: with a common order of all elements, rarest first, two sets of similarity s share one of the first
|A| - ceil(2 s / (1 + s) |A|) + 1 elements of the smaller set A and the first |B| - ceil(s |B|) + 1 of the larger one.
Joins are equi-joins on a key, and the lists of a key are split into blocks by the work they hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .runtime import written

#: Lists up to SMALL nodes are paired at once; lists with up to FEW nodes away are compared directly; comparisons of a block.
SMALL, FEW, BLOCK = 8, 64, 1 << 20


def fits(x: str, y: str, similarity: float) -> Column:
    """Whether the sizes of two sets allow the similarity."""
    return F.least(x, y) >= F.lit(similarity) * F.greatest(x, y) - 1e-9


def ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def shared(rows: DataFrame, repeated: bool = False) -> DataFrame:
    """key, c, low: the size and the least node of the lists with more than one node; with ``repeated``, rows may come more than once."""
    least = [F.count(F.lit(1)).alias("c"), F.min("node").alias("low")]
    return rows.groupBy("key").agg(*least, F.max("node").alias("high")).where("low <> high").drop("high") if repeated else rows.groupBy("key").agg(*least).where("c > 1")


def met(rows: DataFrame, heads: DataFrame | None = None) -> DataFrame:
    """The rows of the lists with more than one node, with the size and the least node of their list (``heads``, or of the rows)."""
    return rows.join(shared(rows) if heads is None else heads, "key")


def first_pairs(lists: DataFrame, similarity: float, carried: list[str] = [], possible: Column | None = None) -> DataFrame:  # noqa: B006
    """All pairs of small lists; the nodes of larger ones with three of their list.

    ``possible`` sees the columns ``carried`` of the first and, with a ``_`` before their names, of the second node.
    """
    possible = F.lit(True) if possible is None else possible
    other = [F.col("node").alias("o"), F.col("n").alias("m"), *[F.col(c).alias(f"_{c}") for c in carried]]
    small = lists.where(F.col("c") <= SMALL).select("key", "node", "n", *carried)
    small = small.repartition("key") if carried else small  # SMALL rows of a key at most, shuffled once for both sides
    pairs = small.join(small.select("key", *other), "key").where((F.col("node") < F.col("o")) & fits("n", "m", similarity) & possible).select(*ordered("node", "o"))
    large = lists.where(F.col("c") > SMALL)
    more = large.groupBy("key").agg(F.min(F.struct(F.xxhash64("node"), "node")).alias("x"), F.max("node").alias("high")).select("key", F.col("x.node").alias("middle"), "high")
    if not carried:
        led = large.join(more, "key").select("node", F.explode(F.array("low", "middle", "high")).alias("o")).where("node <> o").select(*ordered("node", "o"))
    else:
        leaders = large.join(more, "key").where("node in (low, middle, high)").select("key", *other)
        led = large.join(leaders, "key").where((F.col("node") != F.col("o")) & possible).select(*ordered("node", "o"))
    return pairs.union(led).distinct()


def joined_roots(roots: DataFrame, links: DataFrame) -> DataFrame:
    """node, root: the components after further links between nodes."""
    fresh = links.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(roots, "node", "left_anti")
    roots = roots.union(fresh.select("node", F.col("node").alias("root")))
    side = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}"))
    further = components(links.join(side("a"), "a").join(side("b"), "b"), "ra", "rb").select(F.col("node").alias("root"), F.col("root").alias("further"))
    return roots.join(further, "root", "left").select("node", F.coalesce("further", "root").alias("root"))


def rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def open_lists(rows: DataFrame) -> DataFrame:
    """Rows (key, node, root, ...; written) of lists that hold more than one component, with ``lead``, their most frequent one, and the nodes outside it."""
    shares = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    lists = shares.groupBy("key").agg(F.sum("c").alias("size"), F.max(F.struct("c", "root")).alias("top"))
    return rows.join(lists.select("key", "size", F.col("top.root").alias("lead"), (F.col("size") - F.col("top.c")).alias("away")).where("away > 0"), "key")


def crossed(open_: DataFrame, carried: list[str], possible: Column, first: Column | None = None, second: Column | None = None) -> DataFrame:
    """Pairs of a node outside its list's lead and any other of the list in another component.

    ``possible`` sees the columns ``carried`` of the first and, with a ``_`` before their names, of the second node.
    """
    blocks = open_.withColumn("blocks", F.ceil(F.col("away") * F.col("size") / BLOCK))
    away = blocks.where("root <> lead").select("key", "node", "root", *carried, F.pmod(F.xxhash64("node"), "blocks").alias("block"))
    renamed = [F.col(c).alias(f"_{c}") for c in carried]
    others = blocks.select("key", F.col("node").alias("o"), F.col("root").alias("q"), F.col("lead").alias("l"), *renamed, F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    # a pair of which both are away would come twice
    once = (F.col("q") == F.col("l")) | (F.col("node") < F.col("o"))
    return away.join(others, ["key", "block"]).where((F.col("root") != F.col("q")) & once & possible).select(*ordered("node", "o")).distinct()


def prefix_lengths(n: Column, similarity: float) -> tuple[Column, Column]:
    """How many of the first elements are looked up by a larger set and listed by a smaller one."""
    probed = n - F.ceil(F.lit(similarity) * n - 1e-9) + 1
    listed = n - F.ceil(F.lit(2 * similarity / (1 + similarity)) * n - 1e-9) + 1
    return probed, listed


def prefix_possible(similarity: float) -> Column:
    """Whether two rows (node, n, at, listed) of a prefix list can be similar: the smaller set (by n, then node) lists the element, and enough elements follow."""
    smaller = (F.col("n") < F.col("_n")) | ((F.col("n") == F.col("_n")) & (F.col("node") < F.col("o")))
    listed = F.when(smaller, F.col("listed")).otherwise(F.col("_listed"))
    rest = F.least(F.col("n") - F.col("at"), F.col("_n") - F.col("_at"))
    return listed & fits("n", "_n", similarity) & (rest * F.lit(1 + similarity) >= F.lit(similarity) * (F.col("n") + F.col("_n")) - 1e-9)
