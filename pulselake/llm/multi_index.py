"""Near-duplicate vectors by an inverted multi-index.

Independent codebooks of the two halves of the (normalised) vectors form a product grid.  Each vector
lives in the cell of its nearest centroids.  As a query it visits cells in order of distance, by the
multi-sequence traversal, until the next cell is further behind the nearest one than a neighbour at the
threshold lies with probability ``recall``; that margin is calibrated on the codebook sample.  What it finds
there is verified by cosine in double precision.

The codebooks are fitted on at most ``SAMPLE`` vectors; every vector is indexed and every vector is a
query.  Equal vectors are one entry with a count.  A cell with many entries or visitors is dealt out in
blocks, so a task compares at most ``BLOCK`` entries with ``VISITORS`` visitors at a time; it returns counts
and links that span the components, never all pairs of a block.  A pair that only one side finds counts for both.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .runtime import table, written

SAMPLE, BLOCK, VISITORS = 20_000, 1024, 4096
#: Entries for each cell of the grid, on average; the grid grows with the table up to 1024 centroids a half.
PER_CELL, MOST_CENTROIDS = 256, 1024

VECTOR_SCHEMA = "vec_id long, node binary, raw binary"


def vector_table(rows: DataFrame, id_col: str = "vec_id", col: str = "embedding") -> DataFrame:
    """Id, digest and float64 bytes of each vector; unusable vectors (null, empty, zero, null or non-finite parts) have a null node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, raw = [], []
            for v in batch.column(1):
                x = v.as_py()
                x = None if not x or None in x else np.array(x, np.float64)
                good = x is not None and np.isfinite(x).all() and x.any()
                raw.append((x + 0.0).tobytes() if good else None)
                node.append(hashlib.blake2b(raw[-1], digest_size=16).digest() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node, pa.binary()), pa.array(raw, pa.binary())], ["vec_id", "node", "raw"])

    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(col).alias("v")).mapInArrow(run, VECTOR_SCHEMA)


def unit(raw: list[bytes]) -> np.ndarray:
    """Rows of length one; scaled first so that no square over- or underflows."""
    x = np.array([np.frombuffer(r) for r in raw])
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def k_means(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        near = _square_distances(points, centres).argmin(1)
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, points)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def _square_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres**2).sum(1) - 2 * points @ centres.T + (points**2).sum(1)[:, None]


class MultiIndex:
    """Two codebooks and the margin of the traversal."""

    def __init__(self, sample: np.ndarray, k: int, least_cosine: float, recall: float):
        self.half = sample.shape[1] // 2
        k = max(1, min(k, len(sample)))
        self.left, self.right = k_means(sample[:, : self.half], k), k_means(sample[:, self.half :], k)
        self.margin = self._calibrate(sample, least_cosine, recall)

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _square_distances(x[:, : self.half], self.left), _square_distances(x[:, self.half :], self.right)

    def _calibrate(self, sample: np.ndarray, cosine: float, recall: float) -> float:
        """How far behind the nearest cell the cell of a random neighbour at the threshold lies, at that quantile."""
        rng = np.random.default_rng(11)
        x = sample[rng.choice(len(sample), 4000)]
        away = rng.normal(size=x.shape)
        away -= (away * x).sum(1, keepdims=True) * x
        size = np.linalg.norm(away, axis=1, keepdims=True)
        y = cosine * x + np.sqrt(max(0.0, 1 - cosine**2)) * np.divide(away, size, out=np.zeros_like(away), where=size > 0)
        (a, b), (c, d), at = self.distances(x), self.distances(y), np.arange(len(x))
        behind = a[at, c.argmin(1)] - a.min(1) + b[at, d.argmin(1)] - b.min(1)
        return float(np.quantile(behind, recall)) + 1e-9

    def home(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a.argmin(1) * len(self.right) + b.argmin(1)

    def visits(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        """Cells of one query by the multi-sequence traversal, nearest first, up to the margin."""
        p, q = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
        a, b = a[p].tolist(), b[q].tolist()
        limit = a[0] + b[0] + self.margin
        heap, seen, out = [(a[0] + b[0], 0, 0)], {(0, 0)}, []
        while heap and heap[0][0] <= limit:
            _, i, j = heapq.heappop(heap)
            out.append(int(p[i]) * len(self.right) + int(q[j]))
            for step in ((i + 1, j), (i, j + 1)):
                if step[0] < len(a) and step[1] < len(b) and step not in seen:
                    seen.add(step)
                    heapq.heappush(heap, (a[step[0]] + b[step[1]], *step))
        return out


def indexed(entries: DataFrame, index: MultiIndex) -> DataFrame:
    shared = entries.sparkSession.sparkContext.broadcast(index)  # at most 2 * MOST_CENTROIDS half vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                a, b = index.distances(unit(part.column(1).to_pylist()))
                cells = [index.visits(x, y) for x, y in zip(a, b)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(index.home(a, b), pa.int32()), pa.array(cells, pa.list_(pa.int32()))], ["node", "raw", "mult", "home", "cells"])

    return entries.select("node", "raw", "mult").mapInArrow(run, "node binary, raw binary, mult long, home int, cells array<int>")


class Block:
    """Some entries of one cell, and the visitors that are compared with them."""

    def __init__(self, members: list[tuple]):
        self.nodes, raws, mult, cells = zip(*members)
        self.at = {n: k for k, n in enumerate(self.nodes)}
        self.matrix, self.mult = unit(raws), np.array(mult)
        sizes = np.fromiter(map(len, cells), np.int64, len(cells))
        self.owner, self.cells = np.repeat(np.arange(len(cells)), sizes), np.concatenate([np.asarray(c, np.int64) for c in cells])
        self.part = np.arange(len(members))  # the component of each member, by the links found so far
        self.credit = np.zeros(len(members), np.int64)

    def visited(self, homes: np.ndarray) -> np.ndarray:
        """For each visitor (row), which members visit its home in their turn and so count it themselves."""
        kinds, which = np.unique(homes, return_inverse=True)
        at = np.minimum(np.searchsorted(kinds, self.cells), len(kinds) - 1)
        found = kinds[at] == self.cells
        out = np.zeros((len(kinds), len(self.nodes)), bool)
        out[at[found], self.owner[found]] = True
        return out[which]

    def meet(self, visitors: list[tuple], least_cosine: float) -> list[tuple]:
        nodes, raws, mult, homes = zip(*visitors)
        hit = unit(raws) @ self.matrix.T >= least_cosine
        for i, node in enumerate(nodes):
            if (k := self.at.get(node)) is not None:
                hit[i, k] = False
        # a link that the member does not find from its side counts for the member here
        self.credit += np.array(mult) @ (hit & ~self.visited(np.array(homes)))
        counts, out = hit @ self.mult, []
        for i in np.flatnonzero(counts):
            out.append((nodes[i], int(counts[i]), None))
            parts, first = np.unique(self.part[hit[i]], return_index=True)
            out += [(nodes[i], 0, self.nodes[j]) for j in np.flatnonzero(hit[i])[first]]
            if len(parts) > 1:
                self.part[np.isin(self.part, parts)] = parts[0]
        return out

    def credits(self) -> list[tuple]:
        return [(self.nodes[k], int(self.credit[k]), None) for k in np.flatnonzero(self.credit)]


def compare(rows: DataFrame, least_cosine: float) -> DataFrame:
    """(node, n, other): linked entries counted with their multiplicity, from both ends, and links that span them, by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members, visitors, block = None, [], [], None

        def flush(out: list[tuple], last: bool):
            nonlocal block
            if visitors and members:
                block = block or Block(members)
                out += block.meet(visitors, least_cosine)
            visitors.clear()
            if last and block:
                out += block.credits()

        def batch_of(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.binary()))], ["node", "n", "other"])

        for batch in batches:
            out: list[tuple] = []
            for cell, mb, vb, visitor, node, raw, m, home, cells in zip(*(c.to_pylist() for c in batch.columns)):
                if (cell, mb, vb) != key:
                    flush(out, True)
                    key, members, block = (cell, mb, vb), [], None
                if visitor:
                    visitors.append((node, raw, m, home))
                    if len(visitors) >= 512:
                        flush(out, False)
                else:
                    members.append((node, raw, m, cells))
            yield batch_of(out)
        out = []
        flush(out, True)
        yield batch_of(out)

    return rows.mapInArrow(run, "node binary, n long, other binary")


def near_vectors(rows: DataFrame, least_cosine: float = 0.95, recall: float = 0.995) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``rows`` (``vec_id``, ``embedding``).

    Unusable vectors (null, empty, zero, with null or non-finite parts) link with nothing and are kept, as
    are vectors of other lengths than the most frequent one, which are compared among their own length.
    Repeated rows are vectors of their own; a null vec_id is never the smallest.  An empty table gives no rows.
    """
    vectors = written(vector_table(rows), "vectors")
    lengths = [r[0] for r in vectors.where("node is not null").select(F.octet_length("raw").alias("n")).distinct().collect()]
    results = [_one_length(vectors.where(F.octet_length("raw") == n), least_cosine, recall) for n in sorted(lengths)]
    lone = vectors.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    for r in results:
        lone = lone.union(r)
    return lone.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _one_length(vectors: DataFrame, least_cosine: float, recall: float) -> DataFrame:
    spark = vectors.sparkSession
    entries = written(vectors.groupBy("node").agg(F.first("raw").alias("raw"), F.count(F.lit(1)).alias("mult"), F.min("vec_id").alias("least")), "entries")
    total = entries.count()
    share = min(1.0, 1.2 * SAMPLE / total)
    sample = entries.where(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("raw").limit(SAMPLE).collect()
    k = max(1, min(MOST_CENTROIDS, round((total / PER_CELL) ** 0.5)))
    index = MultiIndex(unit([r.raw for r in sample or entries.select("raw").limit(1).collect()]), k, least_cosine, recall)
    found = written(indexed(entries, index), "indexed")
    homes = found.groupBy(F.col("home").alias("cell")).agg(F.count(F.lit(1)).alias("m"))
    visited = found.select(F.explode("cells").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("v"))
    blocks = homes.join(visited, "cell").select("cell", F.ceil(F.col("m") / BLOCK).cast("int").alias("mbs"), F.ceil(F.col("v") / VISITORS).cast("int").alias("vbs"))
    blocks = written(blocks, "blocks")  # a row for each cell in use
    part = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    members = found.withColumnRenamed("home", "cell").join(blocks, "cell").select("cell", part("mbs").alias("mb"), every("vbs").alias("vb"), F.lit(False).alias("visitor"), "node", "raw", "mult", F.col("cell").alias("home"), "cells")
    visitors = found.select("node", "raw", "mult", "home", F.explode("cells").alias("cell")).join(blocks, "cell").select("cell", every("mbs").alias("mb"), part("vbs").alias("vb"), F.lit(True).alias("visitor"), "node", "raw", "mult", "home", F.lit(None).cast("array<int>").alias("cells"))
    dealt = members.union(visitors).repartition("cell", "mb", "vb").sortWithinPartitions("cell", "mb", "vb", "visitor")
    links = written(compare(dealt, least_cosine), "vector-links")
    counts = links.where("other is null").groupBy("node").agg(F.sum("n").alias("n"))
    roots = written(components(links.where("other is not null"), "node", "other"), "roots")
    of_node = entries.select("node", "mult", "least").join(roots, "node", "left").join(counts, "node", "left").select("node", "root", (F.coalesce("n", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "least")
    of_root = of_node.where("root is not null").groupBy("root").agg(F.min("least").alias("component"))
    decided = of_node.join(of_root, "root", "left").select("node", "n_links", F.coalesce("component", "least").alias("component_id"))
    return vectors.select("vec_id", "node").join(decided, "node").select("vec_id", "n_links", "component_id")


def op5_multi_index(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))
