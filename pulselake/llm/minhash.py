"""Near-duplicate documents by bottom-k sketches of one hash function.

1. Each document gives its set of word shingles as hashes, a sketch (the ``SKETCH`` smallest), a digest of the
   whole set and a bitmap of ``BITS`` parities.  Documents with equal sets are one class from here on,
   however many they are.
2. Inverted lists hold the classes under every pair among their ``KEYED`` smallest hashes, that is, classes
   that overlap in two retained values meet.  At Jaccard 0.8 a pair of large sets has at most one of the
   8 smallest values of its union in common with probability 8e-5; sets of up to 8 shingles are
   kept whole, so nothing of theirs is lost.
3. Small lists are paired at once, larger ones with three of their classes; most groups are whole after this.
   Where few classes of a list are then outside its most frequent component, these are compared with the whole
   list.  The other lists (frequent words, shared passages) are split by a third retained value: at Jaccard
   0.8 fewer than three of the ``RETAINED`` smallest are common with probability 8e-5.  The classes of lists that are
   crowded still go to an exact prefix filter over their full sets (``lists``), so no list ends on its leaders alone.  Its
   order of shingles is by how many classes have them, counted in ``COUNTERS`` buckets: any common order is
   exact, a good one is short.
4. Bitmaps bound the difference of two sets from below, so clear misses go without their texts; the sketch of the
   union estimates the similarity and drops others; what is left is confirmed on the full sets, word by word.
5. Components of the confirmed links; the smallest doc_id of each is kept.

Classes are told apart by 64 bits of the digest of their whole set: at 15 million classes two different sets
agree in these with probability 6e-6.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .lists import FEW, SMALL, crossed, first_pairs, fits, joined_roots, met, open_lists, prefix_lengths, prefix_possible, rooted
from .runtime import MOST_BROADCAST, bounded_broadcast, drop_written, release, table, worker_cache, written

SKETCH, KEYED, RETAINED, BITS, COUNTERS, ROW = 64, 8, 10, 512, 1 << 20, 64
#: The estimate from 64 values has a deviation of 0.05 at 0.8; a pair is dropped five deviations below.
SLACK = 0.25

SETS_SCHEMA = "doc_id long, salt long, n long, node long, low array<long>, bits array<long>, sketch binary"


class WordHashes(dict):
    def __init__(self, most: int = 300_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    """Distinct runs of ``width`` words; fewer words are one shingle, none give none."""
    if len(words) < width:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(width))))


def shingle_hashes(words: list[bytes], width: int, cache: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    runs = min(width, len(words))
    x = np.full(len(h) - runs + 1, np.uint64(runs if runs < width else 0), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(runs):
            x = (x ^ h[i : len(h) - runs + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return np.unique(x)


def estimate(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> float:
    """Similarity by the k smallest values of the union of two sketches (their upper halves, of which few agree by chance)."""
    union = np.union1d(a, b)[:k]
    both = np.intersect1d(a, b)
    return float(np.isin(union, both).sum() / len(union)) if len(union) else 0.0


def parities(hashes: np.ndarray) -> np.ndarray:
    """For each of BITS buckets, whether an odd number of the hashes falls into it: two sets differ in at least as many elements as bits."""
    odd = np.bincount((hashes >> np.uint64(16)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def set_table(docs: DataFrame, width: int) -> DataFrame:
    """One row per document: size and digest of its set, smallest values, parities and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_cache().setdefault("word hashes", WordHashes())
        names = [c.split()[0] for c in SETS_SCHEMA.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                rows = []
                for doc_id, salt, text in zip(*(c[at : at + 128].to_pylist() for c in batch.columns)):
                    hashes = shingle_hashes(words_of(text), width, cache)
                    if n := len(hashes):
                        node = int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)
                        rows.append((doc_id, salt, n, node, hashes[:RETAINED].view(np.int64), parities(hashes), (hashes[:SKETCH] >> np.uint64(32)).astype(np.uint32).tobytes()))
                    else:
                        rows.append((doc_id, salt, 0, None, None, None, None))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), _salt().alias("salt"), F.col("text")).mapInArrow(run, SETS_SCHEMA)


def _salt():
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def inverted(classes: DataFrame) -> DataFrame:
    """key, last, node, n: a key for every pair of the KEYED smallest values (a single value is its own key), and the place of its second value."""
    get = lambda i: F.get("low", F.lit(i))
    pairs = [F.when(F.size("low") > j, F.struct(F.xxhash64(get(i), get(j)).alias("key"), F.lit(j).alias("last"))) for i, j in combinations(range(KEYED), 2)]
    keys = F.array(*pairs, F.when(F.size("low") == 1, F.struct(get(0).alias("key"), F.lit(0).alias("last"))))
    return classes.select(F.explode(keys).alias("k"), "node", "n").where("k is not null").select("k.key", "k.last", "node", "n")


def extended(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows (key, last, node, n, root) under their key and each later retained value."""
    low = rows.join(classes.select("node", "low"), "node")
    return low.select("node", "n", "root", "key", F.explode(F.slice("low", F.col("last") + 2, F.lit(RETAINED))).alias("v")).select(F.xxhash64("key", "v").alias("key"), "node", "n", "root")


def compressed(rows: DataFrame) -> DataFrame:
    """The rows with ``z``, their text compressed, in its place as the last column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
                z = pa.array([squeeze.compress(t.as_py().encode()) for t in part.column(part.num_columns - 1)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], z], names)

    names = [*rows.columns[:-1], "z"]
    return rows.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]) + ", z binary")


def texts_of(nodes: DataFrame, sets: DataFrame, docs: DataFrame, most: int) -> DataFrame:
    """node, sketch, z: one text of each class in ``nodes`` (at most ``most``); texts that are not wanted are not shuffled where the wanted rows are few."""
    first = sets.where("n > 0").join(bounded_broadcast(nodes), "node", "left_semi").groupBy("node").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("k"), "salt")).alias("r"), F.first("sketch").alias("sketch"))
    wanted = written(first.select("node", "r.k", "r.salt", "sketch"), "wanted", most)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("k"), _salt().alias("salt"), F.coalesce("text", F.lit("")).alias("text"))
    keys = bounded_broadcast(wanted.select("k", "salt", "node"))
    if wanted.count() <= MOST_BROADCAST:
        found = compressed(rows.join(keys, ["k", "salt"]).select("node", "text"))
    else:
        found = compressed(rows.select("k", "salt", "text")).join(keys, ["k", "salt"])
    found = found.groupBy("node").agg(F.first("z").alias("z")).join(wanted.select("node", "sketch"), "node")
    out = written(found.select("node", F.struct("sketch", "z").alias("t")), "texts", most, 5_000)
    drop_written(wanted)
    return out


def with_prefixes(texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """key, node, root, n, at, listed: of each class (node, root, z) its first shingles in a common order, the rarest first."""

    def hashes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        cache = worker_cache().setdefault("word hashes", WordHashes())
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for node, root, z in zip(*batch.columns):
                yield node.as_py(), root.as_py(), shingle_hashes(expand.decompress(z.as_py()).lower().split(), width, cache)

    names = [f"c{i}" for i in range(ROW)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int32)
        for _, _, h in hashes_of(batches):
            np.add.at(counts, h % np.uint64(COUNTERS), 1)
        table = counts.reshape(-1, ROW)
        some = np.flatnonzero(table.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *(pa.array(c) for c in table[some].T)], ["row", *names])

    read = texts.select("node", "root", "z")
    counts = np.zeros((COUNTERS // ROW, ROW), np.int32)
    sums = read.mapInArrow(count, "row int, " + ", ".join(f"{c} int" for c in names)).groupBy("row").agg(*[F.sum(c).alias(c) for c in names])
    for r in sums.toLocalIterator():  # COUNTERS / ROW rows, whatever the corpus
        counts[r[0]] = np.minimum(r[1:], 2**31 - 1)
    counts = counts.ravel()
    shared = texts.sparkSession.sparkContext.broadcast(counts)  # 4 MB, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], ["node", "root", "key", "at", "n"])

        for node, root, h in hashes_of(batches):
            c = shared.value[h % np.uint64(COUNTERS)]
            n = len(h)
            most = n - int(np.ceil(similarity * n - 1e-9)) + 1
            first = np.lexsort((h, c))[:most]
            # a bucket that only one class has cannot meet another class
            at = np.flatnonzero(c[first] > 1)
            held.append((np.full(len(at), node), np.full(len(at), root), h[first[at]].view(np.int64), at.astype(np.int32), np.full(len(at), n, np.int32)))
            size += len(at)
            if size >= 20_000:
                yield out()
                held, size = [], 0
        if held:
            yield out()

    rows = read.mapInArrow(run, "node long, root long, key long, at int, n int")
    return rows.withColumn("listed", F.col("at") < prefix_lengths(F.col("n"), similarity)[1])


def by_bits(pairs: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sizes and parities allow the similarity (exact: nothing similar goes)."""
    side = lambda x, c: classes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits{x}"))
    joined = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    return joined.where(fits("na", "nb", similarity) & differ_little("bitsa", "bitsb", F.col("na") + F.col("nb"), similarity)).select("a", "b")


def differ_little(x: str, y: str, sizes, similarity: float):
    """|A ^ B| <= (|A| + |B|) (1 - s) / (1 + s) if the similarity is s; the parities differ in no more bits."""
    bits = sum((F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(BITS // 64)), F.lit(0))
    return bits * F.lit(1 + similarity) <= sizes * F.lit(1 - similarity) + 1e-9


def confirmed(pairs: DataFrame, sets: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (written) with 100 * |A & B| >= percent * |A | B| on their full sets."""
    most = pairs.count()
    nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes", 2 * most)
    texts = texts_of(nodes, sets, docs, 2 * most)
    release(sets)
    joined = pairs.join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a").join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        held: tuple = (None, None)
        full = lambda z: shingles(expand.decompress(z).lower().split(), width)
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 64):
                for a, b, sa, za, sb, zb in zip(*(c[at : at + 64].to_pylist() for c in batch.columns)):
                    if estimate(np.frombuffer(sa, np.uint32), np.frombuffer(sb, np.uint32)) < percent / 100 - SLACK:
                        continue
                    if held[0] != b:
                        held = (b, full(zb))
                    x, y = full(za), held[1]
                    both = len(x & y)
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        out.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in (0, 1)], ["a", "b"])

    out = written(joined.select("a", "b", "ta.sketch", "ta.z", F.col("tb.sketch").alias("sketch_b"), F.col("tb.z").alias("z_b")).mapInArrow(run, "a long, b long"), "links", most, 4_000)
    drop_written(texts)
    return out


def roots_of(classes: DataFrame, sets: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """node, root: the components of all similar classes that have a link."""
    similarity, most = percent / 100, classes.count() * KEYED * (KEYED - 1) // 2
    lists = written(met(inverted(classes)), "lists", most)
    release(sets)
    most = lists.count()
    pairs = written(by_bits(first_pairs(lists, similarity), classes, similarity), "pairs", most)
    release(sets)
    roots = components(confirmed(pairs, sets, docs, width, percent))
    roots = written(roots, "roots", 2 * pairs.count())
    drop_written(pairs)
    release(sets)
    larger = written(rooted(lists.where(F.col("c") > SMALL).select("key", "last", "node", "n"), roots), "larger", most)
    drop_written(lists)
    bits = classes.select("node", "bits")
    near = fits("n", "_n", similarity) & differ_little("bits", "_bits", F.col("n") + F.col("_n"), similarity)
    open_ = written(open_lists(larger), "open", larger.count())
    pairs = crossed(open_.where(F.col("away") <= SMALL).join(bits, "node"), ["n", "bits"], near)
    further = written(extended(open_.where(F.col("away") > SMALL), classes), "extended", RETAINED * open_.count())
    deeper = written(open_lists(further), "open", further.count())
    pairs = pairs.union(crossed(deeper.where(F.col("away") <= FEW).join(bits, "node"), ["n", "bits"], near))
    crowded = written(deeper.where(F.col("away") > FEW).select("node").distinct(), "crowded", classes.count())
    if not crowded.isEmpty():
        texts = texts_of(crowded, sets, docs, crowded.count())
        rows = written(with_prefixes(rooted(texts.select("node", "t.z"), roots), width, similarity), "prefixes")
        rows = open_lists(rows).join(bits, "node")
        pairs = pairs.union(crossed(rows, ["n", "at", "listed", "bits"], prefix_possible(similarity) & near))
    pairs = written(pairs.distinct(), "pairs", deeper.count() + open_.count())
    for t in (larger, open_, further, deeper):
        drop_written(t)
    release(sets)
    links = confirmed(pairs, sets, docs, width, percent)
    return roots if links.isEmpty() else written(joined_roots(roots, links), "roots", roots.count() + 2 * links.count())


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of ``docs`` (``doc_id``, ``text``).

    Words are what stands between ASCII white space, in ASCII lower case.  A document with fewer than
    ``width`` words has them all as its one shingle; one without words (null text too) has an empty set,
    is linked with nothing and kept.  Rows that repeat a doc_id are rows of their own with one decision
    if their texts agree; a null doc_id is never the smallest and, alone in its component, has a null
    component_id and is kept.  An empty table gives no rows; other columns are not read.
    """
    return decided(docs, width, percent).drop("salt")


def decided(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The same, with a hash of the text."""
    sets = written(set_table(docs, width), "sets")
    classes = written(sets.where("n > 0").groupBy("node").agg(F.first(F.struct("n", "low", "bits")).alias("c")).select("node", "c.*"), "classes", sets.count(), 20_000)
    roots = roots_of(classes, sets, docs, width, percent)
    release(sets)
    least = sets.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    of_node = least.join(roots, "node", "left")
    of_root = of_node.where("root is not null").groupBy("root").agg(F.min("least").alias("component"))
    decided = of_node.join(of_root, "root", "left").select("node", F.coalesce("component", "least").alias("component_id"))
    full = sets.where("n > 0").select("doc_id", "salt", F.col("n").alias("n_shingles"), "node").join(decided, "node", "left").select("doc_id", "salt", "n_shingles", "component_id")
    empty = sets.where("n = 0").select("doc_id", "salt", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.union(empty).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, of which one document of each group of near-duplicates is left: the one with the smallest doc_id.

    Rows that agree in doc_id and text share one decision; rows that share a doc_id but not the text have their own.  Texts without words (null
    too) stay.  A row without doc_id goes if its group has one with; rows without cannot be told apart, so of a
    group of such rows alone all stay.  An empty table gives no rows; other columns may have any names.
    """
    gone = decided(docs, width, percent).where("not kept").select(F.col("doc_id").alias("k"), F.col("salt").alias("s")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("key"), _salt().alias("salt"))
    left = rows.join(gone, F.col("key").eqNullSafe(F.col("k")) & (F.col("salt") == F.col("s")), "left_anti")
    return left.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op8_minhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)
