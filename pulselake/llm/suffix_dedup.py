"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else.

1. Every window of LENGTH bytes has an anchor: the K-gram in it with the least hash (the last one of equals).
   Equal windows have their anchors at the same offset, so they meet under the hash of that K-gram.  Windows
   of a text with one anchor form a segment; a row per segment (hashes and place, no text) is
   counted by anchor, and anchors that stand once go.
2. Where all segments of an anchor are equal, all their windows repeat: no text is needed.
3. Of an anchor with different segments, one of each kind fetches its bytes.  In blocks of such anchors the suffixes
   that begin at the anchors are sorted by a mergesort whose comparisons find the common extension
   by binary search over prefix polynomial hashes.  Of up to ``PAIRED`` kinds, neighbours' extensions to the right give
   those of all pairs of an anchor by running minima, and extensions to the left are found in the same way.  Of more kinds,
   those that agree to the right are runs of the sorted order, and for each offset the left hashes are compared within
   the runs, so the work is linear in the kinds.  Matches of LENGTH bytes are verified byte by byte.
4. An anchor with more than ``SORTED`` kinds of segments (the rim of a passage that very many texts share) does not fit into
   a task: its windows are counted one by one under their 128-bit digests, which is the same result, spread out.
5. The covered ranges of each document meet its text once more.

Every count is aggregated before it is shuffled, and joins are plain equi-joins that the engine may split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import table, worker_cache, written

LENGTH, K, SORTED, PAIRED = 200, 50, 20_000, 64
W = LENGTH - K + 1
BLOCK = 1 << 19
POS = (1 << 20) - 1
BASE = 0x9E3779B97F4A7C15 | 1

SEGMENT_SCHEMA = "h long, sh long, k long, salt int, s0 int, n int, a0 int"


class Hashes:
    """Prefix polynomial hashes modulo 2**64 of byte arrays up to a size."""

    def __init__(self, size: int):
        rng = np.random.default_rng(2024)
        self.of_byte = rng.integers(0, 2**64, 256, np.uint64) | np.uint64(1)
        self.grow(size)

    def grow(self, size: int) -> None:
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(BASE))]))
            self.inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, np.uint64(pow(BASE, -1, 2**64)))]))

    def prefix(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.power):
            self.grow(2 * len(data))
        with np.errstate(over="ignore"):
            return np.concatenate([[np.uint64(0)], np.cumsum(self.of_byte[data] * self.power[: len(data)])])

    def of(self, prefix: np.ndarray, at, length) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (prefix[at + length] - prefix[at]) * self.inverse[at]


def hashes() -> Hashes:
    cache = worker_cache()
    if "polynomial" not in cache:
        cache["polynomial"] = Hashes(1 << 16)
    return cache["polynomial"]


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def segments(data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, segment hash, first window, windows, anchor offset in it) of the segments of a text, by blocks."""
    tool = hashes()
    for start in range(0, len(data) - LENGTH + 1, BLOCK):
        part = data[start : start + BLOCK + LENGTH - 1]
        prefix = tool.prefix(part)
        grams = mix(tool.of(prefix, np.arange(len(part) - K + 1), K))
        key = (grams & np.uint64(~POS & (2**64 - 1))) | (np.uint64(POS) - np.arange(len(grams), dtype=np.uint64))
        padded = np.full(-(-len(key) // W) * W, np.uint64(2**64 - 1))
        padded[: len(key)] = key
        tiles = padded.reshape(-1, W)
        forward = np.minimum.accumulate(tiles, axis=1).ravel()
        backward = np.minimum.accumulate(tiles[:, ::-1], axis=1)[:, ::-1].ravel()
        windows = len(part) - LENGTH + 1
        least = np.minimum(backward[:windows], forward[W - 1 : W - 1 + windows])
        anchor = POS - (least & np.uint64(POS)).astype(np.int64)
        s0 = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        n = np.diff(np.append(s0, windows))
        at = anchor[s0]
        with np.errstate(over="ignore"):
            sh = mix(tool.of(prefix, s0, n + LENGTH - 1) + mix((n * 1024 + at - s0).astype(np.uint64)))
        yield grams[at].view(np.int64), sh.view(np.int64), s0 + start, n, at - s0


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and the key of a row: its doc_id and a hash of its text (rows that agree in both share their fate)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("k"), F.hash(text).alias("salt"))


def segment_table(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in SEGMENT_SCHEMA.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
        held, size = [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), t) for c, t in zip(zip(*held), kinds)], names)

        for batch in batches:
            for text, k, salt in zip(*(batch.column(c) for c in range(3))):
                data = np.frombuffer(text.as_py().encode(), np.uint8)
                for h, sh, s0, n, a0 in segments(data):
                    held.append((h, sh, np.full(len(h), k.as_py()), np.full(len(h), salt.as_py()), s0, n, a0))
                    size += len(h)
                    if size >= 20_000:
                        yield out()
                        held, size = [], 0
        if held:
            yield out()

    return rows.select("text", "k", "salt").mapInArrow(run, SEGMENT_SCHEMA)


def packed(rows: DataFrame) -> DataFrame:
    """Texts compressed, for the joins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([squeeze.compress(t.encode()) if t else b"" for t in part.column(3).to_pylist()], pa.binary())], ["doc_id", "k", "salt", "z"])

    return rows.select("doc_id", "k", "salt", "text").mapInArrow(run, "doc_id long, k long, salt int, z binary")


def unpacked(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z) if z else b""


def contents(kinds: DataFrame, texts: DataFrame) -> DataFrame:
    """h, sh, a0, bytes of one segment of each kind."""
    wanted = kinds.groupBy("k", "salt").agg(F.collect_list(F.struct("h", "sh", "s0", "n", "a0")).alias("w"))
    one = texts.select("k", "salt", "z").join(wanted, ["k", "salt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for z, w in zip(batch.column(0), batch.column(1)):
                data = unpacked(z.as_py())
                rows = [(r["h"], r["sh"], r["a0"], data[r["s0"] : r["s0"] + r["n"] + LENGTH - 1]) for r in w.as_py()]
                for at in range(0, len(rows), 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 20_000]), (pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["h", "sh", "a0", "b"])

    return one.select("z", "w").mapInArrow(run, "h long, sh long, a0 int, b binary")


class SuffixSorter:
    """Suffixes of a block of segments, each from its anchor on, compared by prefix hashes."""

    def __init__(self, parts: list[bytes], offsets: np.ndarray):
        self.data = np.frombuffer(b"".join(parts), np.uint8)
        lengths = np.array([len(p) for p in parts])
        self.first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.last = self.first + lengths
        self.anchor = self.first + offsets
        self.tool = hashes()
        self.prefix = self.tool.prefix(self.data)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common bytes from the anchors of i and j on: binary search over equal hashes."""
        x, y = self.anchor[i], self.anchor[j]
        most = np.minimum(self.last[i] - x, self.last[j] - y)
        return self._search(most, lambda length: self.tool.of(self.prefix, x, length) == self.tool.of(self.prefix, y, length))

    def extension_left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        x, y = self.anchor[i], self.anchor[j]
        most = np.minimum(x - self.first[i], y - self.first[j])
        return self._search(most, lambda length: self.tool.of(self.prefix, x - length, length) == self.tool.of(self.prefix, y - length, length))

    @staticmethod
    def _search(most: np.ndarray, equal) -> np.ndarray:
        low, step = np.zeros_like(most), 1 << 9
        while step:
            up = low + step
            fits = up <= most
            low = np.where(fits & equal(np.where(fits, up, 0)), up, low)
            step >>= 1
        return low

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix i sorts before suffix j: the byte after the common extension decides, a prefix comes first."""
        same = self.extension(i, j)
        x, y = self.anchor[i] + same, self.anchor[j] + same
        end_x, end_y = x >= self.last[i], y >= self.last[j]
        a, b = self.data[np.minimum(x, len(self.data) - 1)], self.data[np.minimum(y, len(self.data) - 1)]
        return np.where(end_x | end_y, end_x & ~end_y | (end_x & end_y & (i < j)), a < b)

    def sort(self) -> np.ndarray:
        """Mergesort from the bottom up; all merges of a level run together, each element finding its rank in the other run."""
        n = len(self.first)
        order, run = np.arange(n), 1
        while run < n:
            at = np.arange(n)
            block = at // run
            lo = np.minimum((block ^ 1) * run, n)
            hi = np.minimum(lo + run, n)
            start, end = lo.copy(), hi
            while (open_ := np.flatnonzero(lo < hi)).size:
                mid = (lo[open_] + hi[open_]) // 2
                before = self.less(order[mid], order[open_])
                lo = lo.copy()
                hi = hi.copy()
                lo[open_[before]] = mid[before] + 1
                hi[open_[~before]] = mid[~before]
            left = block % 2 == 0
            base = np.where(left, block * run, (block - 1) * run)
            target = base + (at - block * run) + (lo - start)
            merged = np.empty_like(order)
            merged[target] = order
            order, run = merged, 2 * run
        return order

    def equal_bytes(self, i: np.ndarray, j: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the bytes from ``left`` before to ``right`` after the anchors agree: no hash is believed."""
        out = np.ones(len(i), bool)
        for at in range(0, len(i), 4096):
            part = slice(at, at + 4096)
            x, y, n = self.anchor[i[part]] - left[part], self.anchor[j[part]] - left[part], (left + right)[part]
            span = np.arange(int(n.max(initial=0)))
            inside = span < n[:, None]
            most = len(self.data) - 1
            out[part] = ((self.data[np.minimum(x[:, None] + span, most)] == self.data[np.minimum(y[:, None] + span, most)]) | ~inside).all(1)
        return out


def repeated_offsets(groups: np.ndarray, parts: list[bytes], offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(segment, least, most): ranges of anchor offsets whose windows another segment of the same group has too."""
    s = SuffixSorter(parts, offsets)
    # groups first (anchors of one hash may differ), then suffixes
    order = s.sort()
    order = order[np.argsort(groups[order], kind="stable")]
    step = s.extension(order[:-1], order[1:]) if len(order) > 1 else np.zeros(0, np.int64)
    _, sizes = np.unique(groups[order], return_counts=True)
    large = np.repeat(sizes > PAIRED, sizes)
    out = _by_offsets(s, groups[order], order, step, large) if large.any() else []
    common, d = step.copy(), 1
    while d < min(len(order), PAIRED):
        i, j = order[:-d], order[d:]
        same = (groups[i] == groups[j]) & ~large[:-d]
        if not same.any():
            break
        near = np.flatnonzero(same & (common >= K))
        i, j, right = i[near], j[near], common[near]
        left = s.extension_left(i, j)
        low, high = np.maximum(LENGTH - right, 0), np.minimum(left, W - 1)
        hit = np.flatnonzero(low <= high)
        hit = hit[s.equal_bytes(i[hit], j[hit], left[hit], right[hit])]
        for x in (i, j):
            out += zip(x[hit].tolist(), low[hit].tolist(), high[hit].tolist())
        d += 1
        common = np.minimum(common[:-1], step[d - 1 :])
    return out


def _by_offsets(s: SuffixSorter, groups: np.ndarray, order: np.ndarray, step: np.ndarray, large: np.ndarray) -> list[tuple[int, int, int]]:
    """(segment, offset, offset): the repeated windows in the groups marked as large, group by group in sorted order."""
    out = []
    same = (groups[1:] == groups[:-1]) & large[1:]
    for a in range(W):
        # a run: suffixes of a group that agree in the LENGTH - a bytes from the anchor on
        new = np.concatenate([[True], ~(same & (step >= LENGTH - a))])
        run = np.cumsum(new)
        at = np.flatnonzero(large & (np.bincount(run)[run] > 1) & (s.anchor[order] - s.first[order] >= a) & (s.last[order] - s.anchor[order] >= LENGTH - a))
        if len(at) < 2:
            continue
        k = order[at]
        left = s.tool.of(s.prefix, s.anchor[k] - a, a)
        by = np.lexsort((left, run[at]))
        k, left, r = k[by], left[by], run[at][by]
        equal = (r[1:] == r[:-1]) & (left[1:] == left[:-1])
        i, j = k[:-1][equal], k[1:][equal]
        good = s.equal_bytes(i, j, np.full(len(i), a), np.full(len(i), LENGTH - a))
        for x in np.unique(np.concatenate([i[good], j[good]])).tolist():
            out.append((x, a, a))
    return out


def sorted_matches(segs: DataFrame) -> DataFrame:
    """h, sh, lo, hi: matched offset ranges within anchors of few kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def solve(rows):
            found = repeated_offsets(np.array([r[0] for r in rows]), [r[3] for r in rows], np.array([r[2] for r in rows]))
            ends: dict[int, tuple[int, int]] = {}  # between two repeated windows of a segment all bytes are covered
            for k, lo, hi in found:
                x = ends.get(k, (lo, hi))
                ends[k] = (min(x[0], lo), max(x[1], hi))
            out = [(rows[k][0], rows[k][1], lo, hi) for k, (lo, hi) in ends.items()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["h", "sh", "lo", "hi"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= 4000 and row[0] != held[-1][0]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    return segs.repartition("h").sortWithinPartitions("h").select("h", "sh", "a0", "b").mapInArrow(run, "h long, sh long, lo int, hi int")


#: Offsets that are looked up first, then between them: the windows of a segment overlap, so only its least and greatest
#: repeated offset count, and offsets between two that repeat need no look.
STRIDES = (32, 8, 1)


#: A window with at least so many bytes before its anchor holds the HALF bytes there, any other the K + HALF from the anchor on.
HALF = (LENGTH - K) // 2


def with_shared_halves(segs: DataFrame) -> DataFrame:
    """``segs`` with the marks before and after: whether another kind has the bytes that all windows of that half hold."""
    before = F.when(F.col("a0") >= HALF, F.xxhash64(F.substring("b", F.col("a0") - HALF + 1, F.lit(HALF))))
    after = F.when(F.octet_length("b") - F.col("a0") >= K + HALF, F.xxhash64(F.substring("b", F.col("a0") + 1, F.lit(K + HALF))))
    rows = segs.withColumns({"x": before, "y": after})
    for c, mark in (("x", "before"), ("y", "after")):
        shared = rows.where(F.col(c).isNotNull()).groupBy("h", c).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("h", c, F.lit(True).alias(mark))
        rows = rows.join(shared, ["h", c], "left")
    return rows.where("before or after").select("h", "sh", "a0", "b", F.coalesce("before", F.lit(False)).alias("before"), F.coalesce("after", F.lit(False)).alias("after"))


def windows(segs: DataFrame, stride: int) -> DataFrame:
    """h, sh, a, id: digest of each window that can repeat, if its offset is a multiple of the stride and beyond (lo, hi), where these are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for h, sh, a0, b, before, after, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
                at = [a for a in range(a0, a0 - (len(b) - LENGTH) - 1, -1) if a % stride == 0 and (before if a >= HALF else after) and (lo is None or not lo <= a <= hi)]
                ids = [hashlib.blake2b(b[a0 - a : a0 - a + LENGTH], digest_size=16).digest() for a in at]
                yield pa.RecordBatch.from_arrays([pa.array([h] * len(at), pa.int64()), pa.array([sh] * len(at), pa.int64()), pa.array(at, pa.int32()), pa.array(ids, pa.binary())], ["h", "sh", "a", "id"])

    return segs.select("h", "sh", "a0", "b", "before", "after", "lo", "hi").mapInArrow(run, "h long, sh long, a int, id binary")


def counted_matches(segs: DataFrame) -> DataFrame:
    """The same for anchors of many kinds: windows counted by digest, no kinds compared."""
    segs = written(with_shared_halves(segs), "halves")
    bounds = segs.withColumns({"lo": F.lit(None).cast("int"), "hi": F.lit(None).cast("int")})
    again = written(windows(bounds, 1).groupBy("id", "a").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("id", "a"), "again")
    for stride in STRIDES:
        found = windows(bounds, stride).join(again, ["id", "a"]).groupBy("h", "sh").agg(F.min("a").alias("x"), F.max("a").alias("y"))
        wider = segs.join(found.union(bounds.where("lo is not null").select("h", "sh", "lo", "hi")).groupBy("h", "sh").agg(F.min("x").alias("lo"), F.max("y").alias("hi")), ["h", "sh"], "left")
        bounds = written(wider, "bounds")
    return bounds.where("lo is not null").select("h", "sh", "lo", "hi")


def covered_ranges(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """k, salt, ranges: the byte ranges of each document that repeated windows cover, as (start, end)."""
    places = segment_table(rows)
    again = places.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min("sh").alias("x"), F.max("sh").alias("y")).where("c > 1").select("h", (F.col("x") != F.col("y")).alias("mixed"))
    met = written(places.join(again, "h"), "segments")
    whole = lambda d: d.select("k", "salt", F.col("s0").alias("start"), (F.col("s0") + F.col("n") - 1 + LENGTH).alias("end"))
    mixed = met.where("mixed")
    place = F.struct("k", "salt", "s0", "n", "a0")
    kinds = written(mixed.groupBy("h", "sh").agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("p")), "kinds")
    copies = kinds.where("c > 1").select("h", "sh")
    sizes = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("m"))
    segs = written(contents(kinds.select("h", "sh", "p.*"), texts).join(sizes, "h"), "contents")
    matches = sorted_matches(segs.where(F.col("m") <= SORTED)).union(counted_matches(segs.where(F.col("m") > SORTED)))
    single = kinds.where("c = 1").select("h", "sh", "p.*").join(matches, ["h", "sh"])
    first = F.greatest(F.col("s0") + F.col("a0") - F.col("hi"), F.col("s0"))
    last = F.least(F.col("s0") + F.col("a0") - F.col("lo"), F.col("s0") + F.col("n") - 1)
    ranges = whole(met.where("not mixed")).union(whole(mixed.join(copies, ["h", "sh"]))).union(single.where(first <= last).select("k", "salt", first.alias("start"), (last + LENGTH).alias("end")))
    return written(ranges.groupBy("k", "salt").agg(F.collect_set(F.struct("start", "end")).alias("ranges")), "ranges")


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes): one row per row of ``docs`` (``doc_id``, ``text``).

    A null text is empty; texts shorter than LENGTH bytes lose nothing; all copies of a string lose it,
    the first too.  Rows that repeat a doc_id are texts of their own; an empty table gives no rows; other columns are not read.
    """
    rows = keyed(docs)
    texts = packed(rows)
    joined = texts.join(covered_ranges(rows, texts), ["k", "salt"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        for batch in batches:
            for part in (batch.slice(at, 64) for at in range(0, batch.num_rows, 64)):
                out = []
                for doc_id, z, ranges in zip(*(c.to_pylist() for c in part.columns)):
                    data, spans = unpacked(z), merged([(r["start"], r["end"]) for r in ranges or ()])
                    kept, at, digest = [], 0, hashlib.sha256()
                    for start, end in [*spans, (len(data), len(data))]:
                        digest.update(data[at:start])
                        if keep_text:
                            kept.append(data[at:start])
                        at = end
                    out.append((doc_id, len(data), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), b"".join(kept) if keep_text else None))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    out = joined.select("doc_id", "z", "ranges").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if keep_text else out.drop("kept")


def _cut_texts(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    out = []
    for t, a, b in zip(texts, starts, ends):
        if t is not None and a is not None:
            data, kept, last = t.encode(), [], 0
            for start, end in merged(list(zip(a, b))):
                kept.append(data[last:start])
                last = end
            t = b"".join(x.decode(errors="ignore").encode() for x in [*kept, data[last:]]).decode()
        out.append(t)
    return pd.Series(out, dtype=object)


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns, the text without its repeated bytes.

    A cut may split a character; the parts of it that are left are dropped, so the text stays UTF-8.  Null
    texts stay null; every row stays, rows that repeat a doc_id too; an empty table gives no rows; other columns may
    have any names.
    """
    rows = keyed(docs)
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("k"), F.hash(F.coalesce(F.col("text"), F.lit(""))).alias("salt"))
    joined = row.join(covered_ranges(rows, packed(rows)), ["k", "salt"], "left")

    cut = F.pandas_udf(_cut_texts, "string")(F.col("row.text"), F.transform("ranges", lambda r: r["start"]), F.transform("ranges", lambda r: r["end"]))
    text = F.when(F.col("ranges").isNull(), F.col("row.text")).otherwise(cut).alias("text")
    return joined.select(*[text if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op7_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
