"""I-Match fingerprints over randomised subsets of a document-frequency band.

The lexicon holds the terms whose document frequency is a share of all documents within a band: common
terms say little, rare ones are typing slips.  Its size is bounded whatever the corpus (each term of at
least ``low`` of the documents takes that share of all distinct terms of documents, so there are at most mean
distinct terms / ``low``); a band of more than ``MOST_TERMS`` is an error, never cut.  A
fingerprint joins the hashes of a document's sorted distinct lexicon terms, one hash for each of several
random subsets of the lexicon.  The subsets come in sizes, so that texts of any length have some subset
that a moderate edit leaves alone; subsets without terms of the document say nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import table

WORD = re.compile(r"\w+")
LOW, HIGH = 1 / 2000, 1 / 10
RATES = (1 / 8, 1 / 32, 1 / 128, 1 / 512, 1 / 2048)
SUBSETS_PER_RATE = 20
MOST_TERMS = 2_000_000
#: Hex digits of the hash of all terms and of the hash of a subset.
WHOLE, SUBSET = 16, 4
EMPTY = "-" * SUBSET
LIMITS = np.repeat([int(r * 2**32) for r in RATES], SUBSETS_PER_RATE).astype(np.uint64)

FINGERPRINT_SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def terms_of(text: str) -> set[str]:
    """Distinct lower-case words; very long ones stand as their digest."""
    out = set(WORD.findall(text.lower()))
    for t in [t for t in out if len(t) > 64]:
        out.remove(t)
        out.add("#" + hashlib.blake2b(t.encode(), digest_size=16).hexdigest())
    return out


def document_frequencies(docs: DataFrame, text_col: str = "text", held: int = 200_000) -> DataFrame:
    """term, n: in how many documents each term stands; counted in the workers before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        out = lambda: pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int32())], ["term", "n"])
        for batch in batches:
            for text in batch.column(0):
                counts.update(terms_of(text.as_py() or ""))
                if len(counts) >= held:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return docs.select(F.col(text_col)).mapInArrow(run, "term string, n int").groupBy("term").agg(F.sum("n").alias("n"))


def choose_lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH, most: int = MOST_TERMS) -> list[str]:
    """Terms in the band; bounded, see above.  Document counts and frequencies cover all rows."""
    total = docs.count()
    band = document_frequencies(docs).where((F.col("n") >= low * total) & (F.col("n") <= max(high * total, 1))).persist()
    try:
        if (size := band.count()) > most:
            raise ValueError(f"{size} terms in the band, more than a worker should hold: raise low or most")
        return [r.term for r in band.select("term").toLocalIterator()]
    finally:
        band.unpersist()


class Lexicon(dict):
    """term -> the subsets it is in, for terms of the lexicon."""

    def __init__(self, terms):
        self.terms = frozenset(terms)

    def __missing__(self, term: str):
        draws = np.frombuffer(hashlib.shake_128(term.encode()).digest(4 * len(LIMITS)), "<u4")
        out = self[term] = tuple(np.flatnonzero(draws < LIMITS).tolist())
        return out

    def fingerprint(self, text: str) -> str:
        """One hash of all terms, then one for each subset.  A text without lexicon terms is known by all of its words."""
        known = sorted(self.terms & terms_of(text))
        if not known:
            return hashlib.blake2b(" ".join(WORD.findall(text.lower())).encode(), digest_size=WHOLE // 2).hexdigest() + EMPTY * len(LIMITS)
        parts: list[list[str] | None] = [None] * len(LIMITS)
        for t in known:
            for j in self[t]:
                if parts[j] is None:
                    parts[j] = [t]
                else:
                    parts[j].append(t)
        digest = lambda ts, n: EMPTY if ts is None else hashlib.blake2b("\n".join(ts).encode(), digest_size=n // 2).hexdigest()
        return digest(known, WHOLE) + "".join(digest(ts, SUBSET) for ts in parts)


def likeness(a: str, b: str) -> float:
    """Share of equal hashes among the subsets in which either text has terms; equal fingerprints give 1."""
    if a == b:
        return 1.0
    same = either = 0
    for k in range(WHOLE, len(a), SUBSET):
        x, y = a[k : k + SUBSET], b[k : k + SUBSET]
        if x != EMPTY or y != EMPTY:
            either += 1
            same += x == y
    return same / either if either else 0.0


def with_next(docs: DataFrame, per_partition: int = 4) -> tuple[DataFrame, int]:
    """Rows in descending doc_id, dealt in ranges of ids, each range followed by the first row of the next.

    Ranges come from the quantiles of doc_id alone.  Texts travel once, compressed.  A row that opens
    a range also goes to the range before it, as its last row (``ghost``); the first of all rows so closes the last range.
    """
    spark = docs.sparkSession
    ranges = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    bounds = sorted({int(x) for x in docs.select(key.cast("double").alias("k")).approxQuantile("k", [i / ranges for i in range(1, ranges)], 0.2 / ranges)}, reverse=True) if ranges > 1 else []
    ids = docs.select(key.alias("k"))
    firsts = sorted((r.part, r.k) for r in ids.groupBy(_search(F.col("k"), bounds).alias("part")).agg(F.max("k").alias("k")).collect())  # one row a range
    before = {k: firsts[i - 1][0] for i, (_, k) in enumerate(firsts)}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        low = np.array(sorted(-b for b in bounds), dtype=object)
        names, kinds = ["part", "ghost", "k", "doc_id", "n", "z"], (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        for batch in batches:
            rows = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                k, text = -(2**63) if doc_id is None else doc_id, text or ""
                z = squeeze.compress(text.encode())
                part = int(np.searchsorted(low, -k, side="right")) if len(low) else 0
                rows.append((part, False, k, doc_id, len(text), z))
                if k in before:
                    rows.append((before[k], True, k, doc_id, len(text), z))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, kinds)], names)

    dealt = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(pack, "part int, ghost boolean, k long, doc_id long, n long, z binary")
    return dealt.repartition("part").sortWithinPartitions("part", "ghost", F.desc("k"), "n", "z"), ranges


def _search(k, bounds: list[int]):
    """How many of the descending bounds are >= k, as the workers count it: part 0 holds the largest ids."""
    if not bounds:
        return F.lit(0)
    asc = F.array(*[F.lit(b) for b in bounds])
    return F.size(F.filter(asc, lambda b: b >= k))


def fingerprint_documents(docs: DataFrame, low: float = LOW, high: float = HIGH) -> DataFrame:
    """Fingerprints of each document (``doc_id``, ``text``) and of its edited text; one row per input row.

    The next document is the next in descending doc_id; rows that share a doc_id follow each other by
    length and content, a null doc_id comes last, after the last row comes the first.  A null text is empty; a
    lone document is its own next; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = spark.sparkContext.broadcast(choose_lexicon(docs, low, high))
    rows, _ = with_next(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, expand = Lexicon(shared.value), zstandard.ZstdDecompressor()
        held: tuple | None = None
        names = [c.split()[0] for c in FINGERPRINT_SCHEMA.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        for batch in batches:
            out = []
            for part, ghost, doc_id, z in zip(*(batch.column(c).to_pylist() for c in ("part", "ghost", "doc_id", "z"))):
                if held is not None and held[0] == part:
                    text = expand.decompress(z).decode() if z else ""
                    print_ = lexicon.fingerprint(text)
                    out.append(_row(lexicon, held, text, print_))
                    held = None if ghost else (part, doc_id, text, print_)
                elif not ghost:
                    text = expand.decompress(z).decode() if z else ""
                    held = (part, doc_id, text, lexicon.fingerprint(text))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 7, kinds)], names)

    return rows.select("part", "ghost", "doc_id", "z").mapInArrow(run, FINGERPRINT_SCHEMA)


def _row(lexicon: Lexicon, held: tuple, following: str, following_print: str) -> tuple:
    _, doc_id, text, print_ = held
    n = len(text) // 3
    edited = text[: len(text) - n] + following[:n]
    edited_print = print_ if edited == text else lexicon.fingerprint(edited)
    return doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), print_, edited_print, likeness(print_, edited_print), likeness(print_, following_print)


def op6_imatch(spark, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))
