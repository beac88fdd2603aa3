"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

The kernel counts common subsequences of three characters within ``SPAN`` characters, each damped by ``DECAY`` for every
character it spans, so an insult with gaps or inserted characters stays close to the insult; words are
scaled by their length.

Training takes labelled sentences: each sentence of a labelled text carries the label of the text.  The SVM is one of
multiple instances: the decision on a sentence is that of its worst word, a clean sentence asks that of all its
words, and a toxic text has a few words in its sentences, the witnesses, that make it toxic.  Witnesses are first the words
whose log-odds between toxic and clean texts are highest, then those that the SVM finds worst; it is
trained again until they stay.  A share ``OUTLIERS`` of the toxic texts may stay without a convincing witness, since labels
err.  Landmarks are witnesses and common or similar words of clean sentences; the Nystroem map of a
word is its kernel row with the landmarks times the inverse root of the landmarks' kernel matrix.

A decision is linear in the kernel rows, so once trained it is folded into one weight for each
subsequence of the landmarks, and a word is decided by looking up its own subsequences: exact, and
independent of the number of landmarks.  The worst decision and the number of toxic words of a text give its score,
by a calibration on labelled texts that were held back from training.

Training takes a bounded sample of labelled documents (``MOST_TOXIC``, ``MOST_CLEAN``); scoring reads
every word of every text.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import math
import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import table

SPAN, DECAY, WINDOW = 7, 0.8, 24
#: Buckets of subsequence weights; a few thousand are in use.
BUCKETS = 1 << 21
MOST_TOXIC, MOST_CLEAN = 2000, 4000
TOXIC_LANDMARKS, CLEAN_LANDMARKS = 96, 64
FLOOR = -3.0
#: Share of toxic texts that may lack a witness; most rounds of training and choosing witnesses; most witnesses of a text.
OUTLIERS, ROUNDS, WITNESSES = 0.15, 2, 8
SENTENCE = re.compile(r"\n|(?<=[.!?])\s+")
SPELLED = re.compile(r"(?<!\S)\w(?:[\s._*-]+\w){2,}(?!\S)")


def units(text: str) -> set[str]:
    """What the kernel compares: lower-case words, spelled-out runs of single letters as one word, words without
    their punctuation, and long words in overlapping windows."""
    text = text.lower()
    words = set(text.split())
    out = set()
    for w in words:
        if not w.isalpha():
            bare = "".join(filter(str.isalnum, w))
            out.add(bare)
        else:
            out.add(w)
    for run in SPELLED.findall(text):
        out.add("".join(filter(str.isalnum, run)))
    for w in [w for w in out if len(w) > WINDOW]:
        out.remove(w)
        out.update(w[at : at + WINDOW] for at in range(0, len(w) - WINDOW // 2, WINDOW // 2))
    return {w for w in out if len(w) >= 3}


@functools.cache
def triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the subsequences of a word of that length, and their weights scaled to length one."""
    at = np.array([(i, j, k) for i in range(length) for j in range(i + 1, min(length, i + SPAN)) for k in range(j + 1, min(length, i + SPAN))])
    weight = DECAY ** (at[:, 2] - at[:, 0] + 1)
    return at, weight / np.linalg.norm(weight)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each subsequence of words of one length (rows), and the weights."""
    at, weight = triples(len(words[0]))
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)
    h = (codes[:, at[:, 0]] * np.uint64(0x9E3779B1) + codes[:, at[:, 1]]) * np.uint64(0x85EBCA77) + codes[:, at[:, 2]]
    h *= np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(43)).astype(np.int64), weight


def by_length(words: list[str], most: int = 1024) -> Iterator[list[int]]:
    """Indices of words of one length at a time."""
    groups: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        groups.setdefault(len(w), []).append(k)
    for g in groups.values():
        for at in range(0, len(g), most):
            yield g[at : at + most]


class Landmarks:
    """The landmarks and their Nystroem map."""

    def __init__(self, words: list[str]):
        self.words = words
        rows = []
        for j, w in enumerate(words):
            ids, weight = subsequences([w])
            rows.append((ids[0], np.full(len(weight), j), weight))
        ids, self.column, self.weight = (np.concatenate(x) for x in zip(*rows))
        self.buckets, self.row = np.unique(ids, return_inverse=True)
        self.table = np.zeros((len(self.buckets) + 1, len(words)))  # the last row: none of the landmarks'
        np.add.at(self.table, (self.row, self.column), self.weight)
        gram = self.kernel(words)
        values, vectors = np.linalg.eigh((gram + gram.T) / 2)
        keep = values > 1e-6
        self.map = vectors[:, keep] / np.sqrt(values[keep])

    def kernel(self, words: list[str]) -> np.ndarray:
        """Kernel of words with the landmarks."""
        out = np.zeros((len(words), len(self.words)))
        for group in by_length(words, 256):
            ids, weight = subsequences([words[k] for k in group])
            at = np.minimum(np.searchsorted(self.buckets, ids), len(self.buckets) - 1)
            at = np.where(self.buckets[at] == ids, at, len(self.buckets))
            for c in range(at.shape[1]):
                out[group] += self.table[at[:, c]] * weight[c]
        return out

    def folded(self, alpha: np.ndarray) -> np.ndarray:
        """Weight of each bucket under a decision that is linear in the kernel rows."""
        out = np.zeros(BUCKETS, np.float32)
        out[self.buckets] = self.table[:-1] @ alpha
        return out


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Squared-hinge linear SVM with balanced classes, by gradient steps with momentum."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, b, vw, vb = np.zeros(x.shape[1]), 0.0, np.zeros(x.shape[1]), 0.0
    step = 0.25 / max(1e-9, np.mean((x**2).sum(1)) + 1)
    for _ in range(rounds):
        slack = np.maximum(0, 1 - y * (x @ w + b)) * weight * y
        vw = 0.9 * vw + step * (2 * slack @ x - w * 1e-4 / cost)
        vb = 0.9 * vb + step * 2 * slack.sum()
        w, b = w + vw, b + vb
    return w, b


class Model:
    """Word decisions and the calibrated score of a text."""

    def __init__(self, landmarks: Landmarks, w: np.ndarray, b: float):
        self.words, self.b = landmarks.words, b
        self.weights = landmarks.folded(landmarks.map @ w)
        self.calibration = (1.0, 0.0, 0.0, 0.0)

    def decide(self, words: list[str]) -> np.ndarray:
        out = np.empty(len(words))
        for group in by_length(words):
            ids, weight = subsequences([words[k] for k in group])
            out[group] = self.weights[ids] @ weight
        return np.clip(out + self.b, FLOOR, -FLOOR)

    def score(self, worst: float, toxic_words: int, words: int) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.calibration, evidence(worst, toxic_words, words)), -30, 30))))


def evidence(worst: float, toxic_words: int, words: int) -> tuple[float, float, float, float]:
    """What the calibration sees of a text: its worst decision, how many and which share of its words are toxic."""
    return max(0.0, worst), math.log1p(toxic_words), 10 * toxic_words / max(10, words), 1.0


def sentences(text: str) -> list[str]:
    return [x for x in SENTENCE.split(text) if x.strip()]


def train(texts: list[str], labels: list[int]) -> Model | None:
    """The model of all texts, calibrated by one that has not seen every fifth; None where the sample lacks a class."""
    sets = [sorted({sys.intern(w) for x in sentences(t) for w in units(x)}) for t in texts]
    if len(set(labels)) < 2:
        return None
    model = learn(sets, labels)
    if model is None:
        return None
    back = [k for c in (0, 1) for k in [i for i, y in enumerate(labels) if y == c][::5]]
    kept = sorted(set(range(len(labels))) - set(back))
    judge = learn([sets[k] for k in kept], [labels[k] for k in kept]) if len({labels[k] for k in kept}) == 2 else None
    judge, back = (judge, back) if judge else (model, range(len(labels)))
    cache: dict[str, float] = {}
    model.calibration = calibrate(np.array([summary(judge, sets[k], cache) for k in back]), np.array([labels[k] for k in back]))
    return model


def learn(sets: list[list[str]], labels: list[int]) -> Model | None:
    """The multiple-instance SVM over the words of the labelled sentences; None where no toxic text has a word."""
    toxic, clean = Counter(), Counter()
    for words, label in zip(sets, labels):
        (toxic if label else clean).update(words)
    n1, n0 = sum(1 for x in labels if x), sum(1 for x in labels if not x)
    bags = [s for s, label in zip(sets, labels) if label and s]
    if not bags:
        return None
    odds = {w: math.log((c + 0.5) / (n1 + 1)) - math.log((clean[w] + 0.5) / (n0 + 1)) for w, c in toxic.items()}

    def worst_of(words: list[str], measure: dict[str, float], below: float, least: float) -> list[str]:
        """The word with the highest measure and the next ones that come near it."""
        order = sorted(words, key=lambda w: (-round(measure[w], 6), -odds[w], -len(w), w))[:WITNESSES]
        return [w for k, w in enumerate(order) if not k or measure[w] >= max(least, measure[order[0]] - below)]

    repeated = [[w for w in s if toxic[w] > 1] or s for s in bags]
    witness = [worst_of(s, odds, 1.5, 1.5) for s in repeated]
    rng = np.random.default_rng(5)
    others = sorted(clean)
    common = [w for w, _ in sorted(clean.items(), key=lambda x: (-x[1], x[0]))[: CLEAN_LANDMARKS // 2]]
    some = [others[k] for k in rng.permutation(len(others))[:10_000]]
    model, cache = None, {}
    for _ in range(ROUNDS):
        support = Counter(w for ws in witness for w in ws)
        chosen = [w for w, _ in sorted(support.items(), key=lambda x: (-x[1], x[0]))][:TOXIC_LANDMARKS]
        probe = Landmarks(chosen)
        near = np.argsort(-probe.kernel(some).max(1), kind="stable") if some else []
        landmarks = Landmarks(list(dict.fromkeys(chosen + common + [some[k] for k in near[: CLEAN_LANDMARKS // 2]])))
        # a witness of one text alone may be a slip of the label, so a word weighs by the texts that it explains
        firm = {w: min(c, 5) for w, c in support.items() if c > 1} or support
        positive = [w for w, c in sorted(firm.items()) for _ in range(c)]
        negative = list(dict.fromkeys(common + some))
        for _ in range(2):  # then with the negatives that come closest
            x = (landmarks.kernel(positive + negative) @ landmarks.map).astype(np.float32)
            y = np.array([1.0] * len(positive) + [-1.0] * len(negative))
            model = Model(landmarks, *train_svm(x, y))
            decided = model.decide(others) if others else np.zeros(0)
            negative = list(dict.fromkeys(negative[:8000] + [others[k] for k in np.argsort(-decided, kind="stable")[:4000]]))
        words = sorted({w for s in bags for w in s})
        cache = dict(zip(words, model.decide(words).tolist()))
        before, witness = witness, [worst_of(s, cache, 1.0, 0.0) for s in bags]
        # texts without a convincing witness are outliers, up to their share
        weakest = sorted(range(len(bags)), key=lambda k: (cache[witness[k][0]], k))[: int(OUTLIERS * len(bags))]
        weak = {k for k in weakest if cache[witness[k][0]] <= 0}
        witness = [w for k, w in enumerate(witness) if k not in weak] or before
        if witness == before:
            break
    return model


def calibrate(stats: np.ndarray, labels: np.ndarray) -> tuple[float, ...]:
    """Logistic weights of the evidence; evidence that would count against toxicity is left out, worst first."""
    x = np.array([evidence(*row) for row in stats])
    used = list(range(x.shape[1]))
    while True:
        theta, part = np.zeros(len(used)), x[:, used]
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(part @ theta, -30, 30)))
            h = (part * (p * (1 - p))[:, None]).T @ part + np.eye(len(used)) * 1e-1
            theta = theta + np.linalg.solve(h, part.T @ (labels - p) - 1e-1 * theta)
        least = int(np.argmin(theta[:-1])) if len(used) > 1 else -1
        if least < 0 or theta[least] >= 0:
            out = np.zeros(x.shape[1])
            out[used] = theta
            return tuple(float(t) for t in out)
        used.pop(least)


def summary(model: Model, words, cache: dict[str, float]) -> tuple[float, int, int]:
    new = [w for w in words if w not in cache]
    if new:
        cache.update(zip(new, model.decide(new).tolist()))
    found = [cache[w] for w in words]
    return max(found, default=FLOOR), sum(d > 0 for d in found), len(found)


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int]]:
    """Texts and labels of at most MOST_TOXIC and MOST_CLEAN documents of the learning folds, in the order of a hash of their ids."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").alias("toxic")).where(~held_out())
    picks = [known.where(c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for c, n in (("toxic = 1", MOST_TOXIC), ("toxic = 0", MOST_CLEAN))]
    ids = picks[0].union(picks[1])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").join(F.broadcast(ids), "doc_id").select("doc_id", "text", "toxic").collect()
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return [r.text for r in rows], [int(r.toxic) for r in rows]


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model, learned on the driver from the bounded sample; the memory that this took is given back."""
    model = train(*labelled_sample(docs, labels))
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)
    return model


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per row of ``docs`` (``doc_id``, ``text``).

    A null or empty text has no words and gets the lowest score; without a model (no labels to learn from)
    every score is 0.  A null doc_id counts as held out.  Repeated rows are scored alike; an empty table gives
    no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of landmarks

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        cache = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [units(t or "") for t in part.column(2).to_pylist()] if model else []
                if model:
                    if len(cache) > 400_000:
                        cache.clear()
                    new = list({w for s in sets for w in s if w not in cache})
                    cache.update(zip(new, model.decide(new).tolist()))
                scores = [model.score(*summary(model, s, cache)) for s in sets] if model else [0.0] * part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_clean(docs: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below the threshold."""
    if model is None:
        return docs
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache = shared.value, {}
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                sets = [units(t or "") for t in part.column(at).to_pylist()]
                if len(cache) > 400_000:
                    cache.clear()
                new = list({w for s in sets for w in s if w not in cache})
                cache.update(zip(new, model.decide(new).tolist()))
                yield part.filter(pa.array([model.score(*summary(model, s, cache)) < threshold for s in sets]))

    return docs.mapInArrow(run, docs.schema)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
