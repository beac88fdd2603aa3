"""Quality by co-training of two views of a page.

The text view sees the content: hashed character trigrams, averaged over the words of a text, and the shares of letters,
capitals, digits, marks and repetition.  The
metadata view sees nothing of the words: source, language, and the extent of the page (its length, its lines and
how long they are).  Both start from the labelled pages.  In each round each
view marks the pages of an unlabelled pool that it is surest of, in the proportion of the classes, and
the other view learns them with these pseudo-labels.  At the end each view is calibrated on labelled
pages it has not learned from, and the two log-odds are combined.

Learning takes a bounded sample (``MOST_LABELLED``, ``MOST_POOL``); every document is scored on its whole text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import table

MOST_LABELLED, MOST_POOL, ROUNDS, DIMENSIONS, SHARE, SURE = 3000, 2000, 5, 1024, 0.08, 0.9
SLOTS, EXTENT, FORMS = 48, 37, 10


def trigrams(word: str) -> np.ndarray:
    """Slots of all trigrams of the word; text without spaces is one word, so they are made one by one."""
    padded = f"^{word}$"
    return np.fromiter((xxhash.xxh3_64_intdigest(padded[i : i + 3].encode()) % DIMENSIONS for i in range(len(padded) - 2)), np.int32, len(padded) - 2)


def text_view(text: str, words: list[str], cache: dict[str, np.ndarray]) -> np.ndarray:
    out = np.zeros(DIMENSIONS + FORMS, np.float32)
    out[DIMENSIONS:] = form_view(text, words)
    if words:
        grams = []
        for w in words:
            g = cache.get(w)
            if g is None:
                g = cache[w] = trigrams(w)
            grams.append(g)
        sizes = np.fromiter(map(len, grams), np.int64, len(grams))
        out[:DIMENSIONS] = np.bincount(np.concatenate(grams), np.repeat(1 / sizes, sizes), DIMENSIONS) / len(words) * 10
    return out


def form_view(text: str, words: list[str]) -> list[float]:
    """Bounded shares of kinds of characters, words and lines."""
    n, raw, lines = max(1, len(text)), text.encode(), text.split("\n")
    letters = sum(map(len, filter(str.isalpha, words)))
    capitals = sum(map(raw.count, map(bytes, ([b] for b in range(65, 91)))))
    digits = sum(map(raw.count, map(bytes, ([b] for b in range(48, 58)))))
    marks = sum(map(raw.count, (b"!", b"?", b"#", b"$", b"%", b"&", b"*", b"|", b"@", b"=", b"_", b"~", b"^")))
    full = sum(raw.count(b) for b in (b".", b","))
    some = max(1, len(words))
    return [letters / n, 4 * capitals / n, 4 * digits / n, 4 * marks / n, 8 * full / n, len(set(words)) / some, len(set(lines)) / len(lines), min(3.0, n / some / 8), sum(map(str.isalpha, words)) / some, sum(map(str.isupper, words)) / some]


def metadata_view(text: str, lang: str | None, source: str | None) -> np.ndarray:
    """Bounded numbers about the extent of the page, also in steps, so that a linear view may bend; the fields in hashed slots."""
    n, lines = len(text), text.count("\n") + 1
    numbers = [1.0]
    for x in (math.log1p(n), math.log1p(lines), math.log1p(n / lines)):
        numbers += [x / 10, *(min(1.0, max(0.0, x - k)) for k in range(1, 12))]
    out = np.zeros(EXTENT + 2 * SLOTS)
    out[:EXTENT] = numbers
    for k, field in enumerate((lang, source)):
        out[EXTENT + k * SLOTS + xxhash.xxh3_64_intdigest((field or "").encode()) % SLOTS] = 0.5
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 150, decay: float = 1e-4) -> np.ndarray:
    """Logistic regression with balanced classes, by accelerated gradient steps."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))
    y, weight = y.astype(np.float32), weight.astype(np.float32)
    step = 4.0 / max(1e-9, float(weight @ (x**2).sum(1)))
    theta = ahead = np.zeros(x.shape[1], np.float32)
    for k in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        new = ahead - np.float32(step) * (x.T @ (weight * (p - y)) + decay * ahead)
        ahead = new + np.float32(k / (k + 3)) * (new - theta)
        theta = new
    return theta


def margin(theta: np.ndarray, x: np.ndarray) -> np.ndarray:
    return x @ theta[:-1] + theta[-1]


class Model:
    """Weights of both views and their calibrated combination."""

    def __init__(self, text: np.ndarray, meta: np.ndarray, combine: np.ndarray, calibrations: list[np.ndarray]):
        self.text, self.meta, self.combine, self.calibrations = text, meta, combine, calibrations

    def word(self, word: str) -> float:
        grams = trigrams(word)
        return float(self.text[grams].mean()) * 10

    def scores(self, text_margin: float, meta_margin: float) -> tuple[float, float, float]:
        squash = lambda z: float(1 / (1 + np.exp(-np.clip(z, -30, 30))))
        views = [squash(c[0] * m + c[1]) for c, m in zip(self.calibrations, (text_margin, meta_margin))]
        return *views, squash(self.combine[0] * text_margin + self.combine[1] * meta_margin + self.combine[2])


def platt(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Calibration of one or more margins, by Newton steps with a small ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    theta = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        theta = theta + np.linalg.solve((x.T * (p * (1 - p))) @ x + 0.05 * np.eye(x.shape[1]), x.T @ (y - p) - 0.05 * theta)
    return theta


def co_train(views: list[np.ndarray], y: np.ndarray, pool: list[np.ndarray], rounds: int = ROUNDS) -> tuple[list[np.ndarray], list[list]]:
    """Weights of both views; each learns the other's surest pseudo-labels."""
    taught: list[list[tuple[int, int]]] = [[], []]
    used = np.zeros(len(pool[0]), bool)
    theta = [fit_logistic(v, y) for v in views]
    per_round = max(1, int(SHARE * len(used)))
    for _ in range(rounds):
        new: list[list[tuple[int, int]]] = [[], []]
        for k in (0, 1):
            p = 1 / (1 + np.exp(-np.clip(margin(theta[k], pool[k]), -30, 30)))
            for label, sure, share in ((1, p, y.mean()), (0, 1 - p, 1 - y.mean())):
                order = [i for i in np.argsort(-sure, kind="stable") if not used[i] and sure[i] >= SURE][: max(1, round(share * per_round))]
                used[order] = True
                new[1 - k] += [(int(i), label) for i in order]
        if not any(new):
            break
        for k in (0, 1):
            taught[k] += new[k]
            if taught[k]:
                at, labels = map(list, zip(*taught[k]))
                theta[k] = fit_logistic(np.concatenate([views[k], pool[k][at]]), np.concatenate([y, labels]))
    return theta, taught


def train(labelled: list[tuple], pool: list[tuple]) -> Model | None:
    """Rows are (text, lang, source[, quality]); None where a class is missing."""
    cache: dict[str, np.ndarray] = {}
    both = lambda rows: [np.array([f(r) for r in rows]) for f in (lambda r: text_view(r[0], r[0].split(), cache), lambda r: metadata_view(r[0], r[1], r[2]))]
    y = np.array([r[3] for r in labelled], float)
    if len(set(y)) < 2:
        return None
    views, unlabelled = both(labelled), both(pool) if pool else [np.zeros((0, DIMENSIONS + FORMS)), np.zeros((0, EXTENT + 2 * SLOTS))]
    kept_back = np.arange(len(y)) % 5 == 0
    learn, check = (kept_back == 0, kept_back) if len(set(y[kept_back])) == 2 and len(set(y[~kept_back])) == 2 else (np.ones(len(y), bool),) * 2
    theta, _ = co_train([v[learn] for v in views], y[learn], unlabelled)
    margins = [margin(t, v[check]) for t, v in zip(theta, views)]
    return Model(*theta, platt(np.column_stack(margins), y[check]), [platt(m, y[check]) for m in margins])


def held_out() -> F.Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def samples(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple], list[tuple]]:
    """Bounded samples, by a hash of doc_id: labelled documents outside the held-out fifth, and a pool without labels."""
    known = labels.where("quality is not null and doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    ids = known.where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source").where("text is not null and doc_id is not null")
    labelled = rows.join(F.broadcast(ids), "doc_id").collect()
    open_ids = rows.select("doc_id").distinct().join(known, "doc_id", "left_anti").where(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_POOL)
    pool = rows.join(F.broadcast(open_ids), "doc_id").collect()
    order = lambda r: (r.doc_id, r.text)
    return [(r.text, r.lang, r.source, int(r.quality)) for r in sorted(labelled, key=order)], [(r.text, r.lang, r.source) for r in sorted(pool, key=order)]


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    return train(*samples(docs, labels))


SCORE_SCHEMA = "doc_id long, held_out boolean, text_score double, metadata_score double, score double, kept boolean"


def score_documents(docs: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, text_score, metadata_score, score, kept: one row per row of ``docs`` (``doc_id``, ``text``, ``lang``, ``source``).

    Scores are probabilities of good quality.  A null text is empty and is scored as such; null lang and source are
    values of their own; a null doc_id counts as held out; without a model every score is 1 and all is
    kept.  Repeated rows are scored alike; an empty table gives no rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, cache, held = shared.value, {}, 0
        names = [c.split()[0] for c in SCORE_SCHEMA.split(", ")][2:]
        for batch in batches:
            out = []
            for text, lang, source in zip(*(c.to_pylist() for c in batch.columns[2:])):
                text = text or ""
                words = text.split()
                if model is None:
                    out.append((1.0, 1.0, 1.0, True))
                    continue
                if len(cache) > 400_000 or held > 8_000_000:
                    cache.clear()
                    held = 0
                for w in set(words):
                    if w not in cache:
                        cache[w] = model.word(w)
                        held += len(w)
                view = sum(map(cache.__getitem__, words)) / max(1, len(words)) + float(np.dot(form_view(text, words), model.text[DIMENSIONS:-1])) + float(model.text[-1])
                scores = model.scores(view, float(margin(model.meta, metadata_view(text, lang, source))))
                out.append((*scores, scores[2] >= threshold))
            kinds = (pa.float64(),) * 3 + (pa.bool_(),)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, kinds))], ["doc_id", "held_out", *names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text", "lang", "source").mapInArrow(run, SCORE_SCHEMA)


def op4_cotraining(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))
