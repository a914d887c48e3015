"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Learning: a bounded, balanced sample of labelled documents (``SAMPLE`` per class, by hash order of their ids) gives
counts of documents per hashed n-gram and class. An n-gram whose log-count ratio is within ``Z`` standard errors of 0
says nothing and gets no weight; the others enter a logistic regression as 0 or the ratio. Scoring: the sum of the
weights of a document's distinct n-grams.

Edge cases: null texts count as empty; an empty text scores by the intercept. A document with both labels counts as
toxic. Null ids, labels and texts are not learned from. Without one example of each class all scores are 0.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracecause.llm.common import map_rows
from tracecause.llm.ngrams import hashed_grams

ORDERS, BITS = (3, 4, 5), 22
#: Labelled documents per class that are learned from; the only bound on learning.
SAMPLE = 2000
#: Standard errors that a ratio must differ from 0, least documents with an n-gram, smoothing, ridge and steps.
Z, LEAST, ALPHA, RIDGE, STEPS = 2.5, 5, 1.0, 1e-3, 300
THRESHOLD = 0.7


def sample(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE) -> DataFrame:
    """(text, label) of at most ``per_class`` documents of each class, one row per id.

    The picked ids are few, so they travel to the documents and no text is shuffled but that of the sample.
    """
    known = (labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
             .groupBy("doc_id").agg(F.max("toxic").alias("label")))
    have = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id")
    known = known.join(have, "doc_id", "left_semi")
    picked = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionByName(part)
    rows = docs.where(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.max("text").alias("text")).select("text", "label")


def fit_arrays(texts: list[str], labels: list[int]) -> tuple[list[int], list[float], float]:
    """Features, their weights and the intercept."""
    y = np.array(labels, dtype=np.float64)
    if not len(y) or y.min() == y.max():
        return [], [], 0.0
    grams = [np.unique(hashed_grams(t, ORDERS, BITS)) for t in texts]
    having = np.zeros((2, 1 << BITS))
    for g, label in zip(grams, labels, strict=True):
        having[label, g] += 1
    clean, toxic = having
    ratio = np.log((toxic + ALPHA) / (y.sum() + 2 * ALPHA)) - np.log((clean + ALPHA) / ((1 - y).sum() + 2 * ALPHA))
    error = np.sqrt(1 / (toxic + ALPHA) + 1 / (clean + ALPHA))
    chosen = np.flatnonzero((np.abs(ratio) > Z * error) & (toxic + clean >= LEAST))
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))
    columns = [place[g][place[g] >= 0] for g in grams]
    rows = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    columns = np.concatenate(columns)
    scale = ratio[chosen]
    values = scale[columns]
    # Logistic regression by gradient steps with momentum; the step is set by the largest row norm.
    w, b, speed_w, speed_b = np.zeros(len(chosen)), 0.0, np.zeros(len(chosen)), 0.0
    norms = np.bincount(rows, weights=values ** 2, minlength=len(y))
    step = 4.0 / (1.0 + np.mean(norms) * 4)
    for _ in range(STEPS):
        margin = np.bincount(rows, weights=values * w[columns], minlength=len(y)) + b
        off = 1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y
        grad = np.bincount(columns, weights=values * off[rows], minlength=len(w)) / len(y) + RIDGE * w
        speed_w = 0.9 * speed_w - step * grad
        speed_b = 0.9 * speed_b - step * off.mean()
        w, b = w + speed_w, b + speed_b
    return chosen.tolist(), (w * scale).tolist(), float(b)


def fit(rows: DataFrame) -> dict:
    """Weights from the bounded sample, fitted in one task; the features with a weight reach the driver."""
    schema = pa.schema([("feature", pa.list_(pa.int64())), ("weight", pa.list_(pa.float64())),
                        ("intercept", pa.float64())])

    def run(batches):
        texts, labels = [], []
        for b in batches:
            texts += b.column(0).to_pylist()
            labels += b.column(1).to_pylist()
        order = sorted(range(len(texts)), key=lambda i: (labels[i], texts[i]))
        features, weights, intercept = fit_arrays([texts[i] for i in order], [labels[i] for i in order])
        yield pa.RecordBatch.from_pydict({"feature": [features], "weight": [weights], "intercept": [intercept]}, schema)

    out = rows.coalesce(1).mapInArrow(run, "feature array<long>, weight array<double>, intercept double").collect()
    found = max(out, key=lambda r: len(r["feature"]), default=None)
    return {"feature": found["feature"] if found else [], "weight": found["weight"] if found else [],
            "intercept": found["intercept"] if found else 0.0}


def score(docs: DataFrame, model: dict, keep: list[str], threshold: float = THRESHOLD) -> DataFrame:
    """``score`` (0 to 1) of every whole ``text`` and ``predicted``, beside the columns ``keep``."""
    features, weights, intercept = np.array(model["feature"], np.int64), np.array(model["weight"]), model["intercept"]
    fitted = len(features) > 0

    def make():
        dense = np.zeros(1 << BITS)
        dense[features] = weights
        has = dense != 0

        def one(text: str):
            grams = hashed_grams(text, ORDERS, BITS)
            margin = float(np.sum(dense[np.unique(grams[has[grams]])])) + intercept
            p = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) if fitted else 0.0
            return float(p), int(p >= threshold)
        return one

    return map_rows(docs, make, keep, "score double, predicted int")
