"""Toxicity by multiple-instance learning: sentences judge, documents have the labels.

A sentence scores ``sigmoid(bias + weights of its words)``; a document is toxic if any of its
sentences is, so its score is the noisy-or ``1 - prod(1 - p)``. Weights are learnt by
maximum likelihood of document labels alone, which forces single sentences to carry the
blame; the sentences from ``OFFENDING`` up are located in the text.

Features are words (lower case, outer punctuation off) and their first four and five letters,
so inflected forms share weight. Which of them count is decided by Spark over the training
rows: those far more frequent in toxic documents.

Training rows are labelled documents outside the held-out fifth, at most ``TRAIN_ROWS`` by
hash order of the id (the documented bound; their ids are broadcast). Only counts, the chosen
features and the sparse sentences of these rows reach the driver. Null texts are empty; texts
without words score 0; null labels are left out; without labels of both classes every score is 0.
Repeated rows are scored one by one.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_frames, texts_of

TRAIN_ROWS = 16_000
FEATURES = 2048
#: A feature must occur in so many training documents, and so many times more often in toxic ones.
MIN_DOCUMENTS, MIN_LIFT = 3, 6.0
STEPS, RATE, SHRINK = 500, 0.1, 1e-5
OFFENDING = 0.5
_END = re.compile(r"(?<=[.!?])[\x20\x09-\x0D]+|\n+")
_TRIM = ".,:;!?()[]{}\"'`*#$%&|<>»«“”„-"


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of sentences: cut after end marks and at line ends."""
    out, at = [], 0
    for m in _END.finditer(text):
        if m.start() > at:
            out.append((at, m.start()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def features(word: str) -> tuple[str, ...]:
    bare = word.strip(_TRIM).lower()
    if not bare:
        return ()
    return (bare, *(f"{bare[:k]}*" for k in (4, 5) if len(bare) > k))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """``doc_id, text, label`` of at most ``limit`` labelled documents outside the held-out fifth."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    own = own.filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
    own = own.groupBy("doc_id").agg(F.max("label").alias("label"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return texts_of(docs).join(F.broadcast(own), "doc_id")


def chosen_features(rows: DataFrame) -> list[str]:
    """The features that speak most for toxic documents, by a smoothed log-odds z-score."""

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        seen = {0: Counter(), 1: Counter()}
        for text, label in zip(batch["text"], batch["label"], strict=True):
            seen[int(label)].update({f for w in set(text.split()) for f in features(w)})
        names = list(set(seen[0]) | set(seen[1]))
        return pd.DataFrame({"feature": names, "clean": [seen[0][f] for f in names], "toxic": [seen[1][f] for f in names]})

    total = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not total.get(0) or not total.get(1):
        return []
    sums = map_frames(rows, count, "feature string, clean long, toxic long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    odds = lambda n, whole: F.log((n + 0.5) / (F.lit(whole) - n + 0.5))
    z = (odds(F.col("toxic"), total[1]) - odds(F.col("clean"), total[0])) / F.sqrt(
        1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    lift = F.col("toxic") / total[1] >= MIN_LIFT * F.col("clean") / total[0]
    top = sums.filter(lift & (F.col("toxic") >= MIN_DOCUMENTS)).orderBy(z.desc(), "feature").limit(FEATURES)
    return [r["feature"] for r in top.select("feature").collect()]


def fit_noisy_or(counts: np.ndarray, bags: np.ndarray, sentence: np.ndarray, feature: np.ndarray,
                 labels: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of document labels (full-batch Adam).

    ``counts``: sentences per document. Listed sentences have features; ``bags`` gives the
    document of each, ``sentence, feature`` the pairs. All other sentences score the bias alone.
    """
    listed = np.bincount(bags, minlength=len(counts))
    plain = counts - listed
    value = np.concatenate((np.zeros(width), [-6.0]))
    first, second = np.zeros_like(value), np.zeros_like(value)
    for step in range(1, STEPS + 1):
        w, b = value[:-1], value[-1]
        z = b + np.bincount(sentence, weights=w[feature], minlength=len(bags))
        # log(1 - p) = -softplus(z); a document's log(1 - P) is the sum over its sentences.
        quiet = -np.bincount(bags, weights=np.logaddexp(0, z), minlength=len(counts)) - plain * np.logaddexp(0, b)
        toxic = -np.expm1(np.minimum(quiet, -1e-12))
        # d loss / d quiet: +1/P - 1 for toxic documents, -1 for clean ones, as a loss to minimise.
        pull = np.where(labels == 1, np.exp(quiet) / toxic, -1.0)
        p = 1 / (1 + np.exp(-z))
        each = -pull[bags] * p
        grad = np.empty_like(value)
        grad[:-1] = np.bincount(feature, weights=each[sentence], minlength=width) / len(counts) + SHRINK * w
        grad[-1] = (each.sum() + (-pull * plain).sum() / (1 + np.exp(-b))) / len(counts)
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        value = value - RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    return value[:-1], float(value[-1])


def train(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> tuple[dict[str, float], float]:
    """Weights by feature, and the bias."""
    rows = training_rows(docs, labels, "toxic", limit)
    names = chosen_features(rows)
    if not names:
        return {}, -50.0
    number = {f: i for i, f in enumerate(names)}

    def sparse(batch: pd.DataFrame) -> pd.DataFrame:
        found, counts = [], []
        for text in batch["text"]:
            spans = sentences(text)
            rows_ = ({number[f] for w in set(text[a:b].split()) for f in features(w) if f in number} for a, b in spans)
            found.append([sorted(r) for r in rows_ if r])
            counts.append(len(spans))
        return pd.DataFrame({"label": batch["label"], "n": counts, "found": found})

    sample = map_frames(rows, sparse, "label int, n long, found array<array<int>>").toPandas()
    bags, sentence, feature = [], [], []
    for d, found in enumerate(sample["found"]):
        for one in found:
            sentence += [len(bags)] * len(one)
            feature += list(one)
            bags.append(d)
    as_int = lambda x: np.asarray(x, dtype=np.int64)
    weights, bias = fit_noisy_or(sample["n"].to_numpy(), as_int(bags), as_int(sentence), as_int(feature),
                                 sample["label"].to_numpy(), len(names))
    return {f: float(w) for f, w in zip(names, weights, strict=True)}, bias


def score_documents(docs: DataFrame, weights: dict[str, float], bias: float) -> DataFrame:
    """``doc_id, score, offending``: the noisy-or score and the sentences to blame."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        known: dict[str, frozenset] = {}
        scores, blamed = [], []
        base = 1 / (1 + np.exp(-bias))
        for text in batch["text"]:
            quiet, bad = 0.0, []
            spans = sentences(text)
            for a, b in spans:
                hits = set()
                for w in text[a:b].split():
                    f = known.get(w)
                    if f is None:
                        f = known[w] = frozenset(x for x in features(w) if x in weights)
                    if f:
                        hits |= f
                if hits:
                    p = 1 / (1 + np.exp(-(bias + sum(map(weights.__getitem__, sorted(hits))))))
                    if p >= OFFENDING:
                        bad.append({"start": a, "end": b, "score": float(p)})
                else:
                    p = base
                quiet += np.log1p(-min(p, 1 - 1e-12))
            scores.append(float(-np.expm1(quiet)))
            blamed.append(bad)
        return pd.DataFrame({"doc_id": batch["doc_id"], "score": scores, "offending": blamed})

    return map_frames(texts_of(docs), run, (
        "doc_id long, score double, offending array<struct<start:int,end:int,score:double>>"))


def judge(docs: DataFrame, labels: DataFrame, limit: int = TRAIN_ROWS) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted, offending``."""
    weights, bias = train(docs, labels, limit)
    scored = score_documents(docs, weights, bias)
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")
