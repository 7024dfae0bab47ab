"""Quality by positive-unlabelled learning with the non-negative risk estimator.

Trusted positives are documents labelled good; everything else is unlabelled web text, a
mixture of good and bad with a share ``prior`` of good. A small network ``g`` minimises

    prior * E_pos[loss(g, +)] + max(0, E_unl[loss(g, -)] - prior * E_pos[loss(g, -)])

with the logistic loss; where the second term falls below zero its gradient is reversed, which
keeps the network from learning positives by heart. Labels of bad documents are never used.

The prior is estimated first: for any region A of the feature space, ``P_unl(A) >= prior *
P_pos(A)``; regions are upper level sets of a plain positive-against-unlabelled classifier, and
the least ratio over those that hold enough positives, on rows the classifier has not seen, is
the estimate.

Both samples are bounded (``POSITIVES``, ``UNLABELLED`` rows by hash order of the id) and leave
the held-out fifth out; features are computed by Spark, and only feature rows of the samples
reach the driver. Null texts are empty. Empty texts have all-zero features and are scored like any
other; without positives every score is the prior 0.5. Repeated rows are scored one by one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_frames, texts_of

POSITIVES, UNLABELLED = 8_000, 16_000
HIDDEN, STEPS, RATE, SHRINK, SEED = 16, 600, 0.02, 1e-4, 7
#: Part of the positives that a region must hold to count for the prior.
REGION = 0.3
THRESHOLD = 0.3
SYMBOLS = "#*$%&|<>"
N_FEATURES = 12


def text_features(text: str) -> list[float]:
    """Numbers that tell the kind of text, none of which grows with its length but the first."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    chars = len(text)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    upper = sum(map(str.isupper, words))
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    digits = sum(map(str.isdigit, words))
    ends = sum(x.rstrip().endswith((".", "!", "?", ":", "\"")) for x in lines)
    return [
        math.log1p(n) / 10,
        sum(map(text.count, SYMBOLS)) / n,
        text.count("!!") / n,
        upper / n,
        same / n,
        # Distinct words against what a text of this length tends to have.
        len(counts) / n ** 0.8,
        max(counts.values()) / n,
        digits / n,
        chars / n / 10,
        (text.count(".") + text.count(",")) / n,
        1 - ends / len(lines),
        1 - len(set(lines)) / len(lines),
    ]


def feature_rows(docs: DataFrame, *more: str) -> DataFrame:
    def run(batch: pd.DataFrame) -> pd.DataFrame:
        return batch[["doc_id", *more]].assign(x=[text_features(t) for t in batch["text"]])

    fields = "".join(f", {m} int" for m in more)
    return map_frames(docs.select("doc_id", "text", *more), run, f"doc_id long{fields}, x array<double>")


def sampled(docs: DataFrame, ids: DataFrame, limit: int) -> np.ndarray:
    """Features of at most ``limit`` of the documents named, the first by hash order."""
    few = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = feature_rows(texts_of(docs).join(F.broadcast(few), "doc_id", "left_semi")).toPandas()
    # Row order must not depend on partitions.
    rows = rows.sort_values("doc_id", kind="stable")
    return np.array(rows["x"].tolist(), dtype=float).reshape(-1, N_FEATURES)


class Network:
    """One hidden layer of rectifiers over standardised features."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray) -> None:
        rng = np.random.default_rng(SEED)
        self.centre, self.scale = centre, scale
        n = len(centre)
        self.values = [rng.normal(0, 1 / math.sqrt(n), (n, HIDDEN)), np.zeros(HIDDEN),
                       rng.normal(0, 1 / math.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        self.first = [np.zeros_like(v) for v in self.values]
        self.second = [np.zeros_like(v) for v in self.values]
        self.step = 0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.centre) / self.scale, -6, 6)

    def raw(self, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(0, z @ self.values[0] + self.values[1])
        return h @ self.values[2] + self.values[3][0], h

    def gradient(self, z: np.ndarray, h: np.ndarray, d: np.ndarray) -> list[np.ndarray]:
        back = np.outer(d, self.values[2]) * (h > 0)
        return [z.T @ back, back.sum(0), h.T @ d, np.array([d.sum()])]

    def move(self, grads: list[np.ndarray]) -> None:
        self.step += 1
        for i, g in enumerate(grads):
            g = g + SHRINK * self.values[i]
            self.first[i] = 0.9 * self.first[i] + 0.1 * g
            self.second[i] = 0.999 * self.second[i] + 0.001 * g * g
            self.values[i] = self.values[i] - RATE * (self.first[i] / (1 - 0.9 ** self.step)) / (
                np.sqrt(self.second[i] / (1 - 0.999 ** self.step)) + 1e-8)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(self.inputs(x))[0], -30, 30)))


def _scaled(p: np.ndarray, u: np.ndarray) -> Network:
    both = np.vstack((p, u))
    return Network(both.mean(0), both.std(0) + 1e-3)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """The share of positives among the unlabelled, from level sets on the unseen half."""
    net = _scaled(p, u)
    zp, zu = net.inputs(p[::2]), net.inputs(u[::2])
    for _ in range(STEPS // 3):
        (gp, hp), (gu, hu) = net.raw(zp), net.raw(zu)
        a, b = net.gradient(zp, hp, -_sigmoid(-gp) / len(gp)), net.gradient(zu, hu, _sigmoid(gu) / len(gu))
        net.move([x + y for x, y in zip(a, b, strict=True)])
    sp, su = np.sort(net.score(p[1::2])), np.sort(net.score(u[1::2]))
    cuts = np.quantile(sp, np.linspace(0.02, 1 - REGION, 12))
    in_p = 1 - np.searchsorted(sp, cuts) / len(sp)
    in_u = 1 - np.searchsorted(su, cuts) / len(su)
    # Few regions, so that chance does not pick a ratio far below the rest.
    return float(np.clip((in_u / in_p).min(), 0.05, 0.98))


def fit(p: np.ndarray, u: np.ndarray, prior: float) -> Network:
    """Minimise the non-negative risk, full batch."""
    net = _scaled(p, u)
    zp, zu = net.inputs(p), net.inputs(u)
    for _ in range(STEPS):
        (gp, hp), (gu, hu) = net.raw(zp), net.raw(zu)
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        if negative >= 0:
            dp = (-prior * _sigmoid(-gp) - prior * _sigmoid(gp)) / len(gp)
            du = _sigmoid(gu) / len(gu)
        else:
            # Undo the overfitted part: go up the negative risk only.
            dp, du = prior * _sigmoid(gp) / len(gp), -_sigmoid(gu) / len(gu)
        a, b = net.gradient(zp, hp, dp), net.gradient(zu, hu, du)
        net.move([x + y for x, y in zip(a, b, strict=True)])
    return net


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Network | None:
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("q"))
    good = known.filter("doc_id is not null").filter(~held_out() & (F.col("q") == 1)).select("doc_id").distinct()
    web = texts_of(docs).filter("doc_id is not null").filter(~held_out()).select("doc_id").distinct()
    p, u = sampled(docs, good, positives), sampled(docs, web, unlabelled)
    if len(p) < 4 or len(u) < 4:
        return None
    return fit(p, u, class_prior(p, u))


def judge(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""
    net = train(docs, labels, positives, unlabelled)

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        x = np.array([text_features(t) for t in batch["text"]], dtype=float).reshape(-1, N_FEATURES)
        return pd.DataFrame({"doc_id": batch["doc_id"], "score": net.score(x) if net else 0.5})

    scored = map_frames(texts_of(docs), run, "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
