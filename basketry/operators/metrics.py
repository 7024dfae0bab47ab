"""Ranking, loss and calibration metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import u32
from .ranking import rank_by_hash

from .ranking import running_by_range

# Label of unscored positions, smallest improvement, patience.
IGNORED = -100
MIN_DELTA = 1e-4
PATIENCE = 6


def roc_auc(scored: DataFrame, score: str = "score", label: str = "label",
            group: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve per group, ties count half, NaN if a class is missing.

    Rows collapse to one per distinct score; the running count of negatives is built over
    score ranges, so no task sees all scores.
    """
    counts = scored.groupBy(*group, score).agg(
        F.count_if(F.col(label) > 0.5).alias("pos"), F.count_if(F.col(label) <= 0.5).alias("neg"))
    running = running_by_range(counts, list(group), [F.col(score)], {"upto": F.col("neg")})
    below = F.col("upto") - F.col("neg")
    wins = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    sums = running.groupBy(*group).agg(wins.alias("wins"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    pairs = F.nullif((F.col("positives") * F.col("negatives")).cast("double"), F.lit(0.0))
    return sums.select(*group, "positives", "negatives", F.coalesce(F.col("wins") / pairs, F.lit(float("nan"))).alias("auc"))


def bce_loss(logit: Column, label: Column) -> Column:
    return F.greatest(logit, F.lit(0.0)) - logit * label + F.log1p(F.exp(-F.abs(logit)))


def bce_accuracy(scored: DataFrame, logit: str = "logit", label: str = "label",
                 batch: str | None = None) -> DataFrame:
    """Mean loss and accuracy; with ``batch`` the mean of the batch means."""
    hit = ((F.col(logit) >= 0) == (F.col(label) >= 0.5)).cast("double")
    rows = scored.select(*([batch] if batch else []), bce_loss(F.col(logit), F.col(label)).alias("bce"), hit.alias("hit"))
    if batch:
        rows = rows.groupBy(batch).agg(F.avg("bce").alias("bce"), F.avg("hit").alias("hit"))
    return rows.agg(F.avg("bce").alias("bce"), F.avg("hit").alias("accuracy"))


def soft_ce_per_example(rows: DataFrame, example: Sequence[str], logit: str = "logit",
                        target: str = "target") -> DataFrame:
    """``(example, ce, entropy)`` from long (example, class) rows.

    With L = log-sum-exp: CE = L * sum(t) - sum(t z) and H = L - sum(z p).
    """
    tops = rows.groupBy(*example).agg(F.max(logit).alias("_top"))
    z = F.col(logit) - F.col("_top")
    sums = rows.join(tops, list(example)).groupBy(*example).agg(
        F.sum(F.exp(z)).alias("_e"), F.sum(z * F.exp(z)).alias("_ze"),
        F.sum(F.col(target) * z).alias("_tz"), F.sum(target).alias("_t"))
    return sums.select(
        *example,
        (F.log("_e") * F.col("_t") - F.col("_tz")).alias("ce"),
        (F.log("_e") - F.col("_ze") / F.col("_e")).alias("entropy"))


def soft_ce_entropy(rows: DataFrame, example: Sequence[str], beta: float, logit: str = "logit",
                    target: str = "target") -> DataFrame:
    """Means over examples: cross entropy, entropy, and CE - beta * H."""
    return soft_ce_per_example(rows, example, logit, target).agg(
        F.avg("ce").alias("ce"), F.avg("entropy").alias("entropy"),
        (F.avg("ce") - beta * F.avg("entropy")).alias("total"))


def masked_loss(tokens: DataFrame, loss: str = "loss", label: str = "label") -> DataFrame:
    """Mean token loss over scored positions."""
    return tokens.filter(F.col(label) != IGNORED).agg(F.avg(loss).alias("mlm"))


def masked_ce_from_logits(rows: DataFrame, position: Sequence[str], class_col: str = "token",
                          logit: str = "logit", label: str = "label") -> DataFrame:
    """Mean cross entropy over positions whose label is scored, from long logits."""
    hot = rows.filter(F.col(label) != IGNORED).withColumn(
        "_t", (F.col(class_col) == F.col(label)).cast("double"))
    return soft_ce_per_example(hot, position, logit, "_t").agg(F.avg("ce").alias("mlm"))


def cell_mse(rows: DataFrame, value: str = "value", predicted: str = "predicted") -> DataFrame:
    d = F.col(value) - F.col(predicted)
    return rows.agg(F.avg(d * d).alias("mse"))


def combined_loss(mlm: DataFrame, mse: DataFrame, weight: float) -> DataFrame:
    """One row ``mlm, mse, total`` with total = mlm + weight * mse, from the two one-row losses."""
    return mlm.select("mlm").withColumn("mse", mse.select("mse").scalar()).withColumn("total", F.col("mlm") + weight * F.col("mse"))


def balanced_mix(scored: DataFrame, kind: str, key: str, seed, label: str = "label") -> DataFrame:
    """All positives, and of every kind of negatives the same number: the smallest there is, drawn by hash.

    Kinds are counted first; a rank in hash order, made in pieces, picks each kind's quota, so a kind
    that holds most rows is not gathered anywhere. Null is a kind too.
    """
    negatives = scored.filter(F.col(label) <= 0.5).withColumn("_h", u32(seed, "balance", F.col(key)))
    quota = negatives.groupBy(kind).agg(F.count("*").alias("n")).agg(F.min("n")).first()[0] or 0
    named = negatives.withColumn("_kind", F.coalesce(F.concat(F.lit("k"), F.col(kind).cast("string")), F.lit("n")))
    drawn = rank_by_hash(named, ["_kind"], "_h", [key], "_rank").filter(F.col("_rank") <= quota)
    return scored.filter(F.col(label) > 0.5).unionByName(drawn.select(*scored.columns))


def early_stop(history: DataFrame, run: str = "run", epoch: str = "epoch", metric: str = "metric",
               min_delta: float = MIN_DELTA, patience: int = PATIENCE) -> DataFrame:
    """``(run, best_epoch, best_value, epochs_run)``; best epoch -1 if nothing improves.

    A history is one small row per epoch, so a run folds inside one row.
    """
    states = F.aggregate(
        F.array_sort(F.collect_list(F.struct(F.col(epoch).cast("int").alias("e"), F.col(metric).cast("double").alias("m")))),
        F.struct(F.lit(-1).alias("best"), F.lit(float("inf")).alias("value"), F.lit(0).alias("bad"), F.lit(0).alias("ran")),
        lambda s, x: F.when(s["bad"] >= patience, s).when(
            x["m"] < s["value"] - min_delta,
            F.struct(x["e"].alias("best"), x["m"].alias("value"), F.lit(0).alias("bad"), (s["ran"] + 1).alias("ran")),
        ).otherwise(F.struct(s["best"].alias("best"), s["value"].alias("value"),
                             (s["bad"] + 1).alias("bad"), (s["ran"] + 1).alias("ran"))))
    return history.groupBy(run).agg(states.alias("s")).select(
        run, F.col("s.best").alias("best_epoch"), F.col("s.value").alias("best_value"), F.col("s.ran").alias("epochs_run"))


def run_summary(history: DataFrame, finals: Sequence[str], run: str = "run", epoch: str = "epoch",
                metric: str = "metric", min_delta: float = MIN_DELTA, patience: int = PATIENCE) -> DataFrame:
    """Best epoch and value per run with the last values of ``finals``, best run first."""
    best = early_stop(history, run, epoch, metric, min_delta, patience)
    seen = history.join(best, run).withColumn(
        "_no", F.col(epoch))
    order = seen.groupBy(run).agg(
        *[F.max_by(c, "_no").alias(f"{c}_final") for c in finals])
    return best.join(order, run).orderBy("best_value", run)


def expected_calibration_error(scored: DataFrame, prob: str = "prob", label: str = "label",
                               bins: int = 10, group: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins; the last bin includes 1."""
    bin_no = F.least(F.floor(F.col(prob) * bins), F.lit(bins - 1))
    cells = scored.withColumn("_bin", bin_no).groupBy(*group, "_bin").agg(
        F.count("*").alias("n"), F.abs(F.avg(prob) - F.avg(label)).alias("gap"))
    weighted = F.sum(F.col("n") * F.col("gap")) / F.sum("n")
    return cells.groupBy(*group).agg(weighted.alias("ece"))
