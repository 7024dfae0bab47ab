"""Isotonic calibration by pooling adjacent violators in ranges of scores.

Pooling may be done in any order: pooled blocks of one range, each a weighted point, can be pooled on
with those of the next. Every range of scores is pooled in a task. Then ranges that meet in a
violation are pooled in pairs of neighbours, and dealt out anew in ranges of at most ``RANGE_BLOCKS``
blocks, until no two neighbours violate the order. Blocks never leave the tasks; the driver sees the
first and the last mean of each range. A round merges every violating pair of neighbours, so rounds
are few unless one block swallows range after range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ship_package

# Blocks of a range; two ranges meet in a task at most.
RANGE_BLOCKS = 1 << 17
_BLOCKS = "range long, low double, high double, total double, weight double"


def pool(low: np.ndarray, high: np.ndarray, total: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Blocks in order of score, pooled until their means rise; equal means become one block."""
    ends: list[int] = []
    sums: list[float] = []
    weights: list[float] = []
    for i in range(len(low)):
        s, w = float(total[i]), float(weight[i])
        while sums and sums[-1] * w >= s * weights[-1]:
            s, w = s + sums.pop(), w + weights.pop()
            ends.pop()
        sums.append(s)
        weights.append(w)
        ends.append(i)
    starts = [0, *(e + 1 for e in ends[:-1])]
    return low[starts], high[ends], np.array(sums), np.array(weights)


def _pooled(frame: pd.DataFrame, first: int) -> pd.DataFrame:
    """The pooled blocks of a frame; ranges are numbered from ``first``, fine enough for later splits."""
    frame = frame.sort_values("low")
    low, high, total, weight = pool(*(frame[c].to_numpy() for c in ("low", "high", "total", "weight")))
    return pd.DataFrame({"range": first + np.arange(len(low)) // RANGE_BLOCKS, "low": low, "high": high, "total": total, "weight": weight})


def isotonic_blocks(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``(low, high, total, weight)`` of the fitted steps; rows without score or label do not count."""
    ship_package(scored.sparkSession)
    points = scored.select(F.col(score).cast("double").alias("x"), F.col(label).cast("double").alias("y")).filter(
        F.col("x").isNotNull() & F.col("y").isNotNull()).groupBy("x").agg(F.sum("y").alias("total"), F.count("*").cast("double").alias("weight"))
    spread = points.select(F.col("x").alias("low"), F.col("x").alias("high"), "total", "weight").repartitionByRange("low").withColumn(
        "part", F.spark_partition_id())

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [batch for batch in batches if len(batch)]
        if held:
            frame = pd.concat(held, ignore_index=True)
            # Parts are wide apart, so that a part may be split without meeting the numbers of the next.
            yield _pooled(frame, int(frame["part"].iloc[0]) << 32)

    blocks = cut_lineage(spread.mapInPandas(local, _BLOCKS))
    while True:
        edges = blocks.groupBy("range").agg(
            F.min_by(F.col("total") / F.col("weight"), "low").alias("first"), F.max_by(F.col("total") / F.col("weight"), "low").alias("last")
        ).orderBy("range").collect()
        into: dict[int, int] = {}
        at = 0
        while at + 1 < len(edges):
            if edges[at]["last"] >= edges[at + 1]["first"]:
                into[edges[at + 1]["range"]] = edges[at]["range"]
                at += 1
            at += 1
        if not into:
            return blocks.drop("range")
        pairs = blocks.sparkSession.createDataFrame(list(into.items()), "range long, target long")
        met = {*into, *into.values()}
        moved = blocks.join(pairs, "range", "left").withColumn("range", F.coalesce("target", "range")).drop("target")
        touched = F.col("range").isin(*sorted(into.values())) if len(met) < 1000 else F.lit(True)
        again = moved.filter(touched).groupBy("range").applyInPandas(lambda frame: _pooled(frame, int(frame["range"].iloc[0])), _BLOCKS)
        blocks = cut_lineage(again if len(met) >= 1000 else again.unionByName(moved.filter(~touched)))


def isotonic_breakpoints(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """``(score, prob)`` at the first and the last score of every step of the calibration."""
    steps = isotonic_blocks(scored, score, label).withColumn("prob", F.col("total") / F.col("weight"))
    ends = F.array_distinct(F.array("low", "high"))
    return steps.select(F.explode(ends).alias("score"), "prob")
