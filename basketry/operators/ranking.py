"""Ranks and running totals that never put one group into one task.

Two ways to cut a group into pieces:

* ``by_bucket``: the caller names a bucket expression that grows with the order (a hash
  prefix, a block of dense ids). The cut is a function of the row, so nothing has to be
  written down.
* ``by_range``: for any order. Rows are range partitioned, the cut is the range, and the
  result is checkpointed because sampled range bounds may differ between two runs.

A piece is numbered on its own and shifted by the totals of the pieces before it; there is
at most one total per (group, piece).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_width

PIECE = "_piece"


def _with_offsets(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                  totals: dict[str, Column]) -> DataFrame:
    """Add, per entry of ``totals``, the inclusive running sum along (piece, order)."""
    cut = [*group, PIECE]
    inner = Window.partitionBy(*cut).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*group).orderBy(PIECE).rowsBetween(
        Window.unboundedPreceding, -1)
    sums = df.groupBy(*cut).agg(*[F.sum(v).alias(f"_sum_{n}") for n, v in totals.items()])
    shifts = sums.select(*cut, *[
        F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_off_{n}") for n in totals])
    local = df.select("*", *[F.sum(v).over(inner).alias(f"_loc_{n}") for n, v in totals.items()])
    # Null groups are groups too.
    shifts = shifts.withColumnsRenamed({c: f"_at_{c}" for c in cut})
    same = reduce(and_, [local[c].eqNullSafe(shifts[f"_at_{c}"]) for c in cut])
    return local.join(shifts, same).select(
        *df.columns, *[(F.col(f"_loc_{n}") + F.col(f"_off_{n}")).alias(n) for n in totals]
    ).drop(PIECE)


def running_by_bucket(df: DataFrame, group: Sequence[str], bucket: Column,
                      order: Sequence[Column], totals: dict[str, Column]) -> DataFrame:
    return _with_offsets(df.withColumn(PIECE, bucket), group, order, totals)


def running_by_range(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                     totals: dict[str, Column]) -> DataFrame:
    keys = [F.col(c) for c in group] + list(order)
    pieces = df.repartitionByRange(shuffle_width(df.sparkSession), *keys).withColumn(
        PIECE, F.spark_partition_id())
    return _with_offsets(cut_lineage(pieces), group, order, totals)


def rank_by_range(df: DataFrame, group: Sequence[str], order: Sequence[Column],
                  out: str = "rank") -> DataFrame:
    """1-based row number in ``order`` (which must be total) within ``group``."""
    return running_by_range(df, group, order, {out: F.lit(1).cast("long")})


def rank_by_hash(df: DataFrame, group: Sequence[str], hash_col: str,
                 ties: Sequence[str], out: str = "rank", bits: int = 12) -> DataFrame:
    """1-based row number by a 32-bit hash; a group is cut into up to 2**bits pieces."""
    return running_by_bucket(
        df, group, F.shiftright(hash_col, 32 - bits),
        [F.col(hash_col), *[F.col(t) for t in ties]], {out: F.lit(1).cast("long")})


def rank_by_dense_id(df: DataFrame, group: Sequence[str], id_col: str,
                     out: str = "rank", bits: int = 12) -> DataFrame:
    """1-based row number by a dense id; a piece holds 2**bits ids."""
    return running_by_bucket(
        df, group, F.shiftright(F.col(id_col).cast("long"), bits),
        [F.col(id_col)], {out: F.lit(1).cast("long")})
