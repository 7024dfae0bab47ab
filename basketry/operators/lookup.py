"""Joins of many rows with a table of keys, without dealing rows out by a key that may be hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_width

# A table of keys of up to so many rows goes to every task; a row is a few numbers.
SMALL_ROWS = 50_000
# Copies of a larger table: a key's rows are dealt out over as many tasks.
SALTS = 16
# Numbers that gathered rows make of a task's share (256 MB of doubles).
TASK_NUMBERS = 1 << 25


def gathered(rows: DataFrame, keys: Sequence[str], numbers: int) -> DataFrame:
    """``rows`` with those of equal keys in one task, before they get the ``numbers`` each that are then summed there.

    What is shuffled is the row as it is. The number of tasks follows the rows (which are counted), since
    what a task makes of its rows is many times what it is sent.
    """
    tasks = max(shuffle_width(rows.sparkSession), rows.count() * numbers // TASK_NUMBERS + 1)
    return rows.repartition(tasks, *keys)


def spread(rows: DataFrame) -> DataFrame:
    """``rows`` dealt out evenly, before long work on each: a row group of a file is read by one task, however large it is."""
    return rows.repartition(shuffle_width(rows.sparkSession))


def lookup(rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left",
           small: int | None = None, salts: int | None = None) -> DataFrame:
    """``rows`` with the columns of ``table``, whose rows are few per key; null keys meet nothing.

    The table is counted. A small one is sent to all tasks; of a larger one every key is copied
    ``SALTS`` times and meets a share of its rows each, so that a hot key is spread. Both give the
    same rows. ``how`` is ``left`` or ``inner``.
    """
    limit = SMALL_ROWS if small is None else small
    if table.limit(limit + 1).count() <= limit:
        return rows.join(F.broadcast(table), list(on), how)
    salts = SALTS if salts is None else salts
    spread = F.pmod(F.xxhash64(*[F.col(c) for c, kind in rows.dtypes if not kind.startswith("map")]), F.lit(salts)).cast("int")
    copies = table.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return rows.withColumn("_salt", spread).join(copies, [*on, "_salt"], how).drop("_salt")
