"""Facet sets, buckets and blocks of a feature row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The last bucket is open ended.
BUCKETS = 12


def lowered(facets: Column) -> Column:
    return F.transform(facets, F.lower)


def facet_key(facets: Column) -> Column:
    return F.array_join(F.array_sort(lowered(facets)), "|")


def facet_multihot(facets: Column, order: Sequence[str]) -> Column:
    low = lowered(facets)
    return F.array(*[F.array_contains(low, name.lower()).cast("int") for name in order])


def facet_mask(facets: Column, order: Sequence[str]) -> Column:
    low = lowered(facets)
    mask = F.lit(0)
    for bit, name in enumerate(order):
        mask = mask + F.when(F.array_contains(low, name.lower()), 1 << bit).otherwise(0)
    return mask


def facet_bit(facet: Column, order: Sequence[str]) -> Column:
    """Bit of a single facet value, 0 when unknown; combine with ``bit_or``."""
    bit = F.lit(0)
    for position, name in enumerate(order):
        bit = F.when(F.lower(facet) == name.lower(), 1 << position).otherwise(bit)
    return bit


def mask_to_key(mask: Column, order: Sequence[str]) -> Column:
    """Facet key of a bit mask; names come out sorted."""
    names = sorted((name.lower(), 1 << bit) for bit, name in enumerate(order))
    return F.concat_ws("|", *[F.when(mask.bitwiseAND(bit) != 0, name) for name, bit in names])


def bucket_clip(cost: Column, buckets: int = BUCKETS) -> Column:
    return F.least(F.greatest(cost, F.lit(0)), F.lit(buckets - 1))


def one_hot(index: Column, length: int) -> Column:
    return F.array(*[(index == i).cast("double") for i in range(length)])


def multi_hot(values: Column, classes: Sequence[str]) -> Column:
    """Classes absent from the layout are skipped, repeated ones set one bit."""
    if not classes:
        return F.array().cast("array<double>")
    held = F.coalesce(values, F.array().cast("array<string>"))
    return F.array(*[F.array_contains(held, c).cast("double") for c in classes])


def scaled(value: Column, top: Column) -> Column:
    return F.coalesce(value / top, F.lit(0.0))


def month_back(day: Column, months: int) -> Column:
    return F.add_months(day, -months)


def stratum_month(day: Column) -> Column:
    return F.date_trunc("month", day).cast("date")


def parse_day(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd")
