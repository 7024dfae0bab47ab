"""Feature layout and feature rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.facets import BUCKETS, bucket_clip, multi_hot, one_hot, scaled
from .ranking import rank_by_range


def discover_classes(canonical: DataFrame, list_cols: Sequence[str]) -> DataFrame:
    """Sorted distinct classes per block with their 0-based position."""
    found = None
    for name in list_cols:
        part = canonical.select(F.lit(name).alias("block"), F.explode(name).alias("class"))
        found = part if found is None else found.unionByName(part)
    ranked = rank_by_range(found.distinct(), ["block"], [F.col("class")], "position")
    return ranked.withColumn("position", F.col("position") - 1)


def fit_normalisers(canonical: DataFrame, stats: Sequence[str]) -> DataFrame:
    """One row: the largest value per stat, at least 1."""
    return canonical.agg(*[
        F.greatest(F.coalesce(F.max(s), F.lit(1)), F.lit(1)).alias(s) for s in stats])


def block_lengths(classes: DataFrame, fixed: Sequence[tuple[str, int]],
                  discovered: Sequence[str], scalars: Sequence[str]) -> DataFrame:
    """Blocks in layout order: fixed ones, discovered ones, then one slot per scalar."""
    spark = classes.sparkSession
    names = [n for n, _ in fixed] + list(discovered) + list(scalars)
    sizes = {**dict(fixed), **{s: 1 for s in scalars}}
    order = spark.createDataFrame(
        [(i, n, sizes.get(n)) for i, n in enumerate(names)],
        "block_no int, block string, fixed_length int")
    counted = classes.groupBy("block").agg(F.count("*").alias("n"))
    return order.join(counted, "block", "left").select(
        "block_no", "block", F.coalesce("fixed_length", "n", F.lit(0)).cast("int").alias("length"))


def layout(blocks: DataFrame) -> DataFrame:
    """Offsets are the running sum of lengths; one row per block, so a single task is fine."""
    before = Window.orderBy("block_no").rowsBetween(Window.unboundedPreceding, -1)
    return blocks.withColumn(
        "start", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("int"))


@dataclass(frozen=True)
class FeatureSpec:
    """Column binding of a feature row; class lists and maxima come from the fitted tables."""

    cost: str
    facets: str
    facet_order: tuple[str, ...]
    types: str
    type_order: tuple[str, ...]
    lists: tuple[tuple[str, tuple[str, ...]], ...]
    stats: tuple[tuple[str, float], ...]
    flag: str
    buckets: int = BUCKETS

    @property
    def dim(self) -> int:
        return (self.buckets + len(self.facet_order) + len(self.type_order)
                + sum(len(c) for _, c in self.lists) + len(self.stats) + 1)

    def blocks(self) -> list[tuple[str, int, int]]:
        """(name, start, length) of the maskable blocks; scalars and the flag form one."""
        out, start = [], 0
        sized = [("cost", self.buckets), ("inks", len(self.facet_order)),
                 ("types", len(self.type_order))]
        sized += [(name, len(classes)) for name, classes in self.lists]
        sized += [("scalars", len(self.stats) + 1)]
        for name, length in sized:
            out.append((name, start, length))
            start += length
        return out


def fitted_spec(canonical: DataFrame, *, cost: str, facets: str, facet_order: Sequence[str],
                types: str, type_order: Sequence[str], lists: Sequence[str],
                stats: Sequence[str], flag: str, max_classes: int = 65536) -> FeatureSpec:
    """Fit the data-derived part. A row has one slot per class, so the class list is
    as wide as a row and has to be small; a wider one is refused."""
    classes = discover_classes(canonical, lists)
    rows = classes.orderBy("block", "position").limit(max_classes + 1).collect()
    if len(rows) > max_classes:
        raise ValueError(f"more than {max_classes} classes: too wide for one feature row")
    tops = fit_normalisers(canonical, stats).first()
    by_block: dict[str, list[str]] = {name: [] for name in lists}
    for row in rows:
        by_block[row["block"]].append(row["class"])
    return FeatureSpec(
        cost, facets, tuple(facet_order), types, tuple(type_order),
        tuple((n, tuple(by_block[n])) for n in lists),
        tuple((s, float(tops[s])) for s in stats), flag)


def feature_array(spec: FeatureSpec) -> Column:
    return F.concat(
        one_hot(bucket_clip(F.col(spec.cost), spec.buckets), spec.buckets),
        multi_hot(F.col(spec.facets), spec.facet_order),
        multi_hot(F.col(spec.types), spec.type_order),
        *[multi_hot(F.col(name), classes) for name, classes in spec.lists],
        F.array(*[scaled(F.col(s), F.lit(top)) for s, top in spec.stats],
                F.coalesce(F.col(spec.flag).cast("double"), F.lit(0.0))),
    )


def feature_rows(canonical: DataFrame, spec: FeatureSpec, item: str = "item_idx") -> DataFrame:
    """``(item, features)`` with the all-zero padding row 0."""
    pad = canonical.sparkSession.range(1).select(
        F.lit(0).cast("long").alias(item),
        F.array_repeat(F.lit(0.0), spec.dim).alias("features"))
    return canonical.select(F.col(item).cast("long"), feature_array(spec).alias("features")).unionByName(pad)


def inverted_index(items: DataFrame, facets: str = "facets", bucket: str | None = None,
                   item: str = "item_idx") -> DataFrame:
    """Long postings (facet[, bucket], item); padding is never listed."""
    keep = [F.lower("facet").alias("facet")] + ([F.col(bucket).alias("bucket")] if bucket else [])
    return items.filter(F.col(item) != 0).withColumn("facet", F.explode(facets)).select(
        *keep, item).distinct()


def align_indexes(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """One row: keys on both sides, on one side only, and repeated keys."""
    a = left.groupBy(F.col(left_key).alias("k")).agg(F.count("*").alias("na"))
    b = right.groupBy(F.col(right_key).alias("k")).agg(F.count("*").alias("nb"))
    return a.join(b, "k", "full_outer").agg(
        F.count_if(F.col("na").isNotNull() & F.col("nb").isNotNull()).alias("matched"),
        F.count_if(F.col("nb").isNull()).alias("left_only"),
        F.count_if(F.col("na").isNull()).alias("right_only"),
        F.count_if((F.coalesce("na", F.lit(0)) > 1) | (F.coalesce("nb", F.lit(0)) > 1)).alias("repeated"),
    )


def require_aligned(report: DataFrame) -> None:
    row = report.first()
    if row["left_only"] or row["right_only"] or row["repeated"]:
        raise ValueError(f"indexes do not match one to one: {row.asDict()}")
