"""Basket rewrite, collapse and legality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The smallest legal basket and the reason codes.
MIN_BASKET = 60
UNKNOWN_INDEX = "unknown_logical_index"
UNKNOWN_VARIANT = "unknown_printing_id"
NOT_LEGAL = "card_not_legal"
OVER_CAP = "count_exceeds_max_copies"
OFF_FACET = "card_ink_not_in_deck_inks"
TOO_SMALL = "deck_size_below_60"


def resolve_lines(lines: DataFrame, mapping: DataFrame, variant: str = "variant",
                  map_variant: str = "id", item: str = "item_idx") -> DataFrame:
    """Lines with their item, null where the variant is unknown."""
    table = mapping.select(F.col(map_variant).alias(variant), item)
    return lines.join(table, variant, "left")


def unknown_lines(resolved: DataFrame, item: str = "item_idx") -> DataFrame:
    """Every line with an unknown variant, repeats kept."""
    return resolved.filter(F.col(item).isNull()).drop(item)


def collapse_baskets(lines: DataFrame, basket: str = "basket", item: str = "item_idx",
                     qty: str = "qty") -> DataFrame:
    return lines.groupBy(basket, item).agg(F.sum(qty).alias(qty))


def rewrite_baskets(resolved: DataFrame, basket: str = "basket", item: str = "item_idx",
                    qty: str = "qty") -> DataFrame:
    """Collapsed lines of the baskets in which every variant is known.

    One pass: unknown lines collapse into a null item, which then bars its basket. After
    the collapse a basket has at most one row per item.
    """
    collapsed = collapse_baskets(resolved, basket, item, qty)
    unknown = F.max(F.col(item).isNull()).over(Window.partitionBy(basket))
    return collapsed.withColumn("_unknown", unknown).filter(~F.col("_unknown")).drop("_unknown")


def basket_totals(lines: DataFrame, basket: str = "basket", qty: str = "qty") -> DataFrame:
    return lines.groupBy(basket).agg(F.sum(qty).alias("total"), F.count("*").alias("n_items"))


def line_reasons(strict: bool, legality: Column, qty: Column, cap: Column,
                 facets: Column, allowed: Column, known: Column) -> Column:
    """Typed reason codes of one enriched line; at most one facet reason per item."""
    barred = (legality == "banned") | (F.lit(strict) & (legality != "legal"))
    return F.when(~known, F.array(F.lit(UNKNOWN_INDEX))).otherwise(F.filter(F.array(
        F.when(barred, F.lit(NOT_LEGAL)),
        F.when(qty > cap, F.lit(OVER_CAP)),
        F.when(F.size(F.array_except(facets, allowed)) > 0, F.lit(OFF_FACET)),
    ), lambda code: code.isNotNull()))


def legality_reasons(lines: DataFrame, headers: DataFrame, items: DataFrame,
                     strict: bool = False, minimum: int = MIN_BASKET,
                     basket: str = "basket", item: str = "item_idx", qty: str = "qty") -> DataFrame:
    """``(basket, item, code)``; the item of a size reason is null.

    ``headers`` brings the allowed ``facets`` per basket; ``items`` brings ``legality``,
    ``cap`` (null = no cap) and ``facets``. A line without an item row does not count
    towards the size; a basket without lines has size 0.
    """
    table = items.select(item, "legality", "cap", F.col("facets").alias("item_facets"),
                         F.lit(True).alias("_known"))
    known = F.coalesce(F.col("_known"), F.lit(False))
    cap = F.coalesce(F.col("cap").cast("double"), F.lit(float("inf")))
    enriched = lines.join(table, item, "left").withColumn("_ok", known).withColumn("_cap", cap)
    allowed = headers.select(basket, F.col("facets").alias("allowed"))
    with_rule = enriched.join(allowed, basket)
    codes = with_rule.withColumn("code", F.explode(line_reasons(
        strict, F.col("legality"), F.col(qty), F.col("_cap"),
        F.col("item_facets"), F.col("allowed"), F.col("_ok")))).select(basket, item, "code")
    held = enriched.filter("_ok").groupBy(basket).agg(F.sum(qty).alias("total"))
    small = headers.select(basket).join(held, basket, "left").filter(
        F.coalesce("total", F.lit(0)) < minimum).select(
        basket, F.lit(None).cast(lines.schema[item].dataType).alias(item),
        F.lit(TOO_SMALL).alias("code"))
    return codes.unionByName(small)


def accepted_baskets(headers: DataFrame, unknown: DataFrame, reasons: DataFrame,
                     basket: str = "basket") -> DataFrame:
    failed = unknown.select(basket).unionByName(reasons.select(basket)).distinct()
    return headers.join(failed, basket, "left_anti")


def validation_report(headers: DataFrame, unknown: DataFrame, reasons: DataFrame,
                      basket: str = "basket") -> DataFrame:
    """One row of counts; an unknown variant hides the other reasons of its basket."""
    flags = unknown.select(basket, F.lit(1).alias("u"), F.lit(0).alias("i")).unionByName(
        reasons.select(basket, F.lit(0).alias("u"), F.lit(1).alias("i"))
    ).groupBy(basket).agg(F.max("u").alias("u"), F.max("i").alias("i"))
    joined = headers.select(basket).join(flags, basket, "left")
    drop_u = F.coalesce(F.col("u"), F.lit(0)) == 1
    drop_i = ~drop_u & (F.coalesce(F.col("i"), F.lit(0)) == 1)
    counts = joined.agg(
        F.count("*").alias("total"), F.count_if(~drop_u & ~drop_i).alias("valid"),
        F.count_if(drop_u).alias("dropped_unknown"), F.count_if(drop_i).alias("dropped_illegal"))
    rate = F.when(F.col("total") > 0, (F.col("total") - F.col("valid")) / F.col("total")).otherwise(0.0)
    return counts.withColumn("drop_rate", rate)


def require_drop_rate(report: DataFrame, maximum: float) -> None:
    rate = report.first()["drop_rate"]
    if rate > maximum:
        raise ValueError(f"dropped {rate:.1%} of the baskets, allowed {maximum:.1%}")


def reason_histogram(unknown: DataFrame, reasons: DataFrame, basket: str = "basket") -> DataFrame:
    """Unknown counts once per basket and hides its other reasons; others count per instance."""
    bad = unknown.select(basket).distinct()
    codes = reasons.join(bad, basket, "left_anti").select("code").unionByName(
        bad.select(F.lit(UNKNOWN_VARIANT).alias("code")))
    return codes.groupBy("code").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code")
