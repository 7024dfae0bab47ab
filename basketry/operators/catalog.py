"""Variants to items: keys, canonical variant, dense index, reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import rank_by_range

# Fixed value: how many drifting groups a report lists.
DRIFT_SAMPLES = 20


def with_item_key(df: DataFrame, name: str = "name", version: str = "version") -> DataFrame:
    return df.withColumn(version, F.coalesce(version, F.lit(""))).withColumn(
        "item_id", F.concat(F.col(name), F.lit("|"), F.col(version)))


def variant_rank(set_code: str = "set_code", number: str = "number", ident: str = "id") -> Column:
    """Sort key of a variant inside its item, the biggest one is canonical.

    Numbered sets beat lettered ones, then the later set, then the higher number.
    """
    as_number = F.col(set_code).try_cast("int")
    return F.struct(
        as_number.isNotNull().alias("numbered"),
        F.coalesce(as_number, F.lit(0)).alias("set_number"),
        F.col(set_code).alias("set_code"),
        F.col(number).alias("number"),
        F.col(ident).alias("ident"),
    )


def signature(plain: Sequence[str], lists: Sequence[str] = (), texts: Sequence[str] = ()) -> Column:
    """Digest of what a variant does; lists are order free, texts case and space free."""
    from ..functions.text import normalise_whitespace

    fields = [F.col(c) for c in plain]
    fields += [F.array_sort(c).alias(c) for c in lists]
    fields += [normalise_whitespace(F.lower(c)).alias(c) for c in texts]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)


def collapse_items(variants: DataFrame, carry: Sequence[str], rank: Column | None = None,
                   ident: str = "id") -> DataFrame:
    """One row per item: canonical variant, its ``carry`` columns, number of variants.

    ``max_by`` combines map side, so an item with very many variants costs one buffer.
    """
    keyed = with_item_key(variants)
    best = F.max_by(F.struct(F.col(ident).alias("canonical_id"), *carry),
                    rank if rank is not None else variant_rank(ident=ident))
    return (
        keyed.groupBy("name", "version", "item_id")
        .agg(best.alias("best"), F.count("*").alias("n_variants"))
        .select("name", "version", "item_id", "best.*", "n_variants")
    )


def variant_positions(variants: DataFrame, ident: str = "id") -> DataFrame:
    """Every variant with its position in its item, 1 = canonical."""
    rank = variant_rank(ident=ident)
    keyed = with_item_key(variants).select(
        "name", "version", "item_id", F.col(ident), rank.alias("_rank"))
    return rank_by_range(keyed, ["name", "version"], [F.col("_rank").desc()], "position").drop("_rank")


def item_index(items: DataFrame) -> DataFrame:
    """Dense ``item_idx`` 1..N in (name, version) order; 0 is left for padding."""
    return rank_by_range(items, [], [F.col("name"), F.col("version")], "item_idx")


def variant_item_map(variants: DataFrame, index: DataFrame, ident: str = "id") -> DataFrame:
    return with_item_key(variants).join(
        index.select("name", "version", "item_idx"), ["name", "version"]
    ).select(F.col(ident), "item_idx", "item_id")


def signature_counts(variants: DataFrame, sign: Column) -> DataFrame:
    """Per item: variants and distinct signatures, in two combining steps."""
    per_sign = with_item_key(variants).withColumn("_sign", sign).groupBy(
        "name", "version", "item_id", "_sign").agg(F.count("*").alias("_n"))
    return per_sign.groupBy("name", "version", "item_id").agg(
        F.sum("_n").alias("n_variants"), F.count("*").alias("n_signatures"))


def dedup_report(variants: DataFrame, sign: Column) -> DataFrame:
    return signature_counts(variants, sign).agg(
        F.coalesce(F.sum("n_variants"), F.lit(0)).alias("variants"),
        F.count("*").alias("items"),
        F.count_if(F.col("n_variants") > 1).alias("multi_groups"),
        F.count_if(F.col("n_signatures") > 1).alias("drift_groups"),
    )


def drift_samples(variants: DataFrame, sign: Column, limit: int = DRIFT_SAMPLES,
                  ident: str = "id") -> DataFrame:
    """The first drifting items in key order, one row per variant."""
    first = (
        signature_counts(variants, sign).filter("n_signatures > 1")
        .orderBy("name", "version").limit(limit)
        .select("name", "version", "n_signatures")
    )
    return with_item_key(variants).join(first, ["name", "version"]).select(
        "item_id", "n_signatures", F.col(ident))
