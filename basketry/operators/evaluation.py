"""Judging generated baskets against a corpus.

Definitions the source leaves open are fixed here and named in the docstrings.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import exp, lgamma, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import u32
from ..session import cut_lineage, ship_package
from .lookup import gathered, lookup
from .names import find_names, write_names
from .vectors import SMALL_NUMBERS

# Release gates (metric, kind, low, high), those of style bands in the balanced
# setting, and the text pattern of a class reference.
GATES = (
    ("legality_rate", "hard", 1.0, None),
    ("evaluator_auroc", "hard", 0.80, None),
    ("held_out_nll", "hard", None, 4.5),
    ("diversity", "hard", 0.6, None),
    ("curve_kl", "soft", None, 0.10),
    ("flag_distance_pp", "soft", None, 5.0),
    ("supply_demand", "soft", 0.90, None),
    ("class_reference", "soft", 0.80, None),
    ("calibrated_ece", "soft", None, 0.05),
    ("coverage", "band", 0.35, None),
    ("underplayed", "band", 0.15, None),
    ("archetype_distance", "band", 0.15, 0.40),
)
CLASS_REFERENCE = r"(?i)your (\w+) characters"
SMOOTHING = 0.5
# Hash functions of the diversity estimate.
JACCARD_FUNCTIONS, JACCARD_SEED = 32, "jaccard"
# Numbers that a line's references take in a task, about.
ROLE_NUMBERS = 64


def legality_rate(headers: DataFrame, failed: DataFrame, used: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of legal baskets, and of legal ones whose items show exactly the allowed facets.

    ``used`` is (basket, facet) of the items held; a basket without items counts and is not exact.
    """
    seen = used.select("basket", F.lower("facet").alias("facet")).distinct().groupBy("basket").agg(
        F.collect_set("facet").alias("seen"))
    bad = failed.select("basket").distinct().withColumn("bad", F.lit(1))
    rows = headers.join(seen, "basket", "left").join(bad, "basket", "left")
    ok = F.col("bad").isNull()
    held = F.coalesce("seen", F.array().cast("array<string>"))
    exact = ok & (F.array_sort(held) == F.array_sort(F.transform("facets", F.lower)))
    return rows.groupBy(*by).agg(
        F.count("*").alias("baskets"), F.avg(ok.cast("double")).alias("legal_rate"),
        F.avg(exact.cast("double")).alias("exact_rate"))


def _shares(lines: DataFrame, level: str, name: str) -> DataFrame:
    return lines.groupBy(level).agg(F.sum("qty").alias(name))


def curve_kl(sample: DataFrame, corpus: DataFrame, levels: int, level: str = "bucket") -> DataFrame:
    """KL(sample || corpus) of copies per level, each of ``levels`` cells smoothed by half a copy."""
    spark = sample.sparkSession
    grid = spark.range(levels).select(F.col("id").cast("int").alias(level))
    joined = grid.join(_shares(sample, level, "s"), level, "left").join(_shares(corpus, level, "c"), level, "left")
    cells = joined.select(F.coalesce("s", F.lit(0)).alias("s"), F.coalesce("c", F.lit(0)).alias("c"))
    p = (F.col("s") + SMOOTHING) / (F.col("ts") + SMOOTHING * levels)
    q = (F.col("c") + SMOOTHING) / (F.col("tc") + SMOOTHING * levels)
    totals = cells.agg(F.sum("s").alias("ts"), F.sum("c").alias("tc"))
    both = cells.withColumn("ts", totals.select("ts").scalar()).withColumn("tc", totals.select("tc").scalar())
    return both.agg(F.sum(p * F.log(p / q)).alias("kl"))


def type_chi2(sample: DataFrame, corpus: DataFrame, kind: str = "facet") -> DataFrame:
    """Chi-square statistic of the sample's copies per type against the corpus shares."""
    joined = _shares(corpus, kind, "c").join(_shares(sample, kind, "s"), kind, "left")
    cells = joined.select(F.coalesce("s", F.lit(0)).alias("s"), "c")
    totals = cells.agg(F.sum("s").alias("ts"), F.sum("c").alias("tc"))
    both = cells.withColumn("ts", totals.select("ts").scalar()).withColumn("tc", totals.select("tc").scalar())
    expected = F.col("ts") * F.col("c") / F.col("tc")
    return both.agg(F.sum((F.col("s") - expected) ** 2 / F.nullif(expected, F.lit(0.0))).alias("chi2"), (F.count("*") - 1).alias("dof"))


def chi2_tail(statistic: float, dof: int) -> float:
    """Upper tail of the chi-square distribution: the regularised incomplete gamma function."""
    a, x = dof / 2, statistic / 2
    if x <= 0:
        return 1.0
    scale = exp(a * log(x) - x - lgamma(a))
    if x < a + 1:  # series of the lower part
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return 1 - total * scale
    b, c = x + 1 - a, 1e300  # continued fraction of the upper part
    d = 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b)
        c = b + an / c
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h * scale


def type_chi2_pvalue(sample: DataFrame, corpus: DataFrame, kind: str = "facet") -> float:
    """p-value of the same test, from its one row of statistics."""
    row = type_chi2(sample, corpus, kind).first()
    return 1.0 if row["chi2"] is None or row["dof"] < 1 else chi2_tail(row["chi2"], row["dof"])


def flag_share(sample: DataFrame, corpus: DataFrame, flag: str = "flag") -> DataFrame:
    """Share of flagged copies and its distance to the corpus in percentage points."""
    share = F.sum(F.when(F.col(flag), F.col("qty")).otherwise(0)) / F.sum("qty")
    mean = corpus.agg(share).scalar()
    return sample.agg(share.alias("share")).withColumn("corpus_share", mean).withColumn(
        "distance_pp", F.abs(F.col("share") - F.col("corpus_share")) * 100)


def compliance(lines: DataFrame, named: DataFrame, carried: DataFrame, needed: int = 1) -> DataFrame:
    """Cases and compliant cases over (basket, item, what its text names).

    ``named`` has ``(item_idx, ref)`` that texts name, ``carried`` has ``(item_idx, ref)`` that items
    are or carry. A case is compliant when at least ``needed`` *other* items of the basket carry the
    reference. Items are never paired up: lines come together by basket as they are and get the references
    of their item there, numbered and without those that no text names; members and cases are counted per
    (basket, reference) in one pass.
    """
    roles = named.select("item_idx", "ref", F.lit(1).alias("named"), F.lit(0).alias("carried")).unionByName(
        carried.select("item_idx", "ref", F.lit(0).alias("named"), F.lit(1).alias("carried"))
    ).groupBy("item_idx", "ref").agg(F.sum("named").alias("named"), F.sum("carried").alias("carried"))
    numbered = cut_lineage(named.select("ref").distinct().withColumn("ref_no", F.monotonically_increasing_id()))
    of_item = cut_lineage(roles.join(numbered, "ref").groupBy("item_idx").agg(
        F.collect_list(F.struct("ref_no", "named", "carried")).alias("roles")))
    met = lookup(gathered(lines.select("basket", "item_idx"), ["basket"], ROLE_NUMBERS), of_item, ["item_idx"], "inner").select(
        "basket", F.explode("roles").alias("r")).select("basket", "r.ref_no", "r.named", "r.carried")
    groups = met.groupBy("basket", "ref_no").agg(
        F.sum("carried").alias("members"), F.sum(F.col("named") * F.col("carried")).alias("own"),
        F.sum(F.when(F.col("carried") == 0, F.col("named")).otherwise(0)).alias("foreign"))
    met_by = F.when(F.col("members") > needed, F.col("own")).otherwise(0) + F.when(F.col("members") >= needed, F.col("foreign")).otherwise(0)
    return groups.agg(F.coalesce(F.sum(F.col("own") + F.col("foreign")), F.lit(0)).alias("cases"),
                      F.coalesce(F.sum(met_by), F.lit(0)).alias("compliant")).withColumn(
        "rate", F.col("compliant") / F.nullif(F.col("cases"), F.lit(0)))


def reference_compliance(lines: DataFrame, items: DataFrame, needed: int = 1, pattern: str = CLASS_REFERENCE) -> DataFrame:
    """Compliance with the classes that texts name by a phrase (case-insensitive)."""
    named = items.select("item_idx", F.explode(F.array_distinct(F.transform(
        F.regexp_extract_all("text", F.lit(pattern), F.lit(1)), F.lower))).alias("ref"))
    carried = items.select("item_idx", F.explode(F.array_distinct(F.transform("classes", F.lower))).alias("ref"))
    return compliance(lines, named, carried, needed)


def base_references(items: DataFrame, texts: DataFrame, name: str = "name") -> DataFrame:
    """``(item_idx, ref)``: names of other items that a text of ``(item_idx, text)`` holds, the longest at each place."""
    table = write_names(items.select(name, "item_idx"), name, "item_idx")
    found = texts.select("item_idx", F.explode(F.array_distinct(find_names(F.col("text"), table))).alias("ref"))
    own = items.select("item_idx", F.col(name).alias("ref"))
    return found.join(own, ["item_idx", "ref"], "left_anti")


def base_compliance(lines: DataFrame, items: DataFrame, texts: DataFrame, needed: int = 1, name: str = "name") -> DataFrame:
    """Compliance with the base items that texts name: any item of that name in the basket counts."""
    ship_package(lines.sparkSession)
    return compliance(lines, base_references(items, texts, name), items.select("item_idx", F.col(name).alias("ref")), needed)


def supply_demand(lines: DataFrame, supply: Column, demand: Column, level: str = "bucket") -> DataFrame:
    """``(basket, covered)``: at every level, supply at or above it covers the demand at or above it."""
    sums = lines.groupBy("basket", level).agg(
        F.sum(F.when(supply, F.col("qty")).otherwise(0)).alias("s"),
        F.sum(F.when(demand, F.col("qty")).otherwise(0)).alias("d"))
    above = Window.partitionBy("basket").orderBy(F.col(level).desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return sums.select("basket", (F.sum("s").over(above) >= F.sum("d").over(above)).alias("ok")).groupBy("basket").agg(
        F.bool_and("ok").alias("covered"))


def coverage(lines: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct legal items used over the legal catalogue."""
    legal = items.filter(F.col("legality") == "legal").select("item_idx")
    used = lines.select("item_idx").distinct().join(legal, "item_idx", "left_semi")
    return used.agg(F.count("*").alias("used")).withColumn("legal", legal.agg(F.count("*")).scalar()).withColumn(
        "coverage", F.col("used") / F.nullif(F.col("legal"), F.lit(0)))


def basket_digest(lines: DataFrame, item: str = "item_idx", qty: str = "qty") -> DataFrame:
    """``(basket, digest)`` of the sorted (item, copies) pairs of a collapsed basket."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(item).cast("string").alias("i"), F.col(qty).cast("long").alias("q"))))
    return lines.groupBy("basket").agg(pairs.alias("p")).select("basket", F.sha2(F.to_json("p"), 256).alias("digest"))


def verbatim_rate(sample: DataFrame, train: DataFrame, item: str = "item_idx") -> DataFrame:
    """Share of sample baskets whose multiset is that of some training basket."""
    known = basket_digest(train, item).select("digest").distinct().withColumn("hit", F.lit(1))
    return basket_digest(sample, item).join(known, "digest", "left").agg(
        F.count("*").alias("baskets"), F.count("hit").alias("verbatim"),
        F.avg(F.coalesce("hit", F.lit(0)).cast("double")).alias("rate"))


def underplayed_share(sample: DataFrame, train: DataFrame, quantile: float = 0.1) -> DataFrame:
    """Mean share of copies of items played less than the training quantile; unseen items count as 0."""
    freq = train.groupBy("item_idx").agg(F.sum("qty").alias("n"))
    total = freq.agg(F.sum("n")).scalar()
    freq = freq.withColumn("p", F.col("n") / total)
    bar = freq.agg(F.percentile("p", F.lit(quantile))).scalar()
    low = F.coalesce("p", F.lit(0.0)) < F.col("bar")
    share = F.sum(F.when(low, F.col("qty")).otherwise(0)) / F.sum("qty")
    rows = sample.join(freq.select("item_idx", "p"), "item_idx", "left").withColumn("bar", bar)
    return rows.groupBy("basket").agg(share.alias("share")).agg(F.avg("share").alias("underplayed"))


def jaccard_diversity(lines: DataFrame, functions: int = JACCARD_FUNCTIONS, seed: str = JACCARD_SEED) -> DataFrame:
    """``baskets, diversity, std_error``: estimated mean Jaccard distance over all basket pairs (as item sets).

    The chance that two sets share their smallest item under a random hash is their Jaccard
    index, so per hash function the share of basket pairs with equal minima estimates the
    mean over all pairs. Pairs are counted from group sizes, never formed; cost is linear in
    the lines for sets of any size. ``functions`` independent functions are averaged; their
    spread gives the standard error. Fewer than two baskets have no diversity (null).
    """
    held = lines.select("basket", "item_idx")
    values = [u32(seed, str(i), F.col("item_idx")).alias(f"h{i}") for i in range(functions)]
    hashed = cut_lineage(held.select("item_idx").distinct().select("item_idx", *values))
    near = lookup(gathered(held, ["basket"], functions), hashed, ["item_idx"], "inner", small=max(1, SMALL_NUMBERS // functions))
    least = near.groupBy("basket").agg(*[F.min(f"h{i}").alias(f"h{i}") for i in range(functions)])
    long = least.select(F.posexplode(F.array(*[f"h{i}" for i in range(functions)])).alias("f", "h"))
    met = long.groupBy("f", "h").agg(F.count("*").alias("c")).groupBy("f").agg(
        F.sum(F.col("c") * (F.col("c") - 1)).alias("met"), F.sum("c").alias("n"))
    pairs = F.nullif((F.col("n") * (F.col("n") - 1)).cast("double"), F.lit(0.0))
    return met.select("n", (F.col("met") / pairs).alias("share")).agg(
        F.max("n").alias("baskets"), (1 - F.avg("share")).alias("diversity"),
        (F.stddev_samp("share") / F.sqrt(F.lit(float(functions)))).alias("std_error"))


def gate_table(spark, gates: Sequence[tuple] = GATES) -> DataFrame:
    return spark.createDataFrame(list(gates), "metric string, kind string, low double, high double")


def quality_gates(metrics: DataFrame, gates: DataFrame) -> DataFrame:
    """Status per gate: ``pass``, ``prerelease`` (soft or band missed) or ``fail`` (hard missed or no value)."""
    inside = F.coalesce((F.col("value") >= F.coalesce("low", F.lit(float("-inf"))))
                        & (F.col("value") <= F.coalesce("high", F.lit(float("inf")))) & ~F.isnan("value"), F.lit(False))
    status = F.when(inside, "pass").when(F.col("kind") == "hard", "fail").otherwise("prerelease")
    return gates.join(metrics, "metric", "left").select("metric", "kind", "value", status.alias("status"))


def overall_status(gated: DataFrame) -> DataFrame:
    level = F.when(F.col("status") == "fail", 2).when(F.col("status") == "prerelease", 1).otherwise(0)
    return gated.agg(F.element_at(F.array(F.lit("pass"), F.lit("prerelease"), F.lit("fail")), F.max(level) + 1).alias("overall"))


def style_report(picks: DataFrame, order: Sequence[str]) -> DataFrame:
    """Mean novelty per preset in slider order; a mid-point is ``between`` if it lies between its neighbours."""
    place = F.array_position(F.array(*[F.lit(n) for n in order]), F.col("preset"))
    means = picks.groupBy("preset").agg(F.avg("novelty").alias("novelty")).withColumn("place", place)
    w = Window.orderBy("place")  # one row per preset
    low = F.least(F.lag("novelty").over(w), F.lead("novelty").over(w))
    high = F.greatest(F.lag("novelty").over(w), F.lead("novelty").over(w))
    middle = (F.lag("novelty").over(w).isNotNull()) & (F.lead("novelty").over(w).isNotNull())
    return means.withColumn("between", F.when(middle, (F.col("novelty") >= low) & (F.col("novelty") <= high)))


def interpolatable(report: DataFrame) -> DataFrame:
    """One row: do all mid-points of a ``style_report`` lie between their neighbours? The ends have no say."""
    return report.filter(F.col("between").isNotNull()).agg(F.coalesce(F.bool_and("between"), F.lit(True)).alias("interpolatable"))


def type_mix_passes(sample: DataFrame, corpus: DataFrame, kind: str = "facet", level: float = 0.05) -> DataFrame:
    """``chi2, dof, passes``: is the sample's mix of types one that the corpus gives by chance (p above ``level``)?"""
    found = cut_lineage(type_chi2(sample, corpus, kind))
    row = found.first()
    p = 1.0 if row["chi2"] is None or row["dof"] < 1 else chi2_tail(row["chi2"], row["dof"])
    return found.withColumn("passes", F.lit(p > level))
