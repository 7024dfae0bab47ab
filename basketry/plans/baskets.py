"""Rewrite, legality, splits, frequencies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.facets import facet_key, month_back
from ..functions.hashing import hash_split
from ..operators import baskets as B
from ..operators import frequency as FR
from ..operators import splits as S
from . import binding as b
from .binding import with_ctes
from .registry import query


def _resolved(spark, folder, index):
    return B.resolve_lines(b.raw_lines(spark, folder), b.known_map(spark, folder, index))


_RESOLVED = f"""known as (select id, item_idx from item_map join variants using (id) where number <= {b.KNOWN_SIZE}),
    res as (select r.*, k.item_idx from raw_lines r left join known k on r.variant = k.id),
    bad as (select distinct basket from res where item_idx is null),
    good as (select basket, item_idx, sum(qty)::bigint as qty from res
      where basket not in (select basket from bad) group by all)"""


@query("rewrite_baskets", with_ctes("raw_lines item_map", "select * from good", _RESOLVED))
def rewrite_baskets(spark, folder):
    return B.rewrite_baskets(_resolved(spark, folder, b.items(spark, folder)))


@query("unknown_variants", with_ctes(
    "raw_lines item_map", "select basket, line_no, variant from res where item_idx is null", _RESOLVED))
def unknown_variants(spark, folder):
    return B.unknown_lines(_resolved(spark, folder, b.items(spark, folder))).select("basket", "line_no", "variant")


@query("basket_collapse", with_ctes("lines", "select basket, item_idx, qty from lines"))
def basket_collapse(spark, folder):
    return b.lines(spark, folder)


@query("basket_totals", with_ctes("lines", """
    select basket, sum(qty)::bigint as total, count(*) as n_items from lines group by basket"""))
def basket_totals(spark, folder):
    return B.basket_totals(b.lines(spark, folder))


@query("item_enrich", with_ctes("lines items", """
    select basket, item_idx, qty, facet, bucket, legality from lines join items using (item_idx)"""))
def item_enrich(spark, folder):
    index = b.items(spark, folder)
    return b.lines(spark, folder, index).join(
        index.select("item_idx", F.col("version").alias("facet"), "bucket", "legality"), "item_idx"
    ).select("basket", "item_idx", "qty", "facet", "bucket", "legality")


@query("legality_reasons", with_ctes("reasons", "select * from reasons"))
def legality_reasons(spark, folder):
    index = b.items(spark, folder)
    return B.legality_reasons(b.lines(spark, folder, index), b.played(spark, folder), index)


@query("legality_reasons_strict", with_ctes("reasons", """
    select * from reasons union all select basket, item_idx, 'card_not_legal'
    from lines join items using (item_idx) where legality = 'not_legal'"""))
def legality_reasons_strict(spark, folder):
    index = b.items(spark, folder)
    return B.legality_reasons(b.lines(spark, folder, index), b.played(spark, folder), index, strict=True)


def _validated(spark, folder):
    index = b.items(spark, folder)
    resolved = _resolved(spark, folder, index)
    heads = b.played(spark, folder)
    reasons = B.legality_reasons(B.rewrite_baskets(resolved), heads, index)
    return heads, B.unknown_lines(resolved), reasons


_VALIDATED = _RESOLVED + """,
    e as (select l.*, i.legality, i.cap, i.facet, p.barred from good l
      join items i using (item_idx) join played p using (basket)),
    why as (
        select basket, 'card_not_legal' as code from e where legality = 'banned'
        union all select basket, 'count_exceeds_max_copies' from e where qty > cap
        union all select basket, 'card_ink_not_in_deck_inks' from e where facet = barred
        union all select basket, 'deck_size_below_60' from played left join good using (basket)
          where basket not in (select basket from bad) group by basket having coalesce(sum(qty), 0) < 60)"""


@query("validation_report", with_ctes("raw_lines item_map played", """
    select total, total - u - i as valid, u as dropped_unknown, i as dropped_illegal,
      (u + i) / total as drop_rate
    from (select (select count(*) from played) as total, (select count(*) from bad) as u,
      (select count(distinct basket) from why) as i)""", _VALIDATED))
def validation_report(spark, folder):
    return B.validation_report(*_validated(spark, folder))


@query("reason_histogram", with_ctes("raw_lines item_map played", """
    select code, count(*) as n from why group by code
    union all select 'unknown_printing_id', count(*) from bad""", _VALIDATED))
def reason_histogram(spark, folder):
    _, unknown, reasons = _validated(spark, folder)
    return B.reason_histogram(unknown, reasons)


@query("recency_filter", with_ctes("headers", """
    select basket, date from headers
    where date >= (select max(date) - interval 12 month from headers)"""))
def recency_filter(spark, folder):
    return S.recent(b.headers(spark, folder)).select("basket", "date")


@query("month_subtract", """
    select o_orderkey as basket, (o_orderdate::date - interval 1 month)::date as month_1,
      (o_orderdate::date - interval 6 month)::date as month_6,
      (o_orderdate::date - interval 12 month)::date as month_12 from orders""")
def month_subtract(spark, folder):
    day = F.to_date("o_orderdate")
    return b.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("basket"), *[month_back(day, n).alias(f"month_{n}") for n in (1, 6, 12)])


@query("heldout_split", with_ctes("split", "select basket, facet_key, month, heldout from split"))
def heldout_split(spark, folder):
    return b.split(spark, folder).select("basket", "facet_key", "month", "heldout")


@query("split_report", with_ctes("split", """
    select total, heldout, total - heldout as train, strata, singletons, reference_date,
      (reference_date - interval 12 month)::date as cutoff_date,
      (select count(*) from split where not heldout
        and date >= (select max(date) - interval 12 month from split)) as proposal
    from (select sum(n)::bigint as total, sum(h)::bigint as heldout, count(*) as strata,
        count(*) filter (n = 1) as singletons, max(d) as reference_date
      from (select count(*) as n, sum(heldout::int) as h, max(date) as d from split group by facet_key, month))"""))
def split_report(spark, folder):
    return S.split_report(b.split(spark, folder))


@query("train_sets", with_ctes("split", """
    select basket, case when heldout then 'heldout' else 'train' end as split,
      not heldout and date >= (select max(date) - interval 12 month from split) as proposal from split"""))
def train_sets(spark, folder):
    return S.with_recent_train(b.split(spark, folder)).select("basket", "split", "proposal")


@query("hash_split", f"""
    select doc_id, {b.u32_sql("'pretrain-encoder'", 'doc_id')} < {int(0.1 * 2**32)} as heldout from documents""")
def hash_split_query(spark, folder):
    return b.table(spark, folder, "documents").select(
        "doc_id", hash_split("pretrain-encoder", F.col("doc_id"), 0.1).alias("heldout"))


def keyed_lines(spark, folder, index=None):
    heads = b.played(spark, folder).select("basket", facet_key(F.col("facets")).alias("facet_key"))
    return b.lines(spark, folder, index).join(heads, "basket")


_FREQUENCY = """keyed as (select facet_key, item_idx, sum(qty)::bigint as qty from lines join played using (basket) group by all),
    long as (select * from keyed union all select '_all', item_idx, sum(qty)::bigint from keyed group by item_idx),
    freq as (select *, sum(qty) over (partition by facet_key)::bigint as total from long)"""


@query("play_frequency", with_ctes("lines played", f"""
    select facet_key, item_idx, qty, total, {b.r6('qty / total')} as p from freq""", _FREQUENCY))
def play_frequency(spark, folder):
    from ..functions.vectors import round6

    return FR.play_frequency(keyed_lines(spark, folder)).withColumn("p", round6(F.col("p")))


@query("play_frequency_published", with_ctes("lines played", """
    select facet_key, item_idx, floor(qty / total * 1e6) / 1e6 as p from freq where qty > 0""", _FREQUENCY))
def play_frequency_published(spark, folder):
    return FR.published(FR.play_frequency(keyed_lines(spark, folder)))


@query("facet_key_baskets", with_ctes("played", """
    select facet_key, count(*) as baskets, min(basket) as first_basket from played group by facet_key"""))
def facet_key_baskets(spark, folder):
    return b.played(spark, folder).groupBy(facet_key(F.col("facets")).alias("facet_key")).agg(
        F.count("*").alias("baskets"), F.min("basket").alias("first_basket"))
