"""Items, index, text rules, facets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import facets as FA
from ..functions import text as T
from ..operators import catalog as C
from ..operators import layout as L
from . import binding as b
from .binding import with_ctes
from .registry import query

SIGNATURE = ["number", "price"]


@query("item_collapse", with_ctes("positions", """
    select name, version, name || '|' || version as item_id,
      max(case when position = 1 then id end) as canonical_id, count(*) as n_variants
    from positions group by all"""))
def item_collapse(spark, folder):
    return C.collapse_items(b.variants(spark, folder), []).select(
        "name", "version", "item_id", "canonical_id", "n_variants")


@query("variant_positions", with_ctes("positions", """
    select name || '|' || version as item_id, id, position from positions"""))
def variant_positions(spark, folder):
    return C.variant_positions(b.variants(spark, folder)).select("item_id", "id", "position")


_SIGNED = """g as (select name, version, count(*) as n, count(distinct (number, price)) as s
      from variants group by all)"""


@query("dedup_report", with_ctes("variants", """
    select sum(n)::bigint as variants, count(*) as items, count(*) filter (n > 1) as multi_groups,
      count(*) filter (s > 1) as drift_groups from g""", _SIGNED))
def dedup_report(spark, folder):
    return C.dedup_report(b.variants(spark, folder), C.signature(SIGNATURE))


@query("drift_samples", with_ctes("variants", """
    select name || '|' || version as item_id, s as n_signatures, id from variants
    join (select * from g where s > 1 order by name, version limit 20) using (name, version)""", _SIGNED))
def drift_samples(spark, folder):
    return C.drift_samples(b.variants(spark, folder), C.signature(SIGNATURE))


@query("item_index", with_ctes("items", "select item_idx, name, version, canonical_id from items"))
def item_index(spark, folder):
    return b.items(spark, folder).select("item_idx", "name", "version", "canonical_id")


@query("variant_item_map", with_ctes("item_map", "select id, item_idx, item_id from item_map"))
def variant_item_map(spark, folder):
    return b.item_map(spark, folder)


_TEXTS = """
    select 'part:' || p_partkey as ref, case when p_brand = 'Brand#1'
        then 'You may have any number of cards named ' || p_name || ' in your deck.'
        when p_brand = 'Brand#2' then 'YOU may only have ' || p_size || ' copies of this card in your deck.'
        else 'You may have up to 48 copies of this card in your deck.' end as text from part
    union all select 'doc:' || doc_id, text from documents"""


@query("max_copies", f"""
    select ref, case when regexp_matches(text, '(?i)you may have any number of cards named') then 'infinity'
      else coalesce(nullif(regexp_extract(text, '(?i)you may have up to (\\d+) copies of', 1), ''),
        nullif(regexp_extract(text, '(?i)you may only have (\\d+) cop(?:y|ies) of', 1), ''), '4') end as cap
    from ({_TEXTS})""")
def max_copies(spark, folder):
    only = F.concat(F.lit("YOU may only have "), "p_size", F.lit(" copies of this card in your deck."))
    many = F.concat(F.lit("You may have any number of cards named "), "p_name", F.lit(" in your deck."))
    parts = b.table(spark, folder, "part").select(
        F.concat(F.lit("part:"), "p_partkey").alias("ref"),
        F.when(F.col("p_brand") == "Brand#1", many).when(F.col("p_brand") == "Brand#2", only)
        .otherwise("You may have up to 48 copies of this card in your deck.").alias("text"))
    docs = b.table(spark, folder, "documents").select(
        F.concat(F.lit("doc:"), "doc_id").alias("ref"), "text")
    cap = T.max_copies(F.col("text"))
    return parts.unionByName(docs).select(
        "ref", F.when(cap == float("inf"), "infinity").otherwise(cap.cast("long").cast("string")).alias("cap"))


_SPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"


@query("text_normalise", f"""
    with raw as (select doc_id, replace(replace(text, ', ', ' (as noted) “'), '. ', '”' || chr(9) || ' ‘') as t
      from documents),
    a as (select doc_id, trim(regexp_replace(regexp_replace(t, '{_SPACE}*\\([^)]*\\)', '', 'g'), '{_SPACE}+', ' ', 'g')) as t
      from raw),
    q as (select doc_id, trim(regexp_replace(translate(t, '‘’“”', '''''""'), '{_SPACE}+', ' ', 'g')) as clean from a)
    select doc_id, clean from q where length(clean) > 0""")
def text_normalise(spark, folder):
    raw = F.replace(F.replace(F.col("text"), F.lit(", "), F.lit(" (as noted) “")), F.lit(". "), F.lit("”\t ‘"))
    docs = b.table(spark, folder, "documents").select("doc_id", raw.alias("text"))
    return docs.filter(T.has_text(F.col("text"))).select("doc_id", T.normalise_text(F.col("text")).alias("clean"))


_BASKET_FACETS = """f as (select distinct l_orderkey as basket, p_type as facet
      from lineitem join part on l_partkey = p_partkey)"""


def _basket_facets(spark, folder):
    parts = b.table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    held = b.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey").join(parts, "l_partkey")
    return held.groupBy(F.col("l_orderkey").alias("basket")).agg(F.collect_set("p_type").alias("facets"))


@query("facet_key", with_ctes("", """select basket, string_agg(lower(facet), '|' order by lower(facet)) as facet_key
    from f group by basket""", _BASKET_FACETS))
def facet_key(spark, folder):
    return _basket_facets(spark, folder).select("basket", FA.facet_key(F.col("facets")).alias("facet_key"))


_BITS = " + ".join(f"max(case when facet = '{f}' then {1 << i} else 0 end)" for i, f in enumerate(b.FACETS))


@query("facet_mask", with_ctes("", f"select basket, ({_BITS})::int as mask from f group by basket", _BASKET_FACETS))
def facet_mask(spark, folder):
    parts = b.table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    held = b.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey").join(parts, "l_partkey")
    return held.groupBy(F.col("l_orderkey").alias("basket")).agg(
        F.bit_or(FA.facet_bit(F.col("p_type"), b.FACETS)).alias("mask"))


@query("facet_multihot", with_ctes("", "select basket, " + ", ".join(
    f"max((facet = '{f}')::int) as {f.lower()}" for f in b.FACETS) + " from f group by basket", _BASKET_FACETS))
def facet_multihot(spark, folder):
    hot = FA.facet_multihot(F.col("facets"), b.FACETS)
    return _basket_facets(spark, folder).select("basket", hot.alias("hot")).select(
        "basket", *[F.col("hot")[i].alias(f.lower()) for i, f in enumerate(b.FACETS)])


@query("item_facet_masks", with_ctes("items", """
    select item_idx, case facet """ + " ".join(
        f"when '{f}' then {1 << i}" for i, f in enumerate(b.FACETS)) + """ end as mask from items
    union all select 0, 0"""))
def item_facet_masks(spark, folder):
    from ..sources.artifacts import facet_masks

    return facet_masks(b.items(spark, folder), b.FACETS)


_LISTS = ("classes", "facets")
_BLOCKS = (("cost", 12), ("inks", 6), ("types", 6))
_SCALARS = ("number", "price", "flag")


@query("class_discovery", with_ctes("items", """
    select block, class, row_number() over (partition by block order by class) - 1 as position from (
      select distinct 'classes' as block, unnest(classes) as class from items
      union select distinct 'facets', facet from items)"""))
def class_discovery(spark, folder):
    return L.discover_classes(b.canonical(spark, folder), _LISTS).select("block", "class", "position")


@query("class_layout", with_ctes("items", """
    select block, length, (sum(length) over (order by no) - length)::int as start from (
      values (0,'cost',12), (1,'inks',6), (2,'types',6),
       (3,'classes',(select count(distinct c) from (select unnest(classes) as c from items))),
       (4,'facets',(select count(distinct facet) from items)),
       (5,'number',1), (6,'price',1), (7,'flag',1)) t(no, block, length)"""))
def class_layout(spark, folder):
    classes = L.discover_classes(b.canonical(spark, folder), _LISTS)
    return L.layout(L.block_lengths(classes, _BLOCKS, _LISTS, _SCALARS)).select("block", "length", "start")


@query("normalisers", with_ctes("items", """
    select greatest(max(number), 1) as number, greatest(max(price), 1) as price from items"""))
def normalisers(spark, folder):
    return L.fit_normalisers(b.canonical(spark, folder), ["number", "price"])


def item_spec(index):
    return L.fitted_spec(index, cost="cost", facets="facets", facet_order=b.FACETS, types="facets",
                         type_order=b.FACETS, lists=["classes"], stats=["number", "price"], flag="flag")


_FEATURES = ("""cls as (select c, row_number() over (order by c) - 1 as pos from (select distinct unnest(classes) as c from items)),
    n as (select count(*)::int as n from cls),
    top as (select greatest(max(number), 1) as number, greatest(max(price), 1) as price from items),
    ones as (
      select item_idx, least(greatest(cost, 0), 11) as dim, 1.0::double as value from items
      union all select item_idx, 12 + list_position([""" + ", ".join(f"'{f}'" for f in b.FACETS) + """], facet) - 1, 1.0 from items
      union all select item_idx, 18 + list_position([""" + ", ".join(f"'{f}'" for f in b.FACETS) + """], facet) - 1, 1.0 from items
      union all select distinct item_idx, 24 + pos, 1.0 from (select item_idx, unnest(classes) as c from items) join cls using (c)
      union all select item_idx, 24 + n, """ + b.r6("items.number / top.number") + """ from items, n, top
      union all select item_idx, 25 + n, """ + b.r6("items.price / top.price") + """ from items, n, top
      union all select item_idx, 26 + n, flag::int from items, n)""")


@query("feature_rows", with_ctes("items", """
    select i.item_idx, g.dim::int as dim, coalesce(o.value, 0.0) as value
    from (select item_idx from items union all select 0) i, n, generate_series(0, 26 + n) g(dim)
    left join ones o on o.item_idx = i.item_idx and o.dim = g.dim""", _FEATURES))
def feature_rows(spark, folder):
    from ..functions.vectors import round6

    index = b.items(spark, folder)
    return L.feature_rows(index, item_spec(index)).select(
        "item_idx", F.posexplode("features").alias("dim", "value")
    ).withColumn("value", round6(F.col("value")))


@query("feature_sink", with_ctes("items", """
    select i.item_idx, g.dim::int as dim, coalesce(o.value, 0.0) as value
    from (select item_idx from items union all select 0) i, n, generate_series(0, 26 + n) g(dim)
    left join ones o on o.item_idx = i.item_idx and o.dim = g.dim""", _FEATURES))
def feature_sink(spark, folder):
    """Feature rows and layout written, read back and checked."""
    from ..functions.vectors import round6
    from ..session import scratch_folder
    from ..sources import artifacts as A

    index = b.items(spark, folder)
    spec = item_spec(index)
    layout = spark.createDataFrame([(n, int(o), int(k)) for n, o, k in spec.blocks()], "block string, offset int, length int")
    target = scratch_folder(spark, "features")
    A.write_features(L.feature_rows(index, spec), layout, target)
    rows, _ = A.read_features(spark, target)
    return rows.select("item_idx", F.posexplode("features").alias("dim", "value")).withColumn("value", round6(F.col("value")))


@query("inverted_index", with_ctes("items", "select lower(facet) as facet, bucket, item_idx from items"))
def inverted_index(spark, folder):
    return L.inverted_index(b.items(spark, folder), bucket="bucket")


@query("index_alignment", with_ctes("items", """
    select count(*) filter (a.i is not null and e.vec_id is not null) as matched,
      count(*) filter (e.vec_id is null) as left_only, count(*) filter (a.i is null) as right_only,
      0::bigint as repeated
    from (select item_idx as i from items) a full join embeddings e on e.vec_id = a.i"""))
def index_alignment(spark, folder):
    return L.align_indexes(b.items(spark, folder), b.table(spark, folder, "embeddings"), "item_idx", "vec_id")
