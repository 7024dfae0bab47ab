"""How the bench tables stand in for variants, items, baskets and embeddings.

Each Spark view has a SQL twin of the same name; ``with_ctes`` puts the wanted ones, and
what they build on, in front of a query.

* variant = part: name ``p_name``, version ``p_type``, set = digits of the brand (brands
  21..25 are lettered sets), number ``p_size``;
* item = (name, version); facet = version (six values); bucket = size / 5;
* basket = order, its date, and the facets its customer's segment allows;
* vector of item i = row ``i mod n`` of the embeddings table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import max_copies, normalise_text
from ..operators import baskets as B
from ..operators import catalog as C
from ..operators import splits as S
from ..session import cut_lineage

# Fixed values of the binding.
FACETS = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
BARRED_FACET = {"AUTOMOBILE": "ECONOMY", "BUILDING": "LARGE", "FURNITURE": "MEDIUM",
                "HOUSEHOLD": "PROMO", "MACHINERY": "SMALL"}
KNOWN_SIZE = 49  # the catalogue used for rewriting has no parts above this size
SEED = "basketry"
COMMON_CAP = 48


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def variants(spark: SparkSession, folder: str) -> DataFrame:
    brand = F.regexp_extract("p_brand", r"(\d+)", 1)
    lettered = brand.cast("int").between(21, 25)
    code = F.when(lettered, F.concat(F.lit("P"), brand)).otherwise(brand)
    text = F.when(
        brand == "1",
        F.concat(F.lit("You may have any number of cards named "), "p_name", F.lit(" in your deck.")),
    ).otherwise(f"You may have up to {COMMON_CAP} copies of this card in your deck.")
    legality = F.when(brand == "13", "banned").when(brand == "7", "not_legal").otherwise("legal")
    words = F.split("p_name", " ")
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("version"), code.alias("set_code"),
        F.col("p_size").alias("number"), F.col("p_retailprice").alias("price"),
        text.alias("text"), legality.alias("legality"),
        F.array(F.col("p_type")).alias("facets"), words.alias("classes"),
        F.floor(F.col("p_size") / 5).cast("int").alias("cost"),
        (F.col("p_size") % 2 == 0).alias("flag"))


def canonical(spark: SparkSession, folder: str) -> DataFrame:
    """One row per item, without the dense index."""
    carry = ["set_code", "number", "price", "text", "legality", "facets", "classes", "cost", "flag"]
    return C.collapse_items(variants(spark, folder), carry)


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical attributes with the dense index, bucket and copy cap."""
    cap = max_copies(F.col("text"))
    return (
        C.item_index(canonical(spark, folder))
        .withColumn("bucket", F.least(F.col("cost"), F.lit(11)))
        .withColumn("cap", F.when(cap != float("inf"), cap))
    )


def item_map(spark: SparkSession, folder: str, index: DataFrame | None = None) -> DataFrame:
    index = items(spark, folder) if index is None else index
    return C.variant_item_map(variants(spark, folder), index)


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("basket"), F.col("l_partkey").alias("variant"),
        F.col("l_linenumber").alias("line_no"), F.col("l_quantity").cast("int").alias("qty"))


def lines(spark: SparkSession, folder: str, index: DataFrame | None = None) -> DataFrame:
    """Collapsed (basket, item_idx, qty)."""
    resolved = B.resolve_lines(raw_lines(spark, folder), item_map(spark, folder, index))
    return B.collapse_baskets(resolved)


def headers(spark: SparkSession, folder: str) -> DataFrame:
    """(basket, date, segment, facets) of every order."""
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("basket"), F.col("o_custkey").alias("c_custkey"),
        F.to_date("o_orderdate").alias("date"))
    segments = table(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    barred = F.lit(None).cast("string")
    for segment, facet in BARRED_FACET.items():
        barred = F.when(F.col("segment") == segment, facet).otherwise(barred)
    allowed = F.array_except(F.array(*[F.lit(f) for f in FACETS]), F.array(F.coalesce(barred, F.lit(""))))
    return orders.join(segments, "c_custkey").select("basket", "date", "segment", allowed.alias("facets"))


def played(spark: SparkSession, folder: str) -> DataFrame:
    """Headers of all orders; those without lines are empty baskets."""
    return headers(spark, folder)


def stored(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, lines and headers written once, for plans that read them several times."""
    index = cut_lineage(items(spark, folder))
    return index, cut_lineage(lines(spark, folder, index)), cut_lineage(played(spark, folder))


def known_map(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """Variant map of an older catalogue, so that rewriting meets unknown variants."""
    older = variants(spark, folder).filter(F.col("number") <= KNOWN_SIZE)
    return C.variant_item_map(older, index)


def accepted(spark: SparkSession, folder: str, index: DataFrame | None = None) -> DataFrame:
    """Headers of the legal baskets."""
    index = items(spark, folder) if index is None else index
    heads = played(spark, folder)
    reasons = B.legality_reasons(lines(spark, folder, index), heads, index)
    return heads.join(reasons.select("basket").distinct(), "basket", "left_anti")


def split(spark: SparkSession, folder: str, index: DataFrame | None = None) -> DataFrame:
    """Legal baskets with ``heldout``."""
    return S.heldout_split(accepted(spark, folder, index), seed=SEED)


def item_vectors(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """(item_idx, facets, bucket, vec) with vec as array<double>."""
    source = table(spark, folder, "embeddings")
    n = source.agg(F.count("*")).scalar()
    vectors = source.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))
    return index.withColumn("vec_id", F.pmod(F.col("item_idx"), n)).join(vectors, "vec_id").select(
        "item_idx", "facets", "bucket", "vec")


def item_texts(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """(item_idx, text): names the item seven times further on, then a whole document, normalised."""
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("_doc"), F.coalesce("text", F.lit("")).alias("_body"))
    n, n_docs = index.agg(F.count("*")).scalar(), docs.agg(F.count("*")).scalar()
    base = index.select(F.col("item_idx").alias("_base"), F.col("name").alias("_name"))
    return index.select(
        "item_idx", (F.pmod(F.col("item_idx") * 7, n) + 1).alias("_base"), F.pmod(F.col("item_idx"), n_docs).alias("_doc")
    ).join(base, "_base").join(docs, "_doc").select(
        "item_idx", normalise_text(F.concat(F.lit("Shift onto "), "_name", F.lit(". "), "_body")).alias("text"))


_CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "variants": ((), f"""
        select p_partkey as id, p_name as name, p_type as version,
          case when b between 21 and 25 then 'P' || b else '' || b end as set_code,
          p_size as number, p_retailprice as price,
          case when b = 13 then 'banned' when b = 7 then 'not_legal' else 'legal' end as legality,
          case when b = 1 then null else {COMMON_CAP}.0 end as cap,
          string_split(p_name, ' ') as classes, p_size // 5 as cost, p_size % 2 = 0 as flag
        from (select *, regexp_extract(p_brand, '(\\d+)', 1)::int as b from part)"""),
    "positions": (("variants",), """
        select *, row_number() over (partition by name, version order by
          case when try_cast(set_code as int) is null then 0 else 1 end desc,
          coalesce(try_cast(set_code as int), 0) desc, set_code desc, number desc, id desc) as position
        from variants"""),
    "items": (("positions",), """
        select name, version, name || '|' || version as item_id, id as canonical_id, set_code, number,
          price, legality, cap, classes, cost, flag, least(cost, 11) as bucket, version as facet,
          row_number() over (order by name, version) as item_idx
        from positions where position = 1"""),
    "item_map": (("items", "variants"), """
        select v.id, i.item_idx, i.item_id from variants v join items i using (name, version)"""),
    "raw_lines": ((), """
        select l_orderkey as basket, l_partkey as variant, l_linenumber as line_no,
          l_quantity::int as qty from lineitem"""),
    "lines": (("raw_lines", "item_map"), """
        select basket, item_idx, sum(qty)::bigint as qty from raw_lines
        join item_map on variant = id group by all"""),
    "headers": ((), """
        select o_orderkey as basket, o_orderdate::date as date, c_mktsegment as segment,
          case c_mktsegment """ + " ".join(
              f"when '{s}' then '{f}'" for s, f in BARRED_FACET.items()) + """ end as barred
        from orders join customer on o_custkey = c_custkey"""),
    "facets": ((), "select unnest([" + ", ".join(f"'{f}'" for f in FACETS) + "]) as facet"),
    "segment_keys": (("headers", "facets"), """
        select barred, string_agg(lower(facet), '|' order by facet) as facet_key
        from (select distinct barred from headers) cross join facets
        where barred is null or facet <> barred group by barred"""),
    "played": (("headers", "segment_keys"), """
        select h.*, facet_key from headers h join segment_keys k on h.barred is not distinct from k.barred"""),
    "reasons": (("lines", "items", "played"), """
        with e as (select l.*, i.legality, i.cap, i.facet, p.barred from lines l
          join items i using (item_idx) join played p using (basket))
        select basket, item_idx, 'card_not_legal' as code from e where legality = 'banned'
        union all select basket, item_idx, 'count_exceeds_max_copies' from e where qty > cap
        union all select basket, item_idx, 'card_ink_not_in_deck_inks' from e where facet = barred
        union all select basket, null, 'deck_size_below_60' from played left join lines using (basket)
          group by basket having coalesce(sum(qty), 0) < 60"""),
    "accepted": (("played", "reasons"), """
        select * from played where basket not in (select basket from reasons)"""),
    "split": (("accepted",), f"""
        select * exclude (rn, h), stratum_size >= 10
          and rn <= greatest(1, round_even(stratum_size * 0.1, 0)) as heldout
        from (select *, row_number() over (partition by facet_key, month order by h, basket) as rn,
            count(*) over (partition by facet_key, month) as stratum_size
          from (select *, date_trunc('month', date)::date as month,
              ('0x' || substr(sha1('{SEED}:' || basket), 1, 8))::bigint as h from accepted))"""),
    "item_texts": (("items",), r"""
        select i.item_idx, trim(regexp_replace(regexp_replace(regexp_replace('Shift onto ' || b.name || '. ' || coalesce(d.text, ''),
          '[\t-\r\x1c-\x1f\x{85}\p{Z}]*\([^)]*\)', '', 'g'), '[‘’]', '''', 'g'), '[\t-\r\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g')) as text
        from items i join items b on b.item_idx = (i.item_idx * 7) % (select count(*) from items) + 1
        join documents d on d.doc_id = i.item_idx % (select count(*) from documents)"""),
    "item_vectors": (("items",), """
        select item_idx, facet, bucket, e.embedding::double[] as vec
        from items join embeddings e on e.vec_id = item_idx % (select count(*) from embeddings)"""),
}


def u32_sql(*parts: str) -> str:
    """SQL twin of ``functions.hashing.u32``."""
    return "('0x' || substr(sha1(" + " || ':' || ".join(parts) + "), 1, 8))::bigint"


def r6(value: str) -> str:
    """SQL twin of ``functions.vectors.round6``."""
    return f"floor(({value}) * 1e6 + 0.5) / 1e6"


def with_ctes(wanted: str, body: str, extra: str = "") -> str:
    """Prefix ``body`` with the named views (space separated) and their needs.

    ``extra`` adds views before the body; a body that starts with a comma goes on with the list.
    """
    order: list[str] = []

    def add(name: str) -> None:
        needs, _ = _CTES[name]
        for need in needs:
            add(need)
        if name not in order:
            order.append(name)

    for name in wanted.split():
        add(name)
    parts = [f"{name} as materialized ({_CTES[name][1]})" for name in order]
    if extra:
        parts.append(extra)
    return "with " + ",\n".join(parts) + "\n" + body
