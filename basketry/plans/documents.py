"""Documents and artefacts written from the tables and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.facets import facet_key
from ..operators import frequency as FR
from ..session import scratch_folder
from ..sources import artifacts as A
from ..sources import readers as R
from . import binding as b
from .baskets import _FREQUENCY, keyed_lines
from .binding import with_ctes
from .registry import query


def _event_documents(spark, folder):
    """One event document per order."""
    lines = b.raw_lines(spark, folder).groupBy("basket").agg(F.array_sort(F.collect_list(F.struct(
        F.col("line_no"), F.col("variant").cast("string").alias("cardId"), F.col("qty").alias("count")))).alias("cards"))
    cards = F.transform("cards", lambda c: F.struct(c["cardId"].alias("cardId"), c["count"].alias("count")))
    deck = F.struct(F.col("facets").alias("inks"), cards.alias("cards"), F.lit(None).cast("string").alias("name"))
    entry = F.struct(F.lit(1).alias("placement"), F.col("segment").alias("player"), deck.alias("deck"))
    event = F.struct(
        F.concat(F.lit("https://example.org/"), "basket").alias("sourceUrl"), F.lit("orders").alias("sourceName"),
        F.concat(F.lit("order "), "basket").alias("name"), F.date_format("date", "yyyy-MM-dd").alias("date"), F.array(entry).alias("decks"))
    return lines.join(b.headers(spark, folder), "basket").select(
        F.concat(F.lit("1.0."), "basket").alias("datasetVersion"), F.lit("1").alias("schemaVersion"),
        F.array(event).alias("tournaments"))


@query("nested_read", with_ctes("headers", """
    select '1.0.' || basket as basket, date, segment as player, variant::varchar as variant, qty
    from (select l_orderkey as basket, l_partkey as variant, l_quantity::int as qty from lineitem) join headers using (basket)"""))
def nested_read(spark, folder):
    target = scratch_folder(spark, "events")
    _event_documents(spark, folder).write.json(target)
    baskets = R.read_events(spark, target, multiline=False)
    lines = R.event_lines(baskets).join(baskets.select("basket", "date", "player"), "basket")
    # The basket id ends with the file and the positions in it; the version names the order.
    version = F.regexp_extract("basket", r"^([^:]*):", 1)
    return lines.select(version.alias("basket"), "date", "player", "variant", "qty")


@query("basket_json_roundtrip", with_ctes("lines split", """
    select case when heldout then 'heldout' else 'train' end as split, basket::varchar as player, facet_key, item_idx, qty
    from lines join split using (basket)"""))
def basket_json_roundtrip(spark, folder):
    index, lines, _ = b.stored(spark, folder)
    split = b.split(spark, folder, index).select(
        "basket", "facets", "date", F.lit("https://example.org/").alias("url"), F.lit("orders").alias("event_name"),
        F.lit(None).cast("int").alias("placement"), F.col("basket").cast("string").alias("player"), "heldout")
    label = split.select(F.col("player"), F.when(F.col("heldout"), "heldout").otherwise("train").alias("split"))
    rows = R.basket_rows(lines, split).join(label, "player")
    target = scratch_folder(spark, "splits")
    R.write_splits(rows, target)
    back = R.read_baskets(spark, target, labelled=True)
    return back.select("split", "player", facet_key(F.col("inks")).alias("facet_key"), F.explode("cards").alias("c")).select(
        "split", "player", "facet_key", F.col("c")[0].alias("item_idx"), F.col("c")[1].alias("qty"))


@query("event_violations", """
    with docs as (select c_custkey as k, c_mktsegment as segment from customer),
    events as (select c_custkey as k, o_orderkey as o, row_number() over (partition by c_custkey order by o_orderkey) - 1 as i
      from customer join orders on o_custkey = c_custkey),
    cards as (select k, o, i, l_partkey, l_quantity, row_number() over (partition by o order by l_linenumber,
        case when l_partkey % 50 = 0 then '' else l_partkey::varchar end, case when l_quantity >= 45 then 0 else l_quantity::int end) - 1 as n
      from events join lineitem on l_orderkey = o),
    found as (
      select k, '' as path, unnest([case when k % 7 = 0 then 'datasetVersion is a version' end, case when k % 11 = 0 then 'schemaVersion is filled' end,
        case when segment = 'BUILDING' then 'some sources' end, case when k % 17 = 0 then 'generatedAt is present' end]) as rule from docs
      union all select k, 'tournaments[' || i || ']', unnest([case when o % 5 = 0 then 'sourceUrl is an address' end,
        case when o % 13 = 0 then 'date is a day' end]) from events
      union all select k, 'tournaments[' || i || '].decks[0]', unnest([case when o % 4 = 0 then 'placement is positive' end,
        case when o % 6 = 0 then 'one or two inks' end, case when o % 6 = 0 then 'inks are known' end,
        case when o not in (select l_orderkey from lineitem) then 'some cards' end]) from events
      union all select k, 'tournaments[' || i || '].decks[0].deck.cards[' || n || ']', unnest([
        case when l_partkey % 50 = 0 then 'cardId is filled' end, case when l_quantity >= 45 then 'count is positive' end]) from cards)
    select 'c' || k as document, path, rule from found where rule is not null""")
def event_violations(spark, folder):
    """A document per customer, written and read as JSON, with faults at every level derived from its keys."""
    from .. import schemas

    order, customer = F.col("o_orderkey"), F.col("c_custkey")
    cards = b.table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct(
        "l_linenumber", F.when(F.col("l_partkey") % 50 == 0, "").otherwise(F.col("l_partkey").cast("string")).alias("cardId"),
        F.when(F.col("l_quantity") >= 45, 0).otherwise(F.col("l_quantity").cast("int")).alias("count")))).alias("listed"))
    lines = F.transform(F.coalesce("listed", F.array().cast(cards.schema["listed"].dataType)), lambda c: F.struct(c["cardId"].alias("cardId"), c["count"].alias("count")))
    inks = F.when(order % 6 == 0, F.array(F.lit("Amber"), F.lit("Ruby"), F.lit("Teal"))).otherwise(F.array(F.lit("Steel")))
    entry = F.struct(F.when(order % 4 == 0, 0).otherwise(1).alias("placement"), F.struct(inks.alias("inks"), lines.alias("cards")).alias("deck"))
    event = F.struct(
        order, F.when(order % 5 == 0, "nowhere").otherwise("https://example.org/").alias("sourceUrl"), F.lit("orders").alias("sourceName"),
        F.lit("order").alias("name"), F.when(order % 13 == 0, "1996-1-1").otherwise("1996-01-01").alias("date"), F.array(entry).alias("decks"))
    events = b.table(spark, folder, "orders").join(cards, "o_orderkey", "left").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.array_sort(F.collect_list(event)).alias("events"))
    held = F.transform(F.coalesce("events", F.array().cast(events.schema["events"].dataType)), lambda e: e.dropFields("o_orderkey"))
    docs = b.table(spark, folder, "customer").join(events, "c_custkey", "left").select(
        F.when(customer % 7 == 0, "v1").otherwise("1.0.0").alias("datasetVersion"), F.when(customer % 11 == 0, "").otherwise("1").alias("schemaVersion"),
        F.concat(F.lit("c"), customer).alias("cardSetVersion"), F.lit("tag").alias("cardsReleaseTag"),
        F.when(customer % 17 != 0, "2026-01-01T00:00:00Z").alias("generatedAt"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.array().cast("array<string>")).otherwise(F.array(F.lit("orders"))).alias("sources"),
        held.alias("tournaments"))
    target = scratch_folder(spark, "faulty-events")
    docs.write.json(target)
    read = spark.read.schema(schemas.EVENTS).json(target)
    return R.event_violations(read.withColumnRenamed("cardSetVersion", "document").withColumn("cardSetVersion", F.col("document")), ["document"])


@query("catalogue_violations", """
    with listed as (select p_brand, p_size, p_retailprice, row_number() over (partition by p_brand order by p_partkey) - 1 as i from part),
    found as (
      select p_brand, '' as path, unnest([case when p_brand = 'Brand#9' then 'cardSetVersion is filled' end,
        case when p_brand in ('Brand#9', 'Brand#10') then 'fetchedAt is present' end]) as rule from (select distinct p_brand from part)
      union all select p_brand, 'cards[' || i || ']', unnest([case when p_size > 20 then 'cost is in range' end,
        case when p_size % 7 = 0 then 'some type' end]) from listed)
    select p_brand as document, path, rule from found where rule is not null""")
def catalogue_violations(spark, folder):
    """A catalogue document per brand, with faults in its head and its variants."""
    kinds = F.when(F.col("p_size") % 7 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("Item")))
    null = lambda kind: F.lit(None).cast(kind)
    card = F.struct(
        F.col("p_partkey"), F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("version"),
        F.lit("1").alias("setCode"), null("string").alias("setName"), F.col("p_partkey").cast("int").alias("cardNumber"),
        null("string").alias("collectorNumber"), F.col("p_size").alias("cost"), F.lit(True).alias("inkwell"), F.array(F.lit("Amber")).alias("inks"),
        kinds.alias("types"), F.split("p_name", " ").alias("classifications"), F.array().cast("array<string>").alias("keywords"), F.lit("").alias("text"),
        null("string").alias("flavor"), F.lit("https://example.org/x").alias("imageUrl"), null("string").alias("rarity"),
        F.array().cast("array<string>").alias("illustrators"), null("string").alias("releasedAt"), null("int").alias("tcgplayerId"),
        F.lit("legal").alias("legality"), *[null("int").alias(c) for c in ("lore", "strength", "willpower", "moveCost")])
    docs = b.table(spark, folder, "part").groupBy(F.col("p_brand").alias("document")).agg(F.array_sort(F.collect_list(card)).alias("listed"))
    return R.catalogue_violations(docs.select(
        "document", F.when(F.col("document") == "Brand#9", "").otherwise("1").alias("cardSetVersion"),
        F.when(~F.col("document").isin("Brand#9", "Brand#10"), F.current_timestamp()).alias("fetchedAt"),
        F.transform("listed", lambda c: c.dropFields("p_partkey")).alias("cards")), ["document"])


@query("constraint_violations", """
    select p_partkey as id, rule from (
      select p_partkey, unnest([case when p_size > 20 then 'cost is in range' end,
        case when p_type not in ('SMALL', 'MEDIUM', 'LARGE') then 'types are known' end,
        case when p_name like 'red%' then 'version is null or filled' end,
        case when p_brand = 'Brand#5' then 'imageUrl is an address' end,
        case when p_brand = 'Brand#6' then 'one or two inks' end,
        case when p_brand = 'Brand#6' then 'inks are known' end,
        case when p_brand = 'Brand#7' then 'legality is known' end,
        case when p_brand = 'Brand#8' then 'tcgplayerId is positive' end]) as rule from part) where rule is not null""")
def constraint_violations(spark, folder):
    """Parts as catalogue variants, with faults derived from their brand, name, size and type."""
    from .. import schemas

    kinds = {"SMALL": "Character", "MEDIUM": "Action", "LARGE": "Item"}
    kind = F.col("p_type")
    for old, new in kinds.items():
        kind = F.when(F.col("p_type") == old, new).otherwise(kind)
    brand = F.col("p_brand")
    rows = b.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"),
        F.when(F.startswith("p_name", F.lit("red")), "").otherwise(F.col("p_type")).alias("version"),
        brand.alias("setCode"), F.lit(None).cast("string").alias("setName"), F.col("p_partkey").cast("int").alias("cardNumber"),
        F.lit(None).cast("string").alias("collectorNumber"), F.col("p_size").alias("cost"), F.lit(True).alias("inkwell"),
        F.when(brand == "Brand#6", F.array(F.lit("Amber"), F.lit("Ruby"), F.lit("Teal"))).otherwise(F.array(F.lit("Amber"))).alias("inks"),
        F.array(kind).alias("types"), F.split("p_name", " ").alias("classifications"), F.array().cast("array<string>").alias("keywords"),
        F.lit("").alias("text"), F.lit(None).cast("string").alias("flavor"),
        F.when(brand == "Brand#5", "nowhere").otherwise("https://example.org/a.png").alias("imageUrl"),
        F.lit(None).cast("string").alias("rarity"), F.when(brand == "Brand#7", "unclear").otherwise("legal").alias("legality"),
        F.when(brand == "Brand#8", 0).otherwise(5).alias("tcgplayerId"),
        *[F.lit(None).cast("int").alias(c) for c in ("lore", "strength", "willpower", "moveCost")])
    return R.violations(rows, schemas.variant_rules(), ["id"]).select(F.col("id").cast("long").alias("id"), "rule")


@query("frequency_documents", with_ctes("lines played", """
    select facet_key, item_idx, floor(qty / total * 1e6) / 1e6 as p from freq where qty > 0""", _FREQUENCY))
def frequency_documents(spark, folder):
    """One JSON object per key, read back into rows."""
    docs = A.frequency_documents(FR.play_frequency(keyed_lines(spark, folder)))
    return docs.select("facet_key", F.explode(F.from_json("json", "map<string,double>")).alias("item", "p")).select(
        "facet_key", F.col("item").cast("long").alias("item_idx"), "p")


@query("embedding_shape", """
    select count(*) as rows, min(len(embedding)) as narrowest, max(len(embedding)) as widest from embeddings""")
def embedding_shape(spark, folder):
    """The embedding source read and checked: one vector per item plus padding, one width."""
    vectors = A.read_embeddings(spark, f"{folder}/embeddings.parquet", ("embedding",), "vec_id")
    n = vectors.count()
    width = A.require_shape(vectors, n - 1)
    return spark.createDataFrame([(n, width, width)], "rows long, narrowest int, widest int")


@query("vocabulary_sink", with_ctes("item_map", "select id, item_idx, 'v1' as catalogue_version, name, version from item_map join items using (item_idx)"))
def vocabulary_sink(spark, folder):
    """The vocabulary written and read back: variants with the item they stand for."""
    from ..operators import catalog as C
    from .catalogue import SIGNATURE

    index = b.items(spark, folder)
    target = scratch_folder(spark, "vocabulary")
    A.write_vocabulary(index, b.item_map(spark, folder, index), C.dedup_report(b.variants(spark, folder), C.signature(SIGNATURE)), target, "v1")
    items = spark.read.json(f"{target}/vocabulary").select("item_idx", "name", "version")
    return spark.read.json(f"{target}/variants").join(items, "item_idx").select("id", "item_idx", "catalogue_version", "name", "version")


def _sunk(spark, folder, dtype):
    """Vectors written as bytes, read back and unpacked to one row per number."""
    vectors = b.table(spark, folder, "embeddings").select(F.col("vec_id").alias("item_idx"), F.col("embedding").alias("vec"))
    target = scratch_folder(spark, "vectors")
    A.packed_vectors(vectors, dtype).write.parquet(target)
    back = A.unpacked_vectors(spark.read.parquet(target), dtype)
    return back.select("item_idx", F.posexplode("vec").alias("position", "value"))


_NUMBERS = """select vec_id as item_idx, (generate_subscripts(embedding, 1) - 1)::int as position,
    unnest(embedding)::float::double as x from embeddings"""


@query("fp32_sink", f"select item_idx, position, x as value from ({_NUMBERS})")
def fp32_sink(spark, folder):
    return _sunk(spark, folder, "float32")


# A half has 11 significant bits and no exponent below -14; values round to even.
@query("fp16_sink", f"""
    select item_idx, position, case when x = 0 then 0 else round_even(x / step, 0) * step end as value from (
      select *, pow(2.0, greatest(floor(log2(abs(x))), -14) - 10) as step from ({_NUMBERS}))""")
def fp16_sink(spark, folder):
    return _sunk(spark, folder, "float16")


_BRAND_FILES = """files as (select p_brand as name, string_agg(p_name, chr(10) order by p_partkey) || chr(10) as content
      from part group by p_brand),
    sums as (select name, sha256(content) as sha256, strlen(content)::bigint as size from files)"""


@query("checksum_audit", with_ctes("", """
    select name, case when name = 'Brand#7' then null else size end as size,
      case when name = 'Brand#7' then null else sha256 end as sha256,
      case name when 'Brand#5' then 'mismatch' when 'Brand#7' then 'missing' when 'Brand#9' then 'unlisted' else 'ok' end as status
    from sums""", _BRAND_FILES))
def checksum_audit(spark, folder):
    """A file of part names per brand, audited against a manifest made from the table.

    The manifest has a wrong sum for brand 5 and lacks brand 9; the file of brand 7 is not written.
    """
    names = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))), lambda x: x["p_name"])
    texts = b.table(spark, folder, "part").groupBy(F.col("p_brand").alias("name")).agg(F.array_join(names, "\n").alias("text"))
    target = scratch_folder(spark, "brands")
    texts.filter("name <> 'Brand#7'").withColumn("file", F.translate("name", "#", "-")).select("file", "text").write.partitionBy("file").text(target)
    found = A.file_checksums(spark, target, root=target.rsplit("/", 1)[1])
    folder_name = F.regexp_extract("name", "file=([^/]*)/[^/]*[.]txt$", 1)
    found = found.withColumn("name", F.translate(folder_name, "-", "#")).filter("name <> ''")
    content = F.concat("text", F.lit("\n")).cast("binary")
    manifest = texts.filter("name <> 'Brand#9'").select("name", F.when(F.col("name") == "Brand#5", F.lit("0")).otherwise(
        F.sha2(content, 256)).alias("sha256"), F.length(content).cast("long").alias("size"))
    return A.audit(manifest, found).join(found, "name", "left").select("name", "size", "sha256", "status")
