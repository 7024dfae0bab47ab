"""Catalogue, event and basket documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.facets import lowered, parse_day


def read_catalogue(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """Variants of catalogue documents with the version columns of their document.

    A document is one JSON value and cannot be split; many documents are read in parallel.
    """
    docs = spark.read.schema(schemas.CATALOGUE).json(path, multiLine=True, mode=mode)
    return docs.select("cardSetVersion", "fetchedAt", F.inline("cards"))


def to_engine_names(variants: DataFrame) -> DataFrame:
    """Column names the operators use by default."""
    return variants.withColumnsRenamed(
        {"setCode": "set_code", "cardNumber": "number", "classifications": "classes", "inks": "facets", "inkwell": "flag"})


def read_events(spark: SparkSession, path: str, mode: str = "FAILFAST", multiline: bool = True) -> DataFrame:
    """One row per basket: ``basket`` = (version, file, digest of the document, event and deck position).

    Versions may repeat between documents, so the file and what the document says are part of
    the id; one file must not repeat a whole document.
    """
    docs = spark.read.schema(schemas.EVENTS).json(path, multiLine=multiline, mode=mode)
    mark = F.concat_ws(":", F.regexp_extract(F.input_file_name(), "[^/]*$", 0), F.substring(F.md5(F.to_json(F.struct("*"))), 1, 12))
    events = docs.withColumn("_mark", mark).select("datasetVersion", "_mark", F.posexplode("tournaments").alias("event_pos", "t"))
    decks = events.select(
        "datasetVersion", "_mark", "event_pos", "t.sourceUrl", F.col("t.name").alias("event_name"),
        parse_day(F.col("t.date")).alias("date"), F.posexplode("t.decks").alias("deck_pos", "d"))
    return decks.select(
        F.concat_ws(":", "datasetVersion", "_mark", "event_pos", "deck_pos").alias("basket"), "date",
        F.col("sourceUrl").alias("url"), "event_name", "d.placement", "d.player",
        F.col("d.deck.inks").alias("facets"), F.col("d.deck.cards").alias("cards"))


def event_lines(baskets: DataFrame) -> DataFrame:
    return baskets.select("basket", F.posexplode("cards").alias("line_no", "c")).select(
        "basket", "line_no", F.col("c.cardId").alias("variant"), F.col("c.count").alias("qty"))


def violations(rows: DataFrame, rules: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    """``(keys, rule)`` per broken rule; a predicate that is null counts as broken."""
    broken = F.array(*[F.when(F.coalesce(ok, F.lit(False)), None).otherwise(F.lit(name)) for name, ok in rules.items()])
    return rows.select(*keys, F.explode(F.filter(broken, lambda r: r.isNotNull())).alias("rule"))


def _broken(rules: dict[str, Column], path: Column) -> Column:
    """Array of ``(path, rule)`` of the broken rules; a predicate that is null counts as broken."""
    found = F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.struct(path.alias("path"), F.lit(name).alias("rule"))) for name, ok in rules.items()])
    return F.filter(found, lambda r: r.isNotNull())


def _below(list_: Column, kind: Column, found) -> Column:
    """The findings of all elements of a list; a null list has none."""
    return F.flatten(F.transform(F.coalesce(list_, F.array().cast(kind)), found))


def event_violations(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, path, rule)`` of event documents: head, tournaments, decks and lines in one pass over nested rows.

    A path is that of the document: empty for the head, else like ``tournaments[2].decks[0].deck.cards[5]``.
    """
    events, decks = schemas.EVENTS["tournaments"].dataType, schemas.TOURNAMENT["decks"].dataType
    lines = schemas.DECK["cards"].dataType

    def step(path: Column, name: str, i: Column) -> Column:
        return F.concat(path, F.lit(f"{name}["), i.cast("string"), F.lit("]"))

    def of_deck(path):
        def found(entry, j):
            deck = lambda n: entry[n] if n in ("placement", "player") else entry["deck"][n]
            here = step(path, ".decks", j)
            return F.concat(_broken(schemas.deck_rules(deck), here), _below(entry["deck"]["cards"], lines, lambda card, k: _broken(
                schemas.line_rules(lambda n: card[n]), step(here, ".deck.cards", k))))
        return found

    def of_event(event, i):
        here = step(F.lit(""), "tournaments", i)
        return F.concat(_broken(schemas.event_rules(lambda n: event[n]), here), _below(event["decks"], decks, of_deck(here)))

    found = F.concat(_broken(schemas.dataset_rules(), F.lit("")), _below(F.col("tournaments"), events, of_event))
    return docs.select(*keys, F.explode(found).alias("v")).select(*keys, "v.path", "v.rule")


def catalogue_violations(docs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, path, rule)`` of catalogue documents: head and variants (``cards[3]``)."""

    def of_card(card, i):
        return _broken(schemas.variant_rules(lambda n: card[n]), F.concat(F.lit("cards["), i.cast("string"), F.lit("]")))

    found = F.concat(_broken(schemas.catalogue_rules(), F.lit("")), _below(F.col("cards"), schemas.CATALOGUE["cards"].dataType, of_card))
    return docs.select(*keys, F.explode(found).alias("v")).select(*keys, "v.path", "v.rule")


def require_valid(found: DataFrame, sample: int = 20) -> None:
    """Reject the input as a whole when any rule is broken."""
    rows = found.limit(sample).collect()
    if rows:
        raise ValueError(f"input breaks its schema, e.g. {[tuple(r) for r in rows]}")


def unknown_fields(spark: SparkSession, path: str, declared: T.StructType, multiline: bool = True) -> list[str]:
    """Paths of fields in the files that the schema does not declare."""

    def walk(found: T.DataType, known: T.DataType, at: str) -> list[str]:
        if isinstance(found, T.ArrayType) and isinstance(known, T.ArrayType):
            return walk(found.elementType, known.elementType, at)
        if not (isinstance(found, T.StructType) and isinstance(known, T.StructType)):
            return []
        out: list[str] = []
        for field in found.fields:
            path_here = f"{at}.{field.name}" if at else field.name
            if field.name not in known.fieldNames():
                out.append(path_here)
            else:
                out += walk(field.dataType, known[field.name].dataType, path_here)
        return out

    return walk(spark.read.json(path, multiLine=multiline).schema, declared, "")


def read_baskets(spark: SparkSession, path: str, labelled: bool = False) -> DataFrame:
    """Split rows; rows without cards or inks are dropped, inks lower-cased, cards in item order.

    A line that does not parse or has a value of the wrong type fails the read.

    ``labelled`` reads the folder of all splits and adds their label as ``split``.
    """
    schema = T.StructType(list(schemas.BASKET_LINE.fields))
    if labelled:
        schema = schema.add("split", T.StringType())
    rows = spark.read.schema(schema).json(path, mode="FAILFAST")
    kept = rows.filter((F.coalesce(F.size("cards"), F.lit(0)) > 0) & (F.coalesce(F.size("inks"), F.lit(0)) > 0))
    return kept.withColumn("inks", lowered(F.col("inks"))).withColumn("cards", F.array_sort("cards"))


def basket_rows(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Rows of the split format from collapsed lines and headers
    (basket, facets, date, url, event_name, placement, player)."""
    pairs = F.array_sort(F.collect_list(F.array(F.col("item_idx").cast("long"), F.col("qty").cast("long"))))
    packed = lines.groupBy("basket").agg(pairs.alias("cards"))
    event = F.struct(F.col("url"), F.col("event_name").alias("name"), F.date_format("date", "yyyy-MM-dd").alias("date"))
    return packed.join(headers, "basket").select(
        "cards", F.col("facets").alias("inks"), event.alias("tournament"), "placement", "player")


def write_splits(rows: DataFrame, folder: str, as_json: bool = True) -> None:
    """One folder per split label (column ``split``); nulls stay visible in JSON."""
    writer = rows.write.mode("errorifexists").partitionBy("split")
    if as_json:
        writer.option("ignoreNullFields", "false").json(folder)
    else:
        writer.parquet(folder)
