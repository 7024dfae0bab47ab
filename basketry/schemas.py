"""Input document schemas and their constraints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the input formats, and the structures of the documents below.
INKS = ("Amber", "Amethyst", "Emerald", "Ruby", "Sapphire", "Steel")
TYPES = ("Character", "Action", "Song", "Item", "Location")
RARITIES = ("Common", "Uncommon", "Rare", "Super Rare", "Legendary", "Enchanted", "Special", "Promo")
LEGALITIES = ("legal", "not_legal", "banned")
MAX_COST = 20

_S, _I, _B = T.StringType(), T.IntegerType(), T.BooleanType()
_A = T.ArrayType(_S)


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


VARIANT = _struct(
    id=_S, name=_S, version=_S, setCode=_S, setName=_S, cardNumber=_I, collectorNumber=_S, cost=_I,
    inkwell=_B, inks=_A, types=_A, classifications=_A, keywords=_A, text=_S, flavor=_S, imageUrl=_S,
    rarity=_S, illustrators=_A, releasedAt=_S, tcgplayerId=_I, legality=_S, lore=_I, strength=_I,
    willpower=_I, moveCost=_I)

CATALOGUE = _struct(cardSetVersion=_S, fetchedAt=T.TimestampType(), cards=T.ArrayType(VARIANT))

DECK = _struct(
    inks=_A, cards=T.ArrayType(_struct(cardId=_S, count=_I)), name=_S, source=_S, externalKey=_S, externalUrl=_S)
TOURNAMENT = _struct(
    sourceUrl=_S, sourceName=_S, externalKey=_S, name=_S, date=_S,
    decks=T.ArrayType(_struct(placement=_I, player=_S, deck=DECK)))
EVENTS = _struct(
    datasetVersion=_S, schemaVersion=_S, cardSetVersion=_S, cardsReleaseTag=_S, generatedAt=T.TimestampType(),
    sources=_A, tournaments=T.ArrayType(TOURNAMENT))

BASKET_LINE = T.StructType([
    T.StructField("cards", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("inks", _A),
    T.StructField("tournament", _struct(url=_S, name=_S, date=_S)),
    T.StructField("placement", _I), T.StructField("player", _S)])


#: Gives the column of a field: of a flat row, or of a struct inside a document.
At = Callable[[str], Column]


def _filled(value: Column) -> Column:
    return F.coalesce(F.length(value) > 0, F.lit(False))


def _optional_filled(value: Column) -> Column:
    return value.isNull() | (F.length(value) > 0)


def _at_least(value: Column, low: int, optional: bool = False) -> Column:
    return F.coalesce(value >= low, F.lit(optional))


def _all_in(value: Column, allowed: tuple[str, ...]) -> Column:
    return F.coalesce(F.size(F.array_except(value, F.array(*[F.lit(a) for a in allowed]))) == 0, F.lit(False))


def _sized(value: Column, low: int, high: int | None = None) -> Column:
    n = F.coalesce(F.size(value), F.lit(-1))
    return (n >= low) & (F.lit(True) if high is None else (n <= high))


def _url(value: Column) -> Column:
    return F.coalesce(value.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://\S+$"), F.lit(False))


def variant_rules(at: At = F.col) -> dict[str, Column]:
    """Rule name -> predicate that a valid variant satisfies."""
    rules = {f"{c} is filled": _filled(at(c)) for c in ("id", "name", "setCode")}
    rules |= {f"{c} is null or filled": _optional_filled(at(c)) for c in ("version", "setName", "collectorNumber")}
    rules |= {f"{c} is present": at(c).isNotNull() for c in ("inkwell", "classifications", "keywords", "text")}
    rules |= {f"{c} is not negative": _at_least(at(c), 0, True) for c in ("lore", "strength", "willpower", "moveCost")}
    rules |= {
        "cardNumber is not negative": _at_least(at("cardNumber"), 0),
        "cost is in range": F.coalesce(at("cost").between(0, MAX_COST), F.lit(False)),
        "one or two inks": _sized(at("inks"), 1, 2),
        "inks are known": _all_in(at("inks"), INKS),
        "some type": _sized(at("types"), 1),
        "types are known": _all_in(at("types"), TYPES),
        "imageUrl is an address": _url(at("imageUrl")),
        "rarity is known": at("rarity").isNull() | at("rarity").isin(*RARITIES),
        "tcgplayerId is positive": _at_least(at("tcgplayerId"), 1, True),
        "legality is known": F.coalesce(at("legality").isin(*LEGALITIES), F.lit(False)),
    }
    return rules


def catalogue_rules(at: At = F.col) -> dict[str, Column]:
    """Rules of the head of a catalogue document."""
    return {"cardSetVersion is filled": _filled(at("cardSetVersion")), "fetchedAt is present": at("fetchedAt").isNotNull(),
            "cards are present": at("cards").isNotNull()}


def event_rules(at: At = F.col) -> dict[str, Column]:
    """Rules of one tournament row."""
    return {
        "sourceUrl is an address": _url(at("sourceUrl")), "sourceName is filled": _filled(at("sourceName")),
        "externalKey is null or filled": _optional_filled(at("externalKey")), "name is filled": _filled(at("name")),
        "date is a day": F.coalesce(at("date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False)),
        "some decks": _sized(at("decks"), 1)}


def line_rules(at: At = F.col) -> dict[str, Column]:
    """Rules of one line of a deck."""
    return {"cardId is filled": _filled(at("cardId")), "count is positive": _at_least(at("count"), 1)}


def deck_rules(at: At = F.col) -> dict[str, Column]:
    """Rules of one deck row (fields of the deck and its placement), but those of its lines."""
    return {
        "placement is positive": _at_least(at("placement"), 1, True),
        "one or two inks": _sized(at("inks"), 1, 2), "inks are known": _all_in(at("inks"), INKS),
        "some cards": _sized(at("cards"), 1),
        "externalKey is null or filled": _optional_filled(at("externalKey")),
        "externalUrl is null or an address": at("externalUrl").isNull() | _url(at("externalUrl"))}


def dataset_rules(at: At = F.col) -> dict[str, Column]:
    """Rules of the document head."""
    rules = {f"{c} is filled": _filled(at(c)) for c in ("schemaVersion", "cardSetVersion", "cardsReleaseTag")}
    rules["datasetVersion is a version"] = F.coalesce(at("datasetVersion").rlike(r"^\d+\.\d+\.\d+$"), F.lit(False))
    rules["generatedAt is present"] = at("generatedAt").isNotNull()
    rules["some sources"] = _sized(at("sources"), 1) & ~F.coalesce(F.exists(at("sources"), lambda s: F.coalesce(F.length(s), F.lit(0)) == 0), F.lit(False))
    rules["tournaments are present"] = at("tournaments").isNotNull()
    return rules
