import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from basketry.functions import facets, text
from basketry.functions.hashing import hash_split, u32
from basketry.functions.vectors import l2_normalise, truncate_decimals


def column(spark, values, kind, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in rows.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_reminders_quotes_and_space(spark):
    raw = [
        "Shift 3 (You may pay 3 {I} to play this on top of one of your characters named Elsa.)",
        "Rush (This character can challenge the turn they're played.)",
        "Resist +1 (Damage dealt to them is reduced by 1.)",
        "Evasive (Only x.) Ward (Opponents y.)",
        "Your characters gain Rush (They can challenge.) this turn.",
        "", "No parens here.",
    ]
    want = ["Shift 3", "Rush", "Resist +1", "Evasive Ward", "Your characters gain Rush this turn.", "", "No parens here."]
    assert column(spark, raw, "string", text.strip_reminder) == want
    assert column(spark, ["‘hi’", "“ok”", "teammates’"], "string", text.normalise_quotes) == ["'hi'", '"ok"', "teammates'"]
    assert column(spark, ["a   b\t\tc", "  hi  ", "a \x1cb"], "string", text.normalise_whitespace) == ["a b c", "hi", "a b"]
    mixed = "Shift 3 (You may pay 3 {I}.) ‘Rush’  means  the character can challenge."
    once = column(spark, [mixed], "string", text.normalise_text)
    assert once == ["Shift 3 'Rush' means the character can challenge."]
    assert column(spark, once, "string", text.normalise_text) == once


def test_has_text(spark):
    assert column(spark, ["a", "", " ", "(only a reminder)", None], "string", text.has_text)[:4] == [True, False, False, False]


def test_max_copies(spark):
    raw = [None, "", "You may have any number of cards named Dalmatian Puppy in your deck.",
           "You may have up to 6 copies of this card in your deck.", "YOU MAY ONLY have 1 copy of this card in your deck.",
           "You may only have 2 copies of it. You may have up to 7 copies of it."]
    assert column(spark, raw, "string", text.max_copies) == [4, 4, math.inf, 6, 1, 7]


def test_facets(spark):
    order = ["amber", "amethyst", "emerald", "ruby", "sapphire", "steel"]
    values = [["amber", "ruby"], ["AMBER", "Ruby"], ["amber", "teal"], ["Ruby", "Amber"], ["amber"]]
    assert column(spark, values, "array<string>", facets.facet_key) == ["amber|ruby", "amber|ruby", "amber|teal", "amber|ruby", "amber"]
    hot = column(spark, values, "array<string>", lambda c: facets.facet_multihot(c, order))
    assert hot[0] == hot[1] == [1, 0, 0, 1, 0, 0] and sum(hot[2]) == 1
    assert column(spark, values, "array<string>", lambda c: facets.facet_mask(c, order)) == [9, 9, 1, 9, 1]
    assert column(spark, [9, 1, 0], "int", lambda c: facets.mask_to_key(c, order)) == ["amber|ruby", "amber", ""]


def test_months_and_days(spark):
    days = [dt.date(2026, 5, 13), dt.date(2024, 3, 31), dt.date(2025, 3, 31)]
    assert column(spark, days, "date", lambda c: facets.month_back(c, 12))[0] == dt.date(2025, 5, 13)
    assert column(spark, days, "date", lambda c: facets.month_back(c, 1))[1:] == [dt.date(2024, 2, 29), dt.date(2025, 2, 28)]
    assert column(spark, ["2025-03-15", "nope"], "string", facets.parse_day) == [dt.date(2025, 3, 15), None]


def test_buckets_and_decimals(spark):
    assert column(spark, [-1, 0, 11, 15], "int", facets.bucket_clip) == [0, 0, 11, 11]
    assert column(spark, [0.12345678, 1 / 3], "double", truncate_decimals) == [0.123456, 0.333333]


def test_unit_length(spark):
    out = column(spark, [[3.0, 4.0], [0.0, 0.0]], "array<double>", l2_normalise)
    assert out == [[0.6, 0.8], [0.0, 0.0]]


def test_hash_matches_sha1_prefix(spark):
    ident = "Elsa|Snow Queen"
    got = column(spark, [ident], "string", lambda c: u32("pretrain-encoder", c))
    want = int.from_bytes(hashlib.sha1(f"pretrain-encoder:{ident}".encode()).digest()[:4], "big")
    assert got == [want] == [4064043730]


def test_hash_split_is_stable_per_seed(spark):
    names = [f"c{i}" for i in range(40)]
    a = column(spark, names, "string", lambda c: hash_split(1, c, 0.4))
    assert a == column(spark, names, "string", lambda c: hash_split(1, c, 0.4))
    assert a != column(spark, names, "string", lambda c: hash_split(2, c, 0.4))
    with pytest.raises(ValueError):
        hash_split(1, F.lit("x"), 1.5)
