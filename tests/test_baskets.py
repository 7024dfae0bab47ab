import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.operators import baskets as B
from basketry.operators import frequency as FR
from basketry.operators import splits as S

CARDS = [f"crd_{c}" for c in "abcdefghijklmno"]


def fixture(spark, cards, legality=None, cap=4, facets=("Amber",), strict=False):
    """One basket of (variant, qty) lines over items crd_a.. = 1..15."""
    mapping = spark.createDataFrame([(c, i + 1) for i, c in enumerate(CARDS)] + [("crd_b2", 2)], "id string, item_idx long")
    items = spark.createDataFrame(
        [(i + 1, (legality or {}).get(c, "legal"), cap, ["Amber"]) for i, c in enumerate(CARDS)],
        "item_idx long, legality string, cap int, facets array<string>")
    heads = spark.createDataFrame([(1, list(facets))], "basket long, facets array<string>")
    lines = spark.createDataFrame([(1, i, c, q) for i, (c, q) in enumerate(cards)], "basket long, line_no int, variant string, qty int")
    resolved = B.resolve_lines(lines, mapping)
    rewritten = B.rewrite_baskets(resolved)
    reasons = B.legality_reasons(rewritten, heads, items, strict)
    return heads, B.unknown_lines(resolved), reasons, rewritten


def histogram(heads, unknown, reasons, _):
    return {r["code"]: r["n"] for r in B.reason_histogram(unknown, reasons).collect()}, B.validation_report(heads, unknown, reasons).first()


def test_variants_of_an_item_add_up(spark):
    *_, rewritten = fixture(spark, [("crd_b", 2), ("crd_b2", 3)])
    assert [(r["item_idx"], r["qty"]) for r in rewritten.collect()] == [(2, 5)]


def test_small_basket(spark):
    codes, report = histogram(*fixture(spark, [(c, 4) for c in CARDS[:10]]))
    assert codes == {"deck_size_below_60": 1} and (report["valid"], report["total"], report["drop_rate"]) == (0, 1, 1.0)
    with pytest.raises(ValueError):
        B.require_drop_rate(B.validation_report(*fixture(spark, [(c, 4) for c in CARDS[:10]])[:3]), 0.05)


def test_valid_basket(spark):
    codes, report = histogram(*fixture(spark, [(c, 4) for c in CARDS]))
    assert codes == {} and report["valid"] == 1 and report["drop_rate"] == 0


@pytest.mark.parametrize("legality,strict,want", [
    ("banned", False, {"card_not_legal": 1}), ("not_legal", False, {}), ("not_legal", True, {"card_not_legal": 1})])
def test_legality_field(spark, legality, strict, want):
    codes, _ = histogram(*fixture(spark, [(c, 4) for c in CARDS], {"crd_o": legality}, strict=strict))
    assert codes == want


def test_cap_counts_the_item(spark):
    codes, _ = histogram(*fixture(spark, [("crd_b2", 4)] + [(c, 4) for c in CARDS]))
    assert codes == {"count_exceeds_max_copies": 1}


def test_facet_reason_once_per_item_and_null_cap(spark):
    codes, _ = histogram(*fixture(spark, [(c, 4) for c in CARDS], facets=("Ruby",)))
    assert codes == {"card_ink_not_in_deck_inks": 15}
    codes, _ = histogram(*fixture(spark, [("crd_a", 60)], cap=None))
    assert codes == {}


def test_unknown_variant_hides_other_reasons(spark):
    heads, unknown, reasons, rewritten = fixture(spark, [("nope", 1), ("crd_a", 2), ("nope", 1)])
    assert [r["variant"] for r in unknown.orderBy("line_no").collect()] == ["nope", "nope"] and rewritten.isEmpty()
    codes, report = histogram(heads, unknown, reasons, None)
    assert codes == {"unknown_printing_id": 1} and report["dropped_unknown"] == 1 and report["dropped_illegal"] == 0


def test_empty_report(spark):
    heads, unknown, reasons, _ = fixture(spark, [("crd_a", 60)], cap=None)
    assert B.validation_report(heads.limit(0), unknown, reasons).first()["drop_rate"] == 0.0


def dated(spark, rows):
    return spark.createDataFrame([(i, d, list(f)) for i, (d, f) in enumerate(rows)], "basket long, date date, facets array<string>")


def test_split_report_dates(spark):
    days = [dt.date(2024, 1, 1), dt.date(2025, 6, 1), dt.date(2024, 12, 31)]
    row = S.split_report(S.heldout_split(dated(spark, [(d, ("a",)) for d in days]))).first()
    assert (row["reference_date"], row["cutoff_date"]) == (dt.date(2025, 6, 1), dt.date(2024, 6, 1))
    assert (row["heldout"], row["train"], row["proposal"], row["singletons"]) == (0, 3, 2, 3)


def test_empty_split(spark):
    row = S.split_report(S.heldout_split(dated(spark, [(dt.date(2024, 1, 1), ("a",))]).limit(0))).first()
    assert (row["total"], row["strata"], row["reference_date"]) == (0, 0, None)


def test_strata_and_minimum(spark):
    rows = [(dt.date(2025, m, d + 1), f) for m in (1, 2) for f in (("a", "b"), ("c",)) for d in range(10)]
    for ratio in (0.1, 0.0):
        row = S.split_report(S.heldout_split(dated(spark, rows), ratio)).first()
        assert (row["strata"], row["heldout"], row["train"], row["proposal"]) == (4, 4, 36, 36)


def test_split_depends_on_seed_only(spark):
    rows = dated(spark, [(dt.date(2025, 1, 1 + i % 20), ("a",)) for i in range(40)])

    def held(seed, parts):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            return {r["basket"] for r in S.heldout_split(rows, seed=seed).filter("heldout").collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")

    assert held(7, "4") == held(7, "3") != held(8, "4")
    assert len(held(7, "4")) == 4


def test_frequency_tables(spark):
    lines = spark.createDataFrame([
        ("amber|ruby", 1, 4), ("amber|ruby", 2, 4), ("amber|ruby", 1, 2), ("amber|ruby", 3, 4),
        ("emerald|steel", 4, 4), ("emerald|steel", 5, 4)], "facet_key string, item_idx long, qty long")
    table = FR.play_frequency(lines)
    sums = {r["facet_key"]: r["s"] for r in table.groupBy("facet_key").agg(F.sum("p").alias("s")).collect()}
    assert set(sums) == {"amber|ruby", "emerald|steel", "_all"} and all(abs(s - 1) < 1e-12 for s in sums.values())
    ruby = {r["item_idx"]: r["p"] for r in table.filter("facet_key = 'amber|ruby'").collect()}
    assert ruby == {1: 6 / 14, 2: 4 / 14, 3: 4 / 14}
    assert FR.published(table).filter("facet_key = 'amber|ruby' and item_idx = 1").first()["p"] == 0.428571


def test_basket_without_lines_is_too_small_and_counts(spark):
    from basketry.operators import baskets as B
    from basketry.operators import evaluation as E

    headers = spark.createDataFrame([(1, ["a"]), (2, ["a"])], "basket long, facets array<string>")
    lines = spark.createDataFrame([(1, 7, 60)], "basket long, item_idx int, qty int")
    items = spark.createDataFrame([(7, "legal", None, ["a"])], "item_idx int, legality string, cap double, facets array<string>")
    reasons = B.legality_reasons(lines, headers, items)
    assert [(r.basket, r.item_idx, r.code) for r in reasons.collect()] == [(2, None, B.TOO_SMALL)]
    unknown = lines.limit(0)
    report = B.validation_report(headers, unknown, reasons).first()
    assert (report.total, report.valid, report.drop_rate) == (2, 1, 0.5)
    used = spark.createDataFrame([(1, "A")], "basket long, facet string")
    rate = E.legality_rate(headers, reasons, used).first()
    assert (rate.baskets, rate.legal_rate, rate.exact_rate) == (2, 0.5, 0.5)


def test_null_groups_are_kept(spark):
    from basketry.operators import frequency as FR
    from basketry.operators import metrics as M
    from basketry.operators import splits as S

    rows = [(i, ["a"], None if i % 5 == 0 else "2024-01-15") for i in range(25)]
    baskets = spark.createDataFrame(rows, "basket long, facets array<string>, day string").selectExpr(
        "basket", "facets", "cast(day as date) as date")
    split = S.heldout_split(baskets)
    assert split.count() == 25 and split.filter("month is null").count() == 5
    assert S.with_recent_train(split).filter("proposal is null").count() == 0
    report = S.split_report(split).first()
    assert report.total == 25 and report.train + report.heldout == 25
    scored = spark.createDataFrame([(None, 0.9, 1), (None, 0.1, 0), ("x", 0.5, 1)], "g string, score double, label int")
    auc = {r.g: r.auc for r in M.roc_auc(scored, group=["g"]).collect()}
    assert auc[None] == 1.0 and auc["x"] != auc["x"]
    lines = spark.createDataFrame([(None, 1, 2), ("k", 1, 2)], "facet_key string, item_idx int, qty int")
    assert FR.play_frequency(lines).filter("facet_key is null").count() == 1
