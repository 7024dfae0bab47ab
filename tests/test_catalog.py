import pytest
from pyspark.sql import functions as F

from basketry.operators import catalog as C
from basketry.operators import layout as L
from basketry.operators.ranking import rank_by_dense_id, rank_by_hash, rank_by_range, running_by_range

SCHEMA = "id string, name string, version string, set_code string, number int, cost int, text string"


def pool(spark, rows):
    return spark.createDataFrame([(*r, 3, "") for r in rows], SCHEMA)


def test_collapse_and_canonical(spark):
    rows = pool(spark, [
        ("crd_a", "Mickey", "True Friend", "1", 12), ("crd_b", "Mickey", "True Friend", "P3", 10),
        ("crd_c", "Mickey", "True Friend", "10", 500), ("crd_d", "Mickey", "Brave Little Tailor", "1", 115)])
    items = {r["item_id"]: r for r in C.collapse_items(rows, ["set_code"]).collect()}
    assert len(items) == 2 and items["Mickey|True Friend"]["canonical_id"] == "crd_c"
    report = C.dedup_report(rows, C.signature(["cost"])).first()
    assert (report["variants"], report["items"], report["multi_groups"], report["drift_groups"]) == (4, 2, 1, 0)
    order = [r["id"] for r in C.variant_positions(rows).filter("version = 'True Friend'").orderBy("position").collect()]
    assert order == ["crd_c", "crd_a", "crd_b"]


def test_lettered_sets_rank_last(spark):
    elsa = pool(spark, [(f"e{s}", "Elsa", "Snow Queen", s, 42) for s in ("P1", "1", "5", "10")])
    assert C.collapse_items(elsa, ["set_code"]).first()["set_code"] == "10"
    promo = pool(spark, [("a", "Only", "Card", "P1", 1), ("b", "Only", "Card", "P3", 1)])
    assert C.collapse_items(promo, ["set_code"]).first()["set_code"] == "P3"


def test_null_version_is_empty(spark):
    fire = pool(spark, [("a", "Dragon Fire", None, "1", 1), ("b", "Dragon Fire", None, "P1", 1)])
    assert [r["item_id"] for r in C.collapse_items(fire, []).collect()] == ["Dragon Fire|"]


def test_drift_samples(spark):
    rows = spark.createDataFrame([
        ("a", "Ursula", "Deceiver", "3", 1, 3, "this character"), ("b", "Ursula", "Deceiver", "D23", 1, 3, "this card"),
        ("c", "Elsa", "Queen", "1", 1, 3, "Same  TEXT"), ("d", "Elsa", "Queen", "2", 1, 3, "same text")], SCHEMA)
    sign = C.signature(["cost"], texts=["text"])
    assert C.dedup_report(rows, sign).first()["drift_groups"] == 1
    assert {r["id"] for r in C.drift_samples(rows, sign).collect()} == {"a", "b"}


def test_index_orders_by_name_then_version(spark):
    rows = pool(spark, [("1", "Mickey", "True Friend", "1", 1), ("2", "Elsa", "Snow Queen", "1", 1),
                        ("3", "Ab", None, "1", 1), ("4", "A", "x", "1", 1)])
    got = C.item_index(C.collapse_items(rows, [])).orderBy("item_idx").collect()
    assert [(r["item_idx"], r["name"]) for r in got] == [(1, "A"), (2, "Ab"), (3, "Elsa"), (4, "Mickey")]


@pytest.mark.parametrize("skew", [1, 400])
def test_ranks_match_a_plain_sort(spark, skew):
    data = [(0 if i < skew else i % 5, (i * 7919) % 1009, i) for i in range(600)]
    df = spark.createDataFrame(data, "g int, v int, id long").withColumn("h", F.pmod(F.col("v") * 2654435761, F.lit(2**32)))
    want = {}
    for name, key in (("v", lambda r: (r[1], r[2])), ("h", lambda r: ((r[1] * 2654435761) % 2**32, r[2]))):
        for g in range(5):
            for n, r in enumerate(sorted((r for r in data if r[0] == g), key=key), 1):
                want[name, r[2]] = n
    by_range = rank_by_range(df, ["g"], [F.col("v"), F.col("id")])
    assert all(r["rank"] == want["v", r["id"]] for r in by_range.collect())
    by_hash = rank_by_hash(df, ["g"], "h", ["id"], bits=6)
    assert all(r["rank"] == want["h", r["id"]] for r in by_hash.collect())
    dense = rank_by_dense_id(df, ["g"], "id", bits=3).collect()
    for g in range(5):
        assert [r["rank"] for r in sorted((r for r in dense if r["g"] == g), key=lambda r: r["id"])] == list(
            range(1, sum(1 for r in data if r[0] == g) + 1))


def test_running_total_without_group(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "id long, v long")
    got = {r["id"]: r["s"] for r in running_by_range(df, [], [F.col("id")], {"s": F.col("v")}).collect()}
    assert got == {i: sum(j % 3 for j in range(i + 1)) for i in range(50)}


INKS = ("Amber", "Amethyst", "Emerald", "Ruby", "Sapphire", "Steel")
TYPES = ("Character", "Action", "Song", "Item", "Location")


def card_pool(spark):
    return spark.createDataFrame([
        (1, 3, ["Amber", "Ruby"], ["Character"], ["Storyborn", "Hero"], ["Rush", "Shift"], 2, 3, True),
        (2, 15, ["Steel"], ["Location"], ["Villain", "Villain"], [], None, 1, False),
    ], "item_idx long, cost int, facets array<string>, types array<string>, classes array<string>, keywords array<string>, lore int, move int, flag boolean")


def test_feature_layout_and_rows(spark):
    cards = card_pool(spark)
    spec = L.fitted_spec(cards, cost="cost", facets="facets", facet_order=INKS, types="types", type_order=TYPES,
                         lists=["classes", "keywords"], stats=["lore", "move"], flag="flag")
    assert dict(spec.lists) == {"classes": ("Hero", "Storyborn", "Villain"), "keywords": ("Rush", "Shift")}
    blocks = spec.blocks()
    assert [s for _, s, _ in blocks] == [sum(n for _, _, n in blocks[:i]) for i in range(len(blocks))]
    assert sum(n for _, _, n in blocks) == spec.dim
    rows = {r["item_idx"]: r["features"] for r in L.feature_rows(cards, spec).collect()}
    assert not any(rows[0]) and all(len(v) == spec.dim for v in rows.values())
    assert rows[1][3] == 1.0 and sum(rows[1][:12]) == 1.0 and rows[2][11] == 1.0
    assert sum(rows[1][12:18]) == 2 and sum(rows[1][23:28]) == 4 and sum(rows[2][23:28]) == 1
    assert rows[1][-3:] == [1.0, 1.0, 1.0] and rows[2][-3] == 0.0 and rows[2][-1] == 0.0


def test_alignment_report(spark):
    a = spark.range(1, 5).toDF("i")
    b = spark.range(2, 6).toDF("j")
    row = L.align_indexes(a, b, "i", "j").first()
    assert (row["matched"], row["left_only"], row["right_only"], row["repeated"]) == (3, 1, 1, 0)
    with pytest.raises(ValueError):
        L.require_aligned(L.align_indexes(a, b, "i", "j"))
