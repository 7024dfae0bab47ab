import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry import schemas
from basketry.operators import frequency as FR
from basketry.sources import artifacts as A
from basketry.sources import readers as R

CARD = {
    "id": "crd_a", "name": "Elsa", "version": None, "setCode": "1", "cardNumber": 1, "cost": 3, "inkwell": True,
    "inks": ["Amber"], "types": ["Character"], "classifications": ["Storyborn"], "keywords": [], "text": "", "flavor": None,
    "imageUrl": "https://example.org/a.png", "legality": "legal", "lore": 2, "strength": 3, "willpower": 3, "moveCost": None}


def write(path, value):
    path.write_text(json.dumps(value, indent=1), encoding="utf8")
    return str(path)


def test_catalogue(spark, tmp_path):
    bad = CARD | {"id": "crd_b", "cost": 21, "inks": [], "legality": "maybe", "version": ""}
    path = write(tmp_path / "cards.json", {"cardSetVersion": "v1", "fetchedAt": "2026-05-13T10:00:00Z", "cards": [CARD, bad]})
    rows = R.read_catalogue(spark, path)
    assert rows.count() == 2 and rows.first()["cardSetVersion"] == "v1"
    found = R.violations(rows, schemas.variant_rules(), ["id"])
    assert {(r["id"], r["rule"]) for r in found.collect()} == {
        ("crd_b", r) for r in ("cost is in range", "one or two inks", "legality is known", "version is null or filled")}
    with pytest.raises(ValueError):
        R.require_valid(found)
    assert R.unknown_fields(spark, path, schemas.CATALOGUE) == []
    more = write(tmp_path / "more.json", {"cardSetVersion": "v1", "cards": [CARD | {"mana": 1}], "extra": 1})
    assert sorted(R.unknown_fields(spark, more, schemas.CATALOGUE)) == ["cards.mana", "extra"]


def test_events(spark, tmp_path):
    deck = {"inks": ["Amber", "Ruby"], "cards": [{"cardId": "crd_a", "count": 4}, {"cardId": "crd_b", "count": 2}], "name": None, "source": None}
    event = {"sourceUrl": "https://example.org/t", "sourceName": "s", "name": "Cup", "date": "2025-03-01",
             "decks": [{"placement": 1, "player": None, "deck": deck}, {"placement": None, "player": "p", "deck": deck}]}
    path = write(tmp_path / "d.json", {
        "datasetVersion": "1.0.0", "schemaVersion": "1", "cardSetVersion": "v", "cardsReleaseTag": "t",
        "generatedAt": "2026-01-01T00:00:00Z", "sources": ["s"], "tournaments": [event, event]})
    baskets = R.read_events(spark, path)
    names = sorted(r["basket"] for r in baskets.collect())
    assert [n.split(":", 1)[0] + ":" + n.split(":", 3)[3] for n in names] == ["1.0.0:0:0", "1.0.0:0:1", "1.0.0:1:0", "1.0.0:1:1"]
    assert R.event_lines(baskets).count() == 8 and str(baskets.first()["date"]) == "2025-03-01"


def test_split_rows(spark, tmp_path):
    path = tmp_path / "rows.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in [
        {"cards": [[2, 4], [1, 4]], "inks": ["Amber", "ruby"]}, {"cards": [], "inks": ["amber"]}, {"cards": [[1, 1]]}, {"inks": ["amber"]},
        {"cards": [[3, 1]], "inks": ["steel"]}]), encoding="utf8")
    rows = R.read_baskets(spark, str(path)).collect()
    assert len(rows) == 2 and rows[0]["cards"] == [[1, 4], [2, 4]] and rows[0]["inks"] == ["amber", "ruby"]


def test_split_writer_keeps_the_row_shape(spark, tmp_path):
    lines = spark.createDataFrame([(1, 2, 4), (1, 1, 3)], "basket long, item_idx long, qty long")
    heads = spark.createDataFrame([(1, ["Amber"], "2025-03-01", "u", "n", None, "p")],
                                  "basket long, facets array<string>, date string, url string, event_name string, placement int, player string")
    rows = R.basket_rows(lines, heads.withColumn("date", F.col("date").cast("date"))).withColumn("split", F.lit("train"))
    R.write_splits(rows, str(tmp_path / "out"))
    file = next((tmp_path / "out" / "split=train").glob("*.json"))
    assert json.loads(file.read_text()) == {
        "cards": [[1, 3], [2, 4]], "inks": ["Amber"], "tournament": {"url": "u", "name": "n", "date": "2025-03-01"},
        "placement": None, "player": "p"}


def test_packed_vectors(spark):
    vectors = spark.createDataFrame([(1, [1.5, -2.0]), (0, [0.0, 0.0])], "item_idx long, vec array<float>")
    for dtype, code in (("float16", "<f2"), ("float32", "<f4")):
        rows = A.packed_vectors(vectors, dtype).collect()
        assert [r["item_idx"] for r in rows] == [0, 1]
        assert np.frombuffer(bytes(rows[1]["raw"]), dtype=code).tolist() == [1.5, -2.0]
    with pytest.raises(ValueError):
        A.packed_vectors(vectors, "int8")
    assert A.require_shape(vectors, 1) == 2
    with pytest.raises(ValueError):
        A.require_shape(vectors, 2)


def test_packed_vectors_of_odd_rows(spark):
    """Null vectors stay null, empty ones empty; a missing number is NaN; sliced batches and widths that differ come back."""
    rows = [(i, None if i % 7 == 3 else [float(j) / 8 - i % 90 for j in range(i % 5)]) for i in range(300)] + [(300, [1.0, None, float("inf")])]
    vectors = spark.createDataFrame(rows, "item_idx long, vec array<float>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        for dtype in ("float16", "float32"):
            packed = A.packed_vectors(vectors, dtype)
            size = np.dtype(dtype).itemsize
            assert {r["item_idx"]: None if r["raw"] is None else len(r["raw"]) for r in packed.collect()} == {
                i: None if v is None else size * len(v) for i, v in rows}
            got = {r["item_idx"]: r["vec"] for r in A.unpacked_vectors(packed, dtype).collect()}
            assert got[300][0] == 1.0 and np.isnan(got[300][1]) and got[300][2] == float("inf")
            assert {i: got[i] for i in range(300)} == dict(rows[:300])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert A.unpacked_vectors(A.packed_vectors(vectors.limit(0))).collect() == []


def test_feature_files(spark, tmp_path):
    rows = spark.createDataFrame([(0, [0.0] * 8)], "item_idx long, features array<double>")
    layout = spark.createDataFrame([("cost", 2, 0), ("inks", 6, 2)], "block string, length int, start int")
    A.write_features(rows, layout, str(tmp_path / "f"))
    back, _ = A.read_features(spark, str(tmp_path / "f"))
    assert back.count() == 1
    A.write_features(rows, layout.filter("block = 'cost'"), str(tmp_path / "g"))
    with pytest.raises(ValueError):
        A.read_features(spark, str(tmp_path / "g"))


def test_frequency_document(spark):
    lines = spark.createDataFrame([("k", 2, 1), ("k", 10, 2)], "facet_key string, item_idx long, qty long")
    docs = {r["facet_key"]: r["json"] for r in A.frequency_documents(FR.play_frequency(lines)).collect()}
    assert docs["k"] == '{"2":0.333333,"10":0.666666}' and set(docs) == {"k", "_all"}


def test_checksums(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    found = A.file_checksums(spark, str(tmp_path))
    row = found.first()
    assert row["name"] == "a.bin" and row["size"] == 3 and row["sha256"].startswith("ba7816bf")
    manifest = spark.createDataFrame([("a.bin", row["sha256"], 3), ("b.bin", "0", None)], "name string, sha256 string, size long")
    report = A.audit(manifest, found)
    assert {(r["name"], r["status"]) for r in report.collect()} == {("a.bin", "ok"), ("b.bin", "missing")}
    with pytest.raises(ValueError):
        A.require_audited(report)


def test_registry():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 80


def test_vocabulary_masks_and_centroids(spark, tmp_path):
    from basketry.operators.clustering import KMeansResult

    items = spark.createDataFrame([(2, "b", ["Ruby"]), (1, "a", ["Amber", "Teal"])], "item_idx long, name string, facets array<string>")
    mapping = spark.createDataFrame([("z", 1), ("y", 2)], "id string, item_idx long")
    A.write_vocabulary(items, mapping, spark.range(1).toDF("variants"), str(tmp_path / "v"), "v7")
    kept = spark.read.json(str(tmp_path / "v" / "vocabulary"))
    assert {(r["item_idx"], r["catalogue_version"]) for r in kept.collect()} == {(1, "v7"), (2, "v7")}
    masks = A.facet_masks(items, ["Amber", "Ruby"])
    assert {(r["item_idx"], r["mask"]) for r in masks.collect()} == {(0, 0), (1, 1), (2, 2)}
    A.write_facet_masks(masks, ["Amber", "Ruby"], str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m")).first()["facets"] == ["Amber", "Ruby"]
    A.write_centroids(KMeansResult(np.eye(2), [3, 4], 5, "s"), spark, str(tmp_path / "c"))
    row = spark.read.json(str(tmp_path / "c")).first()
    assert (row["dim"], row["k"], row["clusterSizes"], row["iterations"], row["seed"]) == (2, 2, [3, 4], 5, "s")


def test_embedding_table(spark, tmp_path):
    spark.createDataFrame([(0, [0.0, 0.0]), (1, [1.0, 0.0])], "item_idx long, card_embeddings array<double>").write.parquet(str(tmp_path / "e"))
    vectors = A.read_embeddings(spark, str(tmp_path / "e"))
    assert vectors.schema["vec"].dataType.simpleString() == "array<float>" and A.require_shape(vectors, 1) == 2
    with pytest.raises(ValueError):
        A.read_embeddings(spark, str(tmp_path / "e"), names=["other"])
    with pytest.raises(ValueError):
        A.require_shape(vectors, 0)


def test_broken_basket_rows_fail(spark, tmp_path):
    path = tmp_path / "rows.json"
    path.write_text('{"cards": [[1, 2]], "inks": ["a"]}\n{"cards": "none", "inks": ["a"]}\n{"cards": [[1\n')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        R.read_baskets(spark, str(path)).collect()


def test_equal_versions_keep_their_baskets_apart(spark, tmp_path):
    deck = {"placement": 1, "player": "p", "deck": {"inks": ["a"], "cards": [{"cardId": "1", "count": 60}], "name": None}}
    for name in ("x", "y"):
        event = {"sourceUrl": f"https://e/{name}", "sourceName": "s", "name": name, "date": "2024-01-01", "decks": [deck]}
        (tmp_path / f"{name}.json").write_text(json.dumps({"datasetVersion": "1.0.0", "tournaments": [event]}))
    rows = R.read_events(spark, str(tmp_path)).collect()
    assert len({r["basket"] for r in rows}) == 2
