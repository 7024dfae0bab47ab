import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from basketry.operators import masking as MK
from basketry.operators import models as MO
from basketry.operators import names as N
from basketry.operators import tokens as T

TEXTS = [
    "Resist +1", "Resist +2 and Challenger +2", "Shift 4 onto your Hero characters", "Tinker Bell pays 3 {I}",
    "your other characters gain Rush this turn", "banish chosen character", "draw a card then draw another card",
    "banana banana bandana!!!! !!!!", "aaaa aaaaa aaa",
]


def sequential_merges(counts, room, least=2):
    words = [([f"{b:02X}" for b in w.encode()], n) for w, n in counts.items()]
    merges, known = [], set()
    while len(known) < room:
        pairs = Counter()
        for symbols, n in words:
            for p in zip(symbols, symbols[1:]):
                pairs[p] += n
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        if pairs[best] < least:
            break
        merges.append(best)
        known.add(best[0] + best[1])
        for symbols, _ in words:
            i = 0
            while i < len(symbols) - 1:
                if (symbols[i], symbols[i + 1]) == best:
                    symbols[i:i + 2] = [best[0] + best[1]]
                i += 1
    return merges


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(t,) for t in TEXTS], "text string")


def test_merges_equal_one_by_one_merging(spark, corpus):
    counts = T.pretoken_counts(corpus)
    plain = {r["pretoken"]: r["n"] for r in counts.collect()}
    assert T.learn_merges(counts, vocab_size=5 + 256 + 60) == sequential_merges(plain, 60)
    with pytest.raises(ValueError):
        T.learn_merges(counts.limit(0))


@pytest.mark.parametrize("pairs,level,fragments", [(4096, 65536, 50_000), (7, 65536, 40), (3, 2, 5), (1, 1, 1)])
def test_windows_change_nothing(spark, monkeypatch, pairs, level, fragments):
    """Passes of any size give the merges of one-by-one merging, down to the tail of equal counts."""
    monkeypatch.setattr(T, "WINDOW_PAIRS", pairs)
    monkeypatch.setattr(T, "LEVEL_PAIRS", level)
    monkeypatch.setattr(T, "WINDOW_FRAGMENTS", fragments)
    draw = random.Random(pairs)
    plain = Counter("".join(draw.choice("abbcé") for _ in range(draw.randrange(1, 9))) for _ in range(60 if pairs < 7 else 500))
    counts = spark.createDataFrame(list(plain.items()), "pretoken string, n long")
    room = 25 if pairs < 7 else 4000
    assert T.learn_merges(counts, vocab_size=5 + 256 + room) == sequential_merges(plain, room)


def test_a_window_ends_at_a_known_symbol():
    """'ab' + 'c' after 'a' + 'bc' makes a symbol that exists: its pairs outside the fragments are not known."""
    fragments = [(["61", "6263"], 9), (["6162", "63"], 8), (["64", "65"], 7)]
    assert T.merge_window(fragments, 1, set(), 99) == [("61", "6263"), ("6162", "63")]


def test_long_words_merge_as_short_ones():
    draw = random.Random(3)
    for _ in range(200):
        ranks = {(draw.choice("abc"), draw.choice("abc")): i for i in range(4)}
        ranks |= {(a + b, draw.choice("abc")): 10 + i for i, (a, b) in enumerate(list(ranks))}
        word = [draw.choice("abc") for _ in range(draw.randrange(1, T.SCANNED))]
        assert T.apply_merges(word, ranks) == T._apply_by_heap(word, ranks)
    long = T.apply_merges(["61"] * 100_000, {("61", "61"): 0, ("6161", "6161"): 1})
    assert long == ["61616161"] * 25_000


def test_names_equal_a_pattern(spark):
    draw = random.Random(2)
    for _ in range(500):
        listed = {"".join(draw.choice("ab c") for _ in range(draw.randrange(1, 5))).strip() for _ in range(6)} - {""}
        text = "".join(draw.choice("ab c ") for _ in range(40))
        pattern = "|".join(re.escape(n) for n in sorted(listed, key=lambda n: (-len(n), n)))
        found = N.Names(dict.fromkeys(listed, 1))
        assert list(found.matches(text)) == [(m.start(), m.group()) for m in re.finditer(pattern, text)]
        assert found.mark(text) == re.sub(rf"\s*({pattern})", rf"{N.CUT}{N.HELD}\1{N.CUT}", text)
    rows = spark.createDataFrame([("ab", 3), ("ab", 2), ("", 5), (None, 6), ("abc", 7)], "name string, ident long")
    table = N.write_names(rows, "name", "ident")
    assert table.size == 2 and sorted(map(tuple, table.frame(spark).collect())) == [("ab", 2), ("abc", 7)]
    texts = spark.createDataFrame([(None,), ("",), ("abcab xab",)], "t string")
    assert [r[0] for r in texts.select(N.find_names(F.col("t"), table)).collect()] == [[], [], ["abc", "ab", "ab"]]
    empty = N.write_names(rows.limit(0), "name", "ident")
    assert texts.select(N.marked(F.col("t"), empty)).collect()[2][0] == "abcab xab"


def test_words_are_split_byte_level(spark):
    df = spark.createDataFrame([("It's  +1, naïve 42!\n",)], "t string")
    assert df.select(T.pretokens(F.col("t"))).first()[0] == ["It", "'s", " ", " +", "1", ",", " naïve", " 42", "!", "\n"]


def test_reserved_tokens_are_whole(spark, corpus):
    items = spark.createDataFrame(
        [(1, "Tinker Bell", ["Hero", "Hero"], ["Shift", "Rush"]), (2, "Elsa", ["[PAD]", "Hero"], ["Rush"])],
        "item_idx long, name string, classes array<string>, keywords array<string>")
    tokens = T.reserved_tokens(items)
    listed = [r["token"] for r in tokens.orderBy("token_id").collect()]
    assert listed[:8] == list(T.GLYPHS) and listed[8:28] == list(T.MODIFIERS)
    assert listed[28:] == ["Tinker Bell", "Hero", "Shift", "shift", "Rush", "rush", "Elsa"]
    held = T.written_names(tokens)
    counts = T.pretoken_counts(corpus, "text", held)
    vocabulary = T.Vocabulary(held, tuple(T.learn_merges(counts, 600, held.size)))
    texts = spark.createDataFrame(
        [("Resist +1",), ("Resist +2",), ("Challenger +2",), ("Resist -1",), ("Tinker Bell",), ("{I}",), ("Zürich 😀",)], "text string")
    coded = {r["text"]: r["ids"] for r in T.encode_texts(texts, vocabulary).collect()}
    assert all(ids[0] == T.CLS and ids[-1] == T.SEP and T.UNK not in ids for ids in coded.values())
    plus = [coded[t][-2] for t in ("Resist +2", "Challenger +2")]
    assert plus[0] == plus[1] == 5 + listed.index("+2")
    assert coded["Tinker Bell"] == [2, 5 + 28, 3] and len(coded["{I}"]) == 3
    assert all(T.decode(ids, vocabulary).replace(" ", "") == t.replace(" ", "") for t, ids in coded.items())
    symbols = {r["token_id"]: r["symbol"] for r in vocabulary.table(spark).collect()}
    assert len(symbols) == vocabulary.size == max(symbols) + 1 and symbols[5 + 28] == "Tinker Bell"
    cut = {len(r["ids"]) for r in T.encode_texts(texts, vocabulary, max_positions=4, pad=True).collect()}
    assert cut == {4}


def test_mask_everything_but_specials(spark):
    ids = [0, 1, 2, 3, 4, 10, 11, 12, 13, 14]
    df = spark.createDataFrame([(1, ids)], "row long, ids array<int>")
    out = df.select(MK.mask_tokens(F.col("ids"), F.col("row"), "s", mask_id=4, vocab_size=100, specials=range(5), prob=1.0)).first()[0]
    assert [c["label"] for c in out] == [-100] * 5 + ids[5:] and [c["input_id"] for c in out[:5]] == ids[:5]
    with pytest.raises(ValueError):
        MK.mask_tokens(F.col("ids"), F.col("row"), "s", mask_id=4, vocab_size=100, specials=range(5), prob=0.0)


def test_mask_shares(spark):
    df = spark.range(400).select(F.col("id"), F.array_repeat(F.lit(50), 50).alias("ids"))
    cells = df.select(F.explode(MK.mask_tokens(F.col("ids"), F.col("id"), "s", mask_id=4, vocab_size=1000, specials=range(5))).alias("c"))
    row = cells.agg(F.avg((F.col("c.label") != -100).cast("double")), F.sum((F.col("c.input_id") == 4).cast("int")),
                    F.sum((F.col("c.label") != -100).cast("int"))).first()
    assert abs(row[0] - 0.15) < 0.01 and abs(row[1] / row[2] - 0.8) < 0.03


def test_block_masking(spark):
    blocks = [("cost", 0, 2), ("inks", 2, 3), ("scalars", 5, 1)]
    df = spark.createDataFrame([(1, [1.0] * 6)], "row long, f array<double>")
    for prob, want, names in ((1.0, [0.0] * 6, ["cost", "inks", "scalars"]), (0.0, [1.0] * 6, [])):
        dropped = MK.dropped_blocks(F.col("row"), "s", [n for n, _, _ in blocks], prob)
        row = df.select(dropped.alias("d"), MK.mask_blocks(F.col("f"), dropped, blocks).alias("m")).first()
        assert row["m"] == want and row["d"] == names


def test_pretrain_rows_and_embeddings(spark):
    items = spark.createDataFrame([(i, f"n{i}|v", t) for i, t in enumerate(TEXTS, 1)] + [(10, "n10|v", "")], "item_idx long, item_id string, text string")
    features = items.select("item_idx", F.array(F.lit(1.0), (F.col("item_idx") % 3).cast("double"), F.lit(0.5)).alias("features"))
    vocabulary = T.Vocabulary(None, tuple(T.learn_merges(T.pretoken_counts(items), 400)))
    rows = T.pretrain_rows(items, features, vocabulary, "seed", 0.3).collect()
    assert len(rows) == 10 and all(len(r["ids"]) == T.MAX_POSITIONS and r["ids"][0] == T.CLS for r in rows)
    by = {r["item_idx"]: [i for i in r["ids"] if i != T.PAD] for r in rows}
    assert by[10] == [T.CLS, T.SEP] and T.decode(by[2], vocabulary) == TEXTS[1]
    from hashlib import sha1

    for r in rows:
        digest = sha1(f"seed:n{r['item_idx']}|v".encode()).hexdigest()
        assert r["heldout"] == (int(digest[:8], 16) < int(0.3 * 2 ** 32))
    vectors = MO.item_embeddings(T.encode_texts(items, vocabulary).select("item_idx", "ids").join(features, "item_idx"), 4, hashed=64).collect()
    assert sorted(r["item_idx"] for r in vectors) == list(range(11))
    for r in vectors:
        norm = sum(x * x for x in r["vec"])
        assert len(r["vec"]) == 4 and (norm == 0 if r["item_idx"] == 0 else abs(norm - 1) < 1e-9)


def test_tables_of_decoding_are_built_once(monkeypatch):
    vocabulary = T.Vocabulary(None, (("61", "62"),))
    built = []
    plain = T.Vocabulary.ids
    monkeypatch.setattr(T.Vocabulary, "ids", lambda self: built.append(1) or plain(self))
    text = T.decoder(vocabulary, {})
    rows = [[T.CLS, vocabulary.first_byte + 256, T.SEP], [T.CLS, vocabulary.first_byte + ord("c"), T.SEP], [T.CLS, T.SEP]]
    assert [text(r) for r in rows] == ["ab", "c", ""] and len(built) == 1


def test_batches_become_python_values_a_few_rows_at_a_time():
    import pyarrow as pa

    seen = []

    def sizes(rows):
        seen.append(len(rows))
        return [len(r or ()) for r in rows]

    batches = [pa.array([[1] * (i % 3) for i in range(1000)] + [None]), pa.array([], pa.list_(pa.int64()))]
    out = [a.to_pylist() for a in T.by_slices(iter(batches), sizes, pa.int32())]
    assert out == [[i % 3 for i in range(1000)] + [0], []]
    assert max(seen) <= T.SLICE_ROWS and sum(seen) == 1001


def test_no_more_words_are_encoded_than_positions(spark, monkeypatch):
    monkeypatch.setattr(T, "_encode_udf", lambda vocabulary: lambda words: F.array(F.size(words)))
    texts = spark.createDataFrame([("a " * 1000,), ("a b",)], "text string")
    ids = [r["ids"][1] for r in T.encode_texts(texts, T.Vocabulary(None, ())).collect()]
    assert sorted(ids) == [2, T.MAX_POSITIONS]


def test_texts_of_one_row_group_are_dealt_out(spark, tmp_path):
    """A file of one row group is read by one task, but its texts are normalised and cut in many."""
    from basketry.plans.texts import clean_docs

    rows = [(i, f"Text  {i}") for i in range(200)] + [(200, ""), (201, None)]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    docs = clean_docs(spark, str(tmp_path))
    sizes = [r["n"] for r in docs.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 4 and sum(sizes) == 200 and max(sizes) < 100
    assert sorted(r["doc_id"] for r in docs.collect()) == list(range(200))


def test_words_merged_in_step_are_those_merged_one_by_one(spark):
    """Ids of odd words and texts, each alone and all together, with a merge that is never met and two that make one symbol."""
    import random

    import numpy as np
    import pyarrow as pa

    rng = random.Random(4)
    merges = (("61", "62"), ("6162", "61"), ("62", "61"), ("61", "6261"), ("20", "61"), ("7A7A", "7A"), ("C3", "A4"), ("61", "61"))
    vocabulary = T.Vocabulary(None, merges)
    words = ["".join(rng.choice("aab zä") for _ in range(rng.randrange(1, 45))) for _ in range(400)] + ["", "a", "€"]
    ranks = {pair: i for i, pair in reversed(list(enumerate(merges)))}
    want = [[vocabulary.ids()[x] for x in T.apply_merges([f"{c:02X}" for c in w.encode()], ranks)] for w in words]
    assert [c.tolist() for c in T._Merger(vocabulary).codes(words)] == want
    plain = T.Vocabulary(None, ())
    assert [c.tolist() for c in T._Merger(plain).codes(["ab", ""])] == [[plain.first_byte + 97, plain.first_byte + 98], []]
    ids = [sum(want[i:i + 5], []) for i in range(0, len(words), 5)] + [[], None, [T.CLS, *want[3], T.SEP], [T.CLS, *want[3], T.SEP, *want[4]], [vocabulary.first_byte + 0xC3]]
    read = T.batch_decoder(vocabulary)
    for some in (ids, ids[:-2], ids[:-1]):
        got = [t for part in T.by_values(iter([pa.array(some, pa.list_(pa.int32()))]), read, pa.string()) for t in part.to_pylist()]
        assert got == [T.decode(x or (), vocabulary) for x in some]
    parts = np.array([3, 0, 2])
    assert T.spans(parts, np.array([2, 1, 0, 2])).tolist() == [3, 4, 0, 1, 2, 3, 4]


def test_rows_of_many_words_are_worked_on_apart(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(T, "SLICE_VALUES", 50)
    seen = []
    rows = [[1] * (i % 70) for i in range(200)] + [None]
    out = list(T.by_values(iter([pa.array(rows)]), lambda x: seen.append((len(x), len(x.flatten()))) or x, pa.list_(pa.int64())))
    assert out[0].to_pylist() == rows and all(n == 1 or m <= 50 for n, m in seen)
