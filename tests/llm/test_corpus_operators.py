"""Operators of the corpus subpackage: brute-force versions, round trips and edge cases.

Every operator meets nulls in any column, empty and very long texts, ties, repeated rows, empty
tables and extra columns with clashing names.
"""

import hashlib
import io
import random
import re
import zipfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.llm import (
    chat_format,
    near_dedup,
    paragraph_sketch,
    piece_codec,
    quality_pu,
    quality_rules,
    secret_scan,
    source_mix,
    toxicity,
    warc_zip,
)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept boolean, place long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = " ".join(f"w{i % 977}" for i in range(60_000)) + "."


def table(spark, rows):
    """Documents with nulls where rows are short and columns whose names clash with results."""
    full = [(i, t, "en", s, None, 0.5, True, 9) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [
    (1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, "one two three", "b"), (5, "one two three", "b"),
    (6, LONG, "b"), (6, LONG, "b"), (None, "a b c d e f", None), (7, "é漢字 \U0001f600 ＡＢＣ x", "c"), (8, "x", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


def by_id(df, key="doc_id"):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r[key] is not None, r[key] or 0))


# -- 1 toxicity and 8 quality -------------------------------------------------------------------


def made_corpus(spark, n=240):
    rnd = random.Random(3)
    words = ["river", "stone", "bright", "under", "walk", "green", "paper", "seven", "cloud", "table"]
    docs, labels = [], []
    for i in range(n):
        lines = [" ".join(rnd.choice(words) for _ in range(9)).capitalize() + "." for _ in range(6)]
        toxic, bad = i % 4 == 0, i % 5 == 0
        if toxic:
            lines[rnd.randrange(6)] = "You " + rnd.choice(["grotling", "grotlings", "snarfle"]) + " go away."
        if bad:
            lines = [re.sub(r"(\w+)", r"\1!!", x.upper()) for x in lines]
        docs.append((i, "\n".join(lines), "s"))
        labels.append((i, int(not bad), int(toxic), None))
    docs += [(900, None, "s"), (901, "", None), (902, LONG, "s"), (None, "river.", "s"), (0, docs[0][1], "s")]
    labels += [(903, 1, 1, None), (None, 1, 0, None), (904, None, None, None), (1, 1, 0, None)]
    return table(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string")


def test_toxicity_learns_and_locates(spark, none):
    docs, labels = made_corpus(spark)
    rows = toxicity.judge(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.toxic for r in labels.collect() if r.toxic is not None}
    texts = {r.doc_id: r.text for r in docs.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth and r.doc_id < 900]
    assert held and all(r.predicted == truth[r.doc_id] for r in held)
    for r in rows:
        assert 0 <= r.score <= 1
        for s in r.offending:
            assert re.search("grotling|snarfle", texts[r.doc_id][s.start:s.end], re.I)
    assert {r.score for r in rows if r.doc_id in (900, 901)} == {0.0}
    assert toxicity.judge(none, labels).count() == 0


def test_toxicity_without_labels_scores_nearly_zero(spark):
    docs, labels = made_corpus(spark, 20)
    assert all(r.score < 1e-9 for r in toxicity.judge(docs, labels.limit(0)).collect())


def test_sentences_cover_all_words():
    text = "One. Two!\nThree? four\n\n five"
    assert [text[a:b].strip() for a, b in toxicity.sentences(text)] == ["One.", "Two!", "Three?", "four", "five"]


def test_quality_from_positives_alone(spark, none):
    docs, labels = made_corpus(spark)
    rows = quality_pu.judge(docs, labels).collect()
    assert len(rows) == docs.count()
    truth = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 900]
    assert held and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert quality_pu.judge(none, labels).count() == 0
    assert {r.score for r in quality_pu.judge(docs, labels.limit(0)).collect()} == {0.5}


def test_quality_never_reads_bad_labels(spark):
    docs, labels = made_corpus(spark)
    only_good = labels.filter("quality = 1")
    pick = lambda x: {(r.doc_id, round(r.score, 9)) for r in quality_pu.judge(docs, x).collect()}
    assert pick(labels) == pick(only_good)


# -- 2 quality rules ------------------------------------------------------------------------------


def plain_counts(text):
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    marked = {j for i, w in enumerate(windows) if w in twice for j in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(marked))


def test_base_counts_against_plain_code():
    rnd = random.Random(5)
    texts = ["", "a", "a a a a", LONG, " \x0b\x0c ", "x y\x85z \x1c q", "a b c a b c\n\na b c"]
    texts += ["".join(rnd.choice(["a ", "b ", "c\n", "# ", "é\t"]) for _ in range(rnd.randrange(40))) for _ in range(300)]
    for text in texts:
        assert quality_rules.base_counts(text) == plain_counts(text)


def test_lines_are_judged_one_by_one():
    good = "The river runs under the bridge and on to the sea."
    bad = ["Home | About | Contact | Login", "All rights reserved.", "BUY!! NOW!! CHEAP!! OFFER!! TODAY!!",
           "one&&& two*** three$$$ four### five%%%", "no end mark at all in this line here"]
    text = "\n".join([good, *bad, good])
    cleaned, lost = quality_rules.clean_lines(text)
    assert cleaned == f"{good}\n{good}"
    assert lost == sum(len(b.split()) for b in bad)


def test_quality_rules_on_odd_rows(spark, odd, none):
    rows = quality_rules.judge(odd).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        text = next(t or "" for i, t, _ in ODD if i == r.doc_id)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality_rules.judge(none).count() == 0
    kept = quality_rules.keep_documents(odd)
    assert kept.columns == odd.columns and kept.count() == sum(r.kept for r in rows)


def test_clean_documents_stay_and_junk_goes(spark):
    good = "\n".join(f"Line {i} tells{i} of{i} walks along{i} rivers, hills{i} and town{i}." for i in range(9))
    junk = "\n".join("Home | About | Shop | Cart | Login | Help" for _ in range(3)) + "\n" + good.split("\n")[0]
    mixed = good + "\nAll rights reserved."
    rows = by_id(quality_rules.keep_documents(table(spark, [(1, good, "a"), (2, junk * 5, "a"), (3, mixed, "a")])))
    assert [(r["doc_id"], r["text"].strip()) for r in rows] == [(1, good), (3, good)]


# -- 3 chat formatting ------------------------------------------------------------------------------


def test_template_round_trip():
    rnd = random.Random(2)
    bits = ["<|im_end|>", "<|im_start|>", "<\\|", "<|", "\\", "\n", "assistant ok", "a", "<", "|>", "é"]
    for _ in range(300):
        turns = [(rnd.choice(["user", "assistant", "", "odd\nrole", "r\\n<|"]), "".join(rnd.choices(bits, k=rnd.randrange(8))))
                 for _ in range(rnd.randrange(5))]
        text, spans = chat_format.write_turns(turns)
        assert chat_format.read_turns(text) == turns
        assert "".join(chat_format.unescape(text[a:b]) for a, b in spans) == "".join(t for r, t in turns if r == "assistant")


def test_layouts_meet_in_canonical_turns(spark):
    turns = [("user", "hi <|im_end|>"), ("assistant", "yo")]
    records = [
        '{"messages":[{"role":"user","content":"hi <|im_end|>"},{"content":"yo","role":"assistant"}]}',
        '{"conversations":[{"from":"human","value":"hi <|im_end|>"},{"from":"gpt","value":"yo"}]}',
        '{"data":{"turns":[{"speaker":{"role":"user"},"utterance":{"text":"hi <|im_end|>"}},'
        '{"speaker":{"role":"assistant"},"utterance":{"text":"yo"}}]}}',
        '{"instruction":"hi <|im_end|>","output":"yo"}', '{"prompt":"hi <|im_end|>","completion":"yo"}',
        '{"prompt":{"text":"hi <|im_end|>"},"response":{"text":"yo"}}',
        '{"messages":[]}', '{"unknown":1}', "not json", None, "[1]"]
    df = spark.createDataFrame(list(enumerate(records)), "k long, r string")
    rows = by_id(chat_format.format_records(df, "k", "r"), "k")
    want, _ = chat_format.write_turns(turns)
    assert [r["formatted"] for r in rows[:6]] == [want] * 6
    assert [r["mapping"] for r in rows[6:]] == ["no messages", None, None, None, None]
    assert all(r["formatted"] == "" for r in rows[6:])
    assert len({r["fingerprint"] for r in rows[:6]}) == 6


def test_conversations_read_back(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a<|x"), (2, None, None, None), (2, 0, "assistant", None), (2, 0, "assistant", None),
            (3, 0, "system", "s"), (3, 1, "user", ""), (3, 2, "assistant", LONG), (None, 0, "user", "n")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, record long")
    full = chat_format.with_control_case(df)
    got = {r["conv_id"]: r for r in by_id(chat_format.read_back(chat_format.format_records(
        chat_format.conversation_records(full), "conv_id", "record")), "conv_id")}
    said = "<|im_end|><|im_start|>assistant ok"
    want = {1: [("user", "q"), ("assistant", "a<|x")], 2: [("assistant", ""), ("assistant", ""), ("", "")], None: [("user", "n")],
            3: [("system", "s"), ("user", ""), ("assistant", LONG)], -1: [("user", said), ("assistant", said)]}
    assert set(got) == set(want)
    for k, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert got[k]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (got[k]["loss_chars"], got[k]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[k]["formatted_chars"] == len(chat_format.write_turns(turns)[0])


# -- 4 paragraph sketches ----------------------------------------------------------------------------


def plain_digests(text):
    word, blank = r"[^\x20\x09-\x0D]", r"[\x20\x09\x0B-\x0D]"
    return set(re.findall(f"(?:{word}{{1,64}}{blank}*){{1,{paragraph_sketch.BLOCK_WORDS}}}", text))


def likeness(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def test_sketches_recover_the_differences(spark):
    rnd = random.Random(9)
    rows = []
    for i in range(40):
        lines = [f"line {rnd.randrange(10**9)}" for _ in range(rnd.choice([1, 3, 10, 60, 400]))]
        rows.append((i, "\n".join(lines), "s"))
    rows += [(50, None, None), (51, "", "s"), (52, LONG, "s"), (53, LONG + "\nmore", "s"), (54, "a\n" * 50, "s"), (55, "a\n" * 60, "s"), (55, "a\n" * 60, "s")]
    got = by_id(paragraph_sketch.report(table(spark, rows)))
    order = sorted({(i, t or "") for i, t, _ in rows})
    assert len(got) == len(rows)
    for r in got:
        at = next(k for k, (i, _) in enumerate(order) if i == r["doc_id"])
        text, nxt = order[at][1], order[(at + 1) % len(order)][1]
        edited = text[:len(text) - len(text) // 4] + nxt[:len(text) // 4]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["n_chars"] == len(text)
        assert r["near_edited"] == pytest.approx(likeness(plain_digests(text), plain_digests(edited)))
        assert r["near_next"] == pytest.approx(likeness(plain_digests(text), plain_digests(nxt)))


def test_equal_texts_have_equal_fingerprints(spark, odd, none):
    rows = paragraph_sketch.report(odd).collect()
    assert len(rows) == len(ODD)
    marks = {}
    for r in rows:
        text = next(t or "" for i, t, _ in ODD if i == r.doc_id)
        assert marks.setdefault(text, r.fingerprint) == r.fingerprint
    assert paragraph_sketch.report(none).count() == 0
    one = paragraph_sketch.report(table(spark, [(1, "alone. here", "a")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


# -- 5 source mix --------------------------------------------------------------------------------------


def test_targets_by_water_filling(spark):
    sized = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), ("d", 400), (None, 50), (None, 50)], "source string, size long")
    rows = {r.source: r for r in source_mix.source_targets(sized).collect()}
    size = {"a": 100, "b": 1000, "c": 10, "d": 400, None: 100}
    weight = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    target, open_, left = {}, set(size), 1.5 * sum(size.values())
    while open_:
        share = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > 2 * size[s]}
        for s in over or open_:
            target[s] = 2.0 * size[s] if over else share * weight[s]
        left -= sum(target[s] for s in (over or open_))
        open_ -= over or open_
    assert {s: r.target for s, r in rows.items()} == pytest.approx(target)


def test_mix_takes_what_is_owed(spark, odd, none):
    rnd = random.Random(4)
    docs = table(spark, [(i, "w " * rnd.choice([0, 1, 7, 300, 900]), rnd.choice(["a", "a", "a", "b", None])) for i in range(120)])
    for df, n in ((docs, 120), (odd, len(ODD))):
        rows = source_mix.mix_report(df, block=16).collect()
        assert len(rows) == n
        by_source = {}
        kinds = {r.doc_id: r.source for r in df.select("doc_id", "source").collect()}
        for r in rows:
            assert 0 <= r.taken <= 2 * r.size
            got = by_source.setdefault(kinds[r.doc_id], [0, r.target])
            got[0] += r.taken
        assert all(taken == int(target) for taken, target in by_source.values())
    assert source_mix.mix_report(none).count() == 0
    again = lambda: sorted((r.doc_id, r.taken) for r in source_mix.mix_report(docs, block=16).collect())
    assert again() == again()


def test_every_stretch_of_the_schedule_is_near_the_weights(spark):
    targets = spark.createDataFrame([("a", 6000, 5, 5000.0), ("b", 9000, 2, 2000.0), ("c", 9000, 1, 1000.0)],
                                    "source string, source_size long, weight long, target double")
    rows = sorted((r.slot, r.source) for r in source_mix.schedule(targets, block=10).collect())
    assert [s for s, _ in rows] == list(range(800))
    for at in range(0, 700, 50):
        part = Counter(s for _, s in rows[at:at + 80])
        assert abs(part["a"] - 50) <= 4 and abs(part["b"] - 20) <= 4 and abs(part["c"] - 10) <= 4


def test_mixed_documents_have_the_words_taken(spark):
    docs = table(spark, [(i, "\n".join(f"d{i}w{j}" for j in range(30 + i)), "ab"[i % 2]) for i in range(12)])
    taken = {r.doc_id: r.taken for r in source_mix.mix_report(docs, block=8).collect()}
    out = source_mix.mixed_documents(docs, block=8)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert {k: v for k, v in taken.items() if v} == dict(words)


# -- 6 piece codec ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    with open(piece_codec.MODEL, "rb") as f:
        return piece_codec.Pieces(f.read())


def test_ids_equal_the_library(codec):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=piece_codec.MODEL)
    rnd = random.Random(8)
    texts = ["", " ", "  a  b ", "▁x", "ab\x00c\n\t d", "a" * 40, "日本語 \U0001f600", "x" * 3000, " " * 50 + "y", LONG]
    texts += ["".join(rnd.choice("abcdeth inons\n,.é漢12-=_/") for _ in range(rnd.randrange(200))) for _ in range(500)]
    texts += ["".join(rnd.choice(codec.text) for _ in range(20)).replace("▁", " ") for _ in range(500)]
    got = codec.encode_texts(texts)
    assert [x.tolist() for x in got] == [lib.encode(t) for t in texts]
    assert [codec.decode(x) for x in got] == [lib.decode(x.tolist()) for x in got]


def test_cache_limit_changes_nothing(codec, monkeypatch):
    texts = [f"word{i} other{i % 7} more" for i in range(300)]
    want = [x.tolist() for x in codec.encode_texts(texts)]
    monkeypatch.setattr(piece_codec, "CACHE_CHUNKS", 20)
    monkeypatch.setattr(piece_codec, "INDEX_CHARS", 60)
    codec.cache = {}
    assert [x.tolist() for x in codec.encode_texts(texts)] == want
    assert [x.tolist() for x in codec.encode_texts(texts)] == want


def test_chunks_walk_together(monkeypatch):
    """Chunks of known characters need no walk of their own, dead ends included; the others give the same ids."""
    import random

    import sentencepiece

    rng = random.Random(3)
    texts = ["".join(rng.choice("aeinrst") for _ in range(rng.randrange(1, 14))) for _ in range(3000)]
    library = sentencepiece.SentencePieceProcessor(model_file=piece_codec.MODEL)
    with open(piece_codec.MODEL, "rb") as f:
        model = f.read()
    monkeypatch.setattr(piece_codec, "FEW_CHUNKS", 0)
    together = piece_codec.Pieces(model)
    monkeypatch.setattr(together, "_walk", None)
    assert [x.tolist() for x in together.encode_texts(texts)] == library.encode(texts)
    odd = [t + "\u0b85\U0001f9ff" * (k % 2) for k, t in enumerate(texts)]
    for few in (0, 10_000):
        monkeypatch.setattr(piece_codec, "FEW_CHUNKS", few)
        codec = piece_codec.Pieces(model)
        ids = codec.encode_texts(odd)
        assert [x.tolist() for x in ids] == library.encode(odd) and [codec.decode(x) for x in ids] == odd


def test_suffix_array_finds_every_occurrence():
    import numpy as np

    text = "banana bandana\0"
    data = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.int64) + 1
    pieces = ["a", "an", "ana", "ban", "x", "dana"]
    starts, sizes, ids = piece_codec.occurrences(data, piece_codec.suffix_array(data, 4), piece_codec.PrefixLevels(pieces))
    want = {(m.start(), m.start() + len(p), i) for i, p in enumerate(pieces) for m in re.finditer(f"(?={p})", text)}
    assert set(zip(starts.tolist(), (starts + sizes).tolist(), ids.tolist(), strict=True)) == want


def test_encoding_documents(spark, odd, none):
    rows = piece_codec.encode_documents(odd).collect()
    assert len(rows) == len(ODD)
    assert all(r.round_trip and r.n_pieces == len(r.ids) and r.text_sha256 == r.decoded_sha256 for r in rows)
    assert {r.n_pieces for r in rows if r.doc_id in (1, 2)} == {0}
    assert piece_codec.encode_documents(none).count() == 0


# -- 7 near duplicates ---------------------------------------------------------------------------------------


def plain_components(rows, width):
    sets = []
    for i, t, _ in rows:
        words = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in WORD.findall(t or "")]
        sets.append({tuple(words[j:j + width]) for j in range(max(1, len(words) - width + 1))} if words else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: (len(sets[k]), least[find(k)]) for k, (i, _, _) in enumerate(rows)}


def test_components_against_all_pairs(spark):
    rnd = random.Random(6)
    vocabulary = [f"v{i}" for i in range(400)]
    passage = " ".join(rnd.choice(vocabulary) for _ in range(60))
    base = [rnd.choice(vocabulary) for _ in range(150)]
    rows = [(100, " ".join(base), "s")]
    for i in range(101, 180):  # near copies, some of which only meet through others
        words = list(base)
        for _ in range(rnd.choice([1, 2, 3, 4, 5])):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary).upper()
        rows.append((i, " ".join(words), "s"))
    for i in range(200, 270):  # one passage in texts that differ otherwise
        rows.append((i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([20, 80]))) + " " + passage, "s"))
    rows += [(i, f"short text {i % 3}", "s") for i in range(300, 330)]
    rows += [(400, None, None), (401, "", "s"), (402, "\n ", "s"), (403, LONG, "s"), (404, LONG + " end", "s"), (405, "a b", "s"), (406, "A  b", "s")]
    rnd.shuffle(rows)
    for width in (4, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.duplicate_components(table(spark, rows), width).collect()}
        assert got == plain_components(rows, width)


def test_long_lists_are_compared_in_full(spark):
    rnd = random.Random(11)
    base, passage = [f"b{i}" for i in range(300)], [f"p{i}" for i in range(200)]
    rows = []
    for i in range(300):
        words = rnd.sample(base, 300 - rnd.randrange(10, 70)) + [f"o{i}x{j}" for j in range(rnd.randrange(25))]
        rows.append((1000 + i, " ".join(words), "s"))
        # All hold much of the passage, but only the last two, which hold it whole, are near copies.
        words = rnd.sample(passage, 140) if i < 298 else passage + [f"q{i}x{j}" for j in range(20)]
        rows.append((2000 + i, " ".join(words), "s"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.duplicate_components(table(spark, rows), 1).collect()}
    assert got == plain_components(rows, 1) and got[2299][1] == 2298


def test_longer_text_meets_a_large_group(spark):
    rnd = random.Random(12)
    base = [f"b{i}" for i in range(200)]
    codes = near_dedup.WordCodes()
    common = set(near_dedup.shingle_set(near_dedup.shingle_words(" ".join(base)), 1, codes).tolist())
    rows = [(1000, " ".join(base), "s")]
    rows += [(1001 + i, " ".join(rnd.sample(base, 196) + [f"o{i}x{j}" for j in range(4)]), "s") for i in range(270)]
    while len(rows) < 274:  # a likeness of exactly 0.8 to the first, and few of its values in the index
        text = " ".join(base + [f"s{rnd.randrange(10**9)}" for _ in range(50)])
        index = near_dedup.shingle_set(near_dedup.shingle_words(text), 1, codes)[:near_dedup.INDEX].tolist()
        if 9 <= len(common.intersection(index)) <= 14:
            rows.append((3000 + len(rows), text, "s"))
    got = {r.doc_id: r.component_id for r in near_dedup.duplicate_components(table(spark, rows), 1).collect()}
    assert got == {i: 1000 for i, _, _ in rows}


def test_near_duplicates_on_odd_rows(spark, odd, none):
    rows = near_dedup.duplicate_components(odd).collect()
    assert len(rows) == len(ODD)
    assert {r.doc_id: r.component_id for r in rows} == {**{i: i for i, _, _ in ODD}, 5: 4}
    assert near_dedup.duplicate_components(none).count() == 0
    left = near_dedup.drop_near_duplicates(odd)
    assert left.columns == odd.columns and left.count() == len(ODD) - 1


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 90)] + [(5, 5), (7, 8), (7, 8)]
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(90)}}


# -- 9 secrets -----------------------------------------------------------------------------------------------


def plain_base(text):
    found = []
    for m in re.finditer(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        found += [(m.start(), 0, m.end(), "assign")] * (len(m[2]) >= 6)
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(s, e, k) for s, _, e, k in sorted(found)]


def test_base_spans_against_plain_code():
    rnd = random.Random(1)
    bits = ["password", "Token", "api_key", "APIKEY", "=", ": ", "\"", "'", " ", "abc", "abcdef0123456789", "AKIA", "ABCDEFGH12345678", "é", "\n", "."]
    for _ in range(3000):
        text = "".join(rnd.choices(bits, k=rnd.randrange(12)))
        assert secret_scan.base_spans(text) == plain_base(text)


def test_battery_tells_keys_from_names():
    rnd = random.Random(0)
    alphabet = secret_scan.ALPHABETS[3][1]
    keys = [secret_scan.infer("".join(rnd.choices(alphabet, k=40))) for _ in range(200)]
    assert sum(secret_scan.battery(k[1], k[2]) > 0.05 for k in keys) > 175
    names = ["Section2OfTheUserManualForPrinters", "aaaaaaaaaaaaaaaaaaaaAAAAAAAAAAAAAAAAAAAA1111", "1234567890abcdef1234567890abcdef1234"]
    p = [secret_scan.battery(*secret_scan.infer(n)[1:]) for n in names]
    # What reads like words may look even to the battery; that it is language tells it.
    assert max(p[1:]) < 0.05 and p[0] < 0.2
    language = secret_scan.Language(secret_scan.count_pairs(secret_scan.PRIOR) * secret_scan.PRIOR_WEIGHT)
    assert language.doubt("SectionOfTheUserManualForPrinters") > 1e-4
    assert sum(language.doubt("".join(rnd.choices(alphabet[:62], k=32))) < 1e-5 for _ in range(100)) > 90


def plain_findings(texts):
    """Battery and language by plain sums over listed candidates, Benjamini-Hochberg by the step-up rule over sorted p-values."""
    pairs = np.zeros(secret_scan.SYMBOLS ** 2, dtype=np.int64)
    for text in [secret_scan.PRIOR] * secret_scan.PRIOR_WEIGHT + [secret_scan.TOKEN.sub(" ", t) for t in texts]:
        codes = [int(c) for c in secret_scan.codes_of(text)]
        for x, y in zip(codes, codes[1:]):
            pairs[x * secret_scan.SYMBOLS + y] += 1
    language = secret_scan.Language(pairs)
    scores = [language.score(w) for text in texts for w in re.findall(r"(?<![A-Za-z0-9])[A-Za-z]{12,32}(?![A-Za-z0-9])", text)]
    if scores:
        language.middle = sum(scores) / len(scores)
        language.width = max(1.0, (sum((z - language.middle) ** 2 for z in scores) / len(scores)) ** 0.5)
    listed = [(i, c) for i, text in enumerate(texts) for c in secret_scan.candidates(text, secret_scan.base_spans(text), language)]
    out = set()
    for length in range(4):
        own = [(i, c) for i, c in listed if c[3] == length]
        even = sorted((int(min(c[4] * secret_scan.BINS, secret_scan.BINS - 1)) + 1) / secret_scan.BINS for _, c in own)
        drop = max((p for k, p in enumerate(even, 1) if p <= secret_scan.ALPHA * k / len(own)), default=0.0)
        doubts = sorted(10.0 ** (-c[5] / secret_scan.DOUBT_STEPS) for _, c in own)
        find = max((p for k, p in enumerate(doubts, 1) if p <= secret_scan.DOUBT_ALPHA * k / len(own)), default=-1.0)
        least = max(drop, secret_scan.MIN_P_SHORT if length == 0 else 0.0)
        out |= {(i, c[0], c[1]) for i, c in own if c[4] >= least and 10.0 ** (-c[5] / secret_scan.DOUBT_STEPS) <= find}
    return out


def test_planted_keys_are_found_and_words_are_not(spark):
    """Texts of invented words with long ones among them, and keys of 20 to 80 characters: both shares, and the plain version."""
    rnd = random.Random(8)
    parts = ["ung", "heit", "keit", "schaft", "lich", "ver", "be", "ge", "en", "er", "tion", "ation", "ment", "ing", "Th", "ou", "in"]
    alphabets = [secret_scan.ALPHABETS[3][1][:62], secret_scan.ALPHABETS[2][1], secret_scan.ALPHABETS[4][1]]
    texts, keys = [], {}
    for i in range(400):
        words = ["".join(rnd.choices(parts, k=rnd.randrange(1, 8))) for _ in range(60)]
        words += [w.capitalize() for w in words[:20]] + ["Chapter2" + words[0] + words[1]]
        rnd.shuffle(words)
        if i % 8 == 0:
            keys[i] = "".join(rnd.choices(alphabets[i // 8 % 3], k=rnd.randrange(20, 81)))
            words[30:30] = [keys[i]]
        texts.append(" ".join(words))
    df = table(spark, [(i, t, "s") for i, t in enumerate(texts)])
    found = {(r.doc_id, *map(int, s.split(":")[1:])) for r in secret_scan.report(df).collect() for s in r.spans.split(",") if s.startswith("random")}
    assert found == plain_findings(texts)
    told = {(i, texts[i][a:b]) for i, a, b in found}
    hits = sum((i, k) in told for i, k in keys.items())
    assert hits >= 0.95 * len(keys)
    assert not [t for i, t in told if t.isalpha() and t != keys.get(i)] and len(told) - hits <= 0.05 * len(told)


def test_secrets_on_odd_rows(spark, odd, none):
    rnd = random.Random(2)
    key = "".join(rnd.choices(secret_scan.ALPHABETS[3][1][:62], k=44))
    extra = table(spark, [(20, f"my key {key} and password=hunter22 é", "s"), (21, "password: \"abc\"", "s"), (22, "a" * 200_000, "s")])
    df = odd.unionByName(extra)
    rows = {r.doc_id: r for r in secret_scan.report(df).collect()}
    texts = {r.doc_id: r.text or "" for r in df.collect()}
    for i, r in rows.items():
        base = secret_scan.base_spans(texts[i])
        assert r.base_sha256 == secret_scan.digest(base)
        assert set(f"{k}:{s}:{e}" for s, e, k in base) <= set(r.spans.split(",")) | {""}
    assert rows[20].spans == "random:7:51,assign:56:73" and rows[21].spans == ""
    assert secret_scan.report(none).count() == 0
    masked = {r.doc_id: r.text for r in secret_scan.mask_secrets(df).collect()}
    assert masked[20] == "my key [secret] and [secret] é" and masked[1] is None and masked[6] == LONG
    assert secret_scan.mask_secrets(df).columns == df.columns


def test_keys_in_assignments_urls_and_paths(spark):
    rnd = random.Random(5)
    letters = secret_scan.ALPHABETS[3][1][:62]
    keys = ["".join(rnd.choices(letters, k=44)) for _ in range(40)]
    keys = [k for k in keys if secret_scan.battery(*secret_scan.infer(k)[1:]) > 0.3][:5]
    texts = [f"AWS_SECRET_ACCESS_KEY={keys[0]}", f"GET https://host.example/a?x=1&sig={keys[1]}&auth={keys[2]} now",
             f"pad={keys[3]}== end", f"some-long-path_name/{keys[4]}"]
    language = secret_scan.Language(secret_scan.count_pairs(secret_scan.PRIOR) * secret_scan.PRIOR_WEIGHT)
    spans = [secret_scan.candidates(t, secret_scan.base_spans(t), language) for t in texts]
    told = [[t[a:b] for a, b, *_ in s] for t, s in zip(texts, spans, strict=True)]
    assert told[:3] == [[keys[0]], keys[1:3], [keys[3] + "=="]] and keys[4] in told[3]
    masked = {r.doc_id: r.text for r in secret_scan.mask_secrets(table(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()}
    assert masked[0] == "AWS_SECRET_ACCESS_KEY=[secret]" and not any(k in t for k in keys for t in masked.values())


# -- 10 archives -----------------------------------------------------------------------------------------------


def test_packages_are_zip_files_with_wide_records(tmp_path):
    for wide in (False, True):
        out = io.BytesIO()
        package = warc_zip.PackageWriter(out, always64=wide)
        for name, data in (("a/x", b"123" * 50), ("empty", b"")):
            package.start(name)
            package.write(data)
            package.end()
        package.close()
        with zipfile.ZipFile(out) as z:
            assert z.testzip() is None and z.read("a/x") == b"123" * 50
        members = warc_zip.directory(out, len(out.getvalue()))
        assert [(m.name, m.size) for m in members] == [("a/x", 150), ("empty", 0)]
        at = warc_zip.data_start(out, members[0])
        assert out.getvalue()[at:at + 150] == b"123" * 50
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("c", b"1" * 1000)
    with pytest.raises(ValueError, match="compressed"):
        warc_zip.data_start(packed, warc_zip.directory(packed, len(packed.getvalue()))[0])


def test_archives_round_trip(spark, monkeypatch):
    same, other = "<p>same</p>" * 20, "<p>ö</p>" * 30
    pages = [(3, "http://a/\r\nx", same), (1, None, same), (2, "u", same), (4, "u", "tiny"), (5, "u", "tiny"), (6, "u", None),
             (7, "u", ""), (8, "u", other), (9, "u", other), (9, "u", other), (None, "u", same), (10, "u", "\r\n\r\n" * 100), (11, "u", LONG), (1, "u", same)]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, record_type string, bytes int")
    from basketry.session import scratch_folder

    monkeypatch.setattr(warc_zip, "PACKAGE_BYTES", 300)
    manifest = warc_zip.write_packages(df.coalesce(2), scratch_folder(spark, "warc-test"))
    assert manifest.count() > 2 and manifest.agg(F.sum("records")).first()[0] == len(pages)
    rows = warc_zip.read_packages(manifest).collect()
    first = {same: 1, other: 8}
    got = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)
    want = []
    for i, _, html in pages:
        data = (html or "").encode()
        leads = first.get(html, i)
        want.append((str(i), len(data), hashlib.sha256(data).hexdigest(), "response" if i == leads else "revisit", None if i == leads else leads))
    assert got == sorted(want, key=lambda r: r[:4])
    assert all((r.payload is None) == (r.record_type == "revisit") for r in rows)
    assert warc_zip.archive_report(df.limit(0)).count() == 0


# -- ids and foreign columns -----------------------------------------------------------------------------------

WIDE = 2 ** 53 + 1


@pytest.fixture(scope="module")
def wide(spark):
    """An id that doubles cannot hold, beside a null; a nullable long and a map that the stages must carry."""
    text = " ".join(f"word{i} flows." for i in range(80))
    return spark.createDataFrame(
        [(WIDE, text, "a", 5, WIDE + 2, {"k": 1}), (None, text + " more.", "b", None, None, None), (WIDE + 2, "short", None, 1, None, {})],
        "doc_id long, text string, source string, n_chars long, place long, extra map<string,long>").coalesce(1)


LABELS = [(WIDE, 1, 0), (WIDE + 2, 0, 1), (1, 1, 0), (2, 0, 1)]


@pytest.mark.parametrize("name", ["toxicity", "quality rules", "sketch", "mix", "codec", "near", "quality", "secrets"])
def test_ids_beside_nulls_stay_exact(spark, wide, name):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    run = {
        "toxicity": lambda: toxicity.judge(wide, labels), "quality rules": lambda: quality_rules.judge(wide),
        "sketch": lambda: paragraph_sketch.report(wide), "mix": lambda: source_mix.mix_report(wide),
        "codec": lambda: piece_codec.encode_documents(wide), "near": lambda: near_dedup.duplicate_components(wide, 4),
        "quality": lambda: quality_pu.judge(wide, labels), "secrets": lambda: secret_scan.report(wide)}[name]
    rows = run().collect()
    assert {r.doc_id for r in rows} == {WIDE, WIDE + 2, None} and len(rows) == 3
    if name in ("toxicity", "quality"):
        import zlib

        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)


def test_stages_carry_foreign_columns(spark, wide):
    for out in (quality_rules.keep_documents(wide), secret_scan.mask_secrets(wide), near_dedup.drop_near_duplicates(wide), source_mix.mixed_documents(wide)):
        assert out.columns == wide.columns and out.schema["place"].dataType == wide.schema["place"].dataType
        rows = {r.doc_id: r for r in out.collect()}
        assert rows[WIDE].place == WIDE + 2 and rows[WIDE].extra == {"k": 1}
        assert None not in rows or (rows[None].place is None and rows[None].extra is None)


def test_chat_keys_beside_nulls_stay_exact(spark):
    turns = spark.createDataFrame([(WIDE, 0, "user", "a"), (None, 0, "user", "b"), (WIDE, 1, "assistant", "c")],
                                  "conv_id long, turn long, role string, text string")
    out = chat_format.read_back(chat_format.format_records(chat_format.conversation_records(turns).coalesce(1), "conv_id", "record"))
    assert {(r.conv_id, r.n_turns) for r in out.collect()} == {(WIDE, 2), (None, 1)}


def test_roles_stay_as_they_are_written(spark):
    """Whatever layout a conversation gets, its roles and its loss come back unchanged."""
    roles = ["human", "gpt", "bot", "prompter", "model", "user", "assistant", "system", "Über\n"]
    turns = spark.createDataFrame([(c, t, roles[(c + t) % len(roles)], f"text {c} {t}") for c in range(40) for t in range(3)],
                                  "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_records(chat_format.conversation_records(turns), "conv_id", "record")).collect()}
    for c in range(40):
        said = [(roles[(c + t) % len(roles)], f"text {c} {t}") for t in range(3)]
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256("".join(t for r, t in said if r == "assistant").encode()).hexdigest()


def test_layouts_with_more_fields(spark):
    import json

    records = [
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "id": "x1", "source": "s"},
        {"instruction": "do", "input": "this", "output": "done"}, {"instruction": "do", "input": "", "output": "done", "id": 3},
        {"prompt": "p", "completion": "c", "name": None}, {"messages": [{"role": "gpt", "content": "raw"}], "source": "s"}, {"other": 1}, None]
    df = spark.createDataFrame([(i, json.dumps(r) if r else None) for i, r in enumerate(records)], "k long, record string")
    out = chat_format.format_records(df, "k", "record")
    turns = {r.k: chat_format.read_turns(r.formatted) for r in out.collect()}
    assert turns[0] == [("user", "q"), ("assistant", "a")] and turns[1] == [("user", "do\n\nthis"), ("assistant", "done")]
    assert turns[2] == [("user", "do"), ("assistant", "done")] and turns[3] == [("user", "p"), ("assistant", "c")]
    assert turns[4] == [("gpt", "raw")] and turns[5] == turns[6] == []
    assert {(r.fingerprint is None, r.records) for r in chat_format.unmapped_layouts(out).collect()} == {(False, 1), (True, 1)}


def test_pages_of_one_id_with_two_payloads(spark):
    one, two = "a" * 200, "b" * 200
    pages = spark.createDataFrame([(1, "u", one), (2, "u", one), (2, "u", two), (WIDE, "u", two), (None, "u", one), (3, "u", "c" * 200), (3, "u", "c" * 200)],
                                  "page_id long, url string, html string").coalesce(1)
    rows = Counter((r.page_id, r.record_type, r.refers_to, r.payload_digest) for r in warc_zip.archive_report(pages).collect())
    d = {t[0]: hashlib.sha256(t.encode()).hexdigest() for t in (one, two, "c" * 200)}
    assert rows == Counter([(1, "response", None, d["a"]), (2, "revisit", 1, d["a"]), (2, "response", None, d["b"]), (WIDE, "revisit", 2, d["b"]),
                            (None, "revisit", 1, d["a"]), (3, "response", None, d["c"]), (3, "response", None, d["c"])])


def test_mix_of_repeated_ids_and_clashing_names(spark):
    rows = [(1, "a b c d", "s", 0, 1, 2, 3), (1, "a b c d e f g h", "s", 0, 1, 2, 3), (2, "x y z", "s", 0, 1, 2, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, pass int, _from int, _size int, _mix_id int")
    targets = {r.source: r for r in source_mix.mix(df)[2].collect()}
    out = source_mix.mixed_documents(df)
    assert out.columns == df.columns
    texts = Counter(r.text for r in out.collect())
    assert abs(sum(len(t.split()) * n for t, n in texts.items()) - int(targets["s"].target)) <= 8
    whole = {t for _, t, *_ in rows}
    assert all(any(w.startswith(t) for w in whole) for t in texts) and texts["a b c d"] <= 2 and texts["a b c d e f g h"] <= 2
