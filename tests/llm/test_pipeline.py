"""The pipeline end to end on odd rows and planted cases, each stage beside a plain version."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_corpus_operators import plain_components, plain_findings

import corpus_pipeline
from basketry.llm import quality_rules, secret_scan, source_mix
from basketry.llm.piece_codec import MODEL

BIG = 2 ** 53 + 1
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, pass long, _size int, extra map<string,int>"


def made_rows():
    rnd = random.Random(12)
    words = ["".join(rnd.choices(["ta", "lo", "ri", "ne", "sum", "pel", "ga"], k=rnd.randrange(1, 4))) for _ in range(600)]

    def text(n=90):
        lines = []
        while n > 0:
            k = min(n, rnd.randrange(9, 16))
            lines.append(" ".join(rnd.choice(words) for _ in range(k)).capitalize() + ".")
            n -= k
        return "\n".join(lines)

    rows = [(i, text(), rnd.choice(["a", "a", "b", None])) for i in range(60)]
    base = rows[7][1]
    rows += [(100 + i, base, "b") for i in range(5)]  # exact copies
    rows += [(200 + i, base + f" Added{i} end.", "a") for i in range(4)]  # near copies
    key = "".join(rnd.choices(secret_scan.ALPHABETS[3][1][:62], k=48))
    rows += [(300, text() + f"\nThe key is {key} and no more than that is said here.", "c"), (301, text() + "\nSet password = hunter22x now, they say to us all.", "c")]
    rows += [(400, "Home | About | Contact | Login\n" + text() + "\n" + "=" * 40, "c"), (401, "same line here. " * 60, "a"), (402, "too short.", "a")]
    rows += [(None, text(), None), (BIG, text(), "big"), (BIG, text(50), "big"), (500, None, "a"), (501, "", None), (502, " \n\t", "b")]
    rows += [(600, text(3000), "a")]
    return rows, key


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    rows, key = made_rows()
    folder = str(tmp_path_factory.mktemp("pipeline"))
    full = [(i, t, "en", s, len(t or ""), 3, 4, {"k": i % 7} if i else None) for i, t, s in rows]
    spark.createDataFrame(full, SCHEMA).coalesce(2).write.parquet(f"{folder}/documents.parquet")
    docs, out = corpus_pipeline.table(spark, folder, "documents"), []
    for _, step in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stage(step(spark, docs, folder), "test-pipeline")
        out.append(docs)
    return folder, full, out, key


def pairs(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def plain_quality(rows):
    kept = Counter()
    for i, t, *_ in rows:
        n, _, _, _, repeated = quality_rules.base_counts(t or "")
        lines = [x for x in (t or "").split("\n") if not (x.strip() and quality_rules.line_verdict(x))]
        lost = len((t or "").split()) - sum(len(x.split()) for x in lines)
        if n >= quality_rules.MIN_WORDS and 100 * repeated <= quality_rules.MAX_REPEAT_PERCENT * n and 100 * lost <= quality_rules.MAX_LOST * n:
            kept[(i, "\n".join(lines))] += 1
    return kept


def test_quality_rules_stage(staged):
    _, rows, out, _ = staged
    assert pairs(out[0]) == plain_quality(rows)
    ids = {r.doc_id for r in out[0].collect()}
    assert not ids & {401, 402, 500, 501, 502} and set(range(60)) | {None, BIG, 400, 600} <= ids


def test_near_duplicates_stage(staged):
    _, _, out, _ = staged
    before = [(r.doc_id, r.text) for r in out[0].collect()]
    known = [(i, t, None) for i, t in before if i is not None]
    smallest = plain_components(known, 5)
    kept = Counter((i, t) for i, t in before if i is None or smallest[i][1] == i)
    assert pairs(out[1]) == kept
    ids = {i for i, _ in kept}
    assert 7 in ids and not ids & {100, 101, 102, 103, 104, 200, 201, 202, 203}


def test_secret_stage(staged):
    _, _, out, key = staged
    before = [(r.doc_id, r.text) for r in out[1].collect()]
    found = plain_findings([t for _, t in before])
    expected = Counter()
    for at, (i, t) in enumerate(before):
        spans = sorted([s[:2] for s in secret_scan.base_spans(t)] + [(a, b) for j, a, b in found if j == at])
        new, end = "", 0
        for a, b in spans:
            if a >= end:
                new += t[end:a] + secret_scan.MARK
            end = max(end, b)
        expected[(i, new + t[end:])] += 1
    assert pairs(out[2]) == expected
    assert not any(key in t or "hunter22x" in t for _, t in pairs(out[2]))


def test_mix_stage(staged):
    """Words per source are near their targets, texts are whole but for the last pass, none is taken more than twice over."""
    _, _, out, _ = staged
    before, after = out[2].collect(), out[3].collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    total = Counter()
    for r in before:
        total[r.source] += size(r.text)
    names = sorted((s for s in total if s is not None)) + [None] * (None in total)
    weights = {s: source_mix.WEIGHTS[i % 3] for i, s in enumerate(names)}
    share, target, free = 1.5 * sum(total.values()), {}, set(names)
    while free:  # targets above twice the size stop there, the rest is shared again
        over = {s for s in free if weights[s] * share / sum(weights[x] for x in free) > 2 * total[s]}
        if not over:
            target |= {s: weights[s] * share / sum(weights[x] for x in free) for s in free}
            break
        target |= {s: 2 * total[s] for s in over}
        share, free = share - sum(2 * total[s] for s in over), free - over
    taken = Counter()
    for r in after:
        taken[r.source] += size(r.text)
    longest = max(size(r.text) for r in before)
    assert all(abs(taken[s] - target[s]) <= max(1, longest if total[s] == longest else 1) for s in names)
    whole = Counter((r.doc_id, r.source) for r in before)
    texts = {(r.doc_id, " ".join(r.text.split())) for r in before}
    assert {(r.doc_id, r.source) for r in after} <= set(whole) and set(out[3].columns) == set(out[2].columns)
    assert all(any(i == r.doc_id and " ".join(r.text.split()) in t for i, t in texts) for r in after)
    per = Counter((r.doc_id, r.source) for r in after)
    assert all(n <= 2 * whole[k] for k, n in per.items())


def test_piece_stage(staged):
    import sentencepiece

    _, _, out, _ = staged
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = Counter((r.doc_id, tuple(library.encode(r.text))) for r in out[3].collect())
    rows = out[4].collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == texts and all(r.n_pieces == len(r.ids) for r in rows)


def test_run_is_the_stages_in_order(spark, staged):
    folder, _, out, _ = staged
    whole = corpus_pipeline.run(spark, folder)
    key = ("doc_id", "n_pieces", "text_sha256", "decoded_sha256")
    assert Counter(tuple(r[k] for k in key) for r in whole.collect()) == Counter(tuple(r[k] for k in key) for r in out[4].collect())
    assert whole.columns == out[4].columns


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
