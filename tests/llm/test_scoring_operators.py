"""Whitening, ranked search and token counts against brute force, the public library and odd rows."""

import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from basketry.llm import ranked_search, token_counts, whitening_charpoly

BIG = 2 ** 53 + 1
DOCS = "doc_id long, text string, term string, score double, rank int, bundle long, n_bytes long, shard string"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))


def docs(spark, rows):
    """Documents with null and clashing extra columns."""
    return spark.createDataFrame([(i, t, None, 0.5, 1, 7, None, "s") for i, t in rows], DOCS)


# Token counts ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.VOCABULARY)


def odd_texts():
    draw = random.Random(5)
    letters = "aäß漢字 \n\t'sllve1२!.՘Ᲊ\x1c\x85\xa0 \U0001f600éあetaoin  "
    texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(50))) for _ in range(400)]
    texts += [t.replace("!", "<|endoftext|>") for t in texts[:100]]
    return [None, "", " ", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "a" * 50_000, "漢" * 4000, "\n" * 3000, LONG, *texts]


def test_token_counts_equal_the_library(spark, library):
    rows = [(BIG + i, t) for i, t in enumerate(odd_texts())] + [(None, "x y"), (3, "same"), (3, "same")]
    got = token_counts.count_tokens(docs(spark, rows)).collect()
    expected = Counter()
    for i, t in rows:
        t = t or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        expected[(i, len(t.encode()), n, n > 1024)] += 1
    assert Counter(map(tuple, got)) == expected
    assert token_counts.count_tokens(docs(spark, [])).collect() == []


def test_whole_tokens_are_proven(spark, library):
    """A proven string is one token of the library; what is left out is not one pre-token or not one token."""
    merges = token_counts.read_vocabulary(token_counts.VOCABULARY)
    whole = {r["token"] for r in token_counts.whole_tokens(spark, merges).collect()}
    for text in [*list(merges.strings)[::97], "the", " the", "  ", "a b", "'s"]:
        pieces = library.pre_tokenizer.pre_tokenize_str(text)
        alone = len(pieces) == 1 and len(library.encode(text, add_special_tokens=False).ids) == 1
        assert (text in whole) == (alone and text in set(merges.strings)), text


def test_long_words_merge_as_short_ones():
    merges = token_counts.read_vocabulary(token_counts.VOCABULARY)
    draw = random.Random(9)
    for _ in range(300):
        word = "".join(draw.choice("aehinorst'é") for _ in range(draw.randrange(1, token_counts.SCANNED))).encode()[:token_counts.SCANNED]
        symbols = [merges.first[b] for b in word]
        assert token_counts.merge_count(word, merges) == token_counts._merge_by_heap(symbols, merges)


def test_full_memo_starts_again(spark, library, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_BYTES", 500)
    merges = token_counts.read_vocabulary(token_counts.VOCABULARY)
    whole = frozenset(r["token"] for r in token_counts.whole_tokens(spark, merges).collect())
    counter = token_counts.Counter(whole, merges)
    text = " ".join(f"qx{i}zv" for i in range(300))
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert len(counter.costs) < len(whole) + 20


# Ranked search -----------------------------------------------------------------------------------


def brute_search(rows, items, top=20):
    cut = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def terms(text):
        return cut.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    counted = [(i, Counter(terms(t))) for i, t in rows]
    met = [(i, c) for i, c in counted if c]
    n, length = len(met), sum(sum(c.values()) for _, c in met)
    df = Counter(t for _, c in met for t in c)
    out = []
    for item, text in items:
        asked, scored = Counter(terms(text)), []
        for i, c in met:
            m = 75 + (25 * sum(c.values()) * n) // length
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t, k in asked.items() if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:top])]
    return Counter(out)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", None) for i, t in rows], "item_id long, text string, term string, place long")


SEARCHED = [
    (BIG, "Ab c d"), (None, "ab ab ZZ"), (2, None), (3, ""), (4, " .,! "), (5, "ab c é漢 x9"), (5, "ab c é漢 x9"), (6, LONG + " ab"),
    (7, "C d É漢"), (8, "_ab-c"), (9, "d d d d"), (10, "rare"),
]
ASKED = [(1, "AB c"), (1, "AB c"), (2, None), (None, "é漢 d d"), (3, "unknown words"), (4, ""), (5, "rare w3 w4 ab"), (BIG, "x9 ab")]


def test_search_equals_brute_force(spark):
    got = ranked_search.search(docs(spark, SEARCHED), items_of(spark, ASKED)).collect()
    assert Counter(map(tuple, got)) == brute_search(SEARCHED, ASKED)


@pytest.mark.parametrize("shard,bundle", [(7, 3), (64, 100)])
def test_search_prunes_nothing_that_ranks(spark, monkeypatch, shard, bundle):
    """Small shards and bundles, many ties, common and rare terms: the same rows as adding everything."""
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", shard)
    monkeypatch.setattr(ranked_search, "BUNDLE_ITEMS", bundle)
    draw = random.Random(shard)
    words = [f"t{int(draw.paretovariate(0.6)) % 60}" for _ in range(500)]
    rows = [(i // 2 * 2, " ".join(draw.choice(words) for _ in range(draw.randrange(0, 25)))) for i in range(400)]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.randrange(1, 12)))) for i in range(10)]
    got = ranked_search.search(docs(spark, rows).repartition(3), items_of(spark, items), top=5).collect()
    assert Counter(map(tuple, got)) == brute_search(rows, items, 5)


def test_search_of_nothing(spark):
    assert ranked_search.search(docs(spark, []), items_of(spark, ASKED)).collect() == []
    assert ranked_search.search(docs(spark, SEARCHED), items_of(spark, [])).collect() == []
    assert ranked_search.search(docs(spark, [(1, None), (2, "")]), items_of(spark, ASKED)).collect() == []


def test_accumulators_pack_and_unpack():
    cells, sums = np.array([0, 3, 900_000]), np.array([1, 5_000_000_000, 2 ** 50])
    at, back = ranked_search._unpack(*ranked_search._pack(cells, sums))
    assert at.tolist() == cells.tolist() and back.tolist() == sums.tolist()


# Whitening ---------------------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, 1.5, 2) for i, v in rows],
                                 "vec_id long, embedding array<double>, n long, whitened double, x int")


def exact_characteristic(matrix):
    """Faddeev-LeVerrier in fractions."""
    d = len(matrix)
    a = [[Fraction(v) for v in row] for row in matrix]
    m, out = [[Fraction(int(i == j)) for j in range(d)] for i in range(d)], [1]
    for k in range(1, d + 1):
        am = [[sum(a[i][t] * m[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
        c = -sum(am[i][i] for i in range(d)) / k
        m = [[am[i][j] + (c if i == j else 0) for j in range(d)] for i in range(d)]
        out.append(int(c))
    return out


@pytest.mark.parametrize("kind", ["full", "low rank", "zero", "equal roots", "one"])
def test_polynomial_is_exact(spark, kind):
    draw = np.random.default_rng(4)
    x = {"full": draw.integers(-200, 200, (40, 6)), "low rank": draw.integers(-50, 50, (2, 5)), "zero": np.zeros((3, 4), int),
         "equal roots": np.vstack([np.eye(4, dtype=int), -np.eye(4, dtype=int)]), "one": np.array([[1], [5]])}[kind]
    n, sums, products = len(x), x.sum(0).tolist(), (x.T @ x).tolist()
    matrix = whitening_charpoly.scatter(n, sums, products)
    polynomial = whitening_charpoly.characteristic_polynomial(spark, matrix)
    assert polynomial == exact_characteristic(matrix)
    roots = sorted(np.linalg.eigvalsh(np.array(matrix, dtype=float)), reverse=True)
    top = max(1, sum(matrix[i][i] for i in range(len(matrix)))).bit_length()
    positive = whitening_charpoly.roots_beyond(polynomial, 0, 0)
    assert positive == np.linalg.matrix_rank(np.array(matrix, dtype=float))
    for k in range(1, positive + 1):
        at, bits, first, last = whitening_charpoly.nth_root(polynomial, k, top)
        assert abs(at / 2 ** bits - roots[k - 1]) <= 1e-9 * roots[0] and first <= k <= last


def test_whitening_equals_a_plain_decomposition(spark):
    draw = np.random.default_rng(7)
    base = draw.normal(size=(60, 7)) * [0.9, 0.5, 0.4, 0.3, 0.2, 0.1, 0.05]
    rows = [(BIG + i, v.tolist()) for i, v in enumerate(base)]
    rows += [(None, base[0].tolist()), (BIG, base[1].tolist()), (1, None), (2, []), (3, [1.0, None] + [0.0] * 5), (4, [float("nan")] * 7),
             (5, [float("inf")] + [0.0] * 6), (6, [1.0, 2.0])]
    got = whitening_charpoly.whiten(vectors(spark, rows)).collect()
    kept = [(i, np.floor(256 * np.array(v))) for i, v in rows[:62]]
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, mean = len(fit), fit.mean(0)
    covariance = (fit - mean).T @ (fit - mean) / n
    values, axes = np.linalg.eigh(covariance)
    assert len(got) == 62 * 4 and {r["n"] for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"], r["deviation"]), []).append(r)
    signs = {}
    for i, x in kept:
        deviation = int(((n * x - fit.sum(0)) ** 2).sum())
        for c in range(1, 5):
            row = by[(i, c, deviation)][0]
            plain = (x - mean) @ axes[:, -c] / math.sqrt(values[-c])
            if abs(plain) > 1e-3:
                signs.setdefault(c, set()).add(round(row["whitened"] / plain, 8))
            assert abs(row["explained"] - values[-c] / values.sum()) < 1e-12
            assert row["identity_error"] < 1e-10
    assert all(s in ({1.0}, {-1.0}) for s in signs.values())


def test_whitening_of_few_and_of_equal_roots(spark):
    assert whitening_charpoly.whiten(vectors(spark, [])).collect() == []
    assert whitening_charpoly.whiten(vectors(spark, [(1, None), (2, [])])).collect() == []
    assert whitening_charpoly.whiten(vectors(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect() == []
    two = whitening_charpoly.whiten(vectors(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.75])])).collect()
    assert sorted((r["vec_id"], r["component"], round(abs(r["whitened"]), 12)) for r in two) == [(1, 1, 1.0), (2, 1, 1.0)]
    corners = [[float(s * (i == j)) for j in range(3)] for i in range(3) for s in (1, -1)]
    cross = whitening_charpoly.whiten(vectors(spark, list(enumerate(corners)))).collect()
    assert len(cross) == 18 and all(r["identity_error"] < 1e-12 and abs(r["explained"] - 1 / 3) < 1e-15 for r in cross)


def test_large_entries_stay_exact():
    wide = np.array([[2 ** 40, 3], [-(2 ** 41), 5]], dtype=np.int64)
    assert whitening_charpoly.exact_products(wide) == [[2 ** 80 + 2 ** 82, 3 * 2 ** 40 - 5 * 2 ** 41], [3 * 2 ** 40 - 5 * 2 ** 41, 34]]
