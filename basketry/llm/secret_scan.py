"""Secret scans: fixed patterns plus a battery of randomness tests on other long tokens.

A token of ``[A-Za-z0-9+/_-]``, with ``=`` only as padding at its end, outside the base spans is a
candidate if its characters fit an encoding (hex, base 32, base 64) and mix at least two of upper
case, lower case and digits. Name and value of ``NAME=VALUE`` are tokens of their own; a token with
signs of both alphabets of base 64 is cut, and its parts in either are tested (they may overlap).
Its symbols, as numbers of that alphabet, are tested for

* uniform use of the alphabet (chi-squared over equal classes of symbols),
* the number of runs above and below the middle of the alphabet,
* serial correlation at lag one,

each giving a p-value under "random"; Stouffer's sum joins them. What a short token cannot disprove
is not yet a finding, so a second null is tested: "made of language". Pairs of letters and digits are
counted in all texts, the log-likelihood of a token's pairs under these counts is scaled by that of
long ordinary words, and its lower tail is the p-value. Both are controlled per length class over all
candidates by Benjamini-Hochberg: a candidate is a finding if language is rejected at ``DOUBT_ALPHA`` (at
most that part of the findings is expected to be made of words), and is dropped if its randomness is
rejected at ``ALPHA``. Long tokens have the power to fail, so classes are kept apart, and the shortest
class must in addition reach ``MIN_P_SHORT``.

Null texts are empty and have no spans. Positions are code points, ends exclusive. Repeated
rows are scanned one by one. Length classes and bins of p-values have a fixed number, so what
the procedure gathers from the corpus is bounded by the bins, while counts cover all rows.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_frames, map_stream, map_texts, stage, texts_of, unstage

# The base patterns and their least lengths.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?((?-i:[A-Za-z0-9+/_.=-]+))", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
# Runs of at least 24, found from the left, are the maximal runs that are long enough.
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Candidates of the test battery.
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}(?:=*(?![A-Za-z0-9+/_=-]))?")
#: Parts of a token that no single alphabet holds, cut where those of base 64 differ.
PLAIN = re.compile(r"[A-Za-z0-9+/]{16,}(?:=*$)?")
SAFE = re.compile(r"[A-Za-z0-9_-]{16,}(?:=*$)?")
MIN_SYMBOLS = 16
#: Upper ends of the length classes but the last.
CLASSES = (24, 40, 80)
#: Part of the dropped ones that may be random, and part of the findings that may be language.
ALPHA, DOUBT_ALPHA = 0.05, 0.01
MIN_P_SHORT = 0.02
#: p-values of randomness are counted in so many equal bins per length class, those of language in
#: steps of a factor down to the last.
BINS = 10_000
DOUBT_STEPS, DOUBT_BINS = 20, 600
#: Symbols of the table of pairs: A-Z, a-z, 0-9, and one for all else.
SYMBOLS, OTHER = 63, 62
#: What pairs of letters are before any text is counted: some ordinary words, for tables of few.
PRIOR = """The manual says how to find the keys that people leave in their notes by mistake. Most of what they write is made
of plain words, names and numbers, with a date or a price here and there; some of it is a list of files, a piece of a program
or an address. Only a few strings have no meaning for the reader, because a machine has drawn every one of their letters by
chance, and these should be covered before anybody else can see or use them. Questions, figures, examples and jokes of 2019,
quite as much as long quotations, must stay exactly as their author wished."""
PRIOR_WEIGHT = 20
#: Ordinary words that the score of language is scaled by.
LONG_WORD = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{12,32}(?![A-Za-z0-9])")
#: What a masked secret is replaced by.
MARK = "[secret]"
ALPHABETS = (
    ("hex", "0123456789abcdef"), ("hex", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"))
_VALUES = [(name, {c: i for i, c in enumerate(a)}, len(a)) for name, a in ALPHABETS]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the base patterns, in order of start, then kind as listed."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    found += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def infer(token: str) -> tuple[str, list[int], int] | None:
    """The smallest encoding that holds the token (padding removed), with its symbols as numbers."""
    bare = token.rstrip("=")
    kinds = any(map(str.isdigit, bare)) + any(map(str.islower, bare)) + any(map(str.isupper, bare))
    if len(bare) < MIN_SYMBOLS or kinds < 2:
        return None
    for name, values, size in _VALUES:
        try:
            return name, [values[c] for c in bare], size
        except KeyError:
            continue
    return None


def upper_normal(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def battery(symbols: list[int], size: int) -> float:
    """p-value of "random over the alphabet" from the three tests; small: not random."""
    n = len(symbols)
    # Uniformity: so many equal classes that each expects about four symbols.
    classes = max(2, min(size, n // 4))
    counts = [0] * classes
    for s in symbols:
        counts[s * classes // size] += 1
    shares = [(size * (i + 1) + classes - 1) // classes - (size * i + classes - 1) // classes for i in range(classes)]
    chi = sum((c - n * w / size) ** 2 / (n * w / size) for c, w in zip(counts, shares, strict=True))
    k = classes - 1
    # Wilson-Hilferty: the cube root of chi-squared over its degrees is close to normal.
    z1 = ((chi / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    above = [2 * s >= size for s in symbols]
    n1 = sum(above)
    n2 = n - n1
    if n1 == 0 or n2 == 0:
        z2 = math.sqrt(n)
    else:
        runs = 1 + sum(a != b for a, b in zip(above, above[1:], strict=False))
        mean = 2 * n1 * n2 / n + 1
        spread = math.sqrt(max(1e-9, (mean - 1) * (mean - 2) / (n - 1)))
        z2 = abs(runs - mean) / spread
    middle = sum(symbols) / n
    power = sum((s - middle) ** 2 for s in symbols)
    if power == 0:
        z3 = math.sqrt(n)
    else:
        lag = sum((a - middle) * (b - middle) for a, b in zip(symbols, symbols[1:], strict=False))
        z3 = abs(lag / power * math.sqrt(n) + 1 / math.sqrt(n))
    # Two-sided tests become one-sided normal scores before the sum.
    one_sided = [z1] + [_score(min(1.0, 2 * upper_normal(z))) for z in (z2, z3)]
    return upper_normal(sum(one_sided) / math.sqrt(3))


def _score(p: float) -> float:
    """The normal score with upper tail ``p``, by bisection."""
    low, high = -8.0, 8.0
    for _ in range(50):
        mid = (low + high) / 2
        low, high = (mid, high) if upper_normal(mid) > p else (low, mid)
    return low


def length_class(n: int) -> int:
    return sum(n > c for c in CLASSES)


def _symbol_codes() -> np.ndarray:
    codes = np.full(256, OTHER, dtype=np.int64)
    for start, first, n in ((0, "A", 26), (26, "a", 26), (52, "0", 10)):
        codes[ord(first):ord(first) + n] = np.arange(start, start + n)
    return codes


_CODES = _symbol_codes()


def codes_of(text: str) -> np.ndarray:
    return _CODES[np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)]


def count_pairs(text: str) -> np.ndarray:
    codes = codes_of(text)
    return np.bincount(codes[:-1] * SYMBOLS + codes[1:], minlength=SYMBOLS * SYMBOLS)


class Language:
    """Log-likelihoods of pairs of letters and digits, from their counts in all texts."""

    def __init__(self, counts: np.ndarray) -> None:
        n = counts.reshape(SYMBOLS, SYMBOLS)[:OTHER, :OTHER].astype(float) + 0.5
        self.cost = np.zeros((SYMBOLS, SYMBOLS))
        self.cost[:OTHER, :OTHER] = np.log(n / n.sum(axis=1, keepdims=True))
        share = n / n.sum()
        self.mean = float((share * self.cost[:OTHER, :OTHER]).sum())
        self.spread = math.sqrt(float((share * (self.cost[:OTHER, :OTHER] - self.mean) ** 2).sum())) or 1.0
        # The scores of ordinary words, set once they have been seen.
        self.middle, self.width = 0.0, 1.0

    def score(self, token: str) -> float:
        """Near 0 for words, far below it for what is not made of language."""
        codes = codes_of(token)
        left, right = codes[:-1], codes[1:]
        inside = (left != OTHER) & (right != OTHER)
        n = int(inside.sum())
        if not n:
            return 0.0
        return (float(self.cost[left, right][inside].sum()) - n * self.mean) / (self.spread * math.sqrt(n))

    def doubt(self, token: str) -> float:
        """p-value of "made of language": how seldom words score so low."""
        return upper_normal(-(self.score(token) - self.middle) / self.width)


def learn_language(docs: DataFrame) -> Language:
    """Two passes over all texts: counts of pairs, then the scores of long words under them.

    Tokens long enough to be candidates do not count as language. At most ``SYMBOLS`` squared numbers
    reach the driver, and three sums.
    """

    def pairs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SYMBOLS * SYMBOLS, dtype=np.int64)
        for frame in frames:
            for text in frame["text"]:
                total += count_pairs(TOKEN.sub(" ", text))
        used = np.flatnonzero(total)
        yield pd.DataFrame({"pair": used.astype(np.int32), "n": total[used]})

    counts = count_pairs(PRIOR) * PRIOR_WEIGHT
    for row in map_stream(texts_of(docs), pairs, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        counts[row["pair"]] += row["n"]
    language = Language(counts)

    def moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, first, second = 0, 0.0, 0.0
        for frame in frames:
            for text in frame["text"]:
                for word in LONG_WORD.findall(text):
                    z = language.score(word)
                    n, first, second = n + 1, first + z, second + z * z
        yield pd.DataFrame({"n": [n], "first": [first], "second": [second]})

    n, first, second = map_stream(texts_of(docs), moments, "n long, first double, second double").agg(
        F.sum("n"), F.sum("first"), F.sum("second")).first()
    if n:
        language.middle = first / n
        language.width = max(1.0, math.sqrt(max(0.0, second / n - language.middle ** 2)))
    return language


def doubt_bin(p: float) -> int:
    return min(DOUBT_BINS, int(-math.log10(max(p, 1e-300)) * DOUBT_STEPS))


def candidates(text: str, base: list[tuple[int, int, str]], language: Language) -> list[tuple[int, int, str, int, float, int]]:
    """``(start, end, encoding, length class, p of random, bin of the p of language)`` of tokens that meet no base span."""
    out, i = [], 0
    for m in TOKEN.finditer(text):
        a, b = m.span()
        while i < len(base) and base[i][1] <= a:
            i += 1
        if any(s[0] < b and s[1] > a for s in base[max(0, i - 4):] if s[0] < b):
            continue
        for x, y in parts(m[0]):
            token = m[0][x:y]
            what = infer(token)
            if what:
                out.append((a + x, a + y, what[0], length_class(len(what[1])), battery(what[1], what[2]), doubt_bin(language.doubt(token))))
    return out


def parts(token: str) -> list[tuple[int, int]]:
    """The token, or its parts in either alphabet of base 64 if it has signs of both."""
    if not (("+" in token or "/" in token) and ("-" in token or "_" in token)):
        return [(0, len(token))]
    return sorted({m.span() for e in (PLAIN, SAFE) for m in e.finditer(token)})


def examine(docs: DataFrame, language: Language) -> DataFrame:
    """One row per document: base spans and tested candidates, before the control."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        base, tested = [], []
        for text in batch["text"]:
            spans = base_spans(text)
            base.append([{"start": s, "end": e, "kind": k} for s, e, k in spans])
            tested.append([{"start": s, "end": e, "encoding": c, "class": n, "p": p, "doubt": d}
                           for s, e, c, n, p, d in candidates(text, spans, language)])
        return pd.DataFrame({"doc_id": batch["doc_id"], "base": base, "tested": tested})

    return map_frames(texts_of(docs), run, (
        "doc_id long, base array<struct<start:int,end:int,kind:string>>, "
        "tested array<struct<start:int,end:int,encoding:string,class:int,p:double,doubt:int>>"))


@dataclass(frozen=True)
class Control:
    """Per length class: the p-value from which a candidate may be random, the bin from which it is no language."""

    random: dict[int, float]
    doubt: dict[int, int]

    def least(self, length: int) -> float:
        return max(self.random.get(length, 0.0), MIN_P_SHORT if length == 0 else 0.0)

    def first(self, length: int) -> int:
        """A bin that no candidate has where no p-value of the class is small enough."""
        return self.doubt.get(length, DOUBT_BINS + 1)

    def finds(self, length: int, p: float, doubt: int) -> bool:
        return p >= self.least(length) and doubt >= self.first(length)


def control(examined: DataFrame) -> Control:
    """Benjamini-Hochberg per length class, once for "random" and once for "made of language".

    Only counts per class and bin reach the driver: at most ``4 * BINS`` numbers.
    """
    tested = examined.select(F.explode("tested").alias("t")).select("t.*")

    def ranked(value: Column) -> DataFrame:
        counts = tested.groupBy("class", value.alias("bin")).agg(F.count("*").alias("n"))
        along = Window.partitionBy("class").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return counts.select("class", "bin", F.sum("n").over(along).alias("rank"), F.sum("n").over(Window.partitionBy("class")).alias("all"))

    even = ranked(F.least(F.lit(BINS - 1), F.floor(F.col("p") * BINS)).cast("int"))
    passed = even.filter((F.col("bin") + 1) / BINS <= ALPHA * F.col("rank") / F.col("all"))
    random = {r["class"]: (r["bin"] + 1) / BINS for r in passed.groupBy("class").agg(F.max("bin").alias("bin")).collect()}
    # Bins of language count downwards from the smallest p-values.
    low = ranked(-F.col("doubt"))
    passed = low.filter(F.pow(F.lit(10.0), F.col("bin") / DOUBT_STEPS) <= DOUBT_ALPHA * F.col("rank") / F.col("all"))
    doubt = {r["class"]: -r["bin"] for r in passed.groupBy("class").agg(F.max("bin").alias("bin")).collect()}
    return Control(random, doubt)


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans`` (start, end, kind) in order, base ones and added ones."""
    examined = stage(examine(docs, learn_language(docs)), "secret-tests")
    limits = control(examined)

    def random_spans(tested):
        def finds(x):
            found = F.lit(False)
            for c in range(len(CLASSES) + 1):
                found = found | ((x["class"] == c) & (x["p"] >= limits.least(c)) & (x["doubt"] >= limits.first(c)))
            return found
        return F.transform(F.filter(tested, finds), lambda x: F.struct(
            x["start"].alias("start"), x["end"].alias("end"), F.lit("random").alias("kind")))

    def order(s):
        place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"])
        return F.struct(s["start"].alias("start"), place.alias("k"), s["end"].alias("end"), s["kind"].alias("kind"))

    both = F.array_sort(F.transform(F.concat("base", random_spans(F.col("tested"))), order))
    return examined.select("doc_id", F.transform(both, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))).alias("spans"))


def spans_text(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """The spans of every document with counts and a digest of the base ones."""
    found = find_secrets(docs)
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"))


def mask_secrets(docs: DataFrame, mark: str = MARK) -> DataFrame:
    """The documents with every secret replaced by ``mark``; overlapping spans become one.

    The limits come from all documents; then texts are scanned again in place, so no text is
    shuffled and repeated rows keep their own spans. ``n_chars``, where there is such a column,
    is counted anew.
    """
    language = learn_language(docs)
    examined = stage(examine(docs, language), "secret-tests")
    limits = control(examined)
    unstage(examined)

    def hide(texts: list[str | None]) -> tuple[list[str | None], None]:
        return [None if t is None else masked(t, limits, language, mark) for t in texts], None

    return map_texts(docs, hide)


def masked(text: str, limits: Control, language: Language, mark: str = MARK) -> str:
    base = base_spans(text)
    spans = [s[:2] for s in base] + [(a, b) for a, b, _, c, p, d in candidates(text, base, language) if limits.finds(c, p, d)]
    parts, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join(parts) + text[at:]


def digest(spans: list[tuple[int, int, str]]) -> str:
    """The digest that ``report`` gives for base spans, for tests."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in spans).encode()).hexdigest()
