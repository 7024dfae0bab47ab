"""Quality rules, line first: clean a text line by line, then judge what is left of it.

Every ``\\n``-line with a word is held against rules for its end punctuation, for navigation
(separators, link words), for boilerplate (notices, licences, cookie and script lines), for
symbols and for shouting. Failing lines are removed; a text that loses more than
``MAX_LOST`` of its words is rejected. Before that, the base counts reject texts that are too
short or repeat themselves.

Null or blank texts have no words, fail the base rule and are not kept. Repeated rows are
judged one by one. The length of a text is not limited; memory follows the largest text of a
batch.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, map_frames, map_texts, texts_of

# Fixed values of the base rule.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

#: Percentage of the words that the removed lines may hold.
MAX_LOST = 30
#: Percentages of the words of a line above which it fails.
MAX_SYMBOLS, MAX_SHOUTING, MAX_SEPARATORS, MAX_NAVIGATION = 20, 60, 20, 50
#: Words of a line up to which a boilerplate phrase condemns it.
BOILERPLATE_WORDS = 40
#: Lines of at most so many words may lack any end punctuation (headings).
HEADING_WORDS = 4
#: Words of a line from which shouting and symbols are judged.
MIN_JUDGED = 4
ENDS = ".!?:;\"')]}»”’…。！？"
SEPARATORS = ("|", "›", "»", "•", "·", ">", "/")
#: Fixed phrases, lower case.
BOILERPLATE = (
    "all rights reserved", "cookie policy", "enable javascript", "javascript is disabled", "licensed under",
    "lorem ipsum", "powered by", "privacy policy", "released under the", "sign up for our newsletter",
    "subscribe to our", "terms of service", "terms of use", "this work is licensed", "use of cookies",
)
NAVIGATION = frozenset((
    "about", "account", "archive", "back", "blog", "cart", "categories", "contact", "faq", "forum", "help", "home",
    "login", "logout", "menu", "news", "next", "previous", "register", "rss", "search", "share", "shop", "sitemap", "top"))
_SYMBOLS = re.compile("[" + re.escape(SYMBOLS) + "]")
TRIM = ".,:;!?()[]{}\"'|/>»<«-"
_ENDS = tuple(ENDS)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n = len(words)
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in data.split(b"\n") if x and not x.isspace()]
    repeated = 0
    if n > 3:
        codes = {w: i for i, w in enumerate(dict.fromkeys(words))}
        ids = [codes[w] for w in words]
        size = len(codes)
        windows = [(a * size + b) * size + c for a, b, c in zip(ids, ids[1:], ids[2:], strict=False)]
        if len(set(windows)) < len(windows):
            seen: set[int] = set()
            twice = {x for x in windows if x in seen or seen.add(x)}
            reach = -1
            for i, x in enumerate(windows):
                if x in twice:
                    repeated += i + 2 - max(reach, i - 1)
                    reach = i + 2
    return n, len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated


def line_verdict(line: str) -> str | None:
    """The rule that a line with a word fails, or None."""
    words = WORD.findall(line)
    n = len(words)
    lower = line.lower()
    if n <= BOILERPLATE_WORDS and any(p in lower for p in BOILERPLATE):
        return "boilerplate"
    if n >= 2:
        if 100 * sum(w in SEPARATORS for w in words) > MAX_SEPARATORS * n:
            return "navigation"
        if 100 * sum(w.lower().strip(TRIM) in NAVIGATION for w in words) > MAX_NAVIGATION * n:
            return "navigation"
    if n >= MIN_JUDGED:
        if 100 * max(len(_SYMBOLS.findall(line)), line.count("!!")) > MAX_SYMBOLS * n:
            return "symbols"
        letters = [w for w in words if len(w) > 1 and w.lower() != w.upper()]
        if len(letters) >= MIN_JUDGED and 100 * sum(w == w.upper() for w in letters) > MAX_SHOUTING * len(letters):
            return "shouting"
    if n > HEADING_WORDS and not any(w.endswith(_ENDS) for w in words):
        return "punctuation"
    return None


def clean_lines(text: str) -> tuple[str, int]:
    """The text without its failing lines, and the words they held. Blank lines stay."""
    kept, lost = [], 0
    for line in text.split("\n"):
        if line and not line.isspace() and line_verdict(line):
            lost += len(line.encode("utf-8", "surrogatepass").split())
        else:
            kept.append(line)
    return "\n".join(kept), lost


def judge(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per document: base counts, ``base_failed``, ``lost_words``, ``kept``, and the
    cleaned text if asked for."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for text in batch["text"]:
            cleaned, lost = clean_lines(text)
            rows.append((*base_counts(text), lost, *([cleaned] if with_text else [])))
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "lost_words"]
        out = pd.DataFrame(rows, columns=names + ["cleaned"] * with_text)
        out.insert(0, "doc_id", batch["doc_id"].to_numpy())
        return out

    schema = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
              "n_repeat_words long, lost_words long" + ", cleaned string" * with_text)
    out = map_frames(texts_of(docs), run, schema)
    return out.withColumn("base_failed", base_failed()).withColumn("kept", verdict())


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def verdict() -> Column:
    return ~base_failed() & (100 * F.col("lost_words") <= MAX_LOST * F.col("n_words"))


def keep_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, in their own columns, with failing lines removed from ``text``.

    All in one pass and without a shuffle; columns other than ``text`` and ``n_chars`` are not touched.
    """

    def judged(texts: list[str | None]) -> tuple[list[str | None], list[bool] | None]:
        keep, cleaned = [], []
        for text in texts:
            n, _, _, _, repeated = base_counts(text or "")
            new, lost = clean_lines(text or "")
            keep.append(n >= MIN_WORDS and 100 * repeated <= MAX_REPEAT_PERCENT * n and 100 * lost <= MAX_LOST * n)
            cleaned.append(new)
        return cleaned, keep

    return map_texts(docs, judged)
