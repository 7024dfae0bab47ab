"""Token counts of whole texts under a byte-level BPE vocabulary, by a whole-token shortcut.

Before any text is read, every string of the vocabulary is split and merged on its own, in Spark
tasks; those that are one pre-token and end as one token are proven to count one. In the texts, a
pre-token among them counts one at once. Only the rest is merged by rank, the lowest rank first and
the leftmost of equals, and remembered while the memo has room.

The strings of special tokens are cut out of a text first and count one token each, as the public
library does by default; no begin or end tokens are added, nothing is cut off or padded. Null texts
are empty, empty texts have no tokens, rows and ids are kept as they are, repeated or null. Texts may
be of any length: a long pre-token is merged by a heap. A task holds one batch of texts, the
vocabulary and ``MEMO_BYTES`` of remembered pre-tokens.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import unicodedata
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .common import BATCH_ROWS, texts_of

#: Where the public vocabulary lies on this box; a parameter of every function.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
TOKEN_LIMIT = 1024
#: Bytes of remembered pre-tokens in a task, and the longest one worth remembering.
MEMO_BYTES, MEMO_LONGEST = 160 << 20, 200
#: Up to this many symbols a word is merged by rescanning it, beyond by a heap.
SCANNED = 24
# Fixed value: the byte-level word pattern.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ALL_WORDS = regex.compile(WORDS)
#: The same written out for characters below U+0250, which a plain engine reads faster.
_LETTERS, _NUMBERS, _BLANKS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
_NEAR_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_BLANKS}{_LETTERS}{_NUMBERS}]+"
                         f"|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+")
_BEYOND = re.compile("[^\x00-\u024f]")
#: Rank of a pair that never merges.
NEVER = 1 << 62


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file, letter first."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in shown}
    rest = [b for b in range(256) if b not in set(shown)]
    return table | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Merges:
    """What tasks need: rank of a pair (left << 32 | right), symbol made at a rank, special strings, unlike characters."""

    ranks: dict[int, int]
    made: tuple[int, ...]
    first: tuple[int, ...]
    strings: tuple[str, ...]
    specials: tuple[str, ...]
    unlike: str

    def patterns(self) -> tuple:
        """Of special strings, and of characters to take as neither letter nor number; none: no pattern."""
        special = "|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True))
        return special and regex.compile(special), self.unlike and regex.compile(f"[{self.unlike}]")


def read_vocabulary(path: str) -> Merges:
    """Read a vocabulary file of the public library; only its plain byte-level form is supported."""
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    model, split = data["model"], data["pre_tokenizer"]
    plain = (model["type"] == "BPE" and split["type"] == "ByteLevel" and split["use_regex"] and not split["add_prefix_space"]
             and data["normalizer"] is None and not model.get("dropout") and not model.get("ignore_merges")
             and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in data["added_tokens"]))
    if not plain:
        raise ValueError("only byte-level BPE without normalisation is supported")
    letters, ids = byte_letters(), model["vocab"]
    ranks: dict[int, int] = {}
    made: list[int] = []
    for rank, pair in enumerate(model["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        ranks[ids[left] << 32 | ids[right]] = rank  # of a repeated pair the last counts, as in the library
        made.append(ids[left + right])
    by_byte = {b: letter for letter, b in letters.items()}
    strings = []
    for token in ids:
        try:
            strings.append(bytes(letters[c] for c in token).decode("utf-8"))
        except (KeyError, UnicodeDecodeError):  # a special, or a part of a character: never a whole pre-token
            continue
    return Merges(ranks, tuple(made), tuple(ids[by_byte[b]] for b in range(256)), tuple(strings),
                  tuple(t["content"] for t in data["added_tokens"]), unlike_characters(Tokenizer.from_file(path)))


def unlike_characters(tokenizer) -> str:
    """Letters and numbers of this machine's newer tables that the library takes for neither, as class ranges.

    Where an older and a newer edition of the Unicode tables agree, so does the library; where they
    differ, it is asked.
    """
    known = regex.compile(r"[\p{L}\p{N}]")
    found: list[list[int]] = []
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if unicodedata.category(char) != "Cn" or not known.match(char):
            continue
        if len(tokenizer.pre_tokenizer.pre_tokenize_str("!" + char)) == 1:
            if found and found[-1][1] == code - 1:
                found[-1][1] = code
            else:
                found.append([code, code])
    return "".join(f"\\U{a:08X}-\\U{b:08X}" for a, b in found)


def merge_count(word: bytes, merges: Merges) -> int:
    """Tokens that are left of a pre-token."""
    first, rank_of, made = merges.first, merges.ranks.get, merges.made
    symbols = [first[b] for b in word]
    if len(symbols) > SCANNED:
        return _merge_by_heap(symbols, merges)
    ranks = [rank_of(a << 32 | b, NEVER) for a, b in zip(symbols, symbols[1:])]
    while ranks and (rank := min(ranks)) != NEVER:
        i = ranks.index(rank)
        symbols[i] = symbol = made[rank]
        del symbols[i + 1], ranks[i]
        if i:
            ranks[i - 1] = rank_of(symbols[i - 1] << 32 | symbol, NEVER)
        if i < len(ranks):
            ranks[i] = rank_of(symbol << 32 | symbols[i + 1], NEVER)
    return len(symbols)


def _merge_by_heap(symbols: list[int], merges: Merges) -> int:
    """The same for long words: candidate merges wait in a heap by (rank, place)."""
    after = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    end, left, made = len(symbols), len(symbols), merges.made
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < end and (rank := merges.ranks.get(symbols[i] << 32 | symbols[j])) is not None:
            heapq.heappush(heap, (rank, i, symbols[i], symbols[j]))

    for i in range(end - 1):
        offer(i)
    while heap:
        rank, i, a, b = heapq.heappop(heap)
        j = after[i] if symbols[i] == a else end
        if j >= end or symbols[j] != b:
            continue  # one of the two has been merged meanwhile
        symbols[i], symbols[j] = made[rank], -1
        after[i] = after[j]
        if after[i] < end:
            before[after[i]] = i
        left -= 1
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return left


class Costs(dict):
    """Tokens of a pre-token: one for the proven, merged and remembered for others."""

    def __init__(self, whole: frozenset[str], merges: Merges) -> None:
        super().__init__(dict.fromkeys(whole, 1))
        self.merges, self.whole, self.held = merges, whole, 0

    def __missing__(self, word: str) -> int:
        raw = word.encode("utf-8")
        cost = merge_count(raw, self.merges)
        if len(raw) <= MEMO_LONGEST:
            if self.held > MEMO_BYTES:
                self.clear()
                self.update(dict.fromkeys(self.whole, 1))
                self.held = 0
            self[word] = cost
            self.held += len(raw) + 120
        return cost


class Counter:
    """Counts tokens of texts in a task."""

    def __init__(self, whole: frozenset[str], merges: Merges) -> None:
        self.costs = Costs(whole, merges)
        self.special, self.unlike = merges.patterns()

    def split(self, text: str) -> list[str]:
        """Pre-tokens; characters that the library does not know are read as signs."""
        if not _BEYOND.search(text):
            return _NEAR_WORDS.findall(text)
        if not self.unlike or not self.unlike.search(text):
            return _ALL_WORDS.findall(text)
        shown = self.unlike.sub("!", text)
        return [text[m.start():m.end()] for m in _ALL_WORDS.finditer(shown)]

    def count(self, text: str) -> int:
        cost = self.costs.__getitem__
        if not self.special or not self.special.search(text):
            return sum(map(cost, self.split(text)))
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(cost, self.split(part))) for part in parts)


#: One counter per worker process and vocabulary: its memo serves all tasks of the process.
_COUNTERS: dict[str, Counter] = {}


def whole_tokens(spark: SparkSession, merges: Merges) -> DataFrame:
    """``(token)``: the vocabulary strings that, alone, are one pre-token and merge into one token."""
    ship_package(spark)

    def prove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            alone = [len(_ALL_WORDS.findall(t)) == 1 and merge_count(t.encode("utf-8"), merges) == 1 for t in batch["token"]]
            if any(alone):
                yield batch[alone]

    strings = pd.DataFrame({"token": list(merges.strings)})
    return spark.createDataFrame(strings, "token string").repartition(8).mapInPandas(prove, "token string")


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = TOKEN_LIMIT) -> DataFrame:
    """Per document: ``doc_id, n_bytes, n_tokens, over_limit``."""
    spark = docs.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    merges = read_vocabulary(vocabulary)
    whole = frozenset(r["token"] for r in whole_tokens(spark, merges).toLocalIterator())  # within the vocabulary's size
    shared, token = spark.sparkContext.broadcast((whole, merges)), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if token not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[token] = Counter(*shared.value)
        counter = _COUNTERS[token]
        for batch in batches:
            counts = [counter.count(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    sized = texts_of(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
