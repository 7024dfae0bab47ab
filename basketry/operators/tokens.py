"""Reserved tokens, pre-tokens, byte-pair merges and encoding."""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import SPACE
from ..session import cut_lineage, ship_package
from .drawing import NONE, lengths
from .names import CUT, HELD, NameTable, load, marked, write_names
from .ranking import rank_by_range

# Special tokens in id order, glyphs, stat modifiers, the byte-level word
# pattern, and the defaults of a vocabulary.
SPECIALS = ("[PAD]", "[UNK]", "[CLS]", "[SEP]", "[MASK]")
GLYPHS = ("{E}", "{I}", "{L}", "{S}", "{W}", "{1}", "{2}", "{IW}")
MODIFIERS = ("+0", "+1", "+2", "+3", "+4", "+5", "+6", "+7", "+8", "+9",
             "-0", "-1", "-2", "-3", "-4", "-5", "-6", "-7", "-8", "-9")
WORD = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\x0b\x1c-\x1f\x{85}\p{Z}\p{L}\p{N}]+|"
        + SPACE + r"+(?!\S)|" + SPACE + "+")
VOCAB_SIZE = 32000
MIN_FREQUENCY = 2
MAX_POSITIONS = 256
PAD, UNK, CLS, SEP, MASK = range(5)

# Merge learning: leading pairs looked at in a pass, pairs of one count taken together at most, and
# distinct fragments of them that the driver holds at once.
WINDOW_PAIRS, LEVEL_PAIRS, WINDOW_FRAGMENTS = 4096, 65536, 50_000
# Words of up to so many symbols are merged by rescanning, longer ones by a heap.
SCANNED = 32
NEVER = 1 << 62
# Rows of an Arrow batch that are Python objects at a time, words or ids of one in arrays, and words merged in step.
SLICE_ROWS = 200
SLICE_VALUES = 1 << 18
STEP_WORDS = 8192


def reserved_tokens(items: DataFrame, name: str = "name", classes: str = "classes",
                    keywords: str = "keywords") -> DataFrame:
    """``(token, token_id)``: constants, then per item its name, classes and keywords.

    Keywords also come in lower case. The first place of a token counts.
    """
    spark = items.sparkSession
    fixed = spark.createDataFrame(
        [(t, 0, i) for i, t in enumerate(GLYPHS + MODIFIERS)], "token string, item_idx long, slot int")
    none = F.array().cast("array<string>")
    words = F.concat(
        F.array(F.struct(F.col(name).alias("token"), F.lit(0).alias("slot"))),
        F.transform(F.coalesce(classes, none), lambda c, i: F.struct(c.alias("token"), (i + 1).alias("slot"))),
        F.flatten(F.transform(F.coalesce(keywords, none), lambda c, i: F.array(
            F.struct(c.alias("token"), (F.lit(1 << 20) + 2 * i).alias("slot")),
            F.struct(F.lower(c).alias("token"), (F.lit(1 << 20) + 2 * i + 1).alias("slot"))))))
    found = items.select(F.col("item_idx").cast("long"), F.explode(words).alias("w")).select(
        "w.token", "item_idx", "w.slot")
    first = fixed.unionByName(found).filter(
        (F.length("token") > 0) & ~F.col("token").isin(*SPECIALS)
    ).groupBy("token").agg(F.min(F.struct("item_idx", "slot")).alias("place"))
    return rank_by_range(first, [], [F.col("place"), F.col("token")], "no").select(
        "token", (F.col("no") + len(SPECIALS) - 1).alias("token_id"))


def written_names(reserved: DataFrame) -> NameTable:
    """Reserved tokens for the workers, from ``(token, token_id)``."""
    return write_names(reserved, "token", "token_id")


def _cut_pieces(text: Column, reserved: NameTable | None) -> Column:
    """Array of the pieces of a text: reserved tokens behind a mark, and what lies between them.

    A reserved token takes the white space on its left with it.
    """
    if reserved is None:
        return F.array(text)
    return F.filter(F.split(marked(text, reserved), CUT), lambda p: F.length(p) > 0)


def _words(piece: Column) -> Column:
    return F.regexp_extract_all(piece, F.lit(WORD), F.lit(0))


def pretokens(text: Column, reserved: NameTable | None = None) -> Column:
    """Array of pre-tokens of a text, split byte-level style once reserved tokens are cut out whole."""
    if reserved is None:
        return _words(text)
    return F.flatten(F.transform(_cut_pieces(text, reserved), lambda p: F.when(
        F.startswith(p, F.lit(HELD)), F.array(F.substring(p, 2, 2147483647))).otherwise(_words(p))))


def pretoken_counts(texts: DataFrame, text: str = "text", reserved: NameTable | None = None) -> DataFrame:
    """Words that merges may be learnt from, without reserved tokens, counted map side first."""
    ship_package(texts.sparkSession)
    free = F.filter(_cut_pieces(F.col(text), reserved), lambda p: ~F.startswith(p, F.lit(HELD)))
    words = texts.select(F.explode(F.flatten(F.transform(free, _words))).alias("pretoken"))
    return words.groupBy("pretoken").agg(F.count("*").alias("n"))


def byte_symbols(word: Column) -> Column:
    """UTF-8 bytes as two-digit hex strings; a merged symbol is the joined hex."""
    return F.regexp_extract_all(F.hex(F.encode(word, "UTF-8")), F.lit(".."), F.lit(0))


def pair_counts(words: DataFrame) -> DataFrame:
    """``(lhs, rhs, n)`` over adjacent symbols of ``(symbols, n)``."""
    n = F.size("symbols")
    zipped = F.arrays_zip(F.slice("symbols", F.lit(1), n - 1).alias("l"), F.slice("symbols", F.lit(2), n - 1).alias("r"))
    return words.filter(n > 1).select(F.explode(zipped).alias("p"), "n").groupBy(
        F.col("p.l").alias("lhs"), F.col("p.r").alias("rhs")).agg(F.sum("n").alias("n"))


def _independent(ranked: Sequence[tuple[str, str, int]], known: set[str], complete: bool) -> list[tuple[str, str]]:
    """Longest head of the ranked pairs that one-by-one merging would take unchanged.

    Merging (a, b) touches pairs that end in ``a`` or start with ``b`` and no others, and a
    pair it creates is no more frequent than one of those. So the head may run until the
    first pair that chains with an earlier one (the right symbol of one is the left symbol
    of the other); pairs tied with the first one not taken, or with the unseen rest of an
    incomplete list, are left for the next pass. A merge that yields an already known symbol ends the head,
    since it adds to that symbol's pairs.
    """
    taken: list[tuple[str, str, int]] = []
    lefts: set[str] = set()
    rights: set[str] = set()
    made = set(known)
    for lhs, rhs, n in ranked:
        if taken and (lhs in rights or rhs in lefts or lhs + rhs in lefts or lhs + rhs in rights):
            break
        taken.append((lhs, rhs, n))
        lefts.add(lhs)
        rights.add(rhs)
        if lhs + rhs in made or lhs == rhs:
            break
        made.add(lhs + rhs)
    if len(taken) < len(ranked):
        floor = ranked[len(taken)][2]
    else:
        floor = 0 if complete else ranked[-1][2]
    head = [t for t in taken if t[2] > floor]
    return [(a, b) for a, b, _ in (head or taken[:1])]


def apply_merges(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The symbols of a word after all merges, the lowest rank first and the leftmost of equals."""
    if len(symbols) > SCANNED:
        return _apply_by_heap(symbols, ranks)
    get = ranks.get
    out = list(symbols)
    found = [get(p, NEVER) for p in zip(out, out[1:])]
    while found and (least := min(found)) != NEVER:
        i = found.index(least)
        out[i:i + 2] = [out[i] + out[i + 1]]
        del found[i]
        if i:
            found[i - 1] = get((out[i - 1], out[i]), NEVER)
        if i < len(found):
            found[i] = get((out[i], out[i + 1]), NEVER)
    return out


def _apply_by_heap(symbols: Sequence[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same for long words: possible merges wait in a heap by (rank, place)."""
    out: list[str | None] = list(symbols)
    end = len(out)
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    heap: list[tuple[int, int, str, str]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < end and (rank := ranks.get((out[i], out[j]))) is not None:
            heapq.heappush(heap, (rank, i, out[i], out[j]))

    for i in range(end - 1):
        offer(i)
    while heap:
        _, i, lhs, rhs = heapq.heappop(heap)
        j = after[i] if out[i] == lhs else end
        if j >= end or out[j] != rhs:
            continue  # one of the two has been merged meanwhile
        out[i], out[j] = lhs + rhs, None
        after[i] = after[j]
        if after[i] < end:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [x for x in out if x is not None]


def _with_merged(symbols: list[str], pair: tuple[str, str]) -> list[str]:
    out: list[str] = []
    for x in symbols:
        if out and x == pair[1] and out[-1] == pair[0]:
            out[-1] += x
        else:
            out.append(x)
    return out


def merge_window(fragments: Sequence[tuple[list[str], int]], floor: int, known: set[str], room: int) -> list[tuple[str, str]]:
    """Merges, most frequent pair first and ties by symbols, while the best pair counts more than ``floor``.

    Pair counts and the index from pairs to fragments are kept by difference: a merge touches the
    fragments that hold its pair. Ends after a merge that makes an already known symbol, as that
    adds to pairs outside the fragments.
    """
    words, weight = [list(f) for f, _ in fragments], [n for _, n in fragments]
    counts: dict[tuple[str, str], int] = defaultdict(int)
    where: dict[tuple[str, str], set[int]] = defaultdict(set)
    for i, word in enumerate(words):
        for pair in zip(word, word[1:]):
            counts[pair] += weight[i]
            where[pair].add(i)
    heap = [(-n, pair) for pair, n in counts.items() if n > floor]
    heapq.heapify(heap)
    merges: list[tuple[str, str]] = []
    made: set[str] = set()
    while heap and len(made) < room:
        n, best = heapq.heappop(heap)
        if -n != counts[best]:
            continue  # counted anew meanwhile, and offered with that count
        merges.append(best)
        symbol = best[0] + best[1]
        if symbol in known or symbol in made:
            break
        made.add(symbol)
        changed: set[tuple[str, str]] = set()
        for i in where.pop(best):
            old = words[i]
            new = words[i] = _with_merged(old, best)
            if len(new) == len(old):
                continue  # the pair has gone from this fragment before
            for pair in zip(old, old[1:]):
                counts[pair] -= weight[i]
                changed.add(pair)
            for pair in zip(new, new[1:]):
                counts[pair] += weight[i]
                where[pair].add(i)
                changed.add(pair)
        for pair in changed:
            if counts[pair] > floor:
                heapq.heappush(heap, (-counts[pair], pair))
    return merges


def _fragments(words: DataFrame, window: set[tuple[str, str]]) -> DataFrame:
    """``(fragment, n)``: the longest runs of symbols whose neighbours are all pairs of the window."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: dict[tuple[str, ...], int] = defaultdict(int)
            for symbols, n in zip(batch["symbols"], batch["n"]):
                symbols, start = list(symbols), 0
                for i in range(1, len(symbols) + 1):
                    if i == len(symbols) or (symbols[i - 1], symbols[i]) not in window:
                        if i - start > 1:
                            found[tuple(symbols[start:i])] += n
                        start = i
            if found:
                yield pd.DataFrame({"fragment": [" ".join(f) for f in found], "n": list(found.values())})

    return words.select("symbols", "n").mapInPandas(run, "fragment string, n long").groupBy("fragment").agg(F.sum("n").alias("n"))


def _merged_words(words: DataFrame, merges: Sequence[tuple[str, str]]) -> DataFrame:
    """``words`` after merges, and in ``pair`` ("lhs rhs") and ``change`` how pair counts change (null: untouched)."""
    ranks = {pair: i for i, pair in reversed(list(enumerate(merges)))}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            after, pairs, changes = [], [], []
            for symbols, n in zip(batch["symbols"], batch["n"]):
                new = apply_merges(list(symbols), ranks)
                after.append(new)
                if len(new) == len(symbols):
                    pairs.append(None)
                    changes.append(None)
                    continue
                delta: dict[tuple[str, str], int] = defaultdict(int)
                for pair in zip(symbols, symbols[1:]):
                    delta[pair] -= n
                for pair in zip(new, new[1:]):
                    delta[pair] += n
                pairs.append([" ".join(pair) for pair in delta])
                changes.append(list(delta.values()))
            if after:
                yield pd.DataFrame({"symbols": after, "n": batch["n"], "pair": pairs, "change": changes})

    return words.select("symbols", "n").mapInPandas(run, "symbols array<string>, n long, pair array<string>, change array<long>")


class _Window:
    """Which pairs a pass looks at: all that count more than a floor, as many as the driver's share allows.

    A pair made by merging has no more occurrences than the pair at the same place before, so pairs
    outside the window stay at the floor or below, and all that counts more is seen in the window's
    fragments. The width follows what the last passes could hold.
    """

    def __init__(self) -> None:
        self.width = WINDOW_PAIRS

    def next_merges(self, words: DataFrame, pairs: DataFrame, known: set[str], room: int, min_frequency: int) -> list[tuple[str, str]]:
        """The next merges of one-by-one merging, as many as one window shows."""
        ranked = pairs.filter(F.col("n") >= min_frequency).orderBy(F.desc("n"), "lhs", "rhs")
        top = [(r["lhs"], r["rhs"], r["n"]) for r in ranked.limit(self.width + 1).collect()]
        while top:
            complete = len(top) <= self.width
            floor = min_frequency - 1 if complete else top[self.width][2]
            window = [t for t in top if t[2] > floor]
            if not window:  # more pairs of the highest count than the window holds: all of that count at once
                floor = top[0][2] - 1
                window = [(r["lhs"], r["rhs"], r["n"]) for r in ranked.filter(F.col("n") > floor).limit(LEVEL_PAIRS + 1).collect()]
            rows = None
            if len(window) <= LEVEL_PAIRS:
                rows = _fragments(words, {(a, b) for a, b, _ in window}).limit(WINDOW_FRAGMENTS + 1).collect()
            if rows is not None and len(rows) <= WINDOW_FRAGMENTS:
                self.width = min(WINDOW_PAIRS, self.width * 2)
                return merge_window([(r["fragment"].split(" "), r["n"]) for r in rows], floor, known, room)
            if self.width == 1 or floor == top[0][2] - 1:
                return _independent(top, known, complete)[:room]
            self.width = max(1, min(self.width, len(top)) // 2)
        return []


def learn_merges(counts: DataFrame, vocab_size: int = VOCAB_SIZE, reserved: int = 0,
                 min_frequency: int = MIN_FREQUENCY) -> list[tuple[str, str]]:
    """Merges in order, most frequent pair first, ties by hex.

    Words and pair counts stay distributed. A pass brings the fragments of the leading pairs to the
    driver (``WINDOW_FRAGMENTS`` distinct ones at most), where the order of merges is settled; words
    are merged and pair counts changed by difference in tasks.
    """
    room = vocab_size - len(SPECIALS) - reserved - 256
    ship_package(counts.sparkSession)
    words = cut_lineage(counts.filter(F.length("pretoken") > 0).select(byte_symbols(F.col("pretoken")).alias("symbols"), "n"))
    if words.isEmpty():
        raise ValueError("no training texts")
    pairs = cut_lineage(pair_counts(words))
    merges: list[tuple[str, str]] = []
    known = {f"{b:02X}" for b in range(256)}
    window = _Window()
    while len(known) - 256 < room:
        found = window.next_merges(words, pairs, known, room - len(known) + 256, min_frequency)
        if not found:
            break
        merges += found
        known |= {a + b for a, b in found}
        words = cut_lineage(_merged_words(words, found))
        delta = words.select(F.explode(F.arrays_zip("pair", "change")).alias("d")).select(
            F.split("d.pair", " ")[0].alias("lhs"), F.split("d.pair", " ")[1].alias("rhs"), F.col("d.change").alias("n"))
        pairs = cut_lineage(pairs.unionByName(delta).groupBy("lhs", "rhs").agg(F.sum("n").alias("n")).filter("n > 0"))
    return merges


@dataclass(frozen=True)
class Vocabulary:
    """Ids: specials, reserved tokens, the 256 bytes, then merged symbols."""

    reserved: NameTable | None
    merges: tuple[tuple[str, str], ...]

    @property
    def first_byte(self) -> int:
        return len(SPECIALS) + (self.reserved.size if self.reserved else 0)

    def ids(self) -> dict[str, int]:
        names = [f"{b:02X}" for b in range(256)] + [a + b for a, b in self.merges]
        table: dict[str, int] = {}
        for name in names:
            table.setdefault(name, self.first_byte + len(table))
        return table

    @property
    def size(self) -> int:
        return self.first_byte + len(self.ids())

    def held(self) -> dict[str, int]:
        """Ids of reserved tokens, read in a worker."""
        return load(self.reserved).ident if self.reserved else {}

    def table(self, spark) -> DataFrame:
        """``(token_id, symbol, kind)``."""
        rows = [(i, t, "special") for i, t in enumerate(SPECIALS)]
        rows += [(i, t, "bytes") for t, i in self.ids().items()]
        out = spark.createDataFrame(rows, "token_id int, symbol string, kind string")
        if self.reserved is None:
            return out
        return out.unionByName(self.reserved.frame(spark).select(
            F.col("ident").cast("int").alias("token_id"), F.col("name").alias("symbol"), F.lit("reserved").alias("kind")))


def by_slices(batches: Iterator[pa.Array], fn: Callable[[list], list], kind: pa.DataType) -> Iterator[pa.Array]:
    """``fn`` over a few rows at a time: a batch stays Arrow, whose values take far less room than Python's."""
    for batch in batches:
        parts = [pa.array(fn(batch.slice(at, SLICE_ROWS).to_pylist()), kind) for at in range(0, len(batch), SLICE_ROWS)]
        yield pa.concat_arrays(parts) if parts else pa.array([], kind)


def by_values(batches: Iterator[pa.Array], fn: Callable[[pa.ListArray], pa.Array], kind: pa.DataType) -> Iterator[pa.Array]:
    """``fn`` over some rows of a list column at a time, ``SLICE_VALUES`` values as near as rows allow: what it makes of them is bounded."""
    for batch in batches:
        load, at, parts = np.cumsum(lengths(batch) + 1), 0, []
        while at < len(batch):
            end = max(int(np.searchsorted(load, (load[at - 1] if at else 0) + SLICE_VALUES, "right")), at + 1)
            parts.append(fn(batch.slice(at, end - at)))
            at = end
        yield pa.concat_arrays(parts) if parts else pa.array([], kind)


def spans(sizes: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Places of the parts ``taken``, one after the other, in an array where part ``i`` has ``sizes[i]`` values."""
    n = sizes[taken]
    return np.repeat((np.cumsum(sizes) - sizes)[taken] - (np.cumsum(n) - n), n) + np.arange(n.sum())


class _Merger:
    """``apply_merges`` on ids, for many words in step: a round merges one pair of every word that has one left."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.ids = vocabulary.ids()
        self.ranks: dict[tuple[str, str], int] = {}
        for no, pair in enumerate(vocabulary.merges):
            self.ranks.setdefault(pair, no)
        self.byte = np.array([self.ids[f"{b:02X}"] for b in range(256)], np.int64)
        self.wide = max(self.ids.values()) + 1
        pairs = [(self.ids[a] * self.wide + self.ids[b], no, self.ids[a + b])
                 for (a, b), no in self.ranks.items() if a in self.ids and b in self.ids]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 3)
        self.key, self.rank = table[:, 0].copy(), table[:, 1].copy()
        self.made = np.zeros(len(vocabulary.merges), np.int64)
        self.made[self.rank] = table[:, 2]

    def _ranked(self, lhs: np.ndarray, rhs: np.ndarray) -> np.ndarray:
        """Ranks of pairs, ``NEVER`` for those that are not merged; ids below 0 are none."""
        if not len(self.key):
            return np.full(lhs.shape, NEVER, np.int64)
        key = lhs * self.wide + rhs
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (lhs >= 0) & (rhs >= 0), self.rank[at], NEVER)

    def _in_step(self, words: list[bytes]) -> list[np.ndarray]:
        size = np.array([len(w) for w in words])
        there = np.arange(size.max()) < size[:, None]
        ids = np.full(there.shape, -1, np.int64)
        ids[there] = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        found, live = self._ranked(ids[:, :-1], ids[:, 1:]), np.arange(len(words))
        out: list[np.ndarray] = [NONE] * len(words)
        while len(live):
            least = found.min(axis=1, initial=NEVER)
            done = least == NEVER
            for no, word in zip(live[done].tolist(), ids[done]):
                out[no] = word[word >= 0].astype(np.int32)
            ids, found, live, least = ids[~done], found[~done], live[~done], least[~done]
            if not len(live):
                break
            at, each = found.argmin(axis=1), np.arange(len(live))
            ids[each, at] = self.made[least]
            rest = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, rest + (rest > at[:, None]), 1)
            rest = rest[:-1]
            found = np.take_along_axis(found, rest + (rest >= at[:, None]), 1)
            left, right = at > 0, at < len(rest)
            found[each[left], at[left] - 1] = self._ranked(ids[each[left], at[left] - 1], ids[each[left], at[left]])
            found[each[right], at[right]] = self._ranked(ids[each[right], at[right]], ids[each[right], at[right] + 1])
        return out

    def codes(self, words: Sequence[str]) -> list[np.ndarray]:
        """Ids of every word."""
        raw = [w.encode("utf-8") for w in words]
        out: list[np.ndarray] = [NONE] * len(raw)
        short = sorted((i for i, w in enumerate(raw) if 0 < len(w) <= SCANNED), key=lambda i: len(raw[i]))
        for at in range(0, len(short), STEP_WORDS):
            some = short[at:at + STEP_WORDS]
            for i, code in zip(some, self._in_step([raw[i] for i in some])):
                out[i] = code
        for i, w in enumerate(raw):
            if len(w) > SCANNED:
                out[i] = np.array([self.ids[p] for p in apply_merges([f"{b:02X}" for b in w], self.ranks)], np.int32)
        return out


def _encode_udf(vocabulary: Vocabulary, cache_size: int = 1 << 18):
    @F.arrow_udf("array<int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held, merger = vocabulary.held(), _Merger(vocabulary)
        cache = {w: np.array([i], np.int32).tobytes() for w, i in held.items()}

        def coded(texts: pa.ListArray) -> pa.Array:
            words, count = texts.flatten().dictionary_encode(), lengths(texts)
            distinct = words.dictionary.to_pylist()
            new = [w for w in distinct if w not in cache]
            fresh = dict(zip(new, [c.astype(np.int32).tobytes() for c in merger.codes(new)]))
            codes = [cache[w] if w in cache else fresh[w] for w in distinct]
            for w, code in fresh.items():
                if len(cache) >= cache_size + len(held):
                    break
                cache[w] = code
            size, word = np.array([len(c) // 4 for c in codes], np.int64), words.indices.to_numpy(zero_copy_only=False)
            flat = np.frombuffer(b"".join(codes), np.int32)[spans(size, word)]
            upto = np.concatenate(([0], np.cumsum(size[word])))[np.concatenate(([0], np.cumsum(count)))]
            return pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(flat, pa.int32()))

        yield from by_values(batches, coded, pa.list_(pa.int32()))

    return run


def encode_texts(texts: DataFrame, vocabulary: Vocabulary, text: str = "text",
                 max_positions: int | None = MAX_POSITIONS, pad: bool = False) -> DataFrame:
    """Add ``ids``: [CLS] ids [SEP], cut to ``max_positions`` if given, padded right on demand.

    A narrow pass: pre-tokens are cut in the JVM, the distinct ones of some texts at a time are looked up with
    a bounded memo of words already encoded. A pre-token has one id at least, so what lies beyond
    ``max_positions`` of them is not encoded.
    """
    words = pretokens(F.col(text), vocabulary.reserved)
    raw = _encode_udf(vocabulary)(words if max_positions is None else F.slice(words, 1, max_positions))
    framed = F.concat(F.array(F.lit(CLS)), F.col("_raw"), F.array(F.lit(SEP)))
    out = texts.withColumn("_raw", raw).withColumn("ids", framed)
    if max_positions is not None:
        out = out.withColumn("ids", F.slice("ids", 1, max_positions))
        if pad:
            out = out.withColumn("ids", F.concat("ids", F.array_repeat(F.lit(PAD), F.lit(max_positions) - F.size("ids"))))
    return out.drop("_raw")


def pretrain_rows(items: DataFrame, features: DataFrame, vocabulary: Vocabulary, seed, ratio: float,
                  text: str = "text", ident: str = "item_id") -> DataFrame:
    """``(item_idx, ids, features, heldout)`` for masked training."""
    from ..functions.hashing import hash_split

    coded = encode_texts(items, vocabulary, text, pad=True)
    return coded.join(features, "item_idx").select(
        "item_idx", "ids", "features", hash_split(seed, F.col(ident), ratio).alias("heldout"))


def decoder(vocabulary: Vocabulary, held: dict[int, str] | None = None) -> Callable[[Iterable[int]], str]:
    """A function from encoded ids to their text without specials; ``held`` names reserved tokens by id.

    The tables are built once, here.
    """
    raw = {i: bytes.fromhex(t) for t, i in vocabulary.ids().items()}
    held = {i: t for t, i in vocabulary.held().items()} if held is None else held

    def text(ids: Iterable[int]) -> str:
        out: list[str] = []
        run: list[bytes] = []
        for i in ids:
            symbol = raw.get(i)
            if symbol is not None:
                run.append(symbol)
                continue
            if run:
                out.append(b"".join(run).decode("utf-8", "replace"))
                run = []
            if i >= len(SPECIALS):
                out.append(held[i])
        out.append(b"".join(run).decode("utf-8", "replace"))
        return "".join(out)

    return text


def batch_decoder(vocabulary: Vocabulary) -> Callable[[pa.ListArray], pa.Array]:
    """``decoder`` for many texts at once: the bytes of all ids are put together from one table."""
    held = {i: t for t, i in vocabulary.held().items()}
    plain = decoder(vocabulary, held)
    parts = [b""] * max(vocabulary.size, len(SPECIALS) + 1)
    for symbol, i in vocabulary.ids().items():
        parts[i] = bytes.fromhex(symbol)
    for i, t in held.items():
        parts[i] = parts[i] or t.encode()
    size = np.array([len(x) for x in parts], np.int64)
    table = np.frombuffer(b"".join(parts), np.uint8)

    def read(texts: pa.ListArray) -> pa.Array:
        count = lengths(texts)
        ids = texts.flatten().to_numpy(zero_copy_only=False)
        if len(ids) and ids.max() >= len(parts):
            raise KeyError(int(ids.max()))
        first = np.cumsum(count) - count
        special = ids < len(SPECIALS)
        special[first[count > 0]] = special[(first + count - 1)[count > 0]] = False
        data = table[spans(size, ids)]
        upto = np.concatenate(([0], np.cumsum(size[ids])))[np.concatenate(([0], np.cumsum(count)))]
        raw = pa.Array.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(upto.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())])
        if not special.any():  # one within a text ends a run of bytes
            try:
                return raw.cast(pa.large_string()).cast(pa.string())
            except pa.ArrowInvalid:
                pass
        return pa.array([plain(t or ()) for t in texts.to_pylist()], pa.string())

    return read


def decode(ids: Iterable[int], vocabulary: Vocabulary, held: dict[int, str] | None = None) -> str:
    """Text of the ids of one text."""
    return decoder(vocabulary, held)(ids)
