"""MinHash near-duplicates: bottom-k sketches from one hash function, inverted lists, exact Jaccard.

1. Every whole text becomes its set of word shingles, hashed once to 64 bits; the ``SKETCH``
   smallest values are its sketch. Equal word sequences form a class, told by a digest; only
   the class's smallest id goes on.
2. The ``INDEX`` smallest values are inverted lists. Two sets with a Jaccard likeness of 0.8
   miss each other in all lists with probability ``0.2 ** INDEX``. Lists of up to
   ``LIST_LIMIT`` members generate their pairs.
3. Longer lists are not expanded at first. Texts for which the long lists hold ``HOT_PART`` of
   the index or more are linked to the smallest id of each of their lists, which settles most of
   a cluster of near copies of any size at a bounded cost per text.
4. Bottom-k estimates from the union of two sketches filter the candidates, the best candidate
   of each text is verified on full sets, and texts joined so far form components.
5. What long lists leave is compared in full. Near copies share ``NEED`` index values (or all but
   a fifth of a small set) but with probability 1e-7. Those that are not told by two short lists
   share all but one of these in long lists, and so one of the rarest long values of both; every
   text with that many long values takes part, however many own values it has. Lists of those values, cut by classes of size, are dealt into blocks, and every
   block meets every other with its full sets, once texts are gone of whose shingles too few occur in any other: all pairs of different components that share enough
   of the index are verified there. So are, by themselves, the pairs that step 4 left. Lists within one component are skipped; others cost the square of
   their length, spread over blocks.
6. Components come from repeated contraction; nothing is collected.

Null, empty and blank texts have no shingles, link to nothing and stay. Texts with fewer words
than a shingle have their whole sequence as the only one. Rows that repeat a ``doc_id`` are
judged by their own text. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import map_frames, stage, texts_of, unstage

WIDTH = 5
#: Likeness from which two sets are linked, in per cent.
PERCENT = 80
SKETCH, INDEX, LIST_LIMIT, HOT_PART = 64, 24, 32, 0.6
#: Index values that two texts share, at a likeness of 0.8, but with probability 1e-7.
NEED = 8
#: Members of a block of a long list; all pairs of blocks are compared, each in a group of its own.
BLOCK = 512
#: Pairs of a block whose rare values are compared at once.
PAIRS_AT_ONCE = 4096
#: An estimate from 64 values has a standard error of 0.05 at 0.8; pairs five of them below go.
ESTIMATE_FLOOR = 0.55
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_ODD = 0x9E3779B97F4A7C15
_PAD = np.iinfo(np.int64).max


class WordCodes(dict):
    """64-bit codes of words, computed once each while they fit."""

    def __missing__(self, word: bytes) -> int:
        code = xxhash.xxh64_intdigest(word)
        if len(self) < 150_000:
            self[word] = code
        return code


def shingle_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split()


def shingle_set(words: list[bytes], width: int, codes: WordCodes) -> np.ndarray:
    """The sorted distinct hash values of the shingles, as signed 64-bit numbers."""
    if not words:
        return np.empty(0, dtype=np.int64)
    take = min(width, len(words))
    ids = np.fromiter((codes[w] for w in words), dtype=np.uint64, count=len(words))
    n = len(words) - take + 1
    mixed = np.full(n, take if take == width else take + 1000, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(take):
            mixed = (mixed ^ ids[i:i + n]) * np.uint64(_ODD)
            mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed.view(np.int64))


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, digest, n_shingles, sketch`` of every whole text."""
    codes = WordCodes()

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        digests, counts, lows = [], [], []
        for text in batch["text"]:
            words = shingle_words(text)
            values = shingle_set(words, width, codes)
            digests.append(hashlib.sha256(b" ".join(words)).digest())
            counts.append(len(values))
            lows.append(values[:SKETCH])
        return pd.DataFrame({"doc_id": batch["doc_id"], "digest": digests, "n_shingles": counts, "sketch": lows})

    return map_frames(texts_of(docs), run, "doc_id long, digest binary, n_shingles long, sketch array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``doc_id, packed`` (sorted values as bytes) of the wanted ids."""
    codes = WordCodes()

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": batch["doc_id"],
                             "packed": [shingle_set(shingle_words(t), width, codes).tobytes() for t in batch["text"]]})

    # The ids grow with the corpus: never a broadcast, whatever their planned size.
    few = texts_of(docs).join(wanted.hint("merge"), "doc_id", "left_semi")
    return map_frames(few, run, "doc_id long, packed binary")


def _list_pairs(lists: DataFrame) -> DataFrame:
    """``a, b`` (a < b) of all lists ``m: array<struct<doc, n>>``, sizes within reach of the limit."""
    near = f"least(x.n, y.n) * 100 >= greatest(x.n, y.n) * {PERCENT}"
    pairs = F.expr(f"""flatten(transform(m, (x, i) -> transform(
        filter(slice(m, i + 2, size(m)), y -> y.doc <> x.doc and {near}), y -> struct(x.doc as a, y.doc as b))))""")
    return lists.select(F.explode(pairs).alias("p")).select("p.a", "p.b")


def _collected(members: DataFrame, key: str) -> DataFrame:
    return members.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("doc", "n"))).alias("m"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("doc", "c").alias("a"), F.greatest("doc", "c").alias("b"))


def _least_long(n: str) -> F.Column:
    """Values of long lists that two near copies share which share at most one of short lists (none if small)."""
    return F.greatest(F.lit(1), F.least(F.lit(NEED), F.ceil(F.col(n) * PERCENT / 100).cast("int")) - 1)


def candidate_pairs(reps: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``a, b`` for the representatives ``doc, n, sketch``, and those with values of long lists to compare (``long``)."""
    index = reps.select(F.explode(F.slice("sketch", 1, INDEX)).alias("value"), "doc", "n")
    lengths = index.groupBy("value").agg(F.count("*").alias("length"), F.min("doc").alias("first")).filter("length > 1")
    members = stage(index.join(lengths, "value"), "near-lists")
    short = _list_pairs(_collected(members.filter(F.col("length") <= LIST_LIMIT), "value"))
    # Larger sets that share fewer than two short lists share long ones, which are compared below.
    sizes = reps.select(F.col("doc").alias("a"), F.col("n").alias("n_a")).distinct()
    met = short.groupBy("a", "b").agg(F.count("*").alias("met"))
    met = met.join(sizes, "a").filter((F.col("met") > 1) | (F.col("n_a") < INDEX)).select("a", "b")
    long = members.filter(F.col("length") > LIST_LIMIT)
    held = long.groupBy("doc", "n").agg(F.transform(F.array_sort(F.collect_list(F.struct("length", "value"))),
                                                    lambda x: x["value"]).alias("long"))
    # Pairs that miss the rule of short lists share at least so many values of long ones.
    common = stage(reps.join(held.filter(F.size("long") >= _least_long("n")), ["doc", "n"]), "near-common")
    hot = common.filter(F.size("long") >= HOT_PART * F.least(F.col("n"), F.lit(INDEX))).select("doc").distinct()
    stars = long.join(hot, "doc", "left_semi").select("doc", F.col("first").alias("c"))
    return met.unionByName(_ordered(stars.filter("c <> doc"))).distinct(), common


def _padded(rows: list, width: int) -> np.ndarray:
    out = np.full((len(rows), width), _PAD, dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _linked_in_cell(value: int, cell: int, low: pd.DataFrame, high: pd.DataFrame, same: bool) -> pd.DataFrame:
    """``a, b`` of the near copies between two blocks of a cell that this cell has to tell."""
    sets = [[np.frombuffer(p, dtype=np.int64) for p in f["packed"]] for f in (low, high)]
    codes, known = pd.factorize(np.concatenate([_padded([s[:INDEX] for s in side], INDEX) for side in sets]).ravel())
    codes = codes.reshape(-1, INDEX)
    use = np.zeros((2, len(known)), dtype=bool)
    use[0, codes[:len(low)]] = True
    use[1, codes[len(low):]] = True
    both = np.flatnonzero(use.all(axis=0) & (known != _PAD))
    column = np.full(len(known), len(both))
    column[both] = np.arange(len(both))
    marks = np.zeros((len(codes), len(both) + 1), dtype=np.float32)
    marks[np.arange(len(codes))[:, None], column[codes]] = 1
    shared = marks[:len(low), :-1] @ marks[len(low):, :-1].T
    n_x, n_y = low["n"].to_numpy()[:, None], high["n"].to_numpy()[None, :]
    most = np.maximum(n_x, n_y)
    keep = (np.minimum(n_x, n_y) * 100 >= most * PERCENT) & (shared >= np.minimum(NEED, -(-most * PERCENT // 100)))
    keep &= low["at"].to_numpy()[:, None] != high["at"].to_numpy()[None, :]
    # Two texts of the lower class of sizes meet in the cell of that class.
    keep &= (low["class"].to_numpy()[:, None] == cell) | (high["class"].to_numpy()[None, :] == cell)
    i, j = np.nonzero(np.triu(keep, 1) if same else keep)
    # Of several cells, the one of the first value in common tells the pair.
    width = max(1, *(len(r) for f in (low, high) for r in f["rare"]))
    rare = [_padded(list(f["rare"]), width) for f in (low, high)]
    tell = np.zeros(len(i), dtype=bool)
    for start in range(0, len(i), PAIRS_AT_ONCE):
        left, right = rare[0][i[start:start + PAIRS_AT_ONCE]], rare[1][j[start:start + PAIRS_AT_ONCE]]
        first = np.full(len(left), _PAD)
        for k in reversed(range(width)):
            hit = (left[:, k:k + 1] == right).any(axis=1) & (left[:, k] != _PAD)
            first[hit] = left[hit, k]
        tell[start:start + PAIRS_AT_ONCE] = first == value
    i, j = i[tell], j[tell]
    a, b = [], []
    if len(i):
        docs = [f["doc"].to_numpy() for f in (low, high)]
        whole, known = pd.factorize(np.concatenate(sets[0] + sets[1]))
        cut = np.split(whole, np.cumsum([len(s) for s in sets[0] + sets[1]])[:-1])
        held = np.zeros(len(known), dtype=bool)
        for x in np.unique(i):
            others = j[i == x]
            held[cut[x]] = True
            far = [cut[len(low) + y] for y in others]
            sizes = np.array([len(c) for c in far])
            common = np.add.reduceat(held[np.concatenate(far)].astype(np.int64), np.cumsum(sizes) - sizes)
            held[cut[x]] = False
            for y in others[100 * common >= PERCENT * (len(cut[x]) + sizes - common)]:
                a.append(min(docs[0][x], docs[1][y]))
                b.append(max(docs[0][x], docs[1][y]))
    out = pd.DataFrame({"a": np.array(a, dtype=np.int64), "b": np.array(b, dtype=np.int64)})
    return out[out["a"] != out["b"]]


def _open_lists(cells: DataFrame) -> DataFrame:
    """``value, cell, length``; a cell within one component, or without texts of its own class, has nothing to tell."""
    lists = cells.groupBy("value", "cell").agg(
        F.count("*").alias("length"), F.min("at").alias("low"), F.max("at").alias("high"), F.max("class").alias("top"))
    return lists.filter("low <> high and top = cell").select("value", "cell", "length")


def _with_company(live: DataFrame, sets: DataFrame) -> DataFrame:
    """``doc, n`` of the texts whose full sets have enough in common with all others of ``live``.

    A near copy has ``PERCENT`` of a text's shingles, so a text of which fewer occur in any other has
    none. This leaves out, exactly, what only shares a passage or comes from a group by many changes.
    """
    packed = sets.select(F.col("doc_id").alias("doc"), (F.length("packed") / 8).cast("long").alias("n"), "packed").distinct()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 64):
                part = batch.slice(row, 64)
                n = part.column(1).to_numpy()
                values = np.frombuffer(b"".join(part.column(2).to_pylist()), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column(0).to_numpy(), n)), pa.array(np.repeat(n, n)), pa.array(values)], ["doc", "n", "value"])

    held = stage(live.join(packed, ["doc", "n"]).select("doc", "n", "packed").mapInArrow(unpack, "doc long, n long, value long"), "near-values")
    met = held.groupBy("value").agg(F.count("*").alias("texts")).filter("texts > 1").select("value")
    counts = held.join(met.hint("merge"), "value", "left_semi").groupBy("doc", "n").agg(F.count("*").alias("shared"))
    told = stage(counts.filter(F.col("shared") * 100 >= F.col("n") * PERCENT).select("doc", "n"), "near-told")
    unstage(held)
    return told


def _by_family(cells: DataFrame, placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells and places with one list per family of texts in place of its lists, where that is less to compare.

    Texts that share a list, directly or over others, are a family. The texts of a large group share
    nearly all their lists, so they would meet in each of them; as a family they meet once.
    """
    cells = stage(cells, "near-open")
    family = components(cells.select(F.col("doc").alias("a"), F.col("value").alias("b"))).select(
        F.col("node").alias("doc"), F.col("component").alias("family"))
    cells = stage(cells.join(family, "doc"), "near-family-cells")
    once = cells.select("family", "doc", "n", "at", "class", "cell").distinct()
    apart = cells.groupBy("family", "value", "cell").count().groupBy("family").agg(F.sum(F.col("count") * F.col("count")).alias("apart"))
    whole = once.groupBy("family", "cell").count().groupBy("family").agg(F.sum(F.col("count") * F.col("count")).alias("whole"))
    joint = stage(apart.join(whole, "family").filter("whole <= apart").select("family", F.lit(True).alias("joint")), "near-joint")
    names = ("doc", "n", "at", "value", "class", "cell")
    kept = cells.join(joint, "family", "left_anti").select(*names)
    met = once.join(joint, "family", "left_semi").withColumn("value", F.col("family")).select(*names)
    told = once.join(joint, "family", "left_semi").select("doc", "n", "family").distinct()
    places = placed.join(told, ["doc", "n"], "left").withColumn(
        "rare", F.when(F.col("family").isNotNull(), F.array("family")).otherwise(F.col("rare"))).drop("family")
    return stage(kept.unionByName(met), "near-cells"), stage(places, "near-placed")


def block_links(common: DataFrame, joined: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b`` of all near copies of ``common`` that lie in different components of ``node, component``.

    ``common`` has the values of long lists, the shortest list first, in ``long``; whole sets go
    with the blocks, so that pairs are verified where they meet and only links leave a block.
    """
    ship_package(common.sparkSession)
    # Texts that share ``least`` of their long values share one of the rare ones.
    least = _least_long("n")
    rare = F.expr("slice(long, 1, greatest(size(long) - least + 1, 0))")
    placed = common.join(joined, F.col("doc") == F.col("node"), "left").withColumn("least", least).select(
        "doc", "n", rare.alias("rare"), F.coalesce("component", "doc").alias("at"),
        F.floor(F.log("n") / math.log(100 / PERCENT) * (1 - 1e-9)).cast("int").alias("class"))
    placed = stage(placed.filter(F.size("rare") > 0), "near-placed")
    cells = placed.select("doc", "n", "at", F.explode("rare").alias("value"), "class").withColumn(
        "cell", F.explode(F.array(F.col("class"), F.col("class") + 1)))
    cells = stage(cells, "near-cells")
    live = stage(cells.join(_open_lists(cells), ["value", "cell"], "left_semi").select("doc", "n").distinct(), "near-live")
    cells = stage(cells.join(_with_company(live, sets), ["doc", "n"], "left_semi"), "near-cells")
    cells, placed = _by_family(cells.join(_open_lists(cells).select("value", "cell"), ["value", "cell"]), placed)
    lists = _open_lists(cells).select("value", "cell", F.ceil(F.col("length") / BLOCK).cast("int").alias("blocks"))
    dealt = cells.join(lists, ["value", "cell"]).withColumn("block", F.pmod(F.xxhash64("doc", "n"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("value", "cell", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"), "block", "doc", "n")
    dealt = dealt.join(placed, ["doc", "n"]).join(
        sets.select(F.col("doc_id").alias("doc"), (F.length("packed") / 8).cast("long").alias("n"), "packed").distinct(), ["doc", "n"])

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        value, cell, x, y = (int(k) for k in key)
        low = rows[rows["block"] == x]
        return _linked_in_cell(value, cell, low, low if x == y else rows[rows["block"] == y], x == y)

    return dealt.groupBy("value", "cell", "x", "y").applyInPandas(run, "a long, b long").distinct()


def estimated(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs whose likeness, estimated from the smallest values of the union, may reach the limit."""
    side = lambda x: reps.select(F.col("doc").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("s_a", "s_b")), 1, SKETCH)
    shared = F.size(F.array_intersect(F.array_intersect(F.col("union"), F.col("s_a")), F.col("s_b")))
    out = both.withColumn("union", union).select(
        "a", "b", "n_a", "n_b", (shared / F.size("union")).alias("estimate"))
    in_reach = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * PERCENT
    return out.filter(in_reach & (F.col("estimate") >= ESTIMATE_FLOOR)).select("a", "b", "estimate")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the limit."""

    def run(batch: pd.DataFrame) -> pd.DataFrame:
        keep = []
        for x, y in zip(batch["x"], batch["y"], strict=True):
            x, y = np.frombuffer(x, dtype=np.int64), np.frombuffer(y, dtype=np.int64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both))
        return batch.loc[keep, ["a", "b"]]

    joined = pairs.select("a", "b").join(sets.select(F.col("doc_id").alias("a"), F.col("packed").alias("x")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("packed").alias("y")), "b")
    return map_frames(joined.select("a", "b", "x", "y"), run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node reachable) for all nodes of ``a, b`` links.

    Every node moves to its neighbour of least hash if that is less than its own; links between
    the places they moved to make the next, smaller graph. Local minima stay, so a share of
    the nodes goes in every round, whatever the degrees; a hub is aggregated map-side.
    """
    moves: list[DataFrame] = []
    current = stage(links.filter("a <> b").distinct(), "links")
    while not current.isEmpty():
        # A fixed order lets stars collapse at once; another one every few rounds undoes bad luck.
        rank = lambda c, seed=len(moves) // 6: F.xxhash64(F.lit(seed), F.col(c))
        ends = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ends.groupBy("a").agg(F.min(F.struct(rank("b").alias("r"), F.col("b"))).alias("m"))
        step = stage(least.select(F.col("a").alias("node"), F.when(F.col("m.r") < rank("a"), F.col("m.b")).otherwise(
            F.col("a")).alias("to")), "moves")
        moves.append(step)
        nxt = current.join(step.select(F.col("node").alias("a"), F.col("to").alias("c")), "a").join(
            step.select(F.col("node").alias("b"), F.col("to").alias("d")), "b")
        nxt = stage(nxt.filter("c <> d").select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct(), "links")
        unstage(current)
        current = nxt
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    reach = moves[0]
    for step in moves[1:]:
        later = step.select(F.col("node").alias("to"), F.col("to").alias("then"))
        reach = reach.join(later, "to", "left").select("node", F.coalesce("then", "to").alias("to"))
    reach = stage(reach, "reach")
    smallest = reach.groupBy("to").agg(F.min("node").alias("component"))
    return reach.join(smallest, "to").select("node", "component")


def duplicate_components(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    signed = stage(sketches(docs, width), "near-sketches")
    classes = stage(signed.filter("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("rep")), "near-classes")
    reps = signed.join(classes, (signed["digest"] == classes["digest"]) & (signed["doc_id"] == classes["rep"]), "left_semi")
    reps = stage(reps.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch"), "near-reps")
    candidates, common = candidate_pairs(reps)
    pairs = stage(estimated(candidates, reps), "near-pairs")
    ends = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).unionByName(
        common.select(F.col("doc").alias("doc_id"))).distinct()
    sets = stage(full_sets(docs, ends, width), "near-sets")
    best = pairs.groupBy("b").agg(F.max(F.struct("estimate", (-F.col("a")).alias("minus"))).alias("m"))
    first = stage(verified(best.select((-F.col("m.minus")).alias("a"), "b"), sets), "near-first")
    joined = stage(components(first), "near-joined")
    place = lambda x: joined.select(F.col("node").alias(x), F.col("component").alias(f"c_{x}"))
    open_pairs = pairs.join(place("a"), "a", "left").join(place("b"), "b", "left").filter(
        F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")
    second = stage(verified(open_pairs, sets).unionByName(block_links(common, joined, sets)), "near-second")
    joined = stage(components(first.unionByName(second)), "near-components")
    named = stage(classes.join(joined, F.col("rep") == F.col("node"), "left").select(
        F.col("digest").alias("of"), F.coalesce("component", "rep").alias("component")), "near-named")
    found = signed.select("doc_id", "digest", "n_shingles").join(named, F.col("digest") == F.col("of"), "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents, in their own columns, with the smallest id of each component kept.

    Ids to drop are a table of their own; rows that repeat an id stay or go together.
    """
    gone = stage(duplicate_components(docs, width).filter(~F.col("kept")).select(
        F.col("doc_id").alias("_gone")).distinct(), "near-gone")
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
