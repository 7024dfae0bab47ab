"""Ranked lexical search by pipelined term partitioning.

Texts are read once. Up to ``SHARD_DOCS`` documents form a shard, and per shard and term one block
of (document in shard, occurrences) is written. Terms belong to owners: runs of document frequency,
the rarest terms first. Queries (items) are dealt into bundles. A bundle's accumulators for a shard
start empty and travel through the owners: at each, they meet by cogroup the blocks of the terms
that the bundle asks for, whose integer contributions are added, and go on to the next owner. After
the last, each (bundle, shard) gives its best documents per item, and the best of those remain.

Accumulators are sparse: (item, document) cells with their sum. A cell that cannot reach the k-th
best sum of its item in its shard, even with all that later owners could add, is let go; equal sums
stay, so the result is that of adding everything.

A term's weight is floor(1000 ln((2N+2) / (2df+1))), a document's m is 75 + (25 n N) div L, and a
score sums weight * ((10^9 tf) div (1000 tf + 12 m)), all in 64-bit integers after the logarithm.

Null and empty texts have no terms and do not count in N; items without terms, or met by no
document, have no rows. Repeated rows are documents of their own, with one rank each; equal scores
go by ascending ``doc_id``, null ids last. A repeated ``item_id`` gives each of its rows a list. Only
a bit filter of fixed size is sent to the tasks that read texts; it lets other terms through where
it is crowded, and the join on terms drops them.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import BATCH_ROWS, stage

TOP = 20
#: Items of a bundle; documents of a shard, and its postings; owners of terms.
BUNDLE_ITEMS, SHARD_DOCS, SHARD_POSTINGS, OWNERS = 64, 16_384, 4_000_000, 4
#: Slots of the filter of item terms.
FILTER_SLOTS = 1 << 20
#: More than any (10^9 tf) div (1000 tf + 12 m).
MOST_PER_TERM = 1_000_000
#: Letters and digits of ASCII, and all bytes of other characters; A-Z are lowered before.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")

_BLOCKS = "shard long, term string, docs binary, counts binary, ids array<long>, n_docs long, n_terms long"
_STATE = "bundle long, shard long, sizes binary, n_items int, rest binary, cells binary, sums binary"


def terms_of(text: str | None) -> list[bytes]:
    return _TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """``(bundle, place, item_id, term, times)``: each item's terms, and its place in its bundle."""
    spark = items.sparkSession
    ship_package(spark)
    rows = stage(items.select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"),
        F.col("text").cast("string").alias("text")), "search-items")
    bundles = max(1, math.ceil(rows.count() / BUNDLE_ITEMS))
    dealt = rows.withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles))).withColumn(
        "place", (F.row_number().over(Window.partitionBy("bundle").orderBy("item")) - 1).cast("int"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, terms, times = [], [], []
            for i, text in enumerate(batch.column(3).to_pylist()):
                for term, n in Counter(terms_of(text)).items():
                    at.append(i)
                    terms.append(term.decode("utf-8", "surrogatepass"))
                    times.append(n)
            fixed = [batch.column(j).take(pa.array(at, pa.int64())) for j in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*fixed, pa.array(terms, pa.string()), pa.array(times, pa.int64())], ["bundle", "place", "item_id", "term", "times"])

    return stage(dealt.select("bundle", "place", "item_id", "text").mapInArrow(
        run, "bundle long, place int, item_id long, term string, times long"), "search-item-terms")


def shard_blocks(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Blocks of postings of the wanted terms, and a head row (term null) per shard with ids and sizes."""
    slots = wanted.select((F.crc32("term") % FILTER_SLOTS).cast("int").alias("slot")).distinct()
    bits = bytearray(FILTER_SLOTS)  # at most FILTER_SLOTS rows come here
    for (slot,) in slots.toLocalIterator():
        bits[slot] = 1
    shared = docs.sparkSession.sparkContext.broadcast(bytes(bits))
    names = [part.split()[0] for part in _BLOCKS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.int64()]

    def rows(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, first = shared.value, TaskContext.get().partitionId() << 32
        shards = 0
        ids: list[int | None] = []
        sizes, postings, entries = array("q"), {}, 0

        def close() -> Iterator[pa.RecordBatch]:
            shard = first + shards
            yield rows([[shard], [None], [None], [sizes.tobytes()], [ids], [sum(1 for n in sizes if n)], [sum(sizes)]])
            listed = list(postings.items())
            for at in range(0, len(listed), 1000):
                part = listed[at:at + 1000]
                none = [None] * len(part)
                yield rows([[shard] * len(part), [t.decode("utf-8", "surrogatepass") for t, _ in part],
                            [p[0].tobytes() for _, p in part], [p[1].tobytes() for _, p in part], none,
                            [len(p[0]) for _, p in part], none])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                terms = terms_of(text)
                for term, n in Counter(terms).items():
                    if bits[zlib.crc32(term) % FILTER_SLOTS]:
                        if term not in postings:
                            postings[term] = (array("H"), array("I"))
                        postings[term][0].append(len(ids))
                        postings[term][1].append(n)
                        entries += 1
                ids.append(doc_id)
                sizes.append(len(terms))
                if len(ids) == SHARD_DOCS or entries >= SHARD_POSTINGS:
                    yield from close()
                    shards += 1
                    ids, sizes, postings, entries = [], array("q"), {}, 0
        if ids:
            yield from close()

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stage(texts.mapInArrow(run, _BLOCKS), "search-blocks")


def weighed_terms(wanted: DataFrame, blocks: DataFrame, n_docs: int) -> DataFrame:
    """``(bundle, term, places, times, weight, owner)`` of the terms that any document holds and that weigh."""
    found = blocks.filter(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n_docs").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(float(n_docs)) + 2) / (2 * F.col("df").cast("double") + 1)))
    asked = wanted.groupBy("bundle", "term").agg(F.collect_list(F.struct("place", "times")).alias("asked"))
    known = stage(asked.join(found.withColumn("weight", weight.cast("long")).filter("weight > 0"), "term"), "search-terms")
    volume = known.groupBy(F.log2("df").cast("int").alias("level")).agg(F.sum("df").alias("n")).orderBy("level").collect()
    total, passed, owner_of = sum(r["n"] for r in volume), 0, {}
    for row in volume:  # one row per power of two
        owner_of[row["level"]] = min(OWNERS - 1, OWNERS * passed // max(1, total))
        passed += row["n"]
    owner = F.coalesce(*[F.when(F.log2("df").cast("int") == level, F.lit(o)) for level, o in owner_of.items()], F.lit(0))
    return known.select("bundle", "term", F.col("asked.place").alias("places"), F.col("asked.times").alias("times"),
                        "weight", owner.alias("owner"))


def _pack(cells: np.ndarray, sums: np.ndarray) -> tuple[bytes, bytes]:
    """Cells as steps and sums by byte planes: mostly small numbers, which the shuffle compresses well."""
    steps = np.diff(cells, prepend=0).astype("<i4")
    return steps.tobytes(), np.ascontiguousarray(sums.astype("<i8").view("u1").reshape(-1, 8).T).tobytes()


def _unpack(cells: bytes, sums: bytes) -> tuple[np.ndarray, np.ndarray]:
    at = np.cumsum(np.frombuffer(cells, "<i4"), dtype=np.int64)
    planes = np.frombuffer(sums, "u1").reshape(8, -1)
    return at, np.ascontiguousarray(planes.T).view("<i8").ravel()


def _owner_stage(owner: int, n_docs: int, n_terms: int, top: int):
    """The function of one stage: a bundle's accumulators of a shard meet the owner's blocks."""

    def add(state: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        head = state.iloc[0]
        sizes = np.frombuffer(head["sizes"], "<i8")
        width, items = len(sizes), int(head["n_items"])
        scores = np.zeros(items * width, np.int64)
        cells, sums = _unpack(head["cells"], head["sums"])
        scores[cells] = sums
        scores = scores.reshape(items, width)
        slack = 12 * (75 + 25 * sizes * n_docs // max(1, n_terms))
        for docs, counts, places, times, weight in zip(blocks["docs"], blocks["counts"], blocks["places"], blocks["times"], blocks["weight"]):
            at, tf = np.frombuffer(docs, "<u2"), np.frombuffer(counts, "<u4").astype(np.int64)
            gain = weight * (1_000_000_000 * tf // (1000 * tf + slack[at]))
            for place, n in zip(places, times):
                scores[place, at] += n * gain
        rest = np.frombuffer(head["rest"], "<i8").reshape(-1, items)[owner]
        if width > top:
            kth = np.partition(scores, width - top, axis=1)[:, width - top]
            scores[scores < (kth - rest)[:, None]] = 0
        left = np.flatnonzero(scores)
        packed = _pack(left, scores.ravel()[left])
        return state.assign(cells=[packed[0]], sums=[packed[1]])

    return add


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``top`` documents of the highest scores above 0."""
    spark = docs.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    wanted = item_terms(items)
    blocks = shard_blocks(docs, wanted)
    heads = blocks.filter(F.col("term").isNull())
    n_docs, n_terms = heads.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    terms = weighed_terms(wanted, blocks, n_docs)

    # Per bundle: its items, and what the owners after each could still add to an item.
    bounds = terms.select("bundle", "owner", "weight", F.explode(F.arrays_zip("places", "times")).alias("a")).groupBy(
        "bundle", "owner", F.col("a.places").alias("place")).agg(F.sum(F.col("weight") * F.col("a.times") * MOST_PER_TERM).alias("most"))

    def lay_out(frame: pd.DataFrame) -> pd.DataFrame:
        items = int(frame["place"].max()) + 1
        most = np.zeros((OWNERS, items), np.int64)
        most[frame["owner"], frame["place"]] = frame["most"]
        rest = most[::-1].cumsum(axis=0)[::-1] - most
        return pd.DataFrame({"bundle": [frame["bundle"].iloc[0]], "n_items": [items], "rest": [rest.astype("<i8").tobytes()]})

    bundles = stage(bounds.groupBy("bundle").applyInPandas(lay_out, "bundle long, n_items int, rest binary"), "search-bundles")
    last = bundles.agg(F.coalesce(F.max("bundle"), F.lit(0))).first()[0]
    none = F.lit(b"")
    start = heads.select("shard", F.col("counts").alias("sizes"),
                         F.explode(F.sequence(F.lit(0), F.lit(last).cast("long"))).alias("bundle"))
    state = start.join(bundles, "bundle").select(
        "bundle", "shard", "sizes", "n_items", "rest", none.alias("cells"), none.alias("sums"))
    for owner in range(OWNERS):
        met = blocks.select("shard", "term", "docs", "counts").join(terms.filter(F.col("owner") == owner), "term").select(
            F.col("bundle").alias("by_bundle"), F.col("shard").alias("by_shard"), "docs", "counts", "places", "times", "weight")
        state = state.groupBy("bundle", "shard").cogroup(met.groupBy("by_bundle", "by_shard")).applyInPandas(
            _owner_stage(owner, n_docs, n_terms, top), _STATE)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                cells, sums = _unpack(row["cells"], row["sums"])
                places, ids = cells // len(row["ids"]), row["ids"]
                order = np.lexsort((-sums, places))
                placed, out = places[order], []
                starts = np.flatnonzero(np.diff(placed, prepend=-1))
                for a, b in zip(starts, [*starts[1:], len(order)]):
                    least = sums[order[min(b, a + top) - 1]]
                    for i in order[a:b]:  # ties of the last are kept, the final choice is by id
                        if sums[i] < least:
                            break
                        out.append((row["bundle"], int(placed[a]), ids[cells[i] % len(ids)], int(sums[i])))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 4, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                    ["bundle", "place", "doc_id", "score"])

    # Ids join at the end: they may be null, which pandas would not carry.
    left = state.join(heads.select(F.col("shard").alias("of"), "ids"), F.col("shard") == F.col("of")).select("bundle", "ids", "cells", "sums")
    found = left.mapInArrow(best, "bundle long, place int, doc_id long, score long")
    order = Window.partitionBy("bundle", "place").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    named = wanted.select("bundle", "place", "item_id").distinct()
    return ranked.join(named, ["bundle", "place"]).select("item_id", "rank", "doc_id", "score")
