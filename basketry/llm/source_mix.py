"""Mixing sources to target weights by a low-discrepancy schedule.

Every source is a cyclic stream of words: its documents in hash order (``md5`` of the id),
cut into blocks of equally many words. Slot ``t`` of the mix is the golden-ratio point
``frac(t / phi)``; the source whose interval of the cumulative weights holds the point gives
that slot its next block, so any stretch of the schedule is close to the target weights.
Slots are numbered per source; the r-th slot takes block ``r mod blocks`` in pass
``r div blocks``. A point's place along the cumulative weights is its rank among all points, so
quotas are met exactly. The last slot of a source is cut to the words still owed.

Sizes count ``[^\\x20\\x09-\\x0D]+``; null or blank texts have size 0 and are never taken. A
null source is a source of its own and comes last. Repeated rows of one ``doc_id`` are
separate documents in the streams; an empty table gives an empty mix.

The hot source costs no more than others: running sums are cut by hash prefix, blocks hold a
bounded number of words, and a block meets at most ``ceil(max_repeat)`` slots.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ranking import running_by_bucket
from .common import fresh_name, map_frames, stage, texts_of, words_of

#: Fixed values of the mix: weights by the order of sources, repeated.
WEIGHTS = (5, 2, 1)
#: Words taken in all, as a part of all words, and at most per source as a multiple of its words.
SHARE_NUM, SHARE_DEN = 3, 2
MAX_REPEAT = 2
#: Words in a block.
BLOCK = 256
#: 2**31 / phi, odd: multiples modulo 2**31 are the golden-ratio sequence in whole numbers.
GOLDEN, PERIOD = 1327217885, 2147483648
#: Places of one source that a single row is expanded to.
RUN = 4096
#: Hash prefix length (hex digits) of the pieces that running sums are cut into.
PREFIX = 3


def sizes(docs: DataFrame) -> DataFrame:
    """``doc_id, source, size, shuffled`` with the words of every whole text counted."""

    def count(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": batch["doc_id"], "source": batch["source"],
                             "size": [len(words_of(t)) for t in batch["text"]]})

    counted = map_frames(texts_of(docs, F.col("source").cast("string").alias("source")), count,
                         "doc_id long, source string, size long")
    return counted.withColumn("shuffled", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def source_targets(sized: DataFrame) -> DataFrame:
    """One row per source: ``source, source_size, weight, target`` (words, a fraction possible).

    Water filling in closed form: with sources ordered by size over weight, the first ones
    stop at ``MAX_REPEAT`` times their size, the rest share what is left by weight. The
    windows below run over one row per source, after all documents are summed.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1)
    per = per.withColumn("weight", weight.cast("long"))
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    per = per.select(
        "*", F.sum("source_size").over(whole).alias("_all"),
        F.coalesce(F.sum("source_size").over(below), F.lit(0)).alias("_below"),
        F.sum("weight").over(rest).alias("_rest"))
    # Left to share if exactly the sources before this one stop at their bound, times SHARE_DEN.
    left = SHARE_NUM * F.col("_all") - SHARE_DEN * MAX_REPEAT * F.col("_below")
    stops = F.col("weight") * left >= SHARE_DEN * MAX_REPEAT * F.col("source_size") * F.col("_rest")
    per = per.withColumn("_stops", stops).withColumn("_left", left)
    first = F.min(F.when(~F.col("_stops"), F.struct((F.col("source_size") / F.col("weight")).alias("a"), F.col("source").isNull().alias("b"), F.col("source").alias("c"), "_left", "_rest"))).over(whole)
    per = per.withColumn("_first", first)
    target = F.when(F.col("_stops"), (MAX_REPEAT * F.col("source_size")).cast("double")).otherwise(
        (F.col("weight") * F.col("_first._left")).cast("double") / (SHARE_DEN * F.col("_first._rest")).cast("double"))
    return per.select("source", "source_size", "weight", target.alias("target"))


def _quota(targets: DataFrame, block: int) -> DataFrame:
    """Adds ``words`` (whole words owed), ``quota`` (slots), ``blocks`` (in the stream) and the
    interval ``[low, high)`` of quotas in the cumulative weights."""
    out = targets.withColumn("words", F.floor("target"))
    out = out.withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
    # A pass over the stream has a short last block; full passes first, then what is left.
    out = out.withColumn("passes", F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(0))
    out = out.withColumn("quota", F.col("passes") * F.col("blocks") + F.expr(
        f"(words - passes * source_size + {block - 1}) div {block}"))
    up_to = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return out.withColumn("high", F.sum("quota").over(up_to)).withColumn("low", F.col("high") - F.col("quota"))


def schedule(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """``slot, source, slot_rank`` (0-based within the source) for every slot of the mix."""
    spark = targets.sparkSession
    quotas = stage(_quota(targets, block).filter("quota > 0").select(
        "source", "quota", "low", "high").coalesce(1), "mix-quota")
    total = quotas.agg(F.max("high")).first()[0] or 0
    points = spark.range(total).select(
        F.col("id").alias("slot"), ((F.col("id") % PERIOD) * GOLDEN % PERIOD).alias("point"))
    # The place of a point is its rank among all points, so every source meets its quota exactly.
    placed = running_by_bucket(points, [], F.shiftright("point", 19), [F.col("point"), F.col("slot")],
                               {"place": F.lit(1).cast("long")})
    runs = quotas.select("source", "low", F.explode(F.expr(f"sequence(low, high - 1, {RUN})")).alias("first"), "high")
    places = runs.select("source", F.explode(F.expr(
        f"sequence(first + 1, least(first + {RUN}, high))")).alias("place"))
    # Planned sizes do not count what an explode adds: these joins must not be broadcast by mistake.
    hit = placed.join(places.hint("merge"), "place").select(
        "slot", "source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_name"))
    ranked = running_by_bucket(hit, ["_name"], F.shiftright("slot", 12), [F.col("slot")],
                               {"nth": F.lit(1).cast("long")})
    return ranked.select("slot", "source", (F.col("nth") - 1).alias("slot_rank"))


def stream_pieces(sized: DataFrame, block: int = BLOCK) -> DataFrame:
    """The part of each document in each block: ``source, block, doc_id, size, start, words``."""
    named = sized.filter("size > 0").withColumn("_name", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    summed = running_by_bucket(named, ["_name"], F.substring("shuffled", 1, PREFIX),
                               [F.col("shuffled"), F.col("doc_id"), F.col("size")], {"upto": F.col("size")})
    spans = summed.select("source", "doc_id", "size", (F.col("upto") - F.col("size")).alias("begin"), F.col("upto"))
    cut = spans.withColumn("block", F.explode(F.expr(f"sequence(begin div {block}, (upto - 1) div {block})")))
    left = F.greatest(F.col("begin"), F.col("block") * block)
    right = F.least(F.col("upto"), (F.col("block") + 1) * block)
    return cut.select("source", "block", "doc_id", "size", left.alias("at"), (left - F.col("begin")).alias("start"),
                      (right - left).alias("words"), "begin")


def mix(docs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix as pieces ``slot, pass, source, doc_id, start, words``; the sizes; the targets.

    ``start`` and ``words`` name a run of words of the document. Sorting by ``slot, start``
    gives the mixed stream.
    """
    sized = stage(sizes(docs), "mix-sizes")
    targets = stage(source_targets(sized), "mix-targets")
    quotas = _quota(targets, block).select(
        F.col("source").alias("q_source"), "blocks", "passes", "source_size", "words").withColumnRenamed("words", "owed")
    slots = schedule(targets, block)
    slots = slots.join(quotas, F.col("source").eqNullSafe(F.col("q_source"))).select(
        "slot", F.col("source").alias("s_source"), (F.col("slot_rank") % F.col("blocks")).alias("s_block"),
        F.expr("slot_rank div blocks").alias("pass"),
        # Words of the stream that this pass may take: all of them, or what is left in the last.
        F.when(F.expr("slot_rank div blocks") < F.col("passes"), F.col("source_size"))
        .otherwise(F.col("owed") - F.col("passes") * F.col("source_size")).alias("limit"))
    pieces = stream_pieces(sized, block)
    met = pieces.join(slots.hint("merge"), F.col("source").eqNullSafe(F.col("s_source")) & (F.col("block") == F.col("s_block")))
    taken = met.withColumn("words", F.greatest(F.lit(0), F.least(F.col("words"), F.col("limit") - F.col("at"))))
    return (taken.filter("words > 0").select("slot", "pass", "source", "doc_id", "size", "start", "words"),
            sized, targets)


def mix_report(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    pieces, sized, targets = mix(docs, block)
    taken = pieces.groupBy("doc_id", "source", "size").agg(F.sum("words").alias("taken"))
    # Repeated rows of one document share what was taken evenly; the first ones get the odd words.
    key = [F.col("s.doc_id").eqNullSafe(F.col("t.doc_id")), F.col("s.source").eqNullSafe(F.col("t.source")),
           F.col("s.size") == F.col("t.size")]
    per_id = sized.groupBy("doc_id", "source", "size").agg(F.count("*").alias("_n"))
    shared = per_id.alias("s").join(taken.alias("t"), key[0] & key[1] & key[2], "left").select(
        "s.doc_id", "s.source", "s.size", "_n", F.coalesce("taken", F.lit(0)).alias("taken"))
    each = shared.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n")))).select(
        "doc_id", "source", "size", F.expr("taken div _n + cast(_i <= taken % _n as int)").alias("taken"))
    return each.alias("d").join(targets.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source"))).select(
        "d.doc_id", "d.size", "g.source_size", "g.target", "d.taken")


def mixed_documents(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """The mix with the columns of ``docs``: a row per document and pass that takes words of it.

    A pass that takes all words gives the text as it is; a pass that takes a run of words
    gives the text from the first to the last of them, with ``n_chars`` counted anew where
    there is such a column.
    """
    pieces, sized, _ = mix(docs, block)
    runs = pieces.groupBy("doc_id", "source", "pass", "size").agg(
        F.min("start").alias("start"), F.max(F.col("start") + F.col("words")).alias("stop"))
    # Helper columns whose names no column of the table has.
    ident, source, taken, several = (fresh_name(n, docs.columns) for n in ("_mix_id", "_mix_source", "_mix_taken", "_mix_several"))
    none = F.lit(None).cast("long")
    every = runs.select("doc_id", "source", "size", "start", "stop").unionByName(
        sized.select("doc_id", "source", "size", none.alias("start"), none.alias("stop")))
    listed = every.groupBy(F.col("doc_id").alias(ident), F.col("source").alias(source)).agg(
        F.collect_list(F.when(F.col("start").isNotNull(), F.struct("size", "start", "stop"))).alias(taken),
        (F.min("size") < F.max("size")).alias(several)).filter(F.size(taken) > 0)
    joined = docs.join(listed, F.col("doc_id").eqNullSafe(F.col(ident)) & F.col("source").cast("string").eqNullSafe(F.col(source)))
    blank = r"[\x20\x09-\x0D]"
    # Rows of one id that differ in size take their own runs; only for them words are counted again.
    size = F.when(F.col(several), F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))).otherwise(F.col(taken)[0]["size"])
    joined = joined.withColumn(taken, F.explode(F.filter(taken, lambda t: t["size"] == size)))
    run = F.col(taken)
    # Skip `start` words, keep up to the end of word `stop`; only documents cut by the last block.
    part = F.regexp_extract(F.col("text"), f"(?s)^{blank}*(.*)$", 1)
    words = F.split(part, f"{blank}+")
    cut = F.array_join(F.slice(words, (run["start"] + 1).cast("int"), (run["stop"] - run["start"]).cast("int")), " ")
    text = F.when((run["start"] == 0) & (run["stop"] == run["size"]), F.col("text")).otherwise(cut)
    joined = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return joined.select(*docs.columns)
