"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is a set of paragraph digests: its lines, long ones in blocks of ``BLOCK_WORDS`` words.
Every digest is added to three cells of a sketch, one per sub-table; a cell holds a count, the
xor of digests and the xor of their checks. The sketch of one version minus that of another
holds the differing digests only. Peeling takes digests out of cells with a count of one and a
right check, round by round, until nothing is left; then the digests on either side are known,
and with the numbers of digests the likeness ``shared / all``. Where peeling gets stuck, the
digests are dealt to parts by their high bits and sketched anew with more cells in all, and once
more with larger sketches for parts that are still stuck; a part that defies even that (a rare
cycle) is settled by comparing its digests.

The fingerprint string is the number of digests and the cells of the first sketch. Equal texts
have equal fingerprints. Everything is DataFrame functions.

Defined cases: null texts are empty; two texts without paragraphs have likeness 1, one
against a text with some 0. Rows that repeat id and text are one document in the order of ids
and are returned as often as they occur; other rows of one id are ordered by a digest. A single
document is its own next. Null ids come first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import rank_by_range
from .common import stage, texts_of

BLOCK_WORDS = 24
#: Cells per sub-table of the first sketch, of the parts' sketches, and of the last attempt.
FIRST, SECOND, THIRD = 8, 8, 32
#: A part with more digests than this is dealt to 8 parts by three bits from each of these on.
PART_DIGESTS, LEVELS = 12, (61, 58, 55, 52, 49)
ROUNDS = 8
_BLANK, _WORD = r"[\x20\x09\x0B-\x0D]", r"[^\x20\x09-\x0D]"
#: Words of more than 64 characters count as several.
PARAGRAPH = f"(?:{_WORD}{{1,64}}+{_BLANK}*+){{1,{BLOCK_WORDS}}}+"
_CHECK = "(xxhash64({0}) & 4294967295)"
_EMPTY = "named_struct('n', 0, 'x', 0L, 's', 0L)"


def digests(text: str) -> Column:
    """The distinct paragraph digests of a text column."""
    pieces = F.regexp_extract_all(F.col(text), F.lit(PARAGRAPH), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _slot(h: str, table: int, width: int) -> str:
    return f"(shiftright({h}, {5 + 13 * table}) & {width - 1})"


def sketch(name: str, width: int) -> str:
    """The cells of an array of digests: three sub-tables of ``width`` (a power of two) cells."""
    tables = (f"""transform(sequence(0L, {width - 1}L), i -> aggregate(filter({name}, h -> {_slot('h', t, width)} = i), {_EMPTY},
        (c, h) -> named_struct('n', c.n + 1, 'x', c.x ^ h, 's', c.s ^ {_CHECK.format('h')})))""" for t in range(3))
    return f"concat({', '.join(tables)})"


def subtract(left: str, right: str) -> str:
    return f"zip_with({left}, {right}, (u, v) -> named_struct('n', u.n - v.n, 'x', u.x ^ v.x, 's', u.s ^ v.s))"


def peel(cells: str, width: int) -> str:
    """``done, ours, theirs`` of a difference: whether nothing is left, and the digests found on either side."""
    sure = f"filter(st.cells, c -> abs(c.n) = 1 and c.s = {_CHECK.format('c.x')})"
    pure = f"array_distinct(transform({sure}, c -> named_struct('n', c.n, 'x', c.x)))"
    tables = (f"transform(slice(st.cells, {t * width + 1}, {width}), (c, j) -> aggregate("
              f"filter(pure, p -> {_slot('p.x', t, width)} = j), c, (w, p) -> named_struct("
              f"'n', w.n - p.n, 'x', w.x ^ p.x, 's', w.s ^ {_CHECK.format('p.x')})))" for t in range(3))
    side = "concat(st.{0}, transform(filter(pure, p -> p.n = {1}), p -> p.x))"
    # The lambda over a one-element array names the pure cells, so that they are found once a
    # round; a round without any ends the peeling.
    step = (f"if(st.stop, st, transform(array({pure}), pure -> if(size(pure) = 0, "
            f"named_struct('stop', true, 'cells', st.cells, 'ours', st.ours, 'theirs', st.theirs), "
            f"named_struct('stop', false, 'cells', concat({', '.join(tables)}), "
            f"'ours', {side.format('ours', 1)}, 'theirs', {side.format('theirs', -1)})))[0])")
    none = "cast(array() as array<bigint>)"
    left = "exists(st.cells, c -> c.n <> 0 or c.x <> 0 or c.s <> 0)"
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('stop', false, 'cells', {cells}, 'ours', {none}, 'theirs', {none}), "
            f"(st, r) -> {step}, st -> named_struct('done', not {left}, 'ours', st.ours, 'theirs', st.theirs))")


def compare(left: str, right: str, width: int) -> str:
    """Sketch both arrays of digests, subtract, peel."""
    return peel(subtract(sketch(left, width), sketch(right, width)), width)


def deal(parts: str, shift: int) -> str:
    """Parts (structs of digest arrays ``a, b``) with many digests become 8 by three bits of the digests."""
    pick = lambda d: f"filter(s.{d}, h -> (shiftright(h, {shift}) & 7) = q)"
    cut = (f"filter(transform(sequence(0L, 7L), q -> named_struct('a', {pick('a')}, 'b', {pick('b')})), "
           "z -> size(z.a) + size(z.b) > 0)")
    return f"flatten(transform({parts}, s -> if(size(s.a) + size(s.b) > {PART_DIGESTS}, {cut}, array(s))))"


def with_difference(rows: DataFrame, left: str, right: str, left_cells: str, right_cells: str, out: str) -> DataFrame:
    """Adds ``out``: struct of ``ours, theirs``, the digests on one side only.

    The first sketches are subtracted and peeled; where that fails the parts are, and parts that
    fail are sketched once more with larger tables.
    """
    rows = rows.withColumn("_first", F.expr(peel(subtract(left_cells, right_cells), FIRST)))
    none = "array_repeat(named_struct('a', {0}, 'b', {1}), 0)".format(left, right)
    whole = f"if(_first.done, {none}, array(named_struct('a', {left}, 'b', {right})))"
    for level, shift in enumerate(LEVELS):
        rows = rows.withColumn(f"_parts{level}", F.expr(deal(whole if level == 0 else f"_parts{level - 1}", shift)))
    rows = rows.withColumn("_tried", F.expr(f"transform(_parts{len(LEVELS) - 1}, t -> named_struct('t', t, 'r', {compare('t.a', 't.b', SECOND)}))"))
    rows = rows.withColumn("_again", F.expr(
        f"transform(filter(_tried, t -> not t.r.done), t -> named_struct('t', t.t, 'r', {compare('t.t.a', 't.t.b', THIRD)}))"))

    def side(name: str, one: str, other: str) -> str:
        return (f"if(_first.done, _first.{name}, concat(flatten(transform(filter(_tried, t -> t.r.done), t -> t.r.{name})), "
                f"flatten(transform(_again, t -> if(t.r.done, t.r.{name}, array_except(t.t.{one}, t.t.{other}))))))")

    return rows.withColumn(out, F.expr(f"named_struct('ours', {side('ours', 'a', 'b')}, 'theirs', {side('theirs', 'b', 'a')})")).drop(
        "_first", "_tried", "_again", *[f"_parts{i}" for i in range(len(LEVELS))])


def likeness(left: str, difference: str) -> Column:
    """Digests shared, over all digests of two versions."""
    all_ = F.size(left) + F.size(F.col(difference)["theirs"])
    return F.when(all_ == 0, F.lit(1.0)).otherwise((F.size(left) - F.size(F.col(difference)["ours"])) / all_)


def fingerprint(cells: str, count: str) -> Column:
    """A sketch as text: the number of digests, then count, xor and check of every cell."""
    return F.expr(f"concat({count}, '|', array_join(transform({cells}, c -> concat(c.n, ':', hex(c.x), ':', hex(c.s))), ','))")


def documents_in_order(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts ``k, text``, and per distinct document its place in the order of ids and that of the next."""
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text").cast("binary"))
    based = texts_of(docs).select("doc_id", "text", key.alias("k"))
    small = based.groupBy("k").agg(F.min("doc_id").alias("doc_id"), F.min(F.length("text")).cast("long").alias("n_chars"))
    ranked = stage(rank_by_range(stage(small, "order"), [], [F.col("doc_id").asc_nulls_first(), F.col("k")], "place"), "places")
    total = ranked.count()
    nxt = ranked.select(F.col("place").alias("next_place"), F.col("k").alias("k"), F.col("doc_id"), F.col("n_chars"))
    prev = ranked.select((F.col("place") % max(total, 1) + 1).alias("next_place"), F.col("k").alias("prev_k"),
                         F.floor(F.col("n_chars") / 4).cast("int").alias("prev_quarter"))
    linked = nxt.join(prev, "next_place").select(
        "k", "doc_id", "n_chars", "prev_k", "prev_quarter", F.col("next_place").alias("place"),
        (F.col("next_place") % max(total, 1) + 1).alias("next_place"))
    return based.select("k", "text"), stage(linked, "neighbours")


def versions(docs: DataFrame) -> DataFrame:
    """Per document ``place, next_place, doc_id, n_chars, edited_sha256`` and the digests of its two versions."""
    texts, links = documents_in_order(docs)
    # One exchange of the texts serves both sides: the same columns are asked for.
    full = texts.join(links.hint("merge"), "k")
    heads = full.select(F.col("prev_k").alias("h_k"), F.substring("text", F.lit(1), F.col("prev_quarter")).alias("head"))
    own = full.join(heads.dropDuplicates(["h_k"]).hint("merge"), F.col("k") == F.col("h_k"))
    stays = F.substring("text", F.lit(1), (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int"))
    own = own.select("place", "next_place", "doc_id", "n_chars", "text", F.concat(stays, "head").alias("edited"))
    return own.select("place", "next_place", "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      digests("text").alias("a"), digests("edited").alias("e"))


def compared(docs: DataFrame) -> DataFrame:
    """``versions`` with fingerprints, and the digests that differ from the edited text and from the next document."""
    rows = stage(versions(docs), "versions")
    nexts = rows.select(F.col("place").alias("n_place"), F.col("a").alias("x")).dropDuplicates(["n_place"])
    rows = rows.join(nexts.hint("merge"), F.col("next_place") == F.col("n_place")).drop("n_place", "next_place")
    for d in "aex":
        rows = rows.withColumn(f"_c{d}", F.expr(sketch(d, FIRST)))
    rows = with_difference(rows, "a", "e", "_ca", "_ce", "to_edited")
    rows = with_difference(rows, "a", "x", "_ca", "_cx", "to_next")
    return rows.withColumn("fingerprint", fingerprint("_ca", "size(a)")).withColumn(
        "edited_fingerprint", fingerprint("_ce", "size(e)"))


def report(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and the likeness of the text's to the edited
    text's and to the next document's."""
    return compared(docs).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness("a", "to_edited").alias("near_edited"), likeness("a", "to_next").alias("near_next"))
