"""Tokens, masks, pretraining rows, embeddings of items."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from ..functions.vectors import round6
from ..operators import layout as L
from ..operators import masking as MK
from ..operators import metrics as M
from ..operators import models as MO
from ..operators import tokens as T
from ..operators.lookup import spread
from ..session import cut_lineage
from . import binding as b
from .binding import r6, u32_sql, with_ctes
from .catalogue import item_spec
from .registry import query

_CONSTANTS = ", ".join(f"({i}, '{t}')" for i, t in enumerate(T.GLYPHS + T.MODIFIERS))


@query("reserved_tokens", with_ctes("items", f"""
    select token, row_number() over (order by i, s) + 4 as token_id from (
      select token, min((i, s)) as p, min((i, s))[1] as i, min((i, s))[2] as s from (
        select t as token, 0::bigint as i, n as s from (values {_CONSTANTS}) c(n, t)
        union all select name, item_idx, 0 from items
        union all select unnest(classes), item_idx, generate_subscripts(classes, 1) from items
        union all select facet, item_idx, 1048576 from items
        union all select lower(facet), item_idx, 1048577 from items) group by token)"""))
def reserved_tokens(spark, folder):
    return T.reserved_tokens(b.items(spark, folder), keywords="facets")


_CLEAN = r"""clean as (select doc_id, trim(regexp_replace(regexp_replace(regexp_replace(text,
      '[\t-\r\x1c-\x1f\x{85}\p{Z}]*\([^)]*\)', '', 'g'), '[‘’]', '''', 'g'), '[\t-\r\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g')) as text
    from documents where length(text) > 0)"""
_WORD = (r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+| ?[^\s\x0b\x1c-\x1f\x{85}\p{Z}\p{L}\p{N}]+|[\s\x0b\x1c-\x1f\x{85}\p{Z}]+")


def clean_docs(spark, folder):
    """Normalised texts, dealt out evenly; one that normalises to nothing has no tokens."""
    from ..functions.text import normalise_text

    return spread(b.table(spark, folder, "documents").filter(F.length("text") > 0).select("doc_id", "text")).select(
        "doc_id", normalise_text(F.col("text")).alias("text"))


@query("pretoken_counts", with_ctes("", f"""
    select pretoken, count(*) as n from (select unnest(regexp_extract_all(text, '{_WORD}')) as pretoken from clean)
    group by pretoken""", _CLEAN.replace("'[‘’]', '''', 'g'", "'[‘’]', '''', 'g'")))
def pretoken_counts(spark, folder):
    return T.pretoken_counts(clean_docs(spark, folder))


@query("bpe_pair_counts", with_ctes("", f"""
    select lhs, rhs, sum(n)::bigint as n from (
      select unnest(list_zip(s[:-2], s[2:])) as p, p[1] as lhs, p[2] as rhs, n from (
        select regexp_extract_all(hex(encode(pretoken)), '..') as s, n from (
          select pretoken, count(*) as n from (select unnest(regexp_extract_all(text, '{_WORD}')) as pretoken from clean)
          group by pretoken) where length(hex(encode(pretoken))) > 2)) group by lhs, rhs""", _CLEAN))
def bpe_pair_counts(spark, folder):
    words = T.pretoken_counts(clean_docs(spark, folder))
    return T.pair_counts(words.select(T.byte_symbols(F.col("pretoken")).alias("symbols"), "n"))


# Reserved tokens as one pattern, the longest first, and the texts cut at them.
_HELD = f"""held as (select distinct token from (
      select t as token from (values {_CONSTANTS}) c(n, t) union all select name from items
      union all select unnest(classes) from items union all select facet from items union all select lower(facet) from items)),
    pattern as (select '[\\t-\\r\\x1c-\\x1f\\x{{85}}\\p{{Z}}]*(' || string_agg(regexp_escape(token), '|' order by length(token) desc, token) || ')' as p from held),
    pieces as (select item_idx, unnest(string_split(regexp_replace(text, p, '{T.CUT}{T.HELD}\\1{T.CUT}', 'g'), '{T.CUT}')) as piece
      from item_texts, pattern)"""


def _held(spark, folder, index):
    return T.written_names(T.reserved_tokens(index, keywords="facets"))


@query("reserved_pretokens", with_ctes("items item_texts", f"""
    select pretoken, count(*) as n from (select unnest(regexp_extract_all(piece, '{_WORD}')) as pretoken
      from pieces where not starts_with(piece, '{T.HELD}')) group by pretoken""", _HELD))
def reserved_pretokens(spark, folder):
    """Pre-tokens of item texts once names, classes and keywords are cut out."""
    index = cut_lineage(b.items(spark, folder))
    return T.pretoken_counts(b.item_texts(spark, folder, index), "text", _held(spark, folder, index))


def _vocabulary(texts, held):
    counts = T.pretoken_counts(texts, "text", held)
    return T.Vocabulary(held, tuple(T.learn_merges(counts, T.VOCAB_SIZE, held.size)))


def _document_vocabulary(spark, folder):
    return _vocabulary(clean_docs(spark, folder), _held(spark, folder, cut_lineage(b.items(spark, folder))))


@query("bpe_learn")
def bpe_learn(spark, folder):
    """A vocabulary of the default size from all documents."""
    return _document_vocabulary(spark, folder).table(spark)


@query("bpe_encode", with_ctes("", """
    select doc_id, md5(replace(text, ' ', '')) as letters, true as framed from clean where text <> ''""", _CLEAN))
def bpe_encode(spark, folder):
    """The ids of every text, in a learnt vocabulary, decoded again: its letters must come back, framed by the two markers."""
    vocabulary = _document_vocabulary(spark, folder)
    coded = T.encode_texts(clean_docs(spark, folder), vocabulary, max_positions=None).filter(F.size("ids") > 2)

    @F.arrow_udf("string")
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        text = T.batch_decoder(vocabulary)
        yield from T.by_values(batches, lambda ids: pc.replace_substring(text(ids), " ", ""), pa.string())

    framed = (F.col("ids")[0] == T.CLS) & (F.element_at("ids", -1) == T.SEP)
    return coded.select("doc_id", F.md5(read("ids")).alias("letters"), framed.alias("framed"))


# A small vocabulary for the twin of encoding: merges of common letters, in order.
GIVEN_MERGES = (("20", "74"), ("68", "65"), ("69", "6E"), ("65", "72"), ("61", "6E"), ("2074", "6865"), ("6F", "6E"), ("65", "6E"), ("20", "61"),
                ("2061", "6E64"), ("616E", "64"), ("69", "74"), ("6F", "75"), ("65", "65"), ("616E", "616E"), ("73", "68"), ("726F", "6E"), ("72", "65"))


def _given_sql() -> str:
    word = r"regexp_replace(hex(encode(w)), '(..)', '<\1>', 'g')"
    for lhs, rhs in GIVEN_MERGES:
        word = f"replace({word}, '<{lhs}><{rhs}>', '<{lhs + rhs}>')"
    names = ", ".join(f"'{n}'" for n in T.Vocabulary(None, GIVEN_MERGES).ids())
    return f"""select doc_id, len(ids) as n_ids, md5(array_to_string(ids, ' ')) as ids from (
        select doc_id, (list_concat(list_concat([{T.CLS}], list_transform(regexp_extract_all(array_to_string(
          list_transform(regexp_extract_all(text, '{_WORD}'), lambda w: {word}), ''), '<([0-9A-F]+)>', 1),
          lambda x: list_position([{names}], x) + {len(T.SPECIALS) - 1})), [{T.SEP}]))[:{T.MAX_POSITIONS}] as ids from clean)"""


@query("bpe_encode_ids", with_ctes("", _given_sql(), _CLEAN))
def bpe_encode_ids(spark, folder):
    """The ids of every text in a given vocabulary, framed and cut to the default number of positions."""
    coded = T.encode_texts(clean_docs(spark, folder), T.Vocabulary(None, GIVEN_MERGES))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), F.md5(F.array_join("ids", " ")).alias("ids"))


@query("pretrain_rows")
def pretrain_rows(spark, folder):
    """Token ids and features of every item, with its side of the split."""
    index = cut_lineage(b.items(spark, folder))
    texts = cut_lineage(b.item_texts(spark, folder, index))
    vocabulary = _vocabulary(texts, _held(spark, folder, index))
    rows = index.select("item_idx", "item_id").join(texts, "item_idx")
    return T.pretrain_rows(rows, L.feature_rows(index, item_spec(index)), vocabulary, "pretrain-encoder", 0.1)


EMBEDDING_DIM = 256


@query("item_embedding")
def item_embedding(spark, folder):
    """Unit vectors of the default width from the ids and features of every item, and the padding row."""
    index = cut_lineage(b.items(spark, folder))
    texts = cut_lineage(b.item_texts(spark, folder, index))
    coded = T.encode_texts(texts, _vocabulary(texts, _held(spark, folder, index)))
    features = L.feature_rows(index, item_spec(index))
    return MO.item_embeddings(coded.select("item_idx", "ids").join(features, "item_idx"), EMBEDDING_DIM)


# Word ids by hash, framed like an encoded text; id 2 and 3 are specials.
_IDS = f"""words as (select doc_id, list_concat([2], list_concat(list_transform(string_split(text, ' '),
      lambda w: ({u32_sql("'word'", 'w')} % 4096 + 5)::int), [3])) as ids from documents),
    pos as (select doc_id, unnest(ids) as token, generate_subscripts(ids, 1) - 1 as p from words),
    hashed as (select *, sha1('m:' || doc_id || ':' || p) as d from pos),
    drawn as (select *, token not in (0, 1, 2, 3, 4) and ('0x' || substr(d, 1, 8))::bigint / 4294967296.0::double < 0.15 as chosen,
      ('0x' || substr(d, 9, 8))::bigint / 4294967296.0::double as act, (('0x' || substr(d, 17, 8))::bigint % 4101)::int as other
      from hashed),
    masked as (select doc_id, p::int as pos, token,
      case when not chosen then token when act < 0.8 then 4 when act < 0.9 then other else token end as input_id,
      case when chosen then token else -100 end as label from drawn)"""


def _masked(spark, folder):
    from ..functions.hashing import u32

    ends = F.array(F.lit(None).cast("string"))
    words = b.table(spark, folder, "documents").select(
        "doc_id", F.posexplode(F.concat(ends, F.split("text", " "), ends)).alias("pos", "word"))
    token = F.when(F.col("word").isNotNull(), (F.pmod(u32("word", F.col("word")), F.lit(4096)) + 5).cast("int")).when(
        F.col("pos") == 0, F.lit(T.CLS)).otherwise(F.lit(T.SEP))
    cell = MK.masked_token(F.col("token"), F.col("pos"), F.col("doc_id"), "m", mask_id=T.MASK, vocab_size=4101, specials=range(5))
    cells = words.withColumn("token", token).select("doc_id", "pos", cell.alias("c"))
    return cells.select("doc_id", "pos", "c.input_id", "c.label")


@query("mask_tokens", with_ctes("", "select doc_id, pos, input_id, label from masked", _IDS))
def mask_tokens(spark, folder):
    return _masked(spark, folder)


_LOSS = "avg(-ln((" + u32_sql("'p'", "doc_id", "pos") + " + 1) / 4294967296.0::double))"


@query("masked_loss", with_ctes("", f"select {r6(_LOSS)} as mlm from masked where label <> -100", _IDS))
def masked_loss(spark, folder):
    """Token loss of a pretend model whose probabilities are hashes."""
    from ..functions.hashing import U32, u32

    loss = -F.log((u32("p", F.col("doc_id"), F.col("pos")) + 1) / F.lit(float(U32)))
    return M.masked_loss(_masked(spark, folder).withColumn("loss", loss)).select(round6(F.col("mlm")).alias("mlm"))


def _blocks(spark, folder):
    index = b.items(spark, folder)
    spec = item_spec(index)
    rows = L.feature_rows(index, spec)
    names = [n for n, _, _ in spec.blocks()]
    dropped = MK.dropped_blocks(F.col("item_idx"), "m", names)
    return rows.withColumn("dropped", dropped).withColumn(
        "masked", MK.mask_blocks(F.col("features"), F.col("dropped"), spec.blocks()))


_DROP = ", ".join(f"('{n}')" for n in ("cost", "inks", "types", "classes", "scalars"))


@query("mask_blocks_dropped", with_ctes("items", f"""
    select item_idx, name as block from (select item_idx from items union all select 0) i
    cross join (values {_DROP}) n(name) where {u32_sql("'m'", 'item_idx', 'name')} / 4294967296.0::double < 0.3"""))
def mask_blocks_dropped(spark, folder):
    return _blocks(spark, folder).select("item_idx", F.explode("dropped").alias("block"))


_MSE = f"""
    select {r6('sum(lost) / (count(distinct i.item_idx) * any_value(27 + n))')} as mse
    from (select item_idx from items union all select 0) i, (select count(distinct c) as n from (select unnest(classes) as c from items))
    left join (select item_idx, sum(case block when 'classes' then list_unique(classes)
        when 'scalars' then (number / tn) ** 2 + (price / tp) ** 2 + flag::int else 1 end) as lost
      from items cross join (values {_DROP}) v(block)
      cross join (select greatest(max(number), 1) as tn, greatest(max(price), 1) as tp from items)
      where {u32_sql("'m'", 'item_idx', 'block')} / 4294967296.0::double < 0.3 group by item_idx) l on l.item_idx = i.item_idx"""


@query("mask_blocks_mse", with_ctes("items", _MSE))
def mask_blocks_mse(spark, folder):
    """Squared error of predicting the masked row itself."""
    cells = _blocks(spark, folder).select("item_idx", F.posexplode(F.arrays_zip("features", "masked")).alias("dim", "z"))
    return M.cell_mse(cells.select(F.col("z.features").alias("value"), F.col("z.masked").alias("predicted"))).select(
        round6(F.col("mse")).alias("mse"))


STRUCT_WEIGHT = 0.5


@query("pretrain_loss", with_ctes("items", f"""
    , token_loss as (select {_LOSS} as mlm from masked where label <> -100), block_loss as ({_MSE})
    select {r6('mlm')} as mlm, mse, {r6(f'mlm + {STRUCT_WEIGHT} * mse')} as total from token_loss, block_loss""", _IDS))
def pretrain_loss(spark, folder):
    """Token loss and block error of the same pretend models, combined."""
    from ..functions.hashing import U32, u32

    loss = -F.log((u32("p", F.col("doc_id"), F.col("pos")) + 1) / F.lit(float(U32)))
    both = M.combined_loss(M.masked_loss(_masked(spark, folder).withColumn("loss", loss)), mask_blocks_mse(spark, folder), STRUCT_WEIGHT)
    return both.select(*[round6(F.col(c)).alias(c) for c in ("mlm", "mse", "total")])
