"""Registered queries of this subpackage, each over its whole table, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    chat_format,
    near_dedup,
    paragraph_sketch,
    piece_codec,
    quality_pu,
    quality_rules,
    ranked_search,
    secret_scan,
    source_mix,
    token_counts,
    toxicity,
    warc_zip,
    whitening_charpoly,
)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


#: Words as rows of arrays; DuckDB's splitting leaves an empty string at blank ends.
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"


def _listed(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _class(chars: str) -> str:
    """A character class for a SQL string."""
    return "[" + "".join(f"\\{c}" if c.isascii() else c for c in chars).replace("'", "''") + "]"


_Q = quality_rules
_UPPER = "len(list_filter(letters, lambda w: w = upper(w)))"
QUALITY_SQL = rf"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text, {_WORDS} as words from documents
), windows as (
  select r, i, count(*) over (partition by r, a, b, c) as met from (
    select r, i, words[i] as a, words[i + 1] as b, words[i + 2] as c
    from (select r, words, unnest(range(1, len(words) - 1)) as i from docs))
), repeats as (
  select r, count(distinct i + k) as n from windows cross join (values (0), (1), (2)) t(k) where met > 1 group by r
), lines as (
  select r, line, len(words) as n, words,
    list_filter(words, lambda w: length(w) > 1 and lower(w) <> upper(w)) as letters
  from (select r, line, list_filter(regexp_split_to_array(line, '[ 	-
]+'), lambda w: w <> '') as words
    from (select r, unnest(string_split(text, chr(10))) as line from docs)) where len(words) > 0
), judged as (
  select *, (n <= {_Q.BOILERPLATE_WORDS} and len(list_filter({_listed(_Q.BOILERPLATE)}, lambda p: contains(lower(line), p))) > 0)
    or (n >= 2 and (100 * len(list_filter(words, lambda w: list_contains({_listed(_Q.SEPARATORS)}, w))) > {_Q.MAX_SEPARATORS} * n
      or 100 * len(list_filter(words, lambda w: list_contains({_listed(sorted(_Q.NAVIGATION))},
        trim(lower(w), '{_Q.TRIM.replace("'", "''")}'))))
        > {_Q.MAX_NAVIGATION} * n))
    or (n >= {_Q.MIN_JUDGED} and (100 * greatest(length(line) - length(regexp_replace(line, '{_class(_Q.SYMBOLS)}', '', 'g')),
        (length(line) - length(replace(line, '!!', ''))) // 2) > {_Q.MAX_SYMBOLS} * n
      or (len(letters) >= {_Q.MIN_JUDGED} and 100 * {_UPPER} > {_Q.MAX_SHOUTING} * len(letters))))
    or (n > {_Q.HEADING_WORDS} and len(list_filter(words, lambda w: regexp_matches(w, '{_class(_Q.ENDS)}$'))) = 0) as fails
  from lines
), by_line as (
  select r, count(*) - count(distinct line) as n_dup_lines, coalesce(sum(n) filter (fails), 0) as lost_words from judged group by r
), counted as (
  select doc_id, len(words) as n_words, length(regexp_replace(text, '[ 	-
]+', '', 'g')) as word_chars,
    length(text) - length(regexp_replace(text, '{_class(_Q.SYMBOLS)}', '', 'g')) as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(repeats.n, 0) as n_repeat_words, coalesce(lost_words, 0) as lost_words
  from docs left join by_line using (r) left join repeats using (r)
)
select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
  n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, lost_words::bigint as lost_words, base_failed,
  not base_failed and 100 * lost_words <= {_Q.MAX_LOST} * n_words as kept
from (select *, n_words < {_Q.MIN_WORDS} or 100 * n_repeat_words > {_Q.MAX_REPEAT_PERCENT} * n_words as base_failed from counted)
"""


@query("op2_quality_rules", QUALITY_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judge(table(spark, folder, "documents"))


@query("op3_chat_format", rf"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), sized as (
  select *, length('<|im_start|>') + length(role) + 1
    + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + length('<|im_end|>') + 1 as chars from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text)) as turns_sha256,
  cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls last, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars) as bigint) as formatted_chars
from sized group by conv_id
""")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    turns = chat_format.with_control_case(table(spark, folder, "conversations"))
    records = chat_format.conversation_records(turns)
    return chat_format.read_back(chat_format.format_records(records, "conv_id", "record"))


@query("op5_source_mix", rf"""
with sized as (
  select doc_id, source, len({_WORDS}) as size, md5(cast(doc_id as varchar)) as shuffled from documents
), per as (
  select source, cast(sum(size) as bigint) as source_size from sized group by source
), weighed as (
  select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from per
), filled as (
  select *, sum(source_size) over () as total,
    coalesce(sum(source_size) over (order by source_size / weight, source nulls last
      rows between unbounded preceding and 1 preceding), 0) as below,
    sum(weight) over (order by source_size / weight, source nulls last
      rows between current row and unbounded following) as rest
  from weighed
), judged as (
  select *, weight * (3 * total - 4 * below) >= 4 * source_size * rest as stops from filled
), free as (
  select max(3 * total - 4 * below) as share, max(rest) as rest from (
    select * from judged where not stops order by source_size / weight, source nulls last limit 1)
), targets as (
  select source, source_size, case when stops then cast(2 * source_size as double)
    else cast(weight * share as double) / cast(2 * free.rest as double) end as target
  from judged left join free on true
), placed as (
  select *, sum(size) over (partition by source order by shuffled, doc_id, size rows unbounded preceding) as upto from sized
)
select d.doc_id, cast(d.size as bigint) as size, t.source_size, t.target,
  cast(case when t.source_size = 0 then 0 else
    (floor(t.target)::bigint // t.source_size) * d.size
    + greatest(0, least(d.size, floor(t.target)::bigint % t.source_size - (d.upto - d.size))) end as bigint) as taken
from placed d join targets t on d.source is not distinct from t.source
""")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return source_mix.mix_report(table(spark, folder, "documents"))


@query("op9_secret_scan")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.report(table(spark, folder, "documents"))


@query("op10_warc_zip", """
with sized as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), led as (
  select *, min(page_id) over (partition by payload_digest) as first from sized
)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first then first end as refers_to
from led
""")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return warc_zip.archive_report(table(spark, folder, "pages"))


#: Words of a shingle in the contract of the near-duplicate query.
CONTRACT_WIDTH = 4


#: Every pair that shares a shingle, and all that is reachable over links.
NEAR_SQL = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents
), shingles as (
  select distinct doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 2)), lambda i: array_to_string(w[i:i + 3], ' '))) as s
  from words where len(w) > 0
), sizes as (select doc_id, count(*) as n from shingles group by doc_id),
met as (
  select a.doc_id as x, b.doc_id as y, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), links as (
  select x, y from met join sizes p on p.doc_id = x join sizes q on q.doc_id = y where 100 * c >= 80 * (p.n + q.n - c)
), sides as (select x, y from links union all select y, x from links),
reach(doc_id, other) as (
  select doc_id, doc_id from documents union select y, other from reach join sides on x = doc_id
)
select doc_id, coalesce(n, 0)::bigint as n_shingles, min(other) as component_id, min(other) = doc_id as kept
from reach left join sizes using (doc_id) group by doc_id, n
"""


@query("op7_near_dedup", NEAR_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.duplicate_components(table(spark, folder, "documents"), CONTRACT_WIDTH)


@query("op6_piece_codec")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return piece_codec.encode_documents(table(spark, folder, "documents"))


@query("op1_toxicity")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.judge(table(spark, folder, "documents"), table(spark, folder, "labels")).withColumn(
        "n_offending", F.size("offending").cast("long"))


@query("op8_quality_pu")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return quality_pu.judge(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_paragraph_sketch")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return paragraph_sketch.report(table(spark, folder, "documents"))


@query("op11_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return whitening_charpoly.whiten(table(spark, folder, "embeddings"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query("op12_ranked_search", rf"""
with doc_terms as (
  select row_number() over () as r, doc_id, {_TERMS} as t from documents
), totals as (
  select count(*)::bigint as big_n, sum(len(t))::bigint as big_l from doc_terms where len(t) > 0
), sized as (
  select r, doc_id, 75 + (25 * len(t)::bigint * big_n) // big_l as m from doc_terms, totals where len(t) > 0
), tf as (
  select r, term, count(*)::bigint as tf from (select r, unnest(t) as term from doc_terms) group by all
), asked as (
  select i, item_id, term, count(*)::bigint as times from (
    select row_number() over () as i, item_id, unnest({_TERMS}) as term from benchmark) group by all
), weights as (
  select term, floor(1000 * ln((2 * any_value(big_n) + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from tf, totals where term in (select term from asked) group by term
), scores as (
  select i, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
  from asked join weights using (term) join tf using (term) join sized using (r) group by all
)
select item_id, rank::int as rank, doc_id, score from (
  select *, row_number() over (partition by i order by score desc, doc_id nulls last) as rank from scores where score > 0)
where rank <= {ranked_search.TOP}
""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op13_token_counts")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"))
