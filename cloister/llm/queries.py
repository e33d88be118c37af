"""The queries of the corpus operators, with production parameters over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, chunks, covertree, fingerprints, lines, minhash, mixing, packing, pages, quality
from .common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated_lines(table(spark, sf_dir, "documents"), near_chars=16, exact_chars=1)


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_conversations(table(spark, sf_dir, "conversations"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.repeated_passages(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_packing": op2_packing,
    "op3_minhash": op3_minhash,
    "op4_pages": op4_pages,
    "op5_lines": op5_lines,
    "op6_chat": op6_chat,
    "op7_fingerprints": op7_fingerprints,
    "op8_mixing": op8_mixing,
    "op9_vectors": op9_vectors,
    "op10_chunks": op10_chunks,
}

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Words, shingles as joined words, all pairs that share one, and what links reach.
_NEAR_DUPLICATES = rf"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'), '[^\x20\x09-\x0D]+') as w from documents
), lists as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from words
), sets as (select doc_id, len(s) as n, unnest(s) as x from lists),
pairs as (
  select a.doc_id as a, b.doc_id as b from sets a join sets b on a.x = b.x and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
), reach(id, other) as (select doc_id, doc_id from documents union select r.id, p.b from reach r join pairs p on p.a = r.other)
select l.doc_id, cast(len(l.s) as bigint) as n_shingles, min(r.other) as component_id, min(r.other) = l.doc_id as kept
from lists l join reach r on r.id = l.doc_id group by l.doc_id, l.s
"""

_CHAT = """
with e as (
  select conv_id, turn as position, role, text, case role when 'user' then 'call' when 'assistant' then 'result' else 'message' end as kind,
    case role when 'user' then 'call-' || turn when 'assistant' then 'call-' || (turn - 1) end as call_id from conversations
), ids as (
  select conv_id, call_id, count(*) filter (kind = 'call') as n_calls, count(*) filter (kind = 'result') as n_results, min(position) filter (kind = 'result') as first_result
  from e where call_id is not null group by conv_id, call_id
), j as (select e.*, coalesce(n_calls, 0) as n_calls, coalesce(n_results, 0) as n_results, case when kind = 'call' then first_result end as first_result from e left join ids using (conv_id, call_id))
select conv_id, position, kind, call_id,
  case when kind = 'message' then 'message' when n_calls > 1 or n_results > 1 then 'duplicate' when kind = 'call' and n_results = 0 then 'unanswered' when kind = 'result' and n_calls = 0 then 'orphan' else 'linked' end as status,
  n_calls, n_results, first_result, row_number() over (partition by conv_id order by position) - 1 as seq, false as cycle,
  case kind when 'call' then '{"arguments":{"prompt":' || to_json(text) || '},"id":' || to_json(call_id) || ',"name":"reply","type":"tool_call"}'
    when 'result' then '{"content":' || to_json(text) || ',"tool_call_id":' || to_json(call_id) || ',"type":"tool_result"}'
    else '{"content":' || to_json(text) || ',"role":' || to_json(role) || ',"type":"message"}' end as json,
  case when kind = 'call' then case when text = '' then '$.prompt: length' else '' end end as errors
from j
"""

_NEAR_VECTORS = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings),
good as (select * from v where e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
pairs as (select a.vec_id as a, b.vec_id as b from good a join good b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.9),
reach(id, other) as (select vec_id, vec_id from v union select r.id, p.b from reach r join pairs p on p.a = r.other),
low as (select id, min(other) as component_id from reach group by id)
select vec_id, (select count(*) from pairs where a = vec_id) as n_links, component_id, component_id = vec_id as kept from v join low on low.id = vec_id
"""

#: The others need hashing, tokenizers, parsers or models that SQL hasn't; the tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {"op3_minhash": _NEAR_DUPLICATES, "op6_chat": _CHAT, "op9_vectors": _NEAR_VECTORS}
