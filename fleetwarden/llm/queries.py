"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import json

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from fleetwarden.llm.chat import link_tool_calls, turns_as_calls
from fleetwarden.llm.exact_dedup import exact_dedup
from fleetwarden.llm.fingerprints import edited_fingerprints
from fleetwarden.llm.html_wrappers import extract_text
from fleetwarden.llm.jaccard_join import jaccard_join
from fleetwarden.llm.mixing import mix_sources
from fleetwarden.llm.near_dedup import near_dedup
from fleetwarden.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from fleetwarden.llm.repair import repair
from fleetwarden.llm.sentencepiece_nbest import nbest_digests
from fleetwarden.llm.suffix_dedup import remove_repeats
from fleetwarden.llm.token_counts import token_counts
from fleetwarden.llm.toxicity import toxicity
from fleetwarden.llm.whitening import whiten


@query("""
    select d.doc_id, k.keep_id, k.group_size, d.doc_id = k.keep_id as kept,
      sha256(coalesce(d.text, '')) as text_sha256
    from documents d join (
      select coalesce(text, '') as t, max(doc_id) as keep_id, count(*) as group_size
      from documents group by 1) k on coalesce(d.text, '') = k.t""")
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


@query("""
    with n as (select source, count(*) as n_rows, sqrt(count(*)) as w from documents group by source),
    rates as (select source, (select sum(n_rows) from n) / (select sum(w) from n) * w / n_rows as rate from n),
    parts as (select source, rate, greatest(ceil(rate / 64), 1)::int as draws from rates),
    cdf as (
      select source, draws, list(c order by k) as cdf from (
        select source, draws, k, sum(exp(-m + k * ln(m) - lgamma(k + 1)))
          over (partition by source order by k) as c
        from (select source, draws, rate / draws as m, unnest(range(0, 200)) as k from parts))
      group by source, draws),
    drawn as (
      select d.*, list_sum(list_transform(range(0, draws), lambda j: len(list_filter(cdf, lambda c: c <=
        ('0x' || substr(md5('17:draw:' || j || ':' || d.doc_id), 1, 13))::bigint / 4503599627370496.0)))) as copies
      from documents d join cdf on d.source is not distinct from cdf.source)
    select doc_id, source, lang, n_chars, text, copies::int as copies, copy::int as copy,
      md5('17:order:' || copy || ':' || doc_id) as shuffle_key
    from (select *, unnest(range(1, copies::bigint + 1)) as copy from drawn)""")
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), exponent=0.5, seed=17)
    return mixed.select("row.doc_id", "row.source", "row.lang", "row.n_chars", "row.text", "copies", "copy", "shuffle_key")


@query("""
    with recursive w as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
    s as (
      select distinct doc_id, unnest(case when len(ws) >= 5
        then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as sh from w),
    n as (select doc_id, count(*) as n from s group by doc_id),
    c as (
      select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.sh = y.sh and x.doc_id <> y.doc_id
      group by 1, 2),
    links as (
      select a, b from c join n x on a = x.doc_id join n y on b = y.doc_id where 100 * c >= 75 * (x.n + y.n - c)),
    reach as (
      select doc_id as id, doc_id as m from documents
      union select links.a, reach.m from reach join links on links.b = reach.id),
    comp as (select id, min(m) as m from reach group by id)
    select d.doc_id, coalesce(n.n, 0) as n_shingles, comp.m as component_id, d.doc_id = comp.m as kept
    from documents d join comp on d.doc_id = comp.id left join n on n.doc_id = d.doc_id""")
def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))


@query()
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts(table(spark, sf_dir, "documents"), path, limit=2048)


@query()
def op2_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return nbest_digests(table(spark, sf_dir, "documents"), path, nbest=3)


@query()
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query()
def op9_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


# What the tools named by the roles of the conversations take.
TOOLS = {
    "user": {
        "type": "object",
        "properties": {
            "text": {"type": "string", "minLength": 1},
            "turn": {"type": "integer", "minimum": 0},
            "words": {"type": "integer", "minimum": 2},
        },
        "required": ["text", "turn", "words"],
        "additionalProperties": False,
    },
    "system": {"type": "object", "properties": {"turn": {"const": 0}}, "required": ["text"]},
}


@query("""
    with t as (select conv_id::varchar as conv_id, turn as position, role, coalesce(text, '') as text
      from conversations where conv_id is not null and turn is not null and role is not null),
    calls as (
      select conv_id, md5(conv_id || ':' || position) as call_id, min(position) as position, min(role) as name,
        min(text) as text, len(regexp_extract_all(min(text), '[^ \t\n]+')) as words
      from t where role <> 'assistant' group by 1, 2),
    results as (
      select conv_id, md5(conv_id || ':' || (position - 1)) as call_id, min(text) as content, count(*) as n
      from t where role = 'assistant' group by 1, 2),
    linked as (
      select c.conv_id, c.call_id, c.position, c.name, coalesce(r.n, 0) as n_results,
        case when c.name not in ('user', 'system') then 1
          when c.name = 'system' then (c.position <> 0)::int
          else (length(c.text) < 1)::int + (c.position < 0)::int + (c.words < 2)::int end as n_errors,
        '{"arguments":{"text":' || to_json(c.text)::varchar || ',"turn":' || c.position || ',"words":' || c.words ||
        '},"id":"' || c.call_id || '","name":' || to_json(c.name)::varchar || ',"result":' ||
        coalesce(to_json(r.content)::varchar, 'null') || '}' as message
      from calls c left join results r using (conv_id, call_id)
      union all
      select r.conv_id, r.call_id, null, null, r.n, 1, null
      from results r anti join calls c using (conv_id, call_id))
    select conv_id, call_id, position, position as anchor, case when position is not null then 0 end as lift, name,
      n_results, n_errors, n_errors = 0 and n_results = 1 as valid, sha256(message) as message_sha256 from linked""")
def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = turns_as_calls(table(spark, sf_dir, "conversations"))
    schemas = spark.createDataFrame([(k, json.dumps(v)) for k, v in TOOLS.items()], "name string, schema string")
    linked = link_tool_calls(calls, results, schemas)
    return linked.select(
        "conv_id", "call_id", "position", "anchor", "lift", "name", "n_results", F.size("errors").alias("n_errors"),
        "valid", F.sha2("message", 256).alias("message_sha256"),
    )


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"), length=400, keep_bytes=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), components=8)


@query()
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))


@query("""
    with recursive w as (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
    s as (
      select distinct doc_id, unnest(case when len(ws) >= 5
        then list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
        when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as sh from w),
    n as (select doc_id, count(*) as n from s group by doc_id),
    c as (
      select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.sh = y.sh and x.doc_id <> y.doc_id
      group by 1, 2),
    links as (
      select a, b from c join n x on a = x.doc_id join n y on b = y.doc_id where 100 * c >= 80 * (x.n + y.n - c)),
    reach as (
      select doc_id as id, doc_id as m from documents
      union select links.a, reach.m from reach join links on links.b = reach.id),
    comp as (select id, min(m) as m from reach group by id)
    select d.doc_id, coalesce(n.n, 0) as n_shingles, comp.m as component_id
    from documents d join comp on d.doc_id = comp.id left join n on n.doc_id = d.doc_id""")
def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))
