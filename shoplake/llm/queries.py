"""The operators as queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplake.llm import (
    ann, bpe, chat, filter_audit, licences, mixing, neardup, ngram_join, quality, resampling, secret_scan, topk, urlfilter)
from shoplake.llm.common import table

QUERY_STEP = 50  # rows whose vec_id is divisible by it are queries
CHECK_TEXT = r"\### Assistant: </turn> ok"
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def tokenizer() -> tuple[str, str]:
    """Path of the vocabulary file and its split pattern; the path may be given by TOKENIZER_FILE."""
    import public_tokenizers

    return os.environ.get("TOKENIZER_FILE") or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op1_chat_prefix_targets(spark: SparkSession, d: str) -> DataFrame:
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CHECK_TEXT), (-7, 1, "assistant", CHECK_TEXT)],
                                  "conv_id long, turn long, role string, text string")
    return chat.digests(chat.expand(turns.unionByName(extra)))


def op2_dart_minhash(spark: SparkSession, d: str) -> DataFrame:
    found = neardup.classes(table(spark, d, "documents"))
    return found.select("doc_id", "class_id", "keep", "copies", "links")


def op3_neighbour_quality(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, d, "labels"), quality.learnable())
    return quality.score(docs, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


def op4_bloom_cascade(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "rule string, action string")
    return urlfilter.judge(table(spark, d, "pages"), rules)


def op5_secret_ownership(spark: SparkSession, d: str) -> DataFrame:
    return secret_scan.scan(table(spark, d, "documents"))


def op6_sainte_lague(spark: SparkSession, d: str) -> DataFrame:
    return mixing.plan(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_bpe_merge_replay(spark: SparkSession, d: str) -> DataFrame:
    return bpe.encode(table(spark, d, "documents"), *tokenizer(), digest=True)


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files: source/lang/<id div 100>/<id>.txt; every 100th is its directory's LICENSE, every 1000th its language's."""
    top = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("xx")))
    below = F.concat(F.lit("d"), F.expr("cast(doc_id div 100 as string)"))
    path = (F.when(F.col("doc_id") % 1000 == 0, F.concat_ws("/", top, F.lit("LICENSE")))
            .when(F.col("doc_id") % 100 == 0, F.concat_ws("/", top, below, F.lit("LICENSE")))
            .when(F.col("doc_id").isNotNull(), F.concat_ws("/", top, below, F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))))
    return docs.select("doc_id", path.alias("path"), "text")


def op8_licence_inheritance(spark: SparkSession, d: str) -> DataFrame:
    return licences.scan(document_paths(table(spark, d, "documents")))


def op9_cover_tree_topk(spark: SparkSession, d: str) -> DataFrame:
    return topk.search(table(spark, d, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


def op10_cross_polytope(spark: SparkSession, d: str) -> DataFrame:
    return ann.search(table(spark, d, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


def op11_filter_diagrams(spark: SparkSession, d: str) -> DataFrame:
    return filter_audit.audit(table(spark, d, "documents"), table(spark, d, "labels"))


def op12_importance_resampling(spark: SparkSession, d: str) -> DataFrame:
    return resampling.resample(table(spark, d, "documents"), table(spark, d, "benchmark"))


def op13_metric_ngram_join(spark: SparkSession, d: str) -> DataFrame:
    return ngram_join.join(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_chat_prefix_targets, op2_dart_minhash, op3_neighbour_quality, op4_bloom_cascade, op5_secret_ownership,
        op6_sainte_lague, op7_bpe_merge_replay, op8_licence_inheritance, op9_cover_tree_topk, op10_cross_polytope,
        op11_filter_diagrams, op12_importance_resampling, op13_metric_ngram_join)}


_OP1 = r"""
with t as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') x from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, row_number() over (partition by conv_id order by turn nulls first, r, x) k,
    -- '### ', ': ' and '</turn>' with its line end, and one more character for each escape
    4 + length(r) + 2 + length(x) + 8
    + length(regexp_replace(r || x, '[^\\]', '', 'g')) + length(regexp_replace(r, '[^:]', '', 'g'))
    + coalesce(list_sum([greatest(length(h) - 2, 0) for h in regexp_extract_all(x, '#+')]), 0)
    + coalesce(list_sum([greatest(length(h) - 2, 0) for h in regexp_extract_all(r, '#+')]), 0)
    + len(regexp_extract_all(x, '</turn>')) + len(regexp_extract_all(r, '</turn>')) as n
  from t),
c as (
  select *, sum(n) over (partition by conv_id order by k) upto,
    k = max(k) over (partition by conv_id) is_last from e)
select conv_id, count(*) n_turns, sha256(string_agg(r || chr(10) || x || chr(10), '' order by k)) turns_sha256,
  cast(coalesce(sum(length(x)) filter (r = 'assistant'), 0) as bigint) loss_chars,
  sha256(coalesce(string_agg(x, '' order by k) filter (r = 'assistant'), '')) loss_sha256,
  cast(sum(upto) filter (r = 'assistant' or is_last) as bigint) formatted_chars,
  count(*) filter (r = 'assistant' or is_last) n_examples
from c group by conv_id
"""

_OP4 = r"""
with p as (
  select page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
    regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') path from pages),
j as (
  select *, case when (host = 'example.net' or ends_with(host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (host = 'example.com' or ends_with(host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (host = 'net' or ends_with(host, '.net')) and starts_with(path, '/') then 'net/' end as rule from p)
select page_id, host, path, rule, case when rule in ('net/', 'example.com/de/') then 'block' else 'allow' end verdict from j
"""

_OP9 = r"""
with v as (
  select row_number() over () r, vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] e
  from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0),
s as (
  select q.r, q.vec_id query_id, c.vec_id,
    cast(coalesce(list_sum([a[1] * a[2] for a in list_zip(q.e, c.e)]), 0) as bigint) score
  from v q join v c on q.r <> c.r and len(q.e) = len(c.e) where q.vec_id % 50 = 0)
select query_id, cast(rank as integer) rank, vec_id, score from (
  select *, row_number() over (partition by r order by score desc, vec_id) rank from s) where rank <= 5
"""

_OP11 = r"""
with d as (
  select doc_id, coalesce(source, '') part, coalesce("text", '') x from documents),
w as (
  select *, regexp_extract_all(x, '[^\x20\x09-\x0D]+') words, min(doc_id) over (partition by x) first from d),
l as (
  select doc_id, bool_or(coalesce(quality = 1, false)) good, bool_or(coalesce(toxic = 1, false)) toxic
  from labels where doc_id is not null group by doc_id),
f as (
  select part, coalesce(good, false) good, coalesce(toxic, false) toxic,
    len(words) < 50 a, 100 * len(list_distinct(words)) < 65 * len(words) b,
    100 * length(regexp_replace(x, '[^A-Z]+', '', 'g')) > 5 * length(x) c,
    regexp_matches(x, '[#$%&*|]') d, coalesce(w.doc_id > first, first is not null) e
  from w left join l on w.doc_id = l.doc_id),
m as (
  select part, a, b, c, d, e, count(*) n, count(*) filter (good) n_good, count(*) filter (toxic) n_toxic
  from f group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) x),
orders as (
  select p.x || q.x || r.x || s.x || t.x filter_order
  from letters p, letters q, letters r, letters s, letters t
  where len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps as (select filter_order, unnest(range(1, 6)) step from orders),
fails as (
  select *, list_filter(['A', 'B', 'C', 'D', 'E'], lambda z, i: [a, b, c, d, e][i]) failed from m),
passed as (
  select part, filter_order, step, n, n_good, n_toxic, failed,
    len(list_filter(failed, lambda z: instr(filter_order, z) < step)) = 0 came,
    list_contains(failed, filter_order[step]) fails
  from fails cross join steps),
total as (
  select part, filter_order, cast(step as integer) step,
    cast(coalesce(sum(n) filter (came and not fails), 0) as bigint) kept,
    cast(coalesce(sum(n) filter (came and fails), 0) as bigint) removed,
    cast(coalesce(sum(n) filter (fails and not came), 0) as bigint) redundant,
    cast(coalesce(sum(n) filter (fails and len(failed) = 1), 0) as bigint) unique_fails,
    cast(coalesce(sum(n_good) filter (came and fails), 0) as bigint) good_lost,
    cast(coalesce(sum(n_toxic) filter (came and fails), 0) as bigint) toxic_lost
  from passed group by all)
select *, cast(sum(removed) over (partition by part, filter_order[step]) as bigint) shapley from total
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_prefix_targets": _OP1, "op4_bloom_cascade": _OP4, "op9_cover_tree_topk": _OP9,
            "op11_filter_diagrams": _OP11}
