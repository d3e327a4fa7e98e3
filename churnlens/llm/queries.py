"""Registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import decontam, html, langid, lbl, lines, minmax, packing, periods, prefixes, quality, sentpieces
from . import tokenfiles, vectors
from .tokens import public_vocabulary


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(modulus: int):
    """crc32 of doc_id as text, modulo ``modulus``; the id may be null."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus, F.lit(0))


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html.extract(pages).select("page_id", "url", "text", "n_chars")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), public_vocabulary("word_bpe_49k.json"), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.flag(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, sf_dir, "labels"), _remainder(3) != 1)
    held_out = (_remainder(3) == 1).alias("held_out")
    return quality.score(docs, model).select("doc_id", held_out, "score", "predicted")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.train(docs, _remainder(4) != 2)
    held_out = (_remainder(4) == 2).alias("held_out")
    return langid.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out, "lang_pred", "score", "ambiguous"
    )


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(_table(spark, sf_dir, "documents"), words=2)


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    read = tokenfiles.token_ids(docs, public_vocabulary("byte_bpe_50k.json"), end_id=2)
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.score_texts(_table(spark, sf_dir, "documents"), _remainder(7) == 2)


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicate_vectors(_table(spark, sf_dir, "embeddings"))


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_vocabulary("piece_bpe_32k.model")
    coded = sentpieces.encode(_table(spark, sf_dir, "documents"), path, decoded=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select(
        "doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periods.detect(_table(spark, sf_dir, "documents"), periods.planted_period)
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    best = F.col("best")
    return found.withColumn("best", periods.strongest()).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefixes.rebuilt(_table(spark, sf_dir, "conversations"))
    return prefixes.prefix_trie(turns)


QUERIES = {
    "op1_html_extraction": op1_html_extraction,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_quality": op4_quality,
    "op5_line_dedup": op5_line_dedup,
    "op6_language_id": op6_language_id,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_token_ids": op8_token_ids,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_embedding_near_dedup": op10_embedding_near_dedup,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE = {
    "op5_line_dedup": """
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
  from documents),
k as (
  select doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from l),
c as (select key from k where key <> '' group by key having count(distinct doc_id) >= 10)
select k.doc_id, count(*) as n_lines, count(c.key) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (c.key is null), '')) as kept_sha256
from k left join c on k.key = c.key group by k.doc_id""",
    "op13_conversation_trie": """
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) as digest,
         row_number() over (partition by conv_id order by turn nulls first,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as i
  from conversations where conv_id is not null),
c as (
  select conv_id, count(*) as n, conv_id - conv_id % 100 as base,
         xor(4294967295, list_reduce(list_concat([4294967295::bigint],
           flatten(list_transform(string_split(conv_id::varchar, ''),
             lambda ch: list_transform(range(8), lambda b: (ascii(ch)::bigint >> b) & 1)))),
           lambda r, b: xor(r >> 1, 3988292384 * (xor(r, b) & 1)))) % 6 as h
  from t group by conv_id),
r as (
  select c.conv_id, t.i as p, t.digest, t.text from c join t on t.conv_id = c.base and t.i <= c.h
  union all
  select c.conv_id, least(c.h, coalesce(b.n, 0)) + t.i - c.h, t.digest, t.text
  from c join t on t.conv_id = c.conv_id and t.i > c.h left join c b on b.conv_id = c.base),
p as (
  select conv_id, 0 as depth, '' as key, null as parent, 0 as chars from c
  union all
  select conv_id, p, string_agg(digest, '') over (partition by conv_id order by p),
         coalesce(string_agg(digest, '') over (partition by conv_id order by p rows between unbounded preceding and 1 preceding), ''),
         length(text) from r),
n as (
  select key, max(depth) as depth, max(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs,
         (count(*) - 1) * max(chars) as saved
  from p group by key),
k as (select parent as key, count(*) as n_children from n where parent is not null group by parent),
e as (
  select key, string_agg(conv_id, ',' order by conv_id) as ends
  from (select conv_id, max_by(key, depth) as key from p group by conv_id) group by key),
s as (
  select a.key, sum(n.saved) as saved_tokens, count(*) filter (where k.key is null) as n_leaves
  from (select distinct a.key, b.key as below from p a join p b on a.conv_id = b.conv_id and a.depth <= b.depth) a
  join n on n.key = a.below left join k on k.key = a.below group by a.key)
select n.conv_id, n.depth::bigint as depth, q.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children,
       s.n_leaves, s.saved_tokens::bigint as saved_tokens, sha256(coalesce(e.ends, '')) as ends_sha256
from n join s on s.key = n.key left join n q on q.key = n.parent left join k on k.key = n.key left join e on e.key = n.key""",
}
