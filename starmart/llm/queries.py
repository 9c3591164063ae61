"""One query per operator over its whole table, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import chat, jaccard, merkle, mixing, omh, oracle, packing, quality, sharding, token_orc, topk, toxicity, trie, warc
from starmart.llm.common import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.sql("SELECT cast(-1 AS bigint) AS conv_id, turn, role, text FROM VALUES (0L, 'user', :probe), (1L, 'assistant', :probe) AS t(turn, role, text)", {"probe": probe})
    return chat.digests(chat.format_conversations(rows.unionByName(extra)))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_components(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op6_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orc")
    token_orc.write_tokens(_table(spark, sf_dir, "documents"), path)
    return token_orc.read_tokens(spark, path)


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return omh.fingerprint_documents(_table(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_documents(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_sizes(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(_table(spark, sf_dir, "conversations"))


def op12_pivot_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_formatting": op1_chat_formatting,
    "op2_warc": op2_warc,
    "op3_toxicity": op3_toxicity,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_quality_rules": op5_quality_rules,
    "op6_token_orc": op6_token_orc,
    "op7_order_minhash": op7_order_minhash,
    "op8_sharding": op8_sharding,
    "op9_mixing": op9_mixing,
    "op10_packing": op10_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_pivot_topk": op12_pivot_topk,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_WORD = r"[^\x20\x09-\x0D]+"

def _sql_escape(text: str) -> str:
    """The template's escaping as DuckDB SQL: a backslash after the first character of each control string."""
    for head in sorted({c[0] for c in chat.CONTROL}):
        tails = "|".join(re.escape(c[1:]) for c in chat.CONTROL if c[0] == head)
        text = f"regexp_replace({text}, '({re.escape(head)})(\\\\*)({tails})', '\\1\\\\\\2\\3', 'g')"
    return text


ORACLE: dict[str, str] = {
    **oracle.ORACLE,
    "op1_chat_formatting": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(8 + length(url_encode(role)) + length({_sql_escape('text')}))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id""",
    "op9_mixing": f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
         md5(concat_ws(':', '17', doc_id::VARCHAR)) AS k
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, list_extract([5, 2, 1], 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::BIGINT AS weight FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS remains,
         (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS rest
  FROM w WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)),
c AS (
  SELECT *, min((3 * source_size * rest <= weight * remains)::INT) OVER (ORDER BY source_size / weight, source NULLS LAST) = 1 AS stops FROM l),
t AS (
  SELECT source, source_size,
         CASE WHEN stops THEN (3 * source_size)::DOUBLE
              ELSE weight * (SELECT arg_min(remains::DOUBLE / rest, source_size / weight) FROM c WHERE NOT stops) END AS target
  FROM c),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS passes,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (passes * size + greatest(0, least(size, floor(target)::BIGINT - passes * source_size - place)))::BIGINT AS taken
FROM p""",
}
