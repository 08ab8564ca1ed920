"""Queries of the operators of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontaminate, extract
from . import fingerprint as prints
from . import langid
from . import mix as mixing
from . import ngramjoin, pii, substrings
from . import shard as sharding

N_SHARDS = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.kd_shards(_table(spark, sf_dir, "documents"), n_shards=N_SHARDS)


def op2_boosted_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_table(spark, sf_dir, "pages"))


def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op4_exact_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prints.edited_fingerprints(_table(spark, sf_dir, "documents"))


def op9_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


#: The conversation that op10 formats besides the table's.
CONTROL_ID, CONTROL_TEXT = -7, "\\### Assistant: </turn> ok"


def op10_chat_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(CONTROL_ID).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"),
    )
    records = chat.from_turn_rows(rows.unionByName(control))
    return chat.read_back(chat.format_records(records, "record"))


def op5_information_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(_table(spark, sf_dir, "documents"))
    counts = [F.size(pii.of_kind(F.col("base"), kind)).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS]
    digest = F.sha2(pii.written(F.col("base")).cast("binary"), 256)
    more = [F.size(pii.of_kind(F.col("spans"), kind)).cast("bigint").alias(f"n_{kind}") for kind in ("secret", "term")]
    spans = F.col("spans")
    return found.select("doc_id", *counts, digest.alias("base_sha256"), pii.written(spans).alias("spans"), *more, F.size(spans).cast("bigint").alias("n_spans"))


def op6_compact_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_passages(_table(spark, sf_dir, "documents"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join_components(_table(spark, sf_dir, "documents"))


def op8_compression_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = langid.identify(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    held_out = langid.fold(F.col("doc_id")) == langid.HELD_OUT
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_kd_shards, op2_boosted_extraction, op3_pareto_mix, op4_exact_fingerprints, op5_information_pii, op6_compact_windows, op7_ngram_jaccard, op8_compression_langid, op9_template_decontamination, op10_chat_schema)}


#: op7 by brute force: all pairs that share a shingle, and the least id that links reach.
_OP7_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * i >= 80 * (nx.c + ny.c - i)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS m FROM documents UNION SELECT e.y, r.m FROM r JOIN e ON e.x = r.doc_id)
SELECT d.doc_id, coalesce(n.c, 0) AS n_shingles, min(r.m) AS component_id FROM documents d JOIN r USING (doc_id) LEFT JOIN n USING (doc_id) GROUP BY ALL"""

_OP10_SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
CAST(sum(15 + length(role) + length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'))) AS BIGINT) AS formatted_chars, 'turns' AS layout
FROM t GROUP BY conv_id"""


def oracle_sql() -> dict[str, str]:
    return {"op7_ngram_jaccard": _OP7_SQL, "op10_chat_schema": _OP10_SQL}
