"""A corpus pipeline: each stage is one operator of cloakframe.llm, and what it decides holds.

run() applies STAGES in order to the documents of ``sf_dir``. Every stage takes (spark,
docs, sf_dir), works on all rows that its predecessor kept, and, but for the last,
returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakframe.llm import decontaminate, langid, mix, ngramjoin, shard
from cloakframe.llm.common import Scratch, whole_rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
N_SHARDS = 24


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with some margin; the others go."""
    return langid.identify(docs).where(~F.col("rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links join: the one with the least id, null ids last.

    Of repeated rows one stays; documents without words all stay.
    """
    work, ids = Scratch(spark, "ngramjoin"), Scratch(spark, "stays")
    stays = ids.keep(ngramjoin.one_of_each(docs, scratch=work))
    work.close()
    return whole_rows(docs, stays)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    work, ids = Scratch(spark, "mix"), Scratch(spark, "taken")
    taken = ids.keep(mix.times(docs, scratch=work))
    work.close()
    return whole_rows(docs, taken)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents and each row's shard."""
    return shard.with_shards(docs, n_shards=N_SHARDS)


STAGES = [
    ("language-id", language_id),
    ("ngram-jaccard-join", near_duplicates),
    ("benchmark-decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL can't express the stages' models, sketches and cuts; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    scratch = Scratch(spark, "pipeline")
    before = None
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
        if before is not None:
            scratch.drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
