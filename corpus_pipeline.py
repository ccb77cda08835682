"""From documents to token records: language, near duplicates, benchmark passages, source weights, binary output.

Each stage is a function of (spark, docs, sf_dir); ``run`` writes what it returns to the shared folder and hands the
table read again to the next one. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rosterline.llm import decontamination, jaccard_join, language_id, mixing, token_output
from rosterline.llm.common import prepare, staged

# Of all tokens that reach the mixing stage; no document is taken twice.
MIX_SHARE = 0.9


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.fit(docs.where(~language_id.held_out()))
    return language_id.keep_identified(docs, model)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def by_weight(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs, share=MIX_SHARE, epochs=1)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output.write_and_read(docs, token_output.tokenizer_file())


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", by_weight),
    ("token_records", as_tokens),
]

# The language models and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
