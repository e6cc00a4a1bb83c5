"""From raw documents to token ids: five stages, each over all that the one before has kept.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame, which :func:`run` writes to the
shared folder and reads again as the next stage's documents. All but the last keep the columns of
``documents``; where a text changes, ``n_chars`` follows it. Columns beyond those pass through.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from flowloom.llm import bpe, decontaminate, lineruns, simhash, toxicity
from flowloom.plans.staging import stage_table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from labelled rows that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.reject(docs, toxicity.fit(docs, labels))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of line runs of 50 words or more; emptied ones go."""
    return lineruns.clean(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of near copies: three bits of a SimHash of three-word shingles."""
    return simhash.keep_one(docs)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those that hold little else go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and the text that the ids decode to."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, bpe.tokens, bpe.TOKEN_FIELDS)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_runs", drop_repeated_lines),
    ("simhash", drop_near_copies),
    ("benchmark", cut_benchmark),
    ("bpe", to_tokens),
]

# Training a classifier and near copies have no SQL; tests compare the stages with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return docs
