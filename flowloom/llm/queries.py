"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.llm import (
    bpe,
    crosspolytope,
    decontaminate,
    hardnegatives,
    lineruns,
    ngramjoin,
    pii,
    secretscan,
    simhash,
    spellings,
    suffixlevels,
    toxicity,
    warc,
)
from flowloom.plans.staging import fresh_path


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pii.digest_columns(pii.detect(docs, pii.fit(docs)))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digest_columns(secretscan.detect(_table(spark, sf_dir, "documents")))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.digest_columns(found)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    docs = _table(spark, sf_dir, "documents")
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, bpe.digests, bpe.DIGEST_FIELDS)


def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosspolytope.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest_columns(simhash.classes(_table(spark, sf_dir, "documents")))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").alias("payload"))
    archive = fresh_path(spark, "warc")
    warc.write_archives(pages, archive)
    return warc.digest_columns(warc.transactions(warc.read_records(spark, archive), with_payload=False))


def op8_suffix_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixlevels.digest_columns(suffixlevels.deduplicate(_table(spark, sf_dir, "documents")))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineruns.digest_columns(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = _table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hardnegatives.mine(rows, F.col("id") % 100 == 0)


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.classes(_table(spark, sf_dir, "documents"))


def op13_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spellings.variants(spellings.word_counts(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_secrets": op2_secrets,
    "op3_decontaminate": op3_decontaminate,
    "op4_bpe": op4_bpe,
    "op5_nearest": op5_nearest,
    "op6_simhash": op6_simhash,
    "op7_warc": op7_warc,
    "op8_suffix_levels": op8_suffix_levels,
    "op9_toxicity": op9_toxicity,
    "op10_line_runs": op10_line_runs,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_ngram_join": op12_ngram_join,
    "op13_spellings": op13_spellings,
}
