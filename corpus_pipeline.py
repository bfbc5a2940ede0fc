"""From documents to token ids: quality rules, exact dedup, n-gram Jaccard join, source mixing, byte-level BPE.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept. All but the last return rows of documents with their own columns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallgrass.llm import byte_bpe, common, exact_dedup, ngram_join, quality_rules, source_mixing

VOCABULARY = "byte_bpe_50k.tiktoken"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learnt cutoffs accept."""
    return quality_rules.drop_bad(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of Jaccard similarity 0.8 or more connect."""
    return ngram_join.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: not at all, once, or twice as two rows."""
    return source_mixing.draw(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Each row's token ids, with digests of the ids and of the bytes that they decode to."""
    out = byte_bpe.with_ids(docs, vocabulary or public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return out.select("doc_id", "lang", "source", "bpe.n_tokens", "bpe.ids", "bpe.ids_sha256", "bpe.decoded_sha256")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", keep_good),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("source_mixing", mix_sources),
    ("byte_bpe", encode),
]

#: Sketches and MinHash have no form in SQL; tests hold run() against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each stage's rows written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
