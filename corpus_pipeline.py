"""A corpus pipeline of five operators: language ID, quality rules,
near-dedup, mixing, packing. Each stage works on all that its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from loomwork.llm import language_id, mixing, packing, quality_rules, simhash
from loomwork.llm.common import materialize, read_table, small_batches, unpacked
from loomwork.llm.queries import tokenizer_paths


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some language model fits; the rejected go."""
    small_batches(spark)
    return unpacked(language_id.identify_languages(docs, whole=True).where("NOT rejected"))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    small_batches(spark)
    trusted = quality_rules.trusted_ids(read_table(spark, sf_dir, "labels"))
    return quality_rules.kept_documents(docs, trusted)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group at 5-word Jaccard 0.8 or more."""
    small_batches(spark)
    return simhash.simhash_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources repeats them."""
    small_batches(spark)
    return mixing.mixed_corpus(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    small_batches(spark)
    return packing.pack_documents(docs, *tokenizer_paths())


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("simhash_dedup", remove_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Trained models and 64-bit hashes decide the stages, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each reading the Parquet of the one before."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
