"""The operators applied to their whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.llm import (
    html_extract,
    language_id,
    license_scan,
    mixing,
    oracles,
    packing,
    quality_rules,
    resharding,
    rp_forest,
    simhash,
    site_quality,
)
from loomwork.llm.common import read_table, small_batches

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_paths() -> tuple[str, str]:
    """Where the public vocabulary files are; every node has them."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER), public_tokenizers.path(RANKS)


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(read_table(spark, sf_dir, "documents")).drop("source")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rp_forest.embedding_links(read_table(spark, sf_dir, "embeddings"))


def op3_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), *tokenizer_paths())


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(read_table(spark, sf_dir, "documents"))


def op5_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(read_table(spark, sf_dir, "pages"))


def op6_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharding.reshard(read_table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents")).drop("spans")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.hamming_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality_rules.trusted_ids(read_table(spark, sf_dir, "labels"))
    return quality_rules.quality_verdicts(read_table(spark, sf_dir, "documents"), trusted)


def op10_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.classify_sites(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1's sizes and targets, which SQL can check."""
    return op1_mix(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


def reshard_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6's rows, each with its size."""
    return op6_reshard(spark, sf_dir).select("doc_id", "size", "law")


def licenses_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7's base columns."""
    return op7_licenses(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9's base columns."""
    return op9_quality_rules(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _tuned(query: Query) -> Query:
    """The query in a session with small Arrow batches."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    operators = (op1_mix, op2_embedding_dedup, op3_pack, op4_language_id, op5_extract, op6_reshard, op7_licenses, op8_simhash, op9_quality_rules, op10_site_quality)
    return {f.__name__: _tuned(f) for f in (*operators, pipeline, mix_targets, reshard_sizes, licenses_base, quality_base)}


def oracle_sql() -> dict[str, str]:
    """SQL of the operators that SQL can express, and of columns of others; the rest have brute-force tests."""
    return {
        "op2_embedding_dedup": oracles.EMBEDDING_LINKS,
        "op5_extract": oracles.MAIN_TEXT,
        "mix_targets": oracles.MIX_TARGETS,
        "reshard_sizes": oracles.RESHARD_SIZES,
        "licenses_base": oracles.LICENSE_BASE,
        "quality_base": oracles.QUALITY_BASE,
    }
