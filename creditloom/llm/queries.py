"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import (
    codes,
    decontamination,
    licenses,
    lines,
    mixing,
    neighbours,
    passages,
    prefixes,
    quality,
    quotations,
    setjoin,
    simhash,
    toxicity,
)
from creditloom.llm.common import documents, embeddings
from creditloom.session import configure


def op1_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share; documents without any have no row."""
    return passages.shared_passages(documents(configure(spark), sf_dir)).drop("text_key")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base places and license labels of every document."""
    return licenses.scan(documents(configure(spark), sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by its nearest labelled examples."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.classify(documents(configure(spark), sf_dir), labels)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.taken(documents(configure(spark), sf_dir)).drop("source")


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest vectors of every vector whose id is divisible by 50."""
    return neighbours.nearest(embeddings(configure(spark), sf_dir), k=5, every=50)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier line repeats or nearly repeats."""
    return lines.dedup_lines(documents(configure(spark), sf_dir)).select("doc_id", "text", "n_lines", "n_dropped")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document holds; documents that hold none have no row."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated(documents(configure(spark), sf_dir), benchmark).drop("text_key")


def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without quotes, with its place in the reply order."""
    return quotations.reply_ordered(configure(spark).read.parquet(f"{sf_dir}/conversations.parquet"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of trusted text, and whether it stays."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(documents(configure(spark), sf_dir), labels).drop("text_key")


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(documents(configure(spark), sf_dir), shingle=3, max_bits=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefixes.prefix_trie(configure(spark).read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector."""
    return codes.compress(embeddings(configure(spark), sf_dir))


def op13_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of every document."""
    return setjoin.near_sets(documents(configure(spark), sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_shared_passages": op1_shared_passages,
    "op2_license_scan": op2_license_scan,
    "op3_toxicity": op3_toxicity,
    "op4_source_mixing": op4_source_mixing,
    "op5_nearest_neighbours": op5_nearest_neighbours,
    "op6_line_dedup": op6_line_dedup,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_quotation_linking": op8_quotation_linking,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_vector_codes": op12_vector_codes,
    "op13_ngram_jaccard": op13_ngram_jaccard,
}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_license_scan": licenses.scan_sql(),
        "op4_source_mixing": mixing.taken_sql(),
        "op11_prefix_trie": prefixes.prefix_trie_sql(),
        "op12_vector_codes": codes.compress_sql(),
        "op13_ngram_jaccard": setjoin.near_sets_sql(),
    }
