"""Queries of this subpackage: each runs one operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlens.llm.common import read
from adlens.llm.fingerprints import edited_fingerprints
from adlens.llm.knn import top_k
from adlens.llm.licenses import license_matches
from adlens.llm.line_dedup import line_dedup
from adlens.llm.mixing import mixed_words
from adlens.llm.ngram_join import ngram_join
from adlens.llm.packing import pack
from adlens.llm.pii import pseudonymise
from adlens.llm.quality import quality_scores
from adlens.llm.token_counts import token_counts
from adlens.llm.toxicity import toxicity_scores
from adlens.llm.variants import spelling_variants
from adlens.llm.whitening import whiten


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(read(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "class_size", "n_links")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read(spark, sf_dir), read(spark, sf_dir, "labels"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(read(spark, sf_dir).select("doc_id", "text"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_words(read(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir)).drop("text_hash")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_counts(read(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read(spark, sf_dir))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pseudonymise(read(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "text", F.size("found").alias("n_values"),
                      F.array_join(F.transform("found", lambda x: x["kind"]), ",").alias("kinds"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(read(spark, sf_dir))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read(spark, sf_dir), read(spark, sf_dir, "labels"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op10_quality_classifier": op10_quality_classifier,
    "op3_line_dedup": op3_line_dedup,
    "op7_source_mixing": op7_source_mixing,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op8_token_counts": op8_token_counts,
    "op4_document_fingerprints": op4_document_fingerprints,
    "op9_exact_top_k": op9_exact_top_k,
    "op5_pii_pseudonyms": op5_pii_pseudonyms,
    "op6_license_scan": op6_license_scan,
    "op13_toxicity": op13_toxicity,
    "op12_spelling_variants": op12_spelling_variants,
    "op11_embedding_whitening": op11_embedding_whitening,
}
