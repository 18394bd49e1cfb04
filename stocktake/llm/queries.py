"""The registered queries ``opN_<name>``: each applies its operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stocktake.llm.fingerprint import fingerprint_documents
from stocktake.llm.gru_lm import score_documents
from stocktake.llm.html_text import extract_text
from stocktake.llm.langid import identify_languages
from stocktake.llm.lexical import rank_documents
from stocktake.llm.ngram_join import near_duplicate_groups
from stocktake.llm.nsimplex import cluster_vectors
from stocktake.llm.packing import pack_documents
from stocktake.llm.pieces import piece_digests
from stocktake.llm.quality import quality_rules
from stocktake.llm.secrets import scan_secrets
from stocktake.llm.text import table
from stocktake.llm.token_store import token_round_trip
from stocktake.llm.warc import warc_round_trip


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer's file (the same on every machine)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_quality_rules": op2_quality_rules,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_language_id": op4_language_id,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_warc": op6_warc,
    "op7_token_ids": op7_token_ids,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_fingerprints": op9_fingerprints,
    "op10_secret_scans": op10_secret_scans,
    "op11_ranked_search": op11_ranked_search,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_html_extraction": op13_html_extraction,
    "pipeline": pipeline,
}
