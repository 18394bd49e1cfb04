"""The corpus pipeline: stages over the documents table, each reading what its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stocktake.llm.langid import keep_identified
from stocktake.llm.ngram_join import keep_one_of_each_group
from stocktake.llm.packing import pack_documents
from stocktake.llm.quality import keep_good
from stocktake.llm.queries import tokenizer_file
from stocktake.llm.secrets import redact_secrets
from stocktake.llm.text import scratch, stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no identified language go."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one_of_each_group(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by a mark."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document's token pieces in sequences."""
    return pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("language ID", language), ("n-gram Jaccard join", near_duplicates), ("secret scans", secrets), ("best-fit packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, docs = scratch(spark), table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), root, f"stage_{k}")
    return docs


# Tokenizers and trained models are beyond SQL: tests compare the stages with brute force.
ORACLE_SQL = None
