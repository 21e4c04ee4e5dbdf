"""The corpus pipeline: documents through the operators of ``aerostat.llm``, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerostat.llm.common import new_folder, settle, table
from aerostat.llm.exact_dedup import deduplicate
from aerostat.llm.langid import fit_documents, keep_identified
from aerostat.llm.packing import digest, pack_texts
from aerostat.llm.similarity_join import keep_first


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an identifiable language go (no letters, or a text that no language explains)."""
    settle(spark)
    return keep_identified(docs, fit_documents(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    settle(spark)
    return deduplicate(docs, "doc_id", "text")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of n-gram Jaccard links stays, that with the smallest id."""
    settle(spark)
    return keep_first(docs, "doc_id", "text")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document, tokenised and packed into sequences."""
    settle(spark)
    return digest(pack_texts(docs, "doc_id", "text"))


STAGES = [("language id", language_id), ("exact dedup", exact_dedup), ("n-gram Jaccard join", near_dedup), ("packing", packing)]

# tokenising and language models are beyond SQL; tests/llm hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each one's result written as Parquet in the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
