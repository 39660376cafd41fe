"""A training corpus from `documents`: quality rules, exact dedup, near-copy join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents. Rows that repeat are copies in the dedup stages and count one by one in the
others; texts of any length are taken whole; every stage turns an empty table into an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import common, dedup, mixing, ngram_join, packing, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule, or come from a host that is rejected, go; null, empty and short texts fail (quality.keep_good)."""
    return quality.keep_good(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id stays; null texts are empty ones (dedup.drop_copies)."""
    return dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links of similar five-word shingles connect, the one with the least doc_id stays; texts without words all do (ngram_join.drop_near_copies)."""
    return ngram_join.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the target weights of the sources ask for; a null source is one too (mixing.mixed_documents)."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens; null and empty texts have the end id only (packing.packed_pieces)."""
    return packing.packed_pieces(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_copies", near_copies), ("mix_sources", mix_sources), ("pack", pack)]

#: Neither the near-copy join nor the packing of token ids can be written in SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again; a table goes as soon as the next one is written."""
    docs = common.documents(spark, sf_dir)
    last = None
    for name, stage in STAGES[:-1]:
        path = common.shared_path(spark, name)
        docs = common.staged(stage(spark, docs, sf_dir), name, path=path)
        if last:
            common.delete(spark, last)
        last = path
    packed = STAGES[-1][1](spark, docs, sf_dir)
    common.delete(spark, last)
    return packed
