"""From raw documents to packed sequences: each stage gets the stored result of the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfcast.llm import es_mix, exact_blocks, hilbert_pack, lang_kn, simhash_grid
from shelfcast.llm.common import stored
from shelfcast.llm.queries import table, vocabulary


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models accept."""
    return lang_kn.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact_blocks.dedup_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies the one with the smallest doc_id."""
    return simhash_grid.dedup_near(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return es_mix.mixed_documents(docs, table(spark, sf_dir, "labels"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return hilbert_pack.packed(docs, vocabulary()).drop("ids")


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("mix", mixed), ("pack", packed)]

#: A learned model and a tokenizer have no SQL; tests compare each stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
