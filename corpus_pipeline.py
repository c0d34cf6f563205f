"""The corpus pipeline: filter, deduplicate, mask, mix and pack documents.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of documents. The table
of a stage is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm import crf, mixing, near, packing, pii, quality
from riskspark.llm.common import stored, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity passes. Of rows that repeat a doc_id, all stay if any passes."""
    return quality.filtered(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return near.deduplicated(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced in their texts."""
    return pii.masked(docs, crf.train(pii.labelled_table()))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say."""
    return mixing.resampled(docs, mixing.domains_of(table(spark, sf_dir, "labels")), mixing.TARGETS)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their windows."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mixing", mix_domains),
    ("packing", pack_windows),
]

#: The stages are models and tokenizers, which SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES):
            docs = stored(docs)
    return docs
