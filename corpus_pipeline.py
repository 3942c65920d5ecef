"""Corpus pipeline: each stage reads what its predecessor kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm import exact, langid, mixing, near, packing
from changeloom.session import stage as written
from changeloom.sources.tables import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model names stay (operator 2); those
    without a letter go."""
    return langid.keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays (operator 5)."""
    return exact.drop_duplicates(docs, keep="largest")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (operator 4)."""
    return near.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out to meet the target weights (operator 7)."""
    return mixing.take_mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens (operator 9)."""
    return packing.pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                                     "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = written(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


# Language identification is a trained model: no SQL for these rows.
ORACLE_SQL = None
