"""A pipeline over documents: language, exact and near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``docs``. What a stage returns is written down and read again as the next one's documents.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from topicloom.llm.exact import drop_exact
from topicloom.llm.jaccard import drop_near
from topicloom.llm.language import identified
from topicloom.llm.mixing import mixed
from topicloom.llm.packing import byte_bpe, packed
from topicloom.session import saved
from topicloom.sources.testdata import table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, that with the smallest id."""
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 80 % of their five-word shingles."""
    return drop_near(docs, size=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many words as there are, by source weights; a document may come up to three times."""
    return mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packed(docs, partial(byte_bpe, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("pack", pack),
]

# Learned languages, similarity components and tokens are not for SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
