"""The stages of the corpus pipeline: ``(spark, docs, sf_dir)`` to the documents that go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortix.llm import mixing as mix
from cohortix.llm import packing as pack
from cohortix.llm import pii as private
from cohortix.llm import simhash
from cohortix.llm import toxicity as toxic
from cohortix.llm.common import table
from cohortix.llm.queries import WORD_BPE, WORD_END


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier, trained on the labelled ones, does not reject."""
    return toxic.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.drop_near_copies(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data."""
    return private.pseudonymise(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes, as documents."""
    return mix.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed sequences, one row per piece."""
    return pack.pack(docs, WORD_BPE, end_id=WORD_END)
