"""The corpus pipeline over ``documents``, stage by stage, each written and read again."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortix.llm import stages
from cohortix.llm.common import table
from cohortix.session import shared_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.toxicity),
    ("simhash near-dedup", stages.near_dedup),
    ("pii", stages.pii),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

# Kernels, trained models and token ids are beyond SQL; the stages are tested by brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed sequences of the documents that every stage kept."""
    folder = f"{shared_dir(spark)}/cohortix/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
