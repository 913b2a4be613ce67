"""Scoring of newly landed files. The scorer is stateless, so the batch transform is reused."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from cohortix.operators.score import Scorer


def landed(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def score_stream(rows: DataFrame, scorer: Scorer, out: str, progress: str) -> StreamingQuery:
    """Score everything that has landed since the last run and stop; exactly once per file."""
    return (
        scorer.score(rows).writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", progress).trigger(availableNow=True).start(out)
    )
