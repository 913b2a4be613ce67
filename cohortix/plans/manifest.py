"""Stages of a job that a rerun does not repeat.

A stage writes its tables and then, last, its manifest entry: the key of what it was computed
from, and its result as a document. A key covers the content of the input, the settings and the
stages before, so a rerun skips the stages that are finished and repeats those whose input has
changed. A job that was killed left no entry for the stage it was in.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.sources.sinks import read_document, write_document


def fingerprint(df: DataFrame) -> str:
    """The content of a table whatever the order and the partitions of its rows; columns and types count."""
    low = F.xxhash64(*df.columns)
    row = df.agg(F.count(F.lit(1)), F.sum(low.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(low, 32)),
                 F.bit_xor(F.hash(*df.columns))).first()
    return hashlib.sha256(f"{df.schema.simpleString()}|{tuple(row)}".encode()).hexdigest()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file is there, in any store Spark reaches."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


@dataclass
class Manifest:
    """The entries below ``out``; ``key`` goes from stage to stage."""

    spark: SparkSession
    out: str
    key: str
    skipped: list[str] = field(default_factory=list)

    def entry(self, stage: str) -> dict[str, Any] | None:
        path = f"{self.out}/manifest/{stage}"
        # the committer's mark is written last
        return read_document(self.spark, path) if exists(self.spark, f"{path}/_SUCCESS") else None

    def stage(self, name: str, work: Callable[[], dict[str, Any]], **settings: Any) -> dict[str, Any]:
        """The result of ``work``, or of the run that has finished this stage with the same key.

        ``work`` replaces what it writes; its result has to survive JSON. ``settings`` are
        those the stage depends on, in the key by their representation.
        """
        text = f"{self.key}|{name}|{sorted((k, repr(v)) for k, v in settings.items())}"
        self.key = hashlib.sha256(text.encode()).hexdigest()
        known = self.entry(name)
        if known and known["key"] == self.key:
            self.skipped.append(name)
            return known["result"]
        started = time.time()
        result = json.loads(json.dumps(work(), default=str))  # the same whether run or read
        write_document(self.spark, {"stage": name, "key": self.key, "seconds": round(time.time() - started, 1), "result": result},
                       f"{self.out}/manifest/{name}")
        return result


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    """``stage, key, seconds, result`` of the finished stages; the result as a variant."""
    doc = spark.read.text(f"{out}/manifest/*", wholetext=True).select(F.parse_json("value").alias("doc"))
    return doc.select(*[F.variant_get("doc", f"$.{c}", kind).alias(c) for c, kind in (
        ("stage", "string"), ("key", "string"), ("seconds", "double"), ("result", "variant"))])
