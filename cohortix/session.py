"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BROADCAST_ROWS = 10_000
ROWS_PER_TASK = 50_000
FIT_TASKS = 10_000  # beyond so many tasks their rows grow instead

_local_dir: str | None = None
_shipped: set[str] = set()


def build_session(master: str | None = None, app: str = "cohortix", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only in local mode."""
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="cohortix-")
    return _local_dir


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for functions that run in Python.

    Without it they would need the package installed, or the session started in its folder.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="cohortix-code-"), "cohortix_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("cohortix", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a columnar table, so later passes prune columns and a lost
    executor costs one file scan, not the joins and shuffles above it.
    """
    path = f"{shared_dir(df.sparkSession)}/cohortix/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep ``df`` in executor memory (spilling to disk) for an iterative fit."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def sized(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, most: int = FIT_TASKS) -> DataFrame:
    """Deal a table by the hash of ``key`` to as many partitions as its rows are worth, ``most`` at most.

    Their number and content depend on the rows alone, so a seeded fit gives the same on any
    cluster.
    """
    return df.repartition(min(most, max(1, -(-df.count() // rows_per_task))), key)


def frame_of(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few driver rows as a local relation: planning it starts no job."""
    types = T.StructType.fromDDL(schema)
    columns = [
        pa.array([row[i] for row in rows], type=to_arrow_type(f.dataType))
        for i, f in enumerate(types)
    ]
    return spark.createDataFrame(pa.table(columns, names=types.names), schema=types)


def prepare_checkpoints(spark: SparkSession) -> None:
    """Let iterative ``pyspark.ml`` fits cut their lineage in the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))


def small_side(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Evaluate ``df`` and mark it for broadcast if it has at most ``limit`` rows.

    A larger table comes back as it was, and the planner chooses the join.
    """
    table = df.limit(limit + 1).toArrow()
    if table.num_rows > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(table, schema=df.schema))
