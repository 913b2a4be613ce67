"""Helpers the corpus operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.session import ship_package, written

WORD = r"[^\x20\x09-\x0D]+"


# Batches of whole texts handed to Python: few enough to stay small in both processes.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1_000,
         "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}

_caches: dict[str, Callable[[], None]] = {}


def sole_cache(owner: str, drop: Callable[[], None]) -> None:
    """Keep one operator's table of remembered strings in a worker process; ``drop`` empties it.

    Workers serve one stage after another, and the tables of earlier stages would stay.
    """
    others = [o for o in _caches if o != owner]
    for other in others:
        _caches.pop(other)()
    _caches[owner] = drop
    if others:
        give_back()


def give_back() -> None:
    """Return freed memory of this worker process to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def ready(spark: SparkSession) -> None:
    """Let functions over whole texts run on the executors: ship the package, keep batches small.

    A smaller batch that the session already asks for stays.
    """
    ship_package(spark)
    for key, most in BATCH.items():
        asked = spark.conf.get(key, None) or ""
        if not asked.isdigit() or not 0 < int(asked) <= most:
            spark.conf.set(key, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, stem: str) -> str:
    """A column name ``df`` does not have (names are compared without case, as Spark does)."""
    taken = {c.lower() for c in df.columns}
    name = stem
    while name.lower() in taken:
        name += "_"
    return name


def filled(c: Column | str) -> Column:
    """A text column with missing text as the empty string."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def row_order(id_col: str, text_col: str) -> list[Column]:
    """A total order of rows up to rows that are equal in id and text; missing ids come last."""
    return [F.col(id_col).asc_nulls_last(), F.xxhash64(F.col(text_col)).asc()]


def offsets(sizes: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """Add what lies before each row of an aggregated table, per ``by`` and in ``order``."""
    from pyspark.sql import Window as W

    frame = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return sizes.withColumn(out, F.coalesce(F.sum(value).over(frame), F.lit(0)))


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` of every node of an undirected graph; ``root`` is the smallest node it reaches.

    Alternates the large-star and small-star steps (Kiveris et al., 2014): each moves the
    neighbours of a node to the smallest of them. The smallest neighbour is a combining
    aggregate and is joined back, so a node that a third of the edges share is neither
    gathered nor windowed. Every round is a written table, and only its count and a
    checksum reach the driver. A null end makes no edge; without edges there are no rows.
    """
    pairs = edges.select(
        F.greatest(F.col(a), F.col(b)).alias("u"), F.least(F.col(a), F.col(b)).alias("v")
    ).where("u is not null and v is not null and u > v").distinct()
    pairs = written(pairs, "links")
    state = _state(pairs)
    for _ in range(max_rounds):
        if not state[0]:
            break
        pairs = written(_small_star(_large_star(pairs)), "links")
        before, state = state, _state(pairs)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _state(pairs: DataFrame) -> tuple[int, int]:
    mix = F.xxhash64("u", "v").bitwiseAND(F.lit(0xFFFFFFFF))
    row = pairs.agg(F.count("*"), F.coalesce(F.sum(mix), F.lit(0))).first()
    return row[0], row[1]


def _large_star(pairs: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u"), F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    )


def _small_star(pairs: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.union(own).where("u > v").distinct()
