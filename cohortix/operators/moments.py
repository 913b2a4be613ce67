"""Weighted sums of rows for many sets of components in one pass.

K-Means, the start of a mixture from hard labels and the E-step all need, per component, the
weight of its rows, their weighted sum and their weighted sum of squares. Each task reduces
its rows to these small matrices for every set (restart, or k) at once, and the matrices are
added up: one scan whatever the number of sets, and a row per task, set and component is all
that is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix.session import ship_package

# The shares [row, component] of some rows [row, feature], and a sum over them (cost, likelihood).
Weigh = Callable[[np.ndarray], tuple[np.ndarray, float]]


@dataclass(frozen=True)
class Moments:
    """Per component the weight, the sums and the sums of squares; the sum over all rows, their number."""

    n: np.ndarray
    s: np.ndarray
    q: np.ndarray
    value: float
    rows: int


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The columns of a batch as ``[row, column]``; a missing value is an error."""
    out = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
    if np.isnan(out).any():
        raise ValueError("a feature is missing in a row to be clustered")
    return out


def reduced(points: np.ndarray, shares: np.ndarray, value: float) -> Moments:
    return Moments(shares.sum(axis=0), shares.T @ points, shares.T @ (points * points), value, len(points))


def added(a: Moments | None, b: Moments) -> Moments:
    if a is None:
        return b
    return Moments(a.n + b.n, a.s + b.s, a.q + b.q, a.value + b.value, a.rows + b.rows)


def moment_sums(df: DataFrame, features: Sequence[str], sets: Mapping[int, Weigh]) -> dict[int, Moments]:
    """The moments of every set over all rows of ``df``; a table without rows gives none."""
    ship_package(df.sparkSession)
    weighers = dict(sets)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, Moments | None] = dict.fromkeys(weighers)
        for batch in batches:
            if batch.num_rows:
                points = matrix(batch)
                for key, weigh in weighers.items():
                    total[key] = added(total[key], reduced(points, *weigh(points)))
        rows = [(key, j, m.n[j], m.s[j].tolist(), m.q[j].tolist(), m.value if j == 0 else 0.0, m.rows if j == 0 else 0)
                for key, m in total.items() if m for j in range(len(m.n))]
        kinds = (pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64(), pa.int64())
        names = ["set", "component", "n", "s", "q", "value", "rows"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    d = range(len(features))
    parts = df.select(*[F.col(x).cast("double").alias(x) for x in features]).mapInArrow(
        task, "set int, component int, n double, s array<double>, q array<double>, value double, rows long")
    sums = parts.groupBy("set", "component").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in d]).alias("s"),
        F.array(*[F.sum(F.col("q")[i]) for i in d]).alias("q"), F.sum("value").alias("value"), F.sum("rows").alias("rows"))
    found: dict[int, list] = {}
    for row in sums.collect():  # sets times components
        found.setdefault(row["set"], []).append(row)
    out = {}
    for key, rows in found.items():
        rows.sort(key=lambda r: r["component"])
        out[key] = Moments(np.array([r["n"] for r in rows]), np.array([r["s"] for r in rows]), np.array([r["q"] for r in rows]),
                           sum(r["value"] for r in rows), sum(r["rows"] for r in rows))
    return out
