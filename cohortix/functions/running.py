"""Running totals over a global order without a one-task window."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortix.functions.expr import turn_in_table, whole_table

SLICE_ROWS = 4_000


def slice_bounds(df: DataFrame, col: str, slices: int | None = None) -> list[float]:
    """At most ``slices - 1`` cut points that spread the rows of ``df`` evenly.

    Without a number, about ``SLICE_ROWS`` times the root of the table in thousands go in a
    slice, so that both the slices and the rows in one grow slowly.
    """
    if slices is None:
        rows = df.count()
        slices = max(2, math.ceil(rows / (SLICE_ROWS * max(1.0, math.sqrt(rows / 1e6)))))
    shares = [i / slices for i in range(1, slices)]
    cuts = df.agg(F.percentile_approx(col, shares, 20 * slices)).first()[0]
    return sorted(set(cuts or []))


def sliced(df: DataFrame, col: str, bounds: Sequence[float], out: str = "slice") -> DataFrame:
    """Add the range slice of ``col`` as a long; the slices are ordered like the values."""
    if not bounds:
        return df.withColumn(out, F.lit(0).cast("long"))
    cuts = [float("-inf"), *bounds, float("inf")]
    marked = Bucketizer(splits=cuts, inputCol=col, outputCol=out).transform(df)
    return marked.withColumn(out, F.col(out).cast("long"))


def running_totals(
    df: DataFrame,
    order_col: str,
    values: Sequence[str],
    bounds: Sequence[float],
    *,
    heads: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive, from the highest ``order_col`` down) and ``all_<v>``.

    ``df`` holds one row per distinct ``order_col``. Rows are cut into range slices; the
    totals of the slices (at most ``len(bounds) + 1`` rows) are summed up first, and each
    slice then runs its own window on top of what lies above it. ``heads`` names columns
    whose value in the next lower row is added as ``next_<c>``.
    """
    parts = sliced(df, order_col, bounds)
    top = [F.max_by(c, order_col).alias(f"top_{c}") for c in heads]
    down_slices = turn_in_table(F.col("slice").desc())
    above = down_slices.rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("slice")
        .agg(*[F.sum(v).alias(f"t_{v}") for v in values], *top)
        .select(
            "slice",
            *[F.coalesce(F.sum(f"t_{v}").over(above), F.lit(0)).alias(f"o_{v}") for v in values],
            *[F.sum(f"t_{v}").over(whole_table()).alias(f"all_{v}") for v in values],
            *[F.lead(f"top_{c}").over(down_slices).alias(f"below_{c}")
              for c in heads],
        )
    )
    down = W.partitionBy("slice").orderBy(F.col(order_col).desc())
    upto = down.rowsBetween(W.unboundedPreceding, W.currentRow)

    def total(v: str) -> Column:
        return (F.col(f"o_{v}") + F.sum(v).over(upto)).alias(f"cum_{v}")

    return parts.join(F.broadcast(offsets), "slice").select(
        *df.columns,
        *[total(v) for v in values],
        *[f"all_{v}" for v in values],
        *[F.coalesce(F.lead(c).over(down), F.col(f"below_{c}")).alias(f"next_{c}")
          for c in heads],
    )
