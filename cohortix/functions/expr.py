"""Column expressions. Everything here stays inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import WindowSpec
from pyspark.sql import functions as F


def clip(c: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound ``c`` and keep missing values missing (``least``/``greatest`` would not)."""
    out = F.when(c < F.lit(low), F.lit(low)) if low is not None else None
    if high is not None:
        over = c > F.lit(high)
        out = F.when(over, F.lit(high)) if out is None else out.when(over, F.lit(high))
    return c if out is None else out.otherwise(c)


def nan_to_null(c: Column) -> Column:
    """NaN sorts above every number in Spark, so a NaN would pass a ``>=`` filter."""
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def zero_div(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def order_key(id_col: str, seed: int) -> Column:
    """A seeded pseudo-random order that does not depend on partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def constant_map(c: Column, values: Mapping) -> Column:
    """Look ``c`` up in a fixed dimension; missing keys give null."""
    entries: list[Column] = []
    for key, value in values.items():
        entries += [F.lit(key), F.lit(value)]
    return F.element_at(F.create_map(*entries), c)


def one_of(c: Column, known: Column, what: str) -> Column:
    """``known`` where it is set; the job fails on a value the dimension lacks."""
    message = F.concat(F.lit(f"no {what} for "), F.coalesce(c.cast("string"), F.lit("null")))
    return F.coalesce(known, F.raise_error(message).cast("string"))


def right_closed_band(c: Column, bands: Sequence[tuple[float, str]], floor: float) -> Column:
    """Label of the first band whose upper bound is not below ``c``; null outside all bands."""
    out = F.when(c <= F.lit(floor), F.lit(None).cast("string"))
    for upper, label in bands:
        out = out.when(c <= F.lit(upper), F.lit(label))
    return out


def whole_table(*order: Column | str) -> WindowSpec:
    """Frame over all rows. Only for aggregated tables of a few hundred rows at most."""
    spec = W.partitionBy(F.lit(0))
    return (spec.orderBy(*order) if order else spec).rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing)


def turn_in_table(*order: Column | str) -> WindowSpec:
    """Running order over all rows of such a small table."""
    return W.partitionBy(F.lit(0)).orderBy(*order)
