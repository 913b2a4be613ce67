"""Exact linear-interpolation quantiles from mergeable sketches with bounded state.

``percentile`` keeps every distinct value of a column in one task. Here one pass gathers a
KLL sketch of each column; up to ``k`` values the sketch holds them all and its answers are
exact. Beyond that the sketch brackets every wanted rank, and the next pass counts what lies
below the bracket and sketches what lies inside, for all ranks of all columns at once. Inside
a bracket there are few rows, so the second sketch usually holds them all; otherwise it gives
the next bracket. Correct for any brackets; the sketches only make the search short.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cohortix.functions.expr import nan_to_null
from cohortix.session import frame_of

# Values a sketch holds exactly; beyond them its ranks are off by about a ten thousandth.
SKETCH = 32_768
ACCURACY = 10_000

Ranks = Mapping[str, Sequence[int]]


@dataclass
class _Search:
    """Where the value of one 0-based rank can still be: strictly between the bounds."""

    col: str
    rank: int
    low: float | None = None
    high: float | None = None
    below: int = 0  # values not above ``low``
    value: float | None = None

    @property
    def region(self) -> tuple:
        return self.col, self.low, self.high

    def within(self) -> Column:
        c = F.col(self.col)
        ok = c.isNotNull()
        if self.low is not None:
            ok = ok & (c > F.lit(self.low))
        if self.high is not None:
            ok = ok & (c < F.lit(self.high))
        return ok


def bracket(rank: int, inside: int, k: int) -> tuple[int, int]:
    """Ranks below and above that a sketch's answers for ``rank`` lie between, all but surely."""
    off = math.ceil(2 * inside / k ** 0.9)
    return max(0, rank - off), min(inside - 1, rank + off)


def sketch_values(spark: SparkSession, wanted: Sequence[tuple[bytes, int, Sequence[int]]]) -> list[list[float]]:
    """Values at 0-based ranks of sketches of so many values; planned as a local projection, without a job."""
    own = {bytes(sketch): f"s{i}" for i, (sketch, _, _) in enumerate(wanted)}
    table = frame_of(spark, [tuple(own)], ", ".join(f"{name} binary" for name in own.values()))
    asked = [F.kll_sketch_get_quantile_double(own[bytes(sketch)], F.array(*[F.lit((r + 0.5) / n) for r in ranks])).alias(f"v{i}")
             for i, (sketch, n, ranks) in enumerate(wanted)]
    return [list(v) for v in table.select(*asked).first()]


def order_statistics(
    df: DataFrame, cols: Sequence[str], ranks: Callable[[Row], Ranks], *, also: Sequence[Column] = (), k: int = SKETCH,
) -> tuple[dict[tuple[str, int], float], Row]:
    """Values at 0-based ranks of columns, and the row of sizes and of the aggregates ``also``.

    Nulls and NaN are no values. ``ranks`` gets that row (``n_<column>`` are the numbers of values) and returns
    the wanted ranks by column. Everything is gathered in the same passes, of which there is
    one up to ``k`` values, and most often one more beyond.
    """
    spark = df.sparkSession
    sketches = [F.kll_sketch_agg_double(nan_to_null(F.col(c).cast("double")), F.lit(k)).alias(f"s_{c}") for c in cols]
    first = df.agg(*sketches, *[F.count(nan_to_null(F.col(c).cast("double"))).alias(f"n_{c}") for c in cols], *also).first()
    searches = [_Search(c, r) for c, wanted in ranks(first).items() for r in sorted(set(wanted)) if 0 <= r < first[f"n_{c}"]]
    values = df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols])
    open_, pivots = searches, _resolved(spark, [(s, first[f"s_{s.col}"], first[f"n_{s.col}"]) for s in searches], k)
    while open_ := [s for s in open_ if s.value is None]:
        pivots = _pass(values, [(s, *pivots[s.col, s.rank]) for s in open_], k)
    return {(s.col, s.rank): s.value for s in searches}, first


def _resolved(spark: SparkSession, found: Sequence[tuple[_Search, bytes, int]], k: int) -> dict[tuple, tuple]:
    """Set values that a sketch of the search's region holds exactly; pivots for the other searches."""
    wanted = []
    for s, sketch, inside in found:
        rank = s.rank - s.below
        wanted.append((sketch, inside, [rank] if inside <= k else list(bracket(rank, inside, k))))
    pivots = {}
    for (s, _, _), values in zip(found, sketch_values(spark, wanted) if wanted else []):
        if len(values) == 1:
            s.value = values[0]
        else:
            pivots[s.col, s.rank] = tuple(values)
    return pivots


def _pass(df: DataFrame, probes: Sequence[tuple[_Search, float, float]], k: int) -> dict[tuple, tuple]:
    """Move every search to the side of its pivots that holds the rank, and sketch between them."""
    spark = df.sparkSession
    counts, sketches = [], {}
    for i, (s, a, b) in enumerate(probes):
        c = F.col(s.col)
        counts += [F.count_if(test).alias(f"{name}{i}") for name, test in (
            ("lt_a", c < F.lit(a)), ("le_a", c <= F.lit(a)), ("lt_b", c < F.lit(b)), ("le_b", c <= F.lit(b)))]
        between = _Search(s.col, s.rank, a, b)
        sketches.setdefault(between.region, F.kll_sketch_agg_double(F.when(between.within(), c), F.lit(k)).alias(f"s{len(sketches)}"))
    place = {region: f"s{i}" for i, region in enumerate(sketches)}
    row = df.agg(*counts, *sketches.values()).first()
    inside, missed = [], {}
    for i, (s, a, b) in enumerate(probes):
        lt_a, le_a, lt_b, le_b = (row[f"{name}{i}"] for name in ("lt_a", "le_a", "lt_b", "le_b"))
        if lt_a <= s.rank < le_a:
            s.value = a
        elif lt_b <= s.rank < le_b:
            s.value = b
        elif le_a <= s.rank < lt_b:
            s.low, s.high, s.below = a, b, le_a
            inside.append((s, row[place[s.col, a, b]], lt_b - le_a))
        elif s.rank < lt_a:
            s.high, missed[s.col, s.rank] = a, s
        else:
            s.low, s.below, missed[s.col, s.rank] = b, le_b, s
    pivots = _resolved(spark, inside, k)
    if missed:  # outside of the bracket: sketch the whole region that is left
        left = list(missed.values())
        regions = {s.region: s for s in left}
        again = df.agg(*[F.kll_sketch_agg_double(F.when(s.within(), F.col(s.col)), F.lit(k)).alias(f"s{i}") for i, s in enumerate(regions.values())],
                       *[F.count_if(s.within()).alias(f"n{i}") for i, s in enumerate(regions.values())]).first()
        at = {region: i for i, region in enumerate(regions)}
        pivots |= _resolved(spark, [(s, again[f"s{at[s.region]}"], again[f"n{at[s.region]}"]) for s in left], k)
    return pivots


def quantile_ranks(n: int, probs: Sequence[float]) -> list[int]:
    """The ranks between which the quantiles of ``n`` values lie."""
    return [r for q in probs for r in (math.floor((n - 1) * q), math.ceil((n - 1) * q))] if n else []


def interpolated(at: Callable[[int], float], n: int, q: float) -> float | None:
    """Linear interpolation between neighbouring order statistics; None of no values."""
    if not n:
        return None
    h = (n - 1) * q
    low, high = at(math.floor(h)), at(math.ceil(h))
    return low if low == high else low + (high - low) * (h - math.floor(h))


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], *, k: int = SKETCH) -> dict[str, list[float | None]]:
    """``{column: [value per probability]}``, ignoring nulls and NaN; None for an empty column."""
    found, sizes = order_statistics(
        df, list(wanted), lambda row: {c: quantile_ranks(row[f"n_{c}"], probs) for c, probs in wanted.items()}, k=k)
    return {c: [interpolated(lambda r: found[c, r], sizes[f"n_{c}"], q) for q in probs] for c, probs in wanted.items()}


def approx_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], *, accuracy: int = ACCURACY) -> dict[str, list[float | None]]:
    """One-pass alternative within a rank error of ``1/accuracy``; no interpolation."""
    row = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(c)
          for c, probs in wanted.items()]
    ).first()
    return {c: list(row[c]) if row[c] is not None else [None] * len(probs)
            for c, probs in wanted.items()}


QUANTILES = {"exact": exact_quantiles, "approx": approx_quantiles}
