"""Diagonal Gaussian mixture: soft assignment, likelihood criteria and the EM fit.

``pyspark.ml.GaussianMixture`` is full-covariance only and has no regularisation or
restarts. Here every E-step is one scan for all restarts (``operators.moments``). Each restart
settles on the weighted coreset of K-Means first, a task each; all rows then take over until
the likelihood of all rows settles.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.operators.kmeans import Coreset, nearest_of
from cohortix.operators.moments import Moments, Weigh, moment_sums, reduced
from cohortix.session import frame_of, ship_package

TOLERANCE = 1e-3
MAX_ITERATIONS = 100
_TINY = 10 * 2.220446049250313e-16


@dataclass(frozen=True)
class Mixture:
    """Parameters of k components over the columns ``features``."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    means: tuple[tuple[float, ...], ...]
    variances: tuple[tuple[float, ...], ...]

    @property
    def k(self) -> int:
        return len(self.weights)

    @property
    def free_parameters(self) -> int:
        return 2 * self.k * len(self.features) + self.k - 1

    def constants(self) -> list[float]:
        """``ln w - 1/2 sum ln(2 pi v)`` per component."""
        return [
            math.log(w) - 0.5 * sum(math.log(2 * math.pi * v) for v in vs)
            for w, vs in zip(self.weights, self.variances)
        ]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Mixture:
        raw = json.loads(text)
        return cls(tuple(raw["features"]), tuple(raw["weights"]),
                   tuple(map(tuple, raw["means"])), tuple(map(tuple, raw["variances"])))


# ---- assignment -------------------------------------------------------------
def _first_at(values: Sequence[Column], target: Column) -> Column:
    out = F.when(values[0] == target, F.lit(0))
    for j, v in enumerate(values[1:], 1):
        out = out.when(v == target, F.lit(j))
    return out


def _highest(values: Sequence[Column]) -> Column:
    return F.greatest(*values) if len(values) > 1 else values[0]


def _log_sum(values: Sequence[Column], top: Column) -> Column:
    return top + F.ln(sum((F.exp(v - top) for v in values[1:]), F.exp(values[0] - top)))


def soft_assign(df: DataFrame, mixture: Mixture) -> DataFrame:
    """Add cluster_id, confidence, runner_up_id, runner_up_confidence, probabilities, log_density.

    Narrow and generated code only. Ties go to the lower component number.
    """
    own = df.columns
    joint = [f"_l{j}" for j in range(mixture.k)]
    cols = [F.col(c) for c in joint]
    densities = []
    for j, c in enumerate(mixture.constants()):
        gaps = [(F.col(x) - F.lit(m)) * (F.col(x) - F.lit(m)) / F.lit(v)
                for x, m, v in zip(mixture.features, mixture.means[j], mixture.variances[j])]
        densities.append((F.lit(c) - 0.5 * sum(gaps[1:], gaps[0])).alias(joint[j]))
    ranked = (
        df.select(*own, *densities)
        .select("*", _highest(cols).alias("_top"))
        .select("*", _first_at(cols, F.col("_top")).alias("cluster_id"),
                _log_sum(cols, F.col("_top")).alias("log_density"))
    )
    others = [F.when(F.col("cluster_id") == j, F.lit(None)).otherwise(c) for j, c in enumerate(cols)]
    result = F.struct(
        "cluster_id",
        F.exp(F.col("_top") - F.col("log_density")).alias("confidence"),
        _first_at(others, F.col("_second")).alias("runner_up_id"),
        F.exp(F.col("_second") - F.col("log_density")).alias("runner_up_confidence"),
        F.array(*[F.exp(c - F.col("log_density")) for c in cols]).alias("probabilities"),
        "log_density",
    )
    # Expanding a one-element array keeps later filters on these columns above it;
    # pushed through the steps they would repeat every density many times over.
    return ranked.select("*", _highest(others).alias("_second")).select(*own, F.inline(F.array(result)))


def information_criteria(assigned: DataFrame, mixture: Mixture) -> DataFrame:
    """log_likelihood, bic and aic of assigned rows."""
    p = float(mixture.free_parameters)
    ll = F.sum("log_density")
    return assigned.agg(
        ll.alias("log_likelihood"),
        (-2 * ll + p * F.ln(F.count(F.lit(1)))).alias("bic"),
        (-2 * ll + 2 * p).alias("aic"),
    )


# ---- fit --------------------------------------------------------------------
def maximise(m: Moments, features: Sequence[str], reg: float) -> Mixture:
    """The mixture that the sums of one E-step imply."""
    totals = m.n + _TINY
    means = m.s / totals[:, None]
    variances = np.maximum(m.q / totals[:, None] - means ** 2, 0.0) + reg
    weights = totals / totals.sum()
    return Mixture(tuple(features), tuple(weights.tolist()), tuple(map(tuple, means.tolist())),
                   tuple(map(tuple, variances.tolist())))


def soft_shares(mixture: Mixture, weights: np.ndarray | float = 1.0) -> Weigh:
    """Shares of the components in each row, times its weight, and the weighted log likelihood."""
    weight = np.asarray(weights).reshape(-1, 1)
    base, means = np.array(mixture.constants()), np.array(mixture.means)
    precision = 1.0 / np.array(mixture.variances)

    def weigh(points: np.ndarray) -> tuple[np.ndarray, float]:
        gaps = np.zeros((len(points), len(base)))
        for i in range(points.shape[1]):
            gaps += (points[:, i, None] - means[None, :, i]) ** 2 * precision[None, :, i]
        joint = base - 0.5 * gaps
        top = joint.max(axis=1, keepdims=True)
        share = np.exp(joint - top)
        whole = share.sum(axis=1, keepdims=True)
        return share * (weight / whole), float((weight * (top + np.log(whole))).sum())

    return weigh


def hard_starts(df: DataFrame, features: Sequence[str], centres: Sequence[np.ndarray], reg: float) -> list[Mixture]:
    """First M-step from the nearest of each set of centres; one scan for all sets."""
    sums = moment_sums(df, features, {i: nearest_of(np.asarray(c)) for i, c in enumerate(centres)})
    return [maximise(sums[i], features, reg) for i in range(len(centres))]


@dataclass(frozen=True)
class MixtureFit:
    mixture: Mixture
    mean_log_density: float
    iterations: int
    converged: bool


def em_step(df: DataFrame, mixture: Mixture, reg: float = S.MIXTURE_REG) -> tuple[Mixture, float]:
    """One E-step and M-step; also the mean log density under the given parameters."""
    sums = moment_sums(df, mixture.features, {0: soft_shares(mixture)})[0]
    return maximise(sums, mixture.features, reg), sums.value / sums.rows


def settle(core: Coreset, mixture: Mixture, reg: float, tolerance: float, max_iterations: int) -> Mixture:
    """EM over the weighted points of the coreset until their mean log density settles."""
    last, total = -math.inf, core.weights.sum()
    for _ in range(max_iterations):
        share, value = soft_shares(mixture, core.weights)(core.points)
        mixture = maximise(reduced(core.points, share, value), mixture.features, reg)
        if abs(value / total - last) < tolerance:
            break
        last = value / total
    return mixture


def settled_starts(df: DataFrame, core: Coreset, starts: Sequence[Mixture], reg: float, tolerance: float,
                   max_iterations: int) -> list[Mixture]:
    """Every start settled on the coreset, one task each."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(core)  # about CORESET_ROWS rows

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = settle(shared.value, Mixture.from_json(text), reg, tolerance, max_iterations)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([found.to_json()])], ["start", "mixture"])

    table = frame_of(spark, [(i, m.to_json()) for i, m in enumerate(starts)], "start int, mixture string")
    rows = table.repartitionByRange(len(starts), "start").mapInArrow(task, "start int, mixture string").collect()
    shared.unpersist()
    return [Mixture.from_json(r["mixture"]) for r in sorted(rows)]


def fit_mixture(
    df: DataFrame,
    starts: Sequence[Mixture],
    reg: float = S.MIXTURE_REG,
    tolerance: float = TOLERANCE,
    max_iterations: int = MAX_ITERATIONS,
    core: Coreset | None = None,
) -> MixtureFit:
    """EM from every start over ``df`` (keep it cached); the best final likelihood wins.

    With ``core`` the starts settle on it first. All rows decide when a restart has settled
    and which one wins.
    """
    features = starts[0].features
    if core is not None:
        starts = settled_starts(df, core, starts, reg, tolerance, max_iterations)
    open_runs = dict(enumerate(starts))
    last = {r: -math.inf for r in open_runs}
    done: dict[int, MixtureFit] = {}
    for iteration in range(1, max_iterations + 1):
        sums = moment_sums(df, features, {r: soft_shares(m) for r, m in open_runs.items()})
        for r in list(open_runs):
            mean_ll = sums[r].value / sums[r].rows
            mixture = maximise(sums[r], features, reg)
            settled = abs(mean_ll - last[r]) < tolerance
            if settled or iteration == max_iterations:
                done[r] = MixtureFit(mixture, mean_ll, iteration, settled)
                del open_runs[r]
            else:
                open_runs[r], last[r] = mixture, mean_ll
        if not open_runs:
            break
    return max(done.values(), key=lambda fit: fit.mean_log_density)
