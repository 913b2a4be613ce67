"""K-Means with restarts, nearest-centroid assignment and the sweep over k.

Restarts run on a weighted coreset: rows drawn with chances that grow with their distance
from the mean and weighted by the inverse, so that the cost of any centres on it estimates
their cost on all rows (Bachem, Lucic and Krause, 2018). Every restart is one task over the
coreset. All rows then decide: one pass gives the cost of every restart, and the best of each
k moves on over all rows until it rests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.operators.cluster_scores import centroid_scores, silhouettes
from cohortix.operators.moments import Moments, Weigh, moment_sums
from cohortix.operators.sample import exact_sample
from cohortix.session import frame_of, held, ship_package, sized

MAX_ITERATIONS = 300
# All centres together may still move by this squared distance, in units of the variance.
TOTAL_SHIFT = 1e-4
# Rows the restarts are fitted on, on average; a table of half as many is taken whole.
CORESET_ROWS = 40_000
FIT_ROWS_PER_TASK = 4_000
CONCURRENT_FITS = 16

In = TypeVar("In")
Out = TypeVar("Out")


def overlapped(df: DataFrame, work: Callable[[In], Out], items: Iterable[In], most: int = CONCURRENT_FITS) -> list[Out]:
    """Run independent fits side by side, ``most`` at once, so small jobs fill the cluster; keeps the order."""
    target = inheritable_thread_target(df.sparkSession)(work)
    with ThreadPoolExecutor(min(most, CONCURRENT_FITS)) as pool:
        return list(pool.map(target, items))


@dataclass(frozen=True)
class KMeansFit:
    """Centres, their cost and the rows of each over the whole table."""

    centres: tuple[tuple[float, ...], ...]
    inertia: float
    sizes: tuple[int, ...]
    iterations: int = 0

    @property
    def k(self) -> int:
        return len(self.centres)


# ---- the coreset ------------------------------------------------------------
@dataclass(frozen=True)
class Coreset:
    points: np.ndarray
    weights: np.ndarray
    variance: float  # of all rows, mean over the features


def coreset(df: DataFrame, features: Sequence[str], rows: int = CORESET_ROWS, seed: int = S.SEED,
            id_col: str = S.ID) -> Coreset:
    """About ``rows`` weighted rows; which ones depends on ids and values alone.

    Half of a row's chance is the same for all, half follows its squared distance from the
    mean. A table of at most ``rows / 2`` rows is taken whole, with weight one.
    """
    x = [F.col(c).cast("double") for c in features]
    stats = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"m{i}") for i, c in enumerate(x)],
                   *[F.var_pop(c).alias(f"v{i}") for i, c in enumerate(x)]).first()
    if not stats["n"]:
        raise ValueError("no rows to cluster")
    variance = sum(stats[f"v{i}"] or 0.0 for i in range(len(x)))
    gaps = [(c - F.lit(stats[f"m{i}"])) * (c - F.lit(stats[f"m{i}"])) for i, c in enumerate(x)]
    far = sum(gaps[1:], gaps[0]) / F.lit(variance) if variance > 0 else F.lit(1.0)
    chance = F.least(F.lit(1.0), (far + 1.0) * F.lit(0.5 * rows / stats["n"]))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"core{seed}:"), F.col(id_col).cast("string"))), 1, 8), 16, 10).cast("double")
    drawn = df.select(*[c.alias(f"x{i}") for i, c in enumerate(x)], chance.alias("chance"), (draw / float(1 << 32)).alias("draw"))
    table = drawn.where("draw < chance").drop("draw").toArrow()
    points = np.column_stack([table[f"x{i}"].to_numpy() for i in range(len(x))]).astype(float)
    if np.isnan(points).any():
        raise ValueError("a feature is missing in a row to be clustered")
    order = np.lexsort(points.T)  # the same order on any cluster
    return Coreset(points[order], 1.0 / table["chance"].to_numpy()[order], variance / len(x))


def squared_distances(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.zeros((len(points), len(centres)))
    for i in range(points.shape[1]):
        out += (points[:, i, None] - centres[None, :, i]) ** 2
    return out


def spread_centres(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Starting centres drawn one after another by weighted squared distance to those before (k-means++)."""
    rng = np.random.default_rng([seed, k])
    centres = [points[rng.choice(len(points), p=weights / weights.sum())]]
    nearest = squared_distances(points, np.array(centres))[:, 0]
    while len(centres) < k:
        mass = weights * nearest
        if mass.sum() <= 0:  # fewer different points than centres
            mass = weights
        centres.append(points[rng.choice(len(points), p=mass / mass.sum())])
        nearest = np.minimum(nearest, squared_distances(points, np.array(centres[-1:]))[:, 0])
    return np.array(centres)


def settle(core: Coreset, k: int, seed: int) -> np.ndarray:
    """Centres that the weighted points of the coreset no longer move."""
    centres = spread_centres(core.points, core.weights, k, seed)
    for _ in range(MAX_ITERATIONS):
        label = squared_distances(core.points, centres).argmin(axis=1)
        n = np.bincount(label, core.weights, k)
        s = np.column_stack([np.bincount(label, core.weights * x, k) for x in core.points.T])
        moved = np.where(n[:, None] > 0, s / np.maximum(n, 1e-300)[:, None], centres)
        shift, centres = ((moved - centres) ** 2).sum(), moved
        if shift <= TOTAL_SHIFT * core.variance:
            break
    return centres


def restart_centres(df: DataFrame, core: Coreset, jobs: Sequence[tuple[int, int]]) -> list[np.ndarray]:
    """Settled centres of every ``(k, seed)``, one task each."""
    spark = df.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(core)  # about CORESET_ROWS rows

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for job, k, seed in zip(*(c.to_pylist() for c in batch.columns)):
                found = settle(shared.value, k, seed)
                yield pa.RecordBatch.from_arrays([pa.array([job], pa.int32()), pa.array([found.ravel().tolist()], pa.list_(pa.float64()))],
                                                 ["job", "centres"])

    table = frame_of(spark, [(i, k, s) for i, (k, s) in enumerate(jobs)], "job int, k int, seed int")
    rows = table.repartitionByRange(len(jobs), "job").mapInArrow(task, "job int, centres array<double>").collect()
    shared.unpersist()
    return [np.array(r["centres"]).reshape(jobs[r["job"]][0], -1) for r in sorted(rows)]


# ---- all rows ---------------------------------------------------------------
def nearest_of(centres: np.ndarray) -> Weigh:
    """Hard shares, and the cost."""
    def weigh(points: np.ndarray) -> tuple[np.ndarray, float]:
        apart = squared_distances(points, centres)
        label = apart.argmin(axis=1)
        return np.eye(len(centres))[label], float(apart[np.arange(len(points)), label].sum())
    return weigh


def moved_centres(centres: np.ndarray, m: Moments) -> np.ndarray:
    """The means of the rows of each centre; a centre without rows stays."""
    return np.where(m.n[:, None] > 0, m.s / np.maximum(m.n, 1e-300)[:, None], centres)


def finish(df: DataFrame, features: Sequence[str], jobs: Sequence[tuple[int, int]], starts: Sequence[np.ndarray],
           variance: float) -> dict[int, KMeansFit]:
    """Per k the restart of lowest cost over all rows, moved over all rows until it rests."""
    sums = moment_sums(df, features, {i: nearest_of(c) for i, c in enumerate(starts)})
    open_fits, fits = {}, {}
    for k in dict.fromkeys(k for k, _ in jobs):
        best = min((i for i, (kk, _) in enumerate(jobs) if kk == k), key=lambda i: sums[i].value)
        open_fits[k] = starts[best], sums[best]
    for iteration in range(1, MAX_ITERATIONS + 1):
        following = {}
        for k, (centres, m) in open_fits.items():
            moved = moved_centres(centres, m)
            if ((moved - centres) ** 2).sum() <= TOTAL_SHIFT * variance or iteration == MAX_ITERATIONS:
                fits[k] = KMeansFit(tuple(map(tuple, centres.tolist())), m.value, tuple(int(v) for v in m.n), iteration)
            else:
                following[k] = moved
        if not following:
            break
        sums = moment_sums(df, features, {k: nearest_of(c) for k, c in following.items()})
        open_fits = {k: (c, sums[k]) for k, c in following.items()}
    return fits


def fit_kmeans(df: DataFrame, features: Sequence[str], k: int = S.N_CLUSTERS, n: int = S.KMEANS_RESTARTS,
               seed: int = S.SEED, core: Coreset | None = None) -> KMeansFit:
    """The best of ``n`` restarts. ``df`` has the id and the features; keep it cached."""
    core = core or coreset(df, features, seed=seed)
    jobs = [(k, s) for s in range(seed, seed + n)]
    return finish(df, features, jobs, restart_centres(df, core, jobs), core.variance)[k]


def nearest_centroid(
    df: DataFrame, features: Sequence[str], centroids: Sequence[Sequence[float]],
    out: str = "cluster_id", distance: str = "squared_distance",
) -> DataFrame:
    """Closest of a few fixed centroids as plain expressions; the lower number on a tie."""
    names = [f"_d{j}" for j in range(len(centroids))]
    squares = []
    for name, centre in zip(names, centroids):
        gaps = [(F.col(x) - F.lit(v)) * (F.col(x) - F.lit(v)) for x, v in zip(features, centre)]
        squares.append(sum(gaps[1:], gaps[0]).alias(name))
    label = F.when(F.col(names[0]) == F.col("_least"), F.lit(0))
    for j, name in enumerate(names[1:], 1):
        label = label.when(F.col(name) == F.col("_least"), F.lit(j))
    result = F.struct(label.alias(out), F.col("_least").alias(distance))
    # As in the mixture: a one-element expansion keeps filters above the distances.
    return (
        df.select("*", *squares).select("*", F.least(*names).alias("_least"))
        .select(*df.columns, F.inline(F.array(result)))
    )


def sweep_k(
    df: DataFrame, features: Sequence[str], ks: Sequence[int] = S.SWEEP_K,
    n: int = S.KMEANS_RESTARTS, seed: int = S.SEED, sample_rows: int = S.SCORE_SAMPLE,
) -> DataFrame:
    """k, inertia, Davies-Bouldin and Calinski-Harabasz on all rows, the silhouette on one fixed sample.

    ``df`` needs the id and the feature columns.
    """
    with held(sized(df.select(S.ID, *features), S.ID, FIT_ROWS_PER_TASK)) as rows:
        core = coreset(rows, features, seed=seed)
        jobs = [(k, s) for k in ks for s in range(seed, seed + n)]
        best = finish(rows, features, jobs, restart_centres(rows, core, jobs), core.variance)
        labelled = rows
        for k in ks:
            labelled = nearest_centroid(labelled, features, best[k].centres, f"k{k}", "apart").drop("apart")
        labels = [f"k{k}" for k in ks]
        with held(labelled) as scored:
            flat = centroid_scores(scored, features, labels)
            tight = silhouettes(exact_sample(scored, sample_rows, seed), features, labels, sample_rows)
    found = [
        (k, best[k].inertia, tight[f"k{k}"], flat[f"k{k}"]["davies_bouldin"], flat[f"k{k}"]["calinski_harabasz"])
        for k in ks
    ]
    return frame_of(
        df.sparkSession, found,
        "k int, inertia double, silhouette double, davies_bouldin double, calinski_harabasz double")
