"""Silhouette, Davies-Bouldin and Calinski-Harabasz of labelled rows.

Davies-Bouldin, Calinski-Harabasz and the silhouette of squared distances are aggregates over
all rows: the mean squared distance to a cluster follows from its size, mean and mean square.
The clusters are a table like any other, of any size; pairs of them are compared in blocks.
The Euclidean silhouette needs all pair distances and is therefore defined on a sample of
stated size: the sample is broadcast, and tasks reduce their own rows' distances to
per-cluster sums with array arithmetic, so no pair is ever a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.operators.sample import exact_sample
from cohortix.session import BROADCAST_ROWS, frame_of, ship_package, written

BLOCK = 512
CLUSTER_BLOCK = 2_048  # clusters compared with as many others at once
SALTS = 16


def _long(df: DataFrame, features: Sequence[str], labels: Sequence[str]) -> DataFrame:
    """One row per labelling and input row: model, label, features."""
    models = F.array(*[
        F.struct(F.lit(c).alias("model"), F.col(c).cast("int").alias("label")) for c in labels])
    return df.select(*features, F.inline(models))


def _squared_norm(gaps: Sequence[Column]) -> Column:
    return sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])


def _centred(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features less their means: sums of squares then keep their digits."""
    means = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(features)]).first()
    return df.withColumns({x: F.col(x) - F.lit(means[f"m{i}"]) for i, x in enumerate(features)})


def _clusters(rows: DataFrame, features: Sequence[str]) -> DataFrame:
    """``model, label, n, q, mean``: size, mean square norm and mean of every cluster, a written table."""
    squares = _squared_norm([F.col(x) for x in features])
    sums = rows.where("label is not null").groupBy("model", "label").agg(
        F.count(F.lit(1)).alias("n"), F.avg(squares).alias("q"), F.array(*[F.avg(x) for x in features]).alias("mean"))
    return written(sums, "clusters")


def _with_own(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """Add its cluster's columns to every row. A label may hold most rows: beyond a broadcast it is salted."""
    if clusters.count() <= BROADCAST_ROWS:
        return rows.join(F.broadcast(clusters), ["model", "label"])
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in ("model", "label")]), F.lit(SALTS)).cast("int")
    many = clusters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", salt).join(many, ["model", "label", "salt"]).drop("salt")


def _gap_to(mean: Column, features: Sequence[str]) -> Column:
    """Squared distance of a row to a centre."""
    return _squared_norm([F.col(x) - mean[i] for i, x in enumerate(features)])


def squared_silhouettes(df: DataFrame, features: Sequence[str], labels: Sequence[str]) -> dict[str, float]:
    """Mean silhouette of squared Euclidean distances per label column, over all rows.

    One aggregate for the clusters, then one narrow pass, in which the clusters come in blocks of
    bounded size. A one-row cluster scores 0. A single cluster has no score.
    """
    rows = _long(_centred(df, features), features, labels)
    clusters = _clusters(rows, features)
    spread = F.col("q") - _squared_norm([F.col("mean")[i] for i in range(len(features))])
    table = clusters.select("model", "label", "n", "mean", spread.alias("spread"))
    blocks = max(1, -(-table.count() // BROADCAST_ROWS))
    near = _with_own(rows, table).withColumns({
        "outer": F.lit(None).cast("double"),
        "inner": (_gap_to(F.col("mean"), features) + F.col("spread")) * F.col("n") / F.greatest(F.col("n") - 1, F.lit(1))}).drop("mean", "spread")
    for block in range(blocks):
        some = table.where(F.pmod(F.xxhash64("model", "label"), F.lit(blocks)) == block).groupBy("model").agg(
            F.collect_list(F.struct("label", "mean", "spread")).alias("others"))
        apart = F.transform("others", lambda c: F.when(
            c["label"] != F.col("label"), _gap_to(c["mean"], features) + c["spread"]))
        near = near.join(F.broadcast(some), "model", "left").withColumn("outer", F.least("outer", F.array_min(apart))).drop("others")
    wider = F.greatest("inner", "outer")
    value = F.when(F.col("n") == 1, 0.0).when(wider > 0, (F.col("outer") - F.col("inner")) / wider).otherwise(0.0)
    found = near.select("model", F.when(F.col("outer").isNotNull(), value).alias("v")).groupBy("model").agg(F.avg("v").alias("v"))
    return {r["model"]: r["v"] for r in found.collect()}


def centroid_scores(df: DataFrame, features: Sequence[str], labels: Sequence[str]) -> dict[str, dict]:
    """n_clusters, davies_bouldin and calinski_harabasz per label column, over all rows and any number of clusters."""
    rows = _long(_centred(df, features), features, labels)
    clusters = _clusters(rows, features)
    gap = F.sqrt(_gap_to(F.col("mean"), features))
    spread = written(_with_own(rows, clusters.select("model", "label", "mean")).groupBy("model", "label").agg(
        F.avg(gap).alias("spread")).join(clusters, ["model", "label"]), "spreads")
    n, mean = F.col("n"), [F.col("mean")[i] for i in range(len(features))]
    sums = clusters.groupBy("model").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("rows"), F.sum(n * F.col("q")).alias("squares"),
        F.sum(n * _squared_norm(mean)).alias("centres"), F.array(*[F.sum(n * m) for m in mean]).alias("total")).collect()
    worst = {r["model"]: r["worst"] for r in _worst_ratios(spread).groupBy("model").agg(F.avg("worst").alias("worst")).collect()}
    out = {}
    for r in sums:
        k, size = r["k"], r["rows"]
        score = None
        if 2 <= k < size:
            within = r["squares"] - r["centres"]
            between = r["centres"] - sum(t * t for t in r["total"]) / size
            score = 1.0 if within <= 0 else between * (size - k) / (within * (k - 1))
        out[r["model"]] = {"n_clusters": k, "davies_bouldin": worst.get(r["model"], 0.0) if k > 1 else 0.0, "calinski_harabasz": score}
    return out


def _worst_ratios(spread: DataFrame) -> DataFrame:
    """``model, label, worst``: per cluster the greatest sum of spreads to distance of the centres, over all others.

    Every block of clusters meets every block in a group of its own; a pair is never a row.
    """
    ship_package(spread.sparkSession)
    blocks = max(1, -(-spread.count() // CLUSTER_BLOCK))
    block = F.pmod(F.xxhash64("model", "label"), F.lit(blocks)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    kept = ["model", "label", "mean", "spread"]
    cells = spread.select(*kept, block.alias("a"), every.alias("b"), F.lit(0).alias("role")).union(
        spread.select(*kept, every.alias("a"), block.alias("b"), F.lit(1).alias("role")))

    def compare(cell: pa.Table) -> pa.Table:
        out: dict[str, list] = {"model": [], "label": [], "worst": []}
        frame = cell.to_pandas()
        for model, of in frame.groupby("model"):
            own, other = of[of["role"] == 0], of[of["role"] == 1]
            if own.empty or other.empty:
                continue
            centres, spreads = np.stack(other["mean"].to_numpy()), other["spread"].to_numpy()
            for at in range(0, len(own), BLOCK):
                some = own.iloc[at:at + BLOCK]
                mine = np.stack(some["mean"].to_numpy())
                squared = np.zeros((len(some), len(other)))
                for i in range(mine.shape[1]):
                    squared += (mine[:, i, None] - centres[None, :, i]) ** 2
                ratio = np.divide(some["spread"].to_numpy()[:, None] + spreads, np.sqrt(squared),
                                  out=np.zeros_like(squared), where=squared > 0)
                ratio[some["label"].to_numpy()[:, None] == other["label"].to_numpy()[None, :]] = 0.0
                out["model"] += [model] * len(some)
                out["label"] += some["label"].tolist()
                out["worst"] += ratio.max(axis=1).tolist()
        return pa.table(out, schema=pa.schema([("model", pa.string()), ("label", pa.int32()), ("worst", pa.float64())]))

    found = cells.groupBy("a", "b").applyInArrow(compare, "model string, label int, worst double")
    return found.groupBy("model", "label").agg(F.max("worst").alias("worst"))


def silhouettes(df: DataFrame, features: Sequence[str], labels: Sequence[str],
                limit: int = S.SCORE_SAMPLE) -> dict[str, float]:
    """Mean Euclidean silhouette per label column; a one-row cluster scores 0."""
    ship_package(df.sparkSession)
    features, labels = list(features), list(labels)
    flat = df.select(*[F.col(x).cast("double").alias(x) for x in features],
                     *[F.col(c).cast("int").alias(c) for c in labels])
    table = flat.limit(limit + 1).toArrow()
    if table.num_rows > limit:
        raise ValueError(f"the silhouette needs a sample of at most {limit} rows")
    points = np.column_stack([table[x].to_numpy() for x in features])
    members, sizes = {}, {}
    for c in labels:
        codes, inverse = np.unique(table[c].to_numpy(), return_inverse=True)
        members[c] = np.eye(len(codes))[inverse]
        sizes[c] = (codes, members[c].sum(axis=0))
    shared = df.sparkSession.sparkContext.broadcast((points, members, sizes))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, members, sizes = shared.value
        sums = {c: [0.0, 0] for c in labels}
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                block = batch.iloc[at:at + BLOCK]
                squared = np.zeros((len(block), len(points)))
                for i, x in enumerate(features):
                    squared += (block[x].to_numpy()[:, None] - points[None, :, i]) ** 2
                distance = np.sqrt(squared)
                for c in labels:
                    values = _silhouette(distance @ members[c], block[c].to_numpy(), *sizes[c])
                    sums[c][0] += float(values.sum())
                    sums[c][1] += len(values)
        yield pd.DataFrame([(c, *sums[c]) for c in labels], columns=["model", "total", "n"])

    spread = flat.repartition(df.sparkSession.sparkContext.defaultParallelism)
    rows = (
        spread.mapInPandas(score, "model string, total double, n long")
        .groupBy("model").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    )
    shared.unpersist()
    return {r["model"]: r["total"] / r["n"] for r in rows if r["n"]}


def _silhouette(sums: np.ndarray, label: np.ndarray, codes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Silhouette values from the distance sums of some rows to every cluster."""
    own = np.searchsorted(codes, label)
    rows = np.arange(len(label))
    alone = n[own] == 1
    inner = sums[rows, own] / np.maximum(n[own] - 1, 1)
    mean = sums / n[None, :]
    mean[rows, own] = np.inf
    outer = mean.min(axis=1)
    wider = np.maximum(inner, outer)
    value = np.divide(outer - inner, wider, out=np.zeros_like(inner), where=np.isfinite(wider) & (wider > 0))
    return np.where(alone, 0.0, value)


def cluster_scores(df: DataFrame, features: Sequence[str], labels: Sequence[str],
                   sample_rows: int = S.SCORE_SAMPLE, seed: int = S.SEED) -> DataFrame:
    """All scores per label column: ``silhouette`` on a sample of ``sample_rows``, the others on all rows."""
    flat = centroid_scores(df, features, labels)
    wide = squared_silhouettes(df, features, labels)
    tight = silhouettes(exact_sample(df, sample_rows, seed), features, labels, sample_rows)
    rows = [
        (c, flat[c]["n_clusters"], tight[c], wide[c], flat[c]["davies_bouldin"], flat[c]["calinski_harabasz"])
        for c in labels
    ]
    return frame_of(
        df.sparkSession, rows,
        "model string, n_clusters int, silhouette double, squared_silhouette double, davies_bouldin double, "
        "calinski_harabasz double")
