"""Fixed parameters standing in for learned state, so apply-side queries have exact oracles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.functions.expr import constant_map, logistic
from cohortix.operators import clean
from cohortix.operators.clean import CleaningParams, Fence
from cohortix.operators.mixture import Mixture

# ---- fixed values -----------------------------------------------------------
MEANS = {S.USAGE: 27.0, S.REVENUE: 4550.0, S.DOU: 10.3, S.PACK: 0.68}
STDS = {S.USAGE: 16.5, S.REVENUE: 3150.0, S.DOU: 6.0, S.PACK: 0.47}
CENTROIDS = (
    (-0.9, -0.6, -1.0, -1.4), (-0.2, 0.9, -0.3, -1.4), (0.8, 0.0, 0.7, -1.4),
    (-0.7, 0.7, -0.6, 0.7), (0.4, -0.8, 0.4, 0.7), (1.6, 0.6, 1.7, 0.7),
)
WEIGHTS = (0.12, 0.13, 0.08, 0.27, 0.25, 0.15)
VARIANCES = (
    (0.30, 0.70, 0.25, 0.05), (0.45, 0.60, 0.40, 0.05), (0.60, 1.00, 0.55, 0.05),
    (0.35, 0.55, 0.30, 0.05), (0.50, 0.45, 0.40, 0.05), (0.80, 0.90, 0.70, 0.05),
)
USAGE_BANDS = (16.0, 31.0)
SEGMENT_OF_CLUSTER = {
    0: "Comfortably Numb", 1: "Sleeping Giant", 2: "Loyal Core",
    3: "Question Mark", 4: "Deal Seeker", 5: "Premium Power",
}
MEDIANS = {S.USAGE: 24.0, S.REVENUE: 4300.0}
FENCES = {S.USAGE: Fence(-55.0, 105.0), S.REVENUE: Fence(-15000.0, 9000.0)}
RATIO_CAPS = {"revenue_per_gb": 4800.0, "usage_intensity": 50.0, "revenue_per_active_day": 4000.0}
THRESHOLD = 0.30
CUTS = (0.25, 0.35)
# Linear scores: intercept, then one weight per column.
CHURN_SCORE = (0.8, {S.USAGE: 0.01, S.REVENUE: -0.0001, S.DOU: -0.05, S.PACK: -0.4, S.TENURE: -0.002})
SCORES = {
    "score_a": CHURN_SCORE,
    "score_b": (-1.0, {S.USAGE: 0.03, S.DOU: -0.1}),
    "score_c": (0.5, {S.TENURE: -0.004}),
}
SEGMENT_SHIFT = {"Deal Seeker": 0.2, "Loyal Core": -0.3}
# ---- end of fixed values ----------------------------------------------------

SCALED = tuple(clean.scaled_name(c) for c in S.CLUSTER_FEATURES)
MIXTURE = Mixture(SCALED, WEIGHTS, CENTROIDS, VARIANCES)
PARAMS = CleaningParams(MEDIANS, FENCES, RATIO_CAPS, MEANS, STDS)


def linear(score: tuple[float, dict[str, float]]) -> Column:
    z = F.lit(score[0])
    for c, w in score[1].items():
        z = z + F.lit(w) * F.col(c)
    return z


def probability_of(score: tuple[float, dict[str, float]]) -> Column:
    return F.round(logistic(linear(score)), 6)


def band_cluster() -> Column:
    """Cluster 0..5 from the pack flag and three usage bands."""
    low, high = USAGE_BANDS
    band = F.when(F.col(S.USAGE) <= low, 0).when(F.col(S.USAGE) <= high, 1).otherwise(2)
    return (F.col(S.PACK) * 3 + band).cast("int")


def with_standins(table: DataFrame) -> DataFrame:
    """Add the stand-in cluster, its segment and the stand-in churn probability."""
    return table.withColumns({
        "cluster": band_cluster(),
        "churn_probability": probability_of(CHURN_SCORE),
    }).withColumn(S.SEGMENT, constant_map(F.col("cluster"), SEGMENT_OF_CLUSTER))


def scaled(table: DataFrame) -> DataFrame:
    return clean.standardise(table, MEANS, STDS)


def shifted_probability(df: DataFrame) -> DataFrame:
    """Stand-in for the churn model of the scorer; uses the one-hot segments."""
    z = linear(CHURN_SCORE)
    for segment, w in SEGMENT_SHIFT.items():
        z = z + F.lit(w) * F.col(f"seg_{segment}")
    return df.withColumn("churn_probability", F.round(logistic(z), 6))
