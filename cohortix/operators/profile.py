"""Cluster profiles, naming by revenue rank, agreement, elbow and portfolio figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.functions.expr import constant_map, one_of, turn_in_table, whole_table
from cohortix.session import frame_of


def cluster_profile(df: DataFrame, label: str) -> DataFrame:
    """Means, size, share, revenue rank (1 = highest mean) and name of every cluster."""
    rank = F.row_number().over(turn_in_table(F.col(S.REVENUE).desc(), label))
    return (
        df.groupBy(label)
        .agg(*[F.avg(c).alias(c) for c in (*S.CLUSTER_FEATURES, S.TENURE)],
             F.count(F.lit(1)).alias("n_customers"))
        .withColumn("pct_of_base", 100.0 * F.col("n_customers") / F.sum("n_customers").over(whole_table()))
        .withColumn("revenue_rank", rank)
        .withColumn(S.SEGMENT, constant_map(F.col("revenue_rank"), S.SEGMENT_BY_RANK))
        .orderBy("revenue_rank")
    )


def cluster_names(profile: DataFrame, label: str) -> dict[int, str]:
    """Cluster id -> segment; a cluster ranked beyond the named segments is an error."""
    names = {r[label]: r[S.SEGMENT] for r in profile.select(label, S.SEGMENT).collect()}
    unnamed = sorted(c for c, name in names.items() if name is None)
    if unnamed:
        raise ValueError(f"no segment name for clusters {unnamed}")
    return names


def attach_segment(df: DataFrame, label: str, names: dict[int, str], out: str = S.SEGMENT) -> DataFrame:
    """Look the segment up by cluster id through a broadcast dimension of ``len(names)`` rows."""
    key_type = df.schema[label].dataType.simpleString()
    dim = frame_of(df.sparkSession, sorted(names.items()), f"{label} {key_type}, {out} string")
    joined = df.join(F.broadcast(dim), label, "left")
    return joined.withColumn(out, one_of(F.col(label), F.col(out), "segment"))


def purity(df: DataFrame, a: str, b: str) -> DataFrame:
    """Share of rows in the largest ``b`` cell of their ``a`` group."""
    cells = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    best = cells.groupBy(a).agg(F.max("n").alias("top"), F.sum("n").alias("n"))
    return best.agg((F.sum("top") / F.sum("n")).alias("agreement"))


def with_elbow_distance(sweep: DataFrame) -> DataFrame:
    """Distance of every swept k from the chord, up to the constant chord length."""
    by_k = whole_table("k")
    k0, k1 = F.first("k").over(by_k), F.last("k").over(by_k)
    y0, y1 = F.first("inertia").over(by_k), F.last("inertia").over(by_k)
    cross = (k1 - k0) * (F.col("inertia") - y0) - (y1 - y0) * (F.col("k") - k0)
    return sweep.withColumn("distance", F.abs(cross))


def elbow_k(sweep: DataFrame) -> DataFrame:
    """The k furthest from the chord; the lowest such k on a tie."""
    furthest = F.max(F.struct(F.col("distance"), (-F.col("k")).alias("k")))
    return with_elbow_distance(sweep).agg((-furthest["k"]).alias("elbow_k"))


def best_row(df: DataFrame, score: str, order: str, keep: Sequence[str]) -> DataFrame:
    """The row with the highest ``score``, first in ``order`` on a tie."""
    return df.orderBy(F.col(score).desc(), F.col(order)).limit(1).select(*keep)


def confidence_stats(df: DataFrame, confidence: str = "gmm_confidence") -> DataFrame:
    return df.agg(
        F.avg(confidence).alias("mean_confidence"),
        F.count_if(F.col(confidence) < S.LOW_CONFIDENCE).alias("low_confidence_customers"),
    )


def value_shares(df: DataFrame, col: str) -> DataFrame:
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", 100.0 * F.col("n") / F.sum("n").over(whole_table()))


def portfolio_totals(df: DataFrame, risk: str = "churn_probability") -> DataFrame:
    return df.agg(
        F.sum(S.REVENUE).alias("total_monthly_revenue"),
        F.sum(F.col(S.REVENUE) * F.col(risk)).alias("total_revenue_at_risk"),
        F.avg(S.CHURN).alias("churn_base_rate"),
        F.count(F.lit(1)).alias("customers"),
    )
