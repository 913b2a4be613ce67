"""Campaign design: balance check, offers, holdout suppression, segment economics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.functions.expr import one_of, whole_table
from cohortix.session import frame_of


def offer_book(spark: SparkSession) -> DataFrame:
    rows = [(segment, *offer) for segment, offer in S.OFFERS.items()]
    return frame_of(spark, rows, "segment string, offer string, action string, priority string")


def attach_offer(df: DataFrame) -> DataFrame:
    """Offer, action and base priority of the segment; an unknown segment fails the job."""
    joined = df.join(F.broadcast(offer_book(df.sparkSession)), S.SEGMENT, "left")
    return joined.withColumn("offer", one_of(F.col(S.SEGMENT), F.col("offer"), "offer"))


def escalated(priority: Column, risk: Column) -> Column:
    """One level up when the risk is high; only Medium and Low move."""
    high = F.coalesce(risk >= S.ESCALATE_AT, F.lit(False))
    return (
        F.when(high & (priority == "Medium"), F.lit("High"))
        .when(high & (priority == "Low"), F.lit("Medium"))
        .otherwise(priority)
    )


def suppress_holdout(df: DataFrame) -> DataFrame:
    """Control rows are never contacted."""
    control = F.col(S.GROUP) == S.CONTROL
    return df.withColumns({
        c: F.when(control, F.lit(value)).otherwise(F.col(c))
        for c, value in zip(("offer", "action", "priority"), S.HOLDOUT_OFFER)
    })


def recommend_offers(df: DataFrame, risk: str = "churn_probability") -> DataFrame:
    out = attach_offer(df)
    if risk in df.columns:
        out = out.withColumn("priority", escalated(F.col("priority"), F.col(risk)))
    return suppress_holdout(out)


def balance_check(df: DataFrame, covariates: tuple[str, ...] = S.BALANCE_COVARIATES) -> DataFrame:
    """Means of both groups and the standardised difference per covariate, in one pass."""
    def of(group: str, c: str) -> Column:
        return F.when(F.col(S.GROUP) == group, F.col(c).cast("double"))

    def row(c: str) -> Column:
        t, u = of(S.TARGET, c), of(S.CONTROL, c)
        sd = F.sqrt((F.var_samp(t) + F.var_samp(u)) / 2)
        smd = F.when(sd > 0, F.abs(F.avg(t) - F.avg(u)) / sd).otherwise(F.lit(0.0))
        return F.struct(F.lit(c).alias("feature"), F.avg(t).alias("utg_mean"),
                        F.avg(u).alias("ucg_mean"), smd.alias("abs_smd"))

    rows = df.agg(F.array(*[row(c) for c in covariates]).alias("rows")).select(F.inline("rows"))
    return rows.withColumn("balanced", F.col("abs_smd") < S.BALANCE_LIMIT)


def all_balanced(balance: DataFrame) -> DataFrame:
    return balance.agg(F.every("balanced").alias("all_balanced"))


def segment_summary(df: DataFrame, risk: str = "churn_probability") -> DataFrame:
    """Who the segments are, what they are worth and what is at risk: one aggregate."""
    risks = [
        F.avg(risk).alias("mean_churn_risk"),
        F.sum(F.col(S.REVENUE) * F.col(risk)).alias("revenue_at_risk_inr"),
    ] if risk in df.columns else []
    summary = df.groupBy(S.SEGMENT).agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg(S.REVENUE).alias("avg_revenue"),
        F.avg(S.USAGE).alias("avg_data_gb"),
        F.avg(S.DOU).alias("avg_dou"),
        F.avg(S.TENURE).alias("avg_aon_days"),
        (100 * F.avg(S.PACK)).alias("pack_penetration"),
        (100 * F.avg(S.CHURN)).alias("actual_churn_rate"),
        F.sum(S.REVENUE).alias("monthly_revenue_inr"),
        *risks,
        F.count_if(F.col(S.GROUP) == S.CONTROL).alias("ucg_count"),
        F.count_if(F.col(S.GROUP) == S.TARGET).alias("utg_count"),
    )
    share = 100.0 * F.col("customers") / F.sum("customers").over(whole_table())
    cols = summary.columns
    return (
        summary.withColumn("pct_of_base", share)
        .select(*cols[:2], "pct_of_base", *cols[2:])
        .orderBy(F.col("avg_revenue").desc())
    )
