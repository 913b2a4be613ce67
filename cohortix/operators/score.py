"""Scoring unseen rows with stored parameters: one narrow stage, batch or streaming."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.functions.expr import constant_map, one_of, right_closed_band
from cohortix.operators import clean
from cohortix.operators.campaign import escalated
from cohortix.operators.churn import PROBABILITY, add_one_hot, with_probability
from cohortix.operators.mixture import Mixture, soft_assign


def model_probability(model: Model) -> Callable[[DataFrame], DataFrame]:
    """Adds ``churn_probability`` by a fitted model and drops its working columns."""
    def add(df: DataFrame) -> DataFrame:
        return with_probability(model, df).select(*df.columns, PROBABILITY)
    return add


def prepare(raw: DataFrame, params: clean.CleaningParams, like_training: bool = False) -> DataFrame:
    """Fences, day range, floor and ratios from stored parameters; nothing is learned.

    ``like_training`` also fills gaps with the stored medians and caps the ratios.
    """
    df = clean.impute(raw, params.medians) if like_training else raw
    df = (
        df.transform(clean.apply_fences, params.fences)
        .transform(clean.clip_days).transform(clean.floor_revenue).transform(clean.add_ratios)
    )
    return clean.cap_ratios(df, params.ratio_caps) if like_training else df


GATED = dict(zip((S.SEGMENT, "offer", "action", "priority"), (*S.UNSEGMENTED, None)))


def risk_band(p: Column) -> Column:
    return right_closed_band(p, S.RISK_BANDS, -0.01)


def gate_tenure(df: DataFrame) -> DataFrame:
    """Rows without enough tenure, or that no segment was found for, keep their numbers but get
    no segment, no offer and no priority."""
    short = ~clean.tenured() | F.col(S.SEGMENT).isNull()
    # one struct, so that the test sees the segment as it was
    gated = F.when(short, F.struct(*[F.lit(v).alias(c) for c, v in GATED.items()])).otherwise(
        F.struct(*[F.col(c).alias(c) for c in GATED if c in df.columns],
                 *[F.lit(None).cast("string").alias(c) for c in GATED if c not in df.columns]))
    out = df.withColumn("_gated", gated)
    return out.withColumns({c: F.col(f"_gated.{c}") for c in GATED if c in df.columns}).drop("_gated")


def _offer_part(position: int) -> Column:
    values = {segment: offer[position] for segment, offer in S.OFFERS.items()}
    return constant_map(F.col(S.SEGMENT), values)


def attach_offer_narrow(df: DataFrame) -> DataFrame:
    """Offer, action and escalated priority without a join, so a stream needs no static side."""
    offer = F.when(F.col(S.SEGMENT).isNotNull(), one_of(F.col(S.SEGMENT), _offer_part(0), "offer"))
    return df.withColumns({
        "offer": offer, "action": _offer_part(1),
        "priority": escalated(_offer_part(2), F.col(PROBABILITY)),
    })


@dataclass(frozen=True)
class Scorer:
    cleaning: clean.CleaningParams
    mixture: Mixture
    names: dict[int, str]
    threshold: float
    levels: tuple[str, ...]
    add_probability: Callable[[DataFrame], DataFrame]
    like_training: bool = False

    def segment_of(self, cluster: str) -> Column:
        named = one_of(F.col(cluster), constant_map(F.col(cluster), self.names), "segment")
        return F.when(F.col(cluster).isNotNull(), named)

    def score(self, raw: DataFrame) -> DataFrame:
        """Segment, confidence, runner-up, churn risk, band, offer and priority per row.

        A row that lacks a cluster feature stays unsegmented; one that lacks a model feature
        has no probability, flag or band. A cluster without a name fails the job.
        """
        params = self.cleaning
        working = [clean.scaled_name(c) for c in params.means]
        assigned = (
            prepare(raw, params, self.like_training)
            .transform(clean.standardise, params.means, params.stds)
            .transform(soft_assign, self.mixture)
            .drop(*working, "probabilities", "log_density")
        )
        named = assigned.withColumns({
            S.SEGMENT: self.segment_of("cluster_id"),
            "runner_up_segment": self.segment_of("runner_up_id"),
        }).withColumnsRenamed({"confidence": "segment_confidence"}).drop("runner_up_id")
        risky = self.add_probability(add_one_hot(named, self.levels))
        kept = [c for c in risky.columns if not c.startswith("seg_")]
        return (
            risky.select(*kept)
            .withColumn("churn_prediction", (F.col(PROBABILITY) >= self.threshold).cast("int"))
            .withColumn("risk_band", risk_band(F.col(PROBABILITY)))
            .transform(attach_offer_narrow)
            .transform(gate_tenure)
        )


def review_queue(scored: DataFrame, below: float = S.REVIEW_CONFIDENCE,
                 confidence: str = "segment_confidence",
                 runner_up: str = "runner_up_confidence") -> DataFrame:
    """Borderline assignments with the gap to the second-best segment."""
    gap = F.col(confidence) - F.col(runner_up)
    return scored.where(F.col(confidence) < below).withColumn("confidence_gap", gap)
