"""Cleaning: copies, tenure, invalid values, gaps, outliers, ratios, scale.

Statistics are learned by an action that returns a handful of numbers (``learn_*``) and
applied as plain column expressions, so the apply side never shuffles and also runs on
unseen rows or a stream.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.functions.expr import clip
from cohortix.functions.quantile import QUANTILES, interpolated, order_statistics, quantile_ranks
from cohortix.session import frame_of, written

COPIES = "copies"


@dataclass(frozen=True)
class Fence:
    low: float
    high: float


@dataclass(frozen=True)
class CleaningParams:
    """Everything the cleaning learned; enough to prepare unseen rows the same way."""

    medians: dict[str, float] = field(default_factory=dict)
    fences: dict[str, Fence] = field(default_factory=dict)
    ratio_caps: dict[str, float] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> CleaningParams:
        raw = json.loads(text)
        raw["fences"] = {c: Fence(**f) for c, f in raw["fences"].items()}
        return cls(**raw)


# ---- rows -------------------------------------------------------------------
def drop_copies(df: DataFrame, payload: Sequence[str] = S.PAYLOAD, count: bool = False) -> DataFrame:
    """Keep the lowest id of rows equal in every payload column, missing equal to missing.

    Grouping combines copies before the shuffle, so a payload shared by a third of the
    table still sends one row per map task.
    """
    kept = df.groupBy(*payload).agg(
        F.min(S.ID).alias(S.ID),
        *([F.count(F.lit(1)).alias(COPIES)] if count else []),
    )
    return kept.select(S.ID, *payload, *([COPIES] if count else []))


def tenured():
    """Rows with enough tenure; a missing tenure is not."""
    return F.coalesce(F.col(S.TENURE) >= S.MIN_TENURE_DAYS, F.lit(False))


def keep_tenured(df: DataFrame) -> DataFrame:
    return df.where(F.col(S.TENURE) >= S.MIN_TENURE_DAYS)


def floor_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn(S.REVENUE, clip(F.col(S.REVENUE), low=0.0))


def clip_days(df: DataFrame) -> DataFrame:
    return df.withColumn(S.DOU, clip(F.col(S.DOU), 0.0, float(S.MAX_ACTIVE_DAYS)))


def valid_rows(deduped: DataFrame) -> DataFrame:
    """Tenured rows with values in range; gaps still open. Narrow, no shuffle."""
    return deduped.drop(COPIES).transform(keep_tenured).transform(floor_revenue).transform(clip_days)


# ---- gaps and outliers ------------------------------------------------------
def learn_medians(df: DataFrame, cols: Sequence[str] = S.IMPUTED, method: str = "exact") -> dict[str, float]:
    found = QUANTILES[method](df, {c: [0.5] for c in cols})
    return {c: v[0] for c, v in found.items() if v[0] is not None}


def impute(df: DataFrame, medians: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(m)) for c, m in medians.items()})


QUARTILES = (0.25, 0.75)


def fence(q1: float, q3: float, k: float = S.FENCE_K) -> Fence:
    return Fence(q1 - k * (q3 - q1), q3 + k * (q3 - q1))


def learn_fences(
    df: DataFrame, cols: Sequence[str] = S.CAPPED, k: float = S.FENCE_K, method: str = "exact",
) -> dict[str, Fence]:
    found = QUANTILES[method](df, {c: QUARTILES for c in cols})
    return {c: fence(*q, k) for c, q in found.items() if q[0] is not None}


def learn_gaps_and_fences(
    df: DataFrame, cols: Sequence[str] = S.IMPUTED, k: float = S.FENCE_K,
) -> tuple[dict[str, float], dict[str, Fence]]:
    """Medians, and the fences of the columns once their gaps are filled with them, in one search.

    Filling puts as many copies of the median into the order of the values as there are gaps.
    The value at a rank of the filled column is then the one at that rank of the present values
    if it is below the median, the one as many ranks lower as there are gaps if that is above
    it, and else the median: all of them ranks of the column as it is.
    """
    def ranks(row: Row) -> dict[str, list[int]]:
        out = {}
        for c in cols:
            n, gaps = row[f"n_{c}"], row["rows"] - row[f"n_{c}"]
            filled = quantile_ranks(row["rows"], QUARTILES)
            out[c] = [*quantile_ranks(n, [0.5]), *filled, *[r - gaps for r in filled]]
        return out

    found, row = order_statistics(df, cols, ranks, also=[F.count(F.lit(1)).alias("rows")])
    medians, fences = {}, {}
    for c in cols:
        n, rows = row[f"n_{c}"], row["rows"]
        if not n:
            continue
        medians[c] = middle = interpolated(lambda r: found[c, r], n, 0.5)

        def filled(rank: int) -> float:
            below, above = found.get((c, rank)), found.get((c, rank - (rows - n)))
            if below is not None and below < middle:
                return below
            return above if above is not None and above > middle else middle

        fences[c] = fence(*[interpolated(filled, rows, q) for q in QUARTILES], k)
    return medians, fences


def apply_fences(df: DataFrame, fences: Mapping[str, Fence]) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), f.low, f.high) for c, f in fences.items()})


def count_capped(df: DataFrame, fences: Mapping[str, Fence]) -> DataFrame:
    """One row per fenced column: feature, low, high, n_capped."""
    outside = [
        F.struct(
            F.lit(c).alias("feature"), F.lit(f.low).alias("low"), F.lit(f.high).alias("high"),
            F.count_if((F.col(c) < f.low) | (F.col(c) > f.high)).alias("n_capped"),
        )
        for c, f in fences.items()
    ]
    return df.agg(F.array(*outside).alias("rows")).select(F.inline("rows"))


# ---- features ---------------------------------------------------------------
def add_ratios(df: DataFrame) -> DataFrame:
    eps = F.lit(S.RATIO_EPSILON)
    usage, revenue, dou = F.col(S.USAGE), F.col(S.REVENUE), F.col(S.DOU)
    return df.withColumns({
        "revenue_per_gb": revenue / (usage + eps),
        "usage_intensity": usage / (dou + eps),
        "revenue_per_active_day": revenue / (dou + eps),
        S.DORMANT: F.coalesce(dou <= S.DORMANT_DAYS, F.lit(False)).cast("int"),
    })


def learn_ratio_caps(df: DataFrame, method: str = "exact") -> dict[str, float]:
    found = QUANTILES[method](df, {c: [S.RATIO_CAP_QUANTILE] for c in S.RATIOS})
    return {c: v[0] for c, v in found.items() if v[0] is not None}


def learn_caps_and_scaler(df: DataFrame) -> tuple[dict[str, float], dict, dict]:
    """Ratio caps, means and standard deviations in one search."""
    q = S.RATIO_CAP_QUANTILE
    found, row = order_statistics(
        df, S.RATIOS, lambda row: {c: quantile_ranks(row[f"n_{c}"], [q]) for c in S.RATIOS}, also=_moments(S.CLUSTER_FEATURES))
    caps = {c: interpolated(lambda r: found[c, r], row[f"n_{c}"], q) for c in S.RATIOS if row[f"n_{c}"]}
    return caps, *_scaler(row, S.CLUSTER_FEATURES)


def cap_ratios(df: DataFrame, caps: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), high=v) for c, v in caps.items()})


def _moments(cols: Sequence[str]) -> list[Column]:
    return [*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]]


def _scaler(row: Row, cols: Sequence[str]) -> tuple[dict[str, float], dict[str, float]]:
    return {c: row[f"m_{c}"] for c in cols}, {c: row[f"s_{c}"] or 1.0 for c in cols}


def learn_scaler(df: DataFrame, cols: Sequence[str] = S.CLUSTER_FEATURES) -> tuple[dict, dict]:
    """Means and population standard deviations in one pass; a constant column scales by 1."""
    return _scaler(df.agg(*_moments(cols)).first(), cols)


def scaled_name(c: str) -> str:
    return f"z_{c}"


def standardise(df: DataFrame, means: Mapping[str, float], stds: Mapping[str, float]) -> DataFrame:
    return df.withColumns({
        scaled_name(c): (F.col(c) - F.lit(m)) / F.lit(stds[c]) for c, m in means.items()
    })


# ---- the whole cleaning -----------------------------------------------------
def complete(df: DataFrame, params: CleaningParams) -> DataFrame:
    """Apply learned parameters to the output of ``valid_rows``."""
    return (
        df.transform(impute, params.medians)
        .transform(apply_fences, params.fences)
        .transform(add_ratios)
        .transform(cap_ratios, params.ratio_caps)
    )


def learn_params(valid: DataFrame, method: str = "exact") -> CleaningParams:
    """Learn each statistic on the output of the step before it.

    The exact method reads the rows twice up to ``quantile.SKETCH`` of them, and four times up to
    some hundred million.
    """
    if method == "exact":
        medians, fences = learn_gaps_and_fences(valid)
        caps, means, stds = learn_caps_and_scaler(add_ratios(apply_fences(impute(valid, medians), fences)))
        return CleaningParams(medians, fences, caps, means, stds)
    medians = learn_medians(valid, method=method)
    filled = impute(valid, medians)
    fences = learn_fences(filled, method=method)
    capped = add_ratios(apply_fences(filled, fences))
    return CleaningParams(medians, fences, learn_ratio_caps(capped, method=method), *learn_scaler(capped))


def _audit() -> list[Column]:
    kept = tenured()
    return [
        F.coalesce(F.sum(COPIES), F.lit(0)).alias("rows_in"),
        F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0)).alias("dropped_duplicates"),
        F.count_if(~kept).alias("dropped_by_aon_filter"),
        F.count_if(kept & (F.col(S.REVENUE) < 0)).alias("negative_revenue_floored"),
        F.count_if(kept & ((F.col(S.DOU) < 0) | (F.col(S.DOU) > S.MAX_ACTIVE_DAYS)))
        .alias("dou_clipped_to_0_30"),
        *[F.count_if(kept & F.col(c).isNull()).alias(f"imputed_{c}") for c in S.IMPUTED],
        F.count_if(kept).alias("rows_out"),
    ]


def audit(deduped: DataFrame) -> DataFrame:
    """Every dropped or repaired row counted, in one aggregate over ``drop_copies(.., count=True)``."""
    return deduped.agg(*_audit())


@dataclass(frozen=True)
class Cleaned:
    table: DataFrame
    params: CleaningParams
    valid: DataFrame
    deduped: DataFrame
    audited: dict[str, int]  # the audit, counted by the write of the deduplicated rows


def run(raw: DataFrame, method: str = "exact") -> Cleaned:
    """Clean ``raw``. The deduplicated rows are written and counted once; every later step is narrow."""
    counted = Observation()
    deduped = written(drop_copies(raw, count=True).observe(counted, *_audit()), "deduped")
    valid = valid_rows(deduped)
    params = learn_params(valid, method)
    return Cleaned(complete(valid, params), params, valid, deduped, counted.get)


def one_row(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """Observed counts as a table of one row."""
    return frame_of(spark, [tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


def write_checked(clean: DataFrame, params: CleaningParams, write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, dict[str, int]]:
    """Write the cleaned table by ``write``; the counts of ``violations`` come from the write itself."""
    counted = Observation()
    table = write(clean.observe(counted, *_violations(params)))
    return table, counted.get


# ---- data quality -----------------------------------------------------------
def quality_profile(raw: DataFrame, subset: Sequence[str] = (S.REVENUE, S.DOU, S.TENURE)) -> DataFrame:
    """Defect counts of the raw table in one row."""
    groups = raw.groupBy(*subset).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in S.PAYLOAD],
        F.count_if(F.col(S.REVENUE) < 0).alias("negative_revenue"),
        F.count_if(~F.col(S.CHURN).isin(0, 1)).alias("label_not_binary"),
        F.sum(S.CHURN).alias("positives"),
    )
    n = F.sum("n")
    return groups.agg(
        n.alias("rows_in"),
        *[F.sum(f"null_{c}").alias(f"null_{c}") for c in S.PAYLOAD],
        F.sum("negative_revenue").alias("negative_revenue"),
        F.sum(F.col("n") - 1).alias("duplicate_rows"),
        F.sum("label_not_binary").alias("label_not_binary"),
        F.round(F.sum("positives") / n, 6).alias("base_rate"),
        (F.sum("positives") / n).between(0.10, 0.50).alias("base_rate_plausible"),
    )


def _violations(params: CleaningParams) -> list[Column]:
    def broken(c: str):
        return F.col(c).isNull() | F.isnan(c) | (F.abs(F.col(c)) == float("inf"))

    return [
        F.count_if(~tenured()).alias("short_tenure"),
        *[F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in S.CLUSTER_FEATURES],
        F.count_if(F.col(S.REVENUE) < 0).alias("negative_revenue"),
        F.count_if(~F.col(S.DOU).between(0, S.MAX_ACTIVE_DAYS)).alias("dou_out_of_range"),
        *[F.count_if((F.col(c) > f.high + 1e-6) | (F.col(c) < f.low - 1e-6)).alias(f"outside_{c}")
          for c, f in params.fences.items()],
        *[F.count_if(broken(c)).alias(f"not_finite_{c}") for c in S.RATIOS],
    ]


def violations(clean: DataFrame, params: CleaningParams) -> DataFrame:
    """Post-conditions of the cleaning; every count must be 0."""
    return clean.agg(*_violations(params))
