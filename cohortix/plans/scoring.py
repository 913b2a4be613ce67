"""Batch scoring of a table of unseen rows, and the fixed set of hand-built cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.operators.score import Scorer
from cohortix.session import frame_of
from cohortix.sources import artefacts
from cohortix.sources.sinks import write_report

CASE_COLUMNS = (
    "case_id", S.SEGMENT, "segment_confidence", "runner_up_segment", "runner_up_confidence",
    "churn_probability", "churn_prediction", "risk_band", "offer",
)
CASE_SCHEMA = (
    "case_id string, average_data_usage double, average_revenue double, average_dou int, "
    "pack_flag int, aon int, rationale string"
)

# ---- fixed values: boundary cases for a scoring run -------------------------
CASES = (
    ("HIGH_VALUE_WHALE", 26.0, 840.0, 29, 1, 2100, "textbook Premium Power"),
    ("LOYAL_LONG_TENURE", 14.0, 380.0, 26, 1, 2400, "textbook Loyal Core"),
    ("HEAVY_DATA_LOW_SPEND", 19.5, 300.0, 26, 0, 1500, "Sleeping Giant: upsell target"),
    ("PACK_HOPPER", 8.0, 200.0, 22, 1, 650, "textbook Deal Seeker"),
    ("ERRATIC_LOW_ENGAGE", 3.2, 115.0, 10, 1, 1000, "textbook Question Mark"),
    ("DORMANT_STICKY", 1.4, 80.0, 8, 0, 2300, "textbook Comfortably Numb"),
    ("BORDERLINE_MIDFIELD", 11.0, 285.0, 23, 1, 1200, "sits between two clusters"),
    ("BRAND_NEW_SIM", 9.0, 250.0, 20, 1, 30, "AON=30d -> must be refused"),
    ("CORPORATE_IOT_SIM", 950.0, 410.0, 30, 1, 1800, "extreme usage -> fence must cap"),
    ("CREDIT_ADJUSTED", 6.0, -45.0, 18, 1, 800, "negative revenue -> must floor"),
)
# ---- end of fixed values ----------------------------------------------------


def cases(spark: SparkSession) -> DataFrame:
    return frame_of(spark, CASES, CASE_SCHEMA)


def score_table(spark: SparkSession, artefact_path: str, rows: DataFrame) -> DataFrame:
    return artefacts.load(spark, artefact_path).score(rows)


def verify_cases(scored: DataFrame, scorer: Scorer) -> DataFrame:
    """check, passed: tenure refused, usage at the fence, negative revenue floored."""
    cap = scorer.cleaning.fences[S.USAGE].high
    checks = {
        "BRAND_NEW_SIM": F.col(S.SEGMENT) == S.UNSEGMENTED[0],
        "CORPORATE_IOT_SIM": F.abs(F.col(S.USAGE) - F.least(F.lit(cap), F.lit(950.0))) < 1e-6,
        "CREDIT_ADJUSTED": F.col(S.REVENUE) == 0.0,
    }
    passed = F.lit(None).cast("boolean")
    for case, ok in checks.items():
        passed = F.when(F.col("case_id") == case, ok).otherwise(passed)
    return scored.where(F.col("case_id").isin(*checks)).select("case_id", passed.alias("passed"))


def score_cases(spark: SparkSession, out: str) -> DataFrame:
    scored = score_table(spark, f"{out}/artefacts", cases(spark)).select(*CASE_COLUMNS, "rationale")
    write_report(scored, f"{out}/sample_predictions")
    scored.drop("rationale").coalesce(1).write.mode("overwrite").json(f"{out}/sample_predictions_json")
    return scored
