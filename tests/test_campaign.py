import pytest
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.catalog import standins as P
from cohortix.operators import campaign, sample, score
from cohortix.plans.scoring import cases, verify_cases
from cohortix.session import frame_of


def test_every_segment_has_an_offer():
    assert set(S.OFFERS) == set(S.SEGMENT_BY_RANK.values())


def test_priority_moves_one_level_and_control_is_silent(spark):
    rows = [
        ("Comfortably Numb", 0.7, "UTG"), ("Comfortably Numb", 0.59, "UTG"), ("Deal Seeker", 0.6, "UTG"),
        ("Loyal Core", 0.9, "UTG"), ("Premium Power", 0.9, "UTG"), ("Deal Seeker", 0.9, "UCG"),
        ("Question Mark", None, "UTG"),
    ]
    df = frame_of(spark, rows, "segment string, churn_probability double, campaign_group string")
    got = [(r["priority"], r["action"]) for r in campaign.recommend_offers(df).collect()]
    assert got == [("Medium", "Reactivate"), ("Low", "Reactivate"), ("High", "Sustain"), ("High", "Retain"),
                   ("Very High", "Retain"), ("N/A", "None"), ("Medium", "Activate")]


def test_without_risk_nothing_escalates(spark):
    df = frame_of(spark, [("Comfortably Numb", "UTG")], "segment string, campaign_group string")
    assert campaign.recommend_offers(df).first()["priority"] == "Low"


def test_unknown_segment_fails_the_job(spark):
    df = frame_of(spark, [("Nobody", "UTG")], "segment string, campaign_group string")
    with pytest.raises(Exception, match="no offer for Nobody"):
        campaign.recommend_offers(df).collect()


def test_balance_of_equal_groups(spark):
    df = spark.range(400).selectExpr(
        "id customer_id", "cast(id % 13 as double) average_data_usage", "cast(id % 7 as double) average_revenue",
        "5d average_dou", "cast(id % 2 as int) pack_flag", "cast(id % 50 as int) aon", "0 churn", "'s' segment")
    out = {r["feature"]: r for r in campaign.balance_check(sample.assign_holdout(df, 0.5)).collect()}
    assert set(out) == set(S.BALANCE_COVARIATES)
    assert out[S.DOU]["abs_smd"] == 0.0 and out[S.CHURN]["balanced"]
    assert all(r["abs_smd"] < 0.3 for r in out.values())


def test_summary_counts_an_empty_group_as_zero(spark):
    df = spark.range(5).selectExpr(
        "id customer_id", "1d average_data_usage", "2d average_revenue", "3d average_dou", "1 pack_flag",
        "100 aon", "0 churn", "'Loyal Core' segment", "'UTG' campaign_group", "0.5d churn_probability")
    row = campaign.segment_summary(df).first()
    assert (row["customers"], row["ucg_count"], row["utg_count"]) == (5, 0, 5)
    assert row["revenue_at_risk_inr"] == 5.0 and row["pct_of_base"] == 100.0


def test_risk_bands_close_on_the_right(spark):
    probes = [(0.0, "Low"), (0.25, "Low"), (0.2500001, "Moderate"), (0.5, "Moderate"), (0.75, "High"),
              (0.76, "Critical"), (1.0, "Critical"), (None, None)]
    df = frame_of(spark, probes, "p double, want string")
    assert df.where(~score.risk_band(F.col("p")).eqNullSafe(F.col("want"))).count() == 0


def scorer(like_training=False):
    return score.Scorer(P.PARAMS, P.MIXTURE, P.SEGMENT_OF_CLUSTER, P.THRESHOLD, tuple(sorted(S.OFFERS)),
                        P.shifted_probability, like_training)


def test_boundary_cases(spark):
    scored = scorer().score(cases(spark))
    assert {r["passed"] for r in verify_cases(scored, scorer()).collect()} == {True}
    refused = scored.where("case_id = 'BRAND_NEW_SIM'").first()
    assert refused["offer"] == "Hold - insufficient tenure" and refused["churn_probability"] is not None


def test_missing_tenure_is_refused(spark):
    df = cases(spark).withColumn(S.TENURE, F.lit(None).cast("int"))
    assert {r[S.SEGMENT] for r in scorer().score(df).collect()} == {S.UNSEGMENTED[0]}


def test_review_queue_has_the_gap(spark):
    scored = scorer().score(cases(spark))
    for r in score.review_queue(scored).collect():
        assert r["segment_confidence"] < 0.8
        assert r["confidence_gap"] == pytest.approx(r["segment_confidence"] - r["runner_up_confidence"])


def test_scoring_is_one_narrow_stage(spark):
    plan = scorer().score(spark.createDataFrame(cases(spark).collect()))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
