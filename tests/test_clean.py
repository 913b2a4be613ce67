import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.operators import clean
from cohortix.operators.clean import CleaningParams
from cohortix.session import written

COLUMNS = "customer_id long, average_data_usage double, average_revenue double, average_dou double, " \
          "pack_flag int, aon int, churn int"


def rows(spark, *data):
    return spark.createDataFrame(list(data), COLUMNS)


def test_invariants_hold_after_cleaning(cleaned):
    found = clean.violations(cleaned.table, cleaned.params).first().asDict()
    assert set(found.values()) == {0}


def test_audit_reconciles(raw, cleaned):
    a = clean.audit(cleaned.deduped).first().asDict()
    assert a["rows_in"] == raw.count()
    assert a["rows_out"] == a["rows_in"] - a["dropped_duplicates"] - a["dropped_by_aon_filter"]
    assert a["rows_out"] == cleaned.table.count()


def test_defects_are_present_in_the_input(raw):
    q = clean.quality_profile(raw).first().asDict()
    assert q["null_average_data_usage"] > 0 and q["negative_revenue"] > 0 and q["duplicate_rows"] > 0
    assert q["label_not_binary"] == 0 and q["base_rate_plausible"]


def test_copies_keep_the_lowest_id_and_missing_equals_missing(spark):
    df = rows(spark, (7, None, 1.0, 2.0, 1, 100, 0), (3, None, 1.0, 2.0, 1, 100, 0),
              (5, 4.0, 1.0, 2.0, 1, 100, 0), (6, 4.0, 1.0, 2.0, 1, 101, 0))
    assert sorted(r[S.ID] for r in clean.drop_copies(df).collect()) == [3, 5, 6]


def test_hot_payload_is_combined_before_the_shuffle(spark):
    hot = spark.range(5000).selectExpr(
        "id customer_id", "1d average_data_usage", "1d average_revenue", "1d average_dou",
        "1 pack_flag", "100 aon", "0 churn")
    assert clean.drop_copies(hot).collect()[0][S.ID] == 0
    plan = clean.drop_copies(hot)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def test_missing_tenure_is_not_tenured(spark):
    df = rows(spark, (1, 1.0, 1.0, 1.0, 0, None, 0), (2, 1.0, 1.0, 1.0, 0, 89, 0), (3, 1.0, 1.0, 1.0, 0, 90, 0))
    assert [r[S.ID] for r in clean.keep_tenured(df).collect()] == [3]


def test_clip_keeps_missing_missing(spark):
    df = rows(spark, (1, 1.0, None, None, 0, 90, 0), (2, 1.0, -5.0, 31.0, 0, 90, 0), (3, 1.0, 5.0, -1.0, 0, 90, 0))
    out = {r[S.ID]: (r[S.REVENUE], r[S.DOU]) for r in clean.clip_days(clean.floor_revenue(df)).collect()}
    assert out == {1: (None, None), 2: (0.0, 30.0), 3: (5.0, 0.0)}


def test_revenue_gaps_are_filled_with_the_median(raw):
    holed = raw.withColumn(S.REVENUE, F.when(F.col(S.ID) % 7 != 3, F.col(S.REVENUE)))
    done = clean.run(holed)
    assert done.valid.where(F.col(S.REVENUE).isNull()).count() > 0
    assert done.table.where(F.col(S.REVENUE).isNull()).count() == 0
    kept = done.valid.select(S.REVENUE).dropna().toPandas()[S.REVENUE]
    assert done.params.medians[S.REVENUE] == pytest.approx(kept.median())


def test_missing_days_do_not_break_the_ratio_caps(raw):
    holed = raw.withColumn(S.DOU, F.when(F.col(S.ID) % 5 != 1, F.col(S.DOU)))
    assert set(clean.run(holed).params.ratio_caps) == set(S.RATIOS)


def test_scaled_columns_have_unit_moments(cleaned):
    z = clean.standardise(cleaned.table, cleaned.params.means, cleaned.params.stds)
    row = z.agg(*[F.avg(clean.scaled_name(c)) for c in S.CLUSTER_FEATURES],
                *[F.stddev_pop(clean.scaled_name(c)) for c in S.CLUSTER_FEATURES]).first()
    assert list(row) == pytest.approx([0, 0, 0, 0, 1, 1, 1, 1], abs=1e-9)


def test_params_survive_json(cleaned):
    assert CleaningParams.from_json(cleaned.params.to_json()) == cleaned.params


def test_approximate_method_runs(raw):
    assert clean.run(raw, "approx").params.fences[S.USAGE].high > 0


def test_audit_and_conditions_come_from_the_writes(raw):
    done = clean.run(raw)
    assert done.audited == clean.audit(done.deduped).first().asDict()
    _, broken = clean.write_checked(done.table, done.params, lambda df: written(df, "clean"))
    assert broken == clean.violations(done.table, done.params).first().asDict() and not any(broken.values())
    worse = done.table.withColumn(S.REVENUE, F.col(S.REVENUE) - 20)
    _, broken = clean.write_checked(worse, done.params, lambda df: written(df, "worse"))
    assert broken["negative_revenue"] > 0


@pytest.mark.parametrize("gaps", [0, 1, 7, 40, 300])
def test_fences_of_the_filled_column_from_ranks_of_the_present_values(spark, gaps):
    rng = np.random.default_rng(gaps)
    for values in (rng.normal(size=101), rng.integers(0, 5, 80).astype(float)):
        held = pd.DataFrame({S.USAGE: np.concatenate([values, np.full(gaps, np.nan)])})
        df = spark.createDataFrame(held)
        medians, fences = clean.learn_gaps_and_fences(df, [S.USAGE])
        filled = held[S.USAGE].fillna(held[S.USAGE].median())
        q1, q3 = filled.quantile([0.25, 0.75])
        assert medians[S.USAGE] == pytest.approx(held[S.USAGE].median())
        assert (fences[S.USAGE].low, fences[S.USAGE].high) == pytest.approx((q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1)))


def test_nothing_present_gives_no_median(spark):
    df = spark.range(5).selectExpr(f"cast(null as double) {S.USAGE}")
    assert clean.learn_gaps_and_fences(df, [S.USAGE]) == ({}, {})
