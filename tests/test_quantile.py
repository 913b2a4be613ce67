import numpy as np
import pytest

from cohortix.functions.quantile import approx_quantiles, exact_quantiles

PROBS = [0.0, 0.005, 0.25, 0.5, 0.75, 0.995, 1.0]


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "x double")


@pytest.mark.parametrize("kind", ["spread", "hot", "two_hot", "constant", "few", "gaps"])
@pytest.mark.parametrize("k", [32, 32_768])
def test_equals_linear_interpolation(spark, kind, k):
    rng = np.random.default_rng(3)
    values = {
        "spread": rng.normal(size=700),
        "hot": np.concatenate([np.zeros(400), rng.normal(size=500)]),
        "two_hot": np.concatenate([np.zeros(300), np.ones(300), rng.random(200)]),
        "constant": np.full(90, 4.0),
        "few": np.array([3.0, 1.0, 2.0]),
        "gaps": np.concatenate([rng.random(60), [np.nan] * 30]),
    }[kind]
    rows = [None if np.isnan(v) else v for v in values]
    got = exact_quantiles(frame(spark, rows).repartition(5), {"x": PROBS}, k=k)["x"]
    want = np.quantile(values[~np.isnan(values)], PROBS)
    assert got == pytest.approx(list(want), rel=1e-12, abs=1e-12)


def test_many_columns_share_the_passes(spark):
    df = spark.range(1000).selectExpr("cast(id as double) a", "cast(id % 7 as double) b", "cast(null as double) c")
    got = exact_quantiles(df, {"a": [0.5, 0.25], "b": [0.5], "c": [0.5]}, k=20)
    assert got == {"a": [499.5, 249.75], "b": [3.0], "c": [None]}


def test_approximate_rank_error(spark):
    df = spark.range(10_000).selectExpr("cast(id as double) x")
    (value,) = approx_quantiles(df, {"x": [0.25]}, accuracy=100)["x"]
    assert abs(value - 2500) <= 100


def test_nan_and_infinity(spark):
    df = frame(spark, [1.0, float("nan"), float("inf"), -float("inf"), None, 2.0])
    assert exact_quantiles(df, {"x": [0.0, 0.5, 1.0]})["x"] == [-float("inf"), 1.5, float("inf")]


def test_no_rows(spark):
    assert exact_quantiles(frame(spark, [1.0]).where("false"), {"x": [0.5]}) == {"x": [None]}


def test_passes_over_the_rows(spark):
    """One read while the sketch holds all values, one more beyond."""
    df = spark.range(60_000).selectExpr("cast((id * 7919) % 60000 as double) x", "cast(id % 1000 as double) y").repartition(3).cache()
    df.count()
    rng = [0.25, 0.5, 0.995]
    for k, most in ((60_000, 1), (2_048, 2)):
        with pytest.MonkeyPatch.context() as patch:
            reads = []
            agg = type(df).agg
            patch.setattr(type(df), "agg", lambda self, *a: reads.append(1) or agg(self, *a))
            got = exact_quantiles(df, {"x": rng, "y": rng}, k=k)
        assert got["x"] == pytest.approx(list(np.quantile(np.arange(60_000), rng)))
        assert got["y"] == pytest.approx(list(np.quantile(np.arange(60_000) % 1000, rng)))
        assert len(reads) <= most
