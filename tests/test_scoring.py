"""Scoring incomplete rows, missing scores, the silhouette over all rows, and work outside the repository."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.catalog import standins as P
from cohortix.operators import churn, curves
from cohortix.operators.cluster_scores import centroid_scores, squared_silhouettes
from cohortix.operators.score import Scorer, model_probability
from cohortix.session import sized

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def incomplete(spark):
    columns = (f"{S.ID} string, {S.USAGE} double, {S.REVENUE} double, {S.DOU} double, {S.PACK} int, "
               f"{S.TENURE} int, {S.CHURN} int")
    return spark.createDataFrame([
        ("whole", 10.0, 100.0, 20.0, 1, 900, 0), ("no_tenure", 10.0, 100.0, 20.0, 1, None, 0),
        ("no_usage", None, 100.0, 20.0, 1, 900, 0), ("young", 10.0, 100.0, 20.0, 1, 30, 0),
        ("nothing", None, None, None, None, None, None)], columns)


def scorer(model, like_training):
    return Scorer(P.PARAMS, P.MIXTURE, P.SEGMENT_OF_CLUSTER, 0.5, tuple(sorted(S.OFFERS)), model, like_training)


@pytest.mark.parametrize("like_training", [False, True])
def test_incomplete_rows_are_scored_as_far_as_they_go(incomplete, cleaned, like_training):
    table = churn.add_one_hot(P.with_standins(cleaned.table).drop("churn_probability"), list(S.OFFERS))
    fit = churn.train_churn_models(table, churn.feature_names(list(S.OFFERS)), names=["logistic_regression"])
    out = {r[S.ID]: r for r in scorer(model_probability(fit.best_model), like_training).score(incomplete).collect()}
    assert len(out) == 5
    assert out["whole"][S.SEGMENT] in S.OFFERS and out["whole"]["priority"] and out["whole"]["risk_band"]
    for name in ("no_tenure", "young", "nothing"):
        assert out[name][S.SEGMENT] == S.UNSEGMENTED[0] and out[name]["offer"] == S.UNSEGMENTED[1]
        assert out[name]["action"] == S.UNSEGMENTED[2] and out[name]["priority"] is None
    assert out["young"]["churn_probability"] is not None
    for name in ("no_tenure", "nothing"):
        assert out[name]["churn_probability"] is out[name]["churn_prediction"] is out[name]["risk_band"] is None
    assert (out["no_usage"][S.SEGMENT] in S.OFFERS) == like_training


@pytest.mark.parametrize("value", [None, float("nan")])
def test_missing_scores_fail_loudly(spark, value):
    table = spark.createDataFrame([(0.2, 0), (0.8, 1), (value, 1)], "p double, y int")
    for work in (lambda: curves.curve_summary(curves.score_ladder(table, "p", "y")).collect(),
                 lambda: curves.confusion(table, "p", "y", [0.5]).collect()):
        with pytest.raises(PySparkException, match="missing or NaN"):
            work()


def test_ladder_reads_the_scores_once(spark, tmp_path):
    spark.range(1_000).select((F.rand(3)).alias("p"), (F.col("id") % 2).alias("y")).write.parquet(str(tmp_path / "s"))
    table = spark.read.parquet(str(tmp_path / "s"))
    plan = curves.score_ladder(table, "p", "y")._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path) not in plan  # bounds, totals and windows come from the written scores


def test_squared_silhouette_equals_brute_force(spark):
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(120, 3)) + 1e4
    label = rnd.integers(0, 4, 120)
    label[0] = 9  # alone
    rows = [(*map(float, p), int(c)) for p, c in zip(x, label)]
    table = spark.createDataFrame(rows, "a double, b double, c double, k int")
    apart = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    values = []
    for i in range(120):
        own = (label == label[i]) & (np.arange(120) != i)
        if not own.any():
            values.append(0.0)
            continue
        inner = apart[i, own].mean()
        outer = min(apart[i, label == c].mean() for c in set(label.tolist()) if c != label[i])
        values.append((outer - inner) / max(inner, outer))
    assert squared_silhouettes(table, ["a", "b", "c"], ["k"])["k"] == pytest.approx(np.mean(values), abs=1e-7)
    mean = x.mean(axis=0)
    centre = {c: x[label == c].mean(axis=0) for c in set(label.tolist())}
    within = sum(((p - centre[c]) ** 2).sum() for p, c in zip(x, label.tolist()))
    between = sum((label == c).sum() * ((m - mean) ** 2).sum() for c, m in centre.items())
    want = between / (len(centre) - 1) / (within / (120 - len(centre)))
    assert centroid_scores(table, ["a", "b", "c"], ["k"])["k"]["calinski_harabasz"] == pytest.approx(want, rel=1e-9)


def test_partitions_follow_the_rows_alone(spark):
    table = spark.range(1_000).select(F.col("id").alias(S.ID), F.col("id").cast("double").alias("x"))
    for source in (table, table.repartition(7)):
        parts = sized(source, S.ID, 100)
        assert parts.rdd.getNumPartitions() == 10
        found = parts.groupBy(F.spark_partition_id()).agg(F.sum(S.ID)).collect()
        assert sorted(map(tuple, found)) == sorted(map(tuple, sized(table, S.ID, 100).groupBy(
            F.spark_partition_id()).agg(F.sum(S.ID)).collect()))


def test_python_code_reaches_executors_from_a_foreign_folder(tmp_path, sf_dir):
    """Worker processes find the package although neither their folder nor PYTHONPATH holds it."""
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys\nsys.path.insert(0, {REPO!r})\n"
        "from cohortix.catalog.queries import all_queries\nfrom cohortix.session import build_session\n"
        "spark = build_session('local[2]', **{'spark.sql.shuffle.partitions': '2', 'spark.ui.showConsoleProgress': 'false'})\n"
        f"print('value', all_queries()['silhouette_euclidean'](spark, {sf_dir!r}).first()[0])\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0 and "value " in done.stdout, done.stderr[-2_000:]
