import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortix.functions.running import running_totals
from cohortix.operators import curves
from cohortix.session import frame_of


def scored(spark, p, y, revenue=None):
    revenue = revenue if revenue is not None else [1.0] * len(p)
    rows = [(float(a), int(b), float(c)) for a, b, c in zip(p, y, revenue)]
    return spark.createDataFrame(rows, "p double, y int, revenue double")


@pytest.fixture(scope="module")
def noisy(spark):
    """Every third score is the same value."""
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 1500)
    p = np.round(np.clip(y * 0.35 + rng.normal(0.35, 0.2, 1500), 0, 1), 3)
    p[::3] = 0.5
    return p, y, scored(spark, p, y, rng.random(1500) * 100)


def brute_auc(p, y):
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


def brute_curve(p, y):
    out = []
    for t in sorted(set(p)):
        flagged = p >= t
        tp = (flagged & (y == 1)).sum()
        out.append((t, tp / flagged.sum(), tp / (y == 1).sum()))
    return out


def test_running_totals_do_not_depend_on_the_slices(spark):
    df = spark.range(500).selectExpr("cast(id * 37 % 500 as double) s", "id % 5 v")
    whole = running_totals(df, "s", ["v"], [], heads=["v"])
    cut = running_totals(df, "s", ["v"], [3.0, 100.5, 250.0, 499.0], heads=["v"])
    key = lambda r: r["s"]
    assert sorted(whole.collect(), key=key) == sorted(cut.collect(), key=key)


def test_areas_and_threshold_equal_brute_force(noisy):
    p, y, df = noisy
    got = curves.curve_summary(curves.score_ladder(df, "p", "y")).first()
    assert got["roc_auc"] == pytest.approx(brute_auc(p, y))
    points = brute_curve(p, y)
    ap, above = 0.0, 0.0
    for _, precision, recall in reversed(points):
        ap += (recall - above) * precision
        above = recall
    assert got["average_precision"] == pytest.approx(ap)
    f1 = [2 * a * b / (a + b + 1e-12) if a + b else 0.0 for _, a, b in points]
    assert got["best_threshold"] == points[int(np.argmax(f1))][0]


def test_pr_curve_points(noisy):
    p, y, df = noisy
    got = curves.pr_curve(curves.score_ladder(df, "p", "y")).orderBy("position").collect()
    want = brute_curve(p, y)
    assert [r["position"] for r in got] == list(range(len(want)))
    assert np.allclose([(r["threshold"], r["precision"], r["recall"]) for r in got], want)


def test_roc_leaves_out_only_points_on_a_line(noisy):
    p, y, df = noisy
    got = curves.roc_points(curves.score_ladder(df, "p", "y")).orderBy(F.col("threshold").desc()).collect()
    fpr, tpr = np.array([r["fpr"] for r in got]), np.array([r["tpr"] for r in got])
    assert (fpr[0], tpr[0], fpr[-1], tpr[-1]) == (0, 0, 1, 1)
    assert np.trapezoid(tpr, fpr) == pytest.approx(brute_auc(p, y))


def test_threshold_extremes(spark):
    df = scored(spark, [0.1, 0.4, 0.6, 0.9], [0, 0, 1, 1])
    low, high = curves.metric_suite(df, "p", "y", [0.0, 1.01]).orderBy("threshold").collect()
    assert low["recall"] == 1.0 and low["tn"] == 0
    assert high["recall"] == 0.0 and high["tp"] == 0 and high["accuracy"] == 0.5


def test_one_class_only(spark):
    row = curves.metric_suite(scored(spark, [0.2, 0.7], [0, 0]), "p", "y", [0.5]).first()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (0, 1, 0, 1)
    assert row["recall"] == 0.0 and row["mcc"] == 0.0 and row["roc_auc"] is None


def test_tuned_f1_is_not_below_the_default(noisy):
    _, _, df = noisy
    best = curves.curve_summary(curves.score_ladder(df, "p", "y")).first()["best_threshold"]
    rows = curves.metric_suite(df, "p", "y", [0.5, best]).collect()
    f1 = {r["threshold"]: r["f1"] for r in rows}
    assert f1[best] >= f1[0.5] - 1e-9
    assert all(r["tp"] + r["fp"] + r["fn"] + r["tn"] == 1500 for r in rows)


def test_published_matrix_gives_the_published_rates(spark):
    cells = frame_of(spark, [(8620, 8275, 2646, 19587)], "tp long, fp long, fn long, tn long")
    row = curves.with_metrics(cells).first()
    want = {"accuracy": 0.7209, "balanced_accuracy": 0.7341, "precision": 0.5102, "recall": 0.7651,
            "specificity": 0.7030, "f1": 0.6122, "mcc": 0.4279, "cohen_kappa": 0.4075}
    assert {c: round(row[c], 4) for c in want} == want


def test_grid_equals_a_loop_over_thresholds(noisy):
    p, y, df = noisy
    revenue = np.array([r["revenue"] for r in df.select("revenue").collect()])
    got = {round(r["t"], 2): r for r in curves.threshold_grid(df, "p", "y", "revenue").collect()}
    assert len(got) == 99
    for t in np.arange(0.01, 1.00, 0.01):
        flagged = p >= t
        row = got[round(float(t), 2)]
        assert row["tp"] == (flagged & (y == 1)).sum() and row["fp"] == (flagged & (y == 0)).sum()
        assert row["fn"] + row["tp"] == (y == 1).sum() and row["contacted"] == flagged.sum()
        assert row["rev_saved_ceiling"] == pytest.approx(revenue[flagged & (y == 1)].sum(), abs=0.51)


def test_grid_cell_is_exact_at_the_grid_points(spark):
    grid = np.arange(0.01, 1.00, 0.01)
    probes = sorted({0.0, 1.0, *grid, *np.nextafter(grid, 0), *np.nextafter(grid, 1), *np.round(grid, 2)})
    df = spark.createDataFrame([(float(v),) for v in probes], "p double")
    for r in df.select("p", curves.grid_cell(F.col("p")).alias("cell")).collect():
        assert r["cell"] == (grid <= r["p"]).sum()


def test_multiclass_numbers(spark):
    pairs = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "b")] * 3 + [("c", "a")]
    df = spark.createDataFrame(pairs, "actual string, predicted string")
    counts = curves.class_counts(df, "actual", "predicted")
    report = {r["label"]: r for r in curves.per_class_report(counts).collect()}
    assert report["a"]["precision"] == pytest.approx(5 / 6) and report["a"]["recall"] == pytest.approx(5 / 7)
    assert report["c"]["recall"] == 0.0 and report["c"]["precision"] == 0.0
    total = curves.multiclass_summary(counts).first()
    assert total["accuracy"] == pytest.approx(8 / 11)
    chance = (7 * 6 + 3 * 5 + 1 * 0) / 121
    assert total["cohen_kappa"] == pytest.approx((8 / 11 - chance) / (1 - chance))
    dense = curves.confusion_matrix(counts, ["a", "b", "c"]).collect()
    assert [tuple(r) for r in dense] == [("a", 5, 2, 0), ("b", 0, 3, 0), ("c", 1, 0, 0)]
