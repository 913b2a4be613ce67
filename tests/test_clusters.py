import numpy as np
import pandas as pd
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler

from cohortix import schema as S
from cohortix.operators import clean, kmeans, mixture, profile
from cohortix.operators import cluster_scores as cluster_scores_module
from cohortix.operators.cluster_scores import centroid_scores, cluster_scores, silhouettes, squared_silhouettes
from cohortix.operators.mixture import Mixture
from cohortix.session import frame_of, held

FEATURES = ("x", "y")


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    centres = np.array([[0, 0], [4, 0], [0, 5]])
    label = rng.choice(3, 400, p=[0.6, 0.3, 0.1])
    points = centres[label] + rng.normal(size=(400, 2)) * [0.7, 1.1]
    rows = [(i, float(a), float(b), int(c)) for i, ((a, b), c) in enumerate(zip(points, label))]
    return points, label, spark.createDataFrame(rows, "customer_id long, x double, y double, label int").cache()


def dense_log_density(points, m):
    out = []
    for w, mean, var in zip(m.weights, m.means, m.variances):
        mean, var = np.array(mean), np.array(var)
        out.append(np.log(w) - 0.5 * (np.log(2 * np.pi * var).sum() + ((points - mean) ** 2 / var).sum(axis=1)))
    return np.array(out).T


START = Mixture(FEATURES, (0.5, 0.3, 0.2), ((0.5, 0.0), (3.0, 1.0), (0.0, 4.0)), ((1.0, 1.0), (2.0, 1.0), (1.0, 2.0)))


def test_soft_assignment_equals_numpy(blobs):
    points, _, df = blobs
    joint = dense_log_density(points, START)
    top = joint.max(axis=1, keepdims=True)
    total = top[:, 0] + np.log(np.exp(joint - top).sum(axis=1))
    share = np.exp(joint - total[:, None])
    order = np.argsort(-joint, axis=1)
    rows = np.arange(len(points))
    for r in mixture.soft_assign(df, START).collect():
        i = r["customer_id"]
        assert (r["cluster_id"], r["runner_up_id"]) == (order[i, 0], order[i, 1])
        assert r["confidence"] == pytest.approx(share[i, order[i, 0]])
        assert r["runner_up_confidence"] == pytest.approx(share[i, order[i, 1]])
        assert r["probabilities"] == pytest.approx(list(share[i]))
        assert r["log_density"] == pytest.approx(total[i])
    assert len(rows) == 400


def test_far_away_rows_do_not_underflow(spark):
    df = frame_of(spark, [(1e4, -1e4)], "x double, y double")
    row = mixture.soft_assign(df, START).first()
    assert row["confidence"] == pytest.approx(1.0) and np.isfinite(row["log_density"])


def test_filter_on_the_result_stays_above_the_densities(blobs):
    _, _, df = blobs
    plan = mixture.soft_assign(df, START).where("confidence < 0.9")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate")


def test_em_step_equals_numpy(blobs):
    points, _, df = blobs
    after, mean_ll = mixture.em_step(df, START, 1e-5)
    joint = dense_log_density(points, START)
    total = np.log(np.exp(joint).sum(axis=1))
    r = np.exp(joint - total[:, None])
    n = r.sum(axis=0)
    means = (r.T @ points) / n[:, None]
    var = (r.T @ points ** 2) / n[:, None] - means ** 2 + 1e-5
    assert mean_ll == pytest.approx(total.mean())
    assert np.allclose(after.weights, n / n.sum())
    assert np.allclose(after.means, means) and np.allclose(after.variances, var)


def test_fit_keeps_the_best_start_and_does_not_fall(blobs):
    _, _, df = blobs
    poor = Mixture(FEATURES, (0.4, 0.3, 0.3), ((9.0, 9.0), (9.1, 9.0), (9.0, 9.1)), ((1.0, 1.0),) * 3)
    _, first = mixture.em_step(df, START)
    fit = mixture.fit_mixture(df, [poor, START])
    alone = mixture.fit_mixture(df, [START])
    assert fit.mean_log_density >= alone.mean_log_density - 1e-12 > first
    assert fit.converged or fit.iterations == mixture.MAX_ITERATIONS
    assert sum(fit.mixture.weights) == pytest.approx(1.0)


def test_constant_column_is_held_by_the_regulariser(spark):
    df = spark.range(50).selectExpr("cast(id as double) x", "1d y")
    after, _ = mixture.em_step(df, Mixture(FEATURES, (0.5, 0.5), ((0.0, 1.0), (40.0, 1.0)), ((9.0, 1.0),) * 2))
    assert [v[1] for v in after.variances] == pytest.approx([1e-5, 1e-5], rel=1e-3)


def test_mixture_survives_json():
    assert Mixture.from_json(START.to_json()) == START
    assert Mixture(FEATURES, (1 / 6,) * 6, ((0.0,) * 4,) * 6, ((1.0,) * 4,) * 6).k == 6


def test_scores_equal_brute_force(blobs):
    points, label, df = blobs
    got = cluster_scores(df, FEATURES, ["label"]).first()
    apart = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    s = []
    for i in range(len(points)):
        own = (label == label[i]).sum() - 1
        a = apart[i][label == label[i]].sum() / own
        b = min(apart[i][label == c].mean() for c in set(label) - {label[i]})
        s.append((b - a) / max(a, b))
    assert got["silhouette"] == pytest.approx(np.mean(s))
    centre = np.array([points[label == c].mean(axis=0) for c in range(3)])
    spread = [np.sqrt(((points[label == c] - centre[c]) ** 2).sum(axis=1)).mean() for c in range(3)]
    worst = [max((spread[i] + spread[j]) / np.sqrt(((centre[i] - centre[j]) ** 2).sum())
                 for j in range(3) if j != i) for i in range(3)]
    assert got["davies_bouldin"] == pytest.approx(np.mean(worst))
    sizes = np.array([(label == c).sum() for c in range(3)])
    between = (sizes * ((centre - points.mean(axis=0)) ** 2).sum(axis=1)).sum()
    within = sum(((points[label == c] - centre[c]) ** 2).sum() for c in range(3))
    assert got["calinski_harabasz"] == pytest.approx((between / 2) / (within / 397))


def test_one_row_cluster_scores_zero(spark):
    df = frame_of(spark, [(0.0, 0.0, 0), (0.0, 1.0, 0), (5.0, 5.0, 1)], "x double, y double, label int")
    d = np.sqrt(50), np.sqrt(41)
    want = ((1 - 1 / d[0]) + (1 - 1 / d[1]) + 0.0) / 3
    assert silhouettes(df, FEATURES, ["label"])["label"] == pytest.approx(want)


def test_silhouette_refuses_an_unbounded_table(spark):
    df = spark.range(30).selectExpr("cast(id as double) x", "0d y", "cast(id % 2 as int) label")
    with pytest.raises(ValueError):
        silhouettes(df, FEATURES, ["label"], limit=20)


SWEEP = ((2, 407799.89526960533), (3, 284034.7532484544), (4, 211626.2445127903), (5, 171154.5684153659),
         (6, 141287.18053732312), (7, 118191.94134380718), (8, 102872.5679848091), (9, 93412.49178434303),
         (10, 87654.77237715853))


@pytest.mark.parametrize("sweep, k", [
    (SWEEP, 5), (tuple(zip(range(2, 11), (100.0, 55.0, 30.0, 24.0, 21.0, 19.0, 18.0, 17.0, 16.0))), 4)])
def test_elbow_of_published_curves(spark, sweep, k):
    assert profile.elbow_k(frame_of(spark, sweep, "k int, inertia double")).first()[0] == k


def test_segments_follow_the_revenue_rank(cleaned):
    z = clean.standardise(cleaned.table, cleaned.params.means, cleaned.params.stds)
    features = [clean.scaled_name(c) for c in S.CLUSTER_FEATURES]
    with held(z) as rows:
        model = kmeans.fit_kmeans(rows, features, n=2)
        labelled = kmeans.nearest_centroid(rows, features, model.centres, "cluster")
        prof = profile.cluster_profile(labelled, "cluster").orderBy("revenue_rank").collect()
    assert [r[S.SEGMENT] for r in prof] == [S.SEGMENT_BY_RANK[i] for i in range(1, 7)]
    revenue = [r[S.REVENUE] for r in prof]
    assert revenue == sorted(revenue, reverse=True)
    assert sum(r["n_customers"] for r in prof) == z.count()


def test_cost_and_sizes_are_those_of_the_nearest_centres(blobs):
    _, _, df = blobs
    model = kmeans.fit_kmeans(df, FEATURES, k=3, n=2)
    placed = kmeans.nearest_centroid(df, FEATURES, model.centres)
    assert placed.selectExpr("sum(squared_distance)").first()[0] == pytest.approx(model.inertia)
    assert tuple(r[1] for r in sorted(placed.groupBy("cluster_id").count().collect())) == model.sizes


def test_restarts_match_a_library_fit(blobs):
    """Spark's own K-Means from many seeds finds no lower cost."""
    _, _, df = blobs
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)
    theirs = min(KMeans(k=4, seed=s, maxIter=200, tol=1e-6).fit(vectors).summary.trainingCost for s in range(5))
    assert kmeans.fit_kmeans(df, FEATURES, k=4).inertia <= theirs * 1.001


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(scale=6, size=(6, 2))
    label = rng.choice(6, 20_000, p=[0.5, 0.3, 0.1, 0.06, 0.03, 0.01])
    points = centres[label] + rng.standard_t(4, size=(20_000, 2))
    rows = pd.DataFrame({"customer_id": np.arange(len(points)), "x": points[:, 0], "y": points[:, 1]})
    return points, spark.createDataFrame(rows).repartition(4).cache()


def test_coreset_estimates_the_cost_of_any_centres(many):
    points, df = many
    core = kmeans.coreset(df, FEATURES, rows=2_000)
    assert 1_800 < len(core.points) < 2_200 and core.weights.sum() == pytest.approx(len(points), rel=0.1)
    rng = np.random.default_rng(1)
    for k in (1, 3, 8):
        centres = rng.normal(scale=6, size=(k, 2))
        whole = kmeans.squared_distances(points, centres).min(axis=1).sum()
        drawn = (core.weights * kmeans.squared_distances(core.points, centres).min(axis=1)).sum()
        assert drawn == pytest.approx(whole, rel=0.1)
    again = kmeans.coreset(df.repartition(7), FEATURES, rows=2_000)
    assert (again.points == core.points).all() and again.weights == pytest.approx(core.weights)


def test_small_table_is_its_own_coreset(blobs):
    points, _, df = blobs
    core = kmeans.coreset(df, FEATURES, rows=800)
    assert len(core.points) == 400 and (core.weights == 1).all()


def test_fit_from_the_coreset_is_within_one_per_cent_of_all_rows(many):
    _, df = many
    small = kmeans.fit_kmeans(df, FEATURES, k=6, n=4, core=kmeans.coreset(df, FEATURES, rows=1_000))
    whole = kmeans.fit_kmeans(df, FEATURES, k=6, n=4, core=kmeans.coreset(df, FEATURES, rows=80_000))
    assert small.inertia <= 1.01 * whole.inertia and sum(small.sizes) == 20_000


def test_more_centres_than_points(spark):
    df = frame_of(spark, [(1, 0.0, 0.0), (2, 0.0, 0.0), (3, 1.0, 1.0)], "customer_id long, x double, y double")
    fit = kmeans.fit_kmeans(df, FEATURES, k=3, n=1)
    assert fit.inertia == 0 and sum(fit.sizes) == 3
    with pytest.raises(ValueError):
        kmeans.fit_kmeans(df.where("false"), FEATURES, k=2, n=1)


def test_missing_feature_is_an_error(spark):
    df = frame_of(spark, [(1, 0.0, 0.0), (2, None, 0.0)], "customer_id long, x double, y double")
    with pytest.raises(Exception, match="feature is missing"):
        kmeans.fit_kmeans(df, FEATURES, k=1, n=1)


def test_mixture_settled_on_the_coreset_first(many):
    points, df = many
    starts = mixture.hard_starts(df, FEATURES, [np.array([[0.0, 0.0], [5.0, 5.0], [-5.0, 3.0]]), points[:3]], 1e-5)
    plain = mixture.fit_mixture(df, starts)
    quick = mixture.fit_mixture(df, starts, core=kmeans.coreset(df, FEATURES, rows=4_000))
    assert quick.mean_log_density >= plain.mean_log_density - 0.01 and quick.iterations < plain.iterations
    _, again = mixture.em_step(df, quick.mixture)
    assert again >= quick.mean_log_density - 1e-9


def test_all_starts_share_one_scan(blobs, spark):
    points, _, df = blobs
    centres = [points[:3], points[3:6]]
    before = mixture.hard_starts(df, FEATURES, centres, 1e-5)
    for found, c in zip(before, centres):
        label = kmeans.squared_distances(points, c).argmin(axis=1)
        assert np.allclose(found.means, [points[label == j].mean(axis=0) for j in range(3)])
        assert np.allclose(found.weights, [np.mean(label == j) for j in range(3)])


def test_unnamed_cluster_is_an_error(spark):
    prof = frame_of(spark, [(0, "Loyal Core"), (7, None)], "cluster int, segment string")
    with pytest.raises(ValueError):
        profile.cluster_names(prof, "cluster")


def test_many_clusters(spark, monkeypatch):
    """More clusters than a broadcast and than a block, one of them with a third of the rows."""
    monkeypatch.setattr(cluster_scores_module, "CLUSTER_BLOCK", 40)
    monkeypatch.setattr(cluster_scores_module, "BROADCAST_ROWS", 30)
    rng = np.random.default_rng(4)
    label = np.concatenate([rng.integers(0, 150, 600), np.full(300, 7)])
    points = rng.normal(size=(150, 2))[label] * 5 + rng.normal(size=(900, 2))
    df = spark.createDataFrame(pd.DataFrame({"x": points[:, 0], "y": points[:, 1], "label": label}))
    names, n = np.unique(label, return_counts=True)
    centre = np.array([points[label == c].mean(axis=0) for c in names])
    spread = np.array([np.sqrt(((points[label == c] - m) ** 2).sum(axis=1)).mean() for c, m in zip(names, centre)])
    apart = np.sqrt(((centre[:, None] - centre[None]) ** 2).sum(axis=2))
    ratio = np.divide(spread[:, None] + spread, apart, out=np.zeros_like(apart), where=apart > 0)
    within = sum(((points[label == c] - m) ** 2).sum() for c, m in zip(names, centre))
    between = (n * ((centre - points.mean(axis=0)) ** 2).sum(axis=1)).sum()
    got = centroid_scores(df, FEATURES, ["label"])["label"]
    assert got["n_clusters"] == len(names) and got["davies_bouldin"] == pytest.approx(ratio.max(axis=1).mean())
    assert got["calinski_harabasz"] == pytest.approx(between / (len(names) - 1) / (within / (900 - len(names))))
    squared = ((points[:, None] - points[None]) ** 2).sum(axis=2)
    s = []
    for i in range(900):
        mean = {c: squared[i][label == c].mean() for c in names}
        own = (label == label[i]).sum()
        inner, outer = mean.pop(label[i]) * own / max(own - 1, 1), min(mean.values())
        s.append((outer - inner) / max(inner, outer) if own > 1 else 0.0)
    assert squared_silhouettes(df, FEATURES, ["label"])["label"] == pytest.approx(np.mean(s))


def test_fifty_thousand_clusters(spark):
    df = spark.range(100_000).selectExpr("cast(id % 50000 as int) label", "cast(id % 50000 as double) x", "cast(floor(id / 50000) as double) y")
    got = centroid_scores(df, FEATURES, ["label"])["label"]
    assert got["n_clusters"] == 50_000 and got["davies_bouldin"] == pytest.approx(1.0)  # spreads of a half, centres one apart
