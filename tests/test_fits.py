"""Boosting with patience, the checks of fitted models, and that labels without the rows' pattern fail them."""

import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.catalog import queries as Q
from cohortix.operators import churn, fit_checks
from cohortix.operators.churn import TreeSizes, chosen_round
from cohortix.session import held

SMALL = TreeSizes(forest_trees=20, forest_depth=8, forest_leaf=3, boost_rounds=30, boost_depth=3, boost_leaf=3, boost_bins=32,
                  forest_bins=32)


@pytest.mark.parametrize("losses, patience, want", [
    ([3, 2, 1], 2, (3, False)), ([3, 2, 2.5, 2.4, 1], 2, (2, True)), ([3, 2, 2.5, 1.9, 2, 2, 2], 3, (4, True)),
    ([1, 1, 1, 1], 3, (1, True)), ([1, 1 - 1e-9, 2, 2], 3, (1, True)), ([5], 10, (1, False))])
def test_chosen_round(losses, patience, want):
    assert chosen_round(losses, patience, 1e-7) == want


@pytest.fixture(scope="module")
def matrix(spark):
    """Rows whose label follows the features but for some noise."""
    x = [F.rand(i + 1).alias(c) for i, c in enumerate(S.CHURN_FEATURES)]
    table = spark.range(3000, numPartitions=3).select(F.col("id").alias(S.ID), *x)
    p = 0.8 * F.col(S.USAGE) + 0.2 * F.col(S.DOU) * F.col(S.PACK)
    return table.withColumn(S.CHURN, (p + 0.3 * F.rand(99) > 0.75).cast("int")).cache()


FEATURES = list(S.CHURN_FEATURES)


def test_boosting_keeps_the_rounds_up_to_the_lowest_loss(spark, matrix):
    with held(churn.training_table(matrix, FEATURES)) as train:
        boost = churn.candidates(3000, SMALL)["hist_gradient_boosting"]
        found = churn.fit_boosting(boost, train, SMALL)
        check = train.where(churn.VALIDATION)
        whole = boost.fit(train.where(~F.col(churn.VALIDATION)))
        every = whole.evaluateEachIteration(check)
        assert found.losses == pytest.approx(every[:len(found.losses)])  # a longer fit begins with the shorter one
        assert (found.rounds, True) == chosen_round(every, 10, 1e-7) or found.rounds == chosen_round(every, 10, 1e-7)[0]
        assert found.model.getNumTrees == found.rounds and list(found.model.treeWeights) == list(whole.treeWeights)[:found.rounds]
        assert found.model.evaluateEachIteration(check)[-1] == pytest.approx(every[found.rounds - 1])


def test_the_cut_ensemble_survives_saving(spark, matrix, tmp_path):
    with held(churn.training_table(matrix, FEATURES)) as train:
        model = churn.fit_boosting(churn.candidates(3000, SMALL)["hist_gradient_boosting"], train, SMALL).model
    whole = PipelineModel([churn.assembler(FEATURES, "keep"), model])
    whole.write().save(str(tmp_path / "model"))
    rows = [churn.with_probability(m, matrix).orderBy(S.ID).limit(20).collect() for m in (whole, PipelineModel.load(str(tmp_path / "model")))]
    assert rows[0] == rows[1] and sum(model.featureImportances.toArray()) == pytest.approx(1)


def test_all_rounds_without_validation_rows(spark, matrix):
    sizes = TreeSizes(boost_rounds=4, boost_depth=2, boost_bins=32, boost_validation=0.0)
    train = churn.training_table(matrix, FEATURES, validation=0.0)
    assert churn.fit_boosting(churn.candidates(3000, sizes)["hist_gradient_boosting"], train, sizes).model.getNumTrees == 4


@pytest.fixture(scope="module")
def fitted(matrix):
    return churn.train_churn_models(matrix, FEATURES, sizes=SMALL)


def test_facts_hold_for_the_labels_that_were_learnt(spark, matrix, fitted):
    rows = Q.fit_facts(spark, matrix, FEATURES, fitted)
    assert len(rows) == 3 and all(all(r[1:4]) for r in rows)


def test_shuffled_labels_break_the_facts(spark, matrix, fitted):
    """A model of other labels fits neither the rows it saw nor gives the same area."""
    other = matrix.withColumn(S.CHURN, (F.xxhash64(S.ID) % 100 < 30).cast("int"))
    for name, learnt, same_area, *_ in Q.fit_facts(spark, other, FEATURES, fitted):
        assert not learnt and not same_area, name


def test_nodes_repeat_the_ensembles(spark, matrix, fitted):
    for name in ("random_forest", "hist_gradient_boosting"):
        model = fitted.models[name]
        nodes = fit_checks.node_table(spark, model)
        assert Q._repeated(spark, model, nodes, FEATURES, matrix)
        assert not Q._repeated(spark, model, nodes.withColumn("threshold", F.col("threshold") + 0.05), FEATURES, matrix)


def test_importances_from_the_nodes(spark, fitted):
    model = fitted.models["random_forest"]
    found = fit_checks.importances(fit_checks.node_table(spark, model), len(FEATURES))
    assert found == pytest.approx(model.featureImportances.toArray())


def test_folds_are_recomputed_from_rows_not_seen(spark, matrix, tmp_path):
    path = str(tmp_path / "cv")
    folds = {r["fold"]: r for r in churn.cross_validate(matrix, FEATURES, "random_forest", sizes=SMALL, scores=path).collect()}
    rows = Q.fold_facts(spark, path, folds, matrix.select(S.ID, S.CHURN))
    assert sum(r[1] for r in rows) == 3000 and all(all(r[3:]) for r in rows)
    wrong = matrix.select(S.ID, (F.xxhash64(S.ID) % 100 < 30).cast("int").alias(S.CHURN))
    assert not any(r[3] or r[5] for r in Q.fold_facts(spark, path, folds, wrong))


def test_cross_validation_takes_every_row(spark, tmp_path):
    """As many rows as there are, each once by a model that did not see it and in all other folds by one that did."""
    n, path = 61_000, str(tmp_path / "cv")
    table = spark.range(n, numPartitions=4).select(F.col("id").alias(S.ID), F.rand(1).alias(S.USAGE), (F.rand(2) < 0.3).cast("int").alias(S.CHURN))
    quick = TreeSizes(forest_trees=1, forest_depth=2, forest_bins=8)
    folds = churn.cross_validate(table, [S.USAGE], "random_forest", sizes=quick, scores=path)
    assert sorted(r["fold"] for r in folds.collect()) == [0, 1, 2, 3, 4]
    for part, times in (("unseen", 1), ("seen", 4)):
        found = spark.read.parquet(f"{path}/{part}/*").groupBy(S.ID).count()
        assert (found.count(), found.where(F.col("count") != times).count()) == (n, 0)


@pytest.mark.parametrize("rows, most", [(1000, 3), (3000, 1)])
def test_folds_of_large_tables_are_fitted_one_by_one(matrix, monkeypatch, rows, most):
    """Side by side the trees of all folds would fill the memory."""
    now, seen, lock, fit = [], [], threading.Lock(), churn.fit_candidate

    def watched(*a):
        with lock:
            now.append(1)
            seen.append(len(now))
        try:
            return fit(*a)
        finally:
            with lock:
                now.pop()

    monkeypatch.setattr(churn, "FOLD_ROWS", 3000)
    monkeypatch.setattr(churn, "fit_candidate", watched)
    quick = TreeSizes(forest_trees=1, forest_depth=2, forest_bins=8)
    assert churn.cross_validate(matrix.where(F.col(S.ID) < rows), FEATURES, "random_forest", sizes=quick).count() == 5
    assert len(seen) == 5 and max(seen) <= most


def test_too_many_levels_are_refused(spark):
    wide = spark.range(5000).select(F.col("id").cast("string").alias(S.SEGMENT), F.col("id").alias(S.CHURN))
    with pytest.raises(ValueError, match="segment"):
        churn.segment_levels(wide)
    with pytest.raises(ValueError, match="churn"):
        churn.class_sizes(wide)


def test_tree_fits_have_a_bounded_number_of_tasks(spark, matrix, monkeypatch):
    """Each task sends the statistics of all nodes, so their number must not grow with the rows."""
    seen = []

    def fit(estimator, train, sizes):
        seen.append((train.rdd.getNumPartitions(), train.count()))
        return churn.without_summary(estimator.fit(train))

    monkeypatch.setattr(churn, "TREE_ROWS_PER_TASK", 10)
    monkeypatch.setattr(churn, "fit_candidate", fit)
    churn.train_churn_models(matrix, FEATURES, sizes=SMALL, names=["random_forest"])
    assert seen == [(churn.TREE_TASKS, 2400)]
