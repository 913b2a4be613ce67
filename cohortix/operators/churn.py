"""Churn classifier and segment surrogate: features, candidates, selection, validation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import SparkContext
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.operators.curves import (
    class_counts,
    confusion,
    curve_summary,
    score_ladder,
    with_metrics,
)
from cohortix.operators.kmeans import overlapped
from cohortix.operators.sample import stratified_folds, stratified_split
from cohortix.session import frame_of, held, prepare_checkpoints, sized

WEIGHT = "class_weight"
VECTOR = "churn_features"
PROBABILITY = "churn_probability"
VALIDATION = "is_validation"
TREE_ROWS_PER_TASK = 2_000
# In every pass of a tree fit each task sends the statistics of all nodes of the pass, as many as its rows may be:
# beyond so many tasks their rows grow instead.
TREE_TASKS = 24
# Folds are fitted side by side as long as their tables have no more rows together: beyond, one fit fills the
# cluster, and the trees of several would fill the memory.
FOLD_ROWS = 300_000
MOST_LEVELS = 1_000
# Boosting is fitted for so many rounds first, then for twice as many while its patience lasts.
FIRST_ROUNDS = 25


@dataclass(frozen=True)
class TreeSizes:
    """Sizes of the tree ensembles; the defaults are the fixed production values."""

    forest_trees: int = 120
    forest_depth: int = 13
    forest_leaf: int = 25
    boost_rounds: int = 200
    boost_depth: int = 6
    boost_rate: float = 0.08
    boost_leaf: int = 20
    surrogate_trees: int = 100
    surrogate_depth: int = 16
    surrogate_leaf: int = 10
    forest_bins: int = 255
    boost_bins: int = 255
    # Share of the training rows on which boosting decides when to stop; 0 runs all rounds.
    boost_validation: float = 0.1
    # Boosting stops after so many rounds without a lower validation loss and keeps those up to the lowest.
    boost_patience: int = 10
    boost_tolerance: float = 1e-7
    # Statistics one task may hold per pass: deep levels need fewer passes over the rows.
    memory_mb: int = 512
    seed: int = S.SEED


def dealt(df: DataFrame) -> DataFrame:
    """The rows of a tree fit, dealt to at most ``TREE_TASKS`` partitions."""
    return sized(df, S.ID, TREE_ROWS_PER_TASK, TREE_TASKS)


# ---- features ---------------------------------------------------------------
def one_hot_name(segment: str) -> str:
    return f"seg_{segment}"


def feature_names(segments: Sequence[str]) -> list[str]:
    """Stored feature order: numeric columns, then one column per segment by name."""
    return [*S.CHURN_FEATURES, *[one_hot_name(s) for s in sorted(segments)]]


def add_one_hot(df: DataFrame, segments: Sequence[str]) -> DataFrame:
    """One 0/1 column per stored segment; an unseen segment is all zeros."""
    return df.withColumns({
        one_hot_name(s): F.coalesce(F.col(S.SEGMENT) == s, F.lit(False)).cast("int")
        for s in sorted(segments)
    })


def _few(df: DataFrame, what: str) -> list:
    """The rows of a table of distinct values; more than ``MOST_LEVELS`` mean a wrong column."""
    rows = df.limit(MOST_LEVELS + 1).collect()
    if len(rows) > MOST_LEVELS:
        raise ValueError(f"more than {MOST_LEVELS} different values of {what}")
    return rows


def segment_levels(df: DataFrame) -> list[str]:
    return sorted(r[0] for r in _few(df.select(S.SEGMENT).distinct(), S.SEGMENT))


def class_sizes(df: DataFrame) -> dict[int, int]:
    return {r[0]: r[1] for r in _few(df.groupBy(S.CHURN).agg(F.count(F.lit(1))), S.CHURN)}


def balanced_weight(sizes: dict[int, int]) -> Column:
    """n / (classes * n_class)."""
    total = sum(sizes.values())
    out = F.lit(1.0)
    for label, n in sorted(sizes.items()):
        out = F.when(F.col(S.CHURN) == label, F.lit(total / (len(sizes) * n))).otherwise(out)
    return out


def probability(vector: str = "probability") -> Column:
    return vector_to_array(vector)[1]


# ---- candidates -------------------------------------------------------------
def candidates(rows: int, sizes: TreeSizes) -> dict[str, object]:
    """The three estimators by name, in the order that wins a tie."""
    common = dict(featuresCol=VECTOR, labelCol=S.CHURN)
    boost = GBTClassifier(
        maxIter=sizes.boost_rounds, maxDepth=sizes.boost_depth, stepSize=sizes.boost_rate,
        maxBins=sizes.boost_bins, minInstancesPerNode=sizes.boost_leaf, maxMemoryInMB=sizes.memory_mb,
        seed=sizes.seed, **common)
    return {
        "logistic_regression": LogisticRegression(
            weightCol=WEIGHT, maxIter=2000, regParam=1.0 / rows, **common),
        "random_forest": RandomForestClassifier(
            numTrees=sizes.forest_trees, maxDepth=sizes.forest_depth,
            minInstancesPerNode=sizes.forest_leaf, maxBins=sizes.forest_bins, maxMemoryInMB=sizes.memory_mb,
            featureSubsetStrategy="sqrt", weightCol=WEIGHT, seed=sizes.seed, **common),
        "hist_gradient_boosting": boost,
    }


def chosen_round(losses: Sequence[float], patience: int, tolerance: float) -> tuple[int, bool]:
    """Number of rounds up to the lowest loss that ``patience`` allows to see, and whether it ran out."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best] - tolerance:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


@dataclass(frozen=True)
class Boosting:
    """The kept ensemble, and the validation loss after every fitted round."""

    model: GBTClassificationModel
    losses: list[float]
    rounds: int


def fit_boosting(boost: GBTClassifier, train: DataFrame, sizes: TreeSizes) -> Boosting:
    """Boosting on the rows not marked for validation, which then choose the number of rounds.

    Rounds are seeded and do not depend on later ones, so a longer fit begins with the
    rounds of a shorter one: rounds are doubled until the patience runs out.
    """
    if not sizes.boost_validation:
        return Boosting(boost.fit(train), [], sizes.boost_rounds)
    inner, check = train.where(~F.col(VALIDATION)), train.where(VALIDATION)
    rounds = min(FIRST_ROUNDS, sizes.boost_rounds)
    while True:
        model = boost.copy({boost.maxIter: rounds}).fit(inner)
        losses = model.evaluateEachIteration(check)
        kept, out = chosen_round(losses, sizes.boost_patience, sizes.boost_tolerance)
        if out or rounds >= sizes.boost_rounds:
            return Boosting(first_trees(model, kept), losses, kept)
        rounds = min(2 * rounds, sizes.boost_rounds)


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The ensemble of the first ``n`` trees."""
    whole, context = model._java_obj, SparkContext._active_spark_context
    trees, weights = whole.trees(), whole.treeWeights()
    kept = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    shares = context._gateway.new_array(context._jvm.double, n)
    for i in range(n):
        kept[i], shares[i] = trees[i], weights[i]
    cut = context._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        whole.uid(), kept, shares, whole.numFeatures(), whole.numClasses())
    return GBTClassificationModel(cut.copy(whole.extractParamMap()))


def without_summary(model: Model) -> Model:
    """Drop the training summary, which holds the session and the training rows, from a model or pipeline.

    Spark sends a model with its summary to the tasks that apply it.
    """
    for part in getattr(model, "stages", [model]):
        if getattr(part, "hasSummary", False):
            part._java_obj.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())
    return model


def fit_candidate(estimator: Estimator, train: DataFrame, sizes: TreeSizes) -> Model:
    if isinstance(estimator, GBTClassifier):
        return fit_boosting(estimator, train, sizes).model
    return without_summary(estimator.fit(train))


def assembler(features: Sequence[str], invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid=invalid)


def training_table(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (),
                   validation: float = TreeSizes.boost_validation) -> DataFrame:
    """Id, label, class weight, the rows for early stopping, the feature vector, ``keep``."""
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit("stop:"), F.col(S.ID).cast("string"))), 1, 8), 16, 10)
    return assembler(features).transform(df).select(
        S.ID, S.CHURN, balanced_weight(class_sizes(df)).alias(WEIGHT),
        (bucket.cast("long") / float(1 << 32) < validation).alias(VALIDATION), VECTOR, *keep)


def with_probability(model: Model, df: DataFrame) -> DataFrame:
    """Add the churn probability; a row that lacks an input of a whole pipeline gets null."""
    found = probability()
    if isinstance(model, PipelineModel):
        inputs = [F.col(c).cast("double") for c in model.stages[0].getInputCols()]
        lacking = F.lit(False)
        for c in inputs:
            lacking = lacking | c.isNull() | F.isnan(c)
        found = F.when(~lacking, found)
    return model.transform(df).withColumn(PROBABILITY, found).drop(
        "rawPrediction", "probability", "prediction", VECTOR)


@dataclass(frozen=True)
class ChurnFit:
    best_name: str
    best_model: PipelineModel
    features: list[str]
    comparison: list[dict]
    threshold: float
    scored_test: DataFrame
    models: dict[str, Model] = field(default_factory=dict)


def train_churn_models(
    df: DataFrame, features: Sequence[str], *, sizes: TreeSizes = TreeSizes(),
    names: Sequence[str] | None = None, seed: int = S.SEED,
) -> ChurnFit:
    """Fit every candidate on the training rows; the best area on the test rows wins.

    ``df`` holds the feature columns, the label, and revenue; it is split once and the
    split travels as a column.
    """
    prepare_checkpoints(df.sparkSession)
    split = stratified_split(df, seed=seed)
    train_rows = training_table(split.where(~F.col("is_test")), features, validation=sizes.boost_validation)
    with held(dealt(train_rows)) as train:
        test = assembler(features).transform(split.where("is_test"))
        with held(sized(test.select(S.ID, S.CHURN, S.REVENUE, VECTOR), S.ID)) as held_test:
            wanted = {n: e for n, e in candidates(train.count(), sizes).items() if names is None or n in names}

            def one(name: str) -> tuple[Model, dict]:
                model = fit_candidate(wanted[name], train, sizes)
                return model, compare(name, with_probability(model, held_test))

            done = dict(zip(wanted, overlapped(train, one, wanted)))
            fits, comparison = {n: model for n, (model, _) in done.items()}, [row for _, row in done.values()]
            best = max(comparison, key=lambda r: r["auc"])
    model = fits[best["name"]]
    scored = with_probability(model, test).select(S.ID, S.CHURN, S.REVENUE, PROBABILITY)
    return ChurnFit(best["name"], PipelineModel([assembler(features, "keep"), model]), list(features),
                    comparison, best["best_threshold"], scored, fits)


def compare(name: str, scored: DataFrame) -> dict:
    """Area, accuracy and F1 at 0.5, and the F1-optimal threshold of one candidate."""
    # Three passes read the scores; the model runs once.
    with held(scored.select(S.CHURN, PROBABILITY)) as pairs:
        areas = curve_summary(score_ladder(pairs, PROBABILITY, S.CHURN)).first()
        at_half = with_metrics(confusion(pairs, PROBABILITY, S.CHURN, [0.5])).first()
    return {"name": name, "auc": areas["roc_auc"], "accuracy": at_half["accuracy"],
            "f1": at_half["f1"], "best_threshold": areas["best_threshold"]}


def cross_validate(
    df: DataFrame, features: Sequence[str], name: str, *, sizes: TreeSizes = TreeSizes(),
    folds: int = S.CV_FOLDS, seed: int = S.SEED, scores: str | None = None,
) -> DataFrame:
    """fold, roc_auc, f1 (at 0.5) of one candidate refitted on each fold's complement; every row is in a fold.

    With ``scores`` id, label, fold and probability of every row by the model that did not
    see it are written below that folder, and those of the rows it saw.
    """
    prepare_checkpoints(df.sparkSession)
    part = stratified_folds(df, folds, seed)
    with held(dealt(training_table(part, features, ["fold"], sizes.boost_validation))) as cached:
        n = cached.count()
        estimator = candidates(n * (folds - 1) // folds, sizes)[name]

        def one(fold: int) -> tuple[int, float, float]:
            model = fit_candidate(estimator.copy(), cached.where(F.col("fold") != fold), sizes)
            out_of_fold = with_probability(model, cached.where(F.col("fold") == fold))
            if scores:
                kept = [S.ID, S.CHURN, F.lit(fold).alias("fold"), PROBABILITY]
                out_of_fold.select(*kept).write.parquet(f"{scores}/unseen/{fold}")
                with_probability(model, cached.where(F.col("fold") != fold)).select(*kept).write.parquet(f"{scores}/seen/{fold}")
            row = compare(name, out_of_fold)
            return fold, row["auc"], row["f1"]

        rows_out = overlapped(cached, one, range(folds), max(1, FOLD_ROWS // n))
    return frame_of(df.sparkSession, rows_out, "fold int, roc_auc double, f1 double")


def cv_summary(per_fold: DataFrame) -> DataFrame:
    """Means and population standard deviations over the folds."""
    return per_fold.agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg("roc_auc").alias("roc_auc_mean"), F.stddev_pop("roc_auc").alias("roc_auc_std"),
        F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std"),
    )


def importance(model: Model, features: Sequence[str], top: int = 15) -> list[tuple[str, float]]:
    """Most important features first; empty for a model without importances."""
    found = getattr(model, "featureImportances", None)
    if found is None:
        return []
    pairs = zip(features, (float(v) for v in found.toArray()))
    return sorted(pairs, key=lambda p: -p[1])[:top]


# ---- surrogate --------------------------------------------------------------
@dataclass(frozen=True)
class SurrogateFit:
    model: PipelineModel
    labels: list[str]
    counts: DataFrame


def train_surrogate(
    df: DataFrame, *, sizes: TreeSizes = TreeSizes(), seed: int = S.SEED
) -> SurrogateFit:
    """A forest that reproduces the segments from the four raw features."""
    prepare_checkpoints(df.sparkSession)
    labels = segment_levels(df)
    split = stratified_split(df, seed=seed, strata=(S.SEGMENT,))
    columns = split.select(S.ID, S.SEGMENT, "is_test", *S.CLUSTER_FEATURES)
    index = StringIndexer(inputCol=S.SEGMENT, outputCol="segment_index", stringOrderType="alphabetAsc")
    vector = VectorAssembler(inputCols=list(S.CLUSTER_FEATURES), outputCol="segment_features")
    forest = RandomForestClassifier(
        featuresCol="segment_features", labelCol="segment_index", numTrees=sizes.surrogate_trees,
        maxDepth=sizes.surrogate_depth, minInstancesPerNode=sizes.surrogate_leaf,
        maxBins=sizes.forest_bins, maxMemoryInMB=sizes.memory_mb, featureSubsetStrategy="sqrt", seed=sizes.seed)
    back = IndexToString(inputCol="prediction", outputCol="predicted_segment", labels=labels)
    with held(dealt(columns)) as cached:
        model = without_summary(Pipeline(stages=[index, vector, forest]).fit(cached.where("NOT is_test")))
    whole = PipelineModel([*model.stages, back])
    scored = whole.transform(columns.where("is_test"))
    return SurrogateFit(whole, labels, class_counts(scored, S.SEGMENT, "predicted_segment"))
