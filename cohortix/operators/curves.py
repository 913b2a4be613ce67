"""Classifier evaluation: curves, exact areas, threshold choice, metric suites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortix.functions.expr import turn_in_table, whole_table, zero_div
from cohortix.functions.running import running_totals, slice_bounds
from cohortix.session import frame_of, written


def known(score: str) -> Column:
    """The score; the job fails on a missing or undefined one, which no curve or cell could hold."""
    c = F.col(score).cast("double")
    return F.when(c.isNull() | F.isnan(c), F.raise_error(F.lit(f"{score} is missing or NaN")).cast("double")).otherwise(c)


# ---- curves -----------------------------------------------------------------
def score_ladder(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score with the positives and negatives at or above it.

    Scores are combined before the shuffle and written once; bounds and running totals by
    range slice come from that table, so neither a popular score nor the global order ends up
    in one task.
    """
    positive = F.count_if(F.col(label) == 1)
    steps = written(df.groupBy(known(score).alias("score")).agg(
        positive.alias("pos"), (F.count(F.lit(1)) - positive).alias("neg"),
    ).withColumn("pt", F.lit(1).cast("long")), "scores")
    bounds = slice_bounds(steps, "score")
    return running_totals(steps, "score", ["pos", "neg", "pt"], bounds, heads=["pos", "neg"])


def pr_curve(ladder: DataFrame) -> DataFrame:
    """threshold, precision, recall, f1 and the 0-based position in ascending threshold."""
    tp, flagged = F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")
    recall = F.when(F.col("all_pos") == 0, F.lit(1.0)).otherwise(zero_div(tp, F.col("all_pos")))
    p, r = F.col("precision"), F.col("recall")
    return (
        ladder.select(
            F.col("score").alias("threshold"), (tp / flagged).alias("precision"),
            recall.alias("recall"), (F.col("all_pt") - F.col("cum_pt")).alias("position"),
            F.col("all_pt").alias("points"),
        )
        .withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r + F.lit(1e-12))).otherwise(F.lit(0.0)))
    )


def roc_points(ladder: DataFrame) -> DataFrame:
    """fpr, tpr, threshold; points inside a straight run are left out, (0, 0) is added."""
    bend = (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    ends = (F.col("cum_pt") == 1) | (F.col("cum_pt") == F.col("all_pt"))
    kept = ladder.where(ends | bend).select(
        F.try_divide("cum_neg", "all_neg").alias("fpr"),
        F.try_divide("cum_pos", "all_pos").alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = frame_of(kept.sparkSession, [(0.0, 0.0, float("inf"))], "fpr double, tpr double, threshold double")
    return kept.unionByName(origin)


def decimate_pr(curve: DataFrame, target: int = 100) -> DataFrame:
    """Every n-th point in ascending threshold, n = max(1, points // target)."""
    step = F.greatest(F.floor(F.col("points") / target), F.lit(1))
    return curve.where(F.col("position") % step == 0)


def decimate_roc(roc: DataFrame, target: int = 120) -> DataFrame:
    """Every n-th ROC point from (0, 0) on, n = max(1, points // target)."""
    finite = F.when(F.col("threshold") == float("inf"), F.lit(None)).otherwise(F.col("threshold"))
    bounds = slice_bounds(roc.select(finite.alias("threshold")), "threshold")
    numbered = running_totals(roc.withColumn("pt", F.lit(1).cast("long")), "threshold", ["pt"], bounds)
    step = F.greatest(F.floor(F.col("all_pt") / target), F.lit(1))
    return (
        numbered.where((F.col("cum_pt") - 1) % step == 0)
        .select("fpr", "tpr", "threshold", (F.col("cum_pt") - 1).alias("position"))
    )


def curve_summary(ladder: DataFrame) -> DataFrame:
    """Exact ROC area, average precision and the F1-optimal cut, in one aggregate.

    Ties count half in the ROC area; average precision is the step sum. The lowest of
    several thresholds with the same F1 wins.
    """
    p = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    r = zero_div(F.col("cum_pos"), F.col("all_pos"))
    f1 = F.when(p + r > 0, 2 * p * r / (p + r + F.lit(1e-12))).otherwise(F.lit(0.0))
    pairs = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2.0)
    best = F.max(F.struct(f1.alias("f1"), (-F.col("score")).alias("minus")))
    all_pos, all_neg = F.max("all_pos"), F.max("all_neg")
    return ladder.agg(
        F.try_divide(F.sum(pairs), all_pos.cast("double") * all_neg).alias("roc_auc"),
        F.try_divide(F.sum(F.col("pos") * p), all_pos).alias("average_precision"),
        (-best["minus"]).alias("best_threshold"),
        best["f1"].alias("best_f1"),
        all_pos.alias("positives"), all_neg.alias("negatives"),
    )


# ---- one operating point ----------------------------------------------------
def confusion(df: DataFrame, score: str, label: str, thresholds: Sequence[float]) -> DataFrame:
    """threshold, tp, fp, fn, tn for a handful of thresholds in one pass."""
    positive = F.col(label) == 1

    def cells(t: float) -> Column:
        flagged = known(score) >= F.lit(float(t))
        return F.struct(
            F.lit(float(t)).alias("threshold"),
            F.count_if(flagged & positive).alias("tp"), F.count_if(flagged & ~positive).alias("fp"),
            F.count_if(~flagged & positive).alias("fn"), F.count_if(~flagged & ~positive).alias("tn"),
        )

    return df.agg(F.array(*[cells(t) for t in thresholds]).alias("rows")).select(F.inline("rows"))


def with_metrics(cells: DataFrame) -> DataFrame:
    """Add every rate derived from tp, fp, fn, tn; an undefined rate is 0."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    margin = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    chance = (tp + fp) * (fp + tn) + (tp + fn) * (fn + tn)
    return cells.withColumns({
        "accuracy": zero_div(tp + tn, tp + fp + fn + tn),
        "precision": zero_div(tp, tp + fp),
        "recall": zero_div(tp, tp + fn),
        "specificity": zero_div(tn, tn + fp),
        "f1": zero_div(2 * tp, 2 * tp + fp + fn),
        "mcc": zero_div(tp * tn - fp * fn, margin),
        "cohen_kappa": zero_div(2 * (tp * tn - fn * fp), chance),
        "negatives": F.col("tn") + F.col("fp"),
        "positives": F.col("fn") + F.col("tp"),
    }).withColumn("balanced_accuracy", (F.col("recall") + F.col("specificity")) / 2)


def metric_suite(df: DataFrame, score: str, label: str, thresholds: Sequence[float]) -> DataFrame:
    """Every binary metric at each threshold, one row per threshold."""
    areas = curve_summary(score_ladder(df, score, label)).first()
    return with_metrics(confusion(df, score, label, thresholds)).withColumns({
        "roc_auc": F.lit(areas["roc_auc"]),
        "pr_auc": F.lit(areas["average_precision"]),
    })


# ---- threshold grid ---------------------------------------------------------
def grid_threshold(i: Column) -> Column:
    """Grid point ``i`` in 1..99, accumulated like the loop that defines it."""
    return F.lit(0.01) + (i - 1) * F.lit(0.01)


def grid_cell(p: Column) -> Column:
    """How many grid points lie at or below ``p``."""
    guess = F.least(F.greatest(F.floor(p * 100), F.lit(0)), F.lit(99)).cast("int")
    down = F.when((guess >= 1) & (p < grid_threshold(guess)), guess - 1)
    up = down.when((guess < 99) & (p >= grid_threshold(guess + 1)), guess + 1)
    return up.otherwise(guess)


def threshold_grid(df: DataFrame, score: str, label: str, revenue: str) -> DataFrame:
    """The confusion matrix and revenue at 99 thresholds from one histogram of 100 cells."""
    positive = F.col(label) == 1
    cells = df.groupBy(grid_cell(F.col(score)).alias("cell")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"),
        F.sum(F.when(positive, F.col(revenue)).otherwise(0.0)).alias("rev_pos"),
        F.sum(F.when(~positive, F.col(revenue)).otherwise(0.0)).alias("rev_neg"),
    )
    sums = ("pos", "neg", "rev_pos", "rev_neg")
    axis = df.sparkSession.range(0, 100, 1, 1).select(F.col("id").cast("int").alias("cell"))
    from_here = turn_in_table(F.col("cell").desc())
    dense = (
        axis.join(cells, "cell", "left").na.fill(0)
        .select("cell",
                *[F.sum(c).over(from_here).alias(c) for c in sums],
                *[F.sum(c).over(whole_table()).alias(f"all_{c}") for c in ("pos", "neg")])
        .where("cell > 0")
    )
    tp, fp = F.col("pos"), F.col("neg")
    counts = dense.select(
        F.round(grid_threshold(F.col("cell")), 2).alias("t"),
        tp.alias("tp"), fp.alias("fp"),
        (F.col("all_pos") - tp).alias("fn"), (F.col("all_neg") - fp).alias("tn"),
        (tp + fp).alias("contacted"),
        # The inner rounding keeps an exact half a half whatever the order of the sum was.
        F.bround(F.round("rev_pos", 6), 0).alias("rev_saved_ceiling"),
        F.bround(F.round("rev_neg", 6), 0).alias("rev_wasted"),
    )
    rates = ("precision", "recall", "f1", "accuracy", "specificity")
    return with_metrics(counts).select(
        "t", "tp", "fp", "fn", "tn", *[F.round(c, 4).alias(c) for c in rates],
        "contacted", "rev_saved_ceiling", "rev_wasted",
    )


# ---- many classes -----------------------------------------------------------
def class_counts(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Confusion matrix in long form: one row per occurring pair."""
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(counts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per actual class and one column per predicted class; absent pairs are 0."""
    wide = counts.groupBy("actual").pivot("predicted", list(labels)).agg(F.sum("n"))
    axis = frame_of(counts.sparkSession, [(x,) for x in labels], "actual string")
    return axis.join(wide, "actual", "left").na.fill(0).orderBy("actual")


def per_class_report(counts: DataFrame) -> DataFrame:
    """label, support, predicted, tp, precision, recall, f1."""
    hit = F.col("actual") == F.col("predicted")
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(F.col("actual").alias("label"), F.col("n").alias("support"),
                 none.alias("predicted"), F.when(hit, F.col("n")).otherwise(none).alias("tp")),
        F.struct(F.col("predicted").alias("label"), none.alias("support"),
                 F.col("n").alias("predicted"), none.alias("tp")),
    )
    totals = counts.select(F.inline(sides)).groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    return totals.withColumns({
        "precision": zero_div(F.col("tp"), F.col("predicted")),
        "recall": zero_div(F.col("tp"), F.col("support")),
        "f1": zero_div(2.0 * F.col("tp"), F.col("support") + F.col("predicted")),
    })


def multiclass_summary(counts: DataFrame) -> DataFrame:
    """Accuracy, macro precision/recall/F1, weighted F1 and kappa from the k x k counts."""
    n = F.sum("support").cast("double")
    hits = F.sum("tp") / n
    chance = F.sum(F.col("support").cast("double") * F.col("predicted")) / (n * n)
    return per_class_report(counts).agg(
        hits.alias("accuracy"),
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("weighted_f1"),
        zero_div(hits - chance, 1.0 - chance).alias("cohen_kappa"),
        F.sum("support").alias("support"),
    )
