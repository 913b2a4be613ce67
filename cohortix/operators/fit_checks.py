"""Facts about fitted models, computed from their parameters and from rows, without the library that fitted them.

A logistic regression is where its penalised gradient vanishes. A tree ensemble is its node
table, as the model writer saves it: rows walk it by plain array expressions, and importances
are sums over it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Model
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortix.session import shared_dir


def logistic_gradient(rows: DataFrame, model: LogisticRegressionModel, features: Sequence[str], label: str, weight: Column,
                      penalty: float) -> float:
    """Largest component of the gradient of the mean weighted loss plus penalty, per unit of spread of a feature.

    The penalty is on coefficients of features of unit spread; the intercept has none.
    """
    x = [F.col(c).cast("double") for c in features]
    score = sum((c * F.lit(float(b)) for c, b in zip(x, model.coefficients)), F.lit(float(model.intercept)))
    rows = rows.select(*[c.alias(f"x{i}") for i, c in enumerate(x)], weight.alias("w"),
                       (F.lit(1.0) / (F.lit(1.0) + F.exp(-score)) - F.col(label)).alias("e"))
    row = rows.agg(
        F.sum("w").alias("total"), F.sum(F.col("w") * F.col("w")).alias("squares"), F.sum(F.col("w") * F.col("e")).alias("g"),
        *[F.sum(F.col("w") * F.col("e") * F.col(f"x{i}")).alias(f"g{i}") for i in range(len(x))],
        *[F.sum(F.col("w") * F.col(f"x{i}")).alias(f"s{i}") for i in range(len(x))],
        *[F.sum(F.col("w") * F.col(f"x{i}") * F.col(f"x{i}")).alias(f"q{i}") for i in range(len(x))]).first()
    total = row["total"]
    out = [abs(row["g"] / total)]
    for i, b in enumerate(model.coefficients):
        mean = row[f"s{i}"] / total
        # the weighted sample variance
        spread = np.sqrt(max(row[f"q{i}"] - total * mean * mean, 0.0) / (total - row["squares"] / total))
        if spread > 0:
            out.append(abs(row[f"g{i}"] / total / spread + penalty * spread * float(b)))
    return max(out)


def node_table(spark: SparkSession, model: Model) -> DataFrame:
    """``tree, id, prediction, stats, gain, left, right, feature, threshold`` of an ensemble's nodes, as its writer saves them."""
    path = f"{shared_dir(spark)}/cohortix/model-{uuid.uuid4().hex}"
    model.write().save(path)
    n = F.col("nodeData")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), n["id"].alias("id"), n["prediction"].alias("prediction"), n["impurityStats"].alias("stats"),
        n["gain"].alias("gain"), n["leftChild"].alias("left"), n["rightChild"].alias("right"),
        n["split"]["featureIndex"].alias("feature"), F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"))


def walked(rows: DataFrame, id_col: str, model: Model, nodes: DataFrame, features: Sequence[str], depth: int, out: str) -> DataFrame:
    """``id_col`` and the probability of class 1 that each row gets by walking down all trees."""
    trees = nodes.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct(
        "id", "left", "right", "feature", "threshold", "prediction", "stats"))).alias("nodes"))

    def below(at: Column, _: Column) -> Column:
        node = F.get("nodes", at)
        low = F.get("x", node["feature"]) <= node["threshold"]
        return F.when(node["left"] < 0, at).when(low, node["left"]).otherwise(node["right"])

    leaf = F.get("nodes", F.aggregate(F.sequence(F.lit(1), F.lit(max(1, depth))), F.lit(0), below))
    weights = list(model.treeWeights)
    each = rows.select(id_col, F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
                       F.explode(F.sequence(F.lit(0), F.lit(len(weights) - 1))).alias("tree"))
    each = each.join(trees, "tree").select(id_col, "tree", leaf.alias("leaf"))
    if isinstance(model, GBTClassificationModel):
        margin = F.sum(F.col("leaf.prediction") * F.get(F.array(*[F.lit(float(w)) for w in weights]), F.col("tree")))
        found = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))
    else:
        found = F.avg(F.col("leaf.stats")[1] / F.aggregate("leaf.stats", F.lit(0.0), lambda a, b: a + b))
    return each.groupBy(id_col).agg(found.alias(out))


def importances(nodes: DataFrame, n_features: int) -> np.ndarray:
    """Shares of the features in the gain of a forest, every tree weighing the same."""
    inner = nodes.where("left >= 0").withColumn(
        "won", F.col("gain") * F.aggregate("stats", F.lit(0.0), lambda a, b: a + b))
    trees = inner.groupBy("tree").agg(F.sum("won").alias("whole"))
    found = inner.join(trees, "tree").where("whole > 0").groupBy("feature").agg(F.sum(F.col("won") / F.col("whole")).alias("share")).collect()
    out = np.zeros(n_features)
    for r in found:
        out[r["feature"]] = r["share"]
    return out / out.sum() if out.sum() else out
