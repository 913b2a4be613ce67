"""Learned state on disk: tidy parameter tables plus the churn model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from cohortix.operators.clean import CleaningParams, Fence
from cohortix.operators.mixture import Mixture
from cohortix.operators.score import Scorer, model_probability
from cohortix.session import frame_of


def _put(spark: SparkSession, path: str, rows: list[tuple], schema: str) -> None:
    frame_of(spark, rows, schema).coalesce(1).write.mode("overwrite").parquet(path)


def save(spark: SparkSession, path: str, cleaning: CleaningParams, mixture: Mixture,
         names: dict[int, str], threshold: float, segments: list[str], model: PipelineModel,
         centres: list[list[float]] | None = None) -> None:
    numbers = [("median", c, v) for c, v in cleaning.medians.items()]
    numbers += [("ratio_cap", c, v) for c, v in cleaning.ratio_caps.items()]
    numbers += [("mean", c, v) for c, v in cleaning.means.items()]
    numbers += [("std", c, v) for c, v in cleaning.stds.items()]
    for c, f in cleaning.fences.items():
        numbers += [("fence_low", c, f.low), ("fence_high", c, f.high)]
    _put(spark, f"{path}/cleaning", numbers, "kind string, feature string, value double")
    components = [
        (j, mixture.weights[j], i, x, mixture.means[j][i], mixture.variances[j][i])
        for j in range(mixture.k) for i, x in enumerate(mixture.features)
    ]
    _put(spark, f"{path}/mixture", components,
         "component int, weight double, position int, feature string, mean double, variance double")
    if centres:
        _put(spark, f"{path}/centres", list(enumerate(centres)), "cluster int, centre array<double>")
    _put(spark, f"{path}/segments", sorted(names.items()), "cluster_id int, segment string")
    _put(spark, f"{path}/metadata", [(threshold, segments)], "threshold double, levels array<string>")
    model.write().overwrite().save(f"{path}/churn_model")


def load_centres(spark: SparkSession, path: str) -> list[list[float]]:
    """The K-Means centres in the scaled features, by cluster number."""
    rows = spark.read.parquet(f"{path}/centres").collect()
    return [list(r["centre"]) for r in sorted(rows, key=lambda r: r["cluster"])]


def load(spark: SparkSession, path: str) -> Scorer:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}")

    kinds: dict[str, dict[str, float]] = {}
    for r in table("cleaning").collect():
        kinds.setdefault(r["kind"], {})[r["feature"]] = r["value"]
    fences = {c: Fence(low, kinds["fence_high"][c]) for c, low in kinds.get("fence_low", {}).items()}
    cleaning = CleaningParams(kinds.get("median", {}), fences, kinds.get("ratio_cap", {}),
                              kinds["mean"], kinds["std"])
    parts = sorted(table("mixture").collect(), key=lambda r: (r["component"], r["position"]))
    k = 1 + max(r["component"] for r in parts)
    by_component = [[r for r in parts if r["component"] == j] for j in range(k)]
    mixture = Mixture(
        tuple(r["feature"] for r in by_component[0]),
        tuple(rows[0]["weight"] for rows in by_component),
        tuple(tuple(r["mean"] for r in rows) for rows in by_component),
        tuple(tuple(r["variance"] for r in rows) for rows in by_component),
    )
    names = {r["cluster_id"]: r["segment"] for r in table("segments").collect()}
    meta = table("metadata").first()
    model = PipelineModel.load(f"{path}/churn_model")
    return Scorer(cleaning, mixture, names, meta["threshold"], tuple(meta["levels"]),
                  model_probability(model))
