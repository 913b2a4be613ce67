"""First job: load, clean, choose k, cluster, name the segments, write the checkpoint.

The checkpoint is the labelled table plus the state (parameters and segment names); names
are attached on resuming, so the table is written once. Its stages are kept in a manifest: a
rerun over the same rows and settings goes on where the last one ended.
"""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import DataFrame

from cohortix import schema as S
from cohortix.operators import clean, kmeans, profile
from cohortix.operators.cluster_scores import cluster_scores
from cohortix.operators.mixture import (
    Mixture,
    MixtureFit,
    fit_mixture,
    hard_starts,
    information_criteria,
    soft_assign,
)
from cohortix.plans.manifest import Manifest, fingerprint
from cohortix.plans.settings import Settings
from cohortix.session import frame_of, held, sized
from cohortix.sources.sinks import records, write_document, write_report, write_table

SCALED = tuple(clean.scaled_name(c) for c in S.CLUSTER_FEATURES)


def fit_clusters(table: DataFrame, settings: Settings) -> tuple[kmeans.KMeansFit, MixtureFit]:
    """K-Means and mixture over the scaled features; the mixture starts from the restarts."""
    with held(sized(table.select(S.ID, *SCALED), S.ID, kmeans.FIT_ROWS_PER_TASK)) as rows:
        core = kmeans.coreset(rows, SCALED, seed=settings.seed)
        jobs = [(settings.clusters, s) for s in range(settings.seed, settings.seed + settings.kmeans_restarts)]
        settled = kmeans.restart_centres(rows, core, jobs)
        best = kmeans.finish(rows, SCALED, jobs, settled, core.variance)[settings.clusters]
        starts = hard_starts(rows, SCALED, settled[:settings.mixture_restarts], S.MIXTURE_REG)
        return best, fit_mixture(rows, starts, core=core)


def label_clusters(table: DataFrame, best: kmeans.KMeansFit, fit: MixtureFit) -> DataFrame:
    """Add both hard labels, the mixture confidence and the log density."""
    hard = kmeans.nearest_centroid(table, SCALED, best.centres, "kmeans_cluster", "squared_distance")
    return soft_assign(hard, fit.mixture).withColumnsRenamed(
        {"cluster_id": "gmm_cluster", "confidence": "gmm_confidence"})


def _clean(raw: DataFrame, out: str, settings: Settings) -> dict[str, Any]:
    cleaned = clean.run(raw, settings.quantiles)
    filled = clean.impute(cleaned.valid, cleaned.params.medians)
    caps = {
        r["feature"]: {c: r[c] for c in ("low", "high", "n_capped")}
        for r in records(clean.count_capped(filled, cleaned.params.fences))
    }
    _, broken = clean.write_checked(cleaned.table, cleaned.params, lambda df: write_table(df, f"{out}/clean"))
    if any(broken.values()):
        raise ValueError(f"the cleaned table breaks its conditions: {broken}")
    return {"audit": cleaned.audited, "outlier_caps": caps, "params": cleaned.params.to_json()}


def _sweep(scaled: DataFrame, out: str, settings: Settings) -> dict[str, Any]:
    sweep = kmeans.sweep_k(scaled, SCALED, settings.sweep, settings.kmeans_restarts, settings.seed, settings.sample_rows)
    write_report(sweep.orderBy("k"), f"{out}/k_sweep")
    return {"k_sweep": records(sweep.orderBy("k")), "elbow_k": profile.elbow_k(sweep).first()[0],
            "silhouette_k": profile.best_row(sweep, "silhouette", "k", ["k"]).first()[0]}


def _clusters(scaled: DataFrame, out: str, settings: Settings) -> dict[str, Any]:
    best, fit = fit_clusters(scaled, settings)
    write_table(label_clusters(scaled, best, fit).drop(*SCALED, "probabilities", "squared_distance", "runner_up_id"), f"{out}/labelled")
    return {"mixture": fit.mixture.to_json(), "centres": [list(c) for c in best.centres]}


def _evaluate(labelled: DataFrame, out: str, params: clean.CleaningParams, mixture: Mixture, settings: Settings) -> dict[str, Any]:
    points = clean.standardise(labelled, params.means, params.stds)
    scores = {r.pop("model"): r for r in records(cluster_scores(
        points, SCALED, ["kmeans_cluster", "gmm_cluster"], settings.sample_rows, settings.seed))}
    prof = profile.cluster_profile(labelled, "gmm_cluster")
    write_report(prof, f"{out}/cluster_profile")
    return {
        "kmeans_eval": scores["kmeans_cluster"],
        "gmm_eval": {**scores["gmm_cluster"], **records(information_criteria(labelled, mixture))[0]},
        "kmeans_gmm_agreement": profile.purity(labelled, "kmeans_cluster", "gmm_cluster").first()[0],
        **records(profile.confidence_stats(labelled))[0],
        "profile": records(prof), "cluster_to_segment": profile.cluster_names(prof, "gmm_cluster"),
    }


def segment_customers(raw: DataFrame, out: str, settings: Settings = Settings()) -> dict[str, Any]:
    """Run the job, write its tables under ``out`` and return its metrics."""
    started = time.time()
    spark = raw.sparkSession
    manifest = Manifest(spark, out, fingerprint(raw))
    fit_settings = dict(restarts=settings.kmeans_restarts, seed=settings.seed, sample_rows=settings.sample_rows)
    cleaned = manifest.stage("clean", lambda: _clean(raw, out, settings), quantiles=settings.quantiles)
    params = clean.CleaningParams.from_json(cleaned["params"])
    scaled = clean.standardise(spark.read.parquet(f"{out}/clean"), params.means, params.stds)
    sweep = manifest.stage("sweep", lambda: _sweep(scaled, out, settings), sweep=settings.sweep, **fit_settings)
    fitted = manifest.stage("clusters", lambda: _clusters(scaled, out, settings), clusters=settings.clusters,
                            mixture_restarts=settings.mixture_restarts, **fit_settings)
    mixture = Mixture.from_json(fitted["mixture"])
    found = manifest.stage("evaluation", lambda: _evaluate(spark.read.parquet(f"{out}/labelled"), out, params, mixture, settings))
    names = {int(k): v for k, v in found["cluster_to_segment"].items()}
    _write_state(spark, out, cleaned["params"], fitted["mixture"], names, fitted["centres"])
    audit = cleaned["audit"]
    doc = {"raw_rows": audit["rows_in"], "clean_rows": audit["rows_out"], "cleaning_report": audit,
           "outlier_caps": cleaned["outlier_caps"], **sweep, "chosen_k": settings.clusters, **found, "cluster_to_segment": names,
           "manifest_key": manifest.key, "segmentation_seconds": round(time.time() - started, 1)}
    write_document(spark, doc, f"{out}/segmentation_metrics")
    return doc


def _write_state(spark, out: str, params: str, mixture: str, names: dict[int, str], centres: list[list[float]]) -> None:
    state = frame_of(spark, [(params, mixture, names, centres)], "cleaning string, mixture string, names map<int,string>, "
                                                                 "centres array<array<double>>")
    state.coalesce(1).write.mode("overwrite").parquet(f"{out}/segmentation_state")
