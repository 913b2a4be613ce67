"""Both jobs, the artefacts, the report and the stream on a small table with small trees."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from cohortix import schema as S
from cohortix.operators.churn import TreeSizes
from cohortix.plans import manifest, prediction, report, scoring, segmentation
from cohortix.plans.settings import Settings
from cohortix.sources import artefacts, sinks
from cohortix.streaming.score_stream import landed, score_stream

SMALL = Settings(
    sweep=(2, 3, 4, 5, 6), kmeans_restarts=2, mixture_restarts=2, sample_rows=80,
    trees=TreeSizes(forest_trees=5, forest_depth=4, forest_leaf=3, boost_rounds=3, boost_depth=2,
                    surrogate_trees=5, surrogate_depth=5, surrogate_leaf=2, boost_bins=32))


@pytest.fixture(scope="module")
def finished(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("job"))
    segmentation.segment_customers(raw, out, SMALL)
    return out, prediction.predict_and_plan(spark, out, SMALL)


def test_metrics_are_consistent(finished):
    _, doc = finished
    assert doc["cleaning_report"]["rows_out"] == doc["clean_rows"] == doc["utg_count"] + doc["ucg_count"]
    assert sum(r["n_customers"] for r in doc["profile"]) == doc["clean_rows"]
    assert doc["elbow_k"] in SMALL.sweep and doc["silhouette_k"] in SMALL.sweep
    assert 0 < doc["kmeans_gmm_agreement"] <= 1 and 0 < doc["mean_confidence"] <= 1
    best = max(doc["churn_model_comparison"].values(), key=lambda r: r["auc"])
    assert doc["churn_model_comparison"][doc["churn_best_model"]] == best
    tuned = doc["churn_metrics_tuned"]
    assert tuned["f1"] >= doc["churn_metrics_default"]["f1"] - 1e-9
    assert tuned["tp"] + tuned["fp"] + tuned["fn"] + tuned["tn"] == tuned["positives"] + tuned["negatives"]
    assert len(doc["threshold_grid"]) == 99 and len(doc["churn_cv"]["roc_auc_folds"]) == 5
    assert sum(r["customers"] for r in doc["segment_summary"]) == doc["clean_rows"]
    assert sum(r["monthly_revenue_inr"] for r in doc["segment_summary"]) == pytest.approx(doc["total_monthly_revenue"])


def test_export_is_split_by_group(spark, finished):
    out, doc = finished
    control = sinks.read_group(spark, f"{out}/customers", S.CONTROL)
    assert control.count() == doc["ucg_count"] and control.columns == list(S.EXPORT_COLUMNS)
    assert {r["offer"] for r in control.select("offer").distinct().collect()} == {S.HOLDOUT_OFFER[0]}
    assert "PartitionFilters: [isnotnull(campaign_group" in control._jdf.queryExecution().executedPlan().toString()


def test_loaded_scorer_repeats_the_training_segments(spark, raw, finished):
    out, _ = finished
    scorer = artefacts.load(spark, f"{out}/artefacts")
    trained = spark.read.parquet(f"{out}/customers").select(S.ID, F.col(S.SEGMENT).alias("known"), "gmm_confidence")
    full = raw.where(F.col(S.USAGE).isNotNull())
    scored = scorer.score(full).join(trained, S.ID)
    assert scored.count() > 100
    assert scored.where("segment <> known").count() == 0
    assert scored.where("abs(segment_confidence - gmm_confidence) > 1e-9").count() == 0


def test_a_killed_job_goes_on_where_it_ended(spark, raw, tmp_path, monkeypatch):
    out, calls = str(tmp_path), []

    def counted(module, name):
        real = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, **k: calls.append(name) or real(*a, **k))

    for name in ("_clean", "_sweep", "_clusters"):
        counted(segmentation, name)
    evaluate = segmentation._evaluate
    monkeypatch.setattr(segmentation, "_evaluate", lambda *a: (_ for _ in ()).throw(InterruptedError()))
    with pytest.raises(InterruptedError):
        segmentation.segment_customers(raw, out, SMALL)
    assert calls == ["_clean", "_sweep", "_clusters"] and not manifest.exists(spark, f"{out}/segmentation_state")
    monkeypatch.setattr(segmentation, "_evaluate", evaluate)
    doc = segmentation.segment_customers(raw.repartition(3), out, SMALL)
    assert calls == ["_clean", "_sweep", "_clusters"]  # the same rows in another order
    entries = {r["stage"]: r["key"] for r in manifest.read_manifest(spark, out).collect()}
    assert set(entries) == {"clean", "sweep", "clusters", "evaluation"}
    again = segmentation.segment_customers(raw, out, SMALL)
    assert {k: v for k, v in again.items() if k != "segmentation_seconds"} == {k: v for k, v in doc.items() if k != "segmentation_seconds"}
    segmentation.segment_customers(raw, out, replace(SMALL, sweep=(2, 3, 4)))
    assert calls[3:] == ["_sweep", "_clusters"]  # the cleaning does not depend on the sweep; what follows it is repeated
    segmentation.segment_customers(raw.where(F.col(S.ID) % 50 != 1), out, replace(SMALL, sweep=(2, 3, 4)))
    assert calls[5:] == ["_clean", "_sweep", "_clusters"]


def test_an_entry_without_its_mark_is_not_finished(spark, tmp_path):
    job = manifest.Manifest(spark, str(tmp_path), "k")
    assert job.stage("a", lambda: {"x": 1}) == {"x": 1}
    again = manifest.Manifest(spark, str(tmp_path), "k")
    assert again.stage("a", lambda: {"x": 2}) == {"x": 1} and again.skipped == ["a"]
    (tmp_path / "manifest" / "a" / "_SUCCESS").unlink()
    assert manifest.Manifest(spark, str(tmp_path), "k").stage("a", lambda: {"x": 3}) == {"x": 3}


def test_fingerprint_follows_the_content(spark, raw):
    first = manifest.fingerprint(raw)
    assert first == manifest.fingerprint(raw.repartition(5)) != manifest.fingerprint(raw.union(raw.limit(1)))
    assert first != manifest.fingerprint(raw.withColumn(S.REVENUE, F.col(S.REVENUE) + (F.col(S.ID) == 3).cast("int")))
    assert first != manifest.fingerprint(raw.withColumnRenamed(S.REVENUE, "other"))
    assert manifest.fingerprint(raw.where("false")) == manifest.fingerprint(raw.where("false"))


def test_missing_sections_of_the_document_are_null(spark, tmp_path):
    sinks.write_document(spark, {"clean_rows": 5, "ucg_balance": []}, str(tmp_path / "metrics"))
    row = report.metrics_variant(spark, str(tmp_path)).select(*[report.section(n).alias(n) for n in report.SECTIONS]).first()
    assert row["headline"]["clean_rows"] == 5 and row["campaign"]["ucg_balance"] == [] and row["clusters"]["k_sweep"] is None


def test_cases_and_report(spark, finished):
    out, doc = finished
    scored = scoring.score_cases(spark, out)
    assert scored.count() == 10
    payload = report.build_report(spark, out)
    assert payload["headline"]["clean_rows"] == doc["clean_rows"] and len(payload["samples"]) == 10
    assert sinks.read_document(spark, f"{out}/report")["offer_book"]["Deal Seeker"]["priority"] == "Medium"
    assert set(payload["surrogate"]) >= {"accuracy", "kappa", "confusion_matrix"}


def test_stream_scores_like_the_batch(spark, finished, tmp_path):
    out, _ = finished
    scorer = artefacts.load(spark, f"{out}/artefacts")
    rows, folder = scoring.cases(spark), str(tmp_path / "in")
    rows.where("pack_flag = 1").write.parquet(folder)
    stream = landed(spark, folder, rows.schema)
    for _ in range(2):
        score_stream(stream, scorer, str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination(120)
        rows.where("pack_flag = 0").write.mode("append").parquet(folder)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = scorer.score(rows)
    columns = ["case_id", S.SEGMENT, "churn_prediction", "risk_band", "offer"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_command_line_scores_a_table(spark, finished, tmp_path):
    from cohortix.__main__ import parser, run
    out, _ = finished
    scoring.cases(spark).write.parquet(str(tmp_path / "in"))
    args = parser().parse_args(["score", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "scored"),
                                "--out", out])
    run(spark, args)
    assert spark.read.parquet(str(tmp_path / "scored")).count() == 10
