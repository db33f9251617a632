"""The random forest, its explanation and the forecast."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from envspark.ml import forecast as fc
from envspark.ml import forest
from envspark.operators import reports
from envspark.operators.features import ml_frame
from envspark.plans import analysis, pipeline
from envspark.profiles import FULL, LITE
from envspark.sources import sinks
from envspark.sources.readings import load_readings

from conftest import MEDIUM


@pytest.fixture(scope="module")
def run(spark):
    data = load_readings(spark, MEDIUM)
    model, scored = analysis.train_and_score(data, FULL)
    return data, model, scored.cache()


def test_profiles_name_their_inputs():
    assert len(FULL.features) == 22 and len(LITE.features) == 21
    assert set(FULL.features) - set(LITE.features) == {"rain"}


def test_pipeline_shape(run):
    _, model, scored = run
    assert [type(s).__name__ for s in model.stages] == [
        "StringIndexerModel", "OneHotEncoderModel", "VectorAssembler", "StandardScalerModel", "VectorAssembler",
        "RandomForestRegressionModel"]
    trees = model.stages[-1]
    assert trees.getNumTrees == 50 and max(t.depth for t in trees.trees) <= 10
    assert trees.numFeatures == 22 + 5
    assert "features" not in scored.columns


def test_forest_beats_persistence(run):
    data, _, scored = run
    learned = reports.regression_metrics(scored).first()
    naive = reports.regression_metrics(pipeline.persistence_predictions(data)).first()
    assert learned.r2 > 0.7 > naive.r2
    assert scored.count() == pytest.approx(data.count() * 0.2, rel=0.1)


def test_importances(run):
    _, model, scored = run
    rows = forest.feature_importance(model, scored, FULL).collect()
    assert len(rows) == 23 and {r.feature for r in rows} == {*FULL.features, "zone"}
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert rows[0].relative == 1.0
    assert [r.importance for r in rows] == sorted((r.importance for r in rows), reverse=True)
    assert forest.feature_importance(model, scored, FULL, top=10).count() == 10


def test_forecast(spark, run):
    data, model, _ = run
    frame = fc.forecast_frame(pipeline.features(data))
    rows = frame.orderBy("hour").collect()
    assert [r.hour for r in rows] == list(range(24))
    assert {r.zone for r in rows} == {"Zone_Central"} and {r.month for r in rows} == {12}
    assert [r.day_of_week for r in rows[:8]] == [1, 2, 3, 4, 5, 6, 7, 1]
    assert rows[0].pm25_lag1 == rows[0].pm25 and rows[0].aqi_lag1 == 100.0
    assert len(frame.columns) == 25
    predicted = fc.forecast(model, frame).collect()
    assert len(predicted) == 24 and all(r.predicted_aqi > 0 for r in predicted)


def test_report_bundle(run):
    data, model, scored = run
    every = forest.score(model, ml_frame(pipeline.features(data), FULL, ("reading_id",)))
    bundle = analysis.run_report(data, model, scored, every, FULL)
    assert set(bundle) == {"metrics", "feature_importance", "zones", "hourly_pattern", "category_distribution",
                           "predictions", "data", "pollutant_stats"}
    counts = {name: frame.count() for name, frame in bundle.items()}
    assert counts["metrics"] == counts["data"] == 1
    assert (counts["feature_importance"], counts["zones"], counts["hourly_pattern"]) == (10, 5, 24)
    assert (counts["predictions"], counts["pollutant_stats"]) == (500, 6)


def test_lite_profile_trains_and_reports_in_one_run(spark, tmp_path):
    data = load_readings(spark, MEDIUM)
    with analysis.run_all(data, "lite") as bundle:
        assert len(bundle) == 8 and bundle["predictions"].count() == 500
        assert bundle["feature_importance"].count() == 10
        sinks.write_report(bundle, str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report" / "metrics")).first().r2 > 0.5
    assert spark.read.parquet(str(tmp_path / "report" / "zones")).count() == 5


def test_fit_reads_parts_by_rows_and_cores(spark, monkeypatch):
    """Every part sends the statistics of all nodes, so a shuffle's hundreds of parts are put together."""
    class Stub:
        def fit(self, rows):
            return rows.rdd.getNumPartitions(), rows.count()

    monkeypatch.setattr(forest, "forest_pipeline", lambda p: Stub())
    columns = [F.col("id").cast("double").alias(c) for c in (*FULL.features, "aqi")]
    rows = spark.range(5000).select(*columns, F.lit("Zone_East").alias("zone")).repartition(150)
    cores = spark.sparkContext.defaultParallelism
    assert forest.fit_forest(rows, FULL) == (150, 5000)  # few rows
    monkeypatch.setattr(forest, "FEW_ROWS", 100)
    assert forest.fit_forest(rows, FULL) == (cores, 5000)
    monkeypatch.setattr(forest, "PART_ROWS", 400)
    parts, count = forest.fit_forest(rows, FULL)
    assert 13 <= parts <= 13 + cores and parts % cores == 0 and count == 5000
    assert forest.fit_forest(rows.coalesce(2), FULL) == (2, 5000)


def test_fit_remembers_nodes_and_grows_the_same_trees(spark):
    """Without remembered nodes each level walks all rows down from the roots again."""
    noise = {c: (F.xxhash64(F.col("id"), F.lit(c)) % 1000).cast("double") for c in FULL.features}
    rows = spark.range(1500).select(*[v.alias(c) for c, v in noise.items()], F.lit("Zone_East").alias("zone")
                                    ).withColumn("aqi", F.col("pm25") + F.col("pm10") / 3).coalesce(2).cache()
    pipe = forest.forest_pipeline(FULL)
    trees = pipe.getStages()[-1]
    assert trees.getCacheNodeIds() and trees.getCheckpointInterval() == -1
    plain = pipe.copy()
    plain.setStages([*pipe.getStages()[:-1], trees.copy({trees.cacheNodeIds: False})])
    with_nodes, without = pipe.fit(rows).stages[-1], plain.fit(rows).stages[-1]
    assert with_nodes.toDebugString.split("\n", 1)[1] == without.toDebugString.split("\n", 1)[1]
    assert max(t.depth for t in with_nodes.trees) > 5
    rows.unpersist()
