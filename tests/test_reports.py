"""Reports, serving, files and the split."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from envspark.operators import quality, reports, serving
from envspark.operators.windows import fit_order_buckets
from envspark.plans import pipeline
from envspark.sources import readings as src
from envspark.sources import sinks


@pytest.fixture(scope="module")
def scored(readings):
    return pipeline.persistence_predictions(readings).cache()


def test_nan_is_above_every_threshold(spark):
    rows = spark.createDataFrame([(float("nan"),), (50.0,), (50.1,), (None,)], "pm25 double")
    assert reports.exceedances(rows).count() == 2


def test_metrics_agree_with_the_evaluator(scored):
    ours = reports.regression_metrics(scored).first()
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(labelCol="aqi", predictionCol="prediction", metricName=name).evaluate(scored)
        assert ours[name] == pytest.approx(theirs, rel=1e-9)
    assert ours.accuracy_percent == pytest.approx(ours.r2 * 100)


def test_correlations_agree_with_corr(readings):
    cleaned = quality.clean(readings, "full")
    got = {(r.column_a, r.column_b): r["corr"] for r in reports.correlation_matrix(cleaned).collect()}
    assert len(got) == 100
    assert got["pm25", "pm25"] == 1.0
    assert got["pm25", "pm10"] == pytest.approx(cleaned.stat.corr("pm25", "pm10"), abs=1e-9)
    assert got["temp", "rain"] == got["rain", "temp"]


def test_a_constant_column_has_no_correlation(spark):
    rows = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (None, 9.0)], "a double, b double")
    got = {(r.column_a, r.column_b): r["corr"] for r in reports.correlation_matrix(rows, ["a", "b"]).collect()}
    assert got["a", "b"] is None


def test_zone_risk_layout(scored):
    zones = reports.zone_risk(scored)
    assert zones.columns == ["zone", "avg_predicted_aqi", "max_predicted_aqi", "min_predicted_aqi",
                             "std_predicted_aqi", "num_records", "risk_level"]
    rows = zones.collect()
    assert len(rows) == 5 and rows == sorted(rows, key=lambda r: -r.avg_predicted_aqi)


@pytest.mark.parametrize("averages,expected", [
    ([160.0, 170.0, 90.0, 80.0, 70.0, 60.0], [170.0, 160.0]),
    ([125.16, 124.79, 124.1, 124.0, 123.55, 10.0], [125.16, 124.79, 124.1, 124.0, 123.55]),
    ([150.0], [150.0]),
    ([], []),
])
def test_high_risk_zones_fall_back_to_the_top_five(spark, averages, expected):
    zones = spark.createDataFrame([(f"z{i}", a) for i, a in enumerate(averages)],
                                  "zone string, avg_predicted_aqi double")
    assert [r.avg_predicted_aqi for r in reports.high_risk_zones(zones).collect()] == expected


def test_peaks_of_the_published_hours(spark):
    published = [126.88, 129.41, 128.17, 123.98, 137.14, 138.45, 136.87, 130.01, 124.65, 126.45, 121.58, 119.39,
                 121.22, 117.35, 117.39, 97.35, 117.93, 112.50, 119.25, 118.36, 124.16, 128.92, 130.68, 133.09]
    rows = spark.createDataFrame(list(enumerate(published)), "hour int, prediction double")
    ends = reports.peak_low_hour(rows).first()
    assert (ends.peak_hour, ends.peak_aqi, ends.low_hour, ends.low_aqi) == (5, 138.45, 15, 97.35)
    assert [r.hour for r in reports.peak_hours(rows, 10).collect()] == [5, 4, 6, 23, 22, 7, 1, 21, 2, 0]
    tied = spark.createDataFrame([(3, 1.0), (1, 1.0), (2, 0.0), (9, 0.0)], "hour int, prediction double")
    ends = reports.peak_low_hour(tied).first()
    assert (ends.peak_hour, ends.low_hour) == (1, 2)


def test_histogram_covers_every_row(scored):
    bins = reports.error_histogram(scored).orderBy("bin").collect()
    assert [b.bin for b in bins] == list(range(50))
    assert sum(b["count"] for b in bins) == scored.count()
    assert bins[-1]["count"] >= 1
    assert sum(r["count"] for r in reports.error_bands(scored).collect()) == scored.count()


def test_histogram_of_equal_errors(spark):
    rows = spark.createDataFrame([(1.0, 0.0), (2.0, 1.0)], "aqi double, prediction double")
    bins = reports.error_histogram(rows).orderBy("bin").collect()
    assert bins[0]["count"] == 2 and sum(b["count"] for b in bins) == 2


def test_shares_add_up(readings):
    shares = reports.category_share(pipeline.indexed(readings)).collect()
    assert sum(r.share_pct for r in shares) == pytest.approx(100, abs=0.3)


def test_hash_split_is_stable(readings):
    train, test = reports.split_hash(readings)
    ids = sorted(r.reading_id for r in train.select("reading_id").collect())
    again, _ = reports.split_hash(readings.repartition(9))
    assert ids == sorted(r.reading_id for r in again.select("reading_id").collect())
    assert train.count() + test.count() == readings.count()
    assert train.count() / readings.count() == pytest.approx(0.8, abs=0.02)


def test_summary_counts(readings, scored):
    row = reports.data_summary(readings, scored, 22).first()
    assert row.total_records == readings.count()
    assert row.train_records + row.test_records == scored.count()
    assert (row.features_count, row.zones_count) == (22, 5)


def test_filters(scored):
    zones = {r.zone for r in serving.filter_predictions(scored, zone="ZONE south").select("zone").distinct().collect()}
    assert zones == {"Zone_South"}
    assert serving.filter_predictions(scored, zone="zone").count() == scored.count()
    assert serving.filter_predictions(scored).count() == scored.count()
    slug = serving.filter_predictions(scored, category="sensitive").select("aqi_category").distinct().collect()
    assert [r[0] for r in slug] == ["Unhealthy for Sensitive Groups"]
    label = serving.filter_predictions(scored, category="Good")
    assert label.count() == serving.filter_predictions(scored, category="good").count() > 0
    assert serving.filter_predictions(scored, category="nothing").count() == 0


def test_pages_put_together_are_the_whole(scored):
    rows = serving.served_rows(scored).filter("zone = 'Zone_East'").cache()
    buckets = fit_order_buckets(rows)
    expected = [r.reading_id for r in rows.orderBy("datetime", "reading_id").collect()]
    size = -(-len(expected) // 3)
    paged = []
    for number in (1, 2, 3):
        part = serving.page(rows, number, size, buckets).collect()
        paged += sorted((r.datetime, r.reading_id) for r in part)
    assert [i for _, i in paged] == expected
    assert serving.page(rows, 4, size, buckets).count() == 0


def test_page_counts(scored):
    empty = scored.filter("false")
    first = serving.page_info(scored, serving.matches(), 1, 20).first()
    assert (first.total, first.pages) == (scored.count(), -(-scored.count() // 20))
    assert serving.page_info(scored, serving.matches(zone="nowhere"), 1, 20).first().pages == 1
    assert serving.page_info(empty, serving.matches(), 1, 20).first().pages == 0


def test_csv_round_trip(spark, tmp_path, readings):
    path = str(tmp_path / "readings")
    text = F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime")
    names = [f.name for f in src.CSV_SCHEMA][1:]
    readings.select(text, *names).write.csv(path, header=True)
    back = src.read_readings(spark, path)
    assert dict(back.dtypes)["datetime"] == "timestamp_ntz" and dict(back.dtypes)["reading_id"] == "bigint"
    assert back.count() == readings.count() == back.select("reading_id").distinct().count()
    assert back.select("pm10", "rain").exceptAll(readings.select("pm10", "rain")).count() == 0
    assert reports.hourly_pattern(back).count() == 24
    inferred = src.read_readings(spark, path, infer=True)
    assert dict(inferred.dtypes)["datetime"].startswith("timestamp")
    src.register(back, "air")
    assert spark.sql("SELECT count(*) FROM air").first()[0] == readings.count()


@pytest.mark.parametrize("profile", ["full", "lite"])
@pytest.mark.parametrize("keyed", [True, False])
def test_csv_goes_through_all_features(spark, tmp_path, readings, profile, keyed):
    path = str(tmp_path / "readings")
    text = F.date_format("datetime", "yyyy-MM-dd HH:mm:ss").alias("datetime")
    keys = ["reading_id"] if keyed else []
    readings.select(text, *[f.name for f in src.CSV_SCHEMA][1:], *keys).write.csv(path, header=True)
    frame = pipeline.features(src.read_readings(spark, path), profile)
    expected = pipeline.features(readings, profile)
    assert frame.count() == expected.count()
    if keyed:
        columns = ["reading_id", "zone", "aqi_category", "hour", "pm25_lag1"]
        rounded = [F.round("pm25_lag1", 6) if c == "pm25_lag1" else F.col(c) for c in columns]
        assert frame.select(*rounded).exceptAll(expected.select(*rounded)).count() == 0


def test_export_writes_all_rows(spark):
    many = spark.range(12_345).select("id", *[F.lit(1.0).alias(c) for c in sinks.EXPORT_COLUMNS])
    assert sinks.predictions_export(many).count() == 12_345


def test_large_event_ids(spark):
    events = spark.sql("SELECT id * 4000000 AS event_id, timestamp_ntz'2024-05-01 10:20:30.5' AS ts, 'a' AS event_type,"
                       " 1D AS value FROM range(5)")
    rows = src.readings_from_events(events).orderBy("reading_id").collect()
    for i, row in enumerate(rows):
        day = datetime(2024, 5, 1, 10, 20, 30) + timedelta(days=i * 4_000_000 % 366)
        assert (row.reading_id, row.datetime) == (i * 4_000_000, day)


def test_a_scan_reads_only_what_it_needs(spark, tmp_path, readings):
    path = str(tmp_path / "table")
    readings.write.parquet(path)
    stored = spark.read.parquet(path)
    plan = reports.exceedances(stored).select("pm25")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<pm25:double>" in plan
    assert "PushedFilters: [IsNotNull(pm25), GreaterThan(pm25,50.0)]" in plan


def test_sinks(spark, tmp_path, scored):
    predictions, zones = str(tmp_path / "predictions"), str(tmp_path / "zones")
    sinks.write_predictions(scored, predictions, limit=100)
    back = spark.read.csv(predictions, header=True, inferSchema=True)
    assert tuple(back.columns) == sinks.EXPORT_COLUMNS and back.count() == 100
    sinks.write_zone_risk(scored, zones)
    assert spark.read.csv(zones, header=True).count() == 5
    sinks.write_report({"a": reports.category_distribution(scored)}, str(tmp_path / "report"))
    assert spark.read.parquet(str(tmp_path / "report" / "a")).count() > 0
