"""Cleaning, imputation and profiling."""

from __future__ import annotations

import math

import pytest

from envspark.operators import quality
from envspark.profiles import MEASURES, POLLUTANTS

NAN = float("nan")
SCHEMA = "reading_id long, pm25 double, pm10 double, no2 double, co double, so2 double, o3 double, temp double"


@pytest.fixture(scope="module")
def edge_rows(spark):
    return spark.createDataFrame([
        (1, 10.0, 10.0, 1.0, 1.0, 1.0, 1.0, -1.0),
        (2, -999.0, 20.0, 1.0, 1.0, 1.0, 1.0, 5.0),
        (3, NAN, 30.0, 1.0, 1.0, 1.0, 1.0, 7.0),
        (4, None, 40.0, 1.0, 1.0, 1.0, 1.0, NAN),
        (5, -5.0, 50.0, 1.0, 1.0, 1.0, 1.0, -1.0),
        (6, 40.0, 60.0, 1.0, 1.0, 1.0, 1.0, 9.0),
    ], SCHEMA)


def column(df, name):
    return [r[0] for r in df.orderBy("reading_id").select(name).collect()]


def test_sentinels_and_nan_become_null(edge_rows):
    cleaned = quality.nullify_sentinels(edge_rows)
    assert column(cleaned, "pm25") == [10.0, None, None, None, -5.0, 40.0]
    assert column(cleaned, "temp") == [None, 5.0, 7.0, None, None, 9.0]


def test_a_column_can_have_its_own_sentinels(edge_rows):
    cleaned = quality.nullify_sentinels(edge_rows, overrides={"temp": (-999.0,)})
    assert column(cleaned, "temp") == [-1.0, 5.0, 7.0, None, -1.0, 9.0]


def test_means_are_taken_after_sentinels_are_gone(edge_rows):
    imputed = quality.impute_mean(quality.nullify_sentinels(edge_rows))
    mean = (10.0 - 5.0 + 40.0) / 3
    assert column(imputed, "pm25") == pytest.approx([10.0, mean, mean, mean, -5.0, 40.0])


def test_lite_imputation_lets_sentinels_and_nan_into_the_mean(edge_rows):
    assert all(math.isnan(v) for v in column(quality.impute_mean(edge_rows), "pm25")[2:4])
    without_nan = edge_rows.filter("reading_id != 3")
    mean = (10.0 - 999.0 - 5.0 + 40.0) / 4
    assert column(quality.impute_mean(without_nan), "pm25")[2] == pytest.approx(mean)


def test_an_empty_column_stays_null(spark):
    rows = spark.createDataFrame([(1, None)], "reading_id long, pm25 double")
    assert column(quality.impute_mean(rows), "pm25") == [None]


def test_funnel_adds_up(edge_rows):
    imputed = quality.impute_mean(quality.nullify_sentinels(edge_rows))
    funnel = quality.quality_funnel(imputed).first()
    assert (funnel.rows_before, funnel.rows_after, funnel.rows_removed) == (6, 5, 1)
    assert quality.filter_valid(imputed).count() == funnel.rows_after
    assert 5 not in column(quality.filter_valid(imputed), "reading_id")


def test_null_pollutants_are_not_valid(edge_rows):
    assert column(quality.filter_valid(quality.nullify_sentinels(edge_rows)), "reading_id") == [1, 6]


def test_missing_profile(edge_rows):
    got = {r.column: r for r in quality.missing_profile(edge_rows).collect()}
    assert set(got) == {"pm25", "temp"}
    assert (got["pm25"].null_count, got["pm25"].special_missing, got["pm25"].total_missing) == (2, 1, 3)
    assert got["pm25"].missing_pct == pytest.approx(50.0)
    assert got["temp"].special_missing == 2
    assert quality.missing_profile(edge_rows.filter("false")).count() == 0


def test_profiles_read_the_table_once(readings):
    for frame in (quality.missing_profile(readings), quality.range_profile(readings),
                  quality.describe_long(readings)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Aggregate") == 1, plan


def test_ranges_of_an_empty_frame(readings):
    nothing = readings.filter("reading_id < 0")
    assert all(r.min is None for r in quality.range_profile(nothing).collect())
    assert all((r.mean, r.min, r.max) == (0.0, 0.0, 0.0) for r in quality.pollutant_stats(nothing).collect())


def test_describe_agrees_with_spark(readings):
    ours = {r.column: r for r in quality.describe_long(readings).collect()}
    theirs = {r.summary: r for r in readings.select(*MEASURES).describe().collect()}
    for m in MEASURES:
        for stat in ("count", "mean", "stddev", "min", "max"):
            expected, got = float(theirs[stat][m]), float(getattr(ours[m], stat) if stat != "count" else ours[m]["count"])
            assert (math.isnan(expected) and math.isnan(got)) or got == pytest.approx(expected, rel=1e-12)


def test_stateless_stages_accept_a_stream(spark, tmp_path, readings):
    """Sentinels, validity, index and calendar need no state."""
    from envspark.operators import features as ft

    path = str(tmp_path / "in")
    readings.write.parquet(path)
    stream = spark.readStream.schema(readings.schema).parquet(path)
    scored = ft.with_calendar(ft.with_index(quality.filter_valid(quality.nullify_sentinels(stream)), "full"), "full")
    query = (scored.select("reading_id", "aqi").writeStream.format("memory").queryName("scored")
             .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    expected = ft.with_index(quality.filter_valid(quality.nullify_sentinels(readings)), "full")
    assert spark.table("scored").exceptAll(expected.select("reading_id", "aqi")).count() == 0
    assert spark.table("scored").count() == expected.count() > 0
    assert set(POLLUTANTS) <= set(scored.columns)
