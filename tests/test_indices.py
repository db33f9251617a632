"""Index, category and risk expressions against values worked out by hand."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from envspark.functions import indices, temporal
from envspark.operators import features as ft
from envspark.profiles import CATEGORY_BANDS, GAPPED_PM25_BANDS, POLLUTANTS

NAN = float("nan")


def values(spark, profile, pollutant, inputs):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, {pollutant} double")
    scored = rows.select("i", indices.sub_index(pollutant, profile).alias("v")).orderBy("i").collect()
    return [r.v for r in scored]


# (pollutant, concentration, full, lite)
CASES = [
    ("pm25", 15.0, 56.41025641025641, 56.41025641025641),
    ("pm25", 0.0, 0.0, 0.0), ("pm25", 12.0, 50.0, 50.0), ("pm25", 35.4, 100.0, 100.0),
    ("pm25", 55.4, 150.0, 150.0), ("pm25", 150.4, 200.0, 200.0), ("pm25", 250.4, 300.0, 300.0),
    ("pm25", 350.4, 400.0, 380.0), ("pm25", 500.4, 500.0, 500.0), ("pm25", 926.1, 783.8, 500.0),
    ("pm25", None, 0.0, 500.0), ("pm25", -999.0, -4162.5, -4162.5),
    ("pm10", 54.0, 50.0, 50.0), ("pm10", 154.0, 100.0, 100.0), ("pm10", 254.0, 150.0, 150.0),
    ("pm10", 354.0, 200.0, 200.0), ("pm10", 424.0, 300.0, 300.0), ("pm10", 604.0, 500.0, 500.0),
    ("pm10", 784.0, 700.0, 700.0), ("pm10", None, 0.0, None),
    ("o3", 54.0, 50.0, 50.0), ("o3", 70.0, 100.0, 100.0), ("o3", 85.0, 150.0, 150.0),
    ("o3", 105.0, 200.0, 200.0), ("o3", 200.0, 300.0, 300.0), ("o3", None, 0.0, None),
    ("no2", 53.0, 50.0, 50.0), ("no2", 100.0, 100.0, 100.0), ("no2", 360.0, 150.0, 150.0),
    ("no2", 649.0, 200.0, 205.57692307692307), ("no2", None, 0.0, None),
    ("so2", 35.0, 50.0, 50.0), ("so2", 75.0, 100.0, 100.0), ("so2", 185.0, 150.0, 150.0),
    ("so2", 304.0, 200.0, 204.0909090909091), ("so2", None, 0.0, None),
    ("co", 4.4, 50.0, 50.0), ("co", 9.4, 100.0, 100.0), ("co", 12.4, 150.0, 150.0),
    ("co", 15.4, 200.0, 200.0), ("co", 18.4, 250.0, 250.0), ("co", None, 0.0, None),
]


@pytest.mark.parametrize("profile,column", [("full", 2), ("lite", 3)])
def test_sub_indices_at_every_edge(spark, profile, column):
    for pollutant in POLLUTANTS:
        cases = [c for c in CASES if c[0] == pollutant]
        for case, got in zip(cases, values(spark, profile, pollutant, [c[1] for c in cases])):
            expected = case[column]
            assert got == expected if expected is None else got == pytest.approx(expected, abs=1e-9), case


@pytest.mark.parametrize("profile", ["full", "lite"])
def test_sub_indices_are_continuous_and_rise(spark, profile):
    for pollutant in POLLUTANTS:
        steps = [i * 0.5 for i in range(1001)]
        got = values(spark, profile, pollutant, steps)
        assert all(b >= a for a, b in zip(got, got[1:])), pollutant
        edges = sorted({c[1] for c in CASES if c[0] == pollutant and c[1] is not None and 0 < c[1] < 500})
        for edge, below, above in zip(edges, values(spark, profile, pollutant, [e - 1e-9 for e in edges]),
                                      values(spark, profile, pollutant, [e + 1e-9 for e in edges])):
            assert abs(above - below) < 1e-6, (pollutant, edge)


def test_nan_reaches_the_open_end(spark):
    assert math.isnan(values(spark, "full", "pm25", [NAN])[0])
    assert values(spark, "lite", "pm25", [NAN]) == [500.0]
    assert math.isnan(values(spark, "lite", "no2", [NAN])[0])


def test_overall_index_skips_null_and_is_the_largest(spark, readings):
    rows = ft.with_index(readings, "lite").select("aqi", *[f"aqi_{p}" for p in POLLUTANTS])
    worst = rows.filter(" OR ".join(f"aqi < aqi_{p}" for p in POLLUTANTS)).count()
    assert worst == 0
    assert rows.filter("aqi_o3 IS NULL AND aqi IS NOT NULL").count() > 0


def test_categories(spark):
    inputs = [(0.0, "Good"), (50.0, "Good"), (50.0001, "Moderate"), (100.0, "Moderate"),
              (150.0, "Unhealthy for Sensitive Groups"), (200.0, "Unhealthy"), (200.5, "Very Unhealthy"),
              (300.0, "Very Unhealthy"), (300.0001, "Hazardous"), (900.0, "Hazardous"), (None, "Hazardous")]
    rows = spark.createDataFrame(inputs, "x double, expected string")
    wrong = rows.filter(indices.category(F.col("x")) != F.col("expected")).collect()
    assert wrong == []


def test_category_lookup_agrees_with_the_expression(spark):
    rows = spark.createDataFrame([(float(x) / 2,) for x in range(0, 1400)] + [(None,)], "x double")
    joined = ft.categorize_by_table(rows, "x", CATEGORY_BANDS)
    assert joined.count() == 1401
    assert joined.filter(F.col("x").isNotNull() & (F.col("category") != indices.category(F.col("x")))).count() == 0
    assert joined.filter("x IS NULL AND category IS NULL").count() == 1
    assert "Join" not in joined._jdf.queryExecution().executedPlan().toString()


def test_category_lookup_with_gaps_and_overlaps(spark):
    rows = spark.createDataFrame([(x,) for x in (0.0, 1.0, 1.5, 2.0, 2.5, 3.0, 9.0, float("nan"), None)], "x double")
    bands = [("b", 2.0, 3.0), ("a", 0.0, 1.0), ("top", 8.0, float("inf"))]
    got = [r.category for r in ft.categorize_by_table(rows, "x", bands).collect()]
    assert got == [None, "a", None, None, "b", "b", "top", None, None]
    with pytest.raises(ValueError, match="overlap"):
        ft.categorize_by_table(rows, "x", [("a", 0.0, 2.0), ("b", 1.0, 3.0)])


def test_gapped_table_sends_gaps_beyond_the_scale(spark):
    rows = spark.createDataFrame([(12.0,), (12.05,), (12.1,), (500.4,), (600.0,), (None,)], "x double")
    got = [r.v for r in rows.select(indices.interpolate(F.col("x"), GAPPED_PM25_BANDS).alias("v")).collect()]
    assert got == [50.0, 500.0, 51.0, 500.0, 500.0, None]
    free = rows.select(indices.interpolate(F.col("x"), GAPPED_PM25_BANDS, beyond=None).alias("v")).collect()
    assert [r.v for r in free] == [50.0, None, 51.0, 500.0, None, None]


def test_risk_levels_of_the_published_zone_table(spark):
    published = [125.16, 124.79, 124.1, 124.0, 123.55]
    edges = [(200.01, "CRITICAL"), (200.0, "HIGH"), (150.0, "MODERATE"), (100.0, "LOW"), (50.0, "MINIMAL"),
             (None, "MINIMAL")] + [(x, "MODERATE") for x in published]
    rows = spark.createDataFrame(edges, "x double, expected string")
    assert rows.filter(indices.risk_level(F.col("x")) != F.col("expected")).count() == 0


def test_zones(spark):
    rows = spark.createDataFrame(
        [(0, 10.0, "Zone_North", "Zone_North"), (1, 11.0, "Zone_South", "Zone_South"),
         (2, 11.5, "Zone_East", "Zone_Central"), (3, None, "Zone_West", "Zone_Central"),
         (4, -5.0, "Zone_Central", "Zone_North"), (-1, -4.0, "Zone_Central", "Zone_Central"),
         (8, NAN, "Zone_West", "Zone_Central")],
        "reading_id long, pm25 double, by_id string, by_value string")
    assert ft.assign_zone(rows, "id").filter("zone != by_id").count() == 0
    assert ft.assign_zone(rows, "value").filter("zone != by_value").count() == 0
    with pytest.raises(ValueError):
        ft.assign_zone(rows, "name")


def test_timestamps_do_not_raise(spark):
    rows = spark.createDataFrame([("2024-02-29 23:00:00",), ("2024-02-30 23:00:00",), ("garbage",), (None,),
                                  ("2024-03-10 02:30:00",), ("2024-01-01",)], "datetime string")
    strict = [str(r.timestamp) if r.timestamp else None for r in temporal.with_timestamp(rows).collect()]
    assert strict == ["2024-02-29 23:00:00", None, None, None, "2024-03-10 02:30:00", None]
    loose = temporal.with_timestamp(rows, strict=False).collect()
    assert str(loose[-1].timestamp) == "2024-01-01 00:00:00"


def test_calendar_and_cycle(spark):
    rows = spark.createDataFrame([("2024-01-07 06:00:00",)], "datetime string")
    full = ft.with_calendar(rows, "full").first()
    assert (full.hour, full.day_of_week, full.month, full.year) == (6, 1, 1, 2024)
    assert full.hour_sin == pytest.approx(math.sin(2 * 3.14159 * 6 / 24), abs=1e-12)
    lite = ft.with_calendar(rows, "lite")
    assert "year" not in lite.columns
    assert lite.first().hour_cos == pytest.approx(math.cos(math.pi / 2), abs=1e-12)
