"""Bucketed windows and quantiles against plain windows and numpy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from envspark.operators import features as ft
from envspark.operators import quantiles, reports
from envspark.operators.windows import BUCKET, fit_order_buckets, numbered, time_key, windowed
from envspark.plans import pipeline
from envspark.profiles import LAG_FEATURES

COLUMNS = {
    "lag1": lambda w: F.lag("pm25", 1).over(w),
    "lag3": lambda w: F.lag("pm10", 3).over(w),
    "mean4": lambda w: F.avg("pm10").over(w.rowsBetween(-3, 0)),
    "ids": lambda w: F.collect_list("reading_id").over(w.rowsBetween(-3, -1)),
}
HOT = "TIMESTAMP_NTZ'2024-02-01 00:00:00'"
NEXT_TO_HOT = "TIMESTAMP_NTZ'2024-02-01 00:00:00.000001'"


@pytest.fixture(scope="module")
def shapes(readings):
    base = readings.select("reading_id", "datetime", "pm25", "pm10",
                           F.concat(F.lit("z"), F.col("reading_id") % 3).alias("zone"))
    third = base.withColumn("datetime", F.expr(
        f"CASE WHEN reading_id % 3 = 0 THEN {HOT} WHEN reading_id % 7 = 0 THEN {NEXT_TO_HOT}"
        " WHEN reading_id = 500 THEN NULL ELSE datetime END"))
    return {
        "even": base,
        "hot timestamp": third,
        "missing timestamps": base.withColumn("datetime", F.expr(
            "CASE WHEN reading_id % 3 != 0 THEN datetime END")),
        "no timestamps": base.withColumn("datetime", F.lit(None).cast("timestamp_ntz")),
        "one timestamp": base.withColumn("datetime", F.expr(HOT)),
        "hot zone": base.withColumn("zone", F.when(F.col("reading_id") < 900, "a").otherwise("b")),
        "rare zones": base.withColumn("zone", F.concat(F.lit("z"), F.col("reading_id") % 400)),
        "one row": base.filter("reading_id = 1"),
        "empty": base.filter("reading_id < 0"),
    }


@pytest.mark.parametrize("shape", ["even", "hot timestamp", "missing timestamps", "no timestamps", "one timestamp",
                                   "hot zone", "rare zones", "one row", "empty"])
@pytest.mark.parametrize("by", [["zone"], []])
def test_bucketed_windows_equal_plain_windows(shapes, shape, by):
    df = shapes[shape]
    plain = Window.partitionBy(*by, F.lit(0)).orderBy("datetime", "reading_id")
    expected = df.withColumns({n: make(plain) for n, make in COLUMNS.items()})
    for count in (2, 60):
        got = windowed(df, COLUMNS, fit_order_buckets(df, buckets=count), by, back=3, uses=["pm25", "pm10"])
        assert got.columns == expected.columns
        assert got.count() == expected.count()
        assert got.exceptAll(expected).count() == 0, (shape, by, count)


@pytest.mark.parametrize("shape", ["even", "hot timestamp", "missing timestamps", "no timestamps", "one timestamp"])
def test_no_bucket_is_hot(shapes, shape):
    df = shapes[shape]
    total, buckets = df.count(), fit_order_buckets(df, buckets=20)
    sizes = buckets.assign(df).groupBy(BUCKET).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 3 * total / 20
    assert sizes[1] <= 60


@pytest.mark.parametrize("shape", ["even", "hot timestamp", "missing timestamps", "no timestamps", "one timestamp"])
def test_bucket_numbers_follow_the_order(shapes, shape):
    df = shapes[shape]
    rows = fit_order_buckets(df, buckets=30).assign(df)
    order = Window.partitionBy(F.lit(0)).orderBy("datetime", "reading_id")
    assert rows.withColumn("p", F.lag(BUCKET).over(order)).filter(F.col("p") > F.col(BUCKET)).count() == 0


TWO_LEVELS = ["even", "hot timestamp", "missing timestamps", "no timestamps", "one timestamp", "one row", "empty"]


@pytest.mark.parametrize("shape", TWO_LEVELS)
def test_cuts_of_two_levels(shapes, shape):
    """More buckets than the driver has cuts for: equal results, buckets in order, none of them hot."""
    df = shapes[shape]
    buckets = fit_order_buckets(df, buckets=40, coarse=5)
    assert len(buckets.time_cuts) + len(buckets.fine_cuts) <= 20
    assert (buckets.table is None) == (shape == "empty")
    plain = Window.partitionBy("zone").orderBy("datetime", "reading_id")
    expected = df.withColumns({n: make(plain) for n, make in COLUMNS.items()})
    got = windowed(df, COLUMNS, buckets, ["zone"], back=3, uses=["pm25", "pm10"])
    assert got.columns == expected.columns and got.count() == expected.count()
    assert got.exceptAll(expected).count() == 0
    rows = buckets.assign(df)
    order = Window.partitionBy(F.lit(0)).orderBy("datetime", "reading_id")
    assert rows.withColumn("p", F.lag(BUCKET).over(order)).filter(F.col("p") > F.col(BUCKET)).count() == 0
    if df.count() > 1:
        sizes = rows.groupBy(BUCKET).count().agg(F.max("count"), F.count("*")).first()
        assert sizes[0] <= 4 * df.count() / 40 and 20 <= sizes[1] <= 160
        found = numbered(df, buckets, "n", 100, 140).select("reading_id", "n")
        whole = df.withColumn("n", F.row_number().over(order)).filter("n BETWEEN 100 AND 140")
        assert sorted(found.collect()) == sorted(whole.select("reading_id", "n").collect())


def test_many_hourly_rows_of_two_levels(spark):
    """Many rows per timestamp, as of many stations: buckets within one timestamp are cut by the tie-breaker."""
    hour = F.to_timestamp_ntz(F.lit("2024-03-01 00:00:00")) + F.make_dt_interval(F.lit(0), F.floor(F.col("id") / 5000))
    df = spark.range(40_000).select(F.col("id").alias("reading_id"), hour.alias("datetime"))
    buckets = fit_order_buckets(df, buckets=100, coarse=4)
    sizes = buckets.assign(df).groupBy(BUCKET).count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= 1600 and sizes[1] >= 60


def test_cuts_of_one_frame_serve_another(shapes):
    """Cuts fitted on a small part still give exact results on the whole."""
    df = shapes["hot timestamp"]
    buckets = fit_order_buckets(df.filter("reading_id % 10 = 3"), buckets=8)
    plain = Window.partitionBy("zone").orderBy("datetime", "reading_id")
    expected = df.withColumns({n: make(plain) for n, make in COLUMNS.items()})
    got = windowed(df, COLUMNS, buckets, ["zone"], back=3, uses=["pm25", "pm10"])
    assert got.exceptAll(expected).count() == 0


def test_no_stage_gathers_the_data(spark, readings):
    """The shuffle of the rows is by zone and bucket; only the bounded tails meet by zone."""
    framed = ft.add_lags(ft.assign_zone(readings), [("pm25", 1)])
    plan = framed._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert "hashpartitioning(zone" in plan and BUCKET in plan
    assert "WindowGroupLimit" in plan


@pytest.mark.parametrize("profile", ["full", "lite"])
def test_features_do_not_depend_on_partitioning(readings, profile):
    results = []
    for parts in (1, 4, 13):
        frame = pipeline.features(readings.repartition(parts), profile)
        results.append(sorted(frame.select("reading_id", "zone", "aqi_category", *[
            F.round(c, 6).alias(c) for c in ("aqi", *LAG_FEATURES)]).collect()))
    assert str(results[0]) == str(results[1]) == str(results[2])


def test_first_rows_of_a_zone_have_no_history(readings):
    base = pipeline.indexed(readings, "full")
    history = ft.add_history(base, "full")
    assert history.filter("aqi_lag1 IS NULL").count() == 5
    assert history.filter("pm25_lag3 IS NULL").count() == 15
    mean = base.agg(F.avg("aqi")).first()[0]
    filled = ft.fill_lags(history, "mean", means_of=base)
    assert filled.filter(F.abs(F.col("aqi_lag1") - mean) < 1e-9).count() >= 5
    assert ft.fill_lags(history, "zero").filter("aqi_lag1 = 0").count() == 5
    with pytest.raises(ValueError):
        ft.fill_lags(history, "median")


def test_rolling_frames_end_at_the_current_row(readings):
    with pytest.raises(ValueError):
        ft.add_rolling(readings, "pm25", -1, 1, "x", by=())


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_time_keys_over_centuries(spark, kind):
    texts = ["1890-01-01 00:00:00", "1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2024-03-10 02:30:00",
             "2024-03-10 03:00:00", "2024-03-10 03:00:00.000001", "2100-06-01 12:00:00", "2250-01-01 00:00:00"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", F.col("t").cast(kind).alias("t"))
    keys = [r.k for r in rows.select("i", time_key(rows, "t").alias("k")).orderBy("i").collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    assert keys[2] == 0.0 and keys[1] == -1.0 and keys[5] - keys[4] == 1.0


@pytest.mark.parametrize("shape", ["even", "hot timestamp", "missing timestamps"])
def test_row_numbers(shapes, shape):
    df = shapes[shape]
    buckets = fit_order_buckets(df, buckets=25)
    expected = [r.reading_id for r in df.orderBy("datetime", "reading_id").collect()]
    every = [r.reading_id for r in numbered(df, buckets, "n").orderBy("n").collect()]
    assert every == expected
    some = numbered(df, buckets, "n", 401, 450).orderBy("n").collect()
    assert [r.reading_id for r in some] == expected[400:450]
    assert [r.n for r in some] == list(range(401, 451))
    assert numbered(df, buckets, "n", len(expected) + 1, len(expected) + 9).count() == 0


@pytest.mark.parametrize("buckets", [1, 2, 40])
def test_exact_quantiles(spark, buckets):
    generator = np.random.default_rng(3)
    data = {"a": generator.normal(50, 20, 3001), "b": np.r_[np.full(900, 7.0), generator.uniform(0, 9, 100)],
            "c": np.array([4.0]), "d": np.array([1.0, 2.0])}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None), ("b", float("nan")), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = quantiles.exact_quantiles(df, "g", "v", probabilities, buckets).collect()
    data[None] = np.array([3.0])
    assert len(got) == len(data) * len(probabilities)
    for r in got:
        assert r["quantile"] == pytest.approx(np.quantile(data[r.g], r.probability), abs=1e-12), r


def test_approximate_quartiles_are_close(readings):
    frame = ft.with_calendar(pipeline.indexed(readings), "full")
    exact = {r.season: r for r in quantiles.seasonal_quartiles(frame).collect()}
    for r in quantiles.seasonal_quartiles(frame, approximate=True).collect():
        assert r.median == pytest.approx(exact[r.season].median, abs=2.0)


def test_rolling_over_everything_needs_no_single_task(readings):
    rolled = reports.rolling_global(readings)
    known = readings.filter("pm25 IS NOT NULL")
    plain = Window.partitionBy(F.lit(0)).orderBy("datetime", "reading_id").rowsBetween(-3, 0)
    expected = known.select("reading_id", "datetime", "pm25",
                            F.round(F.avg("pm25").over(plain), 2).alias("rolling_avg_pm25"))
    assert rolled.exceptAll(expected).count() == 0 and rolled.count() == expected.count()
