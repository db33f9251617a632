"""Stored days, page tokens, counts in flight, SQL text and sketches."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from envspark.operators import quality, quantiles, reports, serving
from envspark.operators.windows import fit_order_buckets
from envspark.plans import analysis, pipeline, sql_text
from envspark.sources.stored import read_days, store_by_day

from conftest import SMALL


def series(spark, n=400):
    """Readings of four days, some at the same time, some without a time."""
    day = F.to_timestamp_ntz(F.lit("2024-03-01 00:00:00"))
    time = day + F.make_dt_interval(F.col("id") % 4, F.col("id") % 24)
    return spark.range(n).select(F.col("id").alias("reading_id"), F.when(F.col("id") % 41 != 0, time).alias("datetime"),
                                 (F.col("id") % 90).cast("double").alias("pm25"))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def bytes_read(df):
    """Size of the files that a frame without shuffles reads."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("filesSize").value() for i in range(leaves.size()))


def test_a_rerun_replaces_its_days_only(spark, tmp_path):
    path, rows = str(tmp_path / "days"), series(spark)
    store_by_day(rows, path)
    again = rows.filter(F.to_date("datetime") == F.lit(dt.date(2024, 3, 2))).withColumn("pm25", F.lit(-7.0)).limit(5)
    store_by_day(again, path)
    stored = {r["day"]: (r["n"], r["low"]) for r in read_days(spark, path).groupBy("day").agg(
        F.count("*").alias("n"), F.min("pm25").alias("low")).collect()}
    before = {r["day"]: r["n"] for r in rows.groupBy(F.to_date("datetime").alias("day")).agg(F.count("*").alias("n")).collect()}
    assert stored.pop(dt.date(2024, 3, 2)) == (5, -7.0)
    assert {d: n for d, (n, _) in stored.items()} == {d: n for d, n in before.items() if d != dt.date(2024, 3, 2)}
    with pytest.raises(ValueError):
        store_by_day(rows.withColumn("day", F.lit(1)), path)


def test_a_span_of_days_reads_only_its_files(spark, tmp_path):
    path = str(tmp_path / "days")
    store_by_day(series(spark), path)
    span = reports.exceedances(read_days(spark, path, dt.date(2024, 3, 2), dt.date(2024, 3, 3)))
    plan = plan_of(span)
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThan(pm25,50.0)" in plan
    whole = reports.exceedances(read_days(spark, path))
    assert 0 < bytes_read(span) < 0.6 * bytes_read(whole)
    wanted = series(spark).filter("pm25 > 50 AND to_date(datetime) BETWEEN date'2024-03-02' AND date'2024-03-03'")
    assert sorted(span.drop("day").collect()) == sorted(wanted.collect())


@pytest.mark.parametrize("per_page", [1, 7, 150, 1000])
def test_tokens_walk_every_row_once(spark, tmp_path, per_page):
    n = 40 if per_page == 1 else 400
    rows = series(spark, n)
    ordered = [r.reading_id for r in rows.orderBy("datetime", "reading_id").collect()]
    kept = rows.cache()
    seen, token = [], None
    while True:
        page = serving.page_after(kept, token, per_page).collect()
        assert [r.reading_id for r in page] == ordered[len(seen):len(seen) + per_page]
        if not page:
            break
        seen += [r.reading_id for r in page]
        token = serving.token_of(page[-1].datetime, page[-1].reading_id)
    assert seen == ordered
    kept.unpersist()


def test_a_deep_page_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "days")
    store_by_day(series(spark), path)
    stored = read_days(spark, path)
    token = serving.next_token(serving.page(stored.drop("day"), 30, 10, fit_order_buckets(stored)))
    page = serving.page_after(stored, token, 10, day="day")
    plan = plan_of(page)
    assert "GreaterThanOrEqual(datetime" in plan and "PartitionFilters: [isnotnull(day" in plan
    assert "TakeOrderedAndProject" in plan
    offset = serving.page(stored, 31, 10, fit_order_buckets(stored)).orderBy("datetime", "reading_id")
    assert [r.reading_id for r in page.collect()] == [r.reading_id for r in offset.collect()]
    assert serving.next_token(page.limit(0)) is None
    for wrong in ("", "x", "bm9wZQ==", "WzFd"):
        with pytest.raises(ValueError):
            serving.behind(wrong)


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, "")
    try:
        result = action()
        return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_counts_come_from_the_writing_job(spark, readings, tmp_path):
    _, jobs_plain = jobs_of(spark, "plain", lambda: pipeline.indexed(readings).write.parquet(str(tmp_path / "plain")))
    seen = Observation()
    _, jobs = jobs_of(spark, "seen", lambda: pipeline.indexed(readings, "full", seen).write.parquet(str(tmp_path / "seen")))
    assert jobs <= jobs_plain
    cleaned = quality.impute_mean(quality.nullify_sentinels(readings))
    assert quality.observed_funnel(seen) == quality.quality_funnel(cleaned).first().asDict()


def test_a_stored_run(spark, readings, tmp_path):
    bundle, counts = analysis.run_stored(readings, str(tmp_path / "run"), "lite")
    assert len(bundle) == 8
    data = bundle["data"].first()
    assert (data.train_records, data.test_records) == (counts["train_records"], counts["test_records"])
    assert round(counts["avg_aqi"], 2) == data.avg_aqi
    assert counts["rows_before"] == readings.count() == data.total_records
    with analysis.run_all(readings, "lite") as kept:
        # the forests see their rows in another order; what does not depend on them is equal
        assert kept["category_distribution"].collect() == bundle["category_distribution"].collect()
        assert kept["pollutant_stats"].count() == bundle["pollutant_stats"].count() == 6
        assert [(r.zone, r.num_records) for r in kept["zones"].orderBy("zone").collect()] == [
            (r.zone, r.num_records) for r in bundle["zones"].orderBy("zone").collect()]


def test_kept_rows_are_released(spark, readings):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with analysis.run_all(readings, "lite") as bundle:
        assert bundle["zones"].count() > 0
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == before + 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_sql_text_equals_the_operators_and_leaves_no_names(spark, readings):
    before = {t.name for t in spark.catalog.listTables()}
    assert repr(sql_text.basic_stats(readings).collect()) == repr(reports.basic_stats(readings).collect())
    assert repr(sql_text.hourly_pattern(readings).collect()) == repr(reports.hourly_pattern(readings).collect())
    buckets = fit_order_buckets(readings, buckets=9)
    found = sql_text.rolling_mean(readings, buckets)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, reports.rolling_global(readings, buckets).collect()))
    assert "hashpartitioning(_bucket" in plan_of(found)  # rows are dealt by bucket, only their bounded tails meet
    assert {t.name for t in spark.catalog.listTables()} == before
    with pytest.raises(Exception):
        sql_text.run_text(spark, "SELECT nothing FROM IDENTIFIER(:readings)", {"readings": readings})
    assert {t.name for t in spark.catalog.listTables()} == before


def test_merged_sketches_keep_their_rank_error(spark):
    rows = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 2).alias("half"),
                                      F.when(F.col("id") % 97 != 0, F.pow(F.col("id") % 9973, F.lit(1.7))).alias("v"))
    daily = quantiles.quantile_sketches(rows, ["day", "half"], "v")
    names = {"p01": 0.01, "q1": 0.25, "median": 0.5, "p99": 0.99}
    found = quantiles.sketched_quantiles(quantiles.merged_sketches(daily, ["half"]), ["half"], names).collect()
    values = {h: sorted(r.v for r in rows.filter(F.col("half") == h).collect() if r.v is not None) for h in (0, 1)}
    for r in found:
        own = values[r.half]
        assert r.n == len(own)
        for name, p in names.items():
            below, upto = sum(v < r[name] for v in own) / len(own), sum(v <= r[name] for v in own) / len(own)
            assert below - quantiles.SKETCH_ERROR <= p <= upto + quantiles.SKETCH_ERROR
    nothing = rows.filter("v IS NULL")
    assert quantiles.merged_sketches(quantiles.quantile_sketches(nothing, ["day"], "v"), ["day"]).collect() == []
