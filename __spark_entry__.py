"""

``entry`` is the flagship query, ``queries`` has one entry per operator and
``oracle_sql`` the same results as SQL text over the same Parquet tables.
Queries that consume a prediction run on the persistence prediction (the
previous index of the zone), which SQL can reproduce; the random-forest queries
have no SQL equivalent.

Values that come out of floating-point sums are rounded to 4 or 6 digits, since
their last bits depend on the order of summation.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Sequence
from datetime import timedelta
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envspark.functions import indices, temporal
from envspark.ml import forecast as fc
from envspark.ml import forest, nodes
from envspark.operators import bands as bd
from envspark.operators import features as ft
from envspark.operators import quality, quantiles, reports, serving
from envspark.operators.windows import fit_order_buckets
from envspark.plans import analysis, pipeline, sql_text
from envspark.plans.session import tune
from envspark.profiles import (CATEGORY_BANDS, FULL, GAPPED_PM25_BANDS, LAG_FEATURES, LITE, MEASURES,
                               POLLUTANTS)
from envspark.sources import csv_files
from envspark.sources import readings as src
from envspark.sources import sinks
from envspark.sources.storage import scratch_path, written
from envspark.sources.stored import read_days, store_by_day
from oracle.sql import ORACLE

try:
    import corpus_pipeline
    from envspark.llm.oracle import ORACLE as LLM_ORACLE
    from envspark.llm.queries import queries as llm_queries
except ModuleNotFoundError as missing:  # the training-data operators are optional, nothing else is
    if missing.name not in ("corpus_pipeline", "envspark.llm"):
        raise
    corpus_pipeline = None

SUB_INDICES = [f"aqi_{p}" for p in POLLUTANTS]


# --- shared inputs ----------------------------------------------------------

def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.load_readings(tune(spark), sf_dir)


def _indexed(spark, sf_dir, profile="full"):
    return pipeline.indexed(_readings(spark, sf_dir), profile)


def _features(spark, sf_dir, profile="full"):
    return pipeline.features(_readings(spark, sf_dir), profile)


def _predictions(spark, sf_dir):
    return pipeline.persistence_predictions(_readings(spark, sf_dir))


def _rounded(df: DataFrame, digits: int = 6, columns: Sequence[str] | None = None) -> DataFrame:
    """Round double columns."""
    doubles = {f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    chosen = doubles if columns is None else doubles & set(columns)
    return df.select(*[F.round(c, digits).alias(c) if c in chosen else F.col(c) for c in df.columns])


_kept: dict[str, DataFrame] = {}


def _keep(name: str, df: DataFrame) -> DataFrame:
    """Keep a narrow frame that a query reads several times, until the query is asked for again."""
    before = _kept.pop(name, None)
    if before is not None and before.sparkSession.sparkContext.applicationId == df.sparkSession.sparkContext.applicationId:
        before.unpersist()
    _kept[name] = df.persist(StorageLevel.MEMORY_AND_DISK)
    return df


_models: dict[tuple, tuple[PipelineModel, DataFrame]] = {}


def _model(spark, sf_dir, profile) -> tuple[PipelineModel, DataFrame]:
    """A model is fitted once per application, table and profile."""
    key = (spark.sparkContext.applicationId, sf_dir, profile)
    if key not in _models:
        _models[key] = analysis.train_and_score(_readings(spark, sf_dir), profile)
    return _models[key]


# --- queries ----------------------------------------------------------------

def zone_category_summary(spark, sf_dir):
    """Flagship: clean, index and categorize all readings, then summarize by zone and category."""
    return (_indexed(spark, sf_dir).groupBy("zone", "aqi_category")
            .agg(F.count("*").alias("readings"), F.round(F.avg("aqi"), 4).alias("avg_aqi"),
                 F.round(F.max("aqi"), 4).alias("max_aqi"))
            .orderBy("zone", "aqi_category"))


def repartition_count(spark, sf_dir):
    spread = src.repartition(_readings(spark, sf_dir).select("reading_id"), 20)
    sizes = spread.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count("*").alias("n"))
    return sizes.agg(F.count("*").alias("partitions"), F.sum("n").alias("total_records"))


def parse_timestamp(spark, sf_dir):
    """Readings whose datetime is text; every eleventh one is written in another format."""
    text = F.col("datetime").cast("string")
    slashed = F.translate(F.substring(text, 1, 16), "-", "/")
    raw = _readings(spark, sf_dir).select(
        "reading_id", F.when(F.col("reading_id") % 11 == 0, slashed).otherwise(text).alias("datetime"))
    return temporal.with_timestamp(raw).select("reading_id", "datetime", "timestamp")


def subindex(profile):
    def query(spark, sf_dir):
        p = FULL if profile == "full" else LITE
        cleaned = quality.clean(_readings(spark, sf_dir), p)
        return _rounded(ft.with_sub_indices(cleaned, p).select("reading_id", *SUB_INDICES))
    return query


def subindex_generic(spark, sf_dir):
    index = indices.interpolate(F.col("pm25"), GAPPED_PM25_BANDS)
    cleaned = quality.nullify_sentinels(_readings(spark, sf_dir))
    return cleaned.select("reading_id", F.round(index, 6).alias("aqi_pm25"))


def index_of(profile):
    def query(spark, sf_dir):
        return _rounded(_indexed(spark, sf_dir, profile).select("reading_id", "aqi", "aqi_category"))
    return query


def aqi_category(spark, sf_dir):
    raw = _readings(spark, sf_dir)
    return raw.select("reading_id", "pm10", indices.category(F.col("pm10")).alias("category"),
                      indices.category(F.col("o3")).alias("category_o3"))


def category_range_join(spark, sf_dir):
    frame = _indexed(spark, sf_dir).select("reading_id", "aqi")
    return _rounded(ft.categorize_by_table(frame, "aqi", CATEGORY_BANDS))


def category_by_table(spark, sf_dir):
    """The same lookup with the bands as a table."""
    table = spark.createDataFrame(list(CATEGORY_BANDS), "name string, lo double, hi double")
    return _rounded(ft.categorize_by_table(_indexed(spark, sf_dir).select("reading_id", "aqi"), "aqi", table))


def subindex_by_table(spark, sf_dir):
    """The generic index with its breakpoints as a table."""
    table = spark.createDataFrame([tuple(map(float, b)) for b in GAPPED_PM25_BANDS],
                                  "c_lo double, c_hi double, i_lo double, i_hi double")
    cleaned = quality.nullify_sentinels(_readings(spark, sf_dir)).select("reading_id", "pm25")
    return _rounded(ft.interpolate_by_table(cleaned, "pm25", table, "aqi_pm25").select("reading_id", "aqi_pm25"))


def bands_join(spark, sf_dir):
    """All bands that hold a reading's PM10, from a table of a band per order; many overlap, some are empty."""
    key = F.col("o_orderkey")
    low = F.pmod(key, F.lit(7919)) * F.lit(0.0625)
    table = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        key.alias("band"), low.alias("lo"), (low + F.pmod(key, F.lit(4)) * F.lit(0.0625)).alias("hi"))
    raw = _readings(spark, sf_dir).select("reading_id", "pm10")
    return bd.range_join(raw, "pm10", table).select("reading_id", "band")


def calendar_features(spark, sf_dir):
    raw = _readings(spark, sf_dir)
    return raw.select("reading_id", *[c.alias(n) for n, c in
                                      temporal.calendar_parts(F.col("datetime")).items()])


def cyclic_hour(profile):
    def query(spark, sf_dir):
        raw = _readings(spark, sf_dir).select("reading_id", F.hour("datetime").alias("hour"))
        return _rounded(ft.with_cyclic_hour(raw, profile))
    return query


def zone_by(rule):
    def query(spark, sf_dir):
        return ft.assign_zone(_readings(spark, sf_dir), rule).select("reading_id", "pm25", "zone")
    return query


def lags(spark, sf_dir):
    raw = _readings(spark, sf_dir)
    lagged = ft.add_lags(pipeline.indexed(raw), buckets=fit_order_buckets(raw))
    return _rounded(lagged.select("reading_id", "zone", "pm25_lag1", "pm25_lag3", "pm10_lag1", "aqi_lag1"))


def rolling(profile, start, end):
    def query(spark, sf_dir):
        raw = _readings(spark, sf_dir)
        rolled = ft.add_rolling(pipeline.indexed(raw, profile), "pm25", start, end, "pm25_rolling_avg",
                                buckets=fit_order_buckets(raw))
        return _rounded(rolled.select("reading_id", "zone", "pm25_rolling_avg"))
    return query


def fill_lags(profile, how):
    def query(spark, sf_dir):
        raw = _readings(spark, sf_dir)
        base = pipeline.indexed(raw, profile)
        filled = ft.fill_lags(ft.add_history(base, profile, fit_order_buckets(raw)), how, means_of=base)
        return _rounded(filled.select("reading_id", *LAG_FEATURES))
    return query


def aqi_not_null(spark, sf_dir):
    """Index of readings that were not imputed, so NULL inputs reach it."""
    scored = ft.with_index(_readings(spark, sf_dir), LITE).filter(F.col("aqi").isNotNull())
    return _rounded(scored.select("reading_id", "aqi"))


def interactions(spark, sf_dir):
    framed = ft.interactions(quality.clean(_readings(spark, sf_dir), FULL))
    return _rounded(framed.select("reading_id", "temp_humidity_interaction", "wind_pm25_interaction"))


def prediction_errors(spark, sf_dir):
    return _rounded(reports.with_errors(_predictions(spark, sf_dir)).select(
        "reading_id", "aqi", "prediction", "prediction_error", "abs_error"))


def predictions_by_zone(spark, sf_dir):
    served = serving.served_rows(_predictions(spark, sf_dir))
    return serving.filter_predictions(served, zone="zone north").select(*serving.SERVED_COLUMNS)


def predictions_by_category(spark, sf_dir):
    served = serving.served_rows(_predictions(spark, sf_dir))
    return serving.filter_predictions(served, category="very-unhealthy").select(*serving.SERVED_COLUMNS)


def prediction_sample(spark, sf_dir):
    raw = _readings(spark, sf_dir)
    buckets = fit_order_buckets(raw)
    return serving.prediction_sample(pipeline.persistence_predictions(raw, buckets=buckets), buckets=buckets)


def predictions_page(spark, sf_dir):
    raw = _readings(spark, sf_dir)
    buckets = fit_order_buckets(raw)
    served = serving.served_rows(pipeline.persistence_predictions(raw, buckets=buckets))
    return serving.page(serving.filter_predictions(served, zone="south"), 3, 15, buckets).select(*serving.SERVED_COLUMNS)


def predictions_cursor_page(spark, sf_dir):
    """The fourth page of a hundred rows, reached by the tokens of the pages before it over rows stored by day."""
    path = scratch_path(spark, "served")
    store_by_day(serving.served_rows(_predictions(spark, sf_dir)), path)
    stored, token = read_days(spark, path), None
    for _ in range(3):
        token = serving.next_token(serving.page_after(stored, token, 100, day="day"))
    return serving.page_after(stored, token, 100, day="day").select(*serving.SERVED_COLUMNS)


def predictions_page_deep(spark, sf_dir):
    """A page far from the front: only the order buckets of the page are sorted."""
    raw = _readings(spark, sf_dir)
    buckets = fit_order_buckets(raw)
    served = serving.served_rows(pipeline.persistence_predictions(raw, buckets=buckets))
    return serving.page(served, 59, 100, buckets).select(*serving.SERVED_COLUMNS)


def page_info(spark, sf_dir):
    return serving.page_info(_predictions(spark, sf_dir), serving.matches(zone="south"), 3, 15)


def rolling_global(spark, sf_dir):
    raw = _readings(spark, sf_dir)
    return reports.rolling_global(raw, fit_order_buckets(raw))


def rolling_global_sql(spark, sf_dir):
    raw = _readings(spark, sf_dir)
    return sql_text.rolling_mean(raw, fit_order_buckets(raw))


def rolling_global_head(spark, sf_dir):
    raw = _readings(spark, sf_dir)
    buckets = fit_order_buckets(raw)
    first = reports.first_rows(reports.rolling_global(raw, buckets), 10, buckets)
    return first.select("datetime", "pm25", "rolling_avg_pm25")


def zone_index(spark, sf_dir):
    zones = ft.assign_zone(_readings(spark, sf_dir)).select("reading_id", "zone")
    return forest.zone_indexer().fit(zones).transform(zones)


def zone_onehot(spark, sf_dir):
    indexed = zone_index(spark, sf_dir)
    encoded = forest.zone_encoder().fit(indexed).transform(indexed)
    slots = vector_to_array("zone_encoded")
    return encoded.select("reading_id", "zone", *[slots[i].alias(f"slot_{i}") for i in range(5)])


def assembled(profile):
    p = FULL if profile == "full" else LITE

    def query(spark, sf_dir):
        vectors = forest.numeric_assembler(p).transform(_features(spark, sf_dir, profile))
        rows = vectors.select("reading_id", vector_to_array("numeric_features").alias("v"))
        return _rounded(rows.select("reading_id", F.size("v").alias("dims"),
                                    *[F.col("v")[i].alias(f) for i, f in enumerate(p.features)]))
    return query


def scaled_features(profile):
    p = FULL if profile == "full" else LITE

    def query(spark, sf_dir):
        vectors = forest.numeric_assembler(p).transform(_features(spark, sf_dir, profile)).select(
            "reading_id", "numeric_features")
        vectors = _keep(f"scaled_{profile}", vectors)  # fit and transform read it
        scaled = forest.scaler().fit(vectors).transform(vectors)
        rows = scaled.select("reading_id", vector_to_array("scaled_features").alias("v"))
        return _rounded(rows.select("reading_id", *[F.col("v")[i].alias(f"z_{f}") for i, f in enumerate(p.features)]))
    return query


def final_vector(spark, sf_dir):
    """The model's input: scaled numbers, then the one-hot zone."""
    frame = _features(spark, sf_dir).select("reading_id", "zone", *FULL.features)
    out = _keep("final_vector", frame)
    for stage in (forest.zone_indexer(), forest.zone_encoder(), forest.numeric_assembler(FULL), forest.scaler(),
                  forest.final_assembler()):
        out = (stage.fit(out) if hasattr(stage, "fit") else stage).transform(out)
    rows = out.select("reading_id", vector_to_array("features").alias("v"))
    names = [f"z_{f}" for f in FULL.features] + [f"slot_{i}" for i in range(5)]
    return _rounded(rows.select("reading_id", F.size("v").alias("dims"), *[F.col("v")[i].alias(n) for i, n in enumerate(names)]))


def split_hash(spark, sf_dir):
    train, test = reports.split_hash(_readings(spark, sf_dir).select("reading_id"))
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


def split_random(spark, sf_dir):
    train, test = reports.split_random(_readings(spark, sf_dir).select("reading_id"))
    return train.withColumn("is_train", F.lit(True)).unionByName(test.withColumn("is_train", F.lit(False)))


def ml_frame(spark, sf_dir):
    return _rounded(ft.ml_frame(_features(spark, sf_dir), FULL, ("reading_id",)))


def data_summary(spark, sf_dir):
    raw = _readings(spark, sf_dir)
    return reports.data_summary(raw, pipeline.persistence_predictions(raw), len(FULL.features))


def seasonal_quartiles(spark, sf_dir):
    frame = ft.with_calendar(_indexed(spark, sf_dir), FULL).select("month", "aqi")
    return _rounded(quantiles.seasonal_quartiles(_keep("seasonal", frame)))


def csv_features(spark, sf_dir):
    """Readings written as CSV text and read back, typed and taken through all features."""
    raw = _readings(spark, sf_dir).select("reading_id", "datetime", *MEASURES, "station")
    fields = ", ".join(f"{n} {'string' if n == 'datetime' else t}" for n, t in raw.dtypes)
    lines = raw.select(F.to_csv(F.struct(*raw.columns), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}).alias("line"))
    back = lines.select(F.from_csv("line", F.lit(fields)).alias("r")).select("r.*")
    # columns read from text stand in for the parse wherever they are used, so they are stored once
    return _rounded(pipeline.features(written(src.typed(back), "from_csv"), "full"))


def seasonal_quartiles_sketched(spark, sf_dir):
    """Quartiles by season from stored sketches of days: are they within the stated error of their ranks?"""
    dated = ft.with_calendar(_indexed(spark, sf_dir), FULL)
    frame = _keep("sketched", dated.select(F.to_date("timestamp").alias("day"), temporal.season(F.col("month")).alias("season"),
                                           F.col("aqi").alias("v")))
    daily = written(quantiles.quantile_sketches(frame, ["day", "season"], "v"), "sketches")
    names = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    found = quantiles.sketched_quantiles(quantiles.merged_sketches(daily, ["season"]), ["season"], names)
    ranked = frame.join(F.broadcast(found), "season").groupBy("season").agg(  # four rows
        F.count("v").alias("count"), *[F.avg((F.col("v") < F.col(n)).cast("int")).alias(f"{n}_below") for n in names],
        *[F.avg((F.col("v") <= F.col(n)).cast("int")).alias(f"{n}_upto") for n in names])
    error = quantiles.SKETCH_ERROR
    return ranked.select("season", "count", *[
        ((F.col(f"{n}_below") - error <= p) & (F.col(f"{n}_upto") + error >= p)).alias(f"{n}_within") for n, p in names.items()])


def quality_funnel_observed(spark, sf_dir):
    """The counts of the funnel, taken in flight by the job that stores the cleaned rows."""
    _, counts = analysis.store_indexed(_readings(spark, sf_dir), scratch_path(spark, "indexed"))
    return spark.createDataFrame([counts], "rows_before long, rows_after long, rows_removed long")


def csv_ingest(spark, sf_dir):
    """Readings written as CSV files of two column orders, with bad numbers and times among them, and read back:
    every row is accepted with its values or rejected with a reason."""
    number = F.col("reading_id")
    raw = _readings(spark, sf_dir).select(
        "reading_id", F.when(number % 19 == 0, "yesterday").otherwise(F.col("datetime").cast("string")).alias("datetime"),
        F.when(number % 13 == 0, "abc").otherwise(F.col("pm25").cast("string")).alias("pm25"), *MEASURES[1:], "station")
    path = scratch_path(spark, "csv")
    raw.filter(number % 2 == 0).write.csv(f"{path}/in/even", header=True)
    raw.filter(number % 2 == 1).select(*raw.columns[::-1]).write.csv(f"{path}/in/odd", header=True)
    accepted, rejected = csv_files.ingest(spark, f"{path}/in/*", f"{path}/out")
    columns = ["reading_id", "datetime", "station", *MEASURES]
    lost = rejected.select(F.col("fields")["reading_id"].cast("long").alias("reading_id"), "reason")
    return _rounded(accepted.select(*columns, F.lit("accepted").alias("status"))
                    .unionByName(lost.withColumn("status", F.lit("rejected")), allowMissingColumns=True))


def stored_days(spark, sf_dir):
    """Two days are stored, the first is written again with other values, and both are read."""
    raw = _readings(spark, sf_dir).select("reading_id", "datetime", "pm10")
    day = F.to_date("datetime")
    first, second = [r.day for r in raw.select(day.alias("day")).distinct().orderBy("day").limit(2).collect()]
    path = scratch_path(spark, "days")
    store_by_day(raw.filter(day.isin(first, second)), path)
    store_by_day(raw.filter(day == F.lit(first)).withColumn("pm10", F.lit(0.0)), path)
    return _rounded(read_days(spark, path, first, second).drop("day"))


def filter_high_pm25_stored(spark, sf_dir):
    """The threshold filter over a month of the table stored by day."""
    raw = _readings(spark, sf_dir).select("reading_id", "datetime", "pm25")
    path = scratch_path(spark, "days")
    store_by_day(raw, path)
    start = raw.agg(F.min(F.to_date("datetime")).alias("day")).first().day
    span = read_days(spark, path, start + timedelta(days=100), start + timedelta(days=130))
    return reports.exceedances(span).select("reading_id", "pm25")


def _bundle(spark, sf_dir):
    """The result sets of a run, on the persistence prediction."""
    raw = _readings(spark, sf_dir)
    buckets = fit_order_buckets(raw)
    scored = _keep("report_bundle", pipeline.persistence_predictions(raw, buckets=buckets))
    return analysis.run_report(raw, None, scored, scored, "full", buckets)


def bundle_member(name):
    return lambda spark, sf_dir: _bundle(spark, sf_dir)[name]


def report_bundle(spark, sf_dir):
    """Rows of each result set of a run, on the persistence prediction."""
    bundle = _bundle(spark, sf_dir)
    counts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n_rows")) for name, df in sorted(bundle.items())]
    return reduce(DataFrame.unionByName, counts)


def rf_checked(profile):
    """What can be said of the forest's scores without knowing the trees."""
    def query(spark, sf_dir):
        model, scored = _model(spark, sf_dir, profile)
        labels = scored.agg(F.min("aqi").alias("low"), F.max("aqi").alias("high")).first()
        train = _train_range(spark, sf_dir, profile)
        low, high = min(labels.low, train.low), max(labels.high, train.high)
        square = lambda p: F.sum(F.pow(F.col("aqi") - F.col(p), 2))
        off = scored.agg(square("prediction").alias("forest"), square("aqi_lag1").alias("persistence")).first()
        return _rounded(scored.select(
            "reading_id", "zone", "hour", "aqi", "aqi_category",
            F.col("prediction").between(low - 1e-6, high + 1e-6).alias("in_label_range"),
            F.lit(off.forest < off.persistence).alias("beats_persistence")))
    return query


def _train_range(spark, sf_dir, profile):
    return _indexed(spark, sf_dir, profile).agg(F.min("aqi").alias("low"), F.max("aqi").alias("high")).first()


def importance_checked(spark, sf_dir):
    rows = feature_importance(spark, sf_dir)
    whole = Window.partitionBy(F.lit(0))  # a row per model input
    ranked = rows.withColumn("place", F.row_number().over(whole.orderBy(F.desc("importance"), "feature")))
    return ranked.select(
        "feature", (F.round(F.sum("importance").over(whole), 6) == 1.0).alias("adds_up"),
        F.col("importance").between(0.0, 1.0).alias("is_share"),
        F.sum((F.col("place") <= 10).cast("int")).over(whole).alias("top_rows"))


def forecast_checked(spark, sf_dir):
    rows = forecast_24h(spark, sf_dir)
    # shown values are rounded to a tenth, categories come from the exact ones
    agrees = F.lit(False)
    for shift in (-0.05, 0.0, 0.05):
        agrees = agrees | (F.col("predicted_category") == indices.category(F.col("predicted_aqi") + shift))
    return rows.select("hour", "zone", agrees.alias("category_agrees"), (F.col("predicted_aqi") >= 0).alias("not_negative"))


def split_random_checked(spark, sf_dir):
    rows = split_random(spark, sf_dir)
    return rows.agg(F.count("*").alias("total"), (F.count("*") == F.count_distinct("reading_id")).alias("disjoint"),
                    # two points, or four standard deviations of a small table
                    (F.abs(F.avg(F.col("is_train").cast("int")) - 0.8)
                     < F.greatest(F.lit(0.02), 1.6 / F.sqrt(F.count("*")))).alias("near_share"))


def _agrees(one, other, name="agrees"):
    """Whether two sums of the same numbers in another order are equal."""
    return (F.abs(F.col(one) - F.col(other)) <= F.greatest(F.lit(1.0), F.abs(F.col(one))) * 1e-9).alias(name)


def rf_scores_from_nodes(profile):
    """The forest's scores made again by joins with its table of nodes, against those of the model."""
    def query(spark, sf_dir):
        model, scored = _model(spark, sf_dir, profile)
        vectors = _keep(f"vectors_{profile}", nodes.inputs(model, scored).select(
            "reading_id", "features", F.col("prediction").alias("given")))
        again = nodes.score_by_nodes(nodes.tree_nodes(model), vectors, nodes.forest_depth(model), ["reading_id"])
        return vectors.join(again, "reading_id").select("reading_id", _agrees("given", "prediction"))
    return query


def importance_from_nodes(spark, sf_dir):
    """Importances made again from the gains of the splits, for the forests of both profiles."""
    found = []
    for p in (FULL, LITE):
        model, scored = _model(spark, sf_dir, p.name)
        given = forest.feature_importance(model, scored, p).select("feature", F.col("importance").alias("given"))
        again = nodes.importance_by_nodes(nodes.tree_nodes(model), p)
        found.append(given.join(again, "feature").select(F.lit(p.name).alias("profile"), "feature", _agrees("given", "importance")))
    return found[0].unionByName(found[1])


def forecast_from_nodes(spark, sf_dir):
    """The forecast made again from the table of nodes."""
    model, _ = _model(spark, sf_dir, "full")
    frame = _keep("scenario", fc.forecast_frame(_features(spark, sf_dir)))
    given = forest.score(model, frame).select("hour", F.col("prediction").alias("given"))
    again = nodes.score_by_nodes(nodes.tree_nodes(model), nodes.inputs(model, frame), nodes.forest_depth(model), ["hour"])
    return given.join(again, "hour").select("hour", _agrees("given", "prediction"))


def rf_fit_predict(profile):
    def query(spark, sf_dir):
        return _model(spark, sf_dir, profile)[1].select("reading_id", "zone", "hour", "aqi", "aqi_category",
                                                        "prediction")
    return query


def feature_importance(spark, sf_dir):
    model, scored = _model(spark, sf_dir, "full")
    return forest.feature_importance(model, scored, FULL)


def forecast_24h(spark, sf_dir):
    model, _ = _model(spark, sf_dir, "full")
    return fc.forecast(model, fc.forecast_frame(_features(spark, sf_dir)))


def on_readings(operator, digits=None):
    return lambda spark, sf_dir: _finish(operator(_readings(spark, sf_dir)), digits)


def on_predictions(operator, digits=None):
    return lambda spark, sf_dir: _finish(operator(_predictions(spark, sf_dir)), digits)


def _finish(df, digits):
    return df if digits is None else _rounded(df, digits)


def entry(spark: SparkSession) -> DataFrame:
    return zone_category_summary(spark, "/root/testdata/sf0.001")


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {} if corpus_pipeline is None else {**llm_queries(), "pipeline": corpus_pipeline.run}


def _llm_sql() -> dict[str, str]:
    if corpus_pipeline is None:
        return {}
    whole = corpus_pipeline.ORACLE_SQL
    return {**LLM_ORACLE, **({"pipeline": whole} if whole else {})}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each callable takes (spark, sf_dir)."""
    return {
        **_llm_queries(),
        "zone_category_summary": zone_category_summary,
        # sources, projections, filters
        "scan_readings": on_readings(lambda r: r, 6),
        "repartition_count": repartition_count,
        "project_pm": on_readings(lambda r: r.select("pm25", "pm10")),
        "filter_high_pm25": on_readings(lambda r: reports.exceedances(r).select("reading_id", "pm25")),
        "row_count": on_readings(reports.row_count),
        # cleaning
        "nullify_sentinels": on_readings(lambda r: quality.nullify_sentinels(r).drop("datetime", "station"), 6),
        "impute_mean": on_readings(lambda r: quality.impute_mean(quality.nullify_sentinels(r))
                                   .select("reading_id", *MEASURES), 6),
        "impute_mean_lite": on_readings(lambda r: quality.impute_mean(r).select("reading_id", *MEASURES), 6),
        "filter_valid": on_readings(lambda r: quality.clean(r, FULL).select("reading_id", *MEASURES), 6),
        "filter_high_pm25_stored": filter_high_pm25_stored,
        "stored_days": stored_days,
        "csv_ingest": csv_ingest,
        "quality_funnel_observed": quality_funnel_observed,
        "quality_funnel": on_readings(lambda r: quality.quality_funnel(
            quality.impute_mean(quality.nullify_sentinels(r)))),
        "aqi_not_null": aqi_not_null,
        # profiling and raw aggregates
        "missing_profile": on_readings(quality.missing_profile, 6),
        "range_profile": on_readings(quality.range_profile),
        "pollutant_stats": on_readings(quality.pollutant_stats),
        "describe_readings": on_readings(quality.describe_long, 4),
        "basic_stats": on_readings(reports.basic_stats),
        "basic_stats_short": on_readings(reports.basic_stats_short),
        "basic_stats_sql": on_readings(sql_text.basic_stats),
        "basic_stats_short_sql": on_readings(sql_text.basic_stats_short),
        "hourly_pattern_sql": on_readings(sql_text.hourly_pattern),
        "hourly_pattern_raw": on_readings(reports.hourly_pattern),
        "hourly_totals": on_readings(reports.hourly_totals),
        "distinct_dates": on_readings(reports.distinct_dates),
        "totals": on_readings(reports.totals, 4),
        "correlation_matrix": on_readings(lambda r: reports.correlation_matrix(quality.clean(r, FULL)), 6),
        # index
        "subindex_full": subindex("full"),
        "subindex_lite": subindex("lite"),
        "subindex_generic": subindex_generic,
        "aqi_full": index_of("full"),
        "aqi_lite": index_of("lite"),
        "aqi_category": aqi_category,
        "category_range_join": category_range_join,
        "category_by_table": category_by_table,
        "subindex_by_table": subindex_by_table,
        "bands_join": bands_join,
        "category_distribution": lambda s, d: reports.category_distribution(_indexed(s, d)),
        "category_share": lambda s, d: reports.category_share(_indexed(s, d)),
        "describe_aqi": lambda s, d: _rounded(quality.describe_long(_indexed(s, d), ["aqi"]), 4),
        "seasonal_quartiles": seasonal_quartiles,
        "seasonal_quartiles_sketched": seasonal_quartiles_sketched,
        # time and keys
        "parse_timestamp": parse_timestamp,
        "calendar_features": calendar_features,
        "cyclic_hour_full": cyclic_hour("full"),
        "cyclic_hour_lite": cyclic_hour("lite"),
        "zone_by_id": zone_by("id"),
        "zone_by_value": zone_by("value"),
        # windows and features
        "lags": lags,
        "rolling_prev3": rolling("full", -3, -1),
        "rolling_cur3": rolling("lite", -2, 0),
        "rolling_global": rolling_global,
        "rolling_global_sql": rolling_global_sql,
        "rolling_global_head": rolling_global_head,
        "fill_lags_mean": fill_lags("full", "mean"),
        "fill_lags_zero": fill_lags("lite", "zero"),
        "interactions": interactions,
        "features_full": lambda s, d: _rounded(_features(s, d, "full")),
        "features_lite": lambda s, d: _rounded(_features(s, d, "lite")),
        "feature_means": lambda s, d: _rounded(reports.feature_means(_features(s, d)), 4),
        "ml_frame": ml_frame,
        # scored rows
        "prediction_errors": prediction_errors,
        "describe_errors": on_predictions(reports.describe_errors, 4),
        "regression_metrics": on_predictions(reports.regression_metrics, 4),
        "model_metrics": on_predictions(reports.rounded_metrics),
        "error_by_category": on_predictions(reports.error_by_category),
        "error_histogram": on_predictions(reports.error_histogram, 6),
        "error_bands": on_predictions(reports.error_bands),
        "fit_actual_predicted": on_predictions(reports.fit_actual_predicted, 6),
        "zone_analysis": on_predictions(reports.zone_analysis),
        "zone_risk": on_predictions(reports.zone_risk),
        "high_risk_zones": on_predictions(lambda p: reports.high_risk_zones(reports.zone_analysis(p))),
        "high_risk_zones_fallback": on_predictions(
            lambda p: reports.high_risk_zones(reports.zone_analysis(p), threshold=1000.0, fallback=3)),
        "hourly_risk": on_predictions(reports.hourly_risk),
        "peak_hours_top5": on_predictions(lambda p: reports.peak_hours(p, 5)),
        "peak_hours_top10": on_predictions(lambda p: reports.peak_hours(p, 10)),
        "peak_low_hour": on_predictions(reports.peak_low_hour),
        "overall_prediction": on_predictions(reports.overall_prediction),
        "data_summary": data_summary,
        # serving and export
        "predictions_export": on_predictions(sinks.predictions_export, 6),
        "prediction_sample": prediction_sample,
        "predictions_by_zone": predictions_by_zone,
        "predictions_by_category": predictions_by_category,
        "predictions_page": predictions_page,
        "predictions_page_deep": predictions_page_deep,
        "predictions_cursor_page": predictions_cursor_page,
        "page_info": page_info,
        # model
        "zone_index": zone_index,
        "zone_onehot": zone_onehot,
        "assembled": assembled("full"),
        "assembled_lite": assembled("lite"),
        "scaled_features": scaled_features("full"),
        "scaled_features_lite": scaled_features("lite"),
        "final_vector": final_vector,
        "csv_features": csv_features,
        "report_bundle": report_bundle,
        **{f"bundle_{name}": bundle_member(name) for name in (
            "metrics", "zones", "hourly_pattern", "category_distribution", "predictions", "data", "pollutant_stats")},
        "rf_checked": rf_checked("full"),
        "rf_checked_lite": rf_checked("lite"),
        "rf_scores_from_nodes": rf_scores_from_nodes("full"),
        "rf_scores_from_nodes_lite": rf_scores_from_nodes("lite"),
        "importance_from_nodes": importance_from_nodes,
        "forecast_from_nodes": forecast_from_nodes,
        "importance_checked": importance_checked,
        "forecast_checked": forecast_checked,
        "split_random_checked": split_random_checked,
        "split_hash": split_hash,
        "split_random": split_random,
        "forecast_frame": lambda s, d: _rounded(fc.forecast_frame(_features(s, d)), 4),
        "rf_fit_predict": rf_fit_predict("full"),
        "rf_fit_predict_lite": rf_fit_predict("lite"),
        "feature_importance": feature_importance,
        "forecast_24h": forecast_24h,
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every query that SQL can express."""
    return {**ORACLE, **_llm_sql()}
