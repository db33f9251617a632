"""The whole run: features, split, model, scores and the result bundle."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from envspark.ml.forest import feature_importance, fit_forest, persisted, score
from envspark.operators import quality, reports, serving
from envspark.operators.features import ml_frame
from envspark.operators.windows import OrderBuckets, fit_order_buckets
from envspark.plans.pipeline import features, features_of, indexed
from envspark.profiles import Profile, profile_of
from envspark.sources.stored import read_days, store_by_day

EXTRA_COLUMNS = ("reading_id",)


def train_and_score(readings: DataFrame, profile: str | Profile = "full",
                    buckets: OrderBuckets | None = None) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training rows and score the test rows of a key-based 80/20 split.

    The full profile drops rows with any missing input first; the lite profile
    leaves that to the assembler.
    """
    p = profile_of(profile)
    frame = features(readings, p, buckets)
    if p.name == "full":
        frame = ml_frame(frame, p, EXTRA_COLUMNS)
    train, test = reports.split_hash(frame)
    model = fit_forest(train, p)
    return model, score(model, test)


def store_indexed(readings: DataFrame, path: str, profile: str | Profile = "full") -> tuple[DataFrame, dict[str, int]]:
    """Write cleaned and indexed readings by day; the stored frame and the counts of the quality
    funnel, which come from the writing job itself."""
    seen = Observation()
    store_by_day(indexed(readings, profile, seen), path)
    return read_days(readings.sparkSession, path).drop("day"), quality.observed_funnel(seen)


def run_stored(readings: DataFrame, path: str, profile: str | Profile = "lite"
               ) -> tuple[dict[str, DataFrame], dict[str, int | float]]:
    """From readings to the result sets over tables stored by day below `path`, and the counts of the run.

    Readings are cleaned and indexed in one job and scored in another. Both count what they write, so no
    further pass over the rows is made for the counts, and a later step that fails starts from the stored table.
    """
    p = profile_of(profile)
    base, counts = store_indexed(readings, f"{path}/indexed", p)
    buckets = fit_order_buckets(base)
    frame = features_of(base, p, buckets)
    if p.name == "full":
        frame = ml_frame(frame, p, EXTRA_COLUMNS)
    else:
        frame = frame.filter(F.col("aqi").isNotNull())
    model = fit_forest(reports.split_hash(frame)[0], p)
    train, seen = reports.hash_position() < reports.TRAIN_RATIO, Observation()
    scored = score(model, frame).observe(
        seen, F.count_if(train).alias("train_records"), F.count_if(~train).alias("test_records"),
        F.avg(F.when(~train, F.col("prediction"))).alias("avg_aqi"))
    store_by_day(scored, f"{path}/scored")
    counts |= seen.get
    all_rows = read_days(readings.sparkSession, f"{path}/scored").drop("day")
    return run_report(readings, model, reports.split_hash(all_rows)[1], all_rows, p, buckets), counts


def run_report(readings: DataFrame, model: PipelineModel | None, scored: DataFrame, all_rows: DataFrame,
               profile: str | Profile = "lite", buckets: OrderBuckets | None = None) -> dict[str, DataFrame]:
    """The eight result sets of a run, each lazy until it is written or shown.

    `scored` holds the test rows, `all_rows` train and test rows with a prediction. Without a model, as
    for the persistence prediction, the importances are left out. `buckets` are those of the raw table.
    """
    p = profile_of(profile)
    learned = {} if model is None else {"feature_importance": feature_importance(model, scored, p, top=10)}
    return {
        "metrics": reports.rounded_metrics(scored),
        **learned,
        "zones": reports.zone_risk(scored),
        "hourly_pattern": reports.hourly_risk(scored),
        "category_distribution": reports.category_distribution(scored),
        "predictions": serving.prediction_sample(scored, buckets=buckets),
        "data": reports.data_summary(readings, all_rows, len(p.features)),
        "pollutant_stats": quality.pollutant_stats(readings),
    }


@contextmanager
def run_all(readings: DataFrame, profile: str | Profile = "lite",
            buckets: OrderBuckets | None = None) -> Iterator[dict[str, DataFrame]]:
    """From readings to the eight result sets.

    The rows are scored once and kept while the sets are written or shown inside the `with` block,
    since most of them read the scores.
    """
    p = profile_of(profile)
    buckets = buckets or fit_order_buckets(readings)
    frame = features(readings, p, buckets)
    if p.name == "full":
        frame = ml_frame(frame, p, EXTRA_COLUMNS)
    model = fit_forest(reports.split_hash(frame)[0], p)
    with persisted(score(model, frame)) as all_rows:
        yield run_report(readings, model, reports.split_hash(all_rows)[1], all_rows, p, buckets)
