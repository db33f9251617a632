"""Stages of the two profiles put together: readings -> clean -> index -> features."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from envspark.operators import features as ft
from envspark.operators import quality
from envspark.operators.windows import OrderBuckets, fit_order_buckets
from envspark.profiles import Profile, profile_of


def indexed(readings: DataFrame, profile: str | Profile = "full", seen: Observation | None = None) -> DataFrame:
    """Cleaned readings with zone, sub-indices, overall index and category.

    The value rule of the lite profile looks at the readings before they are
    imputed; the id rule does not care. `seen` counts rows in flight, see `quality.clean`.
    """
    p = profile_of(profile)
    zoned = ft.assign_zone(readings, by=p.zone_rule)
    return ft.with_index(quality.clean(zoned, p, seen), p)


def features(readings: DataFrame, profile: str | Profile = "full",
             buckets: OrderBuckets | None = None) -> DataFrame:
    """The engineered frame of a profile."""
    p = profile_of(profile)
    return features_of(indexed(readings, p), p, buckets or fit_order_buckets(readings))


def features_of(base: DataFrame, profile: str | Profile, buckets: OrderBuckets) -> DataFrame:
    """The engineered frame of indexed readings, which may be stored ones."""
    p = profile_of(profile)
    with_history = ft.add_history(ft.with_calendar(base, p), p, buckets)
    filled = ft.fill_lags(with_history, p.lag_fill, means_of=base)
    framed = ft.interactions(filled)
    return framed if p.name == "full" else framed.filter(F.col("aqi").isNotNull())


def persistence_predictions(readings: DataFrame, profile: str | Profile = "full",
                            buckets: OrderBuckets | None = None) -> DataFrame:
    """Readings with the previous index of the zone as `prediction`.

    The baseline any model has to beat. Rows without a predecessor drop out.
    """
    buckets = buckets or fit_order_buckets(readings)
    base = ft.with_calendar(indexed(readings, profile), profile)
    lagged = ft.add_lags(base, [("aqi", 1)], buckets=buckets)
    return lagged.withColumn("prediction", F.col("aqi_lag1")).filter(F.col("prediction").isNotNull())
