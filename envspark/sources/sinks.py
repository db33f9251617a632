"""Distributed writers of the result files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envspark.operators.reports import first_rows, zone_risk
from envspark.operators.windows import OrderBuckets

EXPORT_COLUMNS = ("datetime", "zone", "pm25", "pm10", "no2", "co", "so2", "o3",
                  "temp", "rh", "wind", "aqi", "prediction", "aqi_category")


def predictions_export(df: DataFrame, limit: int | None = None,
                       buckets: OrderBuckets | None = None) -> DataFrame:
    """The exported columns, prediction rounded; all rows or the first `limit` in time order."""
    if limit is not None:
        df = first_rows(df, limit, buckets)
    return df.withColumn("prediction", F.round("prediction", 2)).select(*EXPORT_COLUMNS)


def write_predictions(df: DataFrame, path: str, limit: int | None = None,
                      buckets: OrderBuckets | None = None) -> None:
    predictions_export(df, limit, buckets).write.mode("overwrite").csv(path, header=True)


def write_zone_risk(df: DataFrame, path: str) -> None:
    """All zones with their risk level: one row per zone, so a single file."""
    zone_risk(df).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_report(report: Mapping[str, DataFrame], path: str) -> None:
    """Each named result set as a Parquet table below `path`."""
    for name, frame in report.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}")
