"""Readings and scores stored by day, so that reading a span of days touches no other files.

Rows of a day are sorted by time within their files, and a day of many rows is split over files by
adaptive execution (`rebalance`), not put into one task. Writing replaces whole days: a
rerun of one day leaves the others as they are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "day"


def store_by_day(df: DataFrame, path: str, time: str = "datetime", tie: str = "reading_id") -> None:
    """Write the days of `df` below `path`; days that are stored there and not in `df` stay. Rows without a time are a day too."""
    if DAY in df.columns:
        raise ValueError(f"the column {DAY!r} is made here")
    (df.withColumn(DAY, F.to_date(time)).hint("rebalance", DAY)
     .sortWithinPartitions(DAY, time, tie)
     .write.partitionBy(DAY).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path))


def read_days(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """The stored rows of the days `first` to `last`, both included; an open end takes all. `day` stays, so
    that later filters on it prune as well."""
    found = spark.read.parquet(path)
    if first is not None:
        found = found.filter(F.col(DAY) >= F.lit(first))
    if last is not None:
        found = found.filter(F.col(DAY) <= F.lit(last))
    return found
