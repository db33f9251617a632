"""SQL text over frames, without names that outlive the query.

`run_text` gives the frames names of its own for the time that Spark needs to analyse the text and drops
them again; the returned DataFrame keeps working. Texts name frames and values by markers (`:readings`,
`:digits`), so nothing is pasted into them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from envspark.operators.windows import OrderBuckets, fit_order_buckets, with_halo
from envspark.sources.readings import register


@contextmanager
def scoped_views(**frames: DataFrame) -> Iterator[dict[str, str]]:
    """Temporary views of the frames under new names, given as {name: view}; dropped at the end of the block."""
    names = {name: f"{name}_{uuid.uuid4().hex}" for name in frames}
    made = []
    try:
        for name, frame in frames.items():
            register(frame, names[name])
            made.append((frame.sparkSession, names[name]))
        yield names
    finally:
        for spark, view in made:
            spark.catalog.dropTempView(view)


def run_text(spark: SparkSession, text: str, frames: Mapping[str, DataFrame], **values: Any) -> DataFrame:
    """The result of SQL text that names frames as `IDENTIFIER(:name)` and values as `:name`."""
    with scoped_views(**frames) as names:
        return spark.sql(text, args={**names, **values})


#: count, averages and range of PM over rows with PM2.5
BASIC_STATS = """
FROM IDENTIFIER(:readings)
|> WHERE pm25 IS NOT NULL
|> AGGREGATE count(1) AS total_records, avg(pm25) AS a25, avg(pm10) AS a10, max(pm25) AS high, min(pm25) AS low
|> SELECT total_records, round(a25, :digits) AS avg_pm25, round(a10, :digits) AS avg_pm10,
          round(high, :digits) AS max_pm25, round(low, :digits) AS min_pm25
"""

BASIC_STATS_SHORT = """
FROM IDENTIFIER(:readings)
|> WHERE pm25 IS NOT NULL
|> AGGREGATE round(avg(pm25), :digits) AS avg_pm25, round(max(pm25), :digits) AS max_pm25, count(1) AS total_records
"""

HOURLY_PATTERN = """
FROM IDENTIFIER(:readings)
|> WHERE pm25 IS NOT NULL
|> EXTEND extract(HOUR FROM datetime) AS at_hour
|> AGGREGATE avg(pm25) AS a25, avg(pm10) AS a10, count(1) AS readings GROUP BY at_hour
|> SELECT at_hour AS hour, round(a25, :digits) AS avg_pm25, round(a10, :digits) AS avg_pm10, readings AS record_count
|> ORDER BY hour
"""

#: over rows that carry the end of the bucket before along, so that the series is no single task
ROLLING_MEAN = """
FROM IDENTIFIER(:series)
|> EXTEND avg(pm25) OVER (PARTITION BY _bucket ORDER BY datetime, reading_id
                          ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS mean
|> WHERE _own
|> SELECT reading_id, datetime, pm25, round(mean, :digits) AS rolling_avg_pm25
"""


def basic_stats(readings: DataFrame, digits: int = 2) -> DataFrame:
    return run_text(readings.sparkSession, BASIC_STATS, {"readings": readings}, digits=digits)


def basic_stats_short(readings: DataFrame, digits: int = 2) -> DataFrame:
    return run_text(readings.sparkSession, BASIC_STATS_SHORT, {"readings": readings}, digits=digits)


def hourly_pattern(readings: DataFrame, digits: int = 2) -> DataFrame:
    return run_text(readings.sparkSession, HOURLY_PATTERN, {"readings": readings}, digits=digits)


def rolling_mean(readings: DataFrame, buckets: OrderBuckets | None = None, digits: int = 2) -> DataFrame:
    """Mean PM2.5 of each row and the three before it, over the whole series."""
    series = with_halo(readings.filter("pm25 IS NOT NULL").select("reading_id", "datetime", "pm25"),
                       buckets or fit_order_buckets(readings), back=3, uses=["pm25"])
    return run_text(readings.sparkSession, ROLLING_MEAN, {"series": series}, digits=digits)
