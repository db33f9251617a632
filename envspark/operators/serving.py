"""Scored rows as they are served: rounded samples, filters and pages."""

from __future__ import annotations

import base64
import datetime as dt
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from envspark.operators.reports import first_rows
from envspark.operators.windows import OrderBuckets, slice_rows
from envspark.profiles import CATEGORY_SLUGS

SAMPLE_ROWS = 500
PER_PAGE = 20

_DIGITS = {"pm25": 1, "pm10": 1, "no2": 1, "co": 2, "so2": 1, "o3": 1}
SERVED_COLUMNS = ("datetime", "zone", *_DIGITS, "actual_aqi", "predicted_aqi", "error", "aqi_category")


def served_rows(df: DataFrame) -> DataFrame:
    """Rounded display columns; reading_id stays as the tie-breaker of the order."""
    return df.select(
        "reading_id", "datetime", "zone",
        *[F.round(c, digits).alias(c) for c, digits in _DIGITS.items()],
        F.round("aqi", 2).alias("actual_aqi"), F.round("prediction", 2).alias("predicted_aqi"),
        F.round(F.abs(F.col("aqi") - F.col("prediction")), 2).alias("error"), "aqi_category")


def prediction_sample(df: DataFrame, n: int = SAMPLE_ROWS, buckets: OrderBuckets | None = None) -> DataFrame:
    """The first n scored rows in time order, rounded for display. `buckets` of the raw table save fitting
    them on `df`, which runs its whole plan."""
    return served_rows(first_rows(df, n, buckets)).select(*SERVED_COLUMNS)


def matches(zone: str = "all", category: str = "all") -> Column:
    """Rows of a zone (any part of its name, case and `_` ignored) and of a category (slug or label)."""
    match = F.lit(True)
    if zone != "all":
        wanted = zone.lower().replace("_", " ")
        match = match & F.translate(F.lower("zone"), "_", " ").contains(wanted)
    if category != "all":
        match = match & (F.col("aqi_category") == CATEGORY_SLUGS.get(category, category))
    return match


def filter_predictions(df: DataFrame, zone: str = "all", category: str = "all") -> DataFrame:
    """The rows that match a zone and a category."""
    return df.filter(matches(zone, category))


def page(df: DataFrame, number: int = 1, per_page: int = PER_PAGE,
         buckets: OrderBuckets | None = None) -> DataFrame:
    """Rows of one 1-based page in (datetime, reading_id) order, near the front or deep."""
    return slice_rows(df, (number - 1) * per_page, per_page, buckets)


def token_of(time: dt.datetime | None, tie: int) -> str:
    """An opaque mark of a place in the order (time, tie): a page goes on behind it."""
    place = json.dumps([None if time is None else time.isoformat(), int(tie)])
    return base64.urlsafe_b64encode(place.encode()).decode()


def place_of(token: str) -> tuple[dt.datetime | None, int]:
    try:
        time, tie = json.loads(base64.urlsafe_b64decode(token.encode()))
        return None if time is None else dt.datetime.fromisoformat(time), int(tie)
    except (ValueError, TypeError) as wrong:
        raise ValueError("this is no page token") from wrong


def behind(token: str, time: str = "datetime", tie: str = "reading_id", day: str | None = None) -> Column:
    """Rows after a token's place. It compares plain columns with values, so it reaches the scan of a
    stored table; `day` names the column of dates that the table is partitioned by."""
    at, number = place_of(token)
    later = F.col(tie) > number
    if at is None:  # rows without a time come first
        return F.col(time).isNotNull() | later
    stamp = F.lit(at).cast("timestamp_ntz")
    found = (F.col(time) >= stamp) & ((F.col(time) > stamp) | later)
    return found if day is None else (F.col(day) >= F.lit(at.date())) & found


def page_after(df: DataFrame, token: str | None = None, per_page: int = PER_PAGE, time: str = "datetime",
               tie: str = "reading_id", day: str | None = None) -> DataFrame:
    """The next page behind a token, or the first one. No row before it is counted or sorted: tasks keep
    their first `per_page` rows each."""
    rows = df if token is None else df.filter(behind(token, time, tie, day))
    return rows.orderBy(time, tie).limit(per_page)


def next_token(page: DataFrame, time: str = "datetime", tie: str = "reading_id") -> str | None:
    """The token behind a page; None behind an empty one."""
    last = page.select(time, tie).orderBy(F.desc(time), F.desc(tie)).first()
    return None if last is None else token_of(last[0], last[1])


def page_info(df: DataFrame, match: Column, number: int = 1, per_page: int = PER_PAGE) -> DataFrame:
    """total, page and pages of the matching rows, in one pass: at least one page, but none
    when there are no rows at all."""
    counts = df.agg(F.count("*").alias("n"), F.count_if(match).alias("total"))
    pages = F.greatest(F.lit(1), F.ceil(F.col("total") / per_page))
    return counts.select("total", F.lit(number).alias("page"),
                         F.when(F.col("n") > 0, pages).otherwise(F.lit(0)).cast("long").alias("pages"))
