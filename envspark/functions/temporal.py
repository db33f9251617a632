"""Column expressions for timestamps, calendar parts, cyclic encoding and zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envspark.profiles import ZONES

_STRICT_FORMAT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"

SEASONS = (("Winter", (12, 1, 2)), ("Spring", (3, 4, 5)), ("Summer", (6, 7, 8)), ("Fall", (9, 10, 11)))


def parse_timestamp(column: Column, strict: bool = True) -> Column:
    """`yyyy-MM-dd HH:mm:ss` text to a zone-free timestamp; other text gives NULL.

    `strict=False` accepts every text form that a cast accepts. Zone-free, so
    the result does not depend on the session time zone.
    """
    parsed = column.try_cast("timestamp_ntz")
    return F.when(column.rlike(_STRICT_FORMAT), parsed) if strict else parsed


def with_timestamp(df: DataFrame, source: str = "datetime", target: str = "timestamp",
                   strict: bool = True) -> DataFrame:
    """Add `target`. A column that is a timestamp already is taken as it is."""
    if isinstance(df.schema[source].dataType, T.StringType):
        return df.withColumn(target, parse_timestamp(F.col(source), strict))
    return df.withColumn(target, F.col(source))


def calendar_parts(column: Column, with_year: bool = True) -> dict[str, Column]:
    """hour, day_of_week (1 = Sunday), month and year."""
    parts = {"hour": F.hour(column), "day_of_week": F.dayofweek(column), "month": F.month(column)}
    if with_year:
        parts["year"] = F.year(column)
    return parts


def cyclic(column: Column, period: float, pi: float) -> tuple[Column, Column]:
    """(sin, cos) of a position in a cycle, in double arithmetic throughout."""
    angle = F.lit(2.0 * pi) * column.cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def season(month: Column) -> Column:
    """Meteorological season of a month number."""
    (first, months), *rest = SEASONS
    chain = F.when(month.isin(*months), F.lit(first))
    for label, months in rest:
        chain = chain.when(month.isin(*months), F.lit(label))
    return chain


def _zone_of(remainder: Column) -> Column:
    *named, fallback = ZONES
    chain = F.when(remainder == F.lit(0), F.lit(named[0]))
    for k, zone in enumerate(named[1:], start=1):
        chain = chain.when(remainder == F.lit(k), F.lit(zone))
    return chain.otherwise(F.lit(fallback))


def zone_by_id(column: Column) -> Column:
    """Zone from a stable row key, so that it does not depend on partitioning."""
    return _zone_of(F.pmod(column, F.lit(len(ZONES))))


def zone_by_value(column: Column) -> Column:
    """Zone from a measured value; fractional, missing and most negative values share the last zone."""
    return _zone_of(column % F.lit(float(len(ZONES))))
