"""Index columns, calendar, zones, lags, rolling means and interactions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envspark.functions import indices, temporal
from envspark.operators.bands import first_band, with_bands
from envspark.operators.quality import column_means, fill_missing
from envspark.operators.windows import OrderBuckets, fit_order_buckets, windowed
from envspark.profiles import BEYOND_SCALE, LAG_FEATURES, LAGS, POLLUTANTS, Profile, profile_of

_INF = float("inf")


def with_sub_indices(df: DataFrame, profile: str | Profile) -> DataFrame:
    return df.withColumns({f"aqi_{p}": indices.sub_index(p, profile) for p in POLLUTANTS})


def with_index(df: DataFrame, profile: str | Profile) -> DataFrame:
    """Sub-indices, overall index and category."""
    df = with_sub_indices(df, profile).withColumn("aqi", indices.overall_index())
    return df.withColumn("aqi_category", indices.category(F.col("aqi")))


def categorize_by_table(df: DataFrame, column: str, bands: Sequence[tuple[str, float, float]] | DataFrame,
                        target: str = "category") -> DataFrame:
    """Look a value up in a table of (name, lo exclusive, hi inclusive) rows; NULL where none fits.

    A list of bands is sorted and must not overlap, so that a binary search finds the only one that may
    fit. A DataFrame (name, lo, hi) may be large and its bands may overlap: the first by lo, hi and name counts.
    """
    if isinstance(bands, DataFrame):
        found, taken = "_found", bands.select("name", "lo", "hi")
        held = with_bands(df, F.col(f"`{column}`"), taken, target=found)
        return held.withColumn(target, first_band(F.col(found), ("lo", "hi", "name"))["name"]).drop(found)
    ordered = sorted((lo, hi, name) for name, lo, hi in bands if lo < hi)
    for (_, hi, name), (lo, _, other) in zip(ordered, ordered[1:]):
        if lo < hi:
            raise ValueError(f"bands {name!r} and {other!r} overlap")
    if not ordered:
        return df.withColumn(target, F.lit(None).cast("string"))
    # the search takes pieces that include their lower end, so it looks at the negated value
    edges = sorted({-x for lo, hi, _ in ordered for x in (lo, hi)})
    names = {(-hi, -lo): name for lo, hi, name in ordered}
    pieces = [names.get(p) for p in zip([-_INF, *edges], [*edges, _INF])]
    splits = [-_INF, *edges, _INF]
    if edges[0] == -_INF:
        splits, pieces = splits[1:], pieces[1:]
    if edges[-1] == _INF:
        splits, pieces = splits[:-1], pieces[:-1]
    place, value = "_place", "_value"
    found = Bucketizer(splits=splits, inputCol=value, outputCol=place, handleInvalid="keep").transform(
        df.withColumn(value, -F.col(f"`{column}`").cast("double")))
    named = F.get(F.array(*[F.lit(p).cast("string") for p in pieces]), F.col(place).cast("int"))
    return found.withColumn(target, named).drop(place, value)


def interpolate_by_table(df: DataFrame, column: str, table: DataFrame, target: str = "index",
                         beyond: float | None = BEYOND_SCALE) -> DataFrame:
    """Index from a table (c_lo, c_hi, i_lo, i_hi) of closed bands: the first band by these columns that holds the
    value counts, values in no band become `beyond`, NULL stays NULL."""
    order, found, x = ("c_lo", "c_hi", "i_lo", "i_hi"), "_found", F.col(f"`{column}`").cast("double")
    taken = table.select(*[F.col(c).cast("double").alias(c) for c in order])
    held = with_bands(df, x, taken, "c_lo", "c_hi", found, closed=True).withColumn(
        found, first_band(F.col(found), order))
    at = {c: F.col(f"{found}.{c}") for c in order}
    slope = F.coalesce(F.try_divide(at["i_hi"] - at["i_lo"], at["c_hi"] - at["c_lo"]), F.lit(0.0))
    index = F.when(F.col(found).isNotNull(), slope * (x - at["c_lo"]) + at["i_lo"]).when(x.isNotNull(), F.lit(beyond))
    return held.withColumn(target, index).drop(found)


def with_calendar(df: DataFrame, profile: str | Profile, source: str = "datetime") -> DataFrame:
    """timestamp, hour, day_of_week, month, (year) and the cyclic hour."""
    p = profile_of(profile)
    df = temporal.with_timestamp(df, source, "timestamp", strict=p.name == "full")
    df = df.withColumns(temporal.calendar_parts(F.col("timestamp"), p.with_year))
    return with_cyclic_hour(df, p)


def with_cyclic_hour(df: DataFrame, profile: str | Profile) -> DataFrame:
    sine, cosine = temporal.cyclic(F.col("hour"), 24, profile_of(profile).pi)
    return df.withColumns({"hour_sin": sine, "hour_cos": cosine})


def assign_zone(df: DataFrame, by: str = "id", key: str = "reading_id", value: str = "pm25") -> DataFrame:
    """Zone from a stable row key (`by="id"`) or from a measured value (`by="value"`)."""
    if by == "id":
        return df.withColumn("zone", temporal.zone_by_id(F.col(key)))
    if by == "value":
        return df.withColumn("zone", temporal.zone_by_value(F.col(value)))
    raise ValueError(f"unknown zone rule {by!r}")


def lag_columns(lags: Iterable[tuple[str, int]]):
    return {f"{c}_lag{k}": (lambda w, c=c, k=k: F.lag(c, k).over(w)) for c, k in lags}


def rolling_mean(column: str, frame: tuple[int, int]):
    return lambda w: F.avg(column).over(w.rowsBetween(*frame))


def add_lags(df: DataFrame, lags: Iterable[tuple[str, int]] = LAGS, by: Sequence[str] = ("zone",),
             buckets: OrderBuckets | None = None) -> DataFrame:
    """Values of k rows earlier in the group. Row lags, whatever the time in between."""
    lags = list(lags)
    return windowed(df, lag_columns(lags), buckets or fit_order_buckets(df), by,
                    back=max(k for _, k in lags), uses=sorted({c for c, _ in lags}))


def add_rolling(df: DataFrame, column: str, start: int, end: int, target: str,
                by: Sequence[str] = ("zone",), buckets: OrderBuckets | None = None) -> DataFrame:
    """Mean over rows `start`..`end` relative to the current one; `start` <= `end` <= 0."""
    if not start <= end <= 0:
        raise ValueError("a rolling frame ends at or before the current row")
    return windowed(df, {target: rolling_mean(column, (start, end))}, buckets or fit_order_buckets(df),
                    by, back=-start, uses=[column])


def add_history(df: DataFrame, profile: str | Profile, buckets: OrderBuckets | None = None) -> DataFrame:
    """All lags and the rolling mean of a profile from a single window."""
    p = profile_of(profile)
    columns = {**lag_columns(LAGS), "pm25_rolling_avg": rolling_mean("pm25", p.rolling_frame)}
    back = max(*(k for _, k in LAGS), -p.rolling_frame[0])
    return windowed(df, columns, buckets or fit_order_buckets(df), ("zone",), back,
                    uses=sorted({c for c, _ in LAGS}))


def fill_lags(df: DataFrame, how: str, means_of: DataFrame | None = None) -> DataFrame:
    """Missing lags and rolling means become global means (`"mean"`) or 0 (`"zero"`).

    `means_of` may name the frame before the window stage, which has the same
    means and a cheaper plan.
    """
    if how == "zero":
        return fill_missing(df, {c: F.lit(0.0) for c in LAG_FEATURES})
    if how != "mean":
        raise ValueError(f"unknown fill {how!r}")
    means = "_means"
    source = {c: c.split("_")[0] for c in LAG_FEATURES}
    base = df if means_of is None else means_of
    filled = fill_missing(df.withColumn(means, column_means(base, sorted(set(source.values())))),
                          {c: F.col(f"{means}.{base_column}") for c, base_column in source.items()})
    return filled.drop(means)


def interactions(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "temp_humidity_interaction": F.col("temp") * F.col("rh") / 100,
        "wind_pm25_interaction": F.col("wind") * F.col("pm25"),
    })


def ml_frame(df: DataFrame, profile: str | Profile, extra: Sequence[str] = ()) -> DataFrame:
    """Model inputs, label, zone, datetime and category without rows that miss any of them."""
    p = profile_of(profile)
    wanted = [*p.features, "aqi", "zone", "datetime", "aqi_category"]
    return df.select(*wanted, *[c for c in extra if c not in wanted]).na.drop(subset=wanted)
