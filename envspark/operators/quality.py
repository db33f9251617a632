"""Missing values, imputation, validity and profiling.

Wide profiles are one aggregation over all columns followed by an unpivot of
the single result row, so the table is read once however many columns it has.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envspark.profiles import MEASURES, POLLUTANTS, SENTINELS, Profile, profile_of

_NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType)


def _present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def _is_missing(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def unpivot_row(row: DataFrame, records: Sequence[Column]) -> DataFrame:
    """One output row per struct in `records`, all taken from a one-row frame."""
    return row.select(F.inline(F.array(*records)))


# --- cleaning ---------------------------------------------------------------

def nullify_sentinels(df: DataFrame, columns: Sequence[str] = MEASURES,
                      sentinels: Sequence[float] = SENTINELS,
                      overrides: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """Sentinels and NaN become NULL.

    The defaults treat -1 as missing in every column, a temperature of -1
    included; `overrides` gives single columns their own sentinels.
    """
    overrides = overrides or {}

    def cleaned(name):
        # NaN equals itself in Spark, so one IN covers it too and the column is
        # written out only twice when later filters are pushed through here
        missing = [f"{float(v)!r}D" for v in overrides.get(name, sentinels)] + ["double('NaN')"]
        return F.expr(f"CASE WHEN `{name}` IN ({', '.join(missing)}) THEN NULL ELSE `{name}` END")

    return df.withColumns({c: cleaned(c) for c in _present(df, columns)})


def column_means(df: DataFrame, columns: Sequence[str]) -> Column:
    """Means of `columns` as one struct-valued scalar subquery: one pass, nothing collected."""
    return df.agg(F.struct(*[F.avg(f"`{c}`").alias(c) for c in columns]).alias("means")).scalar()


def fill_missing(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """NULL and NaN of each named column become the given value."""
    return df.withColumns({
        c: F.coalesce(F.nanvl(F.col(c), F.lit(None).cast("double")), value)
        for c, value in values.items()
    })


def impute_mean(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """NULL and NaN become the column mean.

    The mean is that of the column as it comes in: sentinels count as values
    and one NaN makes the mean NaN unless they were nullified before.
    """
    columns = _present(df, columns)
    means = "_means"
    filled = fill_missing(df.withColumn(means, column_means(df, columns)),
                          {c: F.col(f"{means}.{c}") for c in columns})
    return filled.drop(means)


def valid_row() -> Column:
    """All six pollutants are known and not negative."""
    condition = F.col(POLLUTANTS[0]) >= 0
    for p in POLLUTANTS[1:]:
        condition = condition & (F.col(p) >= 0)
    return condition


def filter_valid(df: DataFrame) -> DataFrame:
    return df.filter(valid_row())


def quality_funnel(df: DataFrame) -> DataFrame:
    """Rows before the validity filter, after it and removed by it, in one pass."""
    counts = df.agg(F.count("*").alias("rows_before"), F.count_if(valid_row()).alias("rows_after"))
    return counts.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def clean(df: DataFrame, profile: str | Profile, seen: Observation | None = None) -> DataFrame:
    """Missing-data stage of a profile. `seen` gets the counts of `quality_funnel` from the first job that
    runs the frame, without a pass of their own."""
    p = profile_of(profile)
    if p.sentinels:
        df = nullify_sentinels(df, sentinels=p.sentinels)
    df = impute_mean(df)
    if seen is not None:
        df = df.observe(seen, F.count(F.lit(1)).alias("rows_before"), F.count_if(valid_row()).alias("rows_after"))
    return filter_valid(df) if p.drop_invalid else df


def observed_funnel(seen: Observation) -> dict[str, int]:
    """The counts of a frame from `clean`, once a job has run it."""
    counts = seen.get
    return {**counts, "rows_removed": counts["rows_before"] - counts["rows_after"]}


# --- profiling --------------------------------------------------------------

def missing_profile(df: DataFrame, columns: Sequence[str] | None = None,
                    sentinels: Sequence[float] = SENTINELS) -> DataFrame:
    """Missing values per column: NULL or NaN, sentinels, total and percent; only columns with any."""
    columns = list(columns or df.columns)

    def special(name):
        if isinstance(df.schema[name].dataType, _NUMERIC):
            return F.count_if(F.col(name).isin(*[float(s) for s in sentinels]))
        return F.lit(0).cast("long")

    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(_is_missing(df, c)).alias(f"n_{c}") for c in columns],
        *[special(c).alias(f"s_{c}") for c in columns],
    )
    records = [
        F.struct(F.lit(c).alias("column"), F.col(f"n_{c}").alias("null_count"),
                 F.col(f"s_{c}").alias("special_missing"),
                 (F.col(f"n_{c}") + F.col(f"s_{c}")).alias("total_missing"),
                 F.try_divide(F.col(f"n_{c}") + F.col(f"s_{c}"), F.col("_rows")).alias("share"))
        for c in columns
    ]
    return (unpivot_row(counts, records)
            .filter(F.col("total_missing") > 0)
            .select("column", "null_count", "special_missing", "total_missing",
                    (F.col("share") * 100).alias("missing_pct")))


def range_profile(df: DataFrame, columns: Sequence[str] = MEASURES, digits: int = 2) -> DataFrame:
    """Minimum, maximum and mean per column; NULL where a column holds no value."""
    columns = _present(df, columns)
    stats = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns
                     for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg))])
    return unpivot_row(stats, [
        F.struct(F.lit(c).alias("column"),
                 *[F.round(F.col(f"{n}_{c}"), digits).alias(n) for n in ("min", "max", "mean")])
        for c in columns
    ])


def pollutant_stats(df: DataFrame, digits: int = 2) -> DataFrame:
    """Mean, minimum and maximum of the raw pollutants, sentinels included; 0 where there is none."""
    zero = F.lit(0.0)
    return (range_profile(df, POLLUTANTS, digits)
            .select(F.col("column").alias("pollutant"), F.coalesce("mean", zero).alias("mean"),
                    F.coalesce("min", zero).alias("min"), F.coalesce("max", zero).alias("max")))


def describe_long(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    """count, mean, sample standard deviation, minimum and maximum, one typed row per column."""
    stats = (("count", F.count), ("mean", F.avg), ("stddev", F.stddev_samp), ("min", F.min), ("max", F.max))
    row = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in stats])
    return unpivot_row(row, [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{n}_{c}").alias(n) for n, _ in stats])
        for c in columns
    ])
