"""Readings tables: the schema, file readers and the stand-in derived from `events`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from envspark.functions.temporal import with_timestamp
from envspark.profiles import MEASURES

CSV_SCHEMA = T.StructType(
    [T.StructField("datetime", T.StringType())]
    + [T.StructField(m, T.DoubleType()) for m in MEASURES]
)
KEYED_CSV_SCHEMA = T.StructType([T.StructField("reading_id", T.LongType()), *CSV_SCHEMA.fields])


def typed(df: DataFrame) -> DataFrame:
    """Readings as the plans want them: `datetime` zone-free and a stable `reading_id`.

    Text that is no timestamp becomes NULL. Without an id the hash of the whole row stands for it, which
    needs no shuffle and does not depend on partitioning; equal rows share one and are interchangeable.
    """
    columns = list(df.columns)
    if "reading_id" in columns:
        df = df.withColumn("reading_id", F.col("reading_id").cast("long"))
    else:
        content = F.xxhash64(*[F.col(f"`{c}`") for c in columns])
        df = df.withColumn("reading_id", F.shiftrightunsigned(content, 12))  # exact as a double
    return with_timestamp(df, "datetime", "datetime", strict=False)


def read_readings(spark: SparkSession, path: str, infer: bool = False,
                  schema: T.StructType | None = None) -> DataFrame:
    """Header CSV of hourly readings, typed, with or without a `reading_id`.

    The explicit schema saves the inference scan and keeps whole-number columns double; only the
    header is looked at. `infer=True` asks Spark to look at the data instead.
    """
    reader = spark.read.option("header", True)
    if infer:
        return typed(reader.option("inferSchema", True).csv(path))
    if schema is None:
        header = reader.csv(path).columns
        known = {f.name: f for f in KEYED_CSV_SCHEMA.fields}
        # columns stand in the order of the file, whatever that is
        schema = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
    return typed(reader.schema(schema).csv(path))


def repartition(df: DataFrame, partitions: int = 20) -> DataFrame:
    """Round-robin spread of a badly split source. AQE sizes all later shuffles."""
    return df.repartition(partitions)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make `df` queryable by name from SQL text."""
    df.createOrReplaceTempView(name)
    return df


def _fourth_power(multiplier: int, divisor: int) -> str:
    # whole numbers below 100, so the power is exact
    return f"power(CAST((event_id * {multiplier}) % 100 AS DOUBLE), 4) / CAST({divisor} AS DOUBLE)"


READING_EXPRESSIONS = {
    "reading_id": "event_id",
    # the event's time cut to whole seconds, spread over all days of a year; by parts, which is cheaper than
    # interval arithmetic and does not depend on the session's time zone
    "datetime": "CAST(date_add(CAST(ts AS DATE), CAST(event_id % 366 AS INT)) AS TIMESTAMP_NTZ)"
                " + make_dt_interval(0, hour(ts), minute(ts), CAST(second(ts) AS DECIMAL(18, 6)))",
    "station": "event_type",
    "pm25": "CASE WHEN event_id % 97 = 0 THEN CAST(-999 AS DOUBLE)"
            " WHEN event_id % 101 = 0 THEN CAST(-1 AS DOUBLE)"
            " WHEN event_id % 103 = 0 THEN CAST(NULL AS DOUBLE)"
            " WHEN event_id % 107 = 0 THEN CAST('NaN' AS DOUBLE)"
            " WHEN event_id % 109 = 0 THEN CAST(-5 AS DOUBLE)"
            " ELSE value * CAST(1.25 AS DOUBLE) END",
    "pm10": "CASE WHEN event_id % 89 = 0 THEN CAST(-999 AS DOUBLE)"
            " ELSE value * CAST(1.6 AS DOUBLE) END",
    "no2": _fourth_power(37, 150000),
    "co": _fourth_power(41, 6000000),
    "so2": _fourth_power(43, 350000),
    "o3": "CASE WHEN event_id % 83 = 0 THEN CAST(NULL AS DOUBLE)"
          f" ELSE {_fourth_power(47, 700000)} END",
    "temp": "CAST((event_id * 59) % 450 AS DOUBLE) / CAST(10 AS DOUBLE) - CAST(5 AS DOUBLE)",
    "rh": "CAST(20 + (event_id * 61) % 80 AS DOUBLE)",
    "wind": "CAST((event_id * 67) % 120 AS DOUBLE) / CAST(10 AS DOUBLE)",
    "rain": "CASE WHEN event_id % 10 = 0 THEN CAST(event_id % 70 AS DOUBLE) / CAST(10 AS DOUBLE)"
            " ELSE CAST(0 AS DOUBLE) END",
}


def readings_from_events(events: DataFrame) -> DataFrame:
    """Readings derived row by row from an `events` table (one reading per event)."""
    return events.selectExpr(*[f"{text} AS {name}" for name, text in READING_EXPRESSIONS.items()])


def load_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of a test-data directory; a narrow projection over the Parquet scan."""
    return readings_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
