"""The 24-hour scenario: average conditions, only the hour moves."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from envspark.functions import indices
from envspark.ml.forest import score
from envspark.operators.features import with_cyclic_hour
from envspark.operators.quality import column_means
from envspark.profiles import MEASURES, Profile

# Fixed values of the scenario
SCENARIO_ZONE = "Zone_Central"
SCENARIO_MONTH = 12
SCENARIO_AQI_LAG = 100.0
UNKNOWN_CATEGORY = "Unknown"


def forecast_frame(features: DataFrame, hours: int = 24, profile: str | Profile = "full") -> DataFrame:
    """One row per hour with every model input; the averages come in as a scalar subquery."""
    spark = features.sparkSession
    mean = "_mean"
    rows = spark.range(hours).select(F.col("id").cast("int").alias("hour"),
                                     column_means(features, MEASURES).alias(mean))

    def avg(column):
        return F.col(f"{mean}.{column}")

    scenario = rows.select(
        "hour", *[avg(m).alias(m) for m in MEASURES],
        (F.col("hour") % 7 + 1).cast("int").alias("day_of_week"),
        F.lit(SCENARIO_MONTH).alias("month"), F.lit(SCENARIO_ZONE).alias("zone"),
        avg("pm25").alias("pm25_lag1"), avg("pm25").alias("pm25_lag3"), avg("pm10").alias("pm10_lag1"),
        F.lit(SCENARIO_AQI_LAG).alias("aqi_lag1"), avg("pm25").alias("pm25_rolling_avg"),
        (avg("temp") * avg("rh") / 100).alias("temp_humidity_interaction"),
        (avg("wind") * avg("pm25")).alias("wind_pm25_interaction"),
        F.lit(0.0).alias("aqi"), F.lit(UNKNOWN_CATEGORY).alias("aqi_category"))
    return with_cyclic_hour(scenario, profile)


def forecast(model: PipelineModel, scenario: DataFrame) -> DataFrame:
    """Predicted index and category per hour."""
    return (score(model, scenario)
            .select("hour", "zone", F.round("prediction", 1).alias("predicted_aqi"),
                    indices.category(F.col("prediction")).alias("predicted_category"))
            .orderBy("hour"))
