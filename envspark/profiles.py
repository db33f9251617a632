"""Fixed values and the two processing profiles.

The two profiles differ in almost every stage (missing data, index bands, zone
rule, rolling frame, lag fill, model inputs), so a profile is passed explicitly
and never mixed.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from types import MappingProxyType
from typing import Mapping

# ---------------------------------------------------------------------------
# Names, labels, thresholds and breakpoint tables that results
# have to agree with.
# ---------------------------------------------------------------------------

POLLUTANTS = ("pm25", "pm10", "no2", "co", "so2", "o3")
WEATHER = ("temp", "rh", "wind", "rain")
MEASURES = POLLUTANTS + WEATHER

SENTINELS = (-999.0, -1.0)

# label, upper edge (inclusive); the last label has no upper edge
CATEGORY_EDGES = (
    ("Good", 50.0),
    ("Moderate", 100.0),
    ("Unhealthy for Sensitive Groups", 150.0),
    ("Unhealthy", 200.0),
    ("Very Unhealthy", 300.0),
    ("Hazardous", None),
)

# The same six categories as (name, lo exclusive, hi inclusive) rows
CATEGORY_BANDS = (
    ("Good", float("-inf"), 50.0),
    ("Moderate", 50.0, 100.0),
    ("Unhealthy for Sensitive Groups", 100.0, 150.0),
    ("Unhealthy", 150.0, 200.0),
    ("Very Unhealthy", 200.0, 300.0),
    ("Hazardous", 300.0, float("inf")),
)

CATEGORY_SLUGS = {
    "good": "Good",
    "moderate": "Moderate",
    "sensitive": "Unhealthy for Sensitive Groups",
    "unhealthy": "Unhealthy",
    "very-unhealthy": "Very Unhealthy",
    "hazardous": "Hazardous",
}

# label, lower edge (exclusive); below all of them: MINIMAL
RISK_EDGES = (
    ("CRITICAL", 200.0),
    ("HIGH", 150.0),
    ("MODERATE", 100.0),
    ("LOW", 50.0),
)
RISK_FLOOR = "MINIMAL"
HIGH_RISK_THRESHOLD = 150.0

ZONES = ("Zone_North", "Zone_South", "Zone_East", "Zone_West", "Zone_Central")

# concentration edges -> index edges, piecewise linear; the last slope goes on
FULL_BANDS = {
    "pm25": ((0, 12.0, 35.4, 55.4, 150.4, 250.4, 350.4, 500.4),
             (0, 50, 100, 150, 200, 300, 400, 500)),
    "pm10": ((0, 54, 154, 254, 354, 424, 604), (0, 50, 100, 150, 200, 300, 500)),
    "o3": ((0, 54, 70, 85, 105, 200), (0, 50, 100, 150, 200, 300)),
    "no2": ((0, 53, 100, 360, 649), (0, 50, 100, 150, 200)),
    "so2": ((0, 35, 75, 185, 304), (0, 50, 100, 150, 200)),
    "co": ((0, 4.4, 9.4, 12.4, 15.4), (0, 50, 100, 150, 200)),
}
LITE_BANDS = {
    "pm25": ((0, 12.0, 35.4, 55.4, 150.4, 250.4, 500.4), (0, 50, 100, 150, 200, 300, 500)),
    "pm10": ((0, 54, 154, 254, 354, 424, 604), (0, 50, 100, 150, 200, 300, 500)),
    "o3": ((0, 54, 70, 85, 105, 200), (0, 50, 100, 150, 200, 300)),
    "no2": ((0, 53, 100, 360), (0, 50, 100, 150)),
    "so2": ((0, 35, 75, 185), (0, 50, 100, 150)),
    "co": ((0, 4.4, 9.4, 12.4), (0, 50, 100, 150)),
}

# The published gapped PM2.5 table: (c_lo, c_hi, i_lo, i_hi), both ends closed
GAPPED_PM25_BANDS = (
    (0.0, 12.0, 0.0, 50.0),
    (12.1, 35.4, 51.0, 100.0),
    (35.5, 55.4, 101.0, 150.0),
    (55.5, 150.4, 151.0, 200.0),
    (150.5, 250.4, 201.0, 300.0),
    (250.5, 500.4, 301.0, 500.0),
)
BEYOND_SCALE = 500.0

LAGS = (("pm25", 1), ("pm25", 3), ("pm10", 1), ("aqi", 1))
LAG_FEATURES = ("pm25_lag1", "pm25_lag3", "pm10_lag1", "aqi_lag1", "pm25_rolling_avg")
CALENDAR_FEATURES = ("hour", "day_of_week", "month", "hour_sin", "hour_cos")
INTERACTION_FEATURES = ("temp_humidity_interaction", "wind_pm25_interaction")

TRAIN_RATIO = 0.8
SEED = 42


@dataclass(frozen=True)
class Profile:
    """One consistent set of processing rules."""

    name: str
    bands: Mapping[str, tuple]
    sentinels: tuple[float, ...]
    drop_invalid: bool
    # value above the last concentration edge: None lets the last slope go on
    above_scale: Mapping[str, float]
    # sub-index of a missing reading; pollutants not named here give NULL
    missing_index: Mapping[str, float]
    zone_rule: str
    rolling_frame: tuple[int, int]
    lag_fill: str
    pi: float
    with_year: bool
    features: tuple[str, ...]
    forest: Mapping[str, object]


FULL = Profile(
    name="full",
    bands=MappingProxyType(FULL_BANDS),
    sentinels=SENTINELS,
    drop_invalid=True,
    above_scale=MappingProxyType({}),
    missing_index=MappingProxyType({p: 0.0 for p in POLLUTANTS}),
    zone_rule="id",
    rolling_frame=(-3, -1),
    lag_fill="mean",
    pi=3.14159,
    with_year=True,
    features=MEASURES + CALENDAR_FEATURES + LAG_FEATURES + INTERACTION_FEATURES,
    forest=MappingProxyType({"numTrees": 50, "maxDepth": 10, "minInstancesPerNode": 5,
                             "featureSubsetStrategy": "sqrt", "seed": SEED}),
)

LITE = Profile(
    name="lite",
    bands=MappingProxyType(LITE_BANDS),
    sentinels=(),
    drop_invalid=False,
    above_scale=MappingProxyType({"pm25": 500.0}),
    missing_index=MappingProxyType({"pm25": 500.0}),
    zone_rule="value",
    rolling_frame=(-2, 0),
    lag_fill="zero",
    pi=math.pi,
    with_year=False,
    features=tuple(m for m in MEASURES if m != "rain")
    + CALENDAR_FEATURES + LAG_FEATURES + INTERACTION_FEATURES,
    forest=MappingProxyType({"numTrees": 50, "maxDepth": 10, "seed": SEED}),
)

PROFILES = {"full": FULL, "lite": LITE}


def profile_of(profile: str | Profile) -> Profile:
    """Accept a profile or its name."""
    if isinstance(profile, Profile):
        return profile
    try:
        return PROFILES[profile]
    except KeyError:
        raise ValueError(f"unknown profile {profile!r}, expected one of {sorted(PROFILES)}") from None
