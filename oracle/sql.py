"""The checked results as DuckDB SQL over the test tables.

Written separately from the library: the breakpoint tables, labels and rules
are stated again here, so that a wrong value in one place shows up.
"""

from __future__ import annotations

POLLUTANTS = ["pm25", "pm10", "no2", "co", "so2", "o3"]
MEASURES = POLLUTANTS + ["temp", "rh", "wind", "rain"]
LAG_NAMES = ["pm25_lag1", "pm25_lag3", "pm10_lag1", "aqi_lag1", "pm25_rolling_avg"]
FEATURES = (MEASURES + ["hour", "day_of_week", "month", "hour_sin", "hour_cos"] + LAG_NAMES
            + ["temp_humidity_interaction", "wind_pm25_interaction"])
INTERACTIONS = ["temp_humidity_interaction", "wind_pm25_interaction"]
LITE_INPUTS = [c for c in FEATURES if c != "rain"]


def dbl(text) -> str:
    return f"CAST({text} AS DOUBLE)"


def r(expr: str, digits: int = 6) -> str:
    return f"round({expr}, {digits})"


def half_up(expr: str, digits: int) -> str:
    """Round the shortest decimal form half up, as Spark does; NaN stays."""
    return (f"CASE WHEN isnan({expr}) THEN {expr} "
            f"ELSE CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE) END")


def comma(parts) -> str:
    return ", ".join(parts)


def query(ctes: list[tuple[str, str]], body: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in ctes) + "\n" + body


# --- readings ---------------------------------------------------------------

def _fourth(m: int, d: int) -> str:
    x = dbl(f"(event_id * {m}) % 100")
    return f"{x} * {x} * {x} * {x} / {dbl(d)}"


READINGS = ("readings", f"""
SELECT event_id AS reading_id,
  date_trunc('second', ts) + to_days(CAST(event_id % 366 AS INTEGER)) AS datetime,
  event_type AS station,
  CASE WHEN event_id % 97 = 0 THEN {dbl(-999)} WHEN event_id % 101 = 0 THEN {dbl(-1)}
       WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN {dbl("'NaN'")}
       WHEN event_id % 109 = 0 THEN {dbl(-5)} ELSE value * {dbl(1.25)} END AS pm25,
  CASE WHEN event_id % 89 = 0 THEN {dbl(-999)} ELSE value * {dbl(1.6)} END AS pm10,
  {_fourth(37, 150000)} AS no2, {_fourth(41, 6000000)} AS co, {_fourth(43, 350000)} AS so2,
  CASE WHEN event_id % 83 = 0 THEN NULL ELSE {_fourth(47, 700000)} END AS o3,
  {dbl("(event_id * 59) % 450")} / {dbl(10)} - {dbl(5)} AS temp,
  {dbl("20 + (event_id * 61) % 80")} AS rh,
  {dbl("(event_id * 67) % 120")} / {dbl(10)} AS wind,
  CASE WHEN event_id % 10 = 0 THEN {dbl("event_id % 70")} / {dbl(10)} ELSE {dbl(0)} END AS rain
FROM events""")

KEYS = ["reading_id", "datetime", "station"]

ZONE_ID = """CASE reading_id % 5 WHEN 0 THEN 'Zone_North' WHEN 1 THEN 'Zone_South'
 WHEN 2 THEN 'Zone_East' WHEN 3 THEN 'Zone_West' ELSE 'Zone_Central' END"""
ZONE_VALUE = """CASE WHEN pm25 % 5.0::DOUBLE = 0 THEN 'Zone_North' WHEN pm25 % 5.0::DOUBLE = 1 THEN 'Zone_South'
 WHEN pm25 % 5.0::DOUBLE = 2 THEN 'Zone_East' WHEN pm25 % 5.0::DOUBLE = 3 THEN 'Zone_West'
 ELSE 'Zone_Central' END"""

# --- cleaning ---------------------------------------------------------------

NULLED = ("nulled", f"""SELECT {comma(KEYS)}, {comma(
    f"CASE WHEN {m} = -999 OR {m} = -1 OR isnan({m}) THEN NULL ELSE {m} END AS {m}" for m in MEASURES)},
 {ZONE_ID} AS zone FROM readings""")
MEANS = ("means", f"SELECT {comma(f'avg({m}) AS mean_{m}' for m in MEASURES)} FROM nulled")
IMPUTED = ("imputed", f"""SELECT {comma(KEYS)}, {comma(f'coalesce({m}, mean_{m}) AS {m}' for m in MEASURES)}, zone
 FROM nulled CROSS JOIN means""")
VALID_IF = " AND ".join(f"{p} >= 0" for p in POLLUTANTS)
VALID = ("valid", f"SELECT * FROM imputed WHERE {VALID_IF}")
CLEAN = [READINGS, NULLED, MEANS, IMPUTED, VALID]

ZONED = ("zoned", f"SELECT {comma(KEYS)}, {comma(MEASURES)}, {ZONE_VALUE} AS zone FROM readings")
LITE_MEANS = ("lite_means", f"SELECT {comma(f'avg({m}) AS mean_{m}' for m in MEASURES)} FROM zoned")
LITE_CLEAN = ("lite_clean", f"""SELECT {comma(KEYS)}, {comma(
    f"CASE WHEN {m} IS NULL OR isnan({m}) THEN mean_{m} ELSE {m} END AS {m}" for m in MEASURES)}, zone
 FROM zoned CROSS JOIN lite_means""")
LITE = [READINGS, ZONED, LITE_MEANS, LITE_CLEAN]

# --- index ------------------------------------------------------------------
# One line per linear piece: concentration from, to, index from, to. The last
# piece of a pollutant goes on without end unless a cap is named. Fixed values.

FULL_PIECES = {
    "pm25": [(0, 12.0, 0, 50), (12.0, 35.4, 50, 100), (35.4, 55.4, 100, 150), (55.4, 150.4, 150, 200),
             (150.4, 250.4, 200, 300), (250.4, 350.4, 300, 400), (350.4, 500.4, 400, 500)],
    "pm10": [(0, 54, 0, 50), (54, 154, 50, 100), (154, 254, 100, 150),
             (254, 354, 150, 200), (354, 424, 200, 300), (424, 604, 300, 500)],
    "o3": [(0, 54, 0, 50), (54, 70, 50, 100), (70, 85, 100, 150), (85, 105, 150, 200), (105, 200, 200, 300)],
    "no2": [(0, 53, 0, 50), (53, 100, 50, 100), (100, 360, 100, 150), (360, 649, 150, 200)],
    "so2": [(0, 35, 0, 50), (35, 75, 50, 100), (75, 185, 100, 150), (185, 304, 150, 200)],
    "co": [(0, 4.4, 0, 50), (4.4, 9.4, 50, 100), (9.4, 12.4, 100, 150), (12.4, 15.4, 150, 200)],
}
LITE_PIECES = {
    "pm25": [(0, 12.0, 0, 50), (12.0, 35.4, 50, 100), (35.4, 55.4, 100, 150),
             (55.4, 150.4, 150, 200), (150.4, 250.4, 200, 300), (250.4, 500.4, 300, 500)],
    "pm10": [(0, 54, 0, 50), (54, 154, 50, 100), (154, 254, 100, 150),
             (254, 354, 150, 200), (354, 424, 200, 300), (424, 604, 300, 500)],
    "o3": [(0, 54, 0, 50), (54, 70, 50, 100), (70, 85, 100, 150), (85, 105, 150, 200), (105, 200, 200, 300)],
    "no2": [(0, 53, 0, 50), (53, 100, 50, 100), (100, 360, 100, 150)],
    "so2": [(0, 35, 0, 50), (35, 75, 50, 100), (75, 185, 100, 150)],
    "co": [(0, 4.4, 0, 50), (4.4, 9.4, 50, 100), (9.4, 12.4, 100, 150)],
}


def _case(column: str, rows: list[tuple], cap: str | None, missing: str) -> str:
    whens = []
    for i, (c0, c1, i0, i1) in enumerate(rows):
        slope = f"(({dbl(i1)} - {dbl(i0)}) / ({dbl(c1)} - {dbl(c0)}))"
        line = f"{dbl(i0)} + {slope} * ({column} - {dbl(c0)})"
        last = i == len(rows) - 1
        condition = f"{column} > {dbl(c0)}" if last and cap is None else f"{column} <= {dbl(c1)}"
        whens.append(f"WHEN {condition} THEN {line}")
    tail = f"WHEN {column} > {dbl(rows[-1][1])} THEN {dbl(cap)}" if cap else ""
    return f"CASE {' '.join(whens)} {tail} ELSE {missing} END"


def category(x: str) -> str:
    return (f"CASE WHEN {x} <= 50 THEN 'Good' WHEN {x} <= 100 THEN 'Moderate' "
            f"WHEN {x} <= 150 THEN 'Unhealthy for Sensitive Groups' WHEN {x} <= 200 THEN 'Unhealthy' "
            f"WHEN {x} <= 300 THEN 'Very Unhealthy' ELSE 'Hazardous' END")


FULL_SUB = comma(f"{_case(p, t, None, dbl(0))} AS aqi_{p}" for p, t in FULL_PIECES.items())
LITE_SUB = comma(f"{_case(p, t, '500' if p == 'pm25' else None, dbl(500) if p == 'pm25' else 'NULL')} AS aqi_{p}"
                 for p, t in LITE_PIECES.items())
SUB_NAMES = [f"aqi_{p}" for p in POLLUTANTS]
GREATEST = f"greatest({comma(SUB_NAMES)})"


def index_ctes(source: str, subs: str, prefix: str) -> list[tuple[str, str]]:
    return [(f"{prefix}sub", f"SELECT *, {subs} FROM {source}"),
            (f"{prefix}scored", f"SELECT *, {GREATEST} AS aqi FROM {prefix}sub"),
            (f"{prefix}indexed", f"SELECT *, {category('aqi')} AS aqi_category FROM {prefix}scored")]


FULL_INDEX = CLEAN + index_ctes("valid", FULL_SUB, "")
LITE_INDEX = LITE + index_ctes("lite_clean", LITE_SUB, "lite_")

# --- features ---------------------------------------------------------------


def calendar(pi: str) -> str:
    return f"""datetime AS timestamp, CAST(hour(datetime) AS INTEGER) AS hour,
 CAST(dayofweek(datetime) + 1 AS INTEGER) AS day_of_week, CAST(month(datetime) AS INTEGER) AS month,
 CAST(year(datetime) AS INTEGER) AS year,
 sin({dbl(2)} * {pi} * hour(datetime) / {dbl(24)}) AS hour_sin,
 cos({dbl(2)} * {pi} * hour(datetime) / {dbl(24)}) AS hour_cos"""


def history(frame: str) -> str:
    return f"""lag(pm25, 1) OVER w AS pm25_lag1, lag(pm25, 3) OVER w AS pm25_lag3, lag(pm10, 1) OVER w AS pm10_lag1,
 lag(aqi, 1) OVER w AS aqi_lag1, avg(pm25) OVER (w ROWS BETWEEN {frame}) AS pm25_rolling_avg"""


WINDOW = "WINDOW w AS (PARTITION BY zone ORDER BY datetime, reading_id)"
INTERACT = "temp * rh / 100 AS temp_humidity_interaction, wind * pm25 AS wind_pm25_interaction"

FULL_PI, LITE_PI = dbl("3.14159"), "pi()"
FULL_HISTORY = FULL_INDEX + [
    ("dated", f"SELECT *, {calendar(FULL_PI)} FROM indexed"),
    ("lagged", f"SELECT *, {history('3 PRECEDING AND 1 PRECEDING')} FROM dated {WINDOW}"),
    ("lag_means", "SELECT avg(pm25) AS m25, avg(pm10) AS m10, avg(aqi) AS ma FROM indexed"),
]
FULL_LAGS = {"pm25_lag1": "m25", "pm25_lag3": "m25", "pm10_lag1": "m10", "aqi_lag1": "ma",
             "pm25_rolling_avg": "m25"}
BASE = KEYS + MEASURES + ["zone"] + SUB_NAMES + ["aqi", "aqi_category"]
CALENDAR = ["timestamp", "hour", "day_of_week", "month", "year", "hour_sin", "hour_cos"]
FULL_FEATURES = FULL_HISTORY + [("features", f"""
SELECT {comma(BASE + CALENDAR)}, {comma(f'coalesce({n}, {m}) AS {n}' for n, m in FULL_LAGS.items())}, {INTERACT}
FROM lagged CROSS JOIN lag_means""")]

LITE_HISTORY = LITE_INDEX + [
    ("lite_dated", f"SELECT *, {calendar(LITE_PI)} FROM lite_indexed"),
    ("lite_lagged", f"SELECT *, {history('2 PRECEDING AND CURRENT ROW')} FROM lite_dated {WINDOW}"),
]
LITE_FILL = comma(f"CASE WHEN {n} IS NULL OR isnan({n}) THEN {dbl(0)} ELSE {n} END AS {n}" for n in LAG_NAMES)
LITE_FEATURES = LITE_HISTORY + [("lite_features", f"""
SELECT {comma(BASE)}, {comma(c for c in CALENDAR if c != 'year')}, {LITE_FILL}, {INTERACT}
FROM lite_lagged WHERE aqi IS NOT NULL""")]

# the assembler skips rows with a missing input, NaN included
LITE_VECTORS = LITE_FEATURES + [("lite_vectors", f"""SELECT * FROM lite_features
WHERE {' AND '.join(f'{c} IS NOT NULL AND NOT isnan({dbl(c)})' for c in LITE_INPUTS)}""")]

TEXT_OR_INT = {"reading_id", "datetime", "station", "zone", "aqi_category", "timestamp", "hour", "day_of_week",
               "month", "year"}


def rounded(columns, digits: int = 6) -> str:
    return comma(c if c in TEXT_OR_INT else f"{half_up(c, digits)} AS {c}" for c in columns)


# --- scored rows ------------------------------------------------------------

SCORED = FULL_HISTORY + [
    ("predictions", "SELECT *, aqi_lag1 AS prediction FROM lagged WHERE aqi_lag1 IS NOT NULL"),
    ("errors", "SELECT *, aqi - prediction AS prediction_error, abs(aqi - prediction) AS abs_error FROM predictions"),
]
SERVED = SCORED + [("served", f"""SELECT reading_id, datetime, zone, {comma(
    f'{half_up(c, 2 if c == "co" else 1)} AS {c}' for c in POLLUTANTS)},
 {half_up('aqi', 2)} AS actual_aqi, {half_up('prediction', 2)} AS predicted_aqi,
 {half_up('abs_error', 2)} AS error, aqi_category FROM errors""")]
SERVED_COLUMNS = comma(["datetime", "zone", *POLLUTANTS, "actual_aqi", "predicted_aqi", "error", "aqi_category"])

ZONE_STATS = ("zone_stats", f"""SELECT zone, {half_up('avg(prediction)', 2)} AS avg_predicted_aqi,
 {half_up('max(prediction)', 2)} AS max_predicted_aqi, {half_up('min(prediction)', 2)} AS min_predicted_aqi,
 {half_up('stddev_samp(prediction)', 2)} AS std_predicted_aqi, count(*) AS num_records
 FROM predictions GROUP BY zone""")
HOUR_AVG = ("hours", f"SELECT hour, {half_up('avg(prediction)', 2)} AS avg_aqi FROM predictions GROUP BY hour")

IS_TRAIN = ("((((reading_id + 42) % 2147483648) * 2654435761) % 4294967296) / 4294967296.0::DOUBLE < 0.8::DOUBLE")


def describe(source_ctes, table: str, columns, digits: int = 4) -> str:
    def stats(c):
        nan = f"coalesce(bool_or(isnan({c})), false)"
        known = f"CASE WHEN isnan({c}) THEN NULL ELSE {c} END"
        return (f"SELECT '{c}' AS \"column\", count({c}) AS count, {r(f'avg({c})', digits)} AS mean, "
                f"CASE WHEN {nan} THEN {dbl(chr(39) + 'NaN' + chr(39))} "
                f"ELSE {r(f'stddev_samp({known})', digits)} END AS stddev, "
                f"{r(f'min({c})', digits)} AS min, {r(f'max({c})', digits)} AS max FROM {table}")
    return query(source_ctes, " UNION ALL ".join(stats(c) for c in columns))


def ranges(table: str, name: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"{name}\", {half_up(f'min({c})', 2)} AS min, {half_up(f'max({c})', 2)} AS max, "
        f"{half_up(f'avg({c})', 2)} AS mean FROM {table}" for c in columns)


def missing(columns) -> str:
    parts = []
    for c in columns:
        nulls = f"count(*) FILTER (WHERE {c} IS NULL" + (f" OR isnan({c}))" if c in MEASURES else ")")
        special = "0" if c in ("datetime", "station") else f"count(*) FILTER (WHERE {c} = -999 OR {c} = -1)"
        parts.append(f"SELECT '{c}' AS \"column\", {nulls} AS null_count, CAST({special} AS BIGINT) AS special_missing, "
                     f"count(*) AS n FROM readings")
    return query([READINGS, ("counts", " UNION ALL ".join(parts))], f"""
SELECT "column", null_count, special_missing, null_count + special_missing AS total_missing,
 {r(f"(null_count + special_missing) / {dbl('n')} * 100")} AS missing_pct
FROM counts WHERE null_count + special_missing > 0""")


def correlations() -> str:
    pairs = [(a, b) for i, a in enumerate(MEASURES) for b in MEASURES[i + 1:]]
    row = comma(f"corr({a}, {b}) AS {a}_{b}" for a, b in pairs)

    def value(a, b):
        if a == b:
            return dbl(1)
        return f"{a}_{b}" if (a, b) in pairs else f"{b}_{a}"
    cells = " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, {r(value(a, b))} AS corr FROM m"
                               for a in MEASURES for b in MEASURES)
    return query(CLEAN + [("m", f"SELECT {row} FROM valid")], cells)


ZONE_RANK = ("ranks", """SELECT zone, row_number() OVER (ORDER BY count(*) DESC, zone) - 1 AS pos
 FROM zones GROUP BY zone""")
ZONES = ("zones", f"SELECT reading_id, {ZONE_ID} AS zone FROM readings")

HIGH = """SELECT * FROM (SELECT * FROM zone_stats WHERE avg_predicted_aqi > {t}
 UNION ALL SELECT * FROM (SELECT * FROM zone_stats ORDER BY avg_predicted_aqi DESC, zone LIMIT {n}) top
 WHERE NOT EXISTS (SELECT 1 FROM zone_stats WHERE avg_predicted_aqi > {t}))"""

PREVIOUS = "datetime, reading_id"

ORACLE: dict[str, str] = {
    "zone_category_summary": query(FULL_INDEX, f"""SELECT zone, aqi_category, count(*) AS readings,
 {r('avg(aqi)', 4)} AS avg_aqi, {r('max(aqi)', 4)} AS max_aqi FROM indexed GROUP BY zone, aqi_category"""),
    # sources, projections, filters
    "scan_readings": query([READINGS], f"SELECT {rounded(KEYS + MEASURES)} FROM readings"),
    "repartition_count": query([READINGS], "SELECT CAST(20 AS BIGINT) AS partitions, count(*) AS total_records FROM readings"),
    "project_pm": query([READINGS], "SELECT pm25, pm10 FROM readings"),
    "filter_high_pm25": query([READINGS], "SELECT reading_id, pm25 FROM readings WHERE pm25 > 50"),
    "row_count": query([READINGS], "SELECT count(*) AS total_records FROM readings"),
    # cleaning
    "nullify_sentinels": query([READINGS, NULLED], f"SELECT {rounded(['reading_id'] + MEASURES)} FROM nulled"),
    "impute_mean": query(CLEAN, f"SELECT {rounded(['reading_id'] + MEASURES)} FROM imputed"),
    "impute_mean_lite": query(LITE, f"SELECT {rounded(['reading_id'] + MEASURES)} FROM lite_clean"),
    "filter_valid": query(CLEAN, f"SELECT {rounded(['reading_id'] + MEASURES)} FROM valid"),
    "quality_funnel": query(CLEAN, f"""SELECT count(*) AS rows_before, count(*) FILTER (WHERE {VALID_IF}) AS rows_after,
 count(*) - count(*) FILTER (WHERE {VALID_IF}) AS rows_removed FROM imputed"""),
    "aqi_not_null": query([READINGS] + index_ctes("readings", LITE_SUB, "raw_"),
                          f"SELECT reading_id, {r('aqi')} AS aqi FROM raw_indexed WHERE aqi IS NOT NULL"),
    # profiling
    "missing_profile": missing(KEYS + MEASURES),
    "range_profile": query([READINGS], ranges("readings", "column", MEASURES)),
    "pollutant_stats": query([READINGS], ranges("readings", "pollutant", POLLUTANTS)),
    "describe_readings": describe([READINGS], "readings", MEASURES),
    "basic_stats": query([READINGS], f"""SELECT count(*) AS total_records, {half_up('avg(pm25)', 2)} AS avg_pm25,
 {half_up('avg(pm10)', 2)} AS avg_pm10, {half_up('max(pm25)', 2)} AS max_pm25, {half_up('min(pm25)', 2)} AS min_pm25
 FROM readings WHERE pm25 IS NOT NULL"""),
    "basic_stats_short": query([READINGS], f"""SELECT {half_up('avg(pm25)', 2)} AS avg_pm25,
 {half_up('max(pm25)', 2)} AS max_pm25, count(*) AS total_records FROM readings WHERE pm25 IS NOT NULL"""),
    "hourly_pattern_raw": query([READINGS], f"""SELECT CAST(hour(datetime) AS INTEGER) AS hour,
 {half_up('avg(pm25)', 2)} AS avg_pm25, {half_up('avg(pm10)', 2)} AS avg_pm10, count(*) AS record_count
 FROM readings WHERE pm25 IS NOT NULL GROUP BY hour(datetime)"""),
    "hourly_totals": query([READINGS], f"""SELECT CAST(hour(datetime) AS INTEGER) AS hour,
 {half_up('avg(pm25)', 2)} AS avg_pm25, {half_up('sum(pm25)', 2)} AS total_pm25, count(*) AS count
 FROM readings GROUP BY hour(datetime)"""),
    "distinct_dates": query([READINGS], "SELECT count(DISTINCT CAST(datetime AS DATE)) AS unique_dates FROM readings"),
    "totals": query([READINGS], f"""SELECT {r('sum(pm25)', 4)} AS total_pm25, {r('sum(pm10)', 4)} AS total_pm10,
 {r('avg(pm25)', 4)} AS avg_pm25 FROM readings"""),
    "correlation_matrix": correlations(),
    # index
    "subindex_full": query(FULL_INDEX, f"SELECT reading_id, {rounded(SUB_NAMES)} FROM sub"),
    "subindex_lite": query(LITE_INDEX, f"SELECT reading_id, {rounded(SUB_NAMES)} FROM lite_sub"),
    "subindex_generic": query([READINGS, NULLED], f"""SELECT reading_id, {r(f'''CASE WHEN pm25 IS NULL THEN NULL
 WHEN pm25 BETWEEN 0 AND 12.0::DOUBLE THEN (50 - 0) / (12.0::DOUBLE - 0) * pm25
 WHEN pm25 BETWEEN 12.1::DOUBLE AND 35.4::DOUBLE THEN (100 - 51) / (35.4::DOUBLE - 12.1::DOUBLE) * (pm25 - 12.1::DOUBLE) + 51
 WHEN pm25 BETWEEN 35.5::DOUBLE AND 55.4::DOUBLE THEN (150 - 101) / (55.4::DOUBLE - 35.5::DOUBLE) * (pm25 - 35.5::DOUBLE) + 101
 WHEN pm25 BETWEEN 55.5::DOUBLE AND 150.4::DOUBLE THEN (200 - 151) / (150.4::DOUBLE - 55.5::DOUBLE) * (pm25 - 55.5::DOUBLE) + 151
 WHEN pm25 BETWEEN 150.5::DOUBLE AND 250.4::DOUBLE THEN (300 - 201) / (250.4::DOUBLE - 150.5::DOUBLE) * (pm25 - 150.5::DOUBLE) + 201
 WHEN pm25 BETWEEN 250.5::DOUBLE AND 500.4::DOUBLE THEN (500 - 301) / (500.4::DOUBLE - 250.5::DOUBLE) * (pm25 - 250.5::DOUBLE) + 301
 ELSE 500.0::DOUBLE END''')} AS aqi_pm25 FROM nulled"""),
    "aqi_full": query(FULL_INDEX, f"SELECT reading_id, {r('aqi')} AS aqi, aqi_category FROM indexed"),
    "aqi_lite": query(LITE_INDEX, f"SELECT reading_id, {r('aqi')} AS aqi, aqi_category FROM lite_indexed"),
    "aqi_category": query([READINGS], f"""SELECT reading_id, pm10, {category('pm10')} AS category,
 {category('o3')} AS category_o3 FROM readings"""),
    "category_range_join": query(FULL_INDEX + [("bands", """SELECT * FROM (VALUES
 ('Good', '-inf'::DOUBLE, 50.0::DOUBLE), ('Moderate', 50, 100), ('Unhealthy for Sensitive Groups', 100, 150),
 ('Unhealthy', 150, 200), ('Very Unhealthy', 200, 300), ('Hazardous', 300, 'inf'::DOUBLE)) AS b(name, lo, hi)""")],
        f"""SELECT reading_id, {r('aqi')} AS aqi, name AS category FROM indexed
 LEFT JOIN bands ON aqi > lo AND aqi <= hi"""),
    "category_distribution": query(FULL_INDEX, "SELECT aqi_category, count(*) AS count FROM indexed GROUP BY aqi_category"),
    "category_share": query(FULL_INDEX, f"""SELECT aqi_category, count(*) AS count,
 {half_up(f"(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM indexed))", 1)} AS share_pct
 FROM indexed GROUP BY aqi_category"""),
    "describe_aqi": describe(FULL_INDEX, "indexed", ["aqi"]),
    "seasonal_quartiles": query(FULL_INDEX + [("seasonal", """SELECT CASE WHEN month(datetime) IN (12, 1, 2) THEN 'Winter'
 WHEN month(datetime) IN (3, 4, 5) THEN 'Spring' WHEN month(datetime) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season,
 aqi FROM indexed""")], f"""SELECT season, count(aqi) AS count, {r('min(aqi)')} AS min,
 {r('quantile_cont(aqi, 0.25)')} AS q1, {r('quantile_cont(aqi, 0.5)')} AS median,
 {r('quantile_cont(aqi, 0.75)')} AS q3, {r('max(aqi)')} AS max FROM seasonal GROUP BY season"""),
    # time and keys
    "parse_timestamp": query([READINGS, ("texts", """SELECT reading_id,
 CASE WHEN reading_id % 11 = 0 THEN strftime(datetime, '%Y/%m/%d %H:%M')
 ELSE strftime(datetime, '%Y-%m-%d %H:%M:%S') END AS datetime FROM readings""")],
        "SELECT reading_id, datetime, try_strptime(datetime, '%Y-%m-%d %H:%M:%S') AS timestamp FROM texts"),
    "calendar_features": query([READINGS], """SELECT reading_id, CAST(hour(datetime) AS INTEGER) AS hour,
 CAST(dayofweek(datetime) + 1 AS INTEGER) AS day_of_week, CAST(month(datetime) AS INTEGER) AS month,
 CAST(year(datetime) AS INTEGER) AS year FROM readings"""),
    "cyclic_hour_full": query([READINGS], f"""SELECT reading_id, CAST(hour(datetime) AS INTEGER) AS hour,
 {r(f'sin({dbl(2)} * {FULL_PI} * hour(datetime) / {dbl(24)})')} AS hour_sin,
 {r(f'cos({dbl(2)} * {FULL_PI} * hour(datetime) / {dbl(24)})')} AS hour_cos FROM readings"""),
    "cyclic_hour_lite": query([READINGS], f"""SELECT reading_id, CAST(hour(datetime) AS INTEGER) AS hour,
 {r(f'sin({dbl(2)} * pi() * hour(datetime) / {dbl(24)})')} AS hour_sin,
 {r(f'cos({dbl(2)} * pi() * hour(datetime) / {dbl(24)})')} AS hour_cos FROM readings"""),
    "zone_by_id": query([READINGS], f"SELECT reading_id, pm25, {ZONE_ID} AS zone FROM readings"),
    "zone_by_value": query([READINGS], f"SELECT reading_id, pm25, {ZONE_VALUE} AS zone FROM readings"),
    # windows and features
    "lags": query(FULL_HISTORY, f"SELECT reading_id, zone, {rounded(LAG_NAMES[:4])} FROM lagged"),
    "rolling_prev3": query(FULL_HISTORY, f"SELECT reading_id, zone, {r('pm25_rolling_avg')} AS pm25_rolling_avg FROM lagged"),
    "rolling_cur3": query(LITE_HISTORY, f"SELECT reading_id, zone, {r('pm25_rolling_avg')} AS pm25_rolling_avg FROM lite_lagged"),
    "rolling_global": query([READINGS, ("rolled", f"""SELECT reading_id, datetime, pm25,
 avg(pm25) OVER (ORDER BY {PREVIOUS} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS avg4
 FROM readings WHERE pm25 IS NOT NULL""")],
        f"SELECT reading_id, datetime, pm25, {half_up('avg4', 2)} AS rolling_avg_pm25 FROM rolled"),
    "rolling_global_head": query([READINGS, ("rolled", f"""SELECT reading_id, datetime, pm25,
 avg(pm25) OVER (ORDER BY {PREVIOUS} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS avg4
 FROM readings WHERE pm25 IS NOT NULL""")], f"""SELECT datetime, pm25, {half_up('avg4', 2)} AS rolling_avg_pm25
 FROM rolled ORDER BY {PREVIOUS} LIMIT 10"""),
    "fill_lags_mean": query(FULL_FEATURES, f"SELECT reading_id, {rounded(LAG_NAMES)} FROM features"),
    "fill_lags_zero": query(LITE_FEATURES, f"SELECT reading_id, {rounded(LAG_NAMES)} FROM lite_features"),
    "interactions": query(CLEAN, f"""SELECT reading_id, {r('temp * rh / 100')} AS temp_humidity_interaction,
 {r('wind * pm25')} AS wind_pm25_interaction FROM valid"""),
    "features_full": query(FULL_FEATURES, f"""SELECT {rounded(BASE + CALENDAR + LAG_NAMES
 + ['temp_humidity_interaction', 'wind_pm25_interaction'])} FROM features"""),
    "features_lite": query(LITE_FEATURES, f"""SELECT {rounded(BASE + [c for c in CALENDAR if c != 'year'] + LAG_NAMES
 + ['temp_humidity_interaction', 'wind_pm25_interaction'])} FROM lite_features"""),
    "feature_means": query(FULL_FEATURES, f"SELECT {comma(f'{r(f'avg({m})', 4)} AS avg_{m}' for m in MEASURES)} FROM features"),
    "ml_frame": query(FULL_FEATURES, f"""SELECT {rounded(FEATURES + ['aqi', 'zone', 'datetime', 'aqi_category', 'reading_id'])}
 FROM features WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES + ['aqi', 'zone', 'datetime', 'aqi_category'])}"""),
    # scored rows
    "prediction_errors": query(SCORED, f"SELECT {rounded(['reading_id', 'aqi', 'prediction', 'prediction_error', 'abs_error'])} FROM errors"),
    "describe_errors": describe(SCORED, "errors", ["prediction_error", "abs_error"]),
    "regression_metrics": query(SCORED, f"""SELECT count(*) AS n, {r('sqrt(avg(prediction_error * prediction_error))', 4)} AS rmse,
 {r('avg(abs_error)', 4)} AS mae,
 {r('1 - avg(prediction_error * prediction_error) / var_pop(aqi)', 4)} AS r2,
 {r('(1 - avg(prediction_error * prediction_error) / var_pop(aqi)) * 100', 4)} AS accuracy_percent FROM errors"""),
    "model_metrics": query(SCORED, f"""SELECT {half_up('(1 - avg(prediction_error * prediction_error) / var_pop(aqi))', 4)} AS r2,
 {half_up('sqrt(avg(prediction_error * prediction_error))', 2)} AS rmse, {half_up('avg(abs_error)', 2)} AS mae,
 {half_up('((1 - avg(prediction_error * prediction_error) / var_pop(aqi)) * 100)', 2)} AS accuracy_percent FROM errors"""),
    "error_by_category": query(SCORED, f"""SELECT aqi_category, {half_up('avg(abs_error)', 2)} AS mean_abs_error,
 count(*) AS count FROM errors GROUP BY aqi_category"""),
    "error_histogram": query(SCORED + [
        ("lim", f"SELECT min(prediction_error) AS lo, max(prediction_error) AS hi, (max(prediction_error) - min(prediction_error)) / {dbl(50)} AS w FROM errors"),
        ("counts", "SELECT least(CAST(floor((prediction_error - lo) / w) AS INTEGER), 49) AS bin, count(*) AS n FROM errors CROSS JOIN lim GROUP BY 1"),
        ("bins", "SELECT CAST(range AS INTEGER) AS bin FROM range(50)")],
        f"""SELECT bins.bin AS bin, {r('lo + bins.bin * w')} AS bin_start, coalesce(n, 0) AS count
 FROM bins CROSS JOIN lim LEFT JOIN counts ON bins.bin = counts.bin"""),
    "error_bands": query(SCORED, """SELECT CASE WHEN abs_error < 5 THEN 'small' WHEN abs_error < 15 THEN 'medium'
 ELSE 'large' END AS band, count(*) AS count FROM errors GROUP BY 1"""),
    "fit_actual_predicted": query(SCORED, f"""SELECT {r('regr_slope(prediction, aqi)')} AS slope,
 {r('regr_intercept(prediction, aqi)')} AS intercept, {r('corr(prediction, aqi)')} AS corr FROM predictions"""),
    "zone_analysis": query(SCORED + [ZONE_STATS], "SELECT * FROM zone_stats"),
    "zone_risk": query(SCORED + [ZONE_STATS], """SELECT *, CASE WHEN avg_predicted_aqi > 200 THEN 'CRITICAL'
 WHEN avg_predicted_aqi > 150 THEN 'HIGH' WHEN avg_predicted_aqi > 100 THEN 'MODERATE'
 WHEN avg_predicted_aqi > 50 THEN 'LOW' ELSE 'MINIMAL' END AS risk_level FROM zone_stats"""),
    "high_risk_zones": query(SCORED + [ZONE_STATS], HIGH.format(t=150, n=5)),
    "high_risk_zones_fallback": query(SCORED + [ZONE_STATS], HIGH.format(t=1000, n=3)),
    "hourly_risk": query(SCORED, f"""SELECT hour, {half_up('avg(prediction)', 2)} AS avg_predicted_aqi,
 {half_up('max(prediction)', 2)} AS max_aqi FROM predictions GROUP BY hour"""),
    "peak_hours_top5": query(SCORED + [HOUR_AVG], "SELECT * FROM hours ORDER BY avg_aqi DESC, hour LIMIT 5"),
    "peak_hours_top10": query(SCORED + [HOUR_AVG], "SELECT * FROM hours ORDER BY avg_aqi DESC, hour LIMIT 10"),
    "peak_low_hour": query(SCORED + [HOUR_AVG], """SELECT
 (SELECT hour FROM hours ORDER BY avg_aqi DESC, hour LIMIT 1) AS peak_hour, (SELECT max(avg_aqi) FROM hours) AS peak_aqi,
 (SELECT hour FROM hours ORDER BY avg_aqi, hour LIMIT 1) AS low_hour, (SELECT min(avg_aqi) FROM hours) AS low_aqi"""),
    "overall_prediction": query(SCORED, f"""SELECT {half_up('avg(prediction)', 2)} AS avg_aqi,
 {category('avg(prediction)')} AS aqi_category FROM predictions"""),
    "data_summary": query(SCORED, f"""SELECT (SELECT count(*) FROM readings) AS total_records,
 count(*) FILTER (WHERE {IS_TRAIN}) AS train_records, count(*) FILTER (WHERE NOT ({IS_TRAIN})) AS test_records,
 CAST(22 AS INTEGER) AS features_count, count(DISTINCT zone) AS zones_count,
 {half_up(f'avg(CASE WHEN NOT ({IS_TRAIN}) THEN prediction END)', 2)} AS avg_aqi FROM predictions"""),
    # serving and export
    "predictions_export": query(SCORED, f"""SELECT datetime, zone, {rounded(MEASURES[:9])}, {r('aqi')} AS aqi,
 {half_up('prediction', 2)} AS prediction, aqi_category FROM predictions """),
    "prediction_sample": query(SERVED, f"SELECT {SERVED_COLUMNS} FROM served ORDER BY {PREVIOUS} LIMIT 500"),
    "predictions_by_zone": query(SERVED, f"SELECT {SERVED_COLUMNS} FROM served WHERE zone = 'Zone_North'"),
    "predictions_by_category": query(SERVED, f"SELECT {SERVED_COLUMNS} FROM served WHERE aqi_category = 'Very Unhealthy'"),
    "predictions_page": query(SERVED, f"""SELECT {SERVED_COLUMNS} FROM served WHERE zone = 'Zone_South'
 ORDER BY {PREVIOUS} LIMIT 15 OFFSET 30"""),
    "predictions_page_deep": query(SERVED, f"SELECT {SERVED_COLUMNS} FROM served ORDER BY {PREVIOUS} LIMIT 100 OFFSET 5800"),
    "page_info": query(SCORED, """SELECT count(*) AS total, CAST(3 AS INTEGER) AS page,
 CAST(CASE WHEN (SELECT count(*) FROM predictions) = 0 THEN 0 ELSE greatest(1, ceil(count(*) / 15.0)) END AS BIGINT) AS pages
 FROM predictions WHERE zone = 'Zone_South'"""),
    # model
    "zone_index": query([READINGS, ZONES, ZONE_RANK], f"SELECT reading_id, zone, {dbl('pos')} AS zone_index FROM zones JOIN ranks USING (zone)"),
    "zone_onehot": query([READINGS, ZONES, ZONE_RANK], f"""SELECT reading_id, zone, {comma(
        f'CASE WHEN pos = {i} THEN {dbl(1)} ELSE {dbl(0)} END AS slot_{i}' for i in range(5))}
 FROM zones JOIN ranks USING (zone)"""),
    "assembled": query(FULL_FEATURES, f"""SELECT reading_id, CAST(22 AS INTEGER) AS dims,
 {comma(f'{half_up(dbl(c), 6)} AS {c}' for c in FEATURES)} FROM features"""),
    "scaled_features": query(FULL_FEATURES + [("spread", f"""SELECT {comma(
        f'avg({c}) AS mean_{c}, stddev_samp({c}) AS sd_{c}' for c in FEATURES)} FROM features""")],
        f"""SELECT reading_id, {comma(f'{r(f"({c} - mean_{c}) / sd_{c}")} AS z_{c}' for c in FEATURES)}
 FROM features CROSS JOIN spread"""),
    "assembled_lite": query(LITE_VECTORS, f"""SELECT reading_id, CAST(21 AS INTEGER) AS dims,
 {comma(f'{half_up(dbl(c), 6)} AS {c}' for c in LITE_INPUTS)} FROM lite_vectors"""),
    "scaled_features_lite": query(LITE_VECTORS + [("spread", f"""SELECT {comma(
        f'avg({c}) AS mean_{c}, stddev_samp({c}) AS sd_{c}' for c in LITE_INPUTS)} FROM lite_vectors""")],
        f"""SELECT reading_id, {comma(f'{r(f"({c} - mean_{c}) / sd_{c}")} AS z_{c}' for c in LITE_INPUTS)}
 FROM lite_vectors CROSS JOIN spread"""),
    "final_vector": query(FULL_FEATURES + [("spread", f"""SELECT {comma(
        f'avg({c}) AS mean_{c}, stddev_samp({c}) AS sd_{c}' for c in FEATURES)} FROM features"""),
        ("ranks", """SELECT zone, row_number() OVER (ORDER BY count(*) DESC, zone) - 1 AS pos
 FROM features GROUP BY zone""")],
        f"""SELECT reading_id, CAST(27 AS INTEGER) AS dims,
 {comma(f'{r(f"({c} - mean_{c}) / sd_{c}")} AS z_{c}' for c in FEATURES)},
 {comma(f'CASE WHEN pos = {i} THEN {dbl(1)} ELSE {dbl(0)} END AS slot_{i}' for i in range(5))}
 FROM features JOIN ranks USING (zone) CROSS JOIN spread"""),
    "csv_features": query(FULL_FEATURES, f"SELECT {rounded(BASE + CALENDAR + LAG_NAMES + INTERACTIONS)} FROM features"),
    "report_bundle": query(SCORED, """SELECT 'metrics' AS name, CAST(1 AS BIGINT) AS n_rows
 UNION ALL SELECT 'data', 1 UNION ALL SELECT 'pollutant_stats', 6
 UNION ALL SELECT 'zones', count(DISTINCT zone) FROM predictions
 UNION ALL SELECT 'hourly_pattern', count(DISTINCT hour) FROM predictions
 UNION ALL SELECT 'category_distribution', count(DISTINCT aqi_category) FROM predictions
 UNION ALL SELECT 'predictions', least(500, count(*)) FROM predictions"""),
    "rf_checked": query(FULL_FEATURES, f"""SELECT reading_id, zone, hour, {half_up('aqi', 6)} AS aqi, aqi_category,
 TRUE AS in_label_range, TRUE AS beats_persistence FROM features
 WHERE NOT ({IS_TRAIN}) AND {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES + ['aqi', 'zone', 'datetime', 'aqi_category'])}"""),
    "rf_checked_lite": query(LITE_VECTORS, f"""SELECT reading_id, zone, hour, {half_up('aqi', 6)} AS aqi, aqi_category,
 TRUE AS in_label_range, TRUE AS beats_persistence FROM lite_vectors WHERE NOT ({IS_TRAIN})"""),
    "importance_checked": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, TRUE AS adds_up, TRUE AS is_share, CAST(10 AS BIGINT) AS top_rows" for c in FEATURES + ["zone"]),
    "forecast_checked": "SELECT CAST(range AS INTEGER) AS hour, 'Zone_Central' AS zone, TRUE AS category_agrees,"
                        " TRUE AS not_negative FROM range(24)",
    "split_random_checked": query([READINGS], "SELECT count(*) AS total, TRUE AS disjoint, TRUE AS near_share FROM readings"),
    "split_hash": query([READINGS], f"SELECT reading_id, {IS_TRAIN} AS is_train FROM readings"),
    "forecast_frame": query(FULL_FEATURES + [
        ("m", f"SELECT {comma(f'avg({c}) AS {c}' for c in MEASURES)} FROM features"),
        ("hours24", "SELECT CAST(range AS INTEGER) AS hour FROM range(24)")],
        f"""SELECT hour, {rounded(MEASURES, 4)}, CAST(hour % 7 + 1 AS INTEGER) AS day_of_week, CAST(12 AS INTEGER) AS month,
 'Zone_Central' AS zone, {r('pm25', 4)} AS pm25_lag1, {r('pm25', 4)} AS pm25_lag3, {r('pm10', 4)} AS pm10_lag1,
 {dbl(100)} AS aqi_lag1, {r('pm25', 4)} AS pm25_rolling_avg, {r('temp * rh / 100', 4)} AS temp_humidity_interaction,
 {r('wind * pm25', 4)} AS wind_pm25_interaction, {dbl(0)} AS aqi, 'Unknown' AS aqi_category,
 {r(f'sin({dbl(2)} * {FULL_PI} * hour / {dbl(24)})', 4)} AS hour_sin,
 {r(f'cos({dbl(2)} * {FULL_PI} * hour / {dbl(24)})', 4)} AS hour_cos FROM hours24 CROSS JOIN m"""),
}

SEASON = """CASE WHEN month(datetime) IN (12, 1, 2) THEN 'Winter' WHEN month(datetime) IN (3, 4, 5) THEN 'Spring'
 WHEN month(datetime) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END"""
BAND_LOW = "(o_orderkey % 7919) * 0.0625::DOUBLE"
BAD_ROW = "CASE WHEN reading_id % 13 = 0 THEN 'pm25 is no double' WHEN reading_id % 19 = 0 THEN 'datetime is no timestamp' END"
TEST_ROWS = f"NOT ({IS_TRAIN}) AND " + " AND ".join(
    f"{c} IS NOT NULL" for c in FEATURES + ["aqi", "zone", "datetime", "aqi_category"])

ORACLE |= {
    # the same results by another way
    "category_by_table": ORACLE["category_range_join"],
    "subindex_by_table": ORACLE["subindex_generic"],
    "basic_stats_sql": ORACLE["basic_stats"],
    "basic_stats_short_sql": ORACLE["basic_stats_short"],
    "hourly_pattern_sql": ORACLE["hourly_pattern_raw"],
    "rolling_global_sql": ORACLE["rolling_global"],
    "quality_funnel_observed": ORACLE["quality_funnel"],
    "bundle_metrics": ORACLE["model_metrics"],
    "bundle_zones": ORACLE["zone_risk"],
    "bundle_hourly_pattern": ORACLE["hourly_risk"],
    "bundle_category_distribution": query(SCORED, "SELECT aqi_category, count(*) AS count FROM predictions GROUP BY aqi_category"),
    "bundle_predictions": ORACLE["prediction_sample"],
    "bundle_data": ORACLE["data_summary"],
    "bundle_pollutant_stats": ORACLE["pollutant_stats"],
    # bands, stored days, files
    "bands_join": query([READINGS], f"""SELECT reading_id, o_orderkey AS band FROM readings JOIN orders
 ON pm10 > {BAND_LOW} AND pm10 <= {BAND_LOW} + (o_orderkey % 4) * 0.0625::DOUBLE"""),
    "predictions_cursor_page": query(SERVED, f"SELECT {SERVED_COLUMNS} FROM served ORDER BY {PREVIOUS} LIMIT 100 OFFSET 300"),
    "seasonal_quartiles_sketched": query(FULL_INDEX, f"""SELECT {SEASON} AS season, count(aqi) AS count, TRUE AS q1_within,
 TRUE AS median_within, TRUE AS q3_within FROM indexed GROUP BY 1"""),
    "stored_days": query([READINGS, ("two", "SELECT DISTINCT CAST(datetime AS DATE) AS d FROM readings ORDER BY d LIMIT 2")],
        f"""SELECT reading_id, datetime, CASE WHEN d = (SELECT min(d) FROM two) THEN {dbl(0)} ELSE {half_up('pm10', 6)} END AS pm10
 FROM readings JOIN two ON CAST(datetime AS DATE) = d"""),
    "filter_high_pm25_stored": query([READINGS, ("start", "SELECT min(CAST(datetime AS DATE)) AS d FROM readings")],
        """SELECT reading_id, pm25 FROM readings, start
 WHERE pm25 > 50 AND CAST(datetime AS DATE) BETWEEN d + 100 AND d + 130"""),
    "csv_ingest": query([READINGS, ("judged", f"SELECT *, {BAD_ROW} AS reason FROM readings")],
        f"""SELECT reading_id, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, reason,
 {comma(f'CASE WHEN reason IS NULL THEN {c} END AS {c}' for c in ('datetime', 'station'))},
 {comma(f'CASE WHEN reason IS NULL THEN {half_up(m, 6)} END AS {m}' for m in MEASURES)} FROM judged"""),
    # the forest as a table of nodes
    "rf_scores_from_nodes": query(FULL_FEATURES, f"SELECT reading_id, TRUE AS agrees FROM features WHERE {TEST_ROWS}"),
    "rf_scores_from_nodes_lite": query(LITE_VECTORS, f"SELECT reading_id, TRUE AS agrees FROM lite_vectors WHERE NOT ({IS_TRAIN})"),
    "importance_from_nodes": " UNION ALL ".join(
        f"SELECT '{p}' AS profile, '{c}' AS feature, TRUE AS agrees"
        for p, inputs in (("full", FEATURES), ("lite", LITE_INPUTS)) for c in inputs + ["zone"]),
    "forecast_from_nodes": "SELECT CAST(range AS INTEGER) AS hour, TRUE AS agrees FROM range(24)",
}
