"""Hourly station series, features, labels and alerts, from the event stream's values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions.advisory import advisory_text, alert_text
from brightloom.functions.calendar import calendar_features
from brightloom.functions.common import FLOOD_BANDS, FLOOD_BANDS_REPORT, band, right_closed, rounded
from brightloom.operators import explore, metrics, series
from brightloom.operators.ordering import quantiles
from brightloom.plans.registry import Tables, query
from brightloom.session import cut

STATIONS = ["click", "error", "purchase", "signup", "view"]

# Rolling windows, lags and trend windows in hours, levels and horizons.
RAIN_WINDOWS = [1, 3, 6, 12, 24, 48, 72]
LEVEL_LAGS = [1, 2, 3, 6, 12, 24]
TREND_WINDOWS = [3, 6, 12, 24]
FLOOD_LEVEL = 750
WARNING_LEVEL = 700
HORIZONS = [6, 12, 24]

SERIES = """
hr AS (SELECT event_type AS station, date_trunc('hour', ts) AS hour, sum(value / 21) AS rain,
         avg(value * 10) AS mean_level FROM events GROUP BY 1, 2),
span AS (SELECT min(hour) AS lo, max(hour) AS hi FROM hr),
rain AS (SELECT g.station, g.hour, coalesce(rain, 0) AS rain FROM
   (SELECT station, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour
    FROM (SELECT DISTINCT station FROM hr), span) g LEFT JOIN hr ON g.station = hr.station AND g.hour = hr.hour),
own AS (SELECT station, unnest(generate_series(min(hour), max(hour), INTERVAL 1 HOUR)) AS hour FROM hr GROUP BY station),
near AS (SELECT own.station, own.hour, mean_level AS v,
    last_value(mean_level IGNORE NULLS) OVER up AS pv,
    last_value(CASE WHEN mean_level IS NOT NULL THEN own.hour END IGNORE NULLS) OVER up AS pt,
    first_value(mean_level IGNORE NULLS) OVER down AS nv,
    first_value(CASE WHEN mean_level IS NOT NULL THEN own.hour END IGNORE NULLS) OVER down AS nt
  FROM own LEFT JOIN hr ON own.station = hr.station AND own.hour = hr.hour
  WINDOW up AS (PARTITION BY own.station ORDER BY own.hour ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         down AS (PARTITION BY own.station ORDER BY own.hour ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
lvl AS (SELECT station, hour, CASE WHEN v IS NOT NULL THEN v WHEN nv IS NULL THEN pv
    ELSE pv + (nv - pv) * date_diff('hour', pt, hour) / date_diff('hour', pt, nt) END AS level FROM near),
lv AS (SELECT *, level - lag(level) OVER (PARTITION BY station ORDER BY hour) AS delta,
    CAST(coalesce(level >= 750, false) AS INTEGER) AS flag FROM lvl),
tot AS (SELECT hour, sum(rain) AS rain_total_mm, avg(rain) AS rain_mean_mm, max(rain) AS rain_max_station_mm FROM rain GROUP BY hour),
wl AS (SELECT hour, """ + ", ".join(
    f"max(level) FILTER (WHERE station = '{s}') AS {s}_level, max(delta) FILTER (WHERE station = '{s}') AS {s}_delta"
    for s in STATIONS) + """, max(level) AS wl_max, avg(level) AS wl_mean,
    CAST(coalesce(max(delta) > 5, false) AS INTEGER) AS wl_rising_flag, max(flag) AS any_flag FROM lv GROUP BY hour),
static AS (SELECT n_name AS area, n_nationkey, round(1 + avg(s_acctbal) / 1000, 3) AS elevation_m,
    count(*) * 1000 AS population FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL),
ground AS (SELECT n_name AS area, round(avg(CASE WHEN c_acctbal > 5000 THEN 1.0 ELSE 0.0 END), 3) AS impervious_ratio
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
"""
HOUR_TXT = "CAST(hour AS VARCHAR) AS hour"


def _txt(df: DataFrame) -> DataFrame:
    return rounded(df).withColumn("hour", F.col("hour").cast("string"))


def rain(t: Tables) -> DataFrame:
    readings = t.events.select("ts", F.col("event_type").alias("station"), (F.col("value") / 21).alias("rain"))
    return series.resample_sum(readings, "ts", "station", "rain")


def raw_levels(t: Tables) -> DataFrame:
    readings = t.events.select("ts", F.col("event_type").alias("station"), (F.col("value") * 10).alias("level"))
    return series.resample_mean(readings, "ts", "station", "level")


def levels(t: Tables) -> DataFrame:
    filled = series.interpolate(raw_levels(t), ["station"], "level")
    return series.delta_and_flag(filled, ["station"], "level", FLOOD_LEVEL)


def totals(t: Tables) -> DataFrame:
    return series.rain_totals(rain(t), "rain")


def level_hours(t: Tables) -> DataFrame:
    return series.level_summary(levels(t), "station", STATIONS)


def areas(t: Tables) -> DataFrame:
    """Nations as areas with attributes from their suppliers and customers."""
    sup = t.supplier.groupBy("s_nationkey").agg(
        F.round(1 + F.avg("s_acctbal") / 1000, 3).alias("elevation_m"),
        (F.count(F.lit(1)) * 1000).alias("population"))
    cus = t.customer.groupBy("c_nationkey").agg(
        F.round(F.avg(F.when(F.col("c_acctbal") > 5000, 1.0).otherwise(0.0)), 3).alias("impervious_ratio"))
    return (
        t.nation.join(sup, F.col("n_nationkey") == F.col("s_nationkey"))
        .join(cus, F.col("n_nationkey") == F.col("c_nationkey"))
        .select(F.col("n_name").alias("area"), "elevation_m", "impervious_ratio", "population")
    )


@query("ts_resample_sum", f"WITH {SERIES} SELECT station, {HOUR_TXT}, round(rain, 6) AS rain FROM rain")
def _(t):
    return _txt(rain(t))


@query("ts_resample_interpolate", f"WITH {SERIES} SELECT station, {HOUR_TXT}, round(level, 6) AS level FROM lvl")
def _(t):
    return _txt(series.interpolate(raw_levels(t), ["station"], "level"))


@query("ts_delta_flag", f"WITH {SERIES} SELECT station, {HOUR_TXT}, round(level, 6) AS level, round(delta, 6) AS delta, flag FROM lv")
def _(t):
    return _txt(levels(t))


@query("flood_wide_hourly", f"WITH {SERIES} SELECT {HOUR_TXT}, " + ", ".join(
    f"round(max(rain) FILTER (WHERE station = '{s}'), 6) AS {s}" for s in STATIONS) + " FROM rain GROUP BY rain.hour")
def _(t):
    return _txt(series.wide(rain(t), "station", STATIONS, "rain"))


def _rain_sql(r=lambda x: f"round({x}, 6)") -> str:
    cols = []
    for n in RAIN_WINDOWS:
        over = f"OVER (ORDER BY hour ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        cols += [f"{r(f'sum(rain_total_mm) {over}')} AS rain_sum_{n}h", f"{r(f'avg(rain_mean_mm) {over}')} AS rain_mean_{n}h",
                 f"{r(f'max(rain_total_mm) {over}')} AS rain_max_{n}h"]
    full = "OVER (ORDER BY hour ROWS BETWEEN 71 PRECEDING AND CURRENT ROW)"
    cols.append(r(f"CASE WHEN count(rain_total_mm) {full} = 72 THEN sum(rain_total_mm) {full} END") + " AS antecedent_rain_72h")
    cols += [f"{r(c)} AS {c}" for c in ("rain_total_mm", "rain_mean_mm", "rain_max_station_mm")]
    return ", ".join(cols)


@query("flood_rain_features", f"WITH {SERIES} SELECT {HOUR_TXT}, {_rain_sql()} FROM tot")
def _(t):
    return _txt(series.rain_features(totals(t), RAIN_WINDOWS))


@query("flood_rain_flags", f"""WITH {SERIES} SELECT {HOUR_TXT}, CAST(rain_total_mm > 20 AS INTEGER) AS rain_heavy_flag,
  CAST(rain_total_mm > 50 AS INTEGER) AS rain_extreme_flag, round(rain_max_station_mm, 6) AS rain_max_station_mm FROM tot""")
def _(t):
    return _txt(series.rain_flags(totals(t)).drop("rain_total_mm", "rain_mean_mm"))


def _lag_sql(r=lambda x: f"round({x}, 6)") -> str:
    return ", ".join(f"{r(f'lag(wl_max, {n}) OVER (ORDER BY hour)')} AS wl_max_lag_{n}h" for n in LEVEL_LAGS)


def _trend_sql(r=lambda x: f"round({x}, 6)") -> str:
    cols = []
    for n in TREND_WINDOWS:
        over = f"OVER (ORDER BY hour ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        cols += [r(f"CASE WHEN count(wl_max) {over} = {n} THEN max(wl_max) {over} END") + f" AS wl_max_roll_{n}h",
                 r(f"wl_max - lag(wl_max, {n}) OVER (ORDER BY hour)") + f" AS wl_max_trend_{n}h"]
    return ", ".join(cols)


@query("flood_level_lags", f"WITH {SERIES} SELECT {HOUR_TXT}, round(wl_max, 6) AS wl_max, {_lag_sql()} FROM wl")
def _(t):
    return _txt(series.lags(level_hours(t).select("hour", "wl_max"), "wl_max", LEVEL_LAGS))


@query("flood_level_trend", f"WITH {SERIES} SELECT {HOUR_TXT}, round(wl_max, 6) AS wl_max, wl_rising_flag, {_trend_sql()} FROM wl")
def _(t):
    base = level_hours(t).select("hour", "wl_max", "wl_rising_flag")
    return _txt(series.rolling_max_and_trend(base, "wl_max", TREND_WINDOWS))


ABOVE = """runs AS (SELECT *, sum(CAST(coalesce(wl_max < 700, false) AS INTEGER)) OVER (ORDER BY hour) AS island FROM wl),
above AS (SELECT * EXCLUDE (island), CAST(row_number() OVER (PARTITION BY island ORDER BY hour) - 1 AS INTEGER) AS hours_above_warning FROM runs)"""


@query("flood_hours_above", f"WITH {SERIES}, {ABOVE} SELECT {HOUR_TXT}, round(wl_max, 6) AS wl_max, hours_above_warning FROM above")
def _(t):
    return _txt(series.run_length_above(
        level_hours(t).select("hour", "wl_max"), "wl_max", WARNING_LEVEL, "hours_above_warning"))


def _labels(df: DataFrame, mode: str = "next") -> DataFrame:
    for h in HORIZONS:
        df = series.forward_label(df, "any_flag", h, f"flood_{h}h", mode=mode)
    return df


def _label_text(offset: bool) -> str:
    frames = [(h, 2 * h - 1) if offset else (1, h) for h in HORIZONS]
    return ", ".join(
        f"CAST(coalesce(max(any_flag) OVER (ORDER BY hour ROWS BETWEEN {a} FOLLOWING AND {b} FOLLOWING), 0) AS INTEGER) AS flood_{h}h"
        for h, (a, b) in zip(HORIZONS, frames))


@query("flood_label", f"WITH {SERIES} SELECT {HOUR_TXT}, any_flag, {_label_text(False)} FROM wl")
def _(t):
    return _txt(_labels(level_hours(t).select("hour", "any_flag")))


@query("flood_label_offset", f"WITH {SERIES} SELECT {HOUR_TXT}, any_flag, {_label_text(True)} FROM wl")
def _(t):
    return _txt(_labels(level_hours(t).select("hour", "any_flag"), "offset"))


CALENDAR_SQL = """CAST(hour(hour) AS INTEGER) AS hour_of_day, CAST(isodow(hour) - 1 AS INTEGER) AS day_of_week,
  CAST(month(hour) AS INTEGER) AS month, CAST(month(hour) >= 10 OR month(hour) <= 4 AS INTEGER) AS is_wet_season,
  CAST(month(hour) IN (1, 2) AS INTEGER) AS is_peak_month, CAST(hour(hour) BETWEEN 17 AND 21 AS INTEGER) AS is_storm_hour,
  round(sin(2 * 3.14159 * hour(hour) / 24), 6) AS hour_sin, round(cos(2 * 3.14159 * hour(hour) / 24), 6) AS hour_cos,
  round(sin(2 * 3.14159 * month(hour) / 12), 6) AS month_sin, round(cos(2 * 3.14159 * month(hour) / 12), 6) AS month_cos"""


@query("flood_calendar", f"WITH h AS (SELECT DISTINCT date_trunc('hour', ts) AS hour FROM events) SELECT {HOUR_TXT}, {CALENDAR_SQL} FROM h")
def _(t):
    hours = t.events.select(series.hour_of("ts").alias("hour")).distinct()
    return _txt(hours.withColumns(calendar_features(F.col("hour"))))


def shared_features(t: Tables) -> DataFrame:
    """Everything the areas have in common, once per hour."""
    wet = series.rain_flags(series.rain_features(totals(t), RAIN_WINDOWS))
    wl = level_hours(t)
    wl = series.rolling_max_and_trend(series.lags(wl, "wl_max", LEVEL_LAGS), "wl_max", TREND_WINDOWS)
    wl = _labels(series.run_length_above(wl, "wl_max", WARNING_LEVEL, "hours_above_warning"))
    label_names = [f"flood_{h}h" for h in HORIZONS]
    both = wet.join(wl, "hour", "left").withColumns(calendar_features(F.col("hour")))
    return both.fillna(0, subset=label_names)


def feature_matrix(t: Tables) -> DataFrame:
    """One row per area and hour after the warm-up; no feature is null."""
    return series.for_entities(cut(shared_features(t).dropna("any")), areas(t), "area")


_SHARED = ", ".join([f"{s}_{c}" for s in STATIONS for c in ("level", "delta")])
MATRIX = f"""{SERIES}, {ABOVE},
rf AS (SELECT hour, {_rain_sql(lambda x: x)}, CAST(rain_total_mm > 20 AS INTEGER) AS rain_heavy_flag,
   CAST(rain_total_mm > 50 AS INTEGER) AS rain_extreme_flag FROM tot),
wf AS (SELECT hour, {_SHARED}, wl_max, wl_mean, wl_rising_flag, any_flag, hours_above_warning, {_lag_sql(lambda x: x)},
   {_trend_sql(lambda x: x)}, {_label_text(False)} FROM above),
shared AS (SELECT * FROM rf JOIN wf USING (hour) WHERE antecedent_rain_72h IS NOT NULL AND wl_max_lag_24h IS NOT NULL
   AND wl_max_roll_24h IS NOT NULL AND wl_max_trend_24h IS NOT NULL AND """ + " AND ".join(
    f"{s}_level IS NOT NULL AND {s}_delta IS NOT NULL" for s in STATIONS) + "),\nmatrix AS (SELECT * FROM shared, static JOIN ground USING (area))"
MATRIX_COLS = ["rain_sum_6h", "rain_mean_24h", "rain_max_72h", "antecedent_rain_72h", "rain_heavy_flag", "wl_max", "wl_mean",
               "error_level", "view_delta", "wl_max_lag_12h", "wl_max_roll_24h", "wl_max_trend_6h", "hours_above_warning",
               "elevation_m", "impervious_ratio", "flood_6h", "flood_12h", "flood_24h"]


def _r(c: str) -> str:
    return c if c.startswith(("flood_", "hours_")) or c.endswith("_flag") else f"round({c}, 6) AS {c}"


@query("flood_feature_matrix", f"WITH {MATRIX} SELECT area, {HOUR_TXT}, {', '.join(map(_r, MATRIX_COLS))} FROM matrix")
def _(t):
    return _txt(feature_matrix(t).select("area", "hour", *MATRIX_COLS))


@query("flood_latest_row", f"WITH {MATRIX} SELECT area, {HOUR_TXT}, round(wl_max, 6) AS wl_max, flood_6h FROM matrix WHERE hour = (SELECT max(hour) FROM matrix)")
def _(t):
    return _txt(series.latest_row(feature_matrix(t).select("area", "hour", "wl_max", "flood_6h"), "area", "hour"))


@query("ts_time_split", f"""WITH {MATRIX}
SELECT CASE WHEN hour < TIMESTAMP '2024-01-21' THEN 'train' ELSE 'validation' END AS part, count(*) AS n,
  CAST(min(hour) AS VARCHAR) AS first_hour, CAST(max(hour) AS VARCHAR) AS last_hour
FROM matrix WHERE hour < TIMESTAMP '2024-01-29' GROUP BY 1""")
def _(t):
    parts = series.time_split(feature_matrix(t).select("area", "hour"), "hour", "2024-01-20", "2024-01-21", "2024-01-28")
    def one(df, name):
        return df.agg(F.count(F.lit(1)).alias("n"), F.min("hour").cast("string").alias("first_hour"),
                      F.max("hour").cast("string").alias("last_hour")).withColumn("part", F.lit(name))
    return one(parts[0], "train").unionByName(one(parts[1], "validation"))


@query("flood_interactions", f"""WITH {MATRIX}
SELECT area, {HOUR_TXT}, round((rain_sum_24h - avg(rain_sum_24h) OVER (PARTITION BY area)) / stddev_samp(rain_sum_24h) OVER (PARTITION BY area), 6) AS rain_z_24h,
  round(wl_max_trend_6h / 6, 6) AS level_velocity, round(rain_sum_72h / elevation_m, 6) AS rain_72h_low_ground,
  round(rain_sum_24h * impervious_ratio, 6) AS rain_24h_sealed FROM matrix""")
def _(t):
    m = feature_matrix(t).select("area", "hour", "rain_sum_24h", "rain_sum_72h", "wl_max_trend_6h", "elevation_m", "impervious_ratio")
    base = m.groupBy("area").agg(F.avg("rain_sum_24h").alias("_m"), F.stddev_samp("rain_sum_24h").alias("_s"))
    return _txt(m.join(base, "area").select(
        "area", "hour", ((F.col("rain_sum_24h") - F.col("_m")) / F.col("_s")).alias("rain_z_24h"),
        (F.col("wl_max_trend_6h") / 6).alias("level_velocity"),
        (F.col("rain_sum_72h") / F.col("elevation_m")).alias("rain_72h_low_ground"),
        (F.col("rain_sum_24h") * F.col("impervious_ratio")).alias("rain_24h_sealed")))


@query("ts_gap_impute", f"""WITH {SERIES},
isl AS (SELECT own.station, own.hour, mean_level AS level, count(mean_level) OVER (PARTITION BY own.station ORDER BY own.hour) AS island
  FROM own LEFT JOIN hr ON own.station = hr.station AND own.hour = hr.hour),
g AS (SELECT *, count(*) FILTER (WHERE level IS NULL) OVER (PARTITION BY station, island) AS gap,
  max(level) OVER (PARTITION BY station, island) AS last_known, avg(level) OVER (PARTITION BY hour) AS others FROM isl)
SELECT g.station, CAST(g.hour AS VARCHAR) AS hour, round(coalesce(g.level, CASE WHEN gap < 2 THEN last_known ELSE others END), 6) AS level,
  round(CASE WHEN g.level IS NOT NULL OR gap < 3 THEN lvl.level END, 6) AS level_linear
FROM g JOIN lvl ON g.station = lvl.station AND g.hour = lvl.hour""")
def _(t):
    raw = raw_levels(t)
    linear = series.gap_limited_fill(raw, "station", "level", 3, "linear").withColumnRenamed("level", "level_linear")
    return _txt(series.gap_limited_fill(raw, "station", "level", 2).join(linear, ["station", "hour"]))


# Fixed weights of a linear risk score.
DRIVERS = {"rain_sum_6h": 0.04, "rain_mean_24h": 0.1, "rain_max_72h": -0.02, "antecedent_rain_72h": 0.01, "wl_max": 0.03, "wl_mean": 0.02, "error_level": -0.004,
           "view_delta": 0.015, "wl_max_lag_12h": 0.006, "wl_max_roll_24h": -0.005, "wl_max_trend_6h": 0.02, "hours_above_warning": 0.05}


@query("flood_event_importance", f"WITH {MATRIX}, f AS (SELECT *, hour - row_number() OVER (ORDER BY hour) * INTERVAL 1 HOUR AS run FROM shared WHERE any_flag = 1), c AS (" + " UNION ALL ".join(
    f"SELECT run, '{c}' AS feature, avg({b!r} * ({c} - (SELECT avg({c}) FROM shared))) AS a FROM f GROUP BY run" for c, b in DRIVERS.items())
    + """), s AS (SELECT run, CAST(min(hour) AS VARCHAR) AS event_start, CAST(max(hour) AS VARCHAR) AS event_end, count(*) AS hours FROM f GROUP BY run)
SELECT event_start, event_end, hours, feature, round(a, 6) AS contribution, CASE WHEN a < 0 THEN 'down' ELSE 'up' END AS direction,
  CAST(row_number() OVER (PARTITION BY run ORDER BY abs(a) DESC, feature) AS INTEGER) AS position FROM c JOIN s USING (run) QUALIFY position <= 10""")
def _(t):
    found = metrics.event_importance(shared_features(t).dropna("any"), "any_flag", "hour", DRIVERS)
    return rounded(found).withColumns({c: F.col(c).cast("string") for c in ("event_start", "event_end")})


@query("eda_heatmap", "SELECT CAST(day(ts) AS INTEGER) AS day, " + ", ".join(
    f"round(avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) FILTER (WHERE hour(ts) = {h}), 6) AS \"{h}\"" for h in range(24))
    + " FROM events GROUP BY 1")
def _(t):
    ev = t.events.select(F.dayofmonth("ts").alias("day"), F.hour("ts").alias("h"),
                         F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("is_error"))
    return rounded(explore.heat_table(ev, "day", "h", range(24), "is_error"))


@query("eda_entity_rate", f"""WITH {SERIES} SELECT station, round(avg(flag) * 100, 6) AS rate_pct, CAST(sum(flag) AS BIGINT) AS total_flagged,
  CAST(any_value(n) AS BIGINT) AS readings FROM lv JOIN (SELECT event_type AS station, count(*) AS n FROM events GROUP BY 1) USING (station) GROUP BY station""")
def _(t):
    statics = t.events.groupBy(F.col("event_type").alias("station")).agg(F.count(F.lit(1)).alias("readings"))
    return rounded(explore.entity_profile(levels(t), "station", "flag", statics))


ELEV = ([0, 3, 5, 7, 15], ["lowest", "low", "middle", "high"])
WET = ([0, 1500, 2500, 3500, 100000], ["light", "moderate", "heavy", "extreme"])


def _case(col: str, spec) -> str:
    return "CASE " + " ".join(f"WHEN {col} > {a} AND {col} <= {b} THEN '{n}'" for a, b, n in zip(spec[0], spec[0][1:], spec[1])) + " END"


@query("eda_bucket_interaction", f"""WITH {MATRIX}
SELECT elev_bucket, """ + ", ".join(f"round(avg(flood_6h) FILTER (WHERE rain_bucket = '{n}'), 6) AS {n}" for n in WET[1]) + f"""
FROM (SELECT {_case('elevation_m', ELEV)} AS elev_bucket, {_case('rain_sum_72h', WET)} AS rain_bucket, flood_6h FROM matrix) GROUP BY 1""")
def _(t):
    m = feature_matrix(t).select(right_closed(F.col("elevation_m"), *ELEV).alias("elev_bucket"),
                                 right_closed(F.col("rain_sum_72h"), *WET).alias("rain_bucket"), "flood_6h")
    return rounded(explore.heat_table(m, "elev_bucket", "rain_bucket", WET[1], "flood_6h"))


@query("eda_imbalance", f"""WITH {SERIES}
SELECT station, count(flag) AS total_rows, CAST(sum(flag) AS BIGINT) AS flagged_rows, round(sum(flag) / count(flag) * 100, 6) AS flagged_pct,
  round((count(flag) - sum(flag)) / greatest(sum(flag), 1), 6) AS imbalance_ratio FROM lv GROUP BY station
UNION ALL SELECT 'all', count(flag), CAST(sum(flag) AS BIGINT), round(sum(flag) / count(flag) * 100, 6),
  round((count(flag) - sum(flag)) / greatest(sum(flag), 1), 6) FROM lv""")
def _(t):
    lv = cut(levels(t))
    whole = explore.imbalance(lv, "flag").withColumn("station", F.lit("all"))
    return rounded(explore.imbalance(lv, "flag", ["station"]).unionByName(whole))


@query("eda_tail_quantiles", """SELECT event_type, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99,
  max(value) AS top FROM events WHERE value > 0 GROUP BY 1""")
def _(t):
    return rounded(quantiles(t.events.filter("value > 0"), "value", {"p95": 0.95, "p99": 0.99, "top": 1.0}, ["event_type"]).drop("n"))


SCAN_WINDOWS = [1, 3, 6, 12, 24, 48, 72, 96, 120]
SCAN_LAGS = [0, 3, 6, 12, 24]


@query("eda_lag_corr", f"""WITH {SERIES},
f AS (SELECT any_flag, """ + ", ".join(f"sum(rain_total_mm) OVER (ORDER BY hour ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS sum_{n}h" for n in SCAN_WINDOWS)
       + ", " + ", ".join(f"lag(wl_max, {n}) OVER (ORDER BY hour) AS lag_{n}h" for n in SCAN_LAGS) + " FROM tot JOIN wl USING (hour)), s AS ("
       + " UNION ALL ".join([f"SELECT 'window' AS kind, 'sum_{n}h' AS feature, corr(sum_{n}h, any_flag) AS r FROM f" for n in SCAN_WINDOWS]
                            + [f"SELECT 'lag' AS kind, 'lag_{n}h' AS feature, corr(lag_{n}h, any_flag) AS r FROM f" for n in SCAN_LAGS])
       + ") SELECT kind, feature, round(r, 6) AS r, r = max(r) OVER (PARTITION BY kind) AS is_best FROM s")
def _(t):
    df = totals(t).join(level_hours(t).select("hour", "wl_max", "any_flag"), "hour")
    return rounded(explore.lag_window_scan(df, "rain_total_mm", "wl_max", "any_flag", SCAN_WINDOWS, SCAN_LAGS))


CORR_COLS = ["rain_sum_1h", "rain_sum_6h", "rain_sum_24h", "rain_sum_72h", "wl_max", "wl_max_lag_6h", "wl_max_lag_12h",
             "elevation_m", "impervious_ratio", "hour_of_day", "any_flag", "flood_6h"]


@query("eda_corr_matrix", f"WITH {MATRIX}, m2 AS (SELECT *, hour(hour) AS hour_of_day FROM matrix) " + " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", CASE WHEN abs(corr({a}, {b})) < 1e-9 THEN 0.0 ELSE round(corr({a}, {b}), 6) END AS r, coalesce(abs(corr({a}, {b})) > 0.85, false) AND '{b}' <> 'flood_6h' AS redundant FROM m2"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]))
def _(t):
    m = explore.correlation_matrix(feature_matrix(t).select(*CORR_COLS), CORR_COLS)
    pairs = explore.redundant_pairs(m, "flood_6h").select("left", "right", F.lit(True).alias("redundant"))
    out = rounded(m.join(pairs, ["left", "right"], "left").fillna(False, ["redundant"]))
    return out.withColumn("r", F.when(F.col("r") == 0, 0.0).otherwise(F.col("r")))  # no negative zero


@query("eda_top_with_target", f"WITH {MATRIX}, m2 AS (SELECT *, hour(hour) AS hour_of_day FROM matrix), c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, flood_6h)) AS r FROM m2" for c in CORR_COLS if c != "flood_6h")
    + ") SELECT feature, CASE WHEN r < 1e-9 THEN 0.0 ELSE round(r, 6) END AS abs_r FROM c ORDER BY round(r, 9) DESC NULLS LAST, feature LIMIT 5")
def _(t):
    m = explore.correlation_matrix(feature_matrix(t).select(*CORR_COLS), CORR_COLS)
    return rounded(explore.top_with_target(m, "flood_6h"))


# A fixed score per area and horizon, so that bands and texts can be checked: the share of
# its customers in debt, raised with the horizon.
def forecast(t: Tables) -> DataFrame:
    share = t.customer.groupBy("c_nationkey").agg(
        F.count_if(F.col("c_acctbal") < 0).alias("bad"), F.count(F.lit(1)).alias("n"))
    horizon = F.explode(F.array(*[F.lit(h) for h in HORIZONS])).alias("horizon")
    return (
        t.nation.join(share, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(areas(t).select("area", "population"), F.col("n_name") == F.col("area"))
        .select("area", "population", "bad", "n", horizon)
        .withColumn("probability", F.round(F.least(F.col("bad") * F.col("horizon") / (F.col("n") * 2.0), F.lit(0.99)), 4))
        .withColumn("risk_level", band(F.col("probability"), FLOOD_BANDS))
        .select("area", "population", "horizon", "probability", "risk_level")
    )


FORECAST = f"""{SERIES}, fc AS (
  SELECT area, population, horizon, probability, CASE WHEN probability < 0.2 THEN 'Aman' WHEN probability < 0.5 THEN 'Waspada'
    WHEN probability < 0.8 THEN 'Siaga' ELSE 'Awas' END AS risk_level FROM (
  SELECT area, population, horizon, round(least(bad * horizon / (n * 2.0), 0.99), 4) AS probability
  FROM static JOIN (SELECT c_nationkey, count(*) FILTER (WHERE c_acctbal < 0) AS bad, count(*) AS n FROM customer GROUP BY 1) c
    ON n_nationkey = c_nationkey, (SELECT unnest([6, 12, 24]) AS horizon)))"""


@query("flood_affected", f"""WITH {FORECAST}
SELECT horizon, count(*) FILTER (WHERE risk_level IN ('Siaga', 'Awas')) AS areas_at_risk,
  CAST(coalesce(sum(population) FILTER (WHERE risk_level IN ('Siaga', 'Awas')), 0) AS BIGINT) AS people_at_risk,
  arg_max(area, (probability, area)) AS top_area FROM fc GROUP BY horizon""")
def _(t):
    high = F.col("risk_level").isin("Siaga", "Awas")
    return forecast(t).groupBy("horizon").agg(
        F.count_if(high).alias("areas_at_risk"),
        F.coalesce(F.sum(F.when(high, F.col("population"))), F.lit(0)).alias("people_at_risk"),
        F.max_by("area", F.struct("probability", "area")).alias("top_area"))


@query("flood_advisory", f"""WITH {FORECAST}
SELECT area, horizon, 'bpbd' AS audience, 'PRIORITAS ' || upper(risk_level) || ': ' || area || ', probabilitas banjir '
  || CAST(round_even(probability * 100, 0) AS INTEGER) || '% dalam ' || horizon || ' jam. Rekomendasi: pre-positioning 2 perahu karet di pos siaga terdekat, '
  || 'koordinasi dengan kelurahan untuk identifikasi lansia/disabilitas yang perlu evakuasi dini, siapkan posko logistik dengan kapasitas 200 jiwa. Window aksi: '
  || greatest(2, horizon - 4) || ' jam.' AS message FROM fc
UNION ALL SELECT area, horizon, 'warga', CASE WHEN risk_level IN ('Siaga', 'Awas') THEN 'Wilayah ' || area || ' berisiko TINGGI banjir ('
  || CAST(round_even(probability * 100, 0) AS INTEGER) || '%) dalam ' || horizon || ' jam ke depan. Segera pindahkan kendaraan ke tempat tinggi, siapkan tas darurat berisi dokumen penting dan obat-obatan, dan pantau ketinggian air pintu air Manggarai. Jika air mulai naik di sekitar rumah, segera evakuasi ke titik aman terdekat.'
  WHEN risk_level = 'Waspada' THEN 'Wilayah ' || area || ' dalam status WASPADA banjir (' || CAST(round_even(probability * 100, 0) AS INTEGER) || '%) dalam ' || horizon
  || ' jam ke depan. Pantau perkembangan cuaca dan ketinggian air, siapkan rencana evakuasi keluarga, dan simpan barang berharga di tempat yang lebih tinggi.'
  ELSE 'Wilayah ' || area || ' dalam status AMAN (' || CAST(round_even(probability * 100, 0) AS INTEGER) || '% risiko) untuk ' || horizon || ' jam ke depan. Tetap pantau update.' END FROM fc
UNION ALL SELECT area, horizon, 'perencana', 'Analisis ' || area || ': probabilitas banjir ' || CAST(round_even(probability * 100, 0) AS INTEGER) || '% horizon ' || horizon
  || 'h didorong oleh faktor hidrologis dan tutupan lahan. Pola ini konsisten dengan kelurahan dengan elevasi rendah dan akumulasi curah hujan tinggi. Implikasi: prioritas program RTH dan normalisasi drainase di wilayah ini untuk mitigasi jangka panjang.' FROM fc""")
def _(t):
    audience = F.explode(F.array(*[F.lit(a) for a in ("bpbd", "warga", "perencana")])).alias("audience")
    rows = forecast(t).select("area", "horizon", "probability", "risk_level", audience)
    return rows.select("area", "horizon", "audience", advisory_text(
        F.col("audience"), F.col("area"), F.col("probability"), F.col("horizon"), F.col("risk_level")).alias("message"))


# Weights of the area attributes in a linear score, for the drivers of an alert.
AREA_WEIGHTS = {"elevation_m": -0.4, "impervious_ratio": 3.0, "population": 0.0001}


@query("flood_alert_text", f"""WITH {FORECAST}, attr AS (SELECT * FROM static JOIN ground USING (area)), lo AS (""" + " UNION ALL ".join(
    f"SELECT area, '{c}' AS feature, {c}::DOUBLE AS value, {b} * ({c} - (SELECT avg({c}) FROM attr)) AS a FROM attr" for c, b in AREA_WEIGHTS.items()) + """),
dr AS (SELECT area, string_agg('  • ' || replace(feature, '_', ' ') || ': ' || printf('%.1f', value) || ' (↑ risk)', chr(10) ORDER BY a DESC, feature) AS drivers FROM lo WHERE a > 0.001 GROUP BY area),
ls AS (SELECT strftime(max(ts), '%Y-%m-%d %H:%M') AS t FROM events)
SELECT area, '[' || t || '] PERINGATAN BANJIR — Level: ' || replace(risk_level, 'Awas', 'Bahaya') || chr(10) || 'Probabilitas: ' || printf('%.1f', probability * 100)
  || '% dalam 24 jam ke depan' || chr(10) || 'Faktor utama:' || chr(10) || coalesce(drivers, '') AS message FROM fc LEFT JOIN dr USING (area), ls WHERE horizon = 24""")
def _(t):
    up = metrics.linear_attribution(areas(t), "area", AREA_WEIGHTS, 3).filter("direction = 'up'")
    drivers = up.groupBy("area").agg(F.array_sort(F.collect_list(F.struct(
        "position", "feature", "value", F.lit("↑ risk").alias("direction")))).alias("drivers"))
    now = t.events.agg(F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm")).scalar()
    none = F.array().cast("array<struct<position:int,feature:string,value:double,direction:string>>")
    return forecast(t).filter("horizon = 24").join(drivers, "area", "left").select("area", alert_text(
        now, F.col("probability"), F.col("horizon"), band(F.col("probability"), FLOOD_BANDS_REPORT), F.coalesce("drivers", none)).alias("message"))
