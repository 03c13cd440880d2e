"""Regular time series: resampling, rolling features, runs and forward labels.

Raw readings are folded to one row per (series, hour) before any window runs, so a
window partition holds at most the hours of the calendar (a century is under 900,000
rows), however many raw rows a series has. The folded table is frozen where a function
needs it more than once, so the raw readings are scanned once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from brightloom.operators.quality import union_all
from brightloom.session import cut


def hour_of(ts: str) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def _hours(lo: Column, hi: Column) -> Column:
    return F.sequence(lo, hi, F.expr("interval 1 hour"))


def _ordered(keys: Sequence[str], time: str = "hour") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(time)


def resample_sum(df: DataFrame, ts: str, station: str, value: str) -> DataFrame:
    """Hourly sums of every station over the common range; a missing hour is 0."""
    hourly = cut(df.groupBy(station, hour_of(ts).alias("hour")).agg(F.sum(value).alias(value)))
    span = hourly.agg(F.struct(F.min("hour").alias("lo"), F.max("hour").alias("hi"))).scalar()
    grid = (
        hourly.select(station).distinct().withColumn("_s", span)
        .select(station, F.explode(_hours(F.col("_s.lo"), F.col("_s.hi"))).alias("hour"))
    )
    return grid.join(hourly, [station, "hour"], "left").select(
        station, "hour", F.coalesce(F.col(value), F.lit(0)).alias(value)
    )


def resample_mean(df: DataFrame, ts: str, station: str, value: str) -> DataFrame:
    """Hourly means of each station over its own range; a missing hour is null."""
    hourly = cut(df.groupBy(station, hour_of(ts).alias("hour")).agg(F.avg(value).alias(value)))
    grid = hourly.groupBy(station).agg(F.min("hour").alias("lo"), F.max("hour").alias("hi")).select(
        station, F.explode(_hours(F.col("lo"), F.col("hi"))).alias("hour")
    )
    return grid.join(hourly, [station, "hour"], "left")


def interpolate(df: DataFrame, keys: Sequence[str], value: str, time: str = "hour") -> DataFrame:
    """Fill nulls on the line between the neighbours; a trailing gap repeats the last
    value and a leading gap stays null. Rows must be regular in ``time``."""
    w = _ordered(keys, time)
    behind, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    known = F.when(F.col(value).isNotNull(), F.col("_i"))
    pv, pi = F.last(value, True).over(behind), F.last(known, True).over(behind)
    nv, ni = F.first(value, True).over(ahead), F.first(known, True).over(ahead)
    line = pv + (nv - pv) * (F.col("_i") - pi) / (ni - pi)
    return (
        df.withColumn("_i", F.row_number().over(w))
        .withColumn("_x", F.when(F.col(value).isNotNull(), F.col(value)).when(nv.isNull(), pv).otherwise(line))
        .withColumn(value, F.col("_x")).drop("_i", "_x")
    )


def delta_and_flag(df: DataFrame, keys: Sequence[str], value: str, threshold: float) -> DataFrame:
    """Change since the previous hour, and whether the threshold is reached (null is no)."""
    return df.withColumns({
        "delta": F.col(value) - F.lag(value).over(_ordered(keys)),
        "flag": F.coalesce(F.col(value) >= threshold, F.lit(False)).cast("int"),
    })


def wide(df: DataFrame, station: str, stations: Sequence[str], value: str) -> DataFrame:
    """One column per station; hours outside a station's range are null."""
    return df.groupBy("hour").pivot(station, list(stations)).agg(F.first(value))


def rain_totals(rain: DataFrame, value: str) -> DataFrame:
    return rain.groupBy("hour").agg(
        F.sum(value).alias("rain_total_mm"), F.avg(value).alias("rain_mean_mm"),
        F.max(value).alias("rain_max_station_mm"),
    )


def rain_features(totals: DataFrame, windows: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    """Rolling sum, mean and maximum over partial windows; one strict 72-hour sum."""
    w = _ordered(keys)
    cols = {}
    for n in windows:
        frame = w.rowsBetween(-(n - 1), 0)
        cols[f"rain_sum_{n}h"] = F.sum("rain_total_mm").over(frame)
        cols[f"rain_mean_{n}h"] = F.avg("rain_mean_mm").over(frame)
        cols[f"rain_max_{n}h"] = F.max("rain_total_mm").over(frame)
    full = w.rowsBetween(-71, 0)
    cols["antecedent_rain_72h"] = F.when(
        F.count("rain_total_mm").over(full) == 72, F.sum("rain_total_mm").over(full)
    )
    return totals.withColumns(cols)


def rain_flags(totals: DataFrame, heavy: float = 20, extreme: float = 50) -> DataFrame:
    return totals.withColumns({
        "rain_heavy_flag": (F.col("rain_total_mm") > heavy).cast("int"),
        "rain_extreme_flag": (F.col("rain_total_mm") > extreme).cast("int"),
    })


def level_summary(levels: DataFrame, station: str, stations: Sequence[str]) -> DataFrame:
    """Per hour: each station's level and change, and the aggregates over stations."""
    per = [
        F.max(F.when(F.col(station) == s, F.col(c))).alias(f"{s}_{c}")
        for s in stations for c in ("level", "delta")
    ]
    return levels.groupBy("hour").agg(
        *per, F.max("level").alias("wl_max"), F.avg("level").alias("wl_mean"),
        F.coalesce(F.max("delta") > 5, F.lit(False)).cast("int").alias("wl_rising_flag"),
        F.max("flag").alias("any_flag"),
    )


def lags(df: DataFrame, value: str, steps: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    return df.withColumns({f"{value}_lag_{n}h": F.lag(value, n).over(_ordered(keys)) for n in steps})


def rolling_max_and_trend(df: DataFrame, value: str, windows: Sequence[int], keys: Sequence[str] = ()) -> DataFrame:
    w = _ordered(keys)
    cols = {}
    for n in windows:
        frame = w.rowsBetween(-(n - 1), 0)
        cols[f"{value}_roll_{n}h"] = F.when(F.count(value).over(frame) == n, F.max(value).over(frame))
        cols[f"{value}_trend_{n}h"] = F.col(value) - F.lag(value, n).over(w)
    return df.withColumns(cols)


def run_length_above(df: DataFrame, value: str, level: float, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows since the last one below ``level``; that row itself, and a series that starts
    above, count from 0."""
    below = F.coalesce(F.col(value) < level, F.lit(False)).cast("int")
    island = F.sum(below).over(_ordered(keys).rowsBetween(Window.unboundedPreceding, 0))
    pos = F.row_number().over(Window.partitionBy(*keys, "_island").orderBy("hour")) - 1
    return df.withColumn("_island", island).withColumn(name, pos).drop("_island")


def forward_label(df: DataFrame, flag: str, horizon: int, name: str, keys: Sequence[str] = (), mode: str = "next") -> DataFrame:
    """Whether the flag is raised ahead. ``next`` looks at rows t+1 … t+H; ``offset``
    looks at t+H … t+2H-1."""
    frame = (1, horizon) if mode == "next" else (horizon, 2 * horizon - 1)
    ahead = F.max(flag).over(_ordered(keys).rowsBetween(*frame))
    return df.withColumn(name, F.coalesce(ahead, F.lit(0)).cast("int"))


def time_split(df: DataFrame, ts: str, train_end: str, val_start: str, val_end: str) -> tuple[DataFrame, DataFrame]:
    """Train up to a day inclusive, validation between two days inclusive."""
    day = F.to_date(ts)
    return df.filter(day <= F.lit(train_end).cast("date")), df.filter(
        day.between(F.lit(val_start).cast("date"), F.lit(val_end).cast("date")))


def known_by(df: DataFrame, ts: str, horizon: int) -> DataFrame:
    """Rows whose label looks at hours that have all passed: those ``horizon`` hours before the
    newest one and earlier. Later rows would be trained on labels cut off by the end."""
    newest = df.agg(F.max(ts)).scalar()
    return df.filter(F.col(ts) <= newest - F.make_dt_interval(hours=F.lit(horizon)))


def training_frames(df: DataFrame, ts: str, labels: dict[int, str]) -> DataFrame:
    """One row per horizon: the span that it is trained on, its rows and positives, and the
    hour that is scored."""
    newest = df.agg(F.max(ts)).scalar()
    return union_all([
        known_by(df, ts, h).agg(F.min(ts).alias("first_hour"), F.max(ts).alias("last_hour"), F.count(F.lit(1)).alias("n"), F.sum(F.col(c).cast("long")).alias("positives"))
        .select(F.lit(h).alias("horizon"), "first_hour", "last_hour", "n", "positives", newest.alias("scored_hour"))
        for h, c in labels.items()])


def latest_row(df: DataFrame, entity: str, time: str) -> DataFrame:
    rest = [c for c in df.columns if c != entity]
    return df.groupBy(entity).agg(F.max_by(F.struct(*rest), F.col(time)).alias("_r")).select(entity, "_r.*")


def for_entities(shared: DataFrame, entities: DataFrame, entity: str, time: str = "hour") -> DataFrame:
    """Every entity with every hour, its own attributes and the shared features.

    Each entity lists the hours itself and meets the features by an equal join on the
    hour, so the work is the size of the result.
    """
    span = shared.agg(F.struct(F.min(time).alias("lo"), F.max(time).alias("hi"))).scalar()
    listed = entities.withColumn("_s", span).withColumn(
        time, F.explode(_hours(F.col("_s.lo"), F.col("_s.hi")))).drop("_s")
    return listed.join(shared, time)


def gap_limited_fill(
    df: DataFrame, station: str, value: str, short: int, method: str = "forward"
) -> DataFrame:
    """Fill only by the rule that fits the gap's length.

    ``forward``: gaps under ``short`` hours repeat the last value, longer ones take the
    mean of the other stations in that hour. ``linear``: gaps under ``short`` hours are
    interpolated, longer ones stay null.
    """
    w = _ordered([station])
    behind = w.rowsBetween(Window.unboundedPreceding, 0)
    island = F.count(value).over(behind)
    gap = F.count_if(F.col(value).isNull()).over(Window.partitionBy(station, "_island"))
    marked = df.withColumn("_island", island).withColumn("_gap", gap)
    is_short = F.col("_gap") < short
    if method == "linear":
        filled = interpolate(marked.withColumn("_raw", F.col(value)), [station], value)
        return filled.withColumn(
            value, F.when(F.col("_raw").isNotNull() | is_short, F.col(value))
        ).drop("_island", "_gap", "_raw")
    means = df.groupBy("hour").agg(F.avg(value).alias("_mean"))
    last = F.last(value, True).over(behind)
    return marked.join(means, "hour").withColumn(
        value,
        F.coalesce(F.col(value), F.when(is_short, last).otherwise(F.col("_mean"))),
    ).drop("_island", "_gap", "_mean")
