"""Calendar features of an hour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The constant for pi, wet-season, peak-month and storm-hour limits.
PI = 3.14159
WET_FROM_MONTH, WET_TO_MONTH = 10, 4
PEAK_MONTHS = [1, 2]
STORM_HOURS = (17, 21)


def calendar_features(ts: Column) -> dict[str, Column]:
    hour, month = F.hour(ts), F.month(ts)
    return {
        "hour_of_day": hour,
        "day_of_week": F.weekday(ts),
        "month": month,
        "is_wet_season": ((month >= WET_FROM_MONTH) | (month <= WET_TO_MONTH)).cast("int"),
        "is_peak_month": month.isin(PEAK_MONTHS).cast("int"),
        "is_storm_hour": hour.between(*STORM_HOURS).cast("int"),
        "hour_sin": F.sin(2 * PI * hour / 24),
        "hour_cos": F.cos(2 * PI * hour / 24),
        "month_sin": F.sin(2 * PI * month / 12),
        "month_cos": F.cos(2 * PI * month / 12),
    }
