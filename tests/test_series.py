from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightloom.functions.advisory import advisory_text
from brightloom.functions.calendar import calendar_features
from brightloom.functions.common import CHURN_BANDS, FLOOD_BANDS, band, right_closed
from brightloom.operators import explore, series

T0 = datetime(2024, 1, 1)


def hourly(frame, values, name="x"):
    return frame([(T0 + timedelta(hours=i), v) for i, v in enumerate(values)], f"hour timestamp_ntz, {name} double")


def values(df, col):
    return [r[col] for r in df.orderBy("hour").collect()]


def test_run_length(frame):
    df = hourly(frame, [710.0, 720.0, 650.0, 705.0, 710.0, 690.0, 700.0])
    assert values(series.run_length_above(df, "x", 700, "n"), "n") == [0, 1, 0, 1, 2, 0, 1]


def test_interpolation(frame):
    df = hourly(frame, [None, 1.0, None, 3.0, None]).withColumn("s", F.lit("a"))
    assert values(series.interpolate(df, ["s"], "x"), "x") == [None, 1.0, 2.0, 3.0, 3.0]


@pytest.mark.parametrize("mode, want", [("next", [0, 0, 1, 1, 1, 0, 0]), ("offset", [1, 1, 1, 0, 0, 0, 0])])
def test_forward_label(frame, mode, want):
    df = hourly(frame, [0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0]).withColumn("x", F.col("x").cast("int"))
    assert values(series.forward_label(df, "x", 3, "y", mode=mode), "y") == want


def test_resample(frame):
    df = frame([("a", T0, 1.0), ("a", T0 + timedelta(minutes=5), 2.0), ("a", T0 + timedelta(hours=2), 4.0), ("b", T0 + timedelta(hours=1), 8.0)],
               "s string, ts timestamp_ntz, v double")
    total = series.resample_sum(df, "ts", "s", "v")
    assert [r["v"] for r in total.filter("s = 'a'").orderBy("hour").collect()] == [3.0, 0.0, 4.0]
    assert total.filter("s = 'b'").count() == 3
    assert [r["v"] for r in series.resample_mean(df, "ts", "s", "v").filter("s = 'a'").orderBy("hour").collect()] == [1.5, None, 4.0]


def test_rolling_against_pandas(frame):
    rng = np.random.default_rng(1)
    v = rng.uniform(0, 60, 100)
    df = hourly(frame, [float(x) for x in v], "rain_total_mm").withColumn("rain_mean_mm", F.col("rain_total_mm") / 3)
    got = series.rain_flags(series.rain_features(df, [1, 6, 72])).orderBy("hour").toPandas()
    s = pd.Series(v)
    np.testing.assert_allclose(got["rain_sum_6h"], s.rolling(6, min_periods=1).sum())
    np.testing.assert_allclose(got["rain_mean_72h"], (s / 3).rolling(72, min_periods=1).mean())
    np.testing.assert_allclose(got["antecedent_rain_72h"].astype(float), s.rolling(72).sum())
    assert got["rain_extreme_flag"].tolist() == (s > 50).astype(int).tolist()
    lev = hourly(frame, [float(x) for x in v], "wl")
    t = series.rolling_max_and_trend(series.lags(lev, "wl", [2]), "wl", [3]).orderBy("hour").toPandas()
    np.testing.assert_allclose(t["wl_roll_3h"].astype(float), s.rolling(3).max())
    np.testing.assert_allclose(t["wl_trend_3h"].astype(float), s - s.shift(3))
    np.testing.assert_allclose(t["wl_lag_2h"].astype(float), s.shift(2))


def test_gap_limited_fill(frame):
    a = hourly(frame, [1.0, None, 3.0, None, None, None, 9.0]).withColumn("s", F.lit("a"))
    b = hourly(frame, [5.0] * 7).withColumn("s", F.lit("b"))
    out = series.gap_limited_fill(a.unionByName(b), "s", "x", 2).filter("s = 'a'")
    assert values(out, "x") == [1.0, 1.0, 3.0, 5.0, 5.0, 5.0, 9.0]
    lin = series.gap_limited_fill(a, "s", "x", 2, "linear")
    assert values(lin, "x") == [1.0, 2.0, 3.0, None, None, None, 9.0]


def test_matrix_rows(frame):
    shared = hourly(frame, [1.0, 2.0, 3.0])
    areas = frame([("p", 1.5), ("q", 2.5)], "area string, elevation double")
    out = series.for_entities(shared, areas, "area")
    assert out.count() == 6 and out.filter("area = 'q'").agg(F.sum("x")).first()[0] == 6.0
    train, val = series.time_split(out, "hour", "2023-12-31", "2024-01-01", "2024-01-01")
    assert (train.count(), val.count()) == (0, 6)


def test_bands_and_calendar(frame):
    df = frame([(0.19,), (0.2,), (0.5,), (0.8,), (None,)], "p double")
    assert [r[0] for r in df.select(band(F.col("p"), CHURN_BANDS)).collect()] == ["Low", "Medium", "High", "Critical", None]
    assert [r[0] for r in df.select(right_closed(F.col("p"), [0, 0.2, 0.5], ["a", "b"])).collect()] == ["a", "a", "b", None, None]
    ts = frame([(datetime(2024, 12, 30, 17),)], "ts timestamp_ntz")
    r = ts.select(*[c.alias(n) for n, c in calendar_features(F.col("ts")).items()]).first()
    assert (r["day_of_week"], r["is_wet_season"], r["is_peak_month"], r["is_storm_hour"]) == (0, 1, 0, 1)


def test_advisory(frame):
    df = frame([("warga", "X", 0.15, 6), ("bpbd", "Y", 0.86, 6), ("warga", "Z", 0.3, 12)], "a string, k string, p double, h int")
    got = [r[0] for r in df.select(advisory_text(F.col("a"), F.col("k"), F.col("p"), F.col("h"), band(F.col("p"), FLOOD_BANDS))).collect()]
    assert got[0] == "Wilayah X dalam status AMAN (15% risiko) untuk 6 jam ke depan. Tetap pantau update."
    assert got[1].startswith("PRIORITAS AWAS: Y, probabilitas banjir 86%") and got[1].endswith("Window aksi: 2 jam.")
    assert "status WASPADA banjir (30%)" in got[2]


def test_lag_scan_of_constants(frame):
    """A constant column has r NaN, which counts as highest as in SQL; no pairs have null."""
    rows = [(T0 + timedelta(hours=i), float(i % 4), 7.0, int(i % 5 == 0), 0) for i in range(40)]
    df = frame(rows, "hour timestamp_ntz, rain double, level double, flag int, calm int")
    got = {r["feature"]: (r["r"], r["is_best"]) for r in explore.lag_window_scan(df, "rain", "level", "calm", [1, 2], [0, 3]).collect()}
    assert len(got) == 4 and all(np.isnan(r) and best for r, best in got.values())
    got = {r["feature"]: (r["r"], r["is_best"]) for r in explore.lag_window_scan(df, "rain", "level", "flag", [1, 2], [0, 50]).collect()}
    pdf = pd.DataFrame(rows, columns=["hour", "rain", "level", "flag", "calm"])
    want = [pdf["rain"].corr(pdf["flag"]), pdf["rain"].rolling(2, min_periods=1).sum().corr(pdf["flag"])]
    assert [got[f"sum_{n}h"][0] for n in (1, 2)] == pytest.approx(want)
    assert [got[f"sum_{n}h"][1] for n in (1, 2)] == [w == max(want) for w in want]
    assert np.isnan(got["lag_0h"][0]) and got["lag_0h"][1] and got["lag_50h"] == (None, None)
