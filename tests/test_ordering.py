"""The order helpers give the same result in one slice and in many."""

import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brightloom.operators import ordering as o


@pytest.fixture(scope="module")
def hot(spark):
    """One key holds most rows, with many equal values."""
    rng = random.Random(3)
    rows = [("hot", rng.randint(0, 30), i) for i in range(700)] + [(f"k{i % 9}", rng.randint(0, 5), i) for i in range(200)]
    return spark.createDataFrame(rows, "k string, v int, i int").cache()


@pytest.fixture(params=["one slice", "many slices"])
def slices(spark, request):
    """Small tables are folded into one slice unless adaptive execution may not fold."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    if request.param == "many slices":
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "9")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


def test_row_numbers(hot, slices):
    got = o.row_numbers(hot, ["k"], [F.col("v"), F.col("i")], "n").toPandas()
    want = hot.toPandas().sort_values(["k", "v", "i"])
    want["n"] = want.groupby("k").cumcount() + 1
    assert sorted(map(tuple, got[["k", "v", "i", "n"]].values)) == sorted(map(tuple, want[["k", "v", "i", "n"]].values))


def test_row_numbers_of_equal_rows(spark, slices):
    same = spark.createDataFrame([("a", 1)] * 300, "k string, v int")
    got = o.row_numbers(same, ["k"], [F.col("v")], "n").toPandas()
    assert sorted(got["n"]) == list(range(1, 301))


def test_running_totals_with_null_key(spark, slices):
    rows = [(k, i, i % 7) for k in ("a", None) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, i int, x int")
    got = o.running_totals(df, [F.col("i")], {"s": "x"}, ["k"]).toPandas()
    for k in ("a", None):
        part = got[got["k"].isna()] if k is None else got[got["k"] == k]
        part = part.sort_values("i")
        assert part["s"].tolist() == np.cumsum([i % 7 for i in range(40)]).tolist()


def test_value_ranks(hot, slices):
    got = o.value_ranks(hot, "v", ["k"], descending=True).toPandas()
    pdf = hot.toPandas()
    for k, part in pdf.groupby("k"):
        lo = part["v"].rank(ascending=False, method="min")
        avg = part["v"].rank(ascending=False, method="average")
        want = {v: (a, b) for v, a, b in zip(part["v"], lo, avg)}
        mine = got[got["k"] == k]
        assert {r.v: (r.rank_min, r.rank_avg) for r in mine.itertuples()} == want
        assert (mine["n"] == len(part)).all()


def test_quantiles(hot, slices):
    probs = {"lo": 0.0, "q1": 0.25, "p80": 0.8, "hi": 1.0}
    got = o.quantiles(hot, "v", probs, ["k"]).toPandas().set_index("k")
    for k, part in hot.toPandas().groupby("k"):
        for name, p in probs.items():
            assert got.loc[k, name] == pytest.approx(part["v"].quantile(p))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=40), st.floats(0, 1))
def test_quantile_property(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = o.quantiles(df, "v", {"q": p}).first()["q"]
    assert got == pytest.approx(pd.Series(values).quantile(p), rel=1e-9, abs=1e-6)
