"""Score metrics, campaigns, drift and subscriber features."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from brightloom.functions import churn as fx
from brightloom.operators import campaign, drift, learning, metrics


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(9)
    y = rng.integers(0, 2, 200)
    p = np.round(np.clip(0.3 * y + rng.uniform(0, 0.7, 200), 0, 1), 2)
    return spark.createDataFrame([(int(a), float(b), float(20 + i % 70)) for i, (a, b) in enumerate(zip(y, p))], "y int, p double, m double").cache(), y, p


def test_areas(sample):
    df, y, p = sample
    pos, neg = p[y == 1], p[y == 0]
    pairs = (pos[:, None] > neg[None]).mean() + 0.5 * (pos[:, None] == neg[None]).mean()
    assert metrics.roc_auc(df, "y", "p").first()[0] == pytest.approx(pairs)
    points = [(1.0, 0.0)]
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        points.append((y[hit].mean(), y[hit].sum() / y.sum()))
    step = sum(a * (r - r0) for (a, r), (_, r0) in zip(points[1:], points))
    trap = sum((a + a0) / 2 * (r - r0) for (a, r), (a0, r0) in zip(points[1:], points))
    assert metrics.pr_auc(df, "y", "p", "step").first()[0] == pytest.approx(step)
    assert metrics.pr_auc(df, "y", "p", "trapezoid").first()[0] == pytest.approx(trap)


def test_fbeta_floor(sample):
    df, y, p = sample
    def fb(t):
        hit = p >= t
        pr, rc = y[hit].mean(), y[hit].sum() / y.sum()
        return 2 * pr * rc / (pr + rc + 1e-9), rc
    ok = [(fb(t)[0], -t) for t in sorted(set(p)) if fb(t)[1] >= 0.7]
    r = metrics.fbeta_threshold(df, "y", "p").first()
    assert (r["fbeta"], r["threshold"], r["floor_met"]) == (pytest.approx(max(ok)[0]), -max(ok)[1], True)
    never = metrics.fbeta_threshold(df, "y", "p", min_recall=1.1).first()
    assert not never["floor_met"]


def test_confusion_zero_division(frame):
    df = frame([(0, 0.1), (0, 0.2)], "y int, p double")
    r = metrics.confusion_rates(metrics.confusion(df, "y", "p", 0.5)).first()
    assert (r["precision"], r["recall"], r["mcc"], r["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_split_is_stable(sample):
    df = sample[0].withColumn("id", F.monotonically_increasing_id())
    ids = df.select("id", "y").collect()
    again = df.sparkSession.createDataFrame(ids[::-1], "id long, y int").repartition(7)
    a = metrics.stratified_split(df.sparkSession.createDataFrame(ids, "id long, y int"), "y", "id")
    b = metrics.stratified_split(again, "y", "id")
    assert rows(a.select("id", "part"), "id") == rows(b.select("id", "part"), "id")
    n = dict(rows(a.groupBy("part").count()))
    assert n["train"] == 140 and n["validation"] == 30 and n["test"] == 30


def test_campaign(frame, sample):
    df = frame([(1, 0.9, 50.0), (0, 0.8, 40.0), (1, 0.2, 30.0), (0, 0.1, 20.0)], "y int, p double, m double")
    r = campaign.simulate(df, "y", "p", "m", 0.5).first()
    assert (r["tp"], r["fp"], r["fn"], r["tn"]) == (1, 1, 1, 1)
    assert r["total_cost"] == 20 * 2 + 0.6 * 100 + 100 and r["revenue_saved"] == pytest.approx(180.0)
    assert r["net_savings"] == pytest.approx(-20.0) and r["opportunity_loss"] == 180.0 and r["baseline_loss"] == 480.0
    big = sample[0]
    swept = {x["threshold"]: x for x in campaign.sweep(big, "y", "p", "m").collect()}
    assert len(swept) == 99
    for t in (0.01, 0.29, 0.57, 0.58, 0.99):
        one = campaign.simulate(big, "y", "p", "m", t).first()
        assert (swept[t]["tp"], swept[t]["fp"], swept[t]["fn"], swept[t]["tn"]) == (one["tp"], one["fp"], one["fn"], one["tn"])
        assert swept[t]["net_savings"] == pytest.approx(one["net_savings"])
    best = campaign.best_threshold(campaign.sweep(big, "y", "p", "m")).first()
    assert best["net_savings"] == pytest.approx(max(x["net_savings"] for x in swept.values()))
    other = campaign.Terms(10.0, 50.0, 0.5, 12)
    what = campaign.what_if(campaign.sweep(big, "y", "p", "m", thresholds=[0.25, 0.5]), [other]).filter("threshold = 0.5").first()
    assert what["net_savings"] == pytest.approx(campaign.simulate(big, "y", "p", "m", 0.5, other).first()["net_savings"])


def test_drift(frame):
    base = frame([(1 + i * 71 // 19, 30.0 + i * 3, "monthly" if i % 2 else "yearly") for i in range(20)], "tenure int, charge double, contract string")
    edges = drift.bin_edges(base, ["tenure", "charge"])
    ref = drift.shares(base, edges, ["contract"]).cache()
    assert all(abs(r[0] - 1) < 1e-12 for r in ref.groupBy("feature").agg(F.sum("share")).select("sum(share)").collect())
    moved = frame([(5 + i, 120.0, "weekly") for i in range(20)], "tenure int, charge double, contract string").drop("tenure")
    cur = drift.shares(moved, edges, ["contract"])
    got = {r["feature"]: r["status"] for r in drift.psi(ref, cur, {"tenure": "numeric"}).collect()}
    assert got == {"tenure": "missing", "charge": "drift", "contract": "drift"}
    assert rows(drift.unseen(ref, cur)) == [("contract", "weekly")]
    same = drift.summary(drift.psi(ref, drift.shares(base, edges, ["contract"]))).first()
    assert same["max_psi"] == 0.0 and not same["drift_detected"]


def test_two_valued_feature_gets_equal_width_bins(frame):
    df = frame([(0.0,), (10.0,), (10.0,)], "v double")
    assert drift.bin_edges(df, ["v"], 5)["v"][0] == 0.0
    assert drift.bin_edges(frame([(1.0,), (1.0,)], "v double"), ["v"]) == {}


def test_charges(frame):
    df = frame([(" ", 0, 45.0, "No"), ("500.0", 10, 50.0, "Yes"), ("", 0, 30.0, "No"), ("400.0", 5, 80.0, "No"), (None, 10, 50.0, "?")],
               "total string, tenure int, monthly double, churn string")
    got = rows(df.select(fx.clean_total(F.col("total"), F.col("tenure"), F.col("monthly")), fx.label_code(F.col("churn"))))
    assert got == [(0.0, 0), (500.0, 1), (0.0, 0), (400.0, 0), (500.0, None)]


def test_subscriber_features(frame):
    df = frame([(12, 85.0, 1020.0, "Yes", "Yes", "No", "Fiber optic"), (0, 45.0, 0.0, "Yes", "No", "Yes", "DSL"), (101, 1.0, 1.0, "No", "No", "No", "No")],
               "tenure int, monthly double, total double, PhoneService string, OnlineSecurity string, StreamingTV string, InternetService string")
    got = rows(df.select(fx.tenure_bucket(F.col("tenure")), fx.service_count(df.columns), fx.yes_count(fx.SECURITY, df.columns),
                         fx.average_revenue(F.col("total"), F.col("tenure"), F.col("monthly"))))
    assert got == [("0-1yr", 3, 1, 85.0), ("0-1yr", 3, 0, 45.0), ("nan", 0, 0, 1.0 / 101)]
    flag = learning.HighValueFlag(inputCol="monthly", outputCol="hv").fit(df)
    assert flag.getOrDefault("threshold") == pytest.approx(np.quantile([85, 45, 1], 0.8))
    assert [r["hv"] for r in flag.transform(df).collect()] == [1, 0, 0]


def test_texts(frame):
    df = frame([(0.1, "One year", "Mailed check", "Yes", "Yes", 50.0), (0.3, "Month-to-month", "Electronic check", "No", "No", 50.0),
                (0.6, "One year", "Mailed check", "Yes", "Yes", 50.0), (0.9, "Two year", "Mailed check", "Yes", "Yes", 95.0)],
               "p double, c string, pay string, sec string, sup string, m double")
    got = [r[0] for r in df.select(fx.recommendation(*map(F.col, ["p", "c", "pay", "sec", "sup", "m"]))).collect()]
    assert got[0] == fx.NO_ACTION
    assert got[1] == fx.MEDIUM_PREFIX + " or ".join([fx.MEDIUM_CONTRACT, fx.MEDIUM_PAYMENT, fx.MEDIUM_SECURITY])
    assert got[2] == fx.HIGH_PREFIX + fx.HIGH_DEFAULT
    assert got[3] == fx.CRITICAL_PREFIX + fx.CRITICAL_LOYAL + " or " + fx.CRITICAL_CHARGE
    assert [r[0] for r in df.select(fx.confidence(F.col("p"), 0.45)).collect()] == [0.8889, 0.6667, 0.6364, 0.9091]
    d = frame([("tenure", 3.0, True), ("tenure_monthly_interaction", 3.0, False), ("gender_Male", 1.0, True)], "f string, v double, r boolean")
    said = [r[0] for r in d.select(fx.driver_text(F.col("f"), F.col("v"), F.col("r"))).collect()]
    assert said[0].startswith("A low tenure (3 months)") and said[1].startswith("Reasonable monthly pricing")
    assert said[2] == "Feature 'gender_Male' (value: 1.0) increases churn risk."


def test_model_beats_chance(sample):
    df = sample[0].withColumn("id", F.monotonically_increasing_id()).withColumn("kind", F.when(F.col("m") > 50, "a").otherwise("b"))
    enc, model = learning.fit_classifier(df, "y", ["p", "m"], ["kind"])
    out = learning.score_batch(df, enc, model).cache()
    assert metrics.roc_auc(out, "y", "churn_probability").first()[0] > 0.7
    assert learning.feature_names(enc, ["p", "m"], ["kind"])[:4] == ["p", "m", "kind_a", "kind_b"]
    odd = learning.score_batch(df.limit(3).withColumn("kind", F.lit("new")), enc, model)
    assert odd.filter("churn_probability BETWEEN 0 AND 1").count() == 3
    for method in ("sigmoid", "isotonic"):
        fitted = learning.calibrate(out, "y", "churn_probability", method)
        cal = learning.apply_calibration(fitted, out, "churn_probability")
        assert metrics.brier(cal, "y", "calibrated").first()["brier"] <= metrics.brier(out, "y", "churn_probability").first()["brier"] + 0.01


def test_profile_is_saved_once_and_read_back(frame, spark, tmp_path):
    ref = frame([(float(i % 50), "a" if i % 3 else "b", None) for i in range(300)], "x double, c string, n double")
    path = f"{tmp_path}/profile"
    drift.save_profile(ref, ["x", "n"], ["c"], path)
    profile = drift.Profile(spark, path)
    assert profile.categorical == ["c"] and set(profile.edges) == {"x"}
    assert {(r.feature, r.type) for r in profile.shares.select("feature", "type").distinct().collect()} == {("x", "double"), ("c", "string")}
    same = {r.feature: r.status for r in profile.compare(ref).collect()}
    assert same == {"x": "stable", "c": "stable"}
    moved = {r.feature: r.status for r in profile.compare(ref.withColumn("x", F.col("x") + 100)).collect()}
    assert moved["x"] == "drift" and moved["c"] == "stable"
    holed = {r.feature: r.status for r in profile.compare(ref.withColumn("x", F.lit(None).cast("double")).drop("c")).collect()}
    assert holed == {"x": "drift", "c": "missing"}
    with pytest.raises(Exception, match="(?i)already exists"):
        drift.save_profile(ref, ["x"], ["c"], path)


def test_event_importance(frame):
    from datetime import datetime as d

    rows_ = [(d(2024, 1, 1, h), int(h in (2, 3, 7)), float(h), 10.0 if h == 7 else 0.0) for h in range(10)]
    df = frame(rows_, "hour timestamp_ntz, flag int, a double, b double")
    got = [tuple(r) for r in metrics.event_importance(df, "flag", "hour", {"a": -1.0, "b": 2.0}, 1).orderBy("event_start").collect()]
    assert got == [(d(2024, 1, 1, 2), d(2024, 1, 1, 3), 2, "a", 2.0, "up", 1), (d(2024, 1, 1, 7), d(2024, 1, 1, 7), 1, "b", 18.0, "up", 1)]


def test_rows_with_unknown_outcome_are_not_trained_on(frame):
    from datetime import datetime as d

    from brightloom.operators import series

    df = frame([(d(2024, 1, 1, h), h % 2) for h in range(24)], "hour timestamp_ntz, y int")
    assert series.known_by(df, "hour", 6).agg(F.max("hour")).first()[0] == d(2024, 1, 1, 17)
    got = [tuple(r) for r in series.training_frames(df, "hour", {6: "y", 12: "y"}).orderBy("horizon").collect()]
    assert got == [(6, d(2024, 1, 1), d(2024, 1, 1, 17), 18, 9, d(2024, 1, 1, 23)), (12, d(2024, 1, 1), d(2024, 1, 1, 11), 12, 6, d(2024, 1, 1, 23))]


def test_training_rows_are_spread_by_number(spark, monkeypatch):
    """One partition of many rows becomes several of about ``PART_ROWS``; no row is lost."""
    df = spark.range(1000).coalesce(1).withColumn("y", (F.col("id") % 2).cast("int"))
    assert learning.training_rows(df, "id").rdd.getNumPartitions() == 1
    monkeypatch.setattr(learning, "PART_ROWS", 100)
    ready = learning.training_rows(df, "id", "y")
    sizes = [r["n"] for r in ready.groupBy(F.spark_partition_id()).agg(F.count("id").alias("n")).collect()]
    assert len(sizes) == 10 and max(sizes) <= 120 and sum(sizes) == 1000
    assert ready.select("id").distinct().count() == 1000


def test_folds_are_scored_by_saved_models(sample, monkeypatch):
    df = sample[0].withColumn("id", F.monotonically_increasing_id()).withColumn("kind", F.lit("a"))
    enc = learning.encoder(["p", "m"], ["kind"]).fit(df)
    ready = learning.training_rows(learning.with_class_weight(enc.transform(df), "y").withColumn("fold", (F.col("id") % 2).cast("int")), "features", "y", "weight", "fold")
    keep, saved = learning.reloaded, []
    monkeypatch.setattr(learning, "reloaded", lambda model, spark: saved.append(type(model).__name__) or keep(model, spark))
    got = learning.compare_models(ready, "y", "fold", 2).collect()
    assert len(saved) == 6 and [r["model"] for r in got] == list(learning.candidates("y")) and all(0.5 < r["auc_mean"] <= 1 for r in got)
