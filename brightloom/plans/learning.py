"""Training, calibration and scoring on Spark ML (results depend on the learner, so these
have no SQL form)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions import churn as fx
from brightloom.functions.common import CHURN_BANDS, FLOOD_BANDS, band, rounded
from brightloom.operators import learning, metrics, series
from brightloom.operators.quality import union_all
from brightloom.plans.churn import cleaned, engineered
from brightloom.plans.flood import HORIZONS, MATRIX, feature_matrix
from brightloom.plans.registry import Tables, query
from brightloom.session import cut

NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges", "tenure_group_12", "service_count", "streaming_count",
           "security_count", "avg_monthly_revenue", "high_value_customer", "tenure_monthly_interaction"]
CATEGORICAL = ["Contract", "PaymentMethod", "InternetService", "tenure_group"]
THRESHOLD = 0.45


def parts(t: Tables) -> dict[str, DataFrame]:
    """Engineered profiles in three parts; the flag is learnt on the training part."""
    df = cut(metrics.stratified_split(engineered(cleaned(t)), "Churn", "customerID"))
    flag = learning.HighValueFlag(inputCol="MonthlyCharges", outputCol="high_value_customer").fit(df.filter("part = 'train'"))
    flagged = flag.transform(df)
    return {p: flagged.filter(F.col("part") == p) for p in ("train", "validation", "test")}


def encoded(t: Tables):
    p = parts(t)
    enc = learning.encoder(NUMERIC, CATEGORICAL).fit(p["train"])
    return p, learning.reloaded(enc, t.spark)


@query("ml_encode")
def _(t):
    p, enc = encoded(t)
    names = learning.feature_names(enc, NUMERIC, CATEGORICAL)
    x = enc.transform(p["train"]).select(vector_to_array("features").alias("x"))
    return rounded(
        x.select(F.posexplode("x").alias("slot", "value")).groupBy("slot").agg(
            F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
        .withColumn("feature", F.element_at(F.array(*[F.lit(n) for n in names]), F.col("slot") + 1)))


@query("ml_cv_compare")
def _(t):
    p, enc = encoded(t)
    train = metrics.folds(enc.transform(p["train"]), "Churn", "customerID")
    ready = learning.training_rows(learning.with_class_weight(train, "Churn"), "features", "Churn", "weight", "fold")
    return learning.compare_models(ready, "Churn", "fold")


@query("ml_param_search")
def _(t):
    p, enc = encoded(t)
    ready = learning.training_rows(learning.with_class_weight(enc.transform(p["train"]), "Churn"), "features", "Churn", "weight")
    return learning.search(ready, "Churn")


@query("ml_calibrate")
def _(t):
    p = parts(t)
    enc, model = learning.fit_classifier(p["train"], "Churn", NUMERIC, CATEGORICAL)
    val = cut(learning.score_batch(p["validation"], enc, model).select("customerID", "Churn", F.col("churn_probability").alias("raw")))
    out = [metrics.brier(val, "Churn", "raw").withColumn("method", F.lit("none"))]
    for method in ("sigmoid", "isotonic"):
        fitted = learning.calibrate(val, "Churn", "raw", method)
        out.append(metrics.brier(learning.apply_calibration(fitted, val, "raw"), "Churn", "calibrated").withColumn("method", F.lit(method)))
    return rounded(union_all(out))


@query("churn_batch_score")
def _(t):
    p = parts(t)
    enc, model = learning.fit_classifier(p["train"], "Churn", NUMERIC, CATEGORICAL)
    s = learning.score_batch(p["test"], enc, model)
    prob = F.col("churn_probability")
    return s.select(
        "customerID", prob, (prob >= THRESHOLD).cast("int").alias("prediction"), band(prob, CHURN_BANDS).alias("risk_category"),
        fx.confidence(prob, THRESHOLD).alias("confidence"),
        fx.recommendation(prob, F.col("Contract"), F.col("PaymentMethod"), F.col("OnlineSecurity"), F.col("TechSupport"),
                          F.col("MonthlyCharges")).alias("recommended_action"))


@query("ml_tree_importance")
def _(t):
    p = parts(t)
    enc, model = learning.fit_classifier(p["train"], "Churn", NUMERIC, CATEGORICAL, "random_forest")
    return learning.tree_importance(model, learning.feature_names(enc, NUMERIC, CATEGORICAL), t.spark, 5, ["tenure", "security", "two year"])


FLOOD_FEATURES = ["rain_sum_6h", "rain_sum_24h", "rain_sum_72h", "wl_max", "wl_mean", "wl_max_lag_3h", "wl_max_lag_24h",
                  "wl_max_roll_24h", "wl_max_trend_6h", "hours_above_warning", "hour_sin", "hour_cos", "elevation_m", "impervious_ratio"]


@query("flood_forecast")
def _(t):
    """Per horizon a model of the hours whose outcome is known, applied to the newest hour."""
    from pyspark.ml.feature import VectorAssembler

    m = cut(feature_matrix(t).select("area", "hour", *FLOOD_FEATURES, *[f"flood_{h}h" for h in HORIZONS]))
    ready = VectorAssembler(inputCols=FLOOD_FEATURES, outputCol="features").transform(m)
    newest = series.latest_row(ready.select("area", "hour", "features"), "area", "hour")
    out = []
    for h in HORIZONS:
        label = f"flood_{h}h"
        known = learning.with_class_weight(series.known_by(ready, "hour", h), label)
        model = learning.reloaded(learning.candidates(label)["random_forest"].fit(known), t.spark)
        prob = F.round(learning.probability(), 4)
        out.append(model.transform(newest).select("area", F.lit(h).alias("horizon"), prob.alias("probability"), band(prob, FLOOD_BANDS).alias("risk_level")))
    return union_all(out)


@query("flood_forecast_frames", f"WITH {MATRIX}, top AS (SELECT max(hour) AS m FROM matrix) " + " UNION ALL ".join(
    f"SELECT {h} AS horizon, CAST(min(hour) AS VARCHAR) AS first_hour, CAST(max(hour) AS VARCHAR) AS last_hour, count(*) AS n, CAST(sum(flood_{h}h) AS BIGINT) AS positives, CAST(max(m) AS VARCHAR) AS scored_hour FROM matrix, top WHERE hour <= m - INTERVAL {h} HOUR"
    for h in HORIZONS))
def _(t):
    m = cut(feature_matrix(t).select("hour", *[f"flood_{h}h" for h in HORIZONS]))
    frames = series.training_frames(m, "hour", {h: f"flood_{h}h" for h in HORIZONS})
    return frames.withColumns({c: F.col(c).cast("string") for c in ("first_hour", "last_hour", "scored_hour")})
