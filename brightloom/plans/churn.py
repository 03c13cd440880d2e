"""Subscriber profiles from customers and their orders: features, campaigns, drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions import churn as fx
from brightloom.functions.common import CHURN_BANDS, FLOOD_BANDS_REPORT, band, rounded
from brightloom.operators import campaign, drift, metrics
from brightloom.operators.ordering import quantiles
from brightloom.plans.registry import Tables, query
from brightloom.sources.files import scratch

PROFILE = """
agg AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spend, count(*) AS n, max(o_totalprice) AS top,
   count(DISTINCT year(o_orderdate) * 12 + month(o_orderdate)) AS active, max(year(o_orderdate) * 12 + month(o_orderdate)) AS lm,
   min(year(o_orderdate) * 12 + month(o_orderdate)) AS fm, max(o_orderdate) AS last_order,
   """ + ", ".join(f"max(CAST(o_orderpriority LIKE '{d}%' AS INTEGER)) AS p{d}" for d in range(1, 6)) + """,
   """ + ", ".join(f"max(CAST(o_orderstatus = '{s}' AS INTEGER)) AS s{s.lower()}" for s in "FOP") + """ FROM orders GROUP BY 1),
prof AS (SELECT c_custkey AS customerID, CAST(coalesce(lm - fm, 0) AS INTEGER) AS tenure,
   coalesce(round(CAST(spend AS DOUBLE) / active / 3000, 2), 20.0) AS MonthlyCharges,
   CASE WHEN c_acctbal < 0 THEN ' ' ELSE CAST(spend AS VARCHAR) END AS TotalCharges,
   CASE c_mktsegment WHEN 'FURNITURE' THEN 'One year' WHEN 'HOUSEHOLD' THEN 'Two year' ELSE 'Month-to-month' END AS Contract,
   CASE WHEN n >= 12 THEN 'Electronic check' WHEN n >= 10 THEN 'Mailed check' WHEN n >= 8 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS PaymentMethod,
   CASE WHEN top > 450000 THEN 'Fiber optic' WHEN top > 250000 THEN 'DSL' ELSE 'No' END AS InternetService,
   """ + ", ".join(f"CASE WHEN {c} = 1 THEN 'Yes' ELSE 'No' END AS {n}" for c, n in [
    ("sf", "PhoneService"), ("so", "MultipleLines"), ("p1", "OnlineSecurity"), ("p2", "OnlineBackup"), ("p3", "DeviceProtection"),
    ("p4", "TechSupport"), ("p5", "StreamingTV"), ("sp", "StreamingMovies")]) + """,
   CASE WHEN last_order IS NULL OR last_order < (SELECT max(o_orderdate) - INTERVAL 6 MONTH FROM orders) THEN 'Yes' ELSE 'No' END AS Churn
  FROM customer LEFT JOIN agg ON c_custkey = o_custkey),
cleaned AS (SELECT * EXCLUDE (TotalCharges, Churn), coalesce(try_cast(nullif(trim(TotalCharges), '') AS DOUBLE),
   CASE WHEN tenure = 0 THEN 0.0 ELSE tenure * MonthlyCharges END) AS TotalCharges, CASE Churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS Churn FROM prof),
scored AS (SELECT *, round(1 / (1 + exp(-(0.8 - 0.03 * tenure + 0.011 * MonthlyCharges))), 6) AS p FROM cleaned)
"""


def profiles(t: Tables) -> DataFrame:
    """One row per customer; orders are folded before they meet the customers."""
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    o = t.orders.groupBy("o_custkey").agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend"), F.count(F.lit(1)).alias("n"),
        F.max("o_totalprice").alias("top"), F.count_distinct(month).alias("active"),
        (F.max(month) - F.min(month)).alias("span"), F.max("o_orderdate").alias("last_order"),
        *[F.max(F.col("o_orderpriority").startswith(str(d))).alias(f"p{d}") for d in range(1, 6)],
        *[F.max(F.col("o_orderstatus") == s).alias(f"s{s}") for s in "FOP"])
    recent = t.orders.agg((F.max("o_orderdate") - F.expr("INTERVAL 6 MONTH"))).scalar()

    def yes(cond):
        return F.when(cond, "Yes").otherwise("No")

    return t.customer.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("customerID"), F.coalesce("span", F.lit(0)).alias("tenure"),
        F.coalesce(F.round(F.col("spend").cast("double") / F.col("active") / 3000, 2), F.lit(20.0)).alias("MonthlyCharges"),
        F.when(F.col("c_acctbal") < 0, " ").otherwise(F.col("spend").cast("string")).alias("TotalCharges"),
        F.when(F.col("c_mktsegment") == "FURNITURE", "One year").when(F.col("c_mktsegment") == "HOUSEHOLD", "Two year")
        .otherwise("Month-to-month").alias("Contract"),
        F.when(F.col("n") >= 12, "Electronic check").when(F.col("n") >= 10, "Mailed check")
        .when(F.col("n") >= 8, "Bank transfer (automatic)").otherwise("Credit card (automatic)").alias("PaymentMethod"),
        F.when(F.col("top") > 450000, "Fiber optic").when(F.col("top") > 250000, "DSL").otherwise("No").alias("InternetService"),
        yes(F.col("sF")).alias("PhoneService"), yes(F.col("sO")).alias("MultipleLines"), yes(F.col("p1")).alias("OnlineSecurity"),
        yes(F.col("p2")).alias("OnlineBackup"), yes(F.col("p3")).alias("DeviceProtection"), yes(F.col("p4")).alias("TechSupport"),
        yes(F.col("p5")).alias("StreamingTV"), yes(F.col("sP")).alias("StreamingMovies"),
        yes(F.col("last_order").isNull() | (F.col("last_order") < recent)).alias("Churn"),
    )


def cleaned(t: Tables) -> DataFrame:
    total = fx.clean_total(F.col("TotalCharges"), F.col("tenure"), F.col("MonthlyCharges"))
    return profiles(t).withColumns({"TotalCharges": total, "Churn": fx.label_code(F.col("Churn"))})


def engineered(df: DataFrame) -> DataFrame:
    present = df.columns
    return df.withColumns({
        "tenure_group_12": fx.tenure_years(F.col("tenure")), "tenure_group": fx.tenure_bucket(F.col("tenure")),
        "service_count": fx.service_count(present), "streaming_count": fx.yes_count(fx.STREAMING, present),
        "security_count": fx.yes_count(fx.SECURITY, present),
        "avg_monthly_revenue": fx.average_revenue(F.col("TotalCharges"), F.col("tenure"), F.col("MonthlyCharges")),
        "tenure_monthly_interaction": F.col("tenure") * F.col("MonthlyCharges"),
    })


def scored(t: Tables) -> DataFrame:
    z = 0.8 - 0.03 * F.col("tenure") + 0.011 * F.col("MonthlyCharges")
    return cleaned(t).withColumn("p", F.round(1 / (1 + F.exp(-z)), 6))


@query("churn_clean_charges", f"WITH {PROFILE} SELECT customerID, tenure, MonthlyCharges, round(TotalCharges, 4) AS TotalCharges, Churn FROM cleaned")
def _(t):
    return rounded(cleaned(t).select("customerID", "tenure", "MonthlyCharges", "TotalCharges", "Churn"), 4)


@query("churn_tenure_bucket", f"""WITH {PROFILE} SELECT customerID, CAST(floor(tenure / 12) AS BIGINT) AS tenure_group_12,
  CASE WHEN tenure > -1 AND tenure <= 12 THEN '0-1yr' WHEN tenure <= 24 THEN '1-2yr' WHEN tenure <= 48 THEN '2-4yr' WHEN tenure <= 60 THEN '4-5yr'
    WHEN tenure <= 100 THEN '5yr+' ELSE 'nan' END AS tenure_group FROM cleaned""")
def _(t):
    return engineered(cleaned(t)).select("customerID", "tenure_group_12", "tenure_group")


def _yes_sql(cols) -> str:
    return " + ".join(f"CAST({c} = 'Yes' AS INTEGER)" for c in cols)


SERVICE_SQL = f"""CAST({_yes_sql(fx.SERVICES)} + CAST(InternetService IN ('DSL', 'Fiber optic') AS INTEGER) AS INTEGER) AS service_count,
  CAST({_yes_sql(fx.STREAMING)} AS INTEGER) AS streaming_count, CAST({_yes_sql(fx.SECURITY)} AS INTEGER) AS security_count"""


@query("churn_service_counts", f"WITH {PROFILE} SELECT customerID, {SERVICE_SQL} FROM cleaned")
def _(t):
    return engineered(cleaned(t)).select("customerID", "service_count", "streaming_count", "security_count")


@query("churn_avg_revenue", f"""WITH {PROFILE} SELECT customerID, round(coalesce(CASE WHEN tenure = 0 THEN MonthlyCharges ELSE TotalCharges / tenure END, MonthlyCharges), 6) AS avg_monthly_revenue FROM cleaned""")
def _(t):
    return rounded(engineered(cleaned(t)).select("customerID", "avg_monthly_revenue"))


@query("churn_high_value", f"""WITH {PROFILE} SELECT customerID, CAST(MonthlyCharges > (SELECT quantile_cont(MonthlyCharges, 0.8) FROM cleaned) AS INTEGER) AS high_value_customer FROM cleaned""")
def _(t):
    from brightloom.operators.learning import HighValueFlag

    df = cleaned(t)
    return HighValueFlag(inputCol="MonthlyCharges", outputCol="high_value_customer").fit(df).transform(df).select(
        "customerID", "high_value_customer")


@query("churn_interaction", f"WITH {PROFILE} SELECT customerID, round(tenure * MonthlyCharges, 4) AS tenure_monthly_interaction FROM cleaned")
def _(t):
    return rounded(engineered(cleaned(t)).select("customerID", "tenure_monthly_interaction"), 4)


@query("risk_bands", """SELECT l_returnflag, CASE WHEN p < 0.2 THEN 'Low' WHEN p < 0.5 THEN 'Medium' WHEN p < 0.8 THEN 'High' ELSE 'Critical' END AS churn_band,
  CASE WHEN p < 0.2 THEN 'Aman' WHEN p < 0.5 THEN 'Waspada' WHEN p < 0.8 THEN 'Siaga' ELSE 'Bahaya' END AS flood_band, count(*) AS n
FROM (SELECT l_returnflag, l_discount * 10 AS p FROM lineitem) GROUP BY ALL""")
def _(t):
    p = t.lineitem.select("l_returnflag", (F.col("l_discount") * 10).alias("p"))
    return p.groupBy("l_returnflag", band(F.col("p"), CHURN_BANDS).alias("churn_band"),
                     band(F.col("p"), FLOOD_BANDS_REPORT).alias("flood_band")).agg(F.count(F.lit(1)).alias("n"))


RECOMMEND_SQL = f"""CASE WHEN p < 0.2 THEN '{fx.NO_ACTION}'
 WHEN p < 0.5 THEN '{fx.MEDIUM_PREFIX}' || coalesce(nullif(concat_ws(' or ', CASE WHEN Contract = 'Month-to-month' THEN '{fx.MEDIUM_CONTRACT}' END,
   CASE WHEN PaymentMethod LIKE '%Electronic check%' THEN '{fx.MEDIUM_PAYMENT}' END, CASE WHEN OnlineSecurity = 'No' THEN '{fx.MEDIUM_SECURITY}' END), ''), '{fx.MEDIUM_DEFAULT}')
 WHEN p < 0.8 THEN '{fx.HIGH_PREFIX}' || coalesce(nullif(concat_ws(' or ', CASE WHEN Contract = 'Month-to-month' THEN '{fx.HIGH_CONTRACT}' END,
   CASE WHEN OnlineSecurity = 'No' OR TechSupport = 'No' THEN '{fx.HIGH_SECURITY}' END, CASE WHEN MonthlyCharges > 80 THEN '{fx.HIGH_CHARGE}' END), ''), '{fx.HIGH_DEFAULT}')
 ELSE '{fx.CRITICAL_PREFIX}' || concat_ws(' or ', CASE WHEN Contract = 'Month-to-month' THEN '{fx.CRITICAL_CONTRACT}' ELSE '{fx.CRITICAL_LOYAL}' END,
   CASE WHEN MonthlyCharges > 90 THEN '{fx.CRITICAL_CHARGE}' END) END"""


@query("churn_recommend", f"WITH {PROFILE} SELECT customerID, {RECOMMEND_SQL} AS recommended_action FROM scored")
def _(t):
    cols = ["p", "Contract", "PaymentMethod", "OnlineSecurity", "TechSupport", "MonthlyCharges"]
    return scored(t).select("customerID", fx.recommendation(*map(F.col, cols)).alias("recommended_action"))


@query("churn_confidence", f"""WITH {PROFILE} SELECT customerID, round(0.5 + 0.5 * CASE WHEN p >= 0.45 THEN (p - 0.45) / (1 - 0.45) ELSE (0.45 - p) / 0.45 END, 4) AS confidence FROM scored""")
def _(t):
    return scored(t).select("customerID", fx.confidence(F.col("p"), 0.45).alias("confidence"))


def _driver_sql() -> str:
    out = "CASE "
    for parts, direction, text in fx.DRIVER_TEXTS:
        cond = " AND ".join(f"feature = '{p[1:]}'" if p.startswith("=") else f"contains(feature, '{p}')" for p in parts)
        cond += {"risk": " AND is_risk", "protects": " AND NOT is_risk", None: ""}[direction]
        text = text.replace("'", "''")
        out += f"WHEN {cond} THEN replace('{text}', '{{value}}', CAST(CAST(value AS INTEGER) AS VARCHAR)) "
    return out + "ELSE 'Feature ''' || feature || ''' (value: ' || CAST(value AS VARCHAR) || CASE WHEN is_risk THEN ') increases churn risk.' ELSE ') supports retention.' END END"


DRIVER_FEATURES = ["Contract", "InternetService", "PaymentMethod", "OnlineSecurity", "TechSupport", "StreamingTV"]
DRIVER_NUMBERS = ["tenure", "service_count", "security_count"]


@query("driver_text", f"""WITH {PROFILE}, eng AS (SELECT *, {SERVICE_SQL} FROM scored),
long AS ({" UNION ALL ".join([f"SELECT '{c}_' || {c} AS feature, 1.0::DOUBLE AS value, p >= 0.5 AS is_risk FROM eng" for c in DRIVER_FEATURES]
 + [f"SELECT '{c}', {c}::DOUBLE, p >= 0.5 FROM eng" for c in DRIVER_NUMBERS])})
SELECT feature, value, is_risk, {_driver_sql()} AS explanation, count(*) AS n FROM long GROUP BY ALL""")
def _(t):
    eng = engineered(scored(t))
    risk = (F.col("p") >= 0.5).alias("is_risk")
    rows = [F.struct(F.concat(F.lit(f"{c}_"), c).alias("feature"), F.lit(1.0).alias("value"), risk) for c in DRIVER_FEATURES]
    rows += [F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"), risk) for c in DRIVER_NUMBERS]
    counts = eng.select(F.inline(F.array(*rows))).groupBy("feature", "value", "is_risk").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("explanation", fx.driver_text(F.col("feature"), F.col("value"), F.col("is_risk")))


@query("churn_label_counts", f"""WITH {PROFILE} SELECT 'Contract' AS attribute, Contract AS value, Churn, count(*) AS n FROM cleaned GROUP BY ALL
UNION ALL SELECT 'PaymentMethod', PaymentMethod, Churn, count(*) FROM cleaned GROUP BY ALL""")
def _(t):
    rows = [F.struct(F.lit(c).alias("attribute"), F.col(c).alias("value"), F.col("Churn")) for c in ("Contract", "PaymentMethod")]
    return cleaned(t).select(F.inline(F.array(*rows))).groupBy("attribute", "value", "Churn").agg(F.count(F.lit(1)).alias("n"))


@query("churn_kpis", f"WITH {PROFILE} SELECT count(*) AS customers, round(avg(Churn) * 100, 6) AS churn_rate, round(avg(MonthlyCharges), 6) AS mean_charge FROM cleaned")
def _(t):
    return rounded(cleaned(t).agg(F.count(F.lit(1)).alias("customers"), (F.avg("Churn") * 100).alias("churn_rate"),
                                  F.avg("MonthlyCharges").alias("mean_charge")))


@query("churn_box_stats", f"WITH {PROFILE} " + " UNION ALL ".join(
    f"SELECT Churn, '{c}' AS measure, min({c})::DOUBLE AS low, round(quantile_cont({c}, 0.25), 6) AS q1, round(quantile_cont({c}, 0.5), 6) AS med, round(quantile_cont({c}, 0.75), 6) AS q3, max({c})::DOUBLE AS high FROM cleaned GROUP BY Churn"
    for c in ("tenure", "MonthlyCharges")))
def _(t):
    rows = [F.struct("Churn", F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in ("tenure", "MonthlyCharges")]
    long = cleaned(t).select(F.inline(F.array(*rows)))
    return rounded(quantiles(long, "v", {"low": 0.0, "q1": 0.25, "med": 0.5, "q3": 0.75, "high": 1.0}, ["Churn", "measure"]).drop("n"))


@query("churn_pred_tally", f"""WITH {PROFILE}, r AS (SELECT CASE WHEN p < 0.2 THEN 'Low' WHEN p < 0.5 THEN 'Medium' WHEN p < 0.8 THEN 'High' ELSE 'Critical' END AS risk_category, CAST(p >= 0.5 AS INTEGER) AS prediction FROM scored)
SELECT risk_category, prediction, count(*) AS n FROM r GROUP BY ALL""")
def _(t):
    return scored(t).groupBy(band(F.col("p"), CHURN_BANDS).alias("risk_category"), (F.col("p") >= 0.5).cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def _roi_sql(cond: str, c=20.0, d=100.0, r=0.6, m=6) -> str:
    """Outcome columns over rows of (y, mon, hit-condition)."""
    tp, fp, fn, tn = (f"count(*) FILTER (WHERE {x})" for x in (f"{cond} AND y = 1", f"{cond} AND y = 0", f"NOT {cond} AND y = 1", f"NOT {cond} AND y = 0"))
    vt, vf = (f"coalesce(sum(mon) FILTER (WHERE {x}), 0)" for x in (f"{cond} AND y = 1", f"NOT {cond} AND y = 1"))
    cost = f"(({tp} + {fp}) * {c} + {tp} * {r} * {d} + {fp} * {d})"
    return f"""{tp} AS tp, {fp} AS fp, {fn} AS fn, {tn} AS tn, ({vt} + {vf}) * {m} AS baseline_loss, ({tp} + {fp}) * {c} AS outreach_cost,
  {tp} * {r} * {d} + {fp} * {d} AS discount_cost, {cost} AS total_cost, {vt} * {m} * {r} AS revenue_saved, {vf} * {m} AS opportunity_loss,
  {vt} * {m} * {r} - {cost} AS net_savings, CASE WHEN {cost} > 0 THEN ({vt} * {m} * {r} - {cost}) / {cost} * 100 ELSE 0 END AS roi_pct, {tp} * {r} AS retained_estimate"""


MONEY = ["baseline_loss", "outreach_cost", "discount_cost", "total_cost", "revenue_saved", "opportunity_loss", "net_savings", "roi_pct", "retained_estimate"]
MONEY_SQL = ", ".join(f"round(CAST({c} AS DOUBLE), 4) AS {c}" for c in MONEY)
SWEEP = f"""{PROFILE}, th AS (SELECT CAST(unnest({campaign.THRESHOLDS}) AS DOUBLE) AS threshold),
sweep AS (SELECT threshold, {_roi_sql('p >= threshold')} FROM (SELECT threshold, p, Churn AS y, MonthlyCharges AS mon FROM scored, th) GROUP BY threshold)"""


@query("churn_roi", f"WITH {PROFILE}, r AS (SELECT {_roi_sql('p >= 0.5')} FROM (SELECT p, Churn AS y, MonthlyCharges AS mon FROM scored)) SELECT tp, fp, fn, tn, {MONEY_SQL}, 0.5::DOUBLE AS threshold FROM r")
def _(t):
    return rounded(campaign.simulate(scored(t), "Churn", "p", "MonthlyCharges", 0.5), 4)


@query("churn_roi_sweep", f"WITH {SWEEP} SELECT threshold, tp, fp, fn, tn, {MONEY_SQL} FROM sweep")
def _(t):
    return rounded(campaign.sweep(scored(t), "Churn", "p", "MonthlyCharges"), 4)


@query("churn_roi_best", f"WITH {SWEEP} SELECT threshold, tp, fp, fn, tn, {MONEY_SQL} FROM sweep ORDER BY round(sweep.net_savings, 6) DESC, threshold LIMIT 1")
def _(t):
    return rounded(campaign.best_threshold(campaign.sweep(scored(t), "Churn", "p", "MonthlyCharges")), 4)


GRID = [campaign.Terms(c, d, 0.6, m) for c in (10.0, 30.0) for d in (50.0, 150.0) for m in (3, 12)]


@query("churn_whatif", f"WITH {PROFILE}, th AS (SELECT CAST(unnest([0.25, 0.5, 0.75]) AS DOUBLE) AS threshold), rowz AS (SELECT threshold, p, Churn AS y, MonthlyCharges AS mon FROM scored, th), g AS (" + " UNION ALL ".join(
    f"SELECT threshold, {g.contact_cost}::DOUBLE AS contact_cost, {g.incentive}::DOUBLE AS incentive, {g.months} AS months, {_roi_sql('p >= threshold', g.contact_cost, g.incentive, g.acceptance, g.months)} FROM rowz GROUP BY threshold" for g in GRID)
    + ") SELECT threshold, contact_cost, incentive, months, round(CAST(net_savings AS DOUBLE), 4) AS net_savings, round(CAST(roi_pct AS DOUBLE), 4) AS roi_pct FROM g")
def _(t):
    swept = campaign.sweep(scored(t), "Churn", "p", "MonthlyCharges", thresholds=[0.25, 0.5, 0.75])
    return rounded(campaign.what_if(swept, GRID).select("threshold", "contact_cost", "incentive", "months", "net_savings", "roi_pct"), 4)


@query("churn_funnel", f"""WITH {PROFILE}, r AS (SELECT {_roi_sql('p >= 0.5')} FROM (SELECT p, Churn AS y, MonthlyCharges AS mon FROM scored)), s AS (SELECT tp + fp + fn + tn AS total, * FROM r)
SELECT 1 AS step, 'total' AS stage, total AS n, 100.0::DOUBLE AS pct_of_total FROM s UNION ALL SELECT 2, 'churners', tp + fn, round((tp + fn) / total * 100, 6) FROM s
UNION ALL SELECT 3, 'targeted', tp + fp, round((tp + fp) / total * 100, 6) FROM s UNION ALL SELECT 4, 'retained', CAST(floor(retained_estimate) AS BIGINT), round(floor(retained_estimate) / total * 100, 6) FROM s""")
def _(t):
    return rounded(campaign.funnel(campaign.simulate(scored(t), "Churn", "p", "MonthlyCharges", 0.5)))


# Scores of order lines against their return flag.
LINES = """sl AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, l_linestatus AS grp,
  round(1 / (1 + exp(-(l_extendedprice / 30000 - 1.5 + 4 * l_discount))), 6) AS p FROM lineitem)"""


def lines(t: Tables) -> DataFrame:
    z = F.col("l_extendedprice") / 30000 - 1.5 + 4 * F.col("l_discount")
    return t.lineitem.select((F.col("l_returnflag") == "R").cast("int").alias("y"), F.col("l_linestatus").alias("grp"),
                             F.round(1 / (1 + F.exp(-z)), 6).alias("p"))


@query("ml_class_weight", f"WITH {LINES} SELECT count(*) FILTER (WHERE y = 0) AS negatives, count(*) FILTER (WHERE y = 1) AS positives, round(count(*) FILTER (WHERE y = 0) / greatest(count(*) FILTER (WHERE y = 1), 1), 6) AS pos_weight FROM sl")
def _(t):
    return rounded(metrics.class_weight(lines(t), "y"))


@query("ml_brier", f"WITH {LINES} SELECT round(avg(power(p - y, 2)), 6) AS brier, count(*) AS n FROM sl")
def _(t):
    return rounded(metrics.brier(lines(t), "y", "p"))


@query("ml_reliability", f"WITH {LINES} SELECT CAST(list_sum(list_transform(range(1, 10), lambda k: CASE WHEN p > k * 0.1e0 THEN 1 ELSE 0 END)) AS INTEGER) AS bin, round(avg(p), 6) AS mean_predicted, round(avg(y), 6) AS fraction_positive, count(*) AS n FROM sl GROUP BY 1")
def _(t):
    return rounded(metrics.reliability(lines(t), "y", "p"))


RATES = """round((tp + tn) / n, 6) AS accuracy, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS balanced_accuracy, round(tp / (tp + fp), 6) AS "precision",
  round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1,
  round((2 * tp / (2 * tp + fp + fn) * (tp + fn) + 2 * tn / (2 * tn + fp + fn) * (tn + fp)) / n, 6) AS f1_weighted,
  round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc, round(tn / (tn + fp), 6) AS specificity,
  round(fp / (fp + tn), 6) AS false_alarm_rate, round(fn / (fn + tp), 6) AS miss_rate"""
CELLS = """CAST(count(*) FILTER (WHERE p >= 0.5 AND y = 1) AS DOUBLE) AS tp, CAST(count(*) FILTER (WHERE p >= 0.5 AND y = 0) AS DOUBLE) AS fp,
  CAST(count(*) FILTER (WHERE p < 0.5 AND y = 1) AS DOUBLE) AS fn, CAST(count(*) FILTER (WHERE p < 0.5 AND y = 0) AS DOUBLE) AS tn, CAST(count(*) AS DOUBLE) AS n"""
COUNTS = "CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn"


@query("ml_confusion_metrics", f"WITH {LINES}, c AS (SELECT grp, {CELLS} FROM sl GROUP BY grp) SELECT grp, {COUNTS}, {RATES} FROM c")
def _(t):
    return rounded(metrics.confusion_rates(metrics.confusion(lines(t), "y", "p", 0.5, ["grp"])))


AUC_SQL = "(sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2) / (count(*) FILTER (WHERE y = 1)::DOUBLE * count(*) FILTER (WHERE y = 0))"


@query("ml_roc_auc", f"""WITH {LINES}, r AS (SELECT grp, y, rank() OVER (PARTITION BY grp ORDER BY p) + (count(*) OVER (PARTITION BY grp, p) - 1) / 2.0 AS rk FROM sl)
SELECT grp, round({AUC_SQL}, 6) AS roc_auc FROM r GROUP BY grp""")
def _(t):
    return rounded(metrics.roc_auc(lines(t), "y", "p", ["grp"]))


CURVE = f"""{LINES}, f AS (SELECT p, sum(y) AS pos, count(*) - sum(y) AS neg FROM sl GROUP BY p),
cum AS (SELECT p, pos, sum(pos) OVER (ORDER BY p DESC) AS tp, sum(neg) OVER (ORDER BY p DESC) AS fp, sum(pos) OVER () AS total FROM f),
pr AS (SELECT p, tp / total AS rec, tp / (tp + fp) AS prec, lag(tp / total, 1, 0) OVER (ORDER BY p DESC) AS rec0, lag(tp / (tp + fp), 1, 1) OVER (ORDER BY p DESC) AS prec0 FROM cum)"""


@query("ml_pr_auc_trapezoid", f"WITH {CURVE} SELECT round(sum((rec - rec0) * (prec + prec0) / 2), 6) AS pr_auc FROM pr")
def _(t):
    return rounded(metrics.pr_auc(lines(t), "y", "p", "trapezoid"))


@query("ml_average_precision", f"WITH {CURVE} SELECT round(sum((rec - rec0) * prec), 6) AS pr_auc FROM pr")
def _(t):
    return rounded(metrics.pr_auc(lines(t), "y", "p", "step"))


@query("ml_fbeta_threshold", f"""WITH {CURVE}, b AS (SELECT p AS threshold, 5 * prec * rec / (4 * prec + rec + 1e-9) AS fbeta, rec >= 0.7 AS floor_met FROM pr)
SELECT threshold, round(fbeta, 6) AS fbeta, floor_met FROM b ORDER BY floor_met DESC, b.fbeta DESC, threshold LIMIT 1""")
def _(t):
    return rounded(metrics.fbeta_threshold(lines(t), "y", "p", beta=2.0))


@query("ml_metrics_by_horizon", """WITH s AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y6, CAST(l_linestatus = 'O' AS INTEGER) AS y12, 0 AS y24,
  round(l_discount * 10, 2) AS p6, round(l_quantity / 50, 2) AS p12 FROM lineitem),
sl AS (SELECT '6h' AS horizon, y6 AS y, p6 AS p FROM s UNION ALL SELECT '12h', y12, p12 FROM s),
r AS (SELECT *, rank() OVER (PARTITION BY horizon ORDER BY p) + (count(*) OVER (PARTITION BY horizon, p) - 1) / 2.0 AS rk FROM sl),
c AS (SELECT horizon, """ + CELLS + f""", round({AUC_SQL}, 6) AS roc_auc FROM r GROUP BY horizon),
f AS (SELECT horizon, p, sum(y) AS pos, count(*) - sum(y) AS neg FROM sl GROUP BY ALL),
cum AS (SELECT horizon, pos, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY horizon) AS total FROM f WINDOW w AS (PARTITION BY horizon ORDER BY p DESC)),
ap AS (SELECT horizon, round(sum(pos * tp / (tp + fp)) / any_value(total), 6) AS pr_auc FROM cum GROUP BY horizon)
SELECT horizon, {COUNTS}, {RATES}, roc_auc, pr_auc, 2 * tp / (2 * tp + fp + fn) >= 0.65 AS passed FROM c JOIN ap USING (horizon)""")
def _(t):
    df = t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y6"), (F.col("l_linestatus") == "O").cast("int").alias("y12"), F.lit(0).alias("y24"),
        F.round(F.col("l_discount") * 10, 2).alias("p6"), F.round(F.col("l_quantity") / 50, 2).alias("p12"))
    return rounded(metrics.horizon_report(df, {"6h": ("y6", "p6"), "12h": ("y12", "p12"), "24h": ("y24", "p6")}, 0.5))


@query("ml_stratified_split", f"""WITH {PROFILE}, h AS (SELECT customerID, Churn, row_number() OVER (PARTITION BY Churn ORDER BY md5(CAST(customerID AS VARCHAR) || ':42'), customerID) AS pos,
  count(*) OVER (PARTITION BY Churn) AS n FROM cleaned)
SELECT customerID, Churn, CASE WHEN pos <= round(n * 0.7) THEN 'train' WHEN pos <= round(n * 0.85) THEN 'validation' ELSE 'test' END AS part FROM h""")
def _(t):
    return metrics.stratified_split(cleaned(t).select("customerID", "Churn"), "Churn", "customerID")


COEFFICIENTS = {"tenure": -0.03, "MonthlyCharges": 0.011, "service_count": -0.2, "security_count": -0.4, "streaming_count": 0.05, "avg_monthly_revenue": 0.00001}
ENG_SQL = f"eng AS (SELECT *, {SERVICE_SQL}, coalesce(CASE WHEN tenure = 0 THEN MonthlyCharges ELSE TotalCharges / tenure END, MonthlyCharges) AS avg_monthly_revenue FROM scored)"


@query("ml_linear_attribution", f"WITH {PROFILE}, {ENG_SQL}, long AS (" + " UNION ALL ".join(
    f"SELECT customerID, '{c}' AS feature, {c}::DOUBLE AS value, {b!r} * ({c} - (SELECT avg({c}) FROM eng)) AS a FROM eng" for c, b in COEFFICIENTS.items())
    + """), d AS (SELECT *, CASE WHEN a > 0.001 THEN 'up' WHEN a < -0.001 THEN 'down' END AS direction FROM long)
SELECT customerID, feature, round(value, 6) AS value, round(a, 6) AS attribution, direction, CAST(row_number() OVER (PARTITION BY customerID, direction ORDER BY abs(a) DESC, feature) AS INTEGER) AS position
FROM d WHERE direction IS NOT NULL QUALIFY position <= 4""")
def _(t):
    return rounded(metrics.linear_attribution(engineered(scored(t)), "customerID", COEFFICIENTS))


@query("ml_importance_by_entity", f"WITH {PROFILE}, {ENG_SQL}, long AS (" + " UNION ALL ".join(
    f"SELECT Contract, '{c}' AS feature, abs({b!r} * ({c} - avg({c}) OVER (PARTITION BY Contract))) AS a FROM eng" for c, b in COEFFICIENTS.items())
    + """), m AS (SELECT Contract, feature, avg(a) AS mean_abs FROM long GROUP BY ALL)
SELECT Contract, feature, round(mean_abs, 6) AS mean_abs, CAST(row_number() OVER (PARTITION BY Contract ORDER BY m.mean_abs DESC, feature) AS INTEGER) AS position FROM m QUALIFY position <= 3""")
def _(t):
    return rounded(metrics.importance(engineered(scored(t)), COEFFICIENTS, 3, "Contract"))


@query("ml_importance_overall", f"WITH {PROFILE}, {ENG_SQL}, long AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs({b!r} * ({c} - avg({c}) OVER ())) AS a FROM eng" for c, b in COEFFICIENTS.items())
    + """), m AS (SELECT feature, avg(a) AS mean_abs FROM long GROUP BY ALL)
SELECT feature, round(mean_abs, 6) AS mean_abs, CAST(row_number() OVER (ORDER BY m.mean_abs DESC, feature) AS INTEGER) AS position FROM m QUALIFY position <= 5""")
def _(t):
    return rounded(metrics.importance(engineered(scored(t)), COEFFICIENTS, 5))


# Drift between order lines shipped before and after a day.
DRIFT_DAY = "1999-01-01"
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount"]
CATEGORICAL = ["l_returnflag", "shipped"]
DRIFT_ROWS = f"""dr AS (SELECT l_quantity, l_extendedprice * CASE WHEN l_shipdate >= TIMESTAMP '{DRIFT_DAY}' THEN 1.5 ELSE 1 END AS l_extendedprice, l_discount, l_returnflag,
  CASE WHEN l_shipdate >= TIMESTAMP '{DRIFT_DAY}' AND l_tax > 0.06 THEN 'AIR' ELSE l_linestatus END AS shipped, l_shipdate >= TIMESTAMP '{DRIFT_DAY}' AS cur FROM lineitem),
""" + ", ".join(f"ed_{c} AS (SELECT DISTINCT unnest(q) AS e FROM (SELECT quantile_cont({c}, {[i / 10 for i in range(11)]}) AS q FROM dr WHERE NOT cur))" for c in NUMERIC) + ", " + ", ".join(
    f"in_{c} AS (SELECT e FROM ed_{c} WHERE e > (SELECT min(e) FROM ed_{c}) AND e < (SELECT max(e) FROM ed_{c}))" for c in NUMERIC) + ", bk AS (" + " UNION ALL ".join(
    [f"SELECT cur, '{c}' AS feature, 'numeric' AS kind, CAST((SELECT count(*) FROM in_{c} WHERE e < {c}) AS VARCHAR) AS bucket FROM dr" for c in NUMERIC]
    + [f"SELECT cur, '{c}', 'categorical', {c} FROM dr" for c in CATEGORICAL]) + """),
sh AS (SELECT cur, feature, kind, bucket, count(*) / sum(count(*)) OVER (PARTITION BY cur, feature) AS share FROM bk GROUP BY cur, feature, kind, bucket)"""


def _drift(t: Tables):
    late = F.col("l_shipdate") >= F.lit(DRIFT_DAY).cast("timestamp_ntz")
    df = t.lineitem.select(
        "l_quantity", (F.col("l_extendedprice") * F.when(late, 1.5).otherwise(1.0)).alias("l_extendedprice"), "l_discount", "l_returnflag",
        F.when(late & (F.col("l_tax") > 0.06), "AIR").otherwise(F.col("l_linestatus")).alias("shipped"), late.alias("cur"))
    path = scratch(t.spark, "profile")
    drift.save_profile(df.filter("NOT cur"), NUMERIC, CATEGORICAL, path)
    return drift.Profile(t.spark, path), df.filter("cur")


@query("drift_reference", f"WITH {DRIFT_ROWS} SELECT feature, kind, bucket, round(share, 9) AS share FROM sh WHERE NOT cur")
def _(t):
    return rounded(_drift(t)[0].shares.select("feature", "kind", "bucket", "share"), 9)


PSI_SQL = f"""{DRIFT_ROWS}, j AS (SELECT feature, kind, greatest(coalesce(r.share, 0), 1e-6) AS e, greatest(coalesce(c.share, 0), 1e-6) AS a
  FROM (SELECT * FROM sh WHERE NOT cur) r FULL JOIN (SELECT * FROM sh WHERE cur) c USING (feature, kind, bucket)),
ps AS (SELECT feature, kind, round(sum((a - e) * ln(a / e)), 6) AS psi FROM j GROUP BY ALL),
rep AS (SELECT feature, kind, psi, CASE WHEN psi >= 0.25 THEN 'drift' WHEN psi >= 0.1 THEN 'warning' ELSE 'stable' END AS status FROM ps
  UNION ALL SELECT 'l_comment', 'categorical', NULL, 'missing')"""


@query("drift_psi", f"WITH {PSI_SQL} SELECT * FROM rep")
def _(t):
    profile, batch = _drift(t)
    return profile.compare(batch, expected={"l_comment": "categorical"})


@query("drift_summary", f"""WITH {PSI_SQL} SELECT bool_or(status = 'drift') AS drift_detected, max(psi) AS max_psi,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE status = 'drift'), '') AS drifted_features,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE status = 'warning'), '') AS warning_features FROM rep""")
def _(t):
    profile, batch = _drift(t)
    return drift.summary(profile.compare(batch))


@query("drift_unseen", f"WITH {DRIFT_ROWS} SELECT feature, bucket AS category FROM sh WHERE cur AND kind = 'categorical' AND (feature, bucket) NOT IN (SELECT (feature, bucket) FROM sh WHERE NOT cur)")
def _(t):
    profile, batch = _drift(t)
    return drift.unseen(profile.shares, profile.of(batch))


# An all-null column of a batch has drifted, one that is not there is missing.
@query("drift_null_column", f"""WITH {DRIFT_ROWS}, n AS (SELECT feature, kind, greatest(share, 1e-6) AS e FROM sh WHERE NOT cur AND feature = 'l_discount')
SELECT feature, kind, round(sum((1e-6 - e) * ln(1e-6 / e)), 6) AS psi, 'drift' AS status FROM n GROUP BY ALL
UNION ALL SELECT 'l_quantity', 'numeric', NULL, 'missing'""")
def _(t):
    profile, batch = _drift(t)
    holed = batch.drop("l_quantity").withColumn("l_discount", F.lit(None).cast("double"))
    return profile.compare(holed).filter("feature IN ('l_discount', 'l_quantity')")
