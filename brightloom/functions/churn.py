"""Column rules for the subscriber domain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from brightloom.functions.common import CHURN_BANDS, band, right_closed

# Service columns, tenure buckets, texts of interventions and drivers.
SERVICES = ["PhoneService", "MultipleLines", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
            "TechSupport", "StreamingTV", "StreamingMovies"]
STREAMING = ["StreamingTV", "StreamingMovies"]
SECURITY = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport"]
INTERNET = ["DSL", "Fiber optic"]
TENURE_EDGES = [-1, 12, 24, 48, 60, 100]
TENURE_LABELS = ["0-1yr", "1-2yr", "2-4yr", "4-5yr", "5yr+"]

NO_ACTION = "No intervention. Maintain standard automated marketing communications."
MEDIUM_PREFIX = "Email Outreach: "
MEDIUM_CONTRACT = "Suggest upgrading to an annual contract with a 5% monthly discount."
MEDIUM_PAYMENT = "Promote a $5 one-time credit for enrolling in Auto-Pay."
MEDIUM_SECURITY = "Offer a 14-day free trial of Online Security."
MEDIUM_DEFAULT = "Send a customer satisfaction survey with usage tips."
HIGH_PREFIX = "Retention Call: "
HIGH_CONTRACT = "Offer a 10% discount on a 1-Year Contract upgrade."
HIGH_SECURITY = "Offer free Online Security + Tech Support bundle for 3 months."
HIGH_CHARGE = "Perform plan optimization to transition to a more cost-effective bundle."
HIGH_DEFAULT = "Offer a loyalty check-in call with a $15 service credit."
CRITICAL_PREFIX = "Priority loyalty offer: "
CRITICAL_CONTRACT = "Urgent retention call: Offer 20% discount on a 1-Year contract, or $150 credit."
CRITICAL_LOYAL = "Loyalty VIP offer: Direct billing credit of $100 or a plan upgrade at no extra cost."
CRITICAL_CHARGE = "Downgrade offer: Switch to a slightly lower-tier plan with waived fees."

# (parts the feature name contains, direction or None for both, text); "=x" asks for the
# exact name; tried in this order.
DRIVER_TEXTS: list[tuple[list[str], str | None, str]] = [
    (["Contract", "Month-to-month"], None, "Being on a Month-to-Month contract is a major risk factor, making it easy for the customer to cancel."),
    (["Contract", "Two year"], None, "The 2-Year Contract provides high security and strongly protects against churn."),
    (["Contract", "One year"], None, "The 1-Year Contract acts as a stabilizer, decreasing churn risk compared to month-to-month."),
    (["=tenure"], "risk", "A low tenure ({value} months) indicates a new customer who is still in the high-risk onboarding phase."),
    (["=tenure"], "protects", "A long tenure ({value} months) indicates high customer loyalty and lowers churn risk."),
    (["tenure_group", "0-1yr"], None, "The customer is in their first year, which is historically the highest-risk churn period."),
    (["tenure_group", "5yr+"], None, "Being a long-term customer (5+ years) indicates strong brand loyalty."),
    (["InternetService", "Fiber optic"], None, "Having Fiber Optic internet increases risk, often tied to higher price tiers or service reliability issues."),
    (["InternetService", "DSL"], None, "Having DSL internet is associated with stable retention, though it represents a lower revenue bracket."),
    (["InternetService", "No"], None, "Not having internet service decreases churn risk, as these are typically low-complexity accounts."),
    (["PaymentMethod", "Electronic check"], None, "Paying via Electronic Check is highly linked to churn, possibly due to manual monthly intervention requirements."),
    (["PaymentMethod", "automatic"], None, "Using an automatic payment method (credit card/bank transfer) reduces billing friction and increases retention."),
    (["OnlineSecurity", "Yes"], None, "Subscribing to Online Security is a major protective factor, increasing customer dependency and product stickiness."),
    (["TechSupport", "Yes"], None, "Having active Tech Support subscription indicates the customer receives help, decreasing churn risk."),
    (["PaperlessBilling", "Yes"], "risk", "Paperless Billing is active, which sometimes correlates with high digital awareness and competitive price shopping."),
    (["service_count"], "risk", "Low service count ({value}) means low product stickiness; they can easily switch to a competitor."),
    (["service_count"], "protects", "High service count ({value}) indicates deep integration with our services, increasing switching costs."),
    (["MonthlyCharges"], "risk", "Higher than average monthly charges create bill shock and make them sensitive to cheaper competitor deals."),
    (["MonthlyCharges"], "protects", "Reasonable monthly pricing reduces billing pressure, acting as a retention driver."),
    (["tenure_monthly_interaction"], "risk", "Higher than average monthly charges create bill shock and make them sensitive to cheaper competitor deals."),
    (["tenure_monthly_interaction"], "protects", "Reasonable monthly pricing reduces billing pressure, acting as a retention driver."),
    (["security_count"], "risk", "Having few security/support features ({value}) reduces switching costs and makes churn easier."),
    (["security_count"], "protects", "Subscribing to multiple security/backup/support services ({value}) makes the account highly sticky."),
]
DRIVER_DEFAULTS = {"risk": "increases churn risk", "protects": "supports retention"}


def clean_total(total: Column, tenure: Column, monthly: Column) -> Column:
    """Text to number; blanks become 0 for a new subscriber, else tenure x monthly."""
    text = F.nullif(F.trim(total.cast("string")), F.lit(""))
    return F.coalesce(
        text.try_cast("double"), F.when(tenure == 0, F.lit(0.0)).otherwise(tenure * monthly))


def label_code(churn: Column) -> Column:
    return F.when(churn == "Yes", 1).when(churn == "No", 0)


def tenure_years(tenure: Column) -> Column:
    return F.floor(tenure / 12)


def tenure_bucket(tenure: Column) -> Column:
    return F.coalesce(right_closed(tenure, TENURE_EDGES, TENURE_LABELS), F.lit("nan"))


def yes_count(columns: Sequence[str], present: Sequence[str]) -> Column:
    flags = [F.coalesce((F.col(c) == "Yes").cast("int"), F.lit(0)) for c in columns if c in present]
    return reduce(lambda a, b: a + b, flags, F.lit(0))


def service_count(present: Sequence[str]) -> Column:
    out = yes_count(SERVICES, present)
    if "InternetService" in present:
        out = out + F.coalesce(F.col("InternetService").isin(INTERNET).cast("int"), F.lit(0))
    return out


def average_revenue(total: Column, tenure: Column, monthly: Column) -> Column:
    return F.coalesce(F.when(tenure == 0, monthly).otherwise(total / tenure), monthly)


def recommendation(prob: Column, contract: Column, payment: Column, security: Column, support: Column, monthly: Column) -> Column:
    """One action text per subscriber from the risk band and the matching conditions."""
    risk = band(prob, CHURN_BANDS)
    flexible = contract == "Month-to-month"

    def offers(prefix: str, choices: Sequence[tuple[Column, str]], default: str | None) -> Column:
        hits = F.array_compact(F.array(*[F.when(c, F.lit(text)) for c, text in choices]))
        joined = F.array_join(hits, " or ")
        if default is not None:
            joined = F.when(F.size(hits) == 0, default).otherwise(joined)
        return F.concat(F.lit(prefix), joined)

    return (
        F.when(risk == "Low", NO_ACTION)
        .when(risk == "Medium", offers(MEDIUM_PREFIX, [
            (flexible, MEDIUM_CONTRACT), (payment.contains("Electronic check"), MEDIUM_PAYMENT),
            (security == "No", MEDIUM_SECURITY)], MEDIUM_DEFAULT))
        .when(risk == "High", offers(HIGH_PREFIX, [
            (flexible, HIGH_CONTRACT), ((security == "No") | (support == "No"), HIGH_SECURITY),
            (monthly > 80, HIGH_CHARGE)], HIGH_DEFAULT))
        .otherwise(offers(CRITICAL_PREFIX, [
            (flexible, CRITICAL_CONTRACT), (~flexible, CRITICAL_LOYAL), (monthly > 90, CRITICAL_CHARGE)], None))
    )


def confidence(prob: Column, threshold: float) -> Column:
    """0.5 at the threshold up to 1 at the far end of its side."""
    above = F.when(prob >= threshold, (prob - threshold) / F.nullif(F.lit(1.0 - threshold), F.lit(0.0)))
    side = above.otherwise((F.lit(threshold) - prob) / F.nullif(F.lit(float(threshold)), F.lit(0.0)))
    return F.round(0.5 + 0.5 * F.coalesce(side, F.lit(0.0)), 4)


def driver_text(feature: Column, value: Column, is_risk: Column) -> Column:
    """Plain sentence for a feature's effect."""
    hits = []
    for parts, direction, text in DRIVER_TEXTS:
        cond = F.lit(True)
        for p in parts:
            cond = cond & ((feature == p[1:]) if p.startswith("=") else feature.contains(p))
        if direction is not None:
            cond = cond & (is_risk if direction == "risk" else ~is_risk)
        hits.append(F.when(cond, F.replace(F.lit(text), F.lit("{value}"), value.cast("int").cast("string"))))
    effect = F.when(is_risk, DRIVER_DEFAULTS["risk"]).otherwise(DRIVER_DEFAULTS["protects"])
    generic = F.concat(F.lit("Feature '"), feature, F.lit("' (value: "), value.cast("string"), F.lit(") "), effect, F.lit("."))
    return F.coalesce(*hits, generic)
