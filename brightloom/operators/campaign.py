"""Money outcome of a retention campaign."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The sweep from 0.01 to 0.99.
THRESHOLDS = [round(0.01 * i, 2) for i in range(1, 100)]


@dataclass(frozen=True)
class Terms:
    """Cost per contact, incentive, acceptance and months a save lasts."""

    contact_cost: float = 20.0
    incentive: float = 100.0
    acceptance: float = 0.60
    months: int = 6


def _outcome(counts: dict[str, Column], value: dict[str, Column], t: Terms) -> dict[str, Column]:
    """Columns from counts (tp, fp, fn, tn) and monthly charges lost or reached (tp, fn)."""
    outreach = (counts["tp"] + counts["fp"]) * F.lit(t.contact_cost)
    payout = counts["tp"] * F.lit(t.acceptance) * F.lit(t.incentive) + counts["fp"] * F.lit(t.incentive)
    cost = outreach + payout
    saved = value["tp"] * F.lit(t.months) * F.lit(t.acceptance)
    net = saved - cost
    return {
        "baseline_loss": (value["tp"] + value["fn"]) * F.lit(t.months),
        "outreach_cost": outreach, "discount_cost": payout, "total_cost": cost, "revenue_saved": saved,
        "opportunity_loss": value["fn"] * F.lit(t.months), "net_savings": net,
        "roi_pct": F.when(cost > 0, net / cost * 100).otherwise(0.0),
        "retained_estimate": counts["tp"] * F.lit(t.acceptance),
    }


def simulate(df: DataFrame, label: str, prob: str, monthly: str, threshold: float, terms: Terms = Terms()) -> DataFrame:
    hit, y = F.col(prob) >= threshold, F.col(label)
    cell = {"tp": hit & (y == 1), "fp": hit & (y == 0), "fn": ~hit & (y == 1), "tn": ~hit & (y == 0)}
    one = df.agg(
        *[F.count_if(c).alias(k) for k, c in cell.items()],
        *[F.coalesce(F.sum(F.when(cell[k], F.col(monthly))), F.lit(0.0)).alias(f"_{k}") for k in ("tp", "fn")])
    out = one.withColumns(_outcome({k: F.col(k) for k in cell}, {"tp": F.col("_tp"), "fn": F.col("_fn")}, terms))
    return out.drop("_tp", "_fn").withColumn("threshold", F.lit(float(threshold)))


def sweep(df: DataFrame, label: str, prob: str, monthly: str, terms: Terms = Terms(), thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """The outcome at every threshold in one pass: rows are folded to the number of
    thresholds they reach (at most 100 groups); sums from the top give each threshold."""
    cuts = F.array(*[F.lit(float(x)) for x in thresholds])
    n = len(thresholds)
    lo, step = thresholds[0], (thresholds[-1] - thresholds[0]) / (n - 1)
    guess = F.greatest(F.lit(0), F.least(F.lit(n), F.floor((F.col(prob) - lo) / step).cast("int") + 1))
    # the guess can be one off where the probability sits on a threshold
    up = F.coalesce((F.col(prob) >= F.get(cuts, guess)).cast("int"), F.lit(0))
    down = F.coalesce((F.col(prob) < F.get(cuts, guess - 1)).cast("int"), F.lit(0))
    y = F.col(label)
    per = df.groupBy((guess + up - down).alias("reached")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"),
        F.coalesce(F.sum(F.when(y == 1, F.col(monthly))), F.lit(0.0)).alias("value"))
    grid = df.sparkSession.createDataFrame([(i + 1, float(x)) for i, x in enumerate(thresholds)], "reached int, threshold double")
    filled = grid.join(per, "reached", "left").fillna(0, ["pos", "neg", "value"])
    above = Window.orderBy(F.desc("reached")).rowsBetween(Window.unboundedPreceding, 0)
    totals = per.agg(F.struct(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("value").alias("value"))).scalar()
    s = filled.withColumns({
        "_t": totals, "tp": F.sum("pos").over(above), "fp": F.sum("neg").over(above), "_v": F.sum("value").over(above)})
    s = s.withColumns({"fn": F.col("_t.pos") - F.col("tp"), "tn": F.col("_t.neg") - F.col("fp")})
    value = {"tp": F.col("_v"), "fn": F.col("_t.value") - F.col("_v")}
    counts = {k: F.col(k) for k in ("tp", "fp", "fn", "tn")}
    return s.withColumns(_outcome(counts, value, terms)).drop("_t", "_v", "pos", "neg", "value", "reached")


def best_threshold(swept: DataFrame) -> DataFrame:
    """Largest net savings; the smallest threshold wins ties."""
    return swept.orderBy(F.desc("net_savings"), "threshold").limit(1)


def what_if(swept: DataFrame, grid: Sequence[Terms]) -> DataFrame:
    """The swept counts under other terms. ``swept`` must come from the same data; its
    charges are recovered from the terms it was made with (``Terms()``)."""
    base = Terms()
    tp_value = F.col("revenue_saved") / (base.months * base.acceptance)
    fn_value = F.col("opportunity_loss") / base.months
    counts = {k: F.col(k) for k in ("tp", "fp", "fn", "tn")}
    options = [
        F.struct(
            F.lit(t.contact_cost).alias("contact_cost"), F.lit(t.incentive).alias("incentive"),
            F.lit(t.acceptance).alias("acceptance"), F.lit(t.months).alias("months"),
            *[c.alias(k) for k, c in _outcome(counts, {"tp": tp_value, "fn": fn_value}, t).items()])
        for t in grid
    ]
    return swept.select("threshold", "tp", "fp", "fn", "tn", F.inline(F.array(*options)))


def funnel(one: DataFrame) -> DataFrame:
    """Stages of a simulated campaign with their share of the first stage."""
    total = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    stages = [
        ("total", total), ("churners", F.col("tp") + F.col("fn")), ("targeted", F.col("tp") + F.col("fp")),
        ("retained", F.floor("retained_estimate")),
    ]
    rows = [F.struct(F.lit(i + 1).alias("step"), F.lit(s).alias("stage"), v.cast("long").alias("n"),
                     (v / total * 100).alias("pct_of_total")) for i, (s, v) in enumerate(stages)]
    return one.select(F.inline(F.array(*rows)))
