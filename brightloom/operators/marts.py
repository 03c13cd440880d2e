"""Marts over orders and events: history, subscription movements, cohorts, forecasts,
prices, ledgers and tickets.

Raw rows are folded to calendar grain (customer and day or month, item and month) before
a window runs, so a window partition is bounded by the calendar however active one
customer or item is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.operators.quality import union_all
from brightloom.session import cut


def month_of(ts: str | Column) -> Column:
    return F.trunc(ts, "month")


# Generic tests -------------------------------------------------------------------


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def relationship_violations(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    return child.filter(F.col(column).isNotNull()).join(parent.select(F.col(key).alias(column)), column, "left_anti")


def failing_rows(tests: dict[str, DataFrame]) -> DataFrame:
    """One row per test with the number of violations."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(name).alias("test"), "failures") for name, df in tests.items()])


# Funnel and history --------------------------------------------------------------


def funnel_dropoff(events: DataFrame, user: str, ts: str, step: str, steps: Sequence[str], window: Column) -> DataFrame:
    """Users reaching each step in order inside a window, and the share of the step before.

    A step is reached at its first time after the step before, so an early click does not
    hide a later one. Times are folded per user, window and step before they meet, and every
    step joins on user and window, by which the rows lie already. Events without a user or
    a window count for nobody.
    """
    times = events.filter(F.col(step).isin(list(steps))).groupBy(
        F.col(user).alias("u"), window.alias("w"), F.col(step).alias("s"), F.col(ts).alias("t")).agg(F.count(F.lit(1)).alias("n"))
    times = cut(times.filter("u is not null and w is not null").select("u", "w", "s", "t").repartition("u", "w"))
    first = times.filter(F.col("s") == steps[0]).groupBy("u", "w").agg(F.min("t").alias("t0"))
    for i, s in enumerate(steps[1:], 1):
        before = first.select("u", "w", F.col(f"t{i - 1}").alias("before"))
        later = times.filter(F.col("s") == s).join(before, ["u", "w"]).filter("t > before")
        first = first.join(later.groupBy("u", "w").agg(F.min("t").alias(f"t{i}")), ["u", "w"], "left")
    reached = [F.count(f"t{i}").alias(f"n{i}") for i in range(len(steps))]
    rows = [
        F.struct(F.lit(i + 1).alias("position"), F.lit(s).alias("step"), F.col(f"n{i}").alias("users"),
                 (F.lit(1.0) if i == 0 else F.col(f"n{i}") / F.nullif(F.col(f"n{i - 1}"), F.lit(0))).alias("conversion"))
        for i, s in enumerate(steps)
    ]
    return first.agg(*reached).select(F.inline(F.array(*rows)))


def attribute_history(changes: DataFrame, entity: str, ts: str, value: str, tie: str) -> DataFrame:
    """Validity ranges of an attribute, day by day: the last value of a day counts, equal
    neighbours are merged, the newest range is open."""
    day = changes.groupBy(entity, F.to_date(ts).alias("valid_from")).agg(F.max_by(value, F.struct(ts, tie)).alias(value))
    w = Window.partitionBy(entity).orderBy("valid_from")
    first = F.lag("valid_from").over(w).isNull()  # a null value is a value of its own
    changed = day.withColumn("_new", first | ~F.lag(value).over(w).eqNullSafe(F.col(value))).filter("_new").drop("_new")
    return changed.withColumn("valid_to", F.lead("valid_from").over(w)).withColumn("is_current", F.col("valid_to").isNull())


def _day_changes(changes: DataFrame, entity: str, ts: str, value: str, tie: str) -> DataFrame:
    """(entity, day, at, tie, value): what counts of each day, its last change."""
    last = F.max_by(F.struct(F.col(ts).alias("at"), F.col(tie).alias("tie"), F.col(value).alias("value")), F.struct(ts, tie))
    return changes.groupBy(entity, F.to_date(ts).alias("day")).agg(last.alias("c")).select(entity, "day", "c.at", "c.tie", "c.value")


def _ranges(days: DataFrame, entity: str, value: str) -> DataFrame:
    """Validity ranges of day changes; ``seen`` keeps the days that each range was built from,
    one entry a day, so that a late change can split it at the right place."""
    w = Window.partitionBy(entity).orderBy("day")
    first = F.lag("day").over(w).isNull()
    new = first | ~F.lag("value").over(w).eqNullSafe(F.col("value"))
    runs = days.withColumn("run", F.sum(new.cast("int")).over(w))
    ranges = runs.groupBy(entity, "run").agg(
        F.min("day").alias("valid_from"), F.min_by("value", "day").alias(value), F.array_sort(F.collect_list(F.struct("day", "at", "tie"))).alias("seen"))
    after = F.lead("valid_from").over(Window.partitionBy(entity).orderBy("run"))
    return ranges.withColumn("valid_to", after).select(entity, value, "valid_from", "valid_to", F.col("valid_to").isNull().alias("is_current"), "seen")


def open_history(changes: DataFrame, entity: str, ts: str, value: str, tie: str) -> DataFrame:
    """The history that ``merge_history`` keeps up to date: the ranges of
    ``attribute_history`` and, in ``seen``, the days behind each."""
    return _ranges(_day_changes(changes, entity, ts, value, tie), entity, value)


def merge_history(history: DataFrame, changes: DataFrame, entity: str, ts: str, value: str, tie: str) -> DataFrame:
    """A batch of changes, late and current ones, brought into a history: ranges are closed,
    split, joined and opened as if all changes had come at once, in whatever order the batches
    come and however often. Only entities of the batch are worked on, the others pass through;
    rows without an entity are one entity."""
    batch = _day_changes(changes, entity, ts, value, tie)
    touched = batch.select(F.col(entity).alias("_touched")).distinct()
    same = history[entity].eqNullSafe(touched["_touched"])
    known = history.join(touched, same, "left_semi").select(entity, F.col(value).alias("value"), F.explode("seen").alias("s"))
    both = known.select(entity, "s.day", "s.at", "s.tie", "value").unionByName(batch)
    last = F.max_by(F.struct("at", "tie", "value"), F.struct("at", "tie"))
    days = both.groupBy(entity, "day").agg(last.alias("c")).select(entity, "day", "c.at", "c.tie", "c.value")
    return history.join(touched, same, "left_anti").unionByName(_ranges(days, entity, value))


# Subscriptions -------------------------------------------------------------------


def monthly_amounts(orders: DataFrame, customer: str, ts: str, amount: str) -> DataFrame:
    return orders.groupBy(F.col(customer).alias("customer"), month_of(ts).alias("month")).agg(
        F.sum(F.col(amount).cast("decimal(18,2)")).cast("decimal(20,2)").alias("mrr"))


def movements(monthly: DataFrame) -> DataFrame:
    """(customer, month, kind, amount): new, expansion, contraction, churned. A customer
    that returns after a gap is new again; churn falls in the first month without
    revenue, if the data reaches it."""
    w = Window.partitionBy("customer").orderBy("month")
    zero = F.lit(0).cast("decimal(20,2)")
    follows = F.lag("month").over(w) == F.add_months("month", -1)
    prev = F.when(follows, F.lag("mrr").over(w))
    ends = F.coalesce(F.lead("month").over(w) != F.add_months("month", 1), F.lit(True))
    last = monthly.agg(F.max("month")).scalar()
    m = monthly.withColumns({"prev": prev, "ends": ends, "last": last})
    kind = F.when(F.col("prev").isNull(), "new").when(F.col("mrr") > F.col("prev"), "expansion").when(
        F.col("mrr") < F.col("prev"), "contraction")
    moved = m.select("customer", "month", kind.alias("kind"), (F.col("mrr") - F.coalesce("prev", zero)).cast("decimal(20,2)").alias("amount"))
    gone = m.filter(F.col("ends") & (F.col("month") < F.col("last"))).select(
        "customer", F.add_months("month", 1).alias("month"), F.lit("churned").alias("kind"), (-F.col("mrr")).cast("decimal(20,2)").alias("amount"))
    return moved.filter("kind IS NOT NULL").unionByName(gone)


def movement_bridge(moves: DataFrame) -> DataFrame:
    kinds = ["new", "expansion", "contraction", "churned"]
    return moves.groupBy("month").agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("amount"))), F.lit(0)).cast("decimal(20,2)").alias(k) for k in kinds])


def reconcile(monthly: DataFrame, bridge: DataFrame) -> DataFrame:
    """Start plus movements minus end per month; every difference must be 0. The window
    holds one row per calendar month."""
    total = monthly.groupBy("month").agg(F.sum("mrr").cast("decimal(20,2)").alias("end_mrr"))
    net = F.col("new") + F.col("expansion") + F.col("contraction") + F.col("churned")
    joined = bridge.join(total, "month", "left").withColumn("end_mrr", F.coalesce("end_mrr", F.lit(0).cast("decimal(20,2)")))
    start = F.coalesce(F.lag("end_mrr").over(Window.orderBy("month")), F.lit(0).cast("decimal(20,2)"))
    return joined.withColumn("start_mrr", start).select(
        "month", "start_mrr", net.cast("decimal(20,2)").alias("net_change"), "end_mrr",
        (F.col("start_mrr") + net - F.col("end_mrr")).cast("decimal(20,2)").alias("difference"))


def subscription_events(moves: DataFrame) -> DataFrame:
    """Signups, upgrades, downgrades and cancellations as rows."""
    names = {"new": "signup", "expansion": "upgrade", "contraction": "downgrade", "churned": "cancellation"}
    event = F.coalesce(*[F.when(F.col("kind") == k, F.lit(v)) for k, v in names.items()])
    return moves.select("customer", "month", event.alias("event"), "amount")


def cohort_retention(monthly: DataFrame) -> DataFrame:
    """Share of each first-month cohort active N months later."""
    first = monthly.groupBy("customer").agg(F.min("month").alias("cohort"))
    active = monthly.join(first, "customer").select(
        "cohort", F.months_between("month", "cohort").cast("int").alias("month_no"))
    size = first.groupBy("cohort").agg(F.count(F.lit(1)).alias("cohort_size"))
    return active.groupBy("cohort", "month_no").agg(F.count(F.lit(1)).alias("active")).join(size, "cohort").withColumn(
        "retention", F.col("active") / F.col("cohort_size"))


def revenue_trend(orders: DataFrame, customer: str, ts: str, amount: str) -> DataFrame:
    """Revenue, active and new customers per month."""
    monthly = monthly_amounts(orders, customer, ts, amount)
    first = F.min("month").over(Window.partitionBy("customer"))
    return monthly.withColumn("first", first).groupBy("month").agg(
        F.sum("mrr").cast("decimal(20,2)").alias("revenue"), F.count(F.lit(1)).alias("active_customers"),
        F.count_if(F.col("month") == F.col("first")).alias("new_customers"))


# Demand --------------------------------------------------------------------------


def monthly_demand(df: DataFrame, item: str, ts: str, quantity: str) -> DataFrame:
    """Demand per item and month on a complete spine; a month without sales is 0."""
    sold = cut(df.groupBy(F.col(item).alias("item"), month_of(ts).alias("month")).agg(F.sum(quantity).cast("double").alias("demand")))
    span = sold.agg(F.struct(F.min("month").alias("lo"), F.max("month").alias("hi"))).scalar()
    spine = sold.select("item").distinct().withColumn("_s", span).select(
        "item", F.explode(F.sequence(F.col("_s.lo"), F.col("_s.hi"), F.expr("interval 1 month"))).alias("month"))
    return spine.join(sold, ["item", "month"], "left").select("item", "month", F.coalesce("demand", F.lit(0.0)).alias("demand"))


def _by_item() -> object:
    return Window.partitionBy("item").orderBy("month")


def seasonal_naive(demand: DataFrame, season: int = 12) -> DataFrame:
    return demand.withColumn("forecast", F.lag("demand", season).over(_by_item()))


def demand_features(demand: DataFrame, lags: Sequence[int] = (1, 2, 3, 12), windows: Sequence[int] = (3, 6, 12)) -> DataFrame:
    """Lags and means of the months before the current one."""
    w = _by_item()
    return demand.withColumns({
        **{f"lag_{n}": F.lag("demand", n).over(w) for n in lags},
        **{f"mean_{n}": F.avg("demand").over(w.rowsBetween(-n, -1)) for n in windows},
        **{f"max_{n}": F.max("demand").over(w.rowsBetween(-n, -1)) for n in windows},
    })


def backtest(demand: DataFrame, origins: int = 12, horizon: int = 3, window: int = 3) -> DataFrame:
    """Errors per item of two forecasts over rolling origins.

    The last ``origins`` months before the horizon are origins; each forecasts the next
    ``horizon`` months by the mean of the ``window`` months up to the origin and by the
    same month a year before. Each origin row lists its targets, which meet the actuals
    by an equal join.
    """
    w = _by_item()
    known = demand.withColumn("mean_fc", F.avg("demand").over(w.rowsBetween(-(window - 1), 0)))
    last = demand.agg(F.max("month")).scalar()
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")
    targets = known.withColumn("last", last).filter(
        (F.col("month") <= F.add_months("last", -horizon)) & (F.col("month") > F.add_months("last", -horizon - origins))
    ).select("item", F.col("month").alias("origin"), "mean_fc", step).withColumn("month", F.add_months("origin", F.col("h")))
    scored = targets.join(seasonal_naive(demand).withColumnRenamed("forecast", "naive_fc"), ["item", "month"])
    rows = [F.struct(F.lit(m).alias("method"), F.col(c).alias("fc")) for m, c in (("rolling_mean", "mean_fc"), ("seasonal_naive", "naive_fc"))]
    long = scored.select("item", "demand", F.inline(F.array(*rows))).filter("fc IS NOT NULL")
    err = F.abs(F.col("demand") - F.col("fc"))
    return long.groupBy("item", "method").agg(
        F.count(F.lit(1)).alias("n"), (F.avg(F.when(F.col("demand") != 0, err / F.abs("demand"))) * 100).alias("mape"),
        (F.sum(err) / F.nullif(F.sum(F.abs("demand")), F.lit(0.0)) * 100).alias("wape"))


def inventory_advice(demand: DataFrame, months: int = 3, margin: float = 0.1) -> DataFrame:
    """Next month's seasonal forecast against the trailing mean, with an advice."""
    w = _by_item()
    m = demand.withColumns({"recent": F.avg("demand").over(w.rowsBetween(-(months - 1), 0)), "forecast": F.lag("demand", 11).over(w)})
    newest = m.groupBy("item").agg(F.max_by(F.struct("recent", "forecast"), F.col("month")).alias("r")).select("item", "r.*")
    advice = F.when(F.col("forecast") > F.col("recent") * (1 + margin), "reorder").when(
        F.col("forecast") < F.col("recent") * (1 - margin), "reduce").otherwise("hold")
    return newest.withColumn("advice", F.when(F.col("forecast").isNull(), "no history").otherwise(advice))


# Prices --------------------------------------------------------------------------


def daily_prices(df: DataFrame, ticker: str, ts: str, price: str, tie: str) -> DataFrame:
    """Close (last price, ``tie`` deciding between equal times), high, low and volume per
    ticker and day."""
    return df.groupBy(F.col(ticker).alias("ticker"), F.to_date(ts).alias("day")).agg(
        F.max_by(price, F.struct(ts, tie)).alias("close"), F.max(price).alias("high"), F.min(price).alias("low"), F.count(F.lit(1)).alias("volume"))


def price_features(prices: DataFrame, fast: int = 3, slow: int = 10) -> DataFrame:
    """Trend, momentum, breakout, volume and volatility per ticker and day; null until a
    window is full. The published description gives no formulas; these are ours."""
    w = Window.partitionBy("ticker").orderBy("day")

    def full(agg: Column, n: int, start: int = 0) -> Column:
        frame = w.rowsBetween(-(n - 1) - start, -start)
        return F.when(F.count("close").over(frame) == n, agg.over(frame))

    ret = F.col("close") / F.lag("close").over(w) - 1
    return prices.withColumn("ret", ret).withColumns({
        "trend": full(F.avg("close"), fast) / full(F.avg("close"), slow) - 1,
        "momentum": F.col("close") / F.lag("close", slow).over(w) - 1,
        "breakout": (F.col("close") > full(F.max("high"), slow, 1)).cast("int"),
        "volume_ratio": F.col("volume") / full(F.avg("volume"), slow, 1),
        "volatility": F.when(F.count("ret").over(w.rowsBetween(-(slow - 1), 0)) == slow, F.stddev_samp("ret").over(w.rowsBetween(-(slow - 1), 0))),
    })


def price_score(features: DataFrame) -> DataFrame:
    """Weighted rule score, its rank among the day's tickers and a tier."""
    def rule(cond: Column, points: int) -> Column:
        return F.when(cond, points).otherwise(0)

    score = (
        rule(F.col("trend") > 0, 30) + rule(F.col("momentum") > 0, 25) + rule(F.col("breakout") == 1, 20)
        + rule(F.col("volume_ratio") > 1.0, 15) + rule(F.col("volatility") < 1.0, 10))
    s = features.filter("volatility IS NOT NULL").withColumn("score", score)
    # tickers are folded to their distinct scores per day first: at most 101 of them
    levels = s.select("day", "score").distinct().withColumn(
        "position", F.dense_rank().over(Window.partitionBy("day").orderBy(F.desc("score"))))
    tier = F.when(F.col("score") >= 70, "A").when(F.col("score") >= 40, "B").otherwise("C")
    return s.join(levels, ["day", "score"]).select("ticker", "day", "score", "position", tier.alias("tier"))


def forward_returns(scored: DataFrame, prices: DataFrame, holds: Sequence[int] = (1, 3, 5)) -> DataFrame:
    """Mean forward return and hit rate per tier and holding period."""
    w = Window.partitionBy("ticker").orderBy("day")
    ahead = prices.select("ticker", "day", *[(F.lead("close", h).over(w) / F.col("close") - 1).alias(f"r{h}") for h in holds])
    rows = [F.struct(F.lit(h).alias("hold"), F.col(f"r{h}").alias("r")) for h in holds]
    long = scored.join(ahead, ["ticker", "day"]).select("tier", F.inline(F.array(*rows))).filter("r IS NOT NULL")
    return long.groupBy("tier", "hold").agg(
        F.count(F.lit(1)).alias("n"), F.avg("r").alias("mean_return"), (F.count_if(F.col("r") > 0) / F.count(F.lit(1))).alias("hit_rate"))


def drawdown(prices: DataFrame) -> DataFrame:
    """Deepest fall from the running peak per ticker."""
    w = Window.partitionBy("ticker").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return prices.withColumn("_d", F.col("close") / F.max("close").over(w) - 1).groupBy("ticker").agg(F.min("_d").alias("max_drawdown"))


# Ledger and tickets --------------------------------------------------------------


def categorize(text: Column, rules: Sequence[tuple[str, str]], default: str = "other") -> Column:
    """Category of the longest keyword inside the text; of equally long ones the last in
    the alphabet."""
    low = F.lower(text)
    hits = F.array_compact(F.array(*[
        F.when(low.contains(k), F.struct(F.lit(len(k)).alias("size"), F.lit(k).alias("keyword"), F.lit(c).alias("category"))) for k, c in rules]))
    return F.coalesce(F.array_max(hits)["category"], F.lit(default))


def month_over_month(monthly: DataFrame, key: str, value: str) -> DataFrame:
    """Change against the month before; null where that month has no row."""
    w = Window.partitionBy(key).orderBy("month")
    adjacent = F.to_date(F.lag("month").over(w)) == F.add_months(F.to_date("month"), -1)
    prev = F.when(adjacent, F.lag(value).over(w))
    return monthly.withColumn("previous", prev).withColumns({
        "change": F.col(value) - F.col("previous"),
        "change_pct": (F.col(value) - F.col("previous")).cast("double") / F.nullif(F.col("previous").cast("double"), F.lit(0.0)) * 100})


def triage(tickets: DataFrame, orders: DataFrame, faq: Sequence[tuple[str, str]], as_of: Column, return_days: int = 30) -> DataFrame:
    """Answer each ticket by the first tool that fits: a return if the order allows it,
    the order's status, an FAQ entry; the rest goes to a person.

    ``tickets`` has (ticket, order_key, text); ``orders`` (order_key, status, ordered).
    """
    t = tickets.join(orders, "order_key", "left")
    age = F.datediff(as_of, F.to_date("ordered"))
    eligible = (F.col("status") == "F") & (age <= return_days)
    found = categorize(F.col("text"), faq, "")
    action = (
        F.when(eligible, "return").when(F.col("status").isNotNull(), "status").when(found != "", "faq").otherwise("escalate"))
    answer = F.when(action == "return", F.concat(F.lit("return until day "), F.lit(str(return_days)))).when(
        action == "status", F.concat(F.lit("order is "), F.col("status"))).when(action == "faq", found)
    return t.select("ticket", action.alias("action"), answer.alias("answer"))
