"""Quality of scores against labels.

Everything is computed from one row per distinct score (counts of both classes), so the
raw rows are shuffled once, pre-aggregated, and the order-dependent parts run on the
folded table with ``running_totals``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brightloom.operators.ordering import row_numbers, running_totals
from brightloom.operators.quality import union_all
from brightloom.session import cut


def confusion(df: DataFrame, label: str, score: str, threshold: float, keys: Sequence[str] = ()) -> DataFrame:
    hit = F.col(score) >= threshold
    return df.groupBy(*keys).agg(
        F.count_if(hit & (F.col(label) == 1)).alias("tp"), F.count_if(hit & (F.col(label) == 0)).alias("fp"),
        F.count_if(~hit & (F.col(label) == 1)).alias("fn"), F.count_if(~hit & (F.col(label) == 0)).alias("tn"))


def _ratio(num: Column, den: Column) -> Column:
    return F.when(den == 0, 0.0).otherwise(num / den)


def confusion_rates(counts: DataFrame) -> DataFrame:
    """Rates from the four counts; a zero denominator gives 0."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    f1, f0 = _ratio(2 * tp, 2 * tp + fp + fn), _ratio(2 * tn, 2 * tn + fp + fn)
    recall, specificity = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    return counts.withColumns({
        "accuracy": _ratio(tp + tn, n), "balanced_accuracy": (recall + specificity) / 2,
        "precision": _ratio(tp, tp + fp), "recall": recall, "f1": f1,
        "f1_weighted": _ratio(f1 * (tp + fn) + f0 * (tn + fp), n),
        "mcc": _ratio(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))),
        "specificity": specificity, "false_alarm_rate": _ratio(fp, fp + tn), "miss_rate": _ratio(fn, fn + tp),
    })


def folded(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per distinct score: positives and negatives."""
    return df.groupBy(*keys, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))


def pr_curve(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, as a threshold: positives and negatives at or above it."""
    return running_totals(
        folded(df, label, score, keys), [F.col("score").desc()], {"tp": "pos", "fp": "neg"}, keys)


def _auc() -> Column:
    """Share of (positive, negative) pairs in the right order, ties count half."""
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    wrong = F.sum(F.col("pos") * (F.col("fp") - F.col("neg") / 2))
    return F.when(pairs > 0, 1 - wrong / pairs)


def _pr_area(method: str) -> Column:
    """``step`` is average precision; ``trapezoid`` joins the points by lines from
    (recall 0, precision 1)."""
    here = F.col("tp") / (F.col("tp") + F.col("fp"))
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    before = F.when(tp0 + fp0 == 0, 1.0).otherwise(tp0 / (tp0 + fp0))
    height = here if method == "step" else (here + before) / 2
    total = F.sum("pos")
    return F.when(total > 0, F.sum(F.col("pos") * height) / total)


def roc_auc(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    return pr_curve(df, label, score, keys).groupBy(*keys).agg(_auc().alias("roc_auc"))


def pr_auc(df: DataFrame, label: str, score: str, method: str, keys: Sequence[str] = ()) -> DataFrame:
    return pr_curve(df, label, score, keys).groupBy(*keys).agg(_pr_area(method).alias("pr_auc"))


def fbeta_threshold(df: DataFrame, label: str, score: str, beta: float = 1.0, min_recall: float = 0.70) -> DataFrame:
    """Score threshold with the best F-beta among those reaching the recall floor; without
    any, among all. The smallest threshold wins ties."""
    c = pr_curve(df, label, score)
    total = F.col("_p").cast("double")
    points = c.withColumn("_p", c.agg(F.sum("pos")).scalar())
    precision, recall = F.col("tp") / (F.col("tp") + F.col("fp")), F.col("tp") / total
    b2 = beta * beta
    fbeta = (1 + b2) * precision * recall / (b2 * precision + recall + 1e-9)
    ok = (recall >= min_recall).cast("int")
    best = F.min(F.struct(-ok, -fbeta, F.col("score")))
    return points.agg(best.alias("b")).select(
        F.col("b.score").alias("threshold"), (-F.col("b.col2")).alias("fbeta"),
        (F.col("b.col1") == -1).alias("floor_met"))


def brier(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.agg(F.avg((F.col(score) - F.col(label)) ** 2).alias("brier"), F.count(F.lit(1)).alias("n"))


def reliability(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Equal-width bins, closed on the right (the first also on the left): mean score and
    share of positives; empty bins have no row."""
    b = sum(((F.col(score) > F.lit(k * (1.0 / bins))).cast("int") for k in range(1, bins)), F.lit(0))
    return df.groupBy(b.alias("bin")).agg(
        F.avg(score).alias("mean_predicted"), F.avg(label).alias("fraction_positive"), F.count(F.lit(1)).alias("n"))


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, the weight of a positive row."""
    neg, pos = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(neg.alias("negatives"), pos.alias("positives"), (neg / F.greatest(pos, F.lit(1))).alias("pos_weight"))


def horizon_report(df: DataFrame, horizons: dict[str, tuple[str, str]], threshold: float, target_f1: float = 0.65) -> DataFrame:
    """Metric row per horizon ``{name: (label, score)}``; one-class horizons are skipped.
    All horizons share one pass over the rows and one curve."""
    pairs = [F.struct(F.lit(h).alias("horizon"), F.col(y).cast("int").alias("y"), F.col(p).cast("double").alias("p"))
             for h, (y, p) in horizons.items()]
    long = df.select(F.inline(F.array(*pairs)))
    hit, p, n = F.col("score") >= threshold, F.col("pos"), F.col("neg")
    one = pr_curve(long, "y", "p", ["horizon"]).groupBy("horizon").agg(
        F.sum(F.when(hit, p).otherwise(0)).alias("tp"), F.sum(F.when(hit, n).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(p)).alias("fn"), F.sum(F.when(hit, 0).otherwise(n)).alias("tn"),
        _auc().alias("roc_auc"), _pr_area("step").alias("pr_auc"))
    out = confusion_rates(one)
    mixed = (F.col("tp") + F.col("fn") > 0) & (F.col("fp") + F.col("tn") > 0)
    return out.filter(mixed).withColumn("passed", F.col("f1") >= target_f1)


def stratified_positions(df: DataFrame, label: str, key: str, seed: int) -> DataFrame:
    """Stable random order inside each class: ``pos`` of ``n``."""
    hashed = df.withColumn("_h", F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))))
    placed = row_numbers(hashed, [label], [F.col("_h"), F.col(key)], "pos")
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return placed.drop("_h").join(sizes, label)


def stratified_split(df: DataFrame, label: str, key: str, seed: int = 42, cuts: Sequence[float] = (0.70, 0.85)) -> DataFrame:
    """70/15/15 inside each class, the same rows under any partitioning."""
    placed = stratified_positions(df, label, key, seed)
    part = F.when(F.col("pos") <= F.round(F.col("n") * cuts[0]), "train").when(
        F.col("pos") <= F.round(F.col("n") * cuts[1]), "validation").otherwise("test")
    return placed.withColumn("part", part).drop("pos", "n")


def folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    placed = stratified_positions(df, label, key, seed)
    return placed.withColumn("fold", ((F.col("pos") - 1) % k).cast("int")).drop("pos", "n")


def linear_attribution(df: DataFrame, key: str, coefficients: dict[str, float], top_n: int = 4, floor: float = 0.001) -> DataFrame:
    """coefficient x (value - mean) per feature: the strongest up and down per row."""
    names = list(coefficients)
    df = cut(df.select(key, *names))
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in names])).scalar()
    long = all_attributions(df.withColumn("_m", means), [key], coefficients)
    side = F.when(F.col("attribution") > floor, "up").when(F.col("attribution") < -floor, "down")
    w = Window.partitionBy(key, "direction").orderBy(F.abs("attribution").desc(), "feature")
    return long.withColumn("direction", side).filter("direction IS NOT NULL").withColumn(
        "position", F.row_number().over(w)).filter(F.col("position") <= top_n)


def all_attributions(df: DataFrame, keep: Sequence[str], coefficients: dict[str, float]) -> DataFrame:
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"),
                 (F.lit(b) * (F.col(c) - F.col(f"_m.{c}"))).alias("attribution"))
        for c, b in coefficients.items()
    ]
    return df.select(*keep, F.inline(F.array(*rows)))


def importance(df: DataFrame, coefficients: dict[str, float], top_n: int, entity: str | None = None) -> DataFrame:
    """Mean absolute attribution per feature, overall or per entity, the largest first."""
    keys = [entity] if entity else []
    df = cut(df.select(*keys, *coefficients))
    means = df.groupBy(*keys).agg(F.struct(*[F.avg(c).alias(c) for c in coefficients]).alias("_m"))
    if entity:
        based = df.join(means, entity)
    else:
        based = df.withColumn("_m", means.scalar())
    per = all_attributions(based, keys, coefficients).groupBy(*keys, "feature").agg(
        F.avg(F.abs("attribution")).alias("mean_abs"))
    w = Window.partitionBy(*keys).orderBy(F.desc("mean_abs"), "feature")
    return per.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= top_n)


def event_importance(df: DataFrame, flag: str, time: str, coefficients: dict[str, float], top_n: int = 10) -> DataFrame:
    """What drove each event: (event_start, event_end, hours, feature, contribution,
    direction, position). An event is a run of flagged hours; a feature's contribution is the
    mean over the event of coefficient x (value - mean of all rows), the largest by size first.
    One row per hour is ordered, so the calendar bounds the window."""
    df = cut(df.select(time, flag, *coefficients))
    means = df.agg(F.struct(*[F.avg(c).alias(c) for c in coefficients])).scalar()
    hour = F.floor(F.unix_timestamp(F.col(time).cast("timestamp")) / 3600)
    flagged = df.filter(F.col(flag) == 1).withColumn("_run", hour - F.row_number().over(Window.orderBy(time)))
    span = flagged.groupBy("_run").agg(F.min(time).alias("event_start"), F.max(time).alias("event_end"), F.count(F.lit(1)).alias("hours"))
    long = all_attributions(flagged.withColumn("_m", means), ["_run"], coefficients)
    folded = long.groupBy("_run", "feature").agg(F.avg("attribution").alias("contribution"))
    ranked = folded.withColumn("position", F.row_number().over(Window.partitionBy("_run").orderBy(F.abs("contribution").desc(), "feature")))
    side = F.when(F.col("contribution") < 0, "down").otherwise("up")
    return ranked.filter(F.col("position") <= top_n).join(span, "_run").select(
        "event_start", "event_end", "hours", "feature", "contribution", side.alias("direction"), "position")


def stack(parts: dict[str, DataFrame], name: str) -> DataFrame:
    return union_all([df.withColumn(name, F.lit(k)) for k, df in parts.items()])
