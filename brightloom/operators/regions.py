"""Regional summaries and tests of group differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions.stats import chi2_test_p, f_test_p
from brightloom.operators.ordering import quantiles
from brightloom.operators.ranking import join_ranks


def assign_region(df: DataFrame, entity: str, mapping: DataFrame) -> DataFrame:
    """``mapping`` has (entity, region). An entity without a region is an error when read."""
    known = df.join(mapping, entity, "left")
    return known.withColumn("region", F.coalesce(
        "region", F.raise_error(F.concat(F.lit("no region for "), F.col(entity))).cast("string")))


def summary(df: DataFrame, region: str, value: str, order: Sequence[str]) -> DataFrame:
    """Count, mean, median, variance and deviation per region, in a fixed order."""
    med = quantiles(df, value, {"median": 0.5}, [region]).drop("n")
    per = df.groupBy(region).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"),
        F.var_samp(value).alias("variance"), F.stddev_samp(value).alias("std"))
    pos = F.array_position(F.array(*[F.lit(r) for r in order]), F.col(region))
    return per.join(med, region, "left").withColumn("region_order", pos.cast("long")).orderBy("region_order")


def crosstab(df: DataFrame, region: str, tier: str, tiers: Sequence[str]) -> DataFrame:
    return df.groupBy(region).pivot(tier, list(tiers)).count().fillna(0, subset=list(tiers))


def anova(df: DataFrame, group: str, value: str) -> DataFrame:
    """One-way F statistic from the group moments."""
    per = df.filter(F.col(value).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"))
    grand = per.agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("g")).scalar()
    one = per.withColumn("_g", grand).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * (F.col("m") - F.col("_g")) ** 2).alias("between"),
        F.sum(F.col("n") * F.col("v")).alias("within"))
    d1, d2 = F.col("k") - 1, F.col("n") - F.col("k")
    f = (F.col("between") / d1) / (F.col("within") / d2)
    return one.select("k", "n", f.alias("f_statistic")).withColumn(
        "p_value", f_test_p(F.col("f_statistic"), F.col("k") - 1, F.col("n") - F.col("k")))


def kruskal(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rank statistic H with the correction for ties."""
    ranked = join_ranks(df.select(group, value).dropna("any"), value, descending=False)
    per = ranked.groupBy(group).agg(F.count(F.lit(1)).alias("g"), F.sum("rank_avg").alias("r"))
    ties = ranked.groupBy(value).agg(F.count(F.lit(1)).cast("double").alias("t")).agg(
        F.sum(F.col("t") ** 3 - F.col("t"))).scalar()
    one = per.agg(F.count(F.lit(1)).alias("k"), F.sum("g").alias("n"), F.sum(F.col("r") ** 2 / F.col("g")).alias("s"))
    n = F.col("n").cast("double")
    h = (12 / (n * (n + 1)) * F.col("s") - 3 * (n + 1)) / (1 - ties / (n ** 3 - n))
    return one.select("k", "n", h.alias("h_statistic")).withColumn(
        "p_value", chi2_test_p(F.col("h_statistic"), F.col("k") - 1))


def describe(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, deviation, quartiles, extremes and bias-adjusted skewness."""
    q = quantiles(df, value, {"p25": 0.25, "p50": 0.5, "p75": 0.75}).select(
        F.struct("p25", "p50", "p75")).scalar()
    n = F.col("n").cast("double")
    return (
        df.agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
               F.min(value).alias("min_value"), F.max(value).alias("max_value"), F.skewness(value).alias("_g"))
        .withColumn("skewness", F.col("_g") * F.sqrt(n * (n - 1)) / (n - 2)).drop("_g")
        .withColumn("_q", q).select("*", "_q.*").drop("_q")
    )
