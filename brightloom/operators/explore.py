"""Exploratory summaries of labelled series."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def heat_table(df: DataFrame, row: str, column: str, columns: Sequence[int], value: str) -> DataFrame:
    """Mean of ``value`` with one column per value of ``column``."""
    return df.groupBy(row).pivot(column, list(columns)).agg(F.avg(value))


def entity_profile(df: DataFrame, entity: str, flag: str, statics: DataFrame) -> DataFrame:
    """Rate in percent and total flagged rows per entity, with its attributes joined."""
    per = df.groupBy(entity).agg(
        (F.avg(flag) * 100).alias("rate_pct"), F.sum(flag).alias("total_flagged"))
    return per.join(statics, entity).orderBy("rate_pct", entity)


def imbalance(df: DataFrame, flag: str, keys: Sequence[str] = ()) -> DataFrame:
    hits, rows = F.sum(flag), F.count(flag)
    return df.groupBy(*keys).agg(
        rows.alias("total_rows"), hits.alias("flagged_rows"),
        (hits / rows * 100).alias("flagged_pct"),
        ((rows - hits) / F.greatest(hits, F.lit(1))).alias("imbalance_ratio"),
    )


def _pearson(a: str, b: str) -> Column:
    """r over rows that have both; NaN where one of the two is constant, null without rows.
    ``F.corr`` divides by zero for a constant, which is an error."""
    both = F.col(a).isNotNull() & F.col(b).isNotNull()
    x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
    r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    return F.when(F.count(x) > 0, F.coalesce(r, F.lit(math.nan)))


def correlations(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Pearson r of column pairs, all in one pass."""
    one = df.agg(*[_pearson(a, b).alias(f"{a}|{b}") for a, b in pairs])
    rows = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"`{a}|{b}`").alias("r"))
        for a, b in pairs
    ]
    return one.select(F.inline(F.array(*rows)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r of all pairs of columns without nulls, as (left, right, r); null where a
    column is constant. The cross-products are one pass; only the p x p matrix returns."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="v").transform(df).select("v")
    matrix = Correlation.corr(vectors, "v").first()[0].toArray()
    rows = [
        (columns[i], columns[j], None if math.isnan(matrix[i, j]) else float(matrix[i, j]))
        for i, j in combinations(range(len(columns)), 2)
    ]
    return df.sparkSession.createDataFrame(rows, "left string, right string, r double")


def redundant_pairs(matrix: DataFrame, target: str, limit: float = 0.85) -> DataFrame:
    return matrix.filter((F.abs("r") > limit) & (F.col("left") != target) & (F.col("right") != target))


def top_with_target(matrix: DataFrame, target: str, n: int = 5) -> DataFrame:
    other = F.when(F.col("left") == target, F.col("right")).otherwise(F.col("left"))
    return (
        matrix.filter((F.col("left") == target) | (F.col("right") == target))
        .select(other.alias("feature"), F.abs("r").alias("abs_r"))
        .orderBy(F.desc_nulls_last("abs_r"), "feature").limit(n)
    )


def lag_window_scan(
    df: DataFrame, rain: str, level: str, flag: str, windows: Sequence[int], steps: Sequence[int],
    keys: Sequence[str] = (), time: str = "hour",
) -> DataFrame:
    """Correlation of rolling sums and lags with a flag; the highest of each kind are marked
    (as in SQL, NaN is above all else and equals itself, and null has no mark)."""
    w = Window.partitionBy(*keys).orderBy(time)
    sums = {f"sum_{n}h": F.sum(rain).over(w.rowsBetween(-(n - 1), 0)) for n in windows}
    lagged = {f"lag_{n}h": F.lag(level, n).over(w) for n in steps}
    wide = df.withColumns({**sums, **lagged})
    kind = F.when(F.col("left").startswith("sum_"), "window").otherwise("lag")
    scan = correlations(wide, [(c, flag) for c in (*sums, *lagged)]).select(
        kind.alias("kind"), F.col("left").alias("feature"), "r")
    best = scan.groupBy("kind").agg(F.max("r").alias("best"))
    return scan.join(best, "kind").select("kind", "feature", "r", (F.col("r") == F.col("best")).alias("is_best"))
