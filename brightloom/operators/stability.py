"""How scores, ranks and tiers move between variants of an index."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions.stats import correlation_p
from brightloom.operators import index
from brightloom.operators.quality import union_all
from brightloom.operators.ranking import join_ranks
from brightloom.session import cut


def compare(base: DataFrame, variant: DataFrame, entity: str, score: str, top_n: int, keys: Sequence[str] = ()) -> DataFrame:
    """Rank and score movement per scenario; entities without a score on either side are
    left out. ``variant`` carries the scenario columns ``keys``."""
    both = base.select(entity, F.col(score).alias("a")).join(
        variant.select(*keys, entity, F.col(score).alias("b")), entity).dropna("any", subset=["a", "b"])
    ra = join_ranks(both, "a", keys).withColumnsRenamed({"rank_min": "ra", "rank_avg": "sa"}).drop("n")
    rb = join_ranks(ra, "b", keys).withColumnsRenamed({"rank_min": "rb", "rank_avg": "sb"}).drop("n")
    shift = F.abs(F.col("rb") - F.col("ra"))
    both_top = (F.col("ra") <= top_n) & (F.col("rb") <= top_n)
    return rb.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_compared"), F.corr("sa", "sb").alias("rank_spearman_r"),
        F.var_samp("a").alias("score_variance_base"), F.var_samp("b").alias("score_variance_variant"),
        F.avg(F.abs(F.col("b") - F.col("a"))).alias("score_mean_abs_diff"),
        F.count_if(both_top).alias("top_overlap"), (F.count_if(both_top) / top_n).alias("top_overlap_fraction"),
        F.min_by(entity, F.struct(-shift, F.col(entity))).alias("largest_shift_entity"),
        F.max(shift).cast("long").alias("largest_shift"),
    )


def top_overlap(base: DataFrame, variant: DataFrame, entity: str, score: str, top_n: int) -> DataFrame:
    """Entities in the top of both rankings."""
    def top(df):
        return join_ranks(df.select(entity, score), score).filter(F.col("rank_min") <= top_n).select(entity)
    return top(base).intersect(top(variant))


def weight_grid(df: DataFrame, entity: str, shifts: Sequence[float], top_n: int = 4, base_share: float = 0.5) -> DataFrame:
    """Stability for shifted weights, all scenarios in one job."""
    dims = cut(index.dimension_scores(df, index.IndexSpec()).select(entity, index.SOCIO, index.EDUCATION))
    base = dims.withColumn("npi", index.weighted_score({index.SOCIO: base_share, index.EDUCATION: 1 - base_share}))
    grid = F.explode(F.array(*[
        F.struct(F.lit(round(s, 6)).alias("shift"), F.lit(min(max(base_share + s, 0.0), 1.0)).alias("share")) for s in shifts
    ])).alias("g")
    share = F.col("g.share")
    num = F.coalesce(F.col(index.SOCIO) * share, F.lit(0.0)) + F.coalesce(F.col(index.EDUCATION) * (1 - share), F.lit(0.0))
    den = F.when(F.col(index.SOCIO).isNotNull(), share).otherwise(0.0) + F.when(
        F.col(index.EDUCATION).isNotNull(), 1 - share).otherwise(0.0)
    variants = dims.select("*", grid).select(
        F.col("g.shift").alias("shift"), entity, (num / F.nullif(den, F.lit(0.0))).alias("npi"))
    return compare(base, variants, entity, "npi", top_n, ["shift"])


def leave_one_indicator_out(df: DataFrame, entity: str, top_n: int = 4) -> DataFrame:
    """Stability of the component form without each indicator, and without education."""
    frozen = cut(df)
    base = cut(index.score(frozen, entity, index.PCA_SPEC))
    scaled = cut(index.min_max(index.align(frozen), index.SOCIO_COLUMNS))
    full = index.fit_component(scaled, index.SOCIO_COLUMNS)["explained"]
    parts = []
    for dropped in index.SOCIO_COLUMNS:
        rest = tuple(c for c in index.SOCIO_COLUMNS if c != dropped)
        variant = index.score(frozen, entity, index.IndexSpec(indicator=None, columns=rest))
        without = index.fit_component(scaled, rest)["explained"]
        parts.append(compare(base, variant, entity, "npi", top_n).withColumns({
            "dropped": F.lit(dropped), "explained_with": F.lit(full), "explained_without": F.lit(without)}))
    no_edu = index.score(frozen, entity, index.IndexSpec(
        indicator=None, columns=tuple(index.SOCIO_COLUMNS), with_education=False))
    parts.append(compare(base, no_edu, entity, "npi", top_n).withColumns({
        "dropped": F.lit(index.EDUCATION_COLUMN), "explained_with": F.lit(None).cast("double"),
        "explained_without": F.lit(None).cast("double")}))
    return union_all(parts)


def leave_one_entity_out(scaled: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    """Loadings refitted without each entity, one row per complete entity.

    The moments of all rows are taken once; each row's own part is subtracted, so a row
    needs only its own values and a p x p eigenproblem.
    """
    cols = list(columns)
    complete = cut(scaled.select(entity, *cols).dropna("any"))
    fit = index.fit_component(complete, cols, min_explained=0.0)
    n, mean = fit["n"], np.array([fit["means"][c] for c in cols])
    p = len(cols)
    second = complete.agg(*[
        F.sum((F.col(cols[i]) - float(mean[i])) * (F.col(cols[j]) - float(mean[j]))).alias(f"s{i}_{j}")
        for i in range(p) for j in range(i, p)
    ]).first()
    scatter = np.array([[second[f"s{min(i, j)}_{max(i, j)}"] for j in range(p)] for i in range(p)])
    full = np.array([fit["loadings"][c] for c in cols])
    names = [f"loading_{c}" for c in cols]
    schema = ", ".join(["variance_explained double", "loading_shift_l2 double", *[f"{c} double" for c in names]])

    @F.pandas_udf(schema)
    def refit(*values: pd.Series) -> pd.DataFrame:
        d = np.column_stack([v.to_numpy(float) for v in values]) - mean
        # taking x out of n rows lowers the scatter by n/(n-1) dd'
        rest = scatter[None] - n / (n - 1) * d[:, :, None] * d[:, None, :]
        vals, vecs = np.linalg.eigh(rest)
        top = vecs[:, :, -1]
        top = np.where(top.sum(axis=1, keepdims=True) < 0, -top, top)
        out = pd.DataFrame(top, columns=names)
        out.insert(0, "loading_shift_l2", np.linalg.norm(top - full, axis=1))
        out.insert(0, "variance_explained", vals[:, -1] / vals.sum(axis=1))
        return out

    return complete.select(F.col(entity).alias("excluded"), refit(*cols).alias("r")).select("excluded", "r.*")


def loo_summary(detail: DataFrame) -> DataFrame:
    return detail.agg(
        F.count(F.lit(1)).alias("n"), F.avg("loading_shift_l2").alias("shift_mean"),
        F.max("loading_shift_l2").alias("shift_max"), F.stddev_samp("loading_shift_l2").alias("shift_std"),
        F.max_by("excluded", F.struct("loading_shift_l2", "excluded")).alias("most_influential"))


def tier_changes(base: DataFrame, variant: DataFrame, entity: str, tier: str) -> DataFrame:
    """Entities with a tier on both sides: how many moved, and which."""
    both = base.select(entity, F.col(tier).alias("tier_base")).join(
        variant.select(entity, F.col(tier).alias("tier_variant")), entity).dropna("any")
    return both.withColumn("changed", F.col("tier_base") != F.col("tier_variant"))


def tier_stability(changes: DataFrame) -> DataFrame:
    n, moved = F.count(F.lit(1)), F.count_if("changed")
    return changes.agg(n.alias("n_compared"), moved.alias("n_changed"), (1 - moved / F.nullif(n, F.lit(0))).alias("stable_fraction"))


def outcome_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson and Spearman r with two-sided p over rows with both values."""
    valid = df.select(x, y).dropna("any")
    rx = join_ranks(valid, x).withColumnRenamed("rank_avg", "rx").drop("n", "rank_min")
    ry = join_ranks(rx, y).withColumnRenamed("rank_avg", "ry").drop("n", "rank_min")
    r = ry.agg(F.count(F.lit(1)).alias("n"), F.corr(x, y).alias("pearson_r"), F.corr("rx", "ry").alias("spearman_r"))
    return r.withColumns({
        "pearson_p": correlation_p(F.col("pearson_r"), F.col("n")),
        "spearman_p": correlation_p(F.col("spearman_r"), F.col("n"))})


def residual_outliers(df: DataFrame, entity: str, x: str, y: str, limit: float = 1.5) -> DataFrame:
    """Rows far from the fitted line, in sample standard deviations of the residual."""
    valid = cut(df.select(entity, x, y).dropna("any"))
    line = valid.agg(F.struct(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a"))).scalar()
    res = valid.withColumn("_l", line).withColumn(
        "residual", F.col(y) - (F.col("_l.a") + F.col("_l.b") * F.col(x)))
    spread = res.agg(F.stddev_samp("residual")).scalar()
    return res.drop("_l").withColumn("residual_z", F.col("residual") / spread).filter(F.abs("residual_z") > limit)
