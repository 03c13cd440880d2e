"""Composite index of nations: scores, ranks, tiers, stability, regions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.functions.common import rounded
from brightloom.operators import index, names, ranking, regions, stability
from brightloom.operators.ordering import quantiles
from brightloom.plans.registry import Tables, query
from brightloom.session import cut

# Nations as entities. Participation is unknown where fewer than four suppliers report.
INDEX = """
cust AS (SELECT n_name AS entity, r_name AS region, count(*) AS population,
   CAST(sum(CASE WHEN c_acctbal < 2000 THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*) AS poverty_rate,
   CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS ipm,
   CAST(sum(CAST(greatest(c_acctbal, 0) AS DECIMAL(18,2))) AS DOUBLE) * 12 / count(*) AS expenditure_per_capita
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL),
sup AS (SELECT n_name AS entity, CASE WHEN count(*) >= 4 THEN
   CAST(sum(CASE WHEN s_acctbal > 3000 THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*) END AS participation_rate
  FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
ret AS (SELECT n_name AS entity, CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) * 100 / count(*) AS stunting_rate
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
merged AS (SELECT cust.*, participation_rate, stunting_rate,
   CASE WHEN stunting_rate < 33 THEN 'Medium' ELSE 'High' END AS stunting_category
  FROM cust LEFT JOIN sup USING (entity) LEFT JOIN ret USING (entity)),
ali AS (SELECT entity, poverty_rate AS p, -ipm AS i, -expenditure_per_capita AS x, -participation_rate AS e FROM merged),
scaled AS (SELECT entity, (p - min(p) OVER ()) / (max(p) OVER () - min(p) OVER ()) AS p,
   (i - min(i) OVER ()) / (max(i) OVER () - min(i) OVER ()) AS i,
   (x - min(x) OVER ()) / (max(x) OVER () - min(x) OVER ()) AS x,
   (e - min(e) OVER ()) / (max(e) OVER () - min(e) OVER ()) AS e FROM ali),
scored AS (SELECT entity, x AS soc, e AS edu, (coalesce(x * 0.5, 0) + coalesce(e * 0.5, 0)) /
   (CASE WHEN x IS NULL THEN 0 ELSE 0.5 END + CASE WHEN e IS NULL THEN 0 ELSE 0.5 END) AS npi,
   CASE WHEN e IS NULL THEN 'partial: education_access unavailable' ELSE 'full' END AS data_completeness FROM scaled),
ranked AS (SELECT *, rank() OVER (ORDER BY npi DESC) AS rank,
   (rank() OVER (ORDER BY npi) + (count(*) OVER (PARTITION BY npi) - 1) / 2.0) * 100.0 / count(*) OVER () AS percentile FROM scored)
"""

# First principal component of three columns in closed form.
PCA_SQL = """
mu AS (SELECT avg(p) AS mp, avg(i) AS mi, avg(x) AS mx FROM scaled),
cov AS (SELECT covar_pop(p, p) AS a, covar_pop(i, i) AS b, covar_pop(x, x) AS c, covar_pop(p, i) AS d,
   covar_pop(i, x) AS ee, covar_pop(p, x) AS f FROM scaled),
e1 AS (SELECT *, (a + b + c) / 3 AS q FROM cov),
e2 AS (SELECT *, sqrt((power(a - q, 2) + power(b - q, 2) + power(c - q, 2) + 2 * (d * d + ee * ee + f * f)) / 6) AS pp FROM e1),
e3 AS (SELECT *, ((a - q) * ((b - q) * (c - q) - ee * ee) - d * (d * (c - q) - ee * f) + f * (d * ee - (b - q) * f)) / (2 * power(pp, 3)) AS r FROM e2),
e4 AS (SELECT *, q + 2 * pp * cos(acos(least(1, greatest(-1, r))) / 3) AS lam FROM e3),
e5 AS (SELECT *, d * ee - f * (b - lam) AS v1, f * d - (a - lam) * ee AS v2, (a - lam) * (b - lam) - d * d AS v3 FROM e4),
pc AS (SELECT lam / (a + b + c) AS explained, sign(v1 + v2 + v3) / sqrt(v1 * v1 + v2 * v2 + v3 * v3) AS s, v1, v2, v3 FROM e5),
proj AS (SELECT entity, ((p - mp) * v1 + (i - mi) * v2 + (x - mx) * v3) * s AS z FROM scaled, mu, pc),
pcs AS (SELECT entity, (z - min(z) OVER ()) / (max(z) OVER () - min(z) OVER ()) AS soc_pca FROM proj),
pcn AS (SELECT entity, soc_pca, (soc_pca * 0.5 + coalesce(edu * 0.5, 0)) / (0.5 + CASE WHEN edu IS NULL THEN 0 ELSE 0.5 END) AS npi_pca FROM pcs JOIN scored USING (entity))
"""

# Least squared deviation of four classes by trying every triple of breaks.
JENKS_SQL = """
dv AS (SELECT npi AS v, count(*) AS w FROM scored GROUP BY 1),
pre AS (SELECT v, row_number() OVER (ORDER BY v) AS i, sum(w) OVER o AS cw, sum(w * (v - 0.5)) OVER o AS cs,
   sum(w * (v - 0.5) * (v - 0.5)) OVER o AS cq FROM dv WINDOW o AS (ORDER BY v)),
tri AS (SELECT x1.v AS b1, x2.v AS b2, x3.v AS b3, z.cq - x1.cs * x1.cs / x1.cw - power(x2.cs - x1.cs, 2) / (x2.cw - x1.cw)
   - power(x3.cs - x2.cs, 2) / (x3.cw - x2.cw) - power(z.cs - x3.cs, 2) / (z.cw - x3.cw) AS cost
  FROM pre x1 JOIN pre x2 ON x2.i > x1.i JOIN pre x3 ON x3.i > x2.i, (SELECT * FROM pre ORDER BY i DESC LIMIT 1) z WHERE x3.i < z.i),
brk AS (SELECT * FROM tri ORDER BY cost LIMIT 1),
qb AS (SELECT quantile_cont(npi, [0.25, 0.5, 0.75]) AS q4, quantile_cont(npi, [0.2, 0.4, 0.6, 0.8]) AS q5 FROM scored),
tiers AS (SELECT ranked.*, CASE WHEN npi <= b1 THEN 'Low' WHEN npi <= b2 THEN 'Medium' WHEN npi <= b3 THEN 'High' ELSE 'Critical' END AS tier_jenks,
   least(abs(npi - b1), abs(npi - b2), abs(npi - b3)) < 0.02 AS tier_boundary_flag,
   CASE WHEN npi <= q4[1] THEN 'Low' WHEN npi <= q4[2] THEN 'Medium' WHEN npi <= q4[3] THEN 'High' ELSE 'Critical' END AS tier_quartile,
   CASE WHEN npi <= q5[1] THEN 'Very Low' WHEN npi <= q5[2] THEN 'Low' WHEN npi <= q5[3] THEN 'Medium' WHEN npi <= q5[4] THEN 'High' ELSE 'Very High' END AS tier_quintile,
   CASE WHEN npi <= 0.25 THEN 'Low' WHEN npi <= 0.5 THEN 'Medium' WHEN npi <= 0.75 THEN 'High' ELSE 'Critical' END AS tier_policy_threshold
  FROM ranked, brk, qb)
"""


def _share(cond) -> F.Column:
    return F.count_if(cond).cast("double") * 100 / F.count(F.lit(1))


def merged(t: Tables) -> DataFrame:
    """One row per nation with its indicators and outcome. Frozen: every later step reads
    this small table several times and the joins behind it should run once."""
    money = F.col("c_acctbal").cast("decimal(18,2)")
    n = F.count(F.lit(1))
    cust = t.customer.groupBy("c_nationkey").agg(
        n.alias("population"), _share(F.col("c_acctbal") < 2000).alias("poverty_rate"),
        (F.sum(money).cast("double") / n).alias("ipm"),
        (F.sum(F.greatest(money, F.lit(0).cast("decimal(18,2)"))).cast("double") * 12 / n).alias("expenditure_per_capita"))
    sup = t.supplier.groupBy("s_nationkey").agg(
        F.when(n >= 4, _share(F.col("s_acctbal") > 3000)).alias("participation_rate"))
    per_order = t.lineitem.groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"), n.alias("lines"))
    ret = (
        per_order.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer.select("c_custkey", F.col("c_nationkey").alias("nk")), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("nk").agg((F.sum("returned").cast("double") * 100 / F.sum("lines")).alias("stunting_rate"))
    )
    joined = (
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .join(cust, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(sup, F.col("n_nationkey") == F.col("s_nationkey"), "left")
        .join(ret, F.col("n_nationkey") == F.col("nk"), "left")
        .select(
            F.col("n_name").alias("entity"), F.col("r_name").alias("region"), "population", "poverty_rate", "ipm",
            "expenditure_per_capita", "participation_rate", "stunting_rate",
            F.when(F.col("stunting_rate") < 33, "Medium").otherwise("High").alias("stunting_category"))
    )
    return cut(joined)


def scored(t: Tables) -> DataFrame:
    return index.score(merged(t), "entity")


def scored_pca(t: Tables) -> DataFrame:
    return index.score(merged(t), "entity", index.PCA_SPEC)


def nine(df: DataFrame) -> DataFrame:
    return rounded(df, 9)


@query("npi_align", f"WITH {INDEX} SELECT entity, round(p, 9) AS poverty_rate, round(i, 9) AS ipm, round(x, 9) AS expenditure_per_capita, round(e, 9) AS participation_rate FROM ali")
def _(t):
    return nine(index.align(merged(t)).select("entity", *index.DIRECTIONS))


@query("npi_minmax", f"WITH {INDEX} SELECT entity, round(p, 9) AS poverty_rate, round(i, 9) AS ipm, round(x, 9) AS expenditure_per_capita, round(e, 9) AS participation_rate FROM scaled")
def _(t):
    return nine(index.min_max(index.align(merged(t)), list(index.DIRECTIONS)).select("entity", *index.DIRECTIONS))


@query("npi_minmax_diag", f"WITH {INDEX} " + " UNION ALL ".join(
    f"SELECT '{c}' AS indicator, round(min({c}), 9) AS min_value, round(max({c}), 9) AS max_value, count({c}) AS n_present, count(*) - count({c}) AS n_missing FROM merged"
    for c in index.DIRECTIONS))
def _(t):
    return nine(index.scale_diagnostics(merged(t), list(index.DIRECTIONS)))


@query("npi_renormalized", f"""WITH {INDEX} SELECT entity, round(npi, 9) AS npi,
  CASE WHEN edu IS NULL THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS weight_socioeconomic_vulnerability,
  CASE WHEN edu IS NULL THEN NULL ELSE 0.5::DOUBLE END AS weight_education_access FROM scored""")
def _(t):
    w = index.IndexSpec().weights
    dims = index.dimension_scores(merged(t), index.IndexSpec())
    return nine(dims.select("entity", index.weighted_score(w).alias("npi"),
                            *[c.alias(n) for n, c in index.effective_weights(w).items()]))


@query("npi_completeness", f"WITH {INDEX} SELECT entity, data_completeness FROM scored")
def _(t):
    return scored(t).select("entity", "data_completeness")


@query("npi_reach", f"WITH {INDEX} SELECT entity, round(population * stunting_rate / 100, 9) AS estimated_children_affected FROM merged")
def _(t):
    return nine(scored(t).select("entity", "estimated_children_affected"))


@query("npi_score", f"WITH {INDEX} SELECT entity, round(soc, 9) AS socioeconomic_vulnerability, round(edu, 9) AS education_access, round(npi, 9) AS npi FROM scored")
def _(t):
    return nine(scored(t).select("entity", index.SOCIO, index.EDUCATION, "npi"))


@query("npi_pca", f"WITH {INDEX}, {PCA_SQL} SELECT entity, round(soc_pca, 6) AS socioeconomic_vulnerability, round(npi_pca, 6) AS npi FROM pcn")
def _(t):
    return rounded(scored_pca(t).select("entity", index.SOCIO, "npi"))


@query("npi_rank_percentile", f"WITH {INDEX} SELECT entity, rank, round(percentile, 9) AS percentile FROM ranked")
def _(t):
    return nine(ranking.rank_and_percentile(scored(t).select("entity", "npi"), "npi").select("entity", "rank", "percentile"))


@query("npi_tier_quartile", f"WITH {INDEX}, {JENKS_SQL} SELECT entity, tier_quartile FROM tiers")
def _(t):
    return ranking.equal_count_tier(cut(scored(t)), "npi", ranking.QUARTILE_LABELS, "tier_quartile").select("entity", "tier_quartile")


@query("npi_tier_quintile", f"WITH {INDEX}, {JENKS_SQL} SELECT entity, tier_quintile FROM tiers")
def _(t):
    return ranking.equal_count_tier(cut(scored(t)), "npi", ranking.QUINTILE_LABELS, "tier_quintile").select("entity", "tier_quintile")


@query("npi_tier_policy", f"WITH {INDEX}, {JENKS_SQL} SELECT entity, tier_policy_threshold FROM tiers")
def _(t):
    return scored(t).select("entity", ranking.policy_tier(F.col("npi")).alias("tier_policy_threshold"))


@query("npi_tier_jenks", f"WITH {INDEX}, {JENKS_SQL} SELECT entity, tier_jenks FROM tiers")
def _(t):
    s = cut(scored(t))
    return s.select("entity", ranking.break_tier(F.col("npi"), ranking.natural_breaks(s, "npi")).alias("tier_jenks"))


@query("npi_boundary_flag", f"WITH {INDEX}, {JENKS_SQL} SELECT entity, tier_boundary_flag FROM tiers")
def _(t):
    s = cut(scored(t))
    return s.select("entity", ranking.near_boundary(F.col("npi"), ranking.natural_breaks(s, "npi")).alias("tier_boundary_flag"))


# The same least cost by the recursion over classes; far too many values to try every triple.
PRICE_BREAKS = """WITH dv AS (SELECT p_retailprice AS v, count(*) AS w FROM part GROUP BY 1), mu AS (SELECT avg(p_retailprice) AS mu FROM part),
pre AS (SELECT v, row_number() OVER (ORDER BY v) AS i, sum(w) OVER o AS cw, sum(w * (v - mu)) OVER o AS cs, sum(w * (v - mu) * (v - mu)) OVER o AS cq FROM dv, mu WINDOW o AS (ORDER BY v)),
c1 AS (SELECT i, cq - cs * cs / cw AS cost FROM pre)""" + "".join(f""",
c{c} AS (SELECT z.i, min(b.cost + z.cq - x.cq - power(z.cs - x.cs, 2) / (z.cw - x.cw)) AS cost, arg_min(x.i, b.cost + z.cq - x.cq - power(z.cs - x.cs, 2) / (z.cw - x.cw)) AS m
  FROM c{c - 1} b JOIN pre x ON x.i = b.i JOIN pre z ON z.i > x.i GROUP BY z.i)""" for c in (2, 3, 4)) + """,
e AS (SELECT c4.m AS i3, c3.m AS i2, c2.m AS i1 FROM c4 JOIN c3 ON c3.i = c4.m JOIN c2 ON c2.i = c3.m WHERE c4.i = (SELECT max(i) FROM pre))
SELECT position, v AS edge FROM (SELECT 0 AS position, min(v) AS v FROM pre UNION ALL SELECT 1, v FROM pre, e WHERE i = i1 UNION ALL SELECT 2, v FROM pre, e WHERE i = i2
  UNION ALL SELECT 3, v FROM pre, e WHERE i = i3 UNION ALL SELECT 4, max(v) FROM pre)"""


@query("part_price_breaks", PRICE_BREAKS)
def _(t):
    edges = ranking.natural_breaks(t.part, "p_retailprice")
    return t.spark.createDataFrame(list(enumerate(edges)), "position int, edge double")


def rankings(t: Tables) -> DataFrame:
    """The final table, best-known tier methods side by side, sorted by rank."""
    base = merged(t)
    s = cut(index.score(base, "entity"))
    breaks = ranking.natural_breaks(s, "npi")
    benchmark = index.score(base, "entity", index.PCA_SPEC).select("entity", F.col("npi").alias("npi_pca_benchmark"))
    out = ranking.rank_and_percentile(s, "npi").withColumns({
        "tier_jenks": ranking.break_tier(F.col("npi"), breaks),
        "tier_boundary_flag": ranking.near_boundary(F.col("npi"), breaks),
        "tier_policy_threshold": ranking.policy_tier(F.col("npi")),
        "methodology": F.lit("single_indicator:expenditure_per_capita"),
    })
    out = ranking.equal_count_tier(out, "npi", ranking.QUARTILE_LABELS, "tier_quartile")
    out = ranking.equal_count_tier(out, "npi", ranking.QUINTILE_LABELS, "tier_quintile")
    return out.join(benchmark, "entity").select(
        "entity", "rank", "percentile", "npi", "tier_jenks", "tier_boundary_flag", "tier_quartile", "tier_quintile",
        "tier_policy_threshold", "npi_pca_benchmark", "methodology", index.SOCIO, index.EDUCATION, "data_completeness",
        "estimated_children_affected", "stunting_rate", "stunting_category",
    ).orderBy("rank", "entity")


RANKINGS_SQL = f"""WITH {INDEX}, {PCA_SQL}, {JENKS_SQL}
SELECT t.entity, rank, round(percentile, 6) AS percentile, round(npi, 6) AS npi, tier_jenks, tier_boundary_flag, tier_quartile, tier_quintile,
  tier_policy_threshold, round(npi_pca, 6) AS npi_pca_benchmark, 'single_indicator:expenditure_per_capita' AS methodology,
  round(soc, 6) AS socioeconomic_vulnerability, round(edu, 6) AS education_access, data_completeness,
  round(population * stunting_rate / 100, 6) AS estimated_children_affected, round(stunting_rate, 6) AS stunting_rate, stunting_category
FROM tiers t JOIN pcn USING (entity) JOIN merged m ON t.entity = m.entity"""


@query("npi_rankings", RANKINGS_SQL)
def _(t):
    return rounded(rankings(t))


@query("npi_explorer", f"""WITH {INDEX}, {JENKS_SQL} SELECT entity, rank, tier_jenks FROM tiers
WHERE tier_jenks IN ('Critical', 'High') AND lower(entity) LIKE '%nation_1%'""")
def _(t):
    return rankings(t).filter(
        F.col("tier_jenks").isin("Critical", "High") & F.lower("entity").contains("nation_1")
    ).select("entity", "rank", "tier_jenks").orderBy("rank")


@query("npi_tier_counts", f"""WITH {INDEX}, {JENKS_SQL} SELECT tier_jenks AS tier, count(*) AS n,
  (SELECT count(*) FROM tiers) AS entities, (SELECT round(avg(npi), 9) FROM tiers) AS mean_npi FROM tiers GROUP BY 1""")
def _(t):
    s = cut(scored(t))
    tiers = s.withColumn("tier", ranking.break_tier(F.col("npi"), ranking.natural_breaks(s, "npi")))
    head = s.agg(F.struct(F.count(F.lit(1)).alias("entities"), F.avg("npi").alias("mean_npi"))).scalar()
    return nine(tiers.groupBy("tier").agg(F.count(F.lit(1)).alias("n")).withColumn("_h", head)
                .select("tier", "n", "_h.entities", "_h.mean_npi"))


@query("npi_vs_median", f"WITH {INDEX} " + " UNION ALL ".join(
    f"SELECT entity, '{c}' AS indicator, round({c}, 6) AS value, round({c} - (SELECT quantile_cont({c}, 0.5) FROM merged), 6) AS vs_median FROM merged"
    for c in ["poverty_rate", "ipm", "participation_rate", "expenditure_per_capita", "stunting_rate"]))
def _(t):
    cols = ["poverty_rate", "ipm", "participation_rate", "expenditure_per_capita", "stunting_rate"]
    long = cut(merged(t).unpivot("entity", cols, "indicator", "value"))
    med = quantiles(long, "value", {"median": 0.5}, ["indicator"]).drop("n")
    return rounded(long.join(med, "indicator", "left").select(
        "entity", "indicator", "value", (F.col("value") - F.col("median")).alias("vs_median")))


# Stability against the component form.
def _variants(t: Tables) -> tuple[DataFrame, DataFrame]:
    base = merged(t)
    return cut(index.score(base, "entity")), cut(index.score(base, "entity", index.PCA_SPEC))


@query("npi_stability", f"""WITH {INDEX}, {PCA_SQL},
b AS (SELECT entity, npi AS a, npi_pca AS b, rank() OVER (ORDER BY npi DESC) AS ra, rank() OVER (ORDER BY npi_pca DESC) AS rb FROM scored JOIN pcn USING (entity))
SELECT count(*) AS n_compared, round(corr(ra, rb), 6) AS rank_spearman_r, round(var_samp(a), 6) AS score_variance_base, round(var_samp(b), 6) AS score_variance_variant,
  round(avg(abs(b - a)), 6) AS score_mean_abs_diff, count(*) FILTER (WHERE ra <= 4 AND rb <= 4) AS top_overlap,
  round(count(*) FILTER (WHERE ra <= 4 AND rb <= 4) / 4, 6) AS top_overlap_fraction, arg_min(entity, (-abs(rb - ra), entity)) AS largest_shift_entity,
  max(abs(rb - ra)) AS largest_shift FROM b""")
def _(t):
    return rounded(stability.compare(*_variants(t), "entity", "npi", 4))


@query("set_topn_overlap", f"""WITH {INDEX}, {PCA_SQL} SELECT entity FROM (
  SELECT entity, rank() OVER (ORDER BY npi DESC) AS ra, rank() OVER (ORDER BY npi_pca DESC) AS rb FROM scored JOIN pcn USING (entity)) WHERE ra <= 10 AND rb <= 10""")
def _(t):
    return stability.top_overlap(*_variants(t), "entity", "npi", 10)


SHIFTS = [-0.2, -0.1, 0.0, 0.1, 0.2]


@query("npi_weight_grid", f"""WITH {INDEX},
g AS (SELECT unnest([-0.2, -0.1, 0.0, 0.1, 0.2])::DOUBLE AS shift),
v AS (SELECT shift, entity, npi AS a, (soc * (0.5 + shift) + coalesce(edu * (1 - (0.5 + shift)), 0)) / ((0.5 + shift) + CASE WHEN edu IS NULL THEN 0 ELSE 1 - (0.5 + shift) END) AS b FROM scored, g),
r AS (SELECT *, rank() OVER (PARTITION BY shift ORDER BY round(a, 12) DESC) AS ra, rank() OVER (PARTITION BY shift ORDER BY round(b, 12) DESC) AS rb FROM v)
SELECT shift, count(*) AS n_compared, round(corr(ra, rb), 6) AS rank_spearman_r, round(var_samp(b), 6) AS score_variance_variant, round(avg(abs(b - a)), 6) AS score_mean_abs_diff,
  count(*) FILTER (WHERE ra <= 4 AND rb <= 4) AS top_overlap, max(abs(rb - ra)) AS largest_shift FROM r GROUP BY shift""")
def _(t):
    return rounded(stability.weight_grid(merged(t), "entity", SHIFTS).select(
        "shift", "n_compared", "rank_spearman_r", "score_variance_variant", "score_mean_abs_diff", "top_overlap", "largest_shift"))


@query("npi_loio")
def _(t):
    return rounded(stability.leave_one_indicator_out(merged(t), "entity"))


@query("npi_loo_pca")
def _(t):
    scaled = index.min_max(index.align(merged(t)), index.SOCIO_COLUMNS)
    return rounded(stability.leave_one_entity_out(scaled, "entity", index.SOCIO_COLUMNS))


@query("npi_loo_summary")
def _(t):
    scaled = index.min_max(index.align(merged(t)), index.SOCIO_COLUMNS)
    return rounded(stability.loo_summary(stability.leave_one_entity_out(scaled, "entity", index.SOCIO_COLUMNS)))


@query("npi_tier_stability", f"""WITH {INDEX}, {PCA_SQL}, q AS (SELECT quantile_cont(npi, [0.25, 0.5, 0.75]) AS q, quantile_cont(npi_pca, [0.25, 0.5, 0.75]) AS k FROM scored JOIN pcn USING (entity)),
c AS (SELECT (CASE WHEN npi <= q[1] THEN 1 WHEN npi <= q[2] THEN 2 WHEN npi <= q[3] THEN 3 ELSE 4 END) <> (CASE WHEN npi_pca <= k[1] THEN 1 WHEN npi_pca <= k[2] THEN 2 WHEN npi_pca <= k[3] THEN 3 ELSE 4 END) AS changed FROM scored JOIN pcn USING (entity), q)
SELECT count(*) AS n_compared, count(*) FILTER (WHERE changed) AS n_changed, round(1 - count(*) FILTER (WHERE changed) / count(*), 6) AS stable_fraction FROM c""")
def _(t):
    tiers = [ranking.equal_count_tier(s, "npi", ranking.QUARTILE_LABELS, "tier") for s in _variants(t)]
    return rounded(stability.tier_stability(stability.tier_changes(*tiers, "entity", "tier")))


@query("npi_tier_stability_fixed", f"""WITH {INDEX}, {PCA_SQL}, q AS (SELECT quantile_cont(npi, [0.25, 0.5, 0.75]) AS q FROM scored),
c AS (SELECT (CASE WHEN npi <= q[1] THEN 1 WHEN npi <= q[2] THEN 2 WHEN npi <= q[3] THEN 3 ELSE 4 END) <> (CASE WHEN npi_pca <= q[1] THEN 1 WHEN npi_pca <= q[2] THEN 2 WHEN npi_pca <= q[3] THEN 3 ELSE 4 END) AS changed FROM scored JOIN pcn USING (entity), q)
SELECT count(*) AS n_compared, count(*) FILTER (WHERE changed) AS n_changed, round(1 - count(*) FILTER (WHERE changed) / count(*), 6) AS stable_fraction FROM c""")
def _(t):
    """Both forms in the tiers of the first one's edges."""
    base, variant = _variants(t)
    tiers = [ranking.tier_on_edges_of(s, base, "npi", ranking.QUARTILE_LABELS, "tier") for s in (base, variant)]
    return rounded(stability.tier_stability(stability.tier_changes(*tiers, "entity", "tier")))


@query("npi_outcome_corr", f"""WITH {INDEX}, j AS (SELECT npi, stunting_rate AS y, data_completeness, rank() OVER (ORDER BY npi) AS rx, rank() OVER (ORDER BY stunting_rate) AS ry FROM scored JOIN merged USING (entity)),
f AS (SELECT npi, y, rank() OVER (ORDER BY npi) AS rx, rank() OVER (ORDER BY y) AS ry FROM j WHERE data_completeness = 'full')
SELECT 'all' AS entities, count(*) AS n, round(corr(npi, y), 6) AS pearson_r, round(corr(rx, ry), 6) AS spearman_r FROM j
UNION ALL SELECT 'full', count(*), round(corr(npi, y), 6), round(corr(rx, ry), 6) FROM f""")
def _(t):
    s = cut(scored(t))
    def one(df, name):
        return stability.outcome_correlation(df, "npi", "stunting_rate").select(
            F.lit(name).alias("entities"), "n", "pearson_r", "spearman_r")
    return rounded(one(s, "all").unionByName(one(s.filter("data_completeness = 'full'"), "full")))


@query("npi_outcome_p_values")
def _(t):
    return rounded(stability.outcome_correlation(scored(t), "npi", "stunting_rate"))


@query("npi_residual_outliers", f"""WITH {INDEX}, j AS (SELECT entity, npi, stunting_rate FROM scored JOIN merged USING (entity)),
l AS (SELECT regr_slope(stunting_rate, npi) AS b, regr_intercept(stunting_rate, npi) AS a FROM j),
r AS (SELECT entity, stunting_rate - (a + b * npi) AS residual FROM j, l)
SELECT entity, round(residual, 6) AS residual, round(z, 6) AS residual_z FROM (SELECT *, residual / stddev_samp(residual) OVER () AS z FROM r) WHERE abs(z) > 1.5""")
def _(t):
    return rounded(stability.residual_outliers(scored(t), "entity", "npi", "stunting_rate").select("entity", "residual", "residual_z"))


@query("npi_describe", f"""WITH {INDEX} SELECT count(npi) AS n, round(avg(npi), 6) AS mean, round(stddev_samp(npi), 6) AS std, round(min(npi), 6) AS min_value,
  round(max(npi), 6) AS max_value, round(skewness(npi), 6) AS skewness, round(quantile_cont(npi, 0.25), 6) AS p25, round(quantile_cont(npi, 0.5), 6) AS p50, round(quantile_cont(npi, 0.75), 6) AS p75 FROM scored""")
def _(t):
    return rounded(regions.describe(cut(scored(t)), "npi"))


REGION_ORDER = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def with_region(t: Tables) -> DataFrame:
    mapping = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("entity"), F.col("r_name").alias("region"))
    return regions.assign_region(scored(t), "entity", mapping)


@query("region_assign", "SELECT n_name AS entity, r_name AS region FROM nation JOIN region ON n_regionkey = r_regionkey")
def _(t):
    return with_region(t).select("entity", "region")


@query("region_summary", f"""WITH {INDEX} SELECT region, count(npi) AS n, round(avg(npi), 6) AS mean, round(var_samp(npi), 6) AS variance, round(stddev_samp(npi), 6) AS std,
  round(quantile_cont(npi, 0.5), 6) AS median, list_position(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST'], region)::BIGINT AS region_order
FROM scored JOIN merged USING (entity) GROUP BY region""")
def _(t):
    return rounded(regions.summary(cut(with_region(t)), "region", "npi", REGION_ORDER))


@query("region_tier_crosstab", f"""WITH {INDEX}, {JENKS_SQL} SELECT region, """ + ", ".join(
    f"count(*) FILTER (WHERE tier_jenks = '{x}') AS \"{x}\"" for x in ranking.QUARTILE_LABELS) + " FROM tiers JOIN merged USING (entity) GROUP BY region")
def _(t):
    s = cut(with_region(t))
    tiers = s.withColumn("tier", ranking.break_tier(F.col("npi"), ranking.natural_breaks(s, "npi")))
    return regions.crosstab(tiers, "region", "tier", ranking.QUARTILE_LABELS)


@query("region_anova", f"""WITH {INDEX}, g AS (SELECT region, count(*) AS n, avg(npi) AS m, var_pop(npi) AS v FROM scored JOIN merged USING (entity) GROUP BY 1),
a AS (SELECT avg(npi) AS gm FROM scored)
SELECT count(*) AS k, sum(n)::BIGINT AS n, round((sum(n * power(m - gm, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 6) AS f_statistic FROM g, a""")
def _(t):
    return rounded(regions.anova(with_region(t), "region", "npi").drop("p_value"))


KRUSKAL = f"""WITH {INDEX}, r AS (SELECT region, rank() OVER (ORDER BY npi) + (count(*) OVER (PARTITION BY npi) - 1) / 2.0 AS rk, npi FROM scored JOIN merged USING (entity)),
g AS (SELECT region, count(*) AS n, sum(rk) AS s FROM r GROUP BY 1), t AS (SELECT sum(c * c * c - c) AS tie FROM (SELECT count(*)::DOUBLE AS c FROM r GROUP BY npi)),
kw AS (SELECT count(*) AS k, sum(n)::BIGINT AS n, (12 / (sum(n) * (sum(n) + 1)) * sum(s * s / n) - 3 * (sum(n) + 1)) / (1 - any_value(tie) / (power(sum(n), 3) - sum(n))) AS h FROM g, t)"""


@query("region_kruskal", f"{KRUSKAL} SELECT k, n, round(h, 6) AS h_statistic FROM kw")
def _(t):
    return rounded(regions.kruskal(with_region(t), "region", "npi").drop("p_value"))


# The tail of chi-square with four degrees of freedom has a closed form; there are five regions.
@query("region_kruskal_p", f"{KRUSKAL} SELECT n, round((1 + h / 2) * exp(-h / 2), 6) AS p_value FROM kw WHERE k = 5")
def _(t):
    return rounded(regions.kruskal(with_region(t), "region", "npi").filter("k = 5").select("n", "p_value"))


@query("region_p_values")
def _(t):
    s = cut(with_region(t))
    f = regions.anova(s, "region", "npi").select(F.lit("anova").alias("test"), F.col("f_statistic").alias("statistic"), "p_value")
    h = regions.kruskal(s, "region", "npi").select(F.lit("kruskal").alias("test"), F.col("h_statistic").alias("statistic"), "p_value")
    return rounded(f.unionByName(h))


# Names, coverage and newest values.
def nation_years(t: Tables, value) -> DataFrame:
    """One value per nation and year over all orders."""
    return (
        t.orders
        .join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation.select("n_nationkey", F.col("n_name").alias("entity")), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("entity", F.year("o_orderdate").alias("year")).agg(value)
    )


def _ny(value: str) -> str:
    return f"""(SELECT n_name AS entity, CAST(year(o_orderdate) AS INTEGER) AS year, {value} FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)"""


def _urgent():
    """Cheap urgent orders, null where a nation and year has none."""
    cheap = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") < 5000)
    return F.nullif(F.count_if(cheap), F.lit(0)).alias("n")


URGENT_SQL = "nullif(count(*) FILTER (WHERE o_orderpriority = '1-URGENT' AND o_totalprice < 5000), 0) AS n"


def _revenue():
    return F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(20,2)").alias("revenue")


REVENUE_SQL = "CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(20,2)) AS revenue"


@query("npi_latest_value", f"""SELECT entity, revenue, year AS revenue_year FROM {_ny(REVENUE_SQL)}
QUALIFY row_number() OVER (PARTITION BY entity ORDER BY year DESC) = 1""", money=["revenue"])
def _(t):
    return names.latest_value(nation_years(t, _revenue()), "entity", "year", ["revenue"], "revenue")


@query("npi_merge_latest", f"""WITH a AS (SELECT entity, revenue AS big, year AS big_year FROM {_ny(REVENUE_SQL)} QUALIFY row_number() OVER (PARTITION BY entity ORDER BY year DESC) = 1),
b AS (SELECT entity, n AS urgent, year AS urgent_year FROM {_ny(URGENT_SQL)} WHERE n IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity ORDER BY year DESC) = 1)
SELECT n_name AS entity, big, big_year, urgent, urgent_year FROM nation LEFT JOIN a ON a.entity = n_name LEFT JOIN b ON b.entity = n_name""", money=["big"])
def _(t):
    return names.merge_latest(t.nation.select(F.col("n_name").alias("entity")), "entity", {
        "big": (nation_years(t, _revenue()), "year", ["revenue"]),
        "urgent": (nation_years(t, _urgent()).filter("n is not null"), "year", ["n"]),
    })


@query("npi_coverage", f"""WITH d AS (SELECT DISTINCT entity, year FROM {_ny(URGENT_SQL)} WHERE n IS NOT NULL)
SELECT (SELECT count(DISTINCT entity) FROM d) AS n_present, count(*) AS n_missing, coalesce(string_agg(n_name, ',' ORDER BY n_name), '') AS missing_names,
  (SELECT string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) FROM (SELECT DISTINCT year FROM d)) AS years_present
FROM nation WHERE n_name NOT IN (SELECT entity FROM d)""")
def _(t):
    d = nation_years(t, _urgent()).filter("n is not null")
    return names.coverage(d, "entity", "year", t.nation.select(F.col("n_name").alias("entity")))


RAW_NAMES = """raw AS (SELECT CASE WHEN s_acctbal < 0 THEN 'ALL NATIONS' WHEN s_acctbal > 5000 THEN '  ' || lower(n_name) || ' ' ELSE n_name END AS entity,
  s_nationkey AS year, CAST(s_acctbal > 3000 AS INTEGER) AS v FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def raw_names(t: Tables) -> DataFrame:
    """Supplier rows that name their nation in several spellings, some a total."""
    return t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.when(F.col("s_acctbal") < 0, "ALL NATIONS").when(
            F.col("s_acctbal") > 5000, F.concat(F.lit("  "), F.lower("n_name"), F.lit(" "))).otherwise(F.col("n_name")).alias("entity"),
        F.col("s_nationkey").alias("year"), (F.col("s_acctbal") > 3000).cast("int").alias("v"), "s_suppkey")


def nation_variants(t: Tables) -> DataFrame:
    return names.variant_map(t.nation.select(F.col("n_name").alias("canonical_name"), F.col("n_name").alias("variant"), F.col("n_nationkey").alias("pos")), "pos")


@query("npi_standardize", f"WITH {RAW_NAMES} SELECT n_name AS entity, year, v FROM raw JOIN nation ON lower(trim(entity)) = lower(trim(n_name))")
def _(t):
    return names.standardize(raw_names(t).drop("s_suppkey"), "entity", nation_variants(t))


@query("npi_standardize_strict", f"WITH {RAW_NAMES} SELECT coalesce(n_name, entity) AS entity, year, v FROM raw LEFT JOIN nation ON lower(trim(entity)) = lower(trim(n_name))")
def _(t):
    """Every spelling is known here, the total included; an unknown one would fail the read."""
    total = t.spark.createDataFrame([("ALL NATIONS", "ALL NATIONS", 1000)], "canonical_name string, variant string, pos long")
    known = t.nation.select(F.col("n_name").alias("canonical_name"), F.col("n_name").alias("variant"), F.col("n_nationkey").cast("long").alias("pos"))
    return names.standardize_strict(raw_names(t).drop("s_suppkey"), "entity", names.variant_map(known.unionByName(total), "pos"))


@query("npi_unknown_names", f"WITH {RAW_NAMES} SELECT entity, count(*) AS n FROM raw WHERE lower(trim(entity)) NOT IN (SELECT lower(trim(n_name)) FROM nation) GROUP BY entity")
def _(t):
    return names.unknown_names(raw_names(t), "entity", nation_variants(t))


@query("npi_cleaning_report", f"""WITH {RAW_NAMES}, m AS (SELECT n_name, year, v FROM raw LEFT JOIN nation ON lower(trim(entity)) = lower(trim(n_name))),
k AS (SELECT count(*) AS n FROM (SELECT DISTINCT * FROM m WHERE n_name IS NOT NULL))
SELECT count(*) AS rows_in, count(*) FILTER (WHERE n_name IS NULL) AS rows_not_entity, count(n_name) - any_value(k.n) AS rows_repeated, any_value(k.n) AS rows_out FROM m, k""")
def _(t):
    return names.cleaning_report(raw_names(t).drop("s_suppkey"), "entity", nation_variants(t), ["entity", "year"], ["v"])
