"""Index operators, with the published 38-entity table as truth."""

import itertools

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from brightloom.functions import stats
from brightloom.functions.regions import REGIONS
from brightloom.operators import index, ranking, regions, stability

# Entity, expenditure, participation and published score.
PUBLISHED = [
    ("Aceh", 11191, 99.43, 0.3303314668), ("Bali", 15383, 99.61, 0.1832804799), ("Banten", 13498, 99.43, 0.2524711901),
    ("Bengkulu", 12197, 99.42, 0.2966889888), ("Di Yogyakarta", 15855, 99.63, 0.166731484), ("Dki Jakarta", 20676, 99.49, 0.0083591331),
    ("Gorontalo", 11937, 98.69, 0.3280644983), ("Jambi", 12018, 99.49, 0.3005629806), ("Jawa Barat", 12447, 99.4, 0.2888707893),
    ("Jawa Tengah", 12746, 99.57, 0.2735165075), ("Jawa Timur", 13509, 99.28, 0.2567439076), ("Kalimantan Barat", 10689, 98.81, 0.3664688015),
    ("Kalimantan Selatan", 13757, 99.3, 0.2477548172), ("Kalimantan Tengah", 12612, 99.13, 0.291661242), ("Kalimantan Timur", 14254, 99.64, 0.220454961),
    ("Kalimantan Utara", 10568, 99.22, 0.357859002), ("Kep. Bangka Belitung", 13837, 99.51, 0.2385533029), ("Kep. Riau", 15881, 99.29, 0.1763803107),
    ("Lampung", 11683, 99.61, 0.308153919), ("Maluku", 9900, 99.59, 0.3689486118), ("Maluku Utara", 9613, 99.12, 0.3931858243),
    ("Nusa Tenggara Barat", 11922, 99.46, 0.3047317326), ("Nusa Tenggara Timur", 8735, 98.62, 0.4382978301), ("Papua", 11342, 83.61, 0.8150185623),
    ("Papua Barat", 9115, 98.41, 0.4319745384), ("Papua Barat Daya", 9076, None, 0.7829902126), ("Papua Pegunungan", 5861, None, 1.0),
    ("Papua Selatan", 9983, None, 0.7217684779), ("Papua Tengah", 8036, None, 0.8531893351), ("Riau", 12233, 99.65, 0.2883532609),
    ("Sulawesi Barat", 10516, 98.31, 0.3877873547), ("Sulawesi Selatan", 12773, 99.49, 0.2750820491), ("Sulawesi Tengah", 10934, 98.34, 0.3727512384),
    ("Sulawesi Tenggara", 10992, 99.2, 0.3441683759), ("Sulawesi Utara", 12450, 99.34, 0.2906271257), ("Sumatera Barat", 12041, 99.76, 0.2914276072),
    ("Sumatera Selatan", 12416, 99.41, 0.2896074287), ("Sumatera Utara", 11898, 99.51, 0.3039937349),
]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame([(n, float(x), p) for n, x, p, _ in PUBLISHED], "entity string, expenditure_per_capita double, participation_rate double")
    return df.withColumns({"poverty_rate": F.lit(1.0), "ipm": F.lit(1.0), "population": F.lit(10.0), "stunting_rate": F.lit(20.0), "stunting_category": F.lit("x")})


@pytest.fixture(scope="module")
def scored(table):
    return index.score(table, "entity").cache()


def test_published_scores(scored):
    got = {r["entity"]: r for r in scored.collect()}
    for name, _, part, want in PUBLISHED:
        assert got[name]["npi"] == pytest.approx(want, abs=1e-9)
        assert got[name]["data_completeness"] == ("full" if part is not None else "partial: education_access unavailable")
        assert got[name]["estimated_children_affected"] == pytest.approx(2.0)


def test_published_ranks_and_tiers(scored):
    edges = ranking.natural_breaks(scored, "npi")
    assert edges[1:-1] == pytest.approx([0.1832804799, 0.3303314668, 0.4382978301], abs=1e-9)
    out = ranking.rank_and_percentile(scored, "npi").withColumn("tier", ranking.break_tier(F.col("npi"), edges))
    assert dict(rows(out.groupBy("tier").count())) == {"Low": 4, "Medium": 20, "High": 9, "Critical": 5}
    ordered = [r["entity"] for r in out.orderBy("rank").collect()]
    assert ordered == [n for n, *_ in sorted(PUBLISHED, key=lambda r: -r[3])]
    assert out.filter("rank = 1").first()["percentile"] == 100.0
    quart = ranking.equal_count_tier(scored, "npi", ranking.QUARTILE_LABELS, "q")
    assert dict(rows(quart.groupBy("q").count())) == {"Low": 10, "Medium": 9, "High": 9, "Critical": 10}


def test_published_regions(spark, scored):
    mapping = spark.createDataFrame([(e, r) for r, es in REGIONS.items() for e in es], "entity string, region string")
    df = regions.assign_region(scored, "entity", mapping).cache()
    got = {r["region"]: r for r in regions.summary(df, "region", "npi", list(REGIONS)).collect()}
    assert got["Western"]["mean"] == pytest.approx(0.2627153364, abs=1e-9)
    assert got["Central"]["median"] == pytest.approx(0.3163981155, abs=1e-9)
    assert got["Eastern"]["std"] == pytest.approx(0.239893836, abs=1e-9)
    f, h = regions.anova(df, "region", "npi").first(), regions.kruskal(df, "region", "npi").first()
    assert f["f_statistic"] == pytest.approx(29.76, abs=0.005) and f["p_value"] == pytest.approx(2.8103025881760668e-08, rel=1e-6)
    assert h["h_statistic"] == pytest.approx(18.85, abs=0.005) and h["p_value"] == pytest.approx(8.085963793169757e-05, rel=1e-6)
    with pytest.raises(Exception, match="no region for"):
        regions.assign_region(spark.createDataFrame([("Nowhere",)], "entity string"), "entity", mapping).collect()


def test_ties_and_nulls(frame):
    df = frame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", 4.0), ("e", None)], "e string, s double")
    got = {r["e"]: (r["rank"], r["percentile"]) for r in ranking.rank_and_percentile(df, "s").collect()}
    assert got == {"a": (4, 25.0), "b": (2, 62.5), "c": (2, 62.5), "d": (1, 100.0), "e": (None, None)}


def _best_by_trying(values, classes):
    v = sorted(set(values))
    w = {x: values.count(x) for x in v}
    def ssd(part):
        xs = [x for x in part for _ in range(w[x])]
        m = sum(xs) / len(xs)
        return sum((x - m) ** 2 for x in xs)
    best = min(itertools.combinations(range(1, len(v)), classes - 1),
               key=lambda cut: sum(ssd(v[a:b]) for a, b in zip((0, *cut), (*cut, len(v)))))
    return [v[0], *[v[c - 1] for c in best], v[-1]]


@pytest.mark.parametrize("fan", [3, 256])
def test_natural_breaks_is_optimal(frame, fan):
    rng = np.random.default_rng(5)
    values = [round(float(x), 3) for x in np.concatenate([rng.normal(0, 1, 9), rng.normal(8, 1, 7), rng.normal(20, 2, 6)])] + [0.5, 0.5]
    df = frame([(v,) for v in values], "s double")
    assert ranking.natural_breaks(df, "s", 3, fan) == pytest.approx(_best_by_trying(values, 3))


def test_too_few_values(frame):
    with pytest.raises(ValueError, match="fewer than 4"):
        ranking.natural_breaks(frame([(1.0,), (2.0,)], "s double"), "s")
    with pytest.raises(Exception, match="not distinct"):
        ranking.equal_count_tier(frame([(1.0,)] * 5 + [(2.0,)], "s double"), "s", ranking.QUARTILE_LABELS, "t").collect()


def test_align_and_scale(frame):
    df = frame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    with pytest.raises(ValueError):
        index.align(df, {"a": "sideways"})
    assert [r["a"] for r in index.align(df, {"a": "higher_is_better"}).collect()] == [-1.0, -3.0, None]
    assert [r["a"] for r in index.min_max(df, ["a"]).collect()] == [0.0, 1.0, None]
    with pytest.raises(Exception, match="zero variance"):
        index.min_max(df, ["b"]).collect()
    w = frame([(1.0, 0.5), (1.0, None), (None, None)], "x double, y double")
    assert [r[0] for r in w.select(index.weighted_score({"x": 0.5, "y": 0.5})).collect()] == [0.75, 1.0, None]


def _numpy_pc(x):
    c = x - x.mean(axis=0)
    vals, vecs = np.linalg.eigh(c.T @ c)
    v = vecs[:, -1]
    v = -v if v.sum() < 0 else v
    return v, vals[-1] / vals.sum()


def test_component(frame):
    rng = np.random.default_rng(0)
    base = rng.uniform(0, 1, 30)
    x = np.column_stack([base, base * 0.8 + rng.normal(0, 0.05, 30), base + rng.normal(0, 0.1, 30)])
    df = frame([(f"e{i:02d}", *map(float, r)) for i, r in enumerate(x)] + [("none", None, 0.1, 0.2)], "e string, a double, b double, c double")
    fit = index.fit_component(df, ["a", "b", "c"])
    v, share = _numpy_pc(x)
    assert list(fit["loadings"].values()) == pytest.approx(v.tolist()) and fit["explained"] == pytest.approx(share) and fit["n"] == 30
    proj = [r[0] for r in df.orderBy("e").select(index.component_score(fit)).collect()]
    assert proj[:30] == pytest.approx(((x - x.mean(0)) @ v).tolist()) and proj[30] is None
    loo = {r["excluded"]: r for r in stability.leave_one_entity_out(df, "e", ["a", "b", "c"]).collect()}
    for i in (0, 17):
        vi, si = _numpy_pc(np.delete(x, i, axis=0))
        r = loo[f"e{i:02d}"]
        assert [r["loading_a"], r["loading_b"], r["loading_c"]] == pytest.approx(vi.tolist())
        assert r["variance_explained"] == pytest.approx(si) and r["loading_shift_l2"] == pytest.approx(np.linalg.norm(vi - v))
    noise = frame([tuple(map(float, r)) for r in np.eye(3)], "a double, b double, c double")
    with pytest.raises(ValueError, match="below 0.6"):
        index.fit_component(noise, ["a", "b", "c"], min_explained=0.6)


def test_stability(table):
    grid = {r["shift"]: r for r in stability.weight_grid(table, "entity", [-0.2, 0.0, 0.2]).collect()}
    assert grid[0.0]["rank_spearman_r"] == pytest.approx(1.0) and grid[0.0]["largest_shift"] == 0
    assert 0.9 < grid[0.2]["rank_spearman_r"] < 1.0 and grid[0.0]["n_compared"] == 38


def test_tail_probabilities():
    assert stats.f_tail(4.0, 2, 10) == pytest.approx((1 + 2 * 4.0 / 10) ** -5)  # closed form for 2 numerator degrees
    assert stats.chi2_tail(5.0, 2) == pytest.approx(np.exp(-2.5))
    assert stats.t_two_sided(1.0, 1) == pytest.approx(0.5)  # Cauchy
