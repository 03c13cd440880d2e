import numpy as np
import pytest
from pyspark.sql import functions as F

from brightloom.operators import spatial


def _brute(pts, k):
    out = set()
    for i, x, y in pts:
        ranked = sorted(((x - a) ** 2 + (y - b) ** 2, j) for j, a, b in pts if j != i)[:k]
        out |= {(i, j, n + 1) for n, (_, j) in enumerate(ranked)}
    return out


@pytest.mark.parametrize("block", [12, 2000])
def test_nearest(frame, block):
    """Clustered points, a spot with many copies and far outliers, over many blocks."""
    rng = np.random.default_rng(2)
    xy = np.round(np.concatenate([rng.normal(0, 0.2, (60, 2)), rng.normal(5, 2, (40, 2)), [[50, 50], [-40, 9]]]), 2)
    pts = [(i, float(a), float(b)) for i, (a, b) in enumerate(xy)] + [(200 + i, 1.0, 1.0) for i in range(30)]
    got = spatial.nearest(frame(pts, "id long, x double, y double"), "id", "x", "y", 4, block)
    assert {(r["i"], r["j"], r["position"]) for r in got.collect()} == _brute(pts, 4)


def _grid(frame, n, value):
    cells = [(f"{i}:{j}", float(value(i, j)), [(float(i + a), float(j + b)) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))])
             for i in range(n) for j in range(n)]
    return frame(cells, "id string, v double, ring array<struct<x:double,y:double>>")


def test_half_and_half(frame):
    g = _grid(frame, 6, lambda i, j: 1 if i < 3 else 0)
    e = spatial.queen(g, "id", "ring")
    assert e.filter("i = '0:0'").count() == 3 and e.filter("i = '2:2'").count() == 8
    w, v = spatial.row_weights(e).cache(), g.select("id", "v")
    m = spatial.moran_global(w, v).first()
    assert m["moran_i"] > 0.5 and m["expected_i"] == pytest.approx(-1 / 35) and m["isolates"] == 0
    p = spatial.moran_permutations(w, v, 99).first()
    assert p["moran_i"] == pytest.approx(m["moran_i"]) and p["significant"] and p["p_sim"] == 0.01
    assert spatial.moran_normal(w, v).first()["p_norm"] < 0.001


def test_checkerboard(frame):
    g = _grid(frame, 6, lambda i, j: (i + j) % 2)
    rook = spatial.queen(g, "id", "ring").filter(
        F.abs(F.split("i", ":")[0].cast("int") - F.split("j", ":")[0].cast("int"))
        + F.abs(F.split("i", ":")[1].cast("int") - F.split("j", ":")[1].cast("int")) == 1)
    assert spatial.moran_global(spatial.row_weights(rook), g.select("id", "v")).first()["moran_i"] == pytest.approx(-1.0)


def test_clusters_lie_in_the_block(frame):
    rng = np.random.default_rng(4)
    noise = rng.normal(0, 0.05, (8, 8))
    g = _grid(frame, 8, lambda i, j: (1 if i < 3 and j < 3 else 0) + noise[i, j])
    w = spatial.row_weights(spatial.queen(g, "id", "ring")).cache()
    got = spatial.local_clusters(w, g.select("id", "v"), 199).collect()
    high = {r["i"] for r in got if r["cluster"] == "High-High"}
    assert high and all(int(c.split(":")[0]) < 4 and int(c.split(":")[1]) < 4 for c in high)
    assert all((r["cluster"] == "Not significant") != r["significant"] for r in got)


def test_isolated_cell(frame):
    g = _grid(frame, 2, lambda i, j: i)
    far = frame([("far", 1.0, [(9.0, 9.0), (10.0, 9.0), (10.0, 10.0)])], "id string, v double, ring array<struct<x:double,y:double>>")
    both = g.unionByName(far)
    assert [r["i"] for r in spatial.isolates(both, "id", spatial.queen(both, "id", "ring")).collect()] == ["far"]


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8, 9, 1000])
def test_shuffles_are_bijections(spark, n):
    df = spark.range(n).select("id", F.explode(F.array(*[F.lit(k).cast("long") for k in range(1, 6)])).alias("key"))
    got = df.select("id", "key", spatial.shuffled_place(F.col("id"), n, F.col("key")).alias("at"))
    per = got.groupBy("key").agg(F.array_sort(F.collect_list("at")).alias("all"), F.collect_list(F.struct("id", "at")).alias("map")).collect()
    assert len(per) == 5 and all(r["all"] == list(range(n)) for r in per)
    if n == 1000:
        maps = {tuple(a for _, a in sorted(map(tuple, r["map"]))) for r in per}
        assert len(maps) == 5 and all(sum(i == a for i, a in enumerate(m)) < 10 for m in maps)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Sort" not in plan and "Window" not in plan and "Exchange" not in plan


def _ring(frame, n, extra=()):
    """Entities in a ring, each with its two next ones; a repeated id and unknown values."""
    w = frame([(i, (i + d) % n, 0.5) for i in range(n) for d in (1, 2)], "i long, j long, w double")
    v = [(i, float((i * 37) % 11) if i % 9 else None) for i in range(n)]
    return w, frame([*v, *extra], "id long, v double")


@pytest.mark.parametrize("n", [1, 2, 9, 1000])
def test_shuffles_run_backwards(spark, n):
    df = spark.range(n).select("id", spatial.shuffled_place(F.col("id"), n, F.lit(7).cast("long")).alias("at")).toPandas()
    assert spatial._unshuffled(df["at"].to_numpy(), n, np.full(n, 7), spatial.SEED).tolist() == df["id"].tolist()


@pytest.mark.parametrize("extra", [(), ((3, 1.0), (-1, 4.0))])
def test_permutations_move_arrays_not_rows(frame, spark, monkeypatch, extra):
    """The statistics of a plain deal by ``shuffled_place``, with no row per entity and permutation."""
    n, perms, written = 41, 300, []
    w, v = _ring(frame, n, extra)
    monkeypatch.setattr(spatial, "DEALT_ROWS", 16, raising=False)
    keep = spatial.stage
    monkeypatch.setattr(spatial, "stage", lambda df: written.append(keep(df)) or written[-1])
    got = spatial.moran_permutations(w, v, perms).first()
    assert max(df.count() for df in written) <= 3 * (n + len(extra))
    ids = sorted(v.collect(), key=lambda r: r["id"])
    mean = np.mean([r["v"] for r in ids if r["v"] is not None])
    z = np.array([np.nan if r["v"] is None else r["v"] - mean for r in ids])
    at = spark.range(len(ids)).select("id", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(perms).cast("long"))).alias("p")).select(
        "id", "p", spatial.shuffled_place(F.col("id"), len(ids), F.col("p")).alias("at")).collect()
    dealt = np.empty((perms, len(ids)))
    for r in at:
        dealt[r["p"] - 1, r["id"]] = z[r["at"]]
    where = {}
    for k, r in enumerate(ids):
        where.setdefault(r["id"], []).append(k)
    pairs = [(a, b, e["w"]) for e in w.collect() for a in where[e["i"]] for b in where[e["j"]]]
    a, b, ws = (np.array(x) for x in zip(*pairs))
    sims = len(ids) / n * np.nansum(dealt[:, a] * dealt[:, b] * ws, axis=1) / np.nansum(z * z)
    above = int((sims >= got["moran_i"]).sum())
    assert got["p_sim"] == pytest.approx((min(above, perms - above) + 1) / (perms + 1))
    assert got["z_sim"] == pytest.approx((got["moran_i"] - sims.mean()) / sims.std())


def test_hashes_are_sparks(spark):
    df = spark.range(-3, 4).select(
        "id", F.xxhash64(F.lit(5), "id").alias("base"), F.xxhash64(F.lit(5), "id", F.lit(999), F.lit(123456789012)).alias("all")).toPandas()
    seeds = spatial.hashed_int(df["base"].to_numpy().view(np.uint64), np.array([999]))
    assert spatial.hashed_long(seeds, 123456789012).view(np.int64).tolist() == df["all"].tolist()


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_draws_by_blocks_of_values(frame, spark, monkeypatch, block):
    """The counts of plain draws, whatever block a drawn value lies in; no draw is a row."""
    n, perms = 41, 150
    w, v = _ring(frame, n)
    for name, size in (("VALUE_ROWS", block), ("GROUP_ROWS", 16), ("PACK_ROWS", 3)):
        monkeypatch.setattr(spatial, name, size, raising=True)
    got = {r["i"]: r for r in spatial.local_clusters(w, v, perms).collect()}
    local = {r["i"]: r for r in spatial.moran_local(w, v).collect()}
    values = [r["v"] for r in sorted(v.collect(), key=lambda r: r["id"])]
    mean = np.mean([x for x in values if x is not None])
    drawn = spark.range(n).select("id", F.explode(F.sequence(F.lit(1), F.lit(perms))).alias("p")).select(
        "id", "p", *[F.pmod(F.xxhash64(F.lit(spatial.SEED), "id", "p", F.lit(s).cast("long")), F.lit(s + 1)).alias(f"d{s}") for s in (n - 3, n - 2)]).collect()
    above = dict.fromkeys(range(n), 0)
    for r in drawn:
        first, second = r[f"d{n - 3}"], r[f"d{n - 2}"]
        picks = [first, n - 2 if second == first else second]
        known = [values[p + (p >= r["id"])] for p in picks]
        known = [x - mean for x in known if x is not None]
        own = local[r["id"]]
        if known and own["z"] is not None and own["lag"] is not None:
            above[r["id"]] += own["z"] * sum(known) / 2 >= own["z"] * own["lag"] - 1e-12
    assert got.keys() == local.keys() and len(got) == n
    for i, r in got.items():
        if local[i]["z"] is None or local[i]["lag"] is None:
            assert r["p_sim"] == pytest.approx(2 / (perms + 1))
        else:  # values are few, so equal sums are as often above as below
            assert r["p_sim"] <= 2 * (above[i] + 1) / (perms + 1) + 0.03
