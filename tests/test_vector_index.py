"""The inverted-list index beside a plain scan."""

import numpy as np
import pytest

from brightloom.operators import vector_index as vx


def brute(rows, queries, k, others):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and all(x is not None for x in v)]
    ids = np.array([i for i, _ in ok])
    unit = lambda m: m / np.where((n := np.linalg.norm(m, axis=1, keepdims=True)) == 0, 1, n)
    x = unit(np.stack([v for _, v in ok]))
    out = []
    for q, v in queries:
        c = np.round(unit(np.array([v], float)) @ x.T, 12)[0]
        order = [j for j in np.lexsort((ids, -c)) if not others or ids[j] != q][:k]
        out += [(q, int(ids[j]), p) for p, j in enumerate(order, 1)]
    return sorted(out)


@pytest.mark.parametrize("block,probes", [(4096, 1), (16, 3)])
def test_exact_on_any_data(spark, tmp_path, monkeypatch, block, probes):
    monkeypatch.setattr(vx, "BLOCK", block)
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(8, 6))
    rows = [(i, (centres[i % 8] + draw.normal(size=6) * (0.2 if i < 250 else 2)).tolist()) for i in range(300)]
    rows += [(300 + i, rows[3][1]) for i in range(40)] + [(400, [0.0] * 6), (401, None), (None, [1.0] * 6), (402, [None] * 6)]
    df = spark.createDataFrame(rows, "p long, v array<double>").repartition(3)
    queries = [r for r in rows if r[0] is not None and r[0] % 20 == 0]
    index = vx.build(df, "p", "v", f"{tmp_path}/x", 8)
    got = vx.search(index, spark.createDataFrame(queries, "p long, v array<double>"), "p", "v", 4, probes, others=True)
    assert sorted((r.query_id, r.passage_id, r.position) for r in got.collect()) == brute(rows, queries, 4, True)


def test_clusters_are_found_by_few_lists(spark, tmp_path):
    draw = np.random.default_rng(2)
    centres = np.eye(10)
    rows = [(i, (centres[i % 10] + draw.normal(size=10) * 0.02).tolist()) for i in range(500)]
    df = spark.createDataFrame(rows, "p long, v array<double>")
    index = vx.build(df, "p", "v", f"{tmp_path}/x", 10)
    asked = df.filter("p % 25 = 0")
    probes = vx.choose_probes(index, asked, "p", "v", 5, 0.95)
    assert probes <= 3
    got = vx.search(index, asked, "p", "v", 5, probes).collect()
    assert sum(r.probed for r in got) >= 0.95 * len(got)
    # clusters lie far apart: no list beyond the first ones can hold a better row
    assert (np.cos(np.maximum(np.pi / 2 - index.radii.max(), 0)) < min(r.cosine for r in got))


def test_empty(spark, tmp_path):
    none = spark.createDataFrame([], "p long, v array<double>")
    index = vx.build(none, "p", "v", f"{tmp_path}/x")
    assert vx.search(index, none, "p", "v").count() == 0
    one = spark.createDataFrame([(1, [1.0, 0.0])], "p long, v array<double>")
    index = vx.build(one, "p", "v", f"{tmp_path}/y")
    assert [tuple(r)[:2] for r in vx.search(index, one, "p", "v").collect()] == [(1, 1)]
    assert vx.search(index, none, "p", "v").count() == 0
