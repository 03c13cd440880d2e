"""Hard negatives beside a plain scan of all vectors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightloom.llm import mining


def brute(rows, every=50, scale=256, positives=5, negatives=3):
    kept = []
    for i, label, v in rows:
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, label, [math.floor(scale * x) for x in v]))
    out = []
    for a, label, v in kept:
        if a % every:
            continue
        score = [(-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in kept]
        for s, p, _ in sorted(x for x in score if x[2] == label and x[1] != a)[:positives]:
            hard = sorted(x for x in score if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s)[:negatives]
            out += [(a, p, r, n, -s, -t) for r, (t, n, _) in enumerate(hard, 1)]
    return sorted(out)


def _mined(spark, rows, every=50):
    table = spark.createDataFrame(rows, "vec_id long, label int, vector array<float>").repartition(3)
    return sorted(map(tuple, mining.mine(table, F.col("vec_id") % every == 0).collect()))


def test_curve_visits_neighbours():
    for dims, bits in ((1, 3), (2, 4), (3, 3), (5, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = [bytes(k) for k in mining.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(cells)
        path = cells[np.array(sorted(range(len(keys)), key=keys.__getitem__))]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_bounds_hold():
    draw = np.random.default_rng(1)
    block, anchors = draw.integers(-50, 50, (40, 6)), draw.integers(-50, 50, (9, 6))
    least, most = mining.bounds(anchors, block.min(0)[None], block.max(0)[None])
    scores = anchors @ block.T
    assert (least[:, 0] <= scores.min(1)).all() and (scores.max(1) <= most[:, 0]).all()


def test_narrowed_window_keeps_the_best():
    least, most = np.array([[5, 8, 1]]), np.array([[9, 20, 7]])
    rows, far = np.array([[2, 1, 4]]), np.array([[mining.FAR]])
    assert mining.narrowed(least, most, rows, -far, far, 1).tolist() == [[8]]
    assert mining.narrowed(least, most, rows, -far, far, 3).tolist() == [[5]]
    assert mining.narrowed(least, most, rows, -far, np.array([[10]]), 3).tolist() == [[1]]
    assert mining.narrowed(least, most, rows, -far, far, 9).tolist() == [[-mining.FAR]]


def test_large_numbers_are_exact():
    a = np.array([[1 << 28, 3]]) * 5
    assert mining.products(a, a).tolist() == [[25 * (1 << 56) + 225]]


@pytest.mark.parametrize("block,zones", [(512, 2048), (16, 4)])
def test_beside_a_scan(spark, monkeypatch, block, zones):
    for name, value in (("BLOCK", block), ("GROUP", block), ("ZONES", zones)):
        monkeypatch.setattr(mining, name, value)
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(6, 8))
    rows = []
    for i in range(400):
        v = np.round(centres[i % 6] + draw.normal(size=8) * 0.3, 2)
        rows.append((i, int(draw.integers(0, 3)), [float(np.float32(x)) for x in v]))
    rows += [(400 + i, i % 2, rows[7][2]) for i in range(60)]  # ties
    random.Random(1).shuffle(rows)
    got = _mined(spark, rows)
    assert got == brute(rows) and len(got) > 50


def test_few_blocks_are_read(spark, monkeypatch):
    """Far clusters are told off by their zones."""
    monkeypatch.setattr(mining, "BLOCK", 16)
    draw = np.random.default_rng(3)
    rows = [(i, i % 2, [float(np.float32(x)) for x in (np.eye(8)[i % 8] * 10 + draw.normal(size=8) * 0.01)]) for i in range(800)]
    seen = []
    keep = mining.stage
    monkeypatch.setattr(mining, "stage", lambda df: seen.append(keep(df)) or seen[-1])
    table = spark.createDataFrame(rows, "vec_id long, label int, vector array<float>")
    got = sorted(map(tuple, mining.mine(table, F.col("vec_id") % 50 == 0).collect()))
    assert got == brute(rows)
    reads = next(x for x in seen if x.columns == ["group", "block", "anchors"])
    blocks = next(x for x in seen if "kinds" in x.columns)
    pairs = reads.agg(F.sum(F.octet_length("anchors") / 8)).first()[0]
    assert pairs < 0.5 * 16 * blocks.count()


def test_rows_of_all_kinds(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.5]), (2, 2, [0.9, 0.9]), (3, 2, [0.5, 0.5]), (4, None, [1.0, 1.0]), (None, 2, [1.0, 1.0]), (5, 2, None),
        (6, 2, [nan, 1.0]), (7, 2, [inf, 1.0]), (8, 2, [None, 1.0]), (9, 2, []), (10, 2, [0.7]), (11, 2, [0.8, 0.8, 5.0]), (50, 3, [0.0, 0.0]), (51, 3, [0.0, 0.0]), (100, 4, [-1.0, -1.0]), (101, 4, [1.0, 1.0]),
    ]
    got, want = _mined(spark, rows), brute(rows)  # zip() ends with the shorter vector, as zeros do
    assert got == want and {a for a, *_ in got} == {0, 50}


def test_repeated_ids_and_clashing_columns(spark):
    rows = [(0, 1, [1.0], 7, "x"), (1, 1, [0.9], 7, "x"), (1, 1, [0.9], 7, "x"), (2, 2, [0.6], 7, "x"), (2, 2, [0.6], 7, "x")]
    table = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>, block int, key string")
    got = sorted(map(tuple, mining.mine(table, F.col("vec_id") % 50 == 0).select("anchor_id", "positive_id", "rank", "negative_id").collect()))
    assert {(a, p, n) for a, p, _, n in got} == {(0, 1, 2)} and {r for *_, r, _ in got} == {1, 2}


def test_empty_tables(spark):
    assert _mined(spark, []) == []
    assert _mined(spark, [(1, 1, [1.0])]) == []
    assert _mined(spark, [(0, 1, [1.0])]) == []
