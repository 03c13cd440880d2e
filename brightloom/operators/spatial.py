"""Neighbour graphs and spatial autocorrelation.

Edges are rows (i, j, position, w); values meet them by equal joins. No step pairs all
entities: nearest neighbours are searched in blocks of bounded size and, where a point's
circle leaves its block, in the blocks it touches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.operators.ordering import row_numbers
from brightloom.session import cut, stage

# Fixed values of the published analysis.
DEFAULT_K = 6
PERMUTATIONS = 999
SIGNIFICANCE = 0.05
SEED = 12345
QUADRANTS = {(True, True): "High-High", (False, True): "Low-High", (False, False): "Low-Low", (True, False): "High-Low"}

BLOCK_ROWS = 2000


def _position(cuts: Column, value: Column) -> Column:
    """Index of the interval (cut, next cut] that holds the value."""
    return F.size(F.filter(cuts, lambda c: c < value))


def _blocks(places: DataFrame, rows: int) -> tuple[DataFrame, Column, DataFrame]:
    """Cut the plane in blocks of about ``rows`` places: strips by x, then cells by y.

    The cuts are approximate quantiles; they only set the balance, not the result.
    Returns the places with (strip, cell), the x cuts (about the square root of the
    number of blocks) and a table of the y cuts of each strip.
    """
    n = places.count()
    strips = max(1, round(math.sqrt(n / rows)))
    probs = [i / strips for i in range(1, strips)]
    found = places.agg(F.percentile_approx("x", probs, 10000)).first()[0] if probs else []
    x_cuts = F.array(*[F.lit(float(c)) for c in sorted(set(found or []))]).cast("array<double>")
    with_strip = places.withColumn("strip", _position(x_cuts, F.col("x")))
    largest = with_strip.groupBy("strip").count().agg(F.max("count")).first()[0] or 1
    parts = math.ceil(largest / rows)
    y_probs = [i / parts for i in range(1, parts)]
    y_cuts = with_strip.groupBy("strip").agg((
        F.array_distinct(F.percentile_approx("y", y_probs, 10000)) if y_probs
        else F.first(F.array().cast("array<double>"))).alias("cuts"))
    placed = with_strip.join(y_cuts, "strip").withColumn("cell", _position(F.col("cuts"), F.col("y")))
    return placed.drop("cuts"), x_cuts, y_cuts


def _search(seekers: pd.DataFrame, places: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest places of each seeker by (distance, lowest id), in chunks."""
    px, py, first, pid = (places[c].to_numpy() for c in ("x", "y", "first_id", "place"))
    parts = []
    if not len(px):
        seekers = seekers.iloc[:0]
    step = max(1, 4_000_000 // max(1, len(px)))
    for a in range(0, len(seekers), step):
        s = seekers.iloc[a:a + step]
        dx = s["x"].to_numpy()[:, None] - px[None]
        dy = s["y"].to_numpy()[:, None] - py[None]
        d2 = dx * dx + dy * dy
        order = np.lexsort((np.broadcast_to(first, d2.shape), d2), axis=1)[:, :k]
        parts.append(pd.DataFrame({
            "place": np.repeat(s["place"].to_numpy(), order.shape[1]),
            "other": pid[order].ravel(), "d2": np.take_along_axis(d2, order, 1).ravel(),
            "first_id": first[order].ravel(),
        }))
    cols = ["place", "other", "d2", "first_id"]
    return pd.concat(parts)[cols] if parts else pd.DataFrame(columns=cols)


def nearest(points: DataFrame, key: str, x: str, y: str, k: int = DEFAULT_K, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The k nearest other points of each point: (i, j, position, distance); ties by id.

    Points at one spot are folded to a place carrying its k+1 lowest ids, which is all
    any point can need, so a spot with many copies stays one row.
    """
    pts = cut(points.select(
        F.col(key).cast("long").alias("id"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")))
    lowest = row_numbers(pts, ["x", "y"], [F.col("id")], "_n").filter(F.col("_n") <= k + 1)
    places = cut(lowest.groupBy("x", "y").agg(F.min("id").alias("first_id"), F.array_sort(F.collect_list("id")).alias("ids"))
                 .withColumn("place", F.col("first_id")))
    slim = places.select("place", "first_id", "x", "y")
    placed, x_cuts, y_cuts = _blocks(slim, block_rows)
    placed = cut(placed)
    result = "place long, other long, d2 double, first_id long"

    near = cut(placed.groupBy("strip", "cell").applyInPandas(lambda pdf: _search(pdf, pdf, k + 1), result))
    reach = near.groupBy("place").agg(F.max("d2").alias("r2"), F.count(F.lit(1)).alias("found"))
    radius = F.when(F.col("found") >= k + 1, F.sqrt("r2") * (1 + 1e-12)).otherwise(F.lit(math.inf))
    seekers = placed.join(reach, "place").withColumn("r", radius)
    # A circle meets the strips between its left and right end, and in each the cells
    # between its lower and upper end.
    def span(cuts: Column, centre: str) -> Column:
        return F.sequence(_position(cuts, F.col(centre) - F.col("r")), _position(cuts, F.col(centre) + F.col("r")))

    reached = (
        seekers.withColumnsRenamed({"strip": "own_strip", "cell": "own_cell"})
        .withColumn("strip", F.explode(span(x_cuts, "x")))
        .join(y_cuts, "strip")
        .withColumn("cell", F.explode(span(F.col("cuts"), "y")))
        .filter((F.col("strip") != F.col("own_strip")) | (F.col("cell") != F.col("own_cell")))
        .select("strip", "cell", "place", "x", "y")
    )
    def visit(pdf: pd.DataFrame) -> pd.DataFrame:
        return _search(pdf[pdf["visitor"]], pdf[~pdf["visitor"]], k + 1)

    both = reached.withColumns({"first_id": F.lit(0).cast("long"), "visitor": F.lit(True)}).unionByName(
        placed.select("strip", "cell", "place", "x", "y", "first_id").withColumn("visitor", F.lit(False)))
    far = both.groupBy("strip", "cell").applyInPandas(visit, result)
    best = near.unionByName(far).groupBy("place").agg(F.slice(F.array_sort(F.collect_list(
        F.struct("d2", "first_id", "other"))), 1, k + 1).alias("c"))
    around = best.select("place", F.explode("c").alias("c")).select("place", "c.d2", F.col("c.other").alias("other")).join(
        places.select(F.col("place").alias("other"), "ids"), "other")
    options = around.groupBy("place").agg(F.flatten(F.collect_list(
        F.transform("ids", lambda i: F.struct(F.col("d2").alias("d2"), i.alias("j"))))).alias("opts"))
    by_spot = options.join(places.select("place", "x", "y"), "place").drop("place")
    chosen = F.slice(F.array_sort(F.filter("opts", lambda o: o.j != F.col("id"))), 1, k)
    return pts.join(by_spot, ["x", "y"]).select(F.col("id").alias("i"), F.posexplode(chosen).alias("_p", "_o")).select(
        "i", F.col("_o.j").alias("j"), (F.col("_p") + 1).alias("position"), F.sqrt("_o.d2").alias("distance"))


def queen(polygons: DataFrame, key: str, ring: str, digits: int = 9) -> DataFrame:
    """Pairs that share a boundary vertex, as (i, j)."""
    v = polygons.select(F.col(key).alias("i"), F.explode(ring).alias("p")).select(
        "i", F.round("p.x", digits).alias("x"), F.round("p.y", digits).alias("y")).distinct()
    return v.join(v.withColumnRenamed("i", "j"), ["x", "y"]).filter("i <> j").select("i", "j").distinct()


def isolates(polygons: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    return polygons.select(F.col(key).alias("i")).join(edges.select("i"), "i", "left_anti")


def row_weights(edges: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Each entity's neighbours share a weight of 1."""
    degree = edges.groupBy(*keys, "i").agg((1.0 / F.count(F.lit(1))).alias("w"))
    return edges.select(*keys, "i", "j").join(degree, [*keys, "i"])


def spatial_lag(weights: DataFrame, values: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Weighted mean of the neighbours: (i, lag). ``values`` has (id, v)."""
    return weights.join(values.select(F.col("id").alias("j"), "v"), "j").groupBy(*keys, "i").agg(
        F.sum(F.col("w") * F.col("v")).alias("lag"))


def deviations(values: DataFrame) -> DataFrame:
    """(id, z): distance from the mean."""
    return values.select("id", (F.col("v") - values.agg(F.avg("v")).scalar()).alias("z"))


def moran_global(weights: DataFrame, values: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Moran's I and its expectation, per weight scheme in ``keys``."""
    z = cut(deviations(values))
    lag = spatial_lag(weights, z.withColumnRenamed("z", "v"), keys)
    size = z.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col("z") ** 2).alias("zz"))).scalar()
    cross = lag.join(z.withColumnRenamed("id", "i"), "i").groupBy(*keys).agg(
        F.sum(F.col("z") * F.col("lag")).alias("zl"), F.count(F.lit(1)).alias("linked"))
    s = cross.withColumn("_s", size)
    return s.select(
        *keys, F.col("_s.n").alias("n"), (F.col("_s.n") - F.col("linked")).alias("isolates"),
        (F.col("_s.n") / F.col("linked") * F.col("zl") / F.col("_s.zz")).alias("moran_i"),
        (-1.0 / (F.col("_s.n") - 1)).alias("expected_i"))


def _normal_tail(z: Column) -> Column:
    @F.pandas_udf("double")
    def two_sided(s: pd.Series) -> pd.Series:
        return s.map(lambda v: math.erfc(abs(v) / math.sqrt(2)))

    return two_sided(z)


def moran_normal(weights: DataFrame, values: DataFrame) -> DataFrame:
    """z and two-sided p of I under normality."""
    back = weights.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("w").alias("wb"))
    both = weights.join(back, ["i", "j"], "full_outer").agg(
        (F.sum((F.coalesce("w", F.lit(0.0)) + F.coalesce("wb", F.lit(0.0))) ** 2) / 2).alias("s1")).select("s1").scalar()
    out_w, in_w = weights.groupBy("i").agg(F.sum("w").alias("o")), weights.groupBy(F.col("j").alias("i")).agg(F.sum("w").alias("n_"))
    s2 = out_w.join(in_w, "i", "full_outer").agg(
        F.sum((F.coalesce("o", F.lit(0.0)) + F.coalesce("n_", F.lit(0.0))) ** 2)).scalar()
    s0 = weights.agg(F.sum("w")).scalar()
    m = moran_global(weights, values).withColumns({"s0": s0, "s1": both, "s2": s2})
    n, e = F.col("n").cast("double"), F.col("expected_i")
    var = (n * n * F.col("s1") - n * F.col("s2") + 3 * F.col("s0") ** 2) / ((n * n - 1) * F.col("s0") ** 2) - e * e
    return m.withColumn("z_norm", (F.col("moran_i") - e) / F.sqrt(var)).select(
        "n", "moran_i", "expected_i", "z_norm", _normal_tail(F.col("z_norm")).alias("p_norm"))


# Fixed values of the shuffle's round function; every product stays below 2 ** 63.
PRIME = 2147483647
ROUNDS = 6
#: Steps that a number may need to come back below n; each is needed with a chance below 1/2.
WALK = 64


def shuffled_place(place: Column, n: int, key: Column, seed: int = SEED) -> Column:
    """A keyed bijection of 0 .. n-1: where ``place`` goes in the shuffle named by ``key``. A
    Feistel network over the least power of two from n on, walked on until the number is below
    n again; no rows are ordered for it."""
    bits = max(1, (n - 1).bit_length())
    low, high = bits - bits // 2, bits // 2

    def turn(x: Column, i: Column) -> Column:
        right = F.when(i % 2 == 0, F.lit(1 << low)).otherwise(F.lit(1 << high)).cast("long")
        left = F.when(i % 2 == 0, F.lit(1 << high)).otherwise(F.lit(1 << low)).cast("long")
        own = x % right
        mixed = (own * 48271 + key * 69621 + i * 16807 + seed) % PRIME
        mixed = (mixed * mixed % PRIME * 39373 + own) % PRIME
        return own * left + F.floor(x / right).cast("long").bitwiseXOR(mixed % left)

    rounds = F.array(*[F.lit(i).cast("long") for i in range(ROUNDS)])

    def network(x: Column) -> Column:
        return F.aggregate(rounds, x, turn)

    return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), network(place.cast("long")), lambda x, _: F.when(x < n, x).otherwise(network(x)))


def _unshuffled(at: np.ndarray, n: int, key: np.ndarray, seed: int) -> np.ndarray:
    """The places that ``shuffled_place`` sends to ``at``: its network and walk backwards."""
    bits = max(1, (n - 1).bit_length())
    low, high = bits - bits // 2, bits // 2

    def back(y: np.ndarray, k: np.ndarray) -> np.ndarray:
        for i in reversed(range(ROUNDS)):
            right, left = (low, high) if i % 2 == 0 else (high, low)
            own = y >> left
            mixed = (own * 48271 + (k * 69621 + i * 16807 + seed)) % PRIME
            mixed = (mixed * mixed % PRIME * 39373 + own) % PRIME
            y = (((y ^ mixed) & ((1 << left) - 1)) << right) + own
        return y

    x = back(at, key)
    while (out := np.flatnonzero(x >= n)).size:
        x[out] = back(x[out], key[out])
    return x


#: Permutations in one row's array, and places in one block of dealt values.
LOT = 125
DEALT_ROWS = 1024
#: Values that one task deals out.
DEALT_VALUES = 1 << 21


def _deal(z: DataFrame, n: int, permutations: int, seed: int) -> DataFrame:
    """(place, lot, zs): the values that each place gets in the permutations of a lot. Every
    value works out the places it goes to and travels there in arrays, one for each block of
    places; a task holds one batch of values or one block and lot."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lots = batch.column("lot").to_numpy()
            for lot in np.unique(lots):
                some = np.flatnonzero(lots == lot)
                perms = np.arange(lot * LOT + 1, min((lot + 1) * LOT, permutations) + 1)
                key = np.tile(perms, len(some))
                to = _unshuffled(np.repeat(batch.column("place").to_numpy()[some] - 1, len(perms)), n, key, seed)
                order = np.argsort(to, kind="stable")
                blocks, first = np.unique(to[order] // DEALT_ROWS, return_index=True)
                offsets = pa.array(np.append(first, len(to)), pa.int32())
                zs = batch.column("z").take(pa.array(some[order // len(perms)]))
                lists = [pa.ListArray.from_arrays(offsets, v) for v in (pa.array(to[order] % DEALT_ROWS), pa.array(key[order] - perms[0]), zs)]
                yield pa.RecordBatch.from_arrays([pa.array(blocks), pa.array(np.full(len(blocks), lot)), *lists], names=["block", "lot", "at", "slot", "z"])

    def receive(some: pa.Table) -> pa.Table:
        block, lot = some["block"][0].as_py(), some["lot"][0].as_py()
        size = min(DEALT_ROWS, n - block * DEALT_ROWS)
        at, slot, v = (pc.list_flatten(some[c]).combine_chunks() for c in ("at", "slot", "z"))
        width = min(LOT, permutations - lot * LOT)
        order = np.empty(size * width, np.int64)
        order[at.to_numpy() * width + slot.to_numpy()] = np.arange(len(at))
        return pa.table({
            "place": np.arange(size) + block * DEALT_ROWS + 1, "lot": np.full(size, lot),
            "zs": pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * width, pa.int32()), v.take(pa.array(order)))})

    lots = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((permutations - 1) // LOT).cast("long"))).alias("lot")
    # few bytes and much work: the number of tasks follows from the values dealt
    spread = z.select("place", "z", lots).repartition(max(1, math.ceil(n * permutations / DEALT_VALUES)), "place", "lot")
    sent = spread.mapInArrow(send, "block long, lot long, at array<long>, slot array<long>, z array<double>")
    return sent.groupBy("block", "lot").applyInArrow(receive, "place long, lot long, zs array<double>")


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of w * zi * zj and numbers of known products, per lot, in the order of its permutations."""
    for batch in batches:
        lots = batch.column("lot").to_numpy()
        for lot in np.unique(lots):
            some = batch.filter(pa.array(lots == lot))
            w = some.column("w").to_numpy(zero_copy_only=False)
            sides = [some.column(c).flatten() for c in ("zi", "zj")]
            left, right = (v.fill_null(0.0).to_numpy().reshape(len(w), -1) for v in sides)
            if sides[0].null_count or sides[1].null_count:
                found = (pc.and_(sides[0].is_valid(), sides[1].is_valid())).to_numpy(zero_copy_only=False).reshape(len(w), -1).sum(axis=0)
            else:
                found = np.full(left.shape[1], len(w))
            total = np.einsum("e,ep,ep->p", w, left, right)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lot]), pa.array([total], pa.list_(pa.float64())), pa.array([found], pa.list_(pa.int64()))], names=["lot", "total", "found"])


def moran_permutations(weights: DataFrame, values: DataFrame, permutations: int = PERMUTATIONS, seed: int = SEED) -> DataFrame:
    """Pseudo p and z of I against random reassignments of the values.

    Each permutation is a keyed bijection of the entities' places, so nothing is ordered per
    permutation. A row holds an entity's values of a whole lot of permutations, and an edge
    meets its two ends once a lot instead of once a permutation.
    """
    z = cut(row_numbers(deviations(values), [], [F.col("id")], "place"))
    n = z.count()
    dealt = stage(_deal(z, n, permutations, seed))
    ends = z.select("id", "place")
    edges = weights.filter("w is not null").join(ends.select(F.col("id").alias("i"), F.col("place").alias("a")), "i").join(
        ends.select(F.col("id").alias("j"), F.col("place").alias("b")), "j").select("a", "b", "w")
    pairs = edges.join(dealt.select(F.col("place").alias("b"), "lot", F.col("zs").alias("zj")), "b").join(
        dealt.select(F.col("place").alias("a"), "lot", F.col("zs").alias("zi")), ["a", "lot"])
    sums = pairs.select("lot", "w", "zi", "zj").mapInArrow(_cross, "lot long, total array<double>, found array<long>")
    per = sums.select("lot", F.posexplode(F.arrays_zip("total", "found")).alias("slot", "s")).groupBy("lot", "slot").agg(
        F.sum("s.total").alias("zl"), F.sum("s.found").alias("found")).filter("found > 0")
    size = z.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col("z") ** 2).alias("zz"))).scalar()
    s0 = weights.agg(F.sum("w")).scalar()
    sims = per.withColumn("_s", size).select(
        (F.col("_s.n") / s0 * F.col("zl") / F.col("_s.zz")).alias("sim"))
    obs = moran_global(weights, values).withColumnRenamed("moran_i", "obs").select("obs").scalar()
    stat = sims.withColumn("obs", obs).agg(
        F.max("obs").alias("moran_i"), F.count_if(F.col("sim") >= F.col("obs")).alias("above"),
        F.avg("sim").alias("m"), F.stddev_pop("sim").alias("s"))
    tail = F.least("above", F.lit(permutations) - F.col("above"))
    p = (tail + 1) / F.lit(permutations + 1)
    return stat.select(
        "moran_i", p.alias("p_sim"), ((F.col("moran_i") - F.col("m")) / F.col("s")).alias("z_sim"),
        F.lit(permutations).alias("permutations"), (p < SIGNIFICANCE).alias("significant"))


def moran_local(weights: DataFrame, values: DataFrame) -> DataFrame:
    """Local I and quadrant per entity: (i, z, lag, local_i, quadrant)."""
    z = cut(deviations(values))
    lag = spatial_lag(weights, z.withColumnRenamed("z", "v"))
    size = z.agg(F.struct(F.count(F.lit(1)).alias("n"), F.sum(F.col("z") ** 2).alias("zz"))).scalar()
    quadrant = F.lit(None).cast("string")
    for (own, around), label in QUADRANTS.items():
        quadrant = F.when(((F.col("z") > 0) == own) & ((F.col("lag") > 0) == around), label).otherwise(quadrant)
    return z.withColumnRenamed("id", "i").join(lag, "i").withColumn("_s", size).select(
        "i", "z", "lag", ((F.col("_s.n") - 1) * F.col("z") * F.col("lag") / F.col("_s.zz")).alias("local_i"), quadrant.alias("quadrant"))


_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _finished(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def hashed_int(seeds: np.ndarray, v: np.ndarray) -> np.ndarray:
    """``F.xxhash64`` of a row whose columns so far hash to ``seeds`` (uint64) and one more int."""
    return _finished(_turned((seeds + (_P5 + np.uint64(4))) ^ (v.astype(np.uint64) * _P1), 23) * _P2 + _P3)


def hashed_long(seeds: np.ndarray, v: int) -> np.ndarray:
    """The same for one more long."""
    mixed = _turned(np.array([v]).astype(np.uint64) * _P2, 31) * _P1
    return _finished(_turned((seeds + (_P5 + np.uint64(8))) ^ mixed, 27) * _P1 + _P4)


#: Rows of one group of entities, of one block of values, and of one array of values.
GROUP_ROWS = 1024
VALUE_ROWS = 1 << 20
PACK_ROWS = 4096
#: Draws that are held at a time.
DRAWS = 1 << 17


def _drawn_sums(bases: np.ndarray, owns: np.ndarray, k: int, m: int, start: int, values: np.ndarray, known: np.ndarray | None, permutations: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the values among ``values``, which begin at place ``start`` + 1, that the rows
    draw in each permutation: k of m others; and whether any was known."""
    if k > m:
        raise ValueError(f"{k} neighbours of {m} others")
    total, found = np.zeros((len(bases), permutations)), np.zeros((len(bases), permutations), bool)
    rows = max(1, DRAWS // (k * permutations))
    width = max(1, min(permutations, DRAWS // k))
    for r in range(0, len(bases), rows):
        for c in range(0, permutations, width):
            part = np.s_[r : r + rows, c : c + width]
            seeds = hashed_int(bases[r : r + rows, None], np.arange(c, min(c + width, permutations))[None] + 1)
            picks: list[np.ndarray] = []
            for step in range(m - k, m):
                pick = hashed_long(seeds, step).view(np.int64) % (step + 1)
                taken = np.zeros(pick.shape, bool)
                for other in picks:
                    taken |= pick == other
                picks.append(np.where(taken, step, pick))
            for pick in picks:
                at = pick + (pick >= owns[r : r + rows, None] - 1) - start
                if start or len(values) <= m:
                    inside = (at >= 0) & (at < len(values))
                    at = np.where(inside, at, 0)
                else:
                    inside = None
                if known is not None:
                    inside = known[at] if inside is None else inside & known[at]
                total[part] += values[at] if inside is None else np.where(inside, values[at], 0.0)
                if inside is None:
                    found[part] = True
                else:
                    found[part] |= inside
    return total, found


def local_clusters(weights: DataFrame, values: DataFrame, permutations: int = PERMUTATIONS, seed: int = SEED) -> DataFrame:
    """Local I with a two-sided pseudo p from conditional permutations, and the cluster
    name where it is significant.

    An entity's value stays; its neighbours are redrawn without repetition from all others.
    A draw is a hash of (seed, entity, permutation, step), so groups of entities repeat their
    draws beside each block of values and keep what falls into it: no draw is ever a row, and
    a task holds one group and one block.
    """
    local = cut(moran_local(weights, values))
    z = cut(row_numbers(deviations(values), [], [F.col("id")], "place"))
    n = z.count()
    degree = weights.groupBy("i").agg(F.count(F.lit(1)).alias("k"))
    # rows of one id share their draws; the first of them names the entity
    entity = cut(z.filter("id is not null").groupBy(F.col("id").alias("i")).agg(F.min("place").alias("e"))
                 .withColumn("g", F.floor((F.col("e") - 1) / GROUP_ROWS).cast("long")).join(degree, "i"))
    block = F.floor((F.col("place") - 1) / VALUE_ROWS).cast("long").alias("block")

    def up_to(last: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, last)).cast("long")))

    base = entity.join(z.select(F.col("id").alias("i"), "place"), "i").select(
        "g", "e", "k", F.col("place").alias("own"), F.xxhash64(F.lit(seed), F.col("i")).alias("base"), up_to((n - 1) // VALUE_ROWS).alias("block"))
    packs = z.groupBy(block, F.floor((F.col("place") - 1) / PACK_ROWS).cast("long").alias("pack")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "z"))), lambda p: p.z).alias("zs")).select(
        "*", up_to((n - 1) // GROUP_ROWS).alias("g"))

    def draw(rows: pa.Table, some: pa.Table) -> pa.Table:
        flat = pc.list_flatten(some.sort_by("pack")["zs"]).combine_chunks()
        known = flat.is_valid().to_numpy(zero_copy_only=False) if flat.null_count else None
        held = flat.fill_null(0.0).to_numpy()
        out, ks = [], rows["k"].to_numpy()
        for k in np.unique(ks):
            own = rows.filter(pa.array(ks == k))
            start = own["block"][0].as_py() * VALUE_ROWS
            total, found = _drawn_sums(
                own["base"].to_numpy().view(np.uint64), own["own"].to_numpy(), int(k), n - 1, start, held, known, permutations)
            sums = pa.array(total.ravel(), mask=None if found.all() else ~found.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * permutations, pa.int32()), sums)
            out.append(pa.table({"g": own["g"], "e": own["e"], "sums": lists}))
        return pa.concat_tables(out) if out else pa.table({"g": pa.array([], pa.int64()), "e": pa.array([], pa.int64()), "sums": pa.array([], pa.list_(pa.float64()))})

    def compare(some: pa.Table, own: pa.Table) -> pa.Table:
        places, at = np.unique(some["e"].to_numpy(), return_inverse=True)
        sums, found = np.zeros((len(places), permutations)), np.zeros((len(places), permutations), bool)
        flat = pc.list_flatten(some["sums"]).combine_chunks()
        np.add.at(sums, at, flat.fill_null(0.0).to_numpy().reshape(-1, permutations))
        np.logical_or.at(found, at, flat.is_valid().to_numpy(zero_copy_only=False).reshape(-1, permutations))
        above, below = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        for e, k, zi, lag in zip(*(own[c].to_pylist() for c in ("e", "k", "z", "lag"))):
            if zi is not None and lag is not None:
                r = np.searchsorted(places, e)
                sim, seen = zi * (sums[r] / k), zi * lag
                # as in Spark, NaN equals NaN and is above all else
                above[r] += (((sim >= seen) | np.isnan(sim)) & found[r]).sum()
                below[r] += (((sim <= seen) | math.isnan(seen)) & found[r]).sum()
        return pa.table({"e": places, "above": above, "below": below})

    sums = base.groupBy("g", "block").cogroup(packs.groupBy("g", "block")).applyInArrow(draw, "g long, e long, sums array<double>")
    seen = local.select("i", "z", "lag").join(entity, "i").select("g", "e", "k", "z", "lag")
    counted = sums.groupBy("g").cogroup(seen.groupBy("g")).applyInArrow(compare, "e long, above long, below long")
    counts = counted.join(entity.select("e", "i"), "e").select("i", "above", "below")
    p = F.least(F.lit(1.0), 2 * (F.least("above", "below") + 1) / F.lit(permutations + 1))
    out = local.join(counts, "i").withColumn("p_sim", p)
    return out.select(
        "i", "local_i", "quadrant", "p_sim", (F.col("p_sim") < SIGNIFICANCE).alias("significant"),
        F.when(F.col("p_sim") < SIGNIFICANCE, F.col("quadrant")).otherwise("Not significant").alias("cluster"))


def sensitivity(points: DataFrame, values: DataFrame, key: str, x: str, y: str, ks: Sequence[int] = (4, 6, 8)) -> DataFrame:
    """Moran's I for several neighbour counts from one neighbour search."""
    edges = nearest(points, key, x, y, max(ks))
    grid = F.explode(F.filter(F.array(*[F.lit(k) for k in ks]), lambda k: k >= F.col("position"))).alias("k")
    weights = cut(row_weights(edges.select("i", "j", grid), ["k"]))
    return moran_global(weights, values, ["k"])
