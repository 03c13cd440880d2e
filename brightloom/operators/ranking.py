"""Ranks, percentiles and tiers of a score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.operators.ordering import quantiles, running_totals, value_ranks
from brightloom.session import cut

# Tier names and the policy cut-offs.
QUARTILE_LABELS = ["Low", "Medium", "High", "Critical"]
QUINTILE_LABELS = ["Very Low", "Low", "Medium", "High", "Very High"]
POLICY_CUTS = [0.25, 0.5, 0.75]
BOUNDARY_MARGIN = 0.02

INF = float("inf")


def join_ranks(df: DataFrame, score: str, keys: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """Attach ``rank_min``, ``rank_avg`` and ``n`` to each row; null scores get nulls.

    The rows are frozen first: a score that is summed again in another order could
    differ in its last bit and miss its own rank.
    """
    frozen = cut(df)
    ranks = value_ranks(frozen, score, keys, descending).drop("ties")
    cond = frozen[score] == ranks[score]
    for k in keys:
        cond = cond & frozen[k].eqNullSafe(ranks[k])
    return frozen.join(ranks, cond, "left").select(
        frozen["*"], ranks["rank_min"], ranks["rank_avg"], ranks["n"])


def rank_and_percentile(df: DataFrame, score: str) -> DataFrame:
    """Rank 1 is the highest score, ties share the best rank; percentile 100 is the highest."""
    r = join_ranks(df, score)
    ascending = F.col("n") + 1 - F.col("rank_avg")
    return r.withColumns({
        "rank": F.col("rank_min").cast("long"), "percentile": ascending / F.col("n") * 100,
    }).drop("rank_min", "rank_avg", "n")


def tier_by(value: Column, edges: Sequence[Column | float], labels: Sequence[str]) -> Column:
    """Right-closed tiers, the lowest edge included. Null where edges coincide: equal
    edges leave fewer classes than labels, which is an error in the caller's data."""
    out = F.when((value >= edges[0]) & (value <= edges[1]), labels[0])
    for lo, hi, label in zip(edges[1:], edges[2:], labels[1:]):
        out = out.when((value > lo) & (value <= hi), label)
    return out


def equal_count_edges(df: DataFrame, score: str, classes: int) -> Column:
    """The quantile edges as one struct, read as a scalar subquery."""
    probs = {f"e{i}": i / classes for i in range(classes + 1)}
    q = quantiles(df, score, probs)
    distinct = F.size(F.array_distinct(F.array(*[F.col(p) for p in probs])))
    safe = F.when(distinct == classes + 1, F.struct(*probs)).otherwise(
        F.raise_error(F.lit(f"{score}: quantile edges are not distinct, {classes} tiers impossible")))
    return q.select(safe).scalar()


def equal_count_tier(df: DataFrame, score: str, labels: Sequence[str], name: str) -> DataFrame:
    n = len(labels)
    e = equal_count_edges(df, score, n)
    t = df.withColumn("_e", e)
    edges = [F.col(f"_e.e{i}") for i in range(n + 1)]
    return t.withColumn(name, tier_by(F.col(score), edges, labels)).drop("_e")


def tier_on_edges_of(df: DataFrame, base: DataFrame, score: str, labels: Sequence[str], name: str) -> DataFrame:
    """Tiers between the inner edges of another table's equal-count tiers; the outer tiers are
    open, as scores may lie beyond all of that table's."""
    n = len(labels)
    t = df.withColumn("_e", equal_count_edges(base, score, n))
    edges = [F.lit(-INF), *[F.col(f"_e.e{i}") for i in range(1, n)], F.lit(INF)]
    return t.withColumn(name, tier_by(F.col(score), edges, labels)).drop("_e")


def policy_tier(score: Column, cuts: Sequence[float] = POLICY_CUTS, labels: Sequence[str] = QUARTILE_LABELS) -> Column:
    return tier_by(score, [F.lit(-INF), *map(F.lit, cuts), F.lit(INF)], labels)


def natural_breaks(df: DataFrame, score: str, classes: int = 4, fan: int = 256) -> list[float]:
    """Class edges that minimise the squared deviation inside classes; exact.

    Works on distinct values with counts. ``best(c, i)``, the least cost of the first
    i values in c classes, is the minimum over the split m of ``best(c-1, m)`` plus the
    cost of one class m+1 … i, and the best m never decreases with i. So it is solved
    for every ``fan``-th position first, whose splits bound the search of the positions
    between: about fan x values candidates per round in place of values squared. One
    path serves every number of values; of few, all positions are solved in one round.
    """
    folded = cut(df.filter(F.col(score).isNotNull()).groupBy(F.col(score).cast("double").alias(score)).agg(F.count(F.lit(1)).alias("w")))
    centre = folded.agg(F.sum(F.col(score) * F.col("w")) / F.sum("w")).scalar()
    c = F.col(score) - centre
    moments = folded.select(
        F.col(score).cast("double").alias("v"), "w", F.lit(1).alias("one"),
        (c * F.col("w")).alias("s"), (c * c * F.col("w")).alias("q"))
    prefix = cut(running_totals(
        moments, [F.col("v")], {"i": "one", "cw": "w", "cs": "s", "cq": "q"}
    ).select("i", "v", "cw", "cs", "cq"))
    total = prefix.agg(F.max("i")).first()[0] or 0
    if total < classes:
        raise ValueError(f"{score}: {total} distinct values, fewer than {classes} classes")
    best = prefix.select("i", (F.col("cq") - F.col("cs") ** 2 / F.col("cw")).alias("cost"), F.lit(0).cast("long").alias("m"))
    rounds = [best]
    for c_no in range(2, classes + 1):
        last = c_no == classes
        best = _split_round(prefix, best, total, c_no, fan, only=total if last else None)
        rounds.append(best)
    edges, at = [], total
    for solved in reversed(rounds[1:]):
        at = solved.filter(F.col("i") == at).first()["m"]
        edges.append(at)
    wanted = [1, *reversed(edges), total]
    values = {r["i"]: r["v"] for r in prefix.filter(F.col("i").isin(wanted)).collect()}
    return [values[i] for i in wanted]


def _split_round(prefix: DataFrame, before: DataFrame, total: int, c_no: int, fan: int, only: int | None) -> DataFrame:
    """Best last split for every position (or just one) with ``c_no`` classes."""
    ends = prefix.select("i", F.col("cw").alias("ew"), F.col("cs").alias("es"), F.col("cq").alias("eq"))
    starts = prefix.join(before.select("i", F.col("cost").alias("head")), "i").select(
        F.col("i").alias("m"), "cw", "cs", "cq", "head")
    if only is not None:
        todo = ends.filter(F.col("i") == only).withColumns({
            "gap": F.lit(0).cast("long"), "lo": F.lit(c_no - 1).cast("long"), "hi": F.lit(only - 1).cast("long")})
        return _solve(todo, starts, c_no)
    stride = 1
    while stride * fan < total:
        stride *= fan
    solved: DataFrame | None = None
    while True:
        step = stride * fan
        todo = ends.filter((F.col("i") >= c_no) & (F.col("i") % stride == 0)).withColumn(
            "gap", F.floor(F.col("i") / step))
        if solved is None:
            todo = todo.withColumns({"lo": F.lit(c_no - 1).cast("long"), "hi": F.lit(total - 1).cast("long")})
        else:
            todo = todo.filter(F.col("i") % step != 0)
            left = solved.select((F.col("i") / step).cast("long").alias("gap"), F.col("m").alias("lo"))
            right = solved.select((F.col("i") / step - 1).cast("long").alias("gap"), F.col("m").alias("hi"))
            todo = todo.join(left, "gap", "left").join(right, "gap", "left").fillna(c_no - 1, ["lo"]).fillna(total - 1, ["hi"])
        level = _solve(todo, starts, c_no)
        solved = level if solved is None else cut(solved.unionByName(level))
        if stride == 1:
            return solved
        stride //= fan


def _solve(todo: DataFrame, starts: DataFrame, c_no: int) -> DataFrame:
    chunk = 4096
    gaps = todo.select("gap", "lo", "hi").distinct()
    splits = (
        gaps.select("gap", "hi", F.explode(F.sequence("lo", F.col("hi"), F.lit(chunk).cast("long"))).alias("a"))
        .select("gap", F.explode(F.sequence("a", F.least(F.col("a") + chunk - 1, F.col("hi")))).alias("m"))
    )
    spread = F.col("es") - F.col("cs")
    cost = F.col("head") + (F.col("eq") - F.col("cq")) - spread * spread / (F.col("ew") - F.col("cw"))
    pairs = splits.join(starts, "m").join(todo.drop("lo", "hi"), "gap").filter(
        (F.col("m") < F.col("i")) & (F.col("m") >= c_no - 1))
    return cut(
        pairs.groupBy("i").agg(F.min(F.struct(cost.alias("cost"), F.col("m"))).alias("b"))
        .select("i", "b.cost", "b.m")
    )


def break_tier(score: Column, edges: Sequence[float], labels: Sequence[str] = QUARTILE_LABELS) -> Column:
    return tier_by(score, [F.lit(e) for e in edges], labels)


def near_boundary(score: Column, edges: Sequence[float], margin: float = BOUNDARY_MARGIN) -> Column:
    """Whether an interior edge is closer than ``margin``; null scores are not near."""
    inner = [F.abs(score - e) for e in edges[1:-1]]
    if not inner:
        return F.lit(False)
    closest = F.least(*inner) if len(inner) > 1 else inner[0]
    return F.coalesce(closest < margin, F.lit(False))
